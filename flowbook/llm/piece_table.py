"""Fill-in-middle transformation on piece tables.

A document is a list of descriptors ``(buffer, begin, size)`` over two buffers that never change: its text and the
sentinels.  Cutting splits the text's descriptor in three, an arrangement permutes them with a sentinel before each,
and the inverse permutation restores the text from the output.  Bytes are copied only where an output is written
out; digests are streamed from the descriptors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flat import slices

TEXT, SENTINEL = 0, 1
SENTINELS = ("<P>", "<S>", "<M>")
PREFIX, SUFFIX, MIDDLE = 0, 1, 2
# The parts of a document in output order.
ARRANGEMENTS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
IN_TEXT = (PREFIX, MIDDLE, SUFFIX)
STREAM_BYTES = 1 << 20

Piece = tuple[int, int, int]


def checked(sentinels: Sequence[str]) -> tuple[bytes, ...]:
    """The sentinels as bytes; ``ValueError`` where text beside one, or another one, could be read as a sentinel."""
    made = tuple(s.encode() for s in sentinels)
    if len(made) != 3 or not all(made):
        raise ValueError("three sentinels are needed: prefix, suffix, middle")
    for i, a in enumerate(made):
        for j, b in enumerate(made):
            if (i != j and a in b) or any(a[-n:] == b[:n] for n in range(1, min(len(a), len(b)))):
                raise ValueError(f"sentinels {sentinels[i]!r} and {sentinels[j]!r} overlap")
    return made


def cut(begin: int, first: int, second: int, end: int) -> list[Piece]:
    """Prefix, suffix and middle of a text at ``begin:end`` that is cut at ``first`` and ``second``."""
    return [(TEXT, begin, first - begin), (TEXT, second, end - second), (TEXT, first, second - first)]


def arrange(parts: Sequence[Piece], form: str, sentinels: Sequence[bytes]) -> list[Piece]:
    """The parts in the order of ``form``, each after its sentinel (the sentinel buffer is the three joined)."""
    out = []
    for part in ARRANGEMENTS[form]:
        out.append((SENTINEL, sum(map(len, sentinels[:part])), len(sentinels[part])))
        out.append(parts[part])
    return out


def disarrange(output: bytes, form: str, sentinels: Sequence[bytes]) -> list[Piece]:
    """The text as descriptors over an output: its sentinels bound the parts, the inverse permutation orders them."""
    if form == "plain":
        return [(TEXT, 0, len(output))]
    order = ARRANGEMENTS[form]
    at = [output.find(sentinels[part]) for part in order] + [len(output)]
    parts = {part: (TEXT, at[k] + len(sentinels[part]), at[k + 1] - at[k] - len(sentinels[part])) for k, part in enumerate(order)}
    return [parts[part] for part in IN_TEXT]


def digest(pieces: Sequence[Piece], buffers: Sequence[memoryview]) -> str:
    """SHA-256 of the bytes that descriptors stand for, a stretch at a time."""
    made = hashlib.sha256()
    for buffer, begin, size in pieces:
        for at in range(begin, begin + size, STREAM_BYTES):
            made.update(buffers[buffer][at:min(at + STREAM_BYTES, begin + size)])
    return made.hexdigest()


def written(pieces: Sequence[Piece], buffers: Sequence[memoryview]) -> bytes:
    return b"".join([buffers[buffer][begin:begin + size] for buffer, begin, size in pieces])


def _draws(seed: int, doc_id: int | None) -> list[int]:
    made = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(made[k:k + 4], "big") for k in range(0, 16, 4)]


def _points(data: np.ndarray) -> int:
    """Code points of UTF-8 bytes."""
    return len(data) - int(np.count_nonzero((data & 0xC0) == 0x80))


_PIECES = pa.list_(pa.struct([("buffer", pa.int8()), ("begin", pa.int64()), ("size", pa.int64())]))
_FIELDS = [
    ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
    ("pieces", _PIECES), ("output", pa.binary()), ("output_sha256", pa.string()),
]
_SCHEMA = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, pieces array<struct<buffer: tinyint, begin: long, size: long>>, "
    "output string, output_sha256 string"
)


def transform(docs: DataFrame, seed: int = 7, rate: int = 100, spm_rate: int = 50, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, pieces, output, output_sha256`` per row of ``docs``.

    Needs ``doc_id, text``; other columns are ignored.  A text has ``n`` lines, each with its line end; both cuts are
    line ends (or the begin) drawn by a hash of ``seed`` and ``doc_id``.  ``rate`` percent of documents are arranged,
    ``spm_rate`` percent of those suffix first; the others, empty or null texts and texts that contain a sentinel stay
    ``plain`` and have null lengths.  ``pieces`` are the output's descriptors in bytes over the text (buffer 0) and
    the joined sentinels (buffer 1).  A null ``doc_id`` is drawn as an empty one; repeated rows and rows with one
    ``doc_id`` are transformed each, with equal draws; an empty table gives no rows.  A very long text is one row: a
    task holds the text and its output, besides about 2 MB of other texts.  No shuffle.
    """
    marks = checked(sentinels)
    joined = memoryview(b"".join(marks))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for lo, hi, data, offsets in slices(batch.column("text")):
                raw = data.tobytes()
                buffers = (memoryview(raw), joined)
                ends = np.flatnonzero(data == 10) + 1
                places = np.searchsorted(ends, offsets, "right").tolist()
                rows, bounds = [], offsets.tolist()
                for k in range(hi - lo):
                    begin, end = bounds[k], bounds[k + 1]
                    full = places[k + 1] - places[k]  # line ends inside the text
                    n = full + (end > begin and raw[end - 1] != 10)
                    h = _draws(seed, keys[lo + k])
                    form = "spm" if h[3] % 100 < spm_rate else "psm"
                    if begin == end or h[2] % 100 >= rate or any(raw.find(m, begin, end) >= 0 for m in marks):
                        form = "plain"
                    if form == "plain":
                        pieces, lengths = [(TEXT, begin, end - begin)], (None, None)
                    else:
                        a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
                        first, second = (begin if c == 0 else end if c > full else int(ends[places[k] + c - 1]) for c in (a, b))
                        pieces = arrange(cut(begin, first, second, end), form, marks)
                        lengths = _points(data[begin:first]), _points(data[first:second])
                    own = [{"buffer": p[0], "begin": p[1] - begin * (p[0] == TEXT), "size": p[2]} for p in pieces]
                    rows.append((keys[lo + k], n, form, *lengths, own, written(pieces, buffers), digest(pieces, buffers)))
                columns = [pa.array(c, t) for c, (_, t) in zip(zip(*rows), _FIELDS)]
                columns[6] = columns[6].cast(pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=[name for name, _ in _FIELDS])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(make, _SCHEMA)


def restore(transformed: DataFrame, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """The rows with ``restored, restored_sha256``: the text rebuilt from ``output`` and ``form`` alone.

    Other columns stay as they are; columns with the added names are replaced.  A null output is empty, a null form
    is plain.  An empty table gives no rows.  A task holds one batch of outputs and their texts.
    """
    marks = checked(sentinels)
    rest = transformed.drop("restored", "restored_sha256")
    names = [*rest.columns, "restored", "restored_sha256"]
    at_output, at_form = names.index("output"), names.index("form")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = batch.column(at_form).to_pylist()
            for lo, hi, data, offsets in slices(batch.column(at_output)):
                bounds, texts, digests = offsets.tolist(), [], []
                for k in range(hi - lo):
                    raw = data[bounds[k]:bounds[k + 1]].tobytes()
                    pieces = disarrange(raw, forms[lo + k] or "plain", marks)
                    texts.append(written(pieces, (memoryview(raw),)))
                    digests.append(digest(pieces, (memoryview(raw),)))
                added = [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(digests, pa.string())]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=names)

    schema = rest.withColumn("restored", F.lit("")).withColumn("restored_sha256", F.lit("")).schema
    return rest.mapInArrow(make, schema)
