"""Token counts of a unigram model by dynamic programming over a trie of the distinct words.

The words of a batch are walked in sorted order, which is the depth-first walk of their trie: the forward scores of a
prefix are computed once and shared by every word below it, and each word's end stores its number of tokens.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flat import slices, word_hashes

MARK = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 400_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> dict[str, float]:
    """Log-probabilities of the file's pieces by Zipf's law over their rank in the file; nothing is trained."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    total = math.log(sum(1 / (k + 2.7) for k in range(len(pieces))))
    return {p: -math.log(k + 2.7) - total for k, p in enumerate(pieces)}


class Forward:
    """Best score and token count of each prefix of the word at hand; the path of the trie walk."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.word, self.best, self.count = "", [0.0], [0]

    def step(self, word: str) -> tuple[int, float]:
        """Tokens and score of ``word``; only what it does not share with the word before is computed."""
        keep, old = 0, self.word
        for a, b in zip(old, word):
            if a != b:
                break
            keep += 1
        best, count, scores = self.best, self.count, self.scores
        del best[keep + 1:], count[keep + 1:]
        for end in range(keep + 1, len(word) + 1):
            top, tokens = -math.inf, 0
            for start in range(max(0, end - self.longest), end):
                s = scores.get(word[start:end])
                if s is not None and best[start] + s > top:
                    top, tokens = best[start] + s, count[start] + 1
            if word[end - 1] not in scores and best[end - 1] + self.unknown > top:
                # A character without a piece is spelled in bytes.
                top, tokens = best[end - 1] + self.unknown, count[end - 1] + len(word[end - 1].encode())
            best.append(top)
            count.append(tokens)
        self.word = word
        return count[-1], best[-1]


@lru_cache(maxsize=2)
def _state(path: str) -> tuple[dict[str, float], dict[bytes, tuple[int, float]]]:
    return vocabulary(path), {}


def token_counts(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """``doc_id, n_words, n_tokens, score`` per document.

    Needs ``doc_id, text``; other columns are ignored.  A word is ``[^\\x20\\x09-\\x0D]+`` with the word mark before
    it.  A null or empty text has no tokens and the score 0; repeated rows are counted each; an empty table gives no
    rows.  Of segmentations with one score, the one with the longer last piece counts.  No shuffle: each task holds
    the words of about 2 MB of text and at most ``REMEMBERED`` words of earlier batches.
    """
    path = model_path or default_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, seen = _state(path)
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text")):
                hashes, first, end, owner = word_hashes(data, offsets)
                _, at, which = np.unique(hashes, return_index=True, return_inverse=True)
                raw = data.tobytes()
                words = [raw[a:b] for a, b in zip(first[at].tolist(), end[at].tolist())]
                if len(seen) > REMEMBERED:
                    seen.clear()
                forward = Forward(scores)
                for word in sorted(MARK + w.decode() for w in words if w not in seen):
                    seen[word[1:].encode()] = forward.step(word)
                found = [seen[w] for w in words]
                tokens = np.array([f[0] for f in found], np.int64)[which] if found else np.zeros(0, np.int64)
                points = np.array([f[1] for f in found], float)[which] if found else np.zeros(0)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(lo, hi - lo), pa.array(np.bincount(owner, minlength=hi - lo).astype(np.int64)),
                    pa.array(np.bincount(owner, tokens, hi - lo).astype(np.int64)), pa.array(np.bincount(owner, points, hi - lo)),
                ], names=["doc_id", "n_words", "n_tokens", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "doc_id long, n_words long, n_tokens long, score double")
