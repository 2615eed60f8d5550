"""Tokens of two public tokenizer files over the same bytes: groups in which both end together, and overlapping pairs.

Texts are cut into units at spaces that follow a visible character.  No token of either file reaches over such a
place, so a unit's tokens, groups and pairs do not depend on the text around it and are found once for a batch.
"""

from __future__ import annotations

import hashlib
import json
import os
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np

from .flat import mix, range_hashes, span_hashes

WORD_MARK = "▁"
REMEMBERED_UNITS = 300_000
LONGEST_REMEMBERED = 64


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level models write for bytes: visible ones stand for themselves, the others follow 255."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in visible}
    for k, b in enumerate(sorted(set(range(256)) - set(visible))):
        letters[chr(256 + k)] = b
    return letters


def _after_visible(data: np.ndarray) -> np.ndarray:
    """For each byte but the first whether the character before it is surely not white space of any kind."""
    seen = data[:-1] > 0x20
    p1 = data[:-1]
    p2 = np.r_[np.zeros(1, np.uint8), p1[:-1]][:len(p1)]
    p3 = np.r_[np.zeros(1, np.uint8), p2[:-1]][:len(p1)]
    # White space beyond ASCII: U+0085, 00A0, 1680, 2000-200A, 2028, 2029, 202F, 205F, 3000.
    wide = (p2 == 0xC2) & ((p1 == 0x85) | (p1 == 0xA0))
    wide |= (p3 == 0xE2) & (p2 == 0x80) & ((p1 <= 0x8A) | (p1 == 0xA8) | (p1 == 0xA9) | (p1 == 0xAF))
    wide |= (p3 == 0xE2) & (p2 == 0x81) & (p1 == 0x9F)
    wide |= ((p3 == 0xE1) & (p2 == 0x9A) | (p3 == 0xE3) & (p2 == 0x80)) & (p1 == 0x80)
    return seen & ~wide & (p1 != 0x7F)


class Aligned(NamedTuple):
    """Per text counts and the digest of its groups; per overlapping pair its code (text order)."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    pairs: np.ndarray
    pair_text: np.ndarray


def _gathered(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches ``starts, sizes`` of a pool one after the other."""
    ends = np.cumsum(sizes)
    return pool[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]


class _Side:
    """One tokenizer's token bytes, and the ids of the units seen so far."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.dtype = np.uint16 if len(tokens) <= 1 << 16 else np.uint32
        self.clear()

    def clear(self) -> None:
        self.pool, self.unit_starts, self.unit_sizes = np.zeros(0, self.dtype), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.unit_starts = np.concatenate((self.unit_starts, len(self.pool) + np.cumsum(sizes) - sizes))
        self.unit_sizes = np.concatenate((self.unit_sizes, sizes))
        self.pool = np.concatenate((self.pool, ids.astype(self.dtype)))

    def gives_back(self, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For each unit whether its tokens' bytes are the unit's."""
        owner = np.repeat(np.arange(len(counts)), counts)
        right = np.bincount(owner, self.sizes[ids], len(counts)).astype(np.int64) == lengths
        kept = ids[right[owner]]
        starts = np.cumsum(lengths) - lengths
        wrong = _gathered(self.data, self.starts[kept], self.sizes[kept]) != _gathered(data, starts[right], lengths[right])
        if wrong.any():
            where = np.repeat(np.flatnonzero(right), lengths[right])
            right[where[wrong]] = False
        return right


class Aligner:
    """Alignments of texts by a byte-level file of the tokenizers library (A) and a sentencepiece model (B).

    Strings of special tokens are plain text.  A pair of ids is one number, ``a * size_b + b``.
    """

    def __init__(self, path_a: str, path_b: str, remembered: int = REMEMBERED_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.library_a = Tokenizer.from_file(path_a)
        self.library_a.encode_special_tokens = True
        self.library_b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = _byte_letters()
        self.size_a, self.size_b = self.library_a.get_vocab_size(), self.library_b.get_piece_size()
        tokens = [self.library_a.id_to_token(i) or "" for i in range(self.size_a)]
        pieces = [self.library_b.id_to_piece(i) for i in range(self.size_b)]
        self.a = _Side([bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in tokens])
        self.b = _Side([bytes([int(p[3:5], 16)]) if self.library_b.is_byte(i) else p.replace(WORD_MARK, " ").encode() for i, p in enumerate(pieces)])
        with open(path_a, encoding="utf-8") as file:
            made = json.load(file)
        cut = made.get("pre_tokenizer") or {}
        self.by_units = (
            not made.get("normalizer") and cut.get("type") == "ByteLevel" and bool(cut.get("use_regex")) and not cut.get("add_prefix_space")
            and not any(WORD_MARK in p.lstrip(WORD_MARK) for p in pieces)
        )
        self.remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.exact = np.zeros(0, bool)
        self.a.clear(), self.b.clear()

    def _learn(self, units: list[bytes]) -> np.ndarray:
        """Encode units that each begin with a space; their numbers.  Units that are not given back keep no tokens."""
        texts = [u.decode() for u in units]
        data, lengths = np.frombuffer(b"".join(units), np.uint8), np.fromiter(map(len, units), np.int64, len(units))
        found = [e.ids for e in self.library_a.encode_batch_fast(texts, add_special_tokens=False)], self.library_b.encode([t[1:] for t in texts], num_threads=1)
        counts = [np.fromiter(map(len, ids), np.int64, len(ids)) for ids in found]
        flat = [np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())) for ids, n in zip(found, counts)]
        right = np.ones(len(units), bool)
        for side, ids, n in zip((self.a, self.b), flat, counts):
            right &= side.gives_back(ids, n, data, lengths)
        for side, ids, n in zip((self.a, self.b), flat, counts):
            side.add(ids[np.repeat(right, n)], np.where(right, n, 0))
        self.exact = np.concatenate((self.exact, right))
        return np.arange(len(self.exact) - len(units), len(self.exact))

    def _numbers(self, units: list[bytes]) -> np.ndarray:
        """The number of each of some different units."""
        if len(self.exact) > self.remembered:
            self._forget()
        new = [u for u in units if u not in self.known]
        added = {}
        if new:
            added = dict(zip(new, self._learn(new).tolist()))
            self.known.update((u, k) for u, k in added.items() if len(u) <= LONGEST_REMEMBERED)
        known = self.known
        return np.fromiter((known[u] if u in known else added[u] for u in units), np.int64, len(units))

    def align(self, data: np.ndarray, offsets: np.ndarray) -> Aligned:
        """The alignment of consecutive texts, given as bytes and offsets.

        A text that is empty, or of which one of the two files does not give back the bytes, has no tokens.
        """
        count, sizes = len(offsets) - 1, np.diff(offsets)
        padded = np.full(len(data) + count, 0x20, np.uint8)
        padded[np.arange(len(data)) + np.repeat(np.arange(1, count + 1), sizes)] = data
        starts = offsets + np.arange(count + 1)
        raw = padded.tobytes()
        begins = np.zeros(len(padded), bool)
        if self.by_units and len(padded):
            begins[1:] = (padded[1:] == 0x20) & _after_visible(padded)
        begins[starts[:-1]] = True
        first = np.flatnonzero(begins)
        end = np.r_[first[1:], len(padded)].astype(np.int64)
        owner = np.searchsorted(starts, first, "right") - 1
        full = sizes[owner] > 0
        first, end, owner = first[full], end[full], owner[full]
        _, at, which = np.unique(span_hashes(padded, first, end), return_index=True, return_inverse=True)
        units = self._numbers([raw[a:b] for a, b in zip(first[at].tolist(), end[at].tolist())])[which]
        inexact = np.bincount(owner, ~self.exact[units], count) > 0
        if self.by_units and inexact.any():
            # Bytes may be lost at one place and won at another, so such a text is encoded whole.
            odd = np.flatnonzero(inexact)
            live = ~inexact[owner]
            units = np.concatenate((units[live], self._learn([raw[starts[k]:starts[k + 1]] for k in odd.tolist()])))
            owner = np.concatenate((owner[live], odd))
            order = np.argsort(owner, kind="stable")
            units, owner = units[order], owner[order]
        return self._meet(units, owner, count)

    def _meet(self, units: np.ndarray, owner: np.ndarray, count: int) -> Aligned:
        ids_a, ids_b = (_gathered(s.pool, s.unit_starts[units], s.unit_sizes[units]).astype(np.int64) for s in (self.a, self.b))
        text_a, text_b = (np.repeat(owner, s.unit_sizes[units]) for s in (self.a, self.b))
        # Both sides of a unit have its length, so ends over all texts one after the other can be compared.
        ends_a, ends_b = np.cumsum(self.a.sizes[ids_a]), np.cumsum(self.b.sizes[ids_b])
        common = np.zeros(int(ends_a[-1]) + 1 if len(ends_a) else 1, np.uint8)
        common[ends_a] += 1
        common[ends_b] += 1
        ends = np.flatnonzero(common)
        joint = common[ends] == 2
        # The stretch before each end lies in one token of either side: that many have ended before it.
        ended_a, ended_b = np.zeros(len(common), bool), np.zeros(len(common), bool)
        ended_a[ends_a], ended_b[ends_b] = True, True
        ended_a, ended_b = ended_a[ends], ended_b[ends]
        at_a, at_b = np.cumsum(ended_a) - ended_a, np.cumsum(ended_b) - ended_b
        pairs = ids_a[at_a] * self.size_b + ids_b[at_b]
        pair_text = text_a[at_a]
        high_a, high_b = at_a[joint] + 1, at_b[joint] + 1
        low_a, low_b = np.r_[0, high_a[:-1]], np.r_[0, high_b[:-1]]
        group_text = pair_text[joint]
        # Different groups are few: each is written once.
        hashes = mix(range_hashes(mix(ids_a.astype(np.uint64)), low_a, high_a) + np.uint64(1)) + range_hashes(mix(ids_b.astype(np.uint64)), low_b, high_b)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        shown = np.array([
            f"{','.join(map(str, ids_a[a:b].tolist()))}|{','.join(map(str, ids_b[c:d].tolist()))}".encode()
            for a, b, c, d in zip(low_a[first].tolist(), high_a[first].tolist(), low_b[first].tolist(), high_b[first].tolist())
        ] + [b""], object)[which].tolist() if len(which) else []
        cuts = np.searchsorted(group_text, np.arange(count + 1)).tolist()
        groups = [hashlib.sha256(b";".join(shown[a:b])).hexdigest() if b > a else "" for a, b in zip(cuts[:-1], cuts[1:])]
        n_a, n_b, n_groups, n_links = (np.bincount(t, minlength=count) for t in (text_a, text_b, group_text, pair_text))
        return Aligned(n_a, n_b, n_groups, n_links, groups, pairs, pair_text)


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner for each Python worker."""
    return Aligner(path_a, path_b)
