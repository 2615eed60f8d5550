"""Token ids of whole texts by a public tokenizer file, with a bounded memory of words already encoded."""

from __future__ import annotations

import gc
import json
import os
import re
import unicodedata
from functools import lru_cache

import numpy as np

from .flat import give_back, word_hashes

END_ID = 2
# Python takes these for white space and the tokenizers library does not; texts with them go to the library whole.
_UNLIKE = re.compile("[\x1c-\x1f]")
# Characters that byte-level models write as others.
_WRITTEN = re.compile(r"[^\n!-~]")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# 1: ASCII letters, 2: ASCII marks but the apostrophe.  A piece never spans both.
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[[c for c in (*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)) if c != 0x27]] = 2


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _ByteLetters(dict):
    """A character -> the letters that byte-level models write for its bytes."""

    def __missing__(self, code: int) -> str:
        from tokenizers.pre_tokenizers import ByteLevel

        self[code] = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(code))[0][0]
        return self[code]


class Encoder:
    """Ids of texts, as the tokenizers library gives them without special tokens added.

    Where the file normalises by NFC, white space and lower case and splits by a pattern into byte-level pieces
    (``default_path`` does), each different word is encoded once, from pieces that the library's model
    encodes; about ``remembered`` words are kept for the next batches, by their hashes.  Whole texts go to the library for any other file, and where a
    text holds a special token's string or a separator character.
    """

    def __init__(self, path: str, remembered: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.bits = max(1, (size - 1).bit_length())
        self.remembered, self.letters = remembered, _ByteLetters()
        self._forget()
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        self.special = [x["content"] for x in made.get("added_tokens") or []]
        steps = (made.get("normalizer") or {}).get("normalizers") or []
        cuts = (made.get("pre_tokenizer") or {}).get("pretokenizers") or []
        self.pieces = None
        if (
            [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and steps[1]["pattern"] == {"Regex": r"\s+"}
            and [c["type"] for c in cuts] == ["Split", "ByteLevel"] and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"]
            and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"] and made["model"]["type"] == "BPE"
        ):
            # White space as Unicode has it; Python's class also takes the separators 1C-1F.
            self.pieces = regex.compile(cuts[0]["pattern"]["Regex"].replace(r"[^\s", r"[^\t-\r\x85\p{Z}") + r"|\n")

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)

    def _learn(self, hashes: np.ndarray, words: list[bytes], plain: bool) -> None:
        """Encode new words and put their ids at the end of the pool; ``hashes`` stay ascending."""
        ids, sizes = self._words(words, plain)
        merged = np.concatenate((self.hashes, hashes))
        order = np.argsort(merged, kind="stable")
        self.hashes = merged[order]
        self.starts = np.concatenate((self.starts, len(self.pool) + np.cumsum(sizes) - sizes))[order]
        self.sizes = np.concatenate((self.sizes, sizes))[order]
        self.pool = np.concatenate((self.pool, ids))

    def _forget(self) -> None:
        self.hashes, self.starts, self.sizes, self.pool = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self.dtype)

    def _words(self, words: list[bytes], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one after the other, and how many each has."""
        text = b"\n".join(words).decode()
        if not plain and (_UNLIKE.search(text) or any(s in text for s in self.special)):
            parts = [self._whole(w.decode()) for w in words]
            return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        if not plain:
            text = unicodedata.normalize("NFC", text)
        # The library lowers each character alone, so a sigma at a word's end stays an ordinary one.
        pieces = self.pieces.findall(text.replace("Σ", "σ").lower())
        new = list(set(pieces).difference("\n"))
        tokenize, letters = self.model.tokenize, self.letters
        found = [tokenize(p.translate(letters)) for p in new] if _WRITTEN.search(text) else list(map(tokenize, new))
        own = np.fromiter(map(len, found), np.int64, len(found))
        pool = np.array([x.id for one in found for x in one], self.dtype)
        at = np.cumsum(own) - own
        known = dict(zip(new, range(len(new))))
        known["\n"] = -1
        index = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        word = np.cumsum(index < 0)[index >= 0]
        index = index[index >= 0]
        sizes = own[index]
        ends = np.cumsum(sizes)
        ids = pool[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(at[index] - (ends - sizes), sizes)]
        return ids, np.bincount(word, sizes, len(words)).astype(np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """The ids of consecutive texts, given as bytes and offsets, each with ``end_id`` after it; and the offsets of the ids."""
        raw = data.tobytes()
        texts = len(offsets) - 1
        if self.pieces is None:
            parts = [self._whole(raw[a:b].decode()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            owner = which = np.arange(texts)
            pool, sizes = np.concatenate([np.zeros(0, self.dtype), *parts]), np.array([len(p) for p in parts], np.int64)
            starts = np.cumsum(sizes) - sizes
        else:
            # Words are lowered and cut between letters and marks before they are told apart, where that is safe.
            cuts, text = None, raw.decode()
            low = _LOWER[data]
            lowered = low.tobytes()
            plain = not (_UNLIKE.search(text) or any(s in text for s in self.special)) and all(
                unicodedata.is_normalized("NFC", t) for t in (text, lowered.decode()))
            if plain:
                kind = _KIND[data]
                cuts = np.flatnonzero(kind[1:] + kind[:-1] == 3) + 1
                data, raw = low, lowered
            hashes, first, end, owner = word_hashes(data, offsets, cuts)
            hashes, at, which = np.unique(hashes, return_index=True, return_inverse=True)
            if len(self.hashes) > self.remembered:
                self._forget()
            # A word's ids do not depend on its text, so words of earlier batches are found by their hashes.
            new = ~np.isin(hashes, self.hashes, assume_unique=True)
            if new.any():
                self._learn(hashes[new], [raw[a:b] for a, b in zip(first[at[new]].tolist(), end[at[new]].tolist())], plain)
            found = np.searchsorted(self.hashes, hashes)
            pool, starts, sizes = self.pool, self.starts[found], self.sizes[found]
        counts = sizes[which]
        ends = np.cumsum(counts)
        out_offsets = np.zeros(texts + 1, np.int64)
        out_offsets[1:] = np.cumsum(np.bincount(owner, counts, texts).astype(np.int64) + 1)
        out = np.full(int(out_offsets[-1]), end_id, self.dtype)
        if len(counts):
            steps = np.arange(int(ends[-1]), dtype=np.int64)
            put = steps.copy()
            put += np.repeat(owner, counts)
            steps += np.repeat(starts[which] - (ends - counts), counts)
            out[put] = pool[steps]
        return out, out_offsets


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each task of a Python worker; ``forget_encoders`` ends its life."""
    return Encoder(path)


def forget_encoders() -> None:
    """To be called at the end of a task: the next stage's tasks may need the memory for something else."""
    encoder.cache_clear()
    gc.collect()
    give_back()
