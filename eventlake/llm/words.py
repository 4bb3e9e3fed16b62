"""Words and word shingles of texts as 64-bit hashes, computed on whole columns of bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Odd, so that it has an inverse modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Bytes hashed at once; bounds the working memory whatever a batch holds.
SLICE = 1 << 20

#: Fixed values of the contract: bytes that separate words, and the ASCII capitals.
SEPARATORS = b" \t\n\x0b\x0c\r"
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[list(SEPARATORS)] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the whole word (an invertible finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Words:
    """Hashes the words of byte strings; keeps the tables of powers between calls."""

    def __init__(self, is_word: np.ndarray = IS_WORD) -> None:
        self.is_word = is_word
        self.up = self.down = np.empty(0, dtype=np.uint64)

    def hashes(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every word: runs of word bytes (other than ASCII blanks), A-Z lowered."""
        word = self.is_word[data]
        edge = np.diff(word.astype(np.int8), prepend=0, append=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(start):
            return start, np.empty(0, dtype=np.uint64)
        if len(self.up) < len(data) + 1:
            self.up, self.down = powers(BASE, len(data) + 1), powers(INVERSE, len(data) + 1)
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((LOWER[data].astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=total[1:])
        return start, mix((total[end] - total[start]) * self.down[start])


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k words; of all words as one run if there are fewer."""
    k = min(k, len(words))
    if not k:
        return words
    out = np.full(len(words) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        out = mix(out * BASE + words[i : len(words) - k + 1 + i])
    return out


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array without copying; a null text is empty."""
    texts = texts.cast(pa.large_string()) if texts.type != pa.large_string() else texts
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return offsets, np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, np.uint8)


def shingle_sets(texts: pa.Array, k: int):
    """Yields the sorted distinct shingle hashes of each text."""
    offsets, data = buffers(texts)
    words = Words()
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE, side="right")) - 1)
        last = min(last, len(texts))
        base = offsets[first]
        part = data[base : offsets[last]]
        cuts = offsets[first : last + 1] - base
        pieces = np.concatenate([[0], cuts[1:-1]]) if last - first > 1 else np.array([0])
        if last - first > 1:
            # a blank between texts, so that no word runs from one into the next
            part = np.insert(part, cuts[1:-1], 32)
            pieces = pieces + np.arange(len(pieces))
        start, hashed = words.hashes(part)
        at = np.searchsorted(start, np.append(pieces, len(part) + 1))
        for i in range(last - first):
            yield np.unique(shingles(hashed[at[i] : at[i + 1]], k))
        first = last
