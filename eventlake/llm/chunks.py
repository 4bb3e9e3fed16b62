"""Distinct-chunk table: each distinct piece of text is encoded once, ids are joined by position."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once, and chunks kept; both bound memory, neither changes results.
SLICE, KEPT = 1 << 20, 100_000

#: White space by any Unicode table, twice in a row.
_WHITE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_BEFORE_BLANK = re.compile(r"(?<=\S)(?= )")
_BEFORE_MARK = re.compile("(?<![ ▁])(?= )")
_CUT = "\x01"


class Ids:
    """Ids of numbered chunks, one after the other."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.flat, self.lengths = flat, lengths
        self.start = np.cumsum(lengths) - lengths

    @classmethod
    def of(cls, lists: list[list[int]]) -> Ids:
        lengths = np.array([len(x) for x in lists], dtype=np.int64)
        return cls(np.fromiter(chain.from_iterable(lists), dtype=np.uint32, count=int(lengths.sum())), lengths)

    @classmethod
    def joined(cls, parts: list[Ids]) -> Ids:
        if not parts:
            return cls.of([])
        return cls(np.concatenate([x.flat for x in parts]), np.concatenate([x.lengths for x in parts]))

    def reordered(self, order: np.ndarray) -> Ids:
        return Ids(self.gather(order), self.lengths[order])

    def upto(self, n: int) -> Ids:
        return Ids(self.flat[: int(self.lengths[:n].sum())], self.lengths[:n])

    def gather(self, code: np.ndarray) -> np.ndarray:
        length = self.lengths[code]
        end = np.cumsum(length)
        first = self.start[code] - (end - length)
        return self.flat[np.repeat(first, length) + np.arange(end[-1] if len(end) else 0)]


class ChunkTable:
    """The first distinct chunks, mostly the frequent ones, stay; others are encoded once for
    each slice of text that has them."""

    def __init__(self, encode: Callable[[list[str]], Ids], kept: int | None = None) -> None:
        self.encode, self.kept = encode, KEPT if kept is None else kept
        self.codes: dict[str, int] = {}
        self.known = Ids.of([])

    def ids(self, documents: pa.ListArray) -> Iterator[np.ndarray]:
        """The ids of each document, given as its chunks in order."""
        coded = documents.flatten().dictionary_encode()
        chunks = coded.dictionary.to_pylist()
        base = len(self.codes)
        code = np.fromiter(map(self.codes.get, chunks, repeat(-1)), dtype=np.int64, count=len(chunks))
        missing = np.flatnonzero(code < 0)
        new = [chunks[i] for i in missing]
        every = Ids.joined([self.known, self.encode(new)]) if new else self.known
        code[missing] = np.arange(base, base + len(new))
        each = code[coded.indices.to_numpy()] if len(coded) else np.empty(0, dtype=np.int64)
        ids = every.gather(each)
        ends = np.concatenate([[0], np.cumsum(every.lengths[each])])[documents.offsets.to_numpy() - documents.offsets[0].as_py()]
        for start, end in zip(ends[:-1], ends[1:], strict=True):
            yield ids[start:end]
        room = max(0, min(self.kept - base, len(new)))
        if room:
            self.codes.update(islice(zip(new, range(base, base + room), strict=False), room))
            self.known = every.upto(base + room)


def slices(texts: pa.Array, most: int | None = None) -> Iterator[pa.Array]:
    """A column in runs of about SLICE or so many bytes; a null text is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    run = np.cumsum(size) // (most or SLICE)
    cuts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]]) if len(run) else np.empty(0, int)
    for first, last in zip(cuts, np.append(cuts[1:], len(texts)), strict=True):
        yield texts.slice(first, last - first).cast(pa.string())


def blank_chunks(text: str) -> list[str]:
    """Cuts a text before each blank that follows something else than white space.

    A splitting pattern whose tokens hold white space only at their start, or hold nothing else,
    always has a boundary there, whatever Unicode tables it uses."""
    return [x for x in _BEFORE_BLANK.split(text) if x]


def blank_lists(texts: pa.Array) -> pa.ListArray:
    """The chunks of each text. Where white space never stands beside white space, also around
    line ends: one that stands alone is a token of its own."""
    odd = pc.or_(pc.match_substring_regex(texts, _WHITE + "{2}"), pc.match_substring(texts, _CUT))

    def cut(plain: pa.Array) -> pa.ListArray:
        plain = pc.replace_substring(plain, " ", f"{_CUT} ")
        return pc.split_pattern(pc.replace_substring(plain, "\n", f"{_CUT}\n{_CUT}"), _CUT)

    return _lists(texts, odd, cut, blank_chunks)


def marked_chunks(text: str) -> list[str]:
    """Cuts a text into marked words, each a run of blanks and what follows; the first blank of
    each, for which the encoder puts a marker of its own, is left out. A literal marker counts
    as a blank that cannot start a word."""
    return [x[1:] for x in _BEFORE_MARK.split(" " + text) if x] if text else []


def marked_lists(texts: pa.Array) -> pa.ListArray:
    """The marked words of each text."""
    odd = pc.or_(pc.match_substring_regex(texts, "^$|^ | $|  "), pc.match_substring(texts, "▁"))
    return _lists(texts, odd, lambda plain: pc.split_pattern(plain, " "), marked_chunks)


def _lists(
    texts: pa.Array, odd: pa.Array, cut: Callable[[pa.Array], pa.ListArray], cut_odd: Callable[[str], list[str]]
) -> pa.ListArray:
    """Chunks of all texts, of the odd ones one by one."""
    plain = cut(texts.filter(pc.invert(odd)))
    if not pc.any(odd).as_py():
        return plain
    rest = pa.array([cut_odd(x) for x in texts.filter(odd).to_pylist()], plain.type)
    where = odd.to_numpy(zero_copy_only=False)
    order = np.argsort(np.argsort(where, kind="stable"), kind="stable")
    return pa.concat_arrays([plain, rest]).take(pa.array(order))
