"""Fill-in-middle by displacement scatter.

A text is cut twice at boundaries of tokens (runs of ASCII letters, or single other code points)
into prefix, middle and suffix, which its output holds in another order behind markers. All bytes
of a run of texts move at once: the cuts are found by scanning the bytes; a difference array holds,
where a part begins, by how much its shift differs from that of the part before, so that a
cumulative sum gives every byte its shift and one scatter builds all outputs. Restoring finds the
markers in the outputs and gathers by the inverse shifts. Scans, sums and copies go block by block,
so a very long text costs little more memory than itself and its output.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from eventlake.llm.chunks import slices
from eventlake.llm.tables import free_names, settle
from eventlake.llm.words import buffers

#: Fixed values of the contract: markers, shares of forms in hundredths, salt of the draws.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM, SPM_BELOW, SALT = 90, 20, "1"
#: Markers of each form in the order of its output.
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
MARK = 3
#: Bytes scanned, summed and copied at once.
BLOCK = 1 << 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: Bytes that begin a code point.
_LEAD = (np.arange(256) & 0xC0) != 0x80

Mask = Callable[[int, int], np.ndarray]


def _blocks(n: int) -> Iterator[tuple[int, int]]:
    return ((a, min(n, a + BLOCK)) for a in range(0, n, BLOCK))


def _counted(mask: Mask, n: int, at: np.ndarray) -> np.ndarray:
    """How often the mask holds before each of the sorted positions."""
    out, total = np.zeros(len(at), dtype=np.int64), 0
    for a, b in _blocks(n):
        sums = np.concatenate([[0], np.cumsum(mask(a, b))])
        here = slice(*np.searchsorted(at, [a, b]))
        out[here] = total + sums[at[here] - a]
        total += int(sums[-1])
    out[np.searchsorted(at, n) :] = total
    return out


def _selected(mask: Mask, n: int, ranks: np.ndarray) -> np.ndarray:
    """Positions of the sorted ranks among those where the mask holds; n for higher ranks."""
    out, total = np.full(len(ranks), n, dtype=np.int64), 0
    for a, b in _blocks(n):
        where = np.flatnonzero(mask(a, b))
        here = slice(*np.searchsorted(ranks, [total, total + len(where)]))
        out[here] = where[ranks[here] - total] + a
        total += len(where)
    return out


def _shifts(n: int, at: np.ndarray, shift: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """For each block of n bytes, where every byte goes: it moves by the shift of the last of the
    sorted positions that is not behind it."""
    step, carry = np.diff(shift, prepend=0), 0
    for a, b in _blocks(n):
        here = slice(*np.searchsorted(at, [a, b]))
        change = np.zeros(b - a, dtype=np.int64)
        np.add.at(change, at[here] - a, step[here])
        moved = carry + np.cumsum(change)
        carry = int(moved[-1])
        yield a, b, moved + np.arange(a, b)


def _token_starts(data: np.ndarray, offsets: np.ndarray) -> Mask:
    first = offsets[:-1][np.diff(offsets) > 0]

    def mask(a: int, b: int) -> np.ndarray:
        letter = _LETTER[data[a:b]]
        before = np.concatenate([_LETTER[data[a - 1 : a]] if a else [False], letter[:-1]])
        found = _LEAD[data[a:b]] & ~(letter & before)
        found[first[slice(*np.searchsorted(first, [a, b]))] - a] = True
        return found

    return mask


def _marks(data: np.ndarray) -> np.ndarray:
    """Positions of all markers."""
    found = []
    for a, b in _blocks(len(data)):
        part = data[a : b + MARK - 1]
        n = len(part) - MARK + 1
        if n > 0:
            kind = part[1 : n + 1]
            named = np.logical_or.reduce([kind == m[1] for m in (PREFIX, SUFFIX, MIDDLE)])
            found.append(np.flatnonzero((part[:n] == PREFIX[0]) & (part[2 : n + 2] == PREFIX[2]) & named) + a)
    return np.concatenate(found) if found else np.empty(0, dtype=np.int64)


def _within(at: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The texts that hold markers at these positions, none of which reaches into a next text."""
    text = np.searchsorted(offsets, at, side="right") - 1
    return np.where(at + MARK <= offsets[text + 1], text, -1)


def _ends(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _texts(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    made = pa.Array.from_buffers(
        pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
    )
    return made.cast(pa.string())


def scattered(
    texts: pa.Array, draws: list[np.ndarray], plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW
) -> tuple[pa.Array, ...]:
    """Tokens, form, code points of prefix and middle, and output of every text, given its four
    drawn numbers."""
    offsets, data = buffers(texts)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    n = len(data)
    starts = _token_starts(data, offsets)
    base = _counted(starts, n, offsets)
    tokens = np.diff(base)
    one, two = draws[0] % (tokens + 1), draws[1] % (tokens + 1)
    ranks = np.stack([base[:-1] + np.minimum(one, two), base[:-1] + np.maximum(one, two)], axis=1)
    cuts = _selected(starts, n, ranks.reshape(-1)).reshape(-1, 2)

    marked = np.zeros(len(tokens) + 1, dtype=bool)
    marked[_within(_marks(data), offsets)] = True
    plain = (tokens == 0) | marked[:-1] | (draws[2] % 100 >= plain_from)
    spm = ~plain & (draws[3] % 100 < spm_below)

    at = np.stack([offsets[:-1], cuts[:, 0], cuts[:, 1]], axis=1)
    size = np.diff(np.column_stack([at, offsets[1:]]), axis=1)
    out = _ends(np.diff(offsets) + np.where(plain, 0, 3 * MARK))
    to = _places(out[:-1], size, plain, spm)
    built = np.empty(int(out[-1]), dtype=np.uint8)
    for a, b, place in _shifts(n, at.reshape(-1), (to - at).reshape(-1)):
        built[place] = data[a:b]
    for form, chosen in (("psm", ~plain & ~spm), ("spm", spm)):
        parts = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
        for mark in ORDER[form]:
            first = to[chosen, parts[mark]] - MARK
            for i in range(MARK):
                built[first + i] = mark[i]
    chars = np.diff(_counted(lambda a, b: _LEAD[data[a:b]], n, np.append(at.reshape(-1), n)))
    chars = chars.reshape(-1, 3)
    form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
    return (
        pa.array(tokens.astype(np.int64)),
        pa.array(form.tolist(), pa.string()),
        pa.array(chars[:, 0].astype(np.int64), mask=plain),
        pa.array(chars[:, 1].astype(np.int64), mask=plain),
        _texts(built, out),
    )


def _places(first: np.ndarray, size: np.ndarray, plain: np.ndarray, spm: np.ndarray) -> np.ndarray:
    """Where prefix, middle and suffix of these sizes begin in outputs that begin here."""
    prefix, middle, suffix = size.T
    put = np.stack([first, first + prefix, first + prefix + middle], axis=1)
    psm = np.stack([first + MARK, first + 3 * MARK + prefix + suffix, first + 2 * MARK + prefix], axis=1)
    other = np.stack([first + 2 * MARK + suffix, first + 3 * MARK + suffix + prefix, first + MARK], axis=1)
    return np.where(plain[:, None], put, np.where(spm[:, None], other, psm))


def gathered(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    """The text of every output; null where an output is not of its form."""
    offsets, data = buffers(outputs)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    form = np.array([f if f in ORDER else "" for f in forms.to_pylist()], dtype=object)
    spm, plain = form == "spm", form == ""
    at = _marks(data)
    text = _within(at, offsets)
    keep = (text >= 0) & ~plain[text]
    at, text = at[keep], text[keep]
    whole = plain | (np.bincount(text, minlength=len(form))[: len(form)] == MARK)
    keep = whole[text]
    mark = np.zeros((len(form), 3), dtype=np.int64)
    mark[~plain & whole] = at[keep].reshape(-1, 3)
    kinds = data[np.minimum(mark + 1, max(0, len(data) - 1))] if len(data) else np.zeros_like(mark)
    want = np.array([[m[1] for m in ORDER["spm" if s else "psm"]] for s in spm], dtype=np.int64).reshape(-1, 3)
    whole &= plain | (kinds == want).all(axis=1)
    marked = whole & ~plain

    # prefix, middle and suffix in the output: where each begins and its size
    first = np.repeat(offsets[:-1, None], 3, axis=1)
    size = np.zeros_like(first)
    size[:, 0] = np.where(plain, np.diff(offsets), 0)
    ends = np.column_stack([mark[:, 1:], offsets[1:]])
    places = np.where(spm[:, None], [1, 2, 0], [0, 2, 1])
    first[marked] = np.take_along_axis(mark + MARK, places, axis=1)[marked]
    size[marked] = np.take_along_axis(ends - mark - MARK, places, axis=1)[marked]
    out = _ends(size.sum(axis=1))
    to = np.column_stack([out[:-1], out[:-1] + size[:, 0], out[:-1] + size[:, 0] + size[:, 1]])
    built = np.empty(int(out[-1]), dtype=np.uint8)
    for a, b, place in _shifts(len(built), to.reshape(-1), (first - to).reshape(-1)):
        built[a:b] = data[place]
    made = _texts(built, out)
    return made if whole.all() else pc.if_else(pa.array(whole), made, pa.scalar(None, pa.string()))


def _runs(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Rows with their texts in runs of bounded bytes; a null text is empty."""
    for batch in batches:
        at = 0
        for part in slices(batch.column(text)):
            yield batch.slice(at, len(part)), part
            at += len(part)


NAMES = ("n", "form", "prefix_chars", "middle_chars", "output")
_TYPES = (LongType(), StringType(), LongType(), LongType(), StringType())


def transformed(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    plain_from: int = PLAIN_FROM,
    spm_below: int = SPM_BELOW,
    salt: str = SALT,
) -> DataFrame:
    """Every row with five more columns: n (tokens), form (plain, psm or spm), prefix_chars and
    middle_chars (code points; null if plain) and output.

    Cuts and form are drawn from a hash of the doc_id, so rows that repeat an id and a text have
    equal outputs; rows without an id draw as if it were empty text. A null text is empty; an
    empty text, and one that holds a marker, is plain. Other columns stay; columns of the new
    names are replaced. An empty table gives an empty one."""
    kept = [c for c in documents.columns if c.lower() not in NAMES]
    names = free_names(documents, *(f"_draw{i}" for i in range(4)))
    key = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    digest = F.sha2(key, 256)
    draws = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(x) for i, x in enumerate(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _runs(batches, text):
            drawn = [rows.column(x).to_numpy(zero_copy_only=False) for x in names]
            made = scattered(texts, drawn, plain_from, spm_below)
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), *made], [*kept, *NAMES])

    settle(documents.sparkSession)
    rows = documents.select(*(F.col(f"`{c}`") for c in kept), *draws)
    fields = [documents.schema[c] for c in kept]
    added = [StructField(c, t) for c, t in zip(NAMES, _TYPES, strict=True)]
    return rows.mapInArrow(run, StructType(fields + added))


def restored(rows: DataFrame, output: str = "output", form: str = "form", text: str = "restored") -> DataFrame:
    """Every row with the text that its output and form give. A null output is empty; a null or
    unknown form is plain; an output without just the markers of its form, in order, gives null.
    Other columns stay; a column of the new name is replaced."""
    kept = [c for c in rows.columns if c.lower() != text.lower()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, outputs in _runs(batches, output):
            made = gathered(outputs, part.column(form))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), made], [*kept, text])

    settle(rows.sparkSession)
    fields = [rows.schema[c] for c in kept]
    return rows.select(*(F.col(f"`{c}`") for c in kept)).mapInArrow(
        run, StructType(fields + [StructField(text, StringType())])
    )
