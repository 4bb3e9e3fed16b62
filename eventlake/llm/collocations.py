"""Phrase collocations by stripes.

A stripe belongs to a prefix, a phrase of up to four words, and counts the words that follow it;
what is left of the empty prefix's occurrences is counted under no word. All numbers come from
this one structure: an entry is the count of its phrase, the empty prefix's total the number of
words, the highest entry of a stripe the most frequent extension to the right, and the highest one
of the stripes whose prefix begins with another word that to the left.

1. Words and pairs of words are counted by 64-bit hashes. A bitmap of fixed size marks the
   frequent ones; marks it has by chance only cost work.
2. Tasks fill stripes, run of text by run, for phrases whose words and pairs are all marked; any
   other phrase is rarer than asked for. Stripes travel entry by entry, summed before and after
   the shuffle, so neither a hot prefix nor a hot language meets in one task.
3. Frequent entries are candidates. As no phrase is more frequent than one inside it, a longer
   phrase that covers a candidate has an extension by one word within it that covers it too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.chunks import slices
from eventlake.llm.tables import freed, settle, stored
from eventlake.llm.words import BASE, LOWER, Words, buffers, mix

#: Fixed values of the contract: bytes that separate pieces and words, words of a phrase, least
#: count, share of the longer phrase in hundredths, rows of a language, name of no language.
BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
LONGEST, LEAST, SHARE, TOP, UNDETERMINED = 5, 100, 100, 2000, "und"
#: Bits of the bitmap: a constant, so that its 8 MB can be sent to every task.
BITS = 1 << 26
#: Bytes of text in a run, bytes hashed at once, words counted at once.
RUN, BLOCK, WORDS = 4 << 20, 1 << 20, 1 << 19

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(BREAKS + BLANKS)] = False
_IS_BREAK = np.zeros(256, dtype=bool)
_IS_BREAK[list(BREAKS)] = True
_BLANK, _BREAK = 32, 10


class Run:
    """The words of some texts in order, in lower case and each behind a blank: the bytes, where in
    them words begin and end, and each word's hash, piece and text."""

    def __init__(self, texts: pa.Array, hasher: Words) -> None:
        offsets, data = buffers(texts)
        data = np.insert(LOWER[data[offsets[0] : offsets[-1]]], offsets[1:] - offsets[0], _BREAK)
        gaps = np.flatnonzero(~_IS_WORD[data])
        starts, hashes, a = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], 0
        while a < len(data):
            # up to a gap, so that no word is cut; the last byte is one
            b = int(gaps[np.searchsorted(gaps, min(a + BLOCK, len(data) - 1))]) + 1
            start, hashed = hasher.hashes(data[a:b])
            starts.append(start + a)
            hashes.append(hashed)
            a = b
        start, self.hash = np.concatenate(starts), np.concatenate(hashes)
        size = gaps[np.searchsorted(gaps, start)] - start
        self.piece = np.searchsorted(np.flatnonzero(_IS_BREAK[data]), start)
        first = offsets[:-1] - offsets[0] + np.arange(len(texts))
        self.text = np.searchsorted(first, start, side="right") - 1
        self.end = np.cumsum(size + 1) - 1
        self.start = self.end - size
        word = _IS_WORD[data]
        data[~word] = _BLANK
        word[1:] |= word[:-1]
        self.data = data[word]

    def __len__(self) -> int:
        return len(self.hash)

    def strings(self, first: np.ndarray, last: np.ndarray) -> pa.Array:
        """The words from each first to each last one, with single blanks."""
        size = self.end[last] - self.start[first]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.start[first] - (ends - size), size) + np.arange(total)
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        made = [None, pa.py_buffer(offsets), pa.py_buffer(self.data[at])]
        return pa.Array.from_buffers(pa.large_string(), len(first), made).cast(pa.string())


def _seeds(langs: list[str]) -> np.ndarray:
    known = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(langs)}
    return np.array([known[x] for x in langs], dtype=np.uint64)


class _Window:
    """Some words of a run, with those after them that their phrases reach: keys of the words and
    of the pairs they begin, and whether a pair lies in one piece."""

    def __init__(self, run: Run, seeds: np.ndarray, first: int, reach: int) -> None:
        self.n = min(WORDS, len(run) - first)
        part = slice(first, first + self.n + reach)
        self.hash = run.hash[part]
        self.word = mix(self.hash ^ seeds[run.text[part]])
        self.pair = longer(self.word[:-1], self.hash[1:])
        self.joined = run.piece[part][1:] == run.piece[part][:-1]


def longer(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Key of a phrase that goes on with a word."""
    return mix(key * BASE + word)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Run, list[str]]]:
    hasher = Words(_IS_WORD)
    for batch in batches:
        langs, at = batch.column("lang").to_pylist(), 0
        for texts in slices(batch.column("text"), RUN):
            yield Run(texts, hasher), langs[at : at + len(texts)]
            at += len(texts)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of words and pairs with their counts in a run."""
    for run, langs in _runs(batches):
        seeds = _seeds(langs)
        for first in range(0, len(run), WORDS):
            part = _Window(run, seeds, first, 1)
            pairs = part.pair[: part.n][part.joined[: part.n]]
            key, n = np.unique(np.concatenate([part.word[: part.n], pairs]), return_counts=True)
            columns = [pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n"])


def frequent(rows: DataFrame, least: int) -> np.ndarray:
    """A bitmap of the keys of words and pairs that occur at least so often."""
    counts = rows.mapInArrow(freed(_counted), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    place = F.pmod("key", F.lit(BITS)) + 1
    marks = counts.where(F.col("n") >= least).groupBy(F.bitmap_bucket_number(place).alias("bucket"))
    size = 8 * 4096
    out = np.zeros(BITS // 8, dtype=np.uint8)
    # at most BITS / size rows, whatever the counts
    for bucket, bits in marks.agg(F.bitmap_construct_agg(F.bitmap_bit_position(place))).collect():
        at = (bucket - 1) * size // 8
        out[at : at + size // 8] = np.frombuffer(bits, dtype=np.uint8)
    return out


def _marked(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = key & np.uint64(BITS - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _filled(bits: np.ndarray, longest: int) -> Callable:
    """Entries of the stripes of every run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text, langs in _runs(batches):
            seeds, names = _seeds(langs), pa.array(langs, pa.string())
            for first in range(0, len(text), WORDS):
                yield from entries(text, seeds, names, first)

    def entries(text: Run, seeds: np.ndarray, names: pa.Array, first: int) -> Iterator[pa.RecordBatch]:
        part = _Window(text, seeds, first, longest - 1)
        known = _marked(bits, part.word)
        joined = part.joined & known[1:] & known[:-1]
        joined[joined] = _marked(bits, part.pair[joined])
        other = text.text[first : first + part.n][~known[: part.n]]
        if len(other):
            owner, n = np.unique(other, return_counts=True)
            blank = pa.array([""] * len(owner), pa.string())
            yield _entries(names.take(pa.array(owner)), blank, blank, n)
        at = np.flatnonzero(known[: part.n])
        key = part.word[at]
        for k in range(1, longest + 1):
            if k > 1:
                keep = np.flatnonzero(at + k - 2 < len(joined))
                keep = keep[joined[at[keep] + k - 2]]
                at = at[keep]
                key = longer(key[keep], part.hash[at + k - 1])
            if not len(at):
                return
            _, one, n = np.unique(key, return_index=True, return_counts=True)
            head = first + at[one]
            last = head + k - 1
            prefix = text.strings(head, last - 1) if k > 1 else pa.array([""] * len(head), pa.string())
            lang = names.take(pa.array(text.text[head]))
            yield _entries(lang, prefix, text.strings(last, last), n)

    return run


def _entries(lang: pa.Array, prefix: pa.Array, following: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    columns = [lang, prefix, following, pa.array(n.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["lang", "prefix", "next", "n"])


def stripes(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    undetermined: str = UNDETERMINED,
) -> DataFrame:
    """(lang, prefix, next, n): the stripe entries of at least `least` occurrences, and all of the
    empty prefix, whose words sum up to the language's. The empty next word stands for those that
    are counted under no word.

    A null text is empty, a null language is that of no language. Repeated rows count as often as
    they occur. An empty table gives no rows. Other columns are not looked at."""
    settle(documents.sparkSession)
    rows = documents.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(undetermined)).alias("lang"), F.col(text).alias("text")
    ).where("text <> ''")
    found = rows.mapInArrow(freed(_filled(frequent(rows, least), longest)), "lang string, prefix string, next string, n long")
    merged = found.groupBy("lang", "prefix", "next").agg(F.sum("n").alias("n"))
    return stored(merged.where((F.col("prefix") == "") | (F.col("n") >= least)), "stripes")


def collocations(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    share: int = SHARE,
    top: int = TOP,
    undetermined: str = UNDETERMINED,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): of each language the phrases of two words or more
    with the highest scores, ties to the higher count, then to the phrase that sorts first.

    a, l, r and n count the phrase, its two parts at the cut with the lowest score (the first of
    equal ones), and all words; score is floor(1000 a n / (l r)), in exact decimals as long as n is
    below 10^16. A phrase goes if a longer candidate holds it and has `share` hundredths of its
    count or more. For null and empty input see `stripes`."""
    found = stripes(documents, text, lang, longest, least, undetermined)
    words = found.where("prefix = ''").groupBy("lang").agg(F.sum("n").alias("n"))
    entries = found.where((F.col("next") != "") & (F.col("n") >= least))
    phrase = F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))
    phrases = stored(entries.select("lang", "prefix", phrase.alias("phrase"), F.col("n").alias("a")), "phrases")
    pairs = phrases.where("prefix <> ''")

    # each phrase is an extension of its prefix, and of what follows its first word
    after = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    covers = pairs.select("lang", F.explode(F.array("prefix", after)).alias("phrase"), "a")
    covers = covers.groupBy("lang", "phrase").agg(F.max("a").alias("cover"))
    kept = pairs.drop("prefix").join(covers, ["lang", "phrase"], "left")
    kept = kept.where(F.col("cover").isNull() | (100 * F.col("cover") < share * F.col("a")))

    parts = kept.select("lang", "phrase", "a", F.split("phrase", " ").alias("w"))
    cuts = parts.withColumn("k", F.explode(F.expr("sequence(1, size(w) - 1)")))
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice("w", 1, F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("rest"),
    )
    first = phrases.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    rest = phrases.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    known = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).join(words, "lang")
    score = F.expr(
        "(cast(a as decimal(16,0)) * cast(n as decimal(16,0)) * cast(1000 as decimal(4,0)))"
        " div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))"
    )
    lowest = known.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("x"))
    scored = lowest.select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
