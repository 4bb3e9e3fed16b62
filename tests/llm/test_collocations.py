import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from eventlake.llm import collocations as module
from eventlake.llm.collocations import Run, collocations, stripes
from eventlake.llm.words import Words

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_counts(rows, longest=5):
    counts, words = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            found = re.findall("[^\x20\x09]+", piece)
            words[lang] += len(found)
            for m in range(1, longest + 1):
                for i in range(len(found) - m + 1):
                    counts[lang, tuple(found[i : i + m])] += 1
    return counts, words


def plain(rows, longest=5, least=100, share=100, top=2000):
    counts, words = plain_counts(rows, longest)
    candidates = {key: n for key, n in counts.items() if len(key[1]) > 1 and n >= least}
    out = {}
    for (lang, phrase), a in candidates.items():
        m, n = len(phrase), words[lang]
        if any(
            x == lang and len(longer) > m and 100 * f >= share * a
            and any(longer[i : i + m] == phrase for i in range(len(longer) - m + 1))
            for (x, longer), f in candidates.items()
        ):
            continue
        cuts = []
        for k in range(1, m):
            left, right = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
            cuts.append((int(Fraction(1000 * a * n, left * right)), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), left, right, n))
    return sorted(
        (lang, rank + 1, p.decode(), -a, left, right, n, -score)
        for lang, found in out.items()
        for rank, (score, a, p, left, right, n) in enumerate(sorted(found)[:top])
    )


def mined(spark, rows, **options):
    table = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    return sorted(tuple(r) for r in collocations(table, **options).collect())


def texts(n, seed=5):
    """Skewed words with fixed phrases, odd blanks and breaks, several languages."""
    rng = random.Random(seed)
    words = ["the", "of", "The", "a", "é", "漢", "x" * 40, "b\xa0c", "--", "new", "york", "city"]
    phrases = ["new york city hall", "in spite of", "in spite of that", "The END"]
    blanks = [" "] * 8 + ["  ", "\t", " \t ", ", ", ".", "\n", "!?", "\x0b", "\r\n"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(60)):
            parts += [rng.choice(phrases) if rng.random() < 0.3 else words[int(rng.random() ** 2 * 12)], rng.choice(blanks)]
        rows.append(("".join(parts), rng.choice(["en", "en", "en", "de", None, "und", "é"])))
    return rows


@pytest.mark.parametrize("words, run, block", [(7, 1, 1), (1 << 19, 300, 64), (1 << 19, 4 << 20, 1 << 20)])
def test_entries_of_tasks(monkeypatch, words, run, block):
    """The same whatever is counted at once; every cut word or phrase would show."""
    monkeypatch.setattr(module, "WORDS", words)
    monkeypatch.setattr(module, "RUN", run)
    monkeypatch.setattr(module, "BLOCK", block)
    rows, least = [(t, "und" if x is None else x) for t, x in texts(200)], 20
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], ["text", "lang"])
    keys = Counter()
    for part in module._counted([batch]):
        keys.update(dict(zip(*(c.to_pylist() for c in part.columns), strict=True)))
    bits = np.zeros(module.BITS // 8, dtype=np.uint8)
    for key, n in keys.items():
        if n >= least:
            bits[(key % module.BITS) // 8] |= 1 << key % 8
    got = Counter()
    for part in module._filled(bits, 5)([batch]):
        for lang, prefix, following, n in zip(*(c.to_pylist() for c in part.columns), strict=True):
            got[lang, (*prefix.split(" "), following) if prefix else (following,)] += n
    counts, total = plain_counts(rows)
    assert {k: n for k, n in got.items() if n >= least and k[1] != ("",)} == {k: n for k, n in counts.items() if n >= least}
    assert {x: sum(n for (lang, p), n in got.items() if lang == x and len(p) == 1) for x in total} == total


def test_against_plain(spark):
    rows = texts(250)
    got = mined(spark, rows, least=20)
    assert got == plain(rows, least=20) and len(got) > 50


def test_options(spark):
    rows = texts(200, seed=8)
    for options in ({"least": 15, "longest": 3, "share": 60}, {"least": 10, "top": 4}, {"least": 30, "longest": 2}):
        assert mined(spark, rows, **options) == plain(rows, **options)


def test_full_bitmap_changes_nothing(spark, monkeypatch):
    """Marks by chance only cost work."""
    rows = texts(150)
    monkeypatch.setattr(module, "frequent", lambda rows, least: np.full(module.BITS // 8, 255, np.uint8))
    assert mined(spark, rows, least=20) == plain(rows, least=20)


def test_stripes_hold_all_numbers(spark):
    rows = texts(150)
    counts, words = plain_counts(rows)
    table = spark.createDataFrame(rows, "text string, lang string")
    found = stripes(table, least=25).collect()
    total = Counter()
    for r in found:
        if not r.prefix:
            total[r.lang] += r.n
        if r.next:
            assert counts[r.lang, (*r.prefix.split(" "), r.next) if r.prefix else (r.next,)] == r.n
    assert total == words
    assert sum(bool(r.next) and r.n >= 25 for r in found) == sum(n >= 25 for n in counts.values())


def test_long_words_and_runs():
    """A word longer than a block, texts that end in one, and a text of breaks only."""
    found = Run(pa.array(["a" * (3 << 20) + " B", "", None, ".;", "x\ty"]), Words(module._IS_WORD))
    assert [len(found), *found.text.tolist()] == [4, 0, 0, 4, 4]
    assert found.piece.tolist()[0] == found.piece.tolist()[1] != found.piece.tolist()[2]
    assert bytes(found.data[found.start[1] : found.end[3]]) == b"b x y"


def test_nulls_repeats_and_extra_columns(spark):
    rows = [("to be or not", "en")] * 120 + [(None, None), ("", "en"), ("to be", None)] * 3 + [("to be. To be", None)] * 60
    got = mined(spark, rows)
    assert got == plain(rows) and {r[0] for r in got} == {"en", "und"}
    table = spark.createDataFrame([(*r, 1, "p", "q") for r in rows], "text string, lang string, n int, prefix string, phrase string")
    assert sorted(tuple(r) for r in collocations(table).collect()) == got


def test_scores_past_64_bits(spark):
    """1000 a n and l r leave 64 bits; the score is exact."""
    entries = [("en", "", "a", 3 * 10**12), ("en", "", "b", 2 * 10**12), ("en", "", "", 10**15), ("en", "a", "b", 10**12 + 7)]
    table = spark.createDataFrame(entries, "lang string, prefix string, next string, n long")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(module, "stripes", lambda *args: table)
        (row,) = collocations(table).collect()
    n = 10**15 + 5 * 10**12
    assert (row.n, row.score) == (n, 1000 * (10**12 + 7) * n // (6 * 10**24))


def test_empty_table(spark):
    assert mined(spark, []) == [] and mined(spark, [(None, None), (" .", "en")]) == []
