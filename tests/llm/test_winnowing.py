import hashlib
import random

import numpy as np
import pytest
import xxhash

from eventlake.llm import winnowing as w

SCHEMA = "doc_id long, text string, bucket int"


def plain_marks(text, gram, window):
    hashes = w.gram_hashes(w.points(text), gram) >> np.uint64(32)
    window = max(1, min(window, len(hashes)))
    out = []
    for i in range(len(hashes) - window + 1):
        part = hashes[i : i + window]
        at = i + max(j for j in range(window) if part[j] == part.min())
        if not out or out[-1][1] != at:
            out.append((int(hashes[at]), at))
    return out


@pytest.mark.parametrize("text", ["", "a", "ab" * 40, "abcdefgh" * 9, "x" * 200, "é𝔘ß" * 33])
@pytest.mark.parametrize(("gram", "window"), [(1, 1), (3, 4), (5, 7), (24, 64)])
def test_marks(text, gram, window):
    assert [tuple(x) for x in w.marks(w.points(text), gram, window).tolist()] == plain_marks(text, gram, window)


def test_gram_hashes_depend_on_the_gram_alone():
    rng = random.Random(1)
    text = "".join(rng.choices("abc", k=300))
    for gram in (1, 2, 3, 7, 24):
        seen = {}
        for i, h in enumerate(w.gram_hashes(w.points(text), gram).tolist()):
            assert seen.setdefault(text[i : i + gram], h) == h
        assert len(set(seen.values())) == len(seen)


def test_a_long_enough_shared_passage_leaves_a_shared_mark():
    rng = random.Random(2)
    for _ in range(30):
        shared = "".join(rng.choices("abcdefgh ", k=w.GRAM + w.WINDOW - 1))
        a, b = ("".join(rng.choices("abcdefgh ", k=rng.randint(0, 300))) for _ in range(2))
        x, y = (w.marks(w.points(p + shared + q)) for p, q in ((a, b), (b, a)))
        common = set(x[:, 0].tolist()) & set(y[:, 0].tolist())
        # and the positions tell where
        assert any(
            p - len(a) == q - len(b)
            for h in common
            for p in x[x[:, 0] == h, 1].tolist()
            for q in y[y[:, 0] == h, 1].tolist()
        )


def test_written_and_read():
    for n in (0, 1, 20, 270, 3000):
        found = w.scaled(w.points(("some text that is long enough " * 100)[:n]))
        again = w.read(w.written(found))
        assert len(again) == len(found) and all(map(np.array_equal, again, found))


def hashed(text):
    """Spark's xxhash64 of a text."""
    value = xxhash.xxh64(text.encode(), seed=42).intdigest()
    return value - (1 << 64) if value >> 63 else value


def plain_rows(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashed(r[1] or ""), r[1] or ""))
    out = []
    for i, (name, text, _) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        third = len(text) // 3
        edit = text[: len(text) - third] + following[:third]
        a, b, c = (w.scaled(w.points(x)) for x in (text, edit, following))
        digest = hashlib.sha256(edit.encode()).hexdigest()
        out.append((name, len(text), digest, w.written(a), w.written(b), w.likeness(a, b), w.likeness(a, c)))
    return sorted(out, key=str)


def found(table):
    return sorted((tuple(r) for r in w.edit_likeness(table).collect()), key=str)


def odd_rows(n):
    rng = random.Random(3)
    rows = [(rng.randrange(10**12) - 10**11, "".join(rng.choices("abc déf𝔘", k=rng.choice([0, 1, 2, 50, 400]))), 1) for _ in range(n)]
    return rows


@pytest.mark.parametrize("n", [1, 2, 3, 200])
def test_edits_follow_the_descending_order(spark, n):
    rows = odd_rows(n)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(7)) == plain_rows(rows)


def test_null_texts_null_ids_and_repeated_rows(spark):
    rows = odd_rows(30)
    rows += [(5, None, 0), (5, "b" * 100, 0), (5, "b" * 100, 0), (None, "c" * 90, 0), (None, "d" * 90, None), (None, None, 0)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain_rows(rows)
    nulls = [(None, "c" * 90, 0), (None, "d" * 90, 1)]
    assert found(spark.createDataFrame(nulls, SCHEMA)) == plain_rows(nulls)


def test_empty_table_and_plain_fingerprints(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    rows = [(1, "same text " * 20, 0), (2, "same text " * 20, 0), (3, None, 0), (4, "", 0)]
    got = {r.doc_id: r.fingerprint for r in w.fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1] == got[2] != "" and got[3] == got[4] == ""


def test_a_very_long_text():
    text = "".join(random.Random(4).choices("abcdef", k=2_000_000))
    assert w.likeness(w.scaled(w.points(text)), w.scaled(w.points(text[: len(text) * 9 // 10]))) > 0.85


LETTERS = "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@pytest.mark.parametrize("following", ["", "x", "a text that is short", "another text that has nothing in it of the first " * 9])
def test_edits_keep_likeness_at_every_length(following):
    """What keeps two thirds is never below 0.3, what keeps all but one code point never below 0.8."""
    rng = random.Random(5)
    for n in [*range(20, 401), *range(980, 1021)]:
        for _ in range(4):
            text = "".join(rng.choices(LETTERS, k=n))
            own, changed, more = (w.scaled(w.points(x)) for x in (text, w.edited(text, following), text + "x"))
            assert w.likeness(own, changed) >= 0.3, n
            assert w.likeness(own, more) >= 0.8 and w.likeness(own, own) == 1, n


def test_scales_of_short_texts():
    text = "".join(random.Random(6).choices("abcdefghijkl ", k=1200))
    coarse, middle, fine = [24, 64], [8, 16], [2, 1]
    for n, scales in ((1000, [coarse]), (999, [coarse, middle]), (260, [coarse, middle]), (259, [coarse, middle, fine]),
                      (23, [None, middle, fine]), (7, [None, None, fine]), (1, [None, None, fine])):
        want = [plain_marks(text[:n], *x) if x else [] for x in scales]
        assert [list(map(tuple, x.tolist())) for x in w.scaled(w.points(text[:n]))] == want
    assert [len(x) for x in w.scaled(w.points(""))] == [0, 0, 0]


@pytest.mark.parametrize("batch", [3, 10_000])
def test_ids_of_63_bits_null_ids_and_repeated_ids(spark, batch):
    """Every row meets its true neighbour, also beyond 2**53, and beside nulls in its batch."""
    rng = random.Random(7)
    rows = [(rng.randrange(2**63), f"text {i} " * rng.randrange(1, 9), 0) for i in range(500)]
    rows += [(None, f"no id {rng.randrange(200)}", 0) for _ in range(250)] + [(2**62, f"hot {i}", 0) for i in range(250)]
    rows += [(-(2**63), "least", 0), (2**63 - 1, "most", 0)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert found(spark.createDataFrame(rows, SCHEMA).repartition(3)) == plain_rows(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_buckets_are_even(spark):
    """A third of the rows without an id, a third under one id."""
    rng = random.Random(8)
    rows = [(rng.randrange(2**63), "x", 0) for _ in range(4000)] + [(None, f"n {i}", 0) for i in range(4000)] + [(77, f"h {i}", 0) for i in range(4000)]
    table = spark.createDataFrame(rows, SCHEMA).select("doc_id", "text")
    sizes = sorted(r["count"] for r in w._neighbour_buckets(table).groupBy("bucket").count().collect())
    assert sizes[-1] <= 3 * sizes[len(sizes) // 2] and len(sizes) >= 20
