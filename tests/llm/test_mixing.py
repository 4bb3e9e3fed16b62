import hashlib
import math
import re

import pytest

from eventlake.llm import mixing
from eventlake.llm.mixing import mix

SCHEMA = "doc_id long, text string, source string, size string, n int"


def plain_targets(sizes):
    """Shares out the budget again and again until no source is above its bound."""
    ordered = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(ordered)}
    left, open_, target = 1.5 * sum(sizes.values()), set(ordered), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def plain(rows):
    docs = [(i, s, len(re.findall("[^\x20\x09-\x0d]+", t or "")), t or "") for i, t, s, *_ in rows]
    sizes = {}
    for _, s, n, _ in docs:
        sizes[s] = sizes.get(s, 0) + n
    targets = plain_targets(sizes)
    out = []
    for s, total in sizes.items():
        epochs = int(targets[s] // total) if total else 1
        rest, upto, keyed = targets[s] - epochs * total, 0, []
        for i, source, n, t in docs:
            if source == s:
                u = (int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
                plainly = sum(c not in mixing.SYMBOLS for c in t) / len(t) if t else 0
                keyed.append((-math.log(u) / max(plainly, mixing.LEAST), i, n))
        for _, i, n in sorted(keyed):
            upto += n
            out.append((i, n, total, targets[s], n * (epochs + (upto - n / 2 <= rest and rest > 0))))
    return sorted(out)


def found(table):
    return sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in mix(table).collect())


def made(n, sources):
    rows = []
    for i in range(n):
        h = int(hashlib.md5(str(i).encode()).hexdigest(), 16)
        # one source has a third of all rows
        source = sources[0] if h % 3 == 0 else sources[h // 3 % len(sources)]
        text = " \n".join(["word", "1#2", "é"][(h >> k) % 3] for k in range(h // 7 % 60))
        rows.append((i, None if i % 50 == 7 else text, source, "x", 0))
    return rows


@pytest.mark.parametrize("sources", [["a"], ["b", "a", None, "ä", "Z"], [f"s{i}" for i in range(40)]])
def test_agrees_with_brute_force(spark, monkeypatch, sources):
    monkeypatch.setattr(mixing, "RANGE", 16)
    rows = made(900, sources)
    got, want = found(spark.createDataFrame(rows, SCHEMA).repartition(5)), plain(rows)
    assert [x[:3] + x[4:] for x in got] == [x[:3] + x[4:] for x in want]
    assert all(a[3] == pytest.approx(b[3]) for a, b in zip(got, want, strict=True))


def test_taken_words_come_near_the_target(spark):
    rows = made(600, ["a", "b", "c", "d"])
    got = mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert got and all(r.taken <= 2 * r.size and r.copies in (0, 1, 2) for r in got)
    for s in "abcd":
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)


def test_reruns_agree_whatever_the_partitions(spark):
    table = spark.createDataFrame(made(300, ["a", "b"]), SCHEMA)
    assert found(table.repartition(2)) == found(table.repartition(7))


def test_odd_rows(spark):
    rows = [(1, None, None, "", 0), (2, "", "a", "", 0), (None, "one two", "a", "", 0), (3, "w " * 50_000, "b", "", 0), (4, "x y", "b", "", 0), (4, "x y", "b", "", 0)]
    got = mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in got)
    assert mix(spark.createDataFrame([], SCHEMA)).collect() == []
    nothing = [(1, None, "a", "", 0), (2, " ", "b", "", 0)]
    assert {(r.target, r.taken) for r in mix(spark.createDataFrame(nothing, SCHEMA)).collect()} == {(0.0, 0)}


def test_better_documents_are_drawn_more_often(spark):
    rows = [(i, "good words only here" if i % 2 else "# # # #", "a" if i < 2000 else "b", "", 0) for i in range(2400)]
    drawn = [r for r in mix(spark.createDataFrame(rows, SCHEMA)).collect() if r.source == "a"]
    best = max(r.copies for r in drawn)
    good, bad = (sum(r.copies == best for r in drawn if r.doc_id % 2 == x) for x in (1, 0))
    assert good > 1.5 * bad


def test_ranges_are_even_whatever_the_qualities(spark, monkeypatch):
    """A third of the texts empty, a third of the rows without an id, qualities far apart: no window
    holds more than three times what is aimed at."""
    monkeypatch.setattr(mixing, "RANGE", 64)
    rows = []
    for i in range(6000):
        text = "" if i % 3 == 0 else ["good words", "# 1 # 2", "a1b2 c3", "x" * (i % 90)][i % 4] + f" {i}"
        rows.append((None if i % 3 == 1 else i, text, "a" if i % 10 else "b", "", 0))
    sizes, whole = [], mixing.stored

    def kept(table, name="table"):
        out = whole(table, name)
        if name == "placed":
            sizes.extend(r["count"] for r in out.groupBy("group", "range").count().collect())
        return out

    monkeypatch.setattr(mixing, "stored", kept)
    got = mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows) and max(sizes) <= 3 * 64 and len(sizes) > 40
    for s in "ab":
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
