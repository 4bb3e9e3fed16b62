import random
import re

import pytest
from pyspark.sql import functions as F

from eventlake.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SCHEMA = "doc_id long, text string, spans string, _pii_email string"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        twice = int(c) * (2 if i % 2 else 1)
        total += twice - 9 if twice > 9 else twice
    return total % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 8 <= len(digits) <= 15


def plain(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in PLAIN.items()
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group())
    ]


BITS = ["a@b.c", "_d@e.f", "@", ".", "..", "1.2.3.4", "999.1.1.1", "10.0.0.256", "00255.1.1.1", "4111 1111 1111 1111", "é", "𝔘",
        "4111-1111-1111-1111 2", "5105105105105100", "+1 (132) 555-1352", "+123", "+", " ", "\n", "x", "9", "-", "%", "1.1.1.1.1"]


def rows():
    rng = random.Random(7)
    made = ["".join(rng.choices(BITS, k=rng.randint(0, 40))) for _ in range(1500)]
    long_ = ["1" * 20000, "a" * 20000 + "@b" + ".c" * 9000, "a@b.cc " * 2000, "1 " * 3000, "+" + "1 " * 4000, "a" * 200_000]
    return [(i, t, "x", "y") for i, t in enumerate([*made, *long_, None, "", "", None])]


def found(spark, table):
    weights = pii.fitted(table)
    base = F.filter("spans", lambda x: x["base"])
    out = pii.with_spans(table, weights).withColumn("b", pii.joined(base)).withColumn("a", pii.joined(F.col("spans")))
    return out.collect()


def test_base_spans_are_those_of_the_plain_patterns(spark):
    table = spark.createDataFrame(rows(), SCHEMA).repartition(4)
    got = found(spark, table)
    assert len(got) == len(rows())
    for r in got:
        assert r.b == ",".join(plain(r.text)), r.text
        assert r._pii_email == "y"


def test_added_spans(spark):
    texts = [
        "My name is James Smith and you can call 212-555-0147 or write to jane [at] mail [dot] org today",
        "ssn 123-45-6789 on file",
        "order 000-00-0000 and model part 111-111-1111 serial",
        "plain words of no interest at all, 12 of them",
    ]
    data = [(i, texts[i % 4] + " x" * (i % 5), "", "") for i in range(80)]
    got = {r.doc_id: r for r in found(spark, spark.createDataFrame(data, SCHEMA))}
    kinds = {k: {s.kind for s in got[k].spans} for k in range(4)}
    assert kinds == {0: {"person", "phone_local", "email_text"}, 1: {"ssn"}, 2: set(), 3: set()}
    for r in got.values():
        for s in r.spans:
            assert not s.base and s.start < s.end <= len(r.text)


def test_secrets_and_numbers(spark):
    hex_, mixed = "04dbebab91ab85687d33eeaaf9ac699e1188f962", "wJalrXUtnFEMI/K7MDENG+bPxRfiCYEX"
    texts = [
        f'token = "{hex_}" and API_KEY: {mixed}==, 𝔘',
        f"TOKEN = '{hex_.upper()}'",
        "aaaaaaaaaaaaaaa1 page 1111111111111111a donaudampfschifffahrtsgesellschaft",
        "ids 9807915762804490 and 1219538112535716",
        "a@b.cc, see http://example.com/some/long-path-of-words-2024/index7",
    ]
    data = [(i, texts[i % 5] + " x" * (i % 5), "", "") for i in range(100)]
    for r in found(spark, spark.createDataFrame(data, SCHEMA)):
        added = [(s.kind, r.text[s.start : s.end]) for s in r.spans if not s.base]
        want = {0: [("secret", hex_), ("secret", mixed + "==")], 1: [("secret", hex_.upper())]}
        assert added == want.get(r.doc_id % 5, []), r.text


def test_on_documents_that_were_not_seen(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    weights = pii.fitted(documents.where("doc_id % 2 = 0"))
    got = pii.with_spans(documents.where("doc_id % 2 = 1"), weights).collect()
    hits = 0
    for r in got:
        text = r.text or ""
        want = [m.span(1) for m in re.finditer('token = "([0-9a-f]{40})"', text, re.IGNORECASE)]
        assert [(s.start, s.end) for s in r.spans if s.kind == "secret"] == want, text
        assert want or all(s.base for s in r.spans), text
        hits += len(want)
    assert hits >= 3


def test_no_candidates_and_no_rows(spark):
    quiet = spark.createDataFrame([(1, "nothing", "", ""), (2, None, "", ""), (2, None, "", "")], SCHEMA)
    assert [r.a for r in found(spark, quiet)] == ["", "", ""]
    assert found(spark, quiet.limit(0)) == []


def test_expectation_maximisation_finds_the_reliable_labelers():
    rng = random.Random(1)
    counts = {}
    for _ in range(4000):
        truth = rng.random() < 0.3
        votes = tuple((1 if truth == (rng.random() < r) else -1) for r in (0.95, 0.9, 0.85, 0.5))
        counts[votes] = counts.get(votes, 0) + 1
    share, table, posterior = pii.reliabilities(sorted(counts.items()))
    assert share == pytest.approx(0.3, abs=0.05)
    right = [(t[1][1] + t[0][-1]) / 2 for t in table]
    assert right[:3] == pytest.approx([0.95, 0.9, 0.85], abs=0.04) and abs(right[3] - 0.5) < 0.06
    assert posterior[1, 1, 1, 1] > 0.95 and posterior[-1, -1, -1, 1] < 0.05


def test_redaction(spark):
    text = "mail a@b.c or +1 (132) 555-1352, 𝔘 1.2.3.4!"
    table = spark.createDataFrame([(1, text, "", ""), (2, "none", "", ""), (3, None, "", ""), (4, "", "", "")], SCHEMA)
    spanned = pii.with_spans(table, pii.fitted(table))
    got = {r.doc_id: r.t for r in spanned.select("doc_id", pii.redacted(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert got == {1: "mail [EMAIL] or [PHONE], 𝔘 [IP]!", 2: "none", 3: None, 4: ""}
