import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventlake.llm import fill_middle
from eventlake.llm.fill_middle import gathered, restored, scattered, transformed


def plain(text, draws):
    """n, form, prefix_chars, middle_chars and output of a text."""
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(tokens)
    a, b = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or draws[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    form, output = ("spm", f"<S>{s}<P>{p}<M>{m}") if draws[3] % 100 < 20 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return n, form, len(p), len(m), output


def drawn(doc_id):
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


@pytest.mark.parametrize("block", [3, 64, 1 << 20])
def test_against_plain(monkeypatch, block):
    """Texts with every kind of byte, markers and parts of them, whatever the blocks."""
    monkeypatch.setattr(fill_middle, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(40):
        texts = [
            rng.choice([None, "", "<S>", "x<", "P>", "".join(rng.choice("ab<>PSM é漢😀 \n.") for _ in range(40))])
            for _ in range(rng.randrange(25))
        ]
        draws = np.array([[rng.randrange(1 << 32) for _ in range(4)] for _ in texts], dtype=np.int64).reshape(-1, 4)
        made = scattered(pa.array(texts, pa.string()), list(draws.T))
        assert list(zip(*(c.to_pylist() for c in made), strict=True)) == [
            plain(t, d) for t, d in zip(texts, draws.tolist(), strict=True)
        ]
        assert gathered(made[4], made[1]).to_pylist() == [t or "" for t in texts]


def test_outputs_not_of_their_form():
    outputs = ["abc", "<P>a<S>b<M>c", "<S>a<P>b<M>c", "<P>a<S>b", "", None, "a<P>b", "<P><S><M>", "<P>x<S>y<M>z<M>"]
    forms = ["psm", "psm", "spm", "psm", "psm", "spm", None, "psm", "psm"]
    want = [None, "acb", "bca", None, None, None, "a<P>b", "", None]
    assert gathered(pa.array(outputs), pa.array(forms)).to_pylist() == want


def test_rows(spark):
    """Null and repeated ids and texts, a very long text, other columns, those of the new names."""
    long = "word, " * 300_000
    rows = [(1, "a b"), (1, "a b"), (None, "x y z"), (None, None), (2, ""), (-7, long), (2**62, "Ünï <M> x"), (3, "a,b c")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("old"))
    table = table.withColumn("_draw0", F.col("text")).withColumn("FORM", F.lit(1)).repartition(3)
    found = restored(transformed(table))
    assert found.columns == ["doc_id", "text", "_draw0", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    got = sorted((tuple(r) for r in found.collect()), key=str)
    want = [(i, t, t, *plain(t, drawn(i)), t or "") for i, t in rows]
    assert got == sorted(want, key=str)


def test_all_forms_and_options(spark):
    table = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("ab cd ef gh").alias("text"))
    forms = {r.form: r["count"] for r in transformed(table).groupBy("form").count().collect()}
    assert forms["spm"] < forms["psm"] and 10 < forms["plain"] < 80
    every = transformed(table, plain_from=100, spm_below=100, salt="other")
    assert {r.form for r in every.select("form").distinct().collect()} == {"spm"}
    assert restored(every).where("restored <> text").count() == 0


def test_empty_table(spark):
    table = spark.createDataFrame([], "doc_id long, text string")
    assert restored(transformed(table)).collect() == []
