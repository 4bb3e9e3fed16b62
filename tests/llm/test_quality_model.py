import zlib

import numpy as np
import pyarrow as pa
import pytest

from eventlake.llm import quality_model as q

SF = "/root/testdata/sf0.01"


def scored(model, texts):
    data = [x.encode() for x in texts]
    offsets = np.cumsum([0, *[len(x) for x in data]])
    return model.score(offsets, np.frombuffer(b"".join(data), np.uint8))


def plain_score(model, text):
    """One window, one chunk at a time."""
    v, data = model.values, text.encode()
    half = q.CHUNK // 2
    pieces = max(2, -(-(len(data) + q.WIDTH - q.STRIDE) // half))
    data = np.frombuffer(data.ljust(pieces * half, b"\0"), np.uint8)
    logits = []
    for chunk in range(pieces - 1):
        best = np.full(q.FILTERS, -np.inf)
        for at in range(chunk * half, (chunk + 2) * half, q.STRIDE):
            if at + q.WIDTH <= len(data):
                best = np.maximum(best, v["bytes"][data[at : at + q.WIDTH]].reshape(-1) @ v["filters"])
        hidden = np.tanh(np.maximum(best + v["shift"], 0) @ v["hidden"] + v["bias"])
        logits.append((hidden @ v["out"] + v["prior"])[0])
    return 1 / (1 + np.exp(-np.mean(logits)))


def test_score_is_that_of_the_plain_network():
    model = q.Network(3)
    texts = ["", "a", "short text", "x y z " * 150, "é" * 256, "b" * 511]
    alone = [scored(model, [x])[0] for x in texts]
    assert np.allclose(alone, [plain_score(model, x) for x in texts], atol=1e-5)


def test_neighbours_do_not_matter():
    model = q.Network(4)
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abc |#"), n)) for n in (0, 1, 255, 256, 257, 512, 513, 5000, 300_000, 3)]
    alone = [scored(model, [x])[0] for x in texts]
    assert np.allclose(scored(model, texts), alone, atol=1e-6)


def test_gradient_is_that_of_the_loss():
    model = q.Network(5)
    model.values = {k: x.astype(np.float64) for k, x in model.values.items()}
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, (6, q.CHUNK + q.WIDTH - q.STRIDE)).astype(np.uint8)
    truth = np.arange(6) % 2

    def loss():
        total = 0.0
        for row, y in zip(data, truth, strict=True):
            best = model.responses(row).max(axis=0)
            z = model.logits(best[None, :])[0]
            total += np.log1p(np.exp(-z if y else z))
        return total / len(data)

    found = model._gradient(data, truth)
    for name, value in model.values.items():
        flat, slope = value.reshape(-1), found[name].reshape(-1)
        for i in rng.choice(len(flat), min(4, len(flat)), replace=False):
            old, step = flat[i], 1e-6
            flat[i] = old + step
            up = loss()
            flat[i] = old - step
            down = loss()
            flat[i] = old
            assert slope[i] == pytest.approx((up - down) / (2 * step), abs=1e-5)


def test_held_out_accuracy(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = q.trained(documents, labels)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    found = {r.doc_id: r.score for r in q.scored(documents, model).collect()}
    assert len(found) == documents.count() and all(0 <= x <= 1 for x in found.values())
    out = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    right = sum((found[i] >= 0.7) == truth[i] for i in out) / len(out)
    assert right > 0.93


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(q, "STEPS", 5)
    rows = [(i, "good words here " * 5 if i % 3 else "### $$$ ###", "x") for i in range(40)]
    rows += [(50, None, "x"), (51, "", None), (None, "text", "x"), (52, "same", "x"), (52, "same", "x"), (53, "long " * 200_000, "")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(40)] + [(50, 1), (51, None), (None, 1), (1, 1)], "doc_id long, quality int")
    found = q.scored(documents, q.trained(documents, labels)).collect()
    assert sorted((r.doc_id for r in found), key=str) == sorted((r[0] for r in rows), key=str)
    assert all(0 <= r.score <= 1 for r in found)
    # no labels, or one class only: the share of good labels
    for known, want in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 0.9)):
        same = {r.score for r in q.scored(documents, q.trained(documents, known)).collect()}
        assert len(same) == 1 and same.pop() >= want - 1e-6
    assert q.scored(documents.limit(0), q.Network()).collect() == []


def test_clashing_labels_do_not_train(spark, monkeypatch):
    """The same network whatever order the label rows are in; ids of both classes are left out."""
    monkeypatch.setattr(q, "STEPS", 3)
    documents = spark.createDataFrame([(i, f"text {i} " * (1 + i % 7)) for i in range(60)], "doc_id long, text string")
    pairs = [(i, i % 2) for i in range(60)] + [(i, 1 - i % 2) for i in range(0, 60, 5)]
    models = [
        q.trained(documents.repartition(n), spark.createDataFrame(order, "doc_id long, quality int").repartition(n))
        for n, order in ((1, pairs), (4, pairs[::-1]), (2, [p for p in pairs if p[0] % 5]))
    ]
    for other in models[1:]:
        assert all(np.array_equal(x, other.values[name]) for name, x in models[0].values.items())


def test_a_long_text_sends_a_few_chunks(spark):
    batch = pa.RecordBatch.from_pydict({"id": [1, 2, 3], "label": [0, 1, 1], "draw": [0.1, 0.2, 0.2], "text": ["x" * 10**6, "", "é"]})
    (cut,) = q._cut(iter([batch]))
    chunks = cut.column("chunks").to_pylist()
    assert [len(c) for c in chunks] == [q.CHUNKS] * 3
    assert all(len(x) == q.CHUNK + q.WIDTH - q.STRIDE for x in chunks[0]) and set(chunks[1]) == {b""}
