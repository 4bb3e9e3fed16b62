"""Quality classifier: a convolutional network over bytes, in numpy.

Bytes get small learned vectors; FILTERS learned filters slide over WIDTH bytes, STRIDE apart;
each filter's largest response within a chunk is kept (max pooling), a hidden layer turns a
chunk's responses into a logit, and the mean logit of a document's chunks into one probability.
Chunks of CHUNK bytes overlap by half and cover the whole document; one that is shorter, and an
empty text, is padded with zeros. Texts are never cut off.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.tables import freed, settle
from eventlake.llm.words import buffers

WIDTH, STRIDE, VECTOR, FILTERS, HIDDEN = 8, 2, 4, 32, 16
CHUNK = 512
#: Positions of a filter in a piece; a chunk is two pieces in a row.
PIECE = CHUNK // 2 // STRIDE
#: Bytes scored at once.
SLICE = 1 << 18
#: Labelled documents of each class used for training, steps and chunks of a step.
PER_CLASS, STEPS, BATCH = 1500, 2500, 64
#: Chunks of a text that training draws from.
CHUNKS = 8
RATE = 3e-3


class Network:
    def __init__(self, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)

        def start(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.values = {
            "bytes": (rng.standard_normal((256, VECTOR)) * 0.5).astype(np.float32),
            "filters": start(WIDTH * VECTOR, FILTERS),
            "shift": np.zeros(FILTERS, np.float32),
            "hidden": start(FILTERS, HIDDEN),
            "bias": np.zeros(HIDDEN, np.float32),
            "out": start(HIDDEN),
            "prior": np.zeros(1, np.float32),
        }

    def responses(self, data: np.ndarray) -> np.ndarray:
        """Filter responses at every position; data is padded by WIDTH - STRIDE bytes."""
        x = self.values["bytes"][data].reshape(-1)
        n = (len(data) - WIDTH) // STRIDE + 1
        step = x.strides[0]
        windows = np.lib.stride_tricks.as_strided(x, (n, WIDTH * VECTOR), (STRIDE * VECTOR * step, step))
        return windows @ self.values["filters"]

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        v = self.values
        return np.tanh(np.maximum(pooled + v["shift"], 0) @ v["hidden"] + v["bias"]) @ v["out"] + v["prior"]

    def score(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Probability of each text, given as ranges of bytes."""
        out = np.empty(len(offsets) - 1)
        first = 0
        while first < len(out):
            last = int(np.searchsorted(offsets, offsets[first] + SLICE, side="right")) - 1
            last = min(max(first + 1, last), len(out))
            out[first:last] = self._slice(offsets[first : last + 1] - offsets[first], data[offsets[first] : offsets[last]])
            first = last
        return out

    def _slice(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        half = PIECE * STRIDE
        # every text gets a whole number of pieces, two at least, and zeros at its end: windows
        # that would reach into the next text begin in the zeros and are left out
        over = WIDTH - STRIDE
        pieces = np.maximum(2, -(-(np.diff(offsets) + over) // half))
        end = np.cumsum(pieces)
        last = np.zeros(int(end[-1]), dtype=bool)
        last[end - 1] = True
        padded = np.zeros(int(end[-1]) * half + over, dtype=np.uint8)
        where = np.arange(len(data)) + np.repeat((end - pieces) * half - offsets[:-1], np.diff(offsets))
        padded[where] = data
        pooled = np.empty((int(end[-1]), FILTERS), np.float32)
        for at in range(0, len(pooled), 512):
            upto = min(at + 512, len(pooled))
            part = self.responses(padded[at * half : upto * half + over])
            part = part.reshape(-1, PIECE, FILTERS)
            part[last[at:upto], -over // STRIDE :] = -np.inf
            pooled[at:upto] = part.max(axis=1)
        chunk = np.maximum(pooled[:-1], pooled[1:])
        logits = np.append(self.logits(chunk), 0.0)
        # the last piece of a text starts no chunk of its own
        logits[end - 1] = 0
        mean = np.add.reduceat(logits, end - pieces) / (pieces - 1)
        return 1 / (1 + np.exp(-mean.astype(np.float64)))

    def train(self, texts: list[list[bytes]], labels: np.ndarray, seed: int = 1) -> None:
        """Adam on the logistic loss of texts' chunks, drawn at random; classes are drawn evenly and the
        prior is put right at the end."""
        rng = np.random.default_rng(seed)
        classes = [np.flatnonzero(labels == c) for c in (0, 1)]
        if not all(len(c) for c in classes):
            share = (len(classes[1]) + 0.5) / (len(labels) + 1)
            self.values["out"][:] = 0
            self.values["prior"][:] = np.log(share / (1 - share))
            return
        length = CHUNK + WIDTH - STRIDE
        first = {k: np.zeros_like(x) for k, x in self.values.items()}
        second = {k: np.zeros_like(x) for k, x in self.values.items()}
        for step in range(1, STEPS + 1):
            truth = np.arange(BATCH) % 2
            data = np.zeros((BATCH, length), np.uint8)
            for row, label in zip(data, truth, strict=True):
                text = texts[rng.choice(classes[label])]
                # some chunks are short, as short documents are
                upto = length if rng.random() < 0.75 else rng.integers(8, CHUNK)
                piece = text[rng.integers(0, len(text))][:upto]
                row[: len(piece)] = np.frombuffer(piece, np.uint8)
            rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
            for k, g in self._gradient(data, truth).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-7)
                self.values[k] -= (rate * move).astype(np.float32)

    def _gradient(self, data: np.ndarray, truth: np.ndarray) -> dict[str, np.ndarray]:
        v = self.values
        n = CHUNK // STRIDE
        at = np.arange(n)[:, None] * STRIDE + np.arange(WIDTH)
        windows = v["bytes"][data[:, at]].reshape(len(data), n, WIDTH * VECTOR)
        response = windows @ v["filters"]
        best = response.argmax(axis=1)
        rows = np.arange(len(data))[:, None]
        pooled = response[rows, best, np.arange(FILTERS)] + v["shift"]
        active = np.maximum(pooled, 0)
        hidden = np.tanh(active @ v["hidden"] + v["bias"])
        logit = hidden @ v["out"] + v["prior"]
        error = ((1 / (1 + np.exp(-logit))) - truth) / len(data)
        d_hidden = error[:, None] * v["out"] * (1 - hidden * hidden)
        d_pooled = (d_hidden @ v["hidden"].T) * (pooled > 0)
        chosen = windows[rows, best]
        d_window = d_pooled[:, :, None] * v["filters"].T
        d_bytes = np.zeros_like(v["bytes"])
        where = data[rows[:, :, None], best[:, :, None] * STRIDE + np.arange(WIDTH)]
        np.add.at(d_bytes, where.reshape(-1), d_window.reshape(-1, VECTOR))
        return {
            "bytes": d_bytes,
            "filters": np.einsum("bf,bfk->kf", d_pooled, chosen),
            "shift": d_pooled.sum(axis=0),
            "hidden": active.T @ d_hidden,
            "bias": d_hidden.sum(axis=0),
            "out": hidden.T @ error,
            "prior": error.sum(keepdims=True),
        }


def held_out(doc_id, modulus: int = 4, remainder: int = 2):
    """Rows kept away from training: by the crc32 of the id as text."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(False))


def trained(
    documents: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text"
) -> Network:
    """A network fitted on about PER_CLASS documents of each class, chosen by a hash of their id
    among the labelled ones that are not held out; of each, CHUNKS chunks reach the driver. Null
    texts, labels and ids do not train, nor do ids with labels of both classes."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
    known = known.where((F.col("label").isin(0, 1)) & ~held_out("id"))
    known = known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most"))
    known = known.where("label = most").drop("most")
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 20)) / float(1 << 20)
    share = F.lit(0.0)
    for c, n in counts.items():
        share = F.when(F.col("label") == c, min(1.0, PER_CLASS / n)).otherwise(share)
    # a sample of bounded size, so it may be broadcast: documents are not shuffled for it
    picked = known.where(draw < share).withColumn("draw", draw).orderBy("draw", "id").limit(3 * PER_CLASS)
    rows = documents.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where("text is not null")
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.join(F.broadcast(picked), "id").mapInArrow(freed(_cut), f"id {kind}, label int, draw double, chunks array<binary>")
    sample = found.orderBy("draw", "id", "chunks").limit(3 * PER_CLASS).collect()
    model = Network()
    model.train([[bytes(x) for x in r.chunks] for r in sample], np.array([r.label for r in sample], dtype=np.int64))
    if len(counts) == 2 and sample:
        model.values["prior"] += np.float32(np.log(counts[1] / counts[0]))
    return model


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """CHUNKS chunks of each text at places drawn by its own number: a few KB of a text of any size."""
    for batch in batches:
        chunks = []
        for text, draw in zip(batch.column("text").to_pylist(), batch.column("draw").to_pylist(), strict=True):
            data = text.encode("utf-8", "surrogatepass")
            rng = np.random.default_rng(int(draw * (1 << 20)))
            places = rng.integers(0, max(1, len(data) - CHUNK // 2), CHUNKS)
            chunks.append([data[at : at + CHUNK + WIDTH - STRIDE] for at in places])
        columns = [batch.column(c) for c in ("id", "label", "draw")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(chunks, pa.list_(pa.binary()))], ["id", "label", "draw", "chunks"])


def scored(documents: DataFrame, model: Network, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) for every row; a null or empty text is scored as zeros. Repeated rows and
    null ids are kept; other columns are not looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = buffers(batch.column("text"))
            found = model.score(offsets - offsets[0], data[offsets[0] : offsets[-1]])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    settle(documents.sparkSession)
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(freed(run), f"doc_id {kind}, score double")
