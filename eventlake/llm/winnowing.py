"""Document fingerprints by winnowing.

Every run of GRAM code points is hashed; of every WINDOW consecutive hashes the smallest is
chosen, the rightmost among equals; what several windows choose counts once. Two texts that
share GRAM + WINDOW - 1 code points in a row therefore share a mark, whose positions say where.

Short texts would get few marks or none that an edit leaves. So a text under a length of SCALES has
marks of that scale too: under 1,000 code points those of grams of 8 in windows of 16, under 260
every pair of code points. Scales are kept apart in the fingerprint, and two texts are compared by
the scales that both have, so a text on one side of a length is alike to one on the other. Each
length is far above those at which the scale before it has too few marks. The scales depend on the
length alone, so equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.tables import freed, parts, settle
from eventlake.llm.words import BASE, mix

GRAM, WINDOW = 24, 64
#: (gram, window, length): texts of fewer code points have marks of the scale; coarse to fine.
SCALES = ((GRAM, WINDOW, None), (8, 16, 1000), (2, 1, 260))
#: Buckets of neighbours per shuffle partition, more even out partitions; keys sampled per bucket.
BUCKETS, SAMPLED = 3, 20

LOW = np.uint64(0xFFFFFFFF)


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def gram_hashes(values: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of every run of gram code points; of the whole text if it is shorter. Runs are put
    together from runs of powers of two."""
    gram = min(gram, len(values))
    if not gram:
        return np.empty(0, dtype=np.uint64)
    n = len(values) - gram + 1
    power = values.astype(np.uint64) + np.uint64(1)
    out, covered, size, base = None, 0, 1, int(BASE)
    while True:
        if gram & size:
            piece = power[covered : covered + n]
            out = piece if out is None else out * np.uint64(base) + piece
            covered += size
        if size * 2 > gram:
            return mix(out)
        power = power[:-size] * np.uint64(base) + power[size:]
        size, base = size * 2, base * base % (1 << 64)


def marks(values: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> np.ndarray:
    """(hash, position) of the chosen grams, in order of position; hashes have 32 bits."""
    return _chosen(values, gram, window)


def scaled(values: np.ndarray) -> list[np.ndarray]:
    """The marks of each scale that a text of this length has, coarse to fine. Grams of more code
    points than the text has leave none, but for those of the finest scale."""
    n, finest = len(values), SCALES[-1][0]
    have = [(g, w) for g, w, length in SCALES if length is None or n < length]
    none = np.empty((0, 2), dtype=np.uint32)
    return [_chosen(values, g, w) if g <= n or g == finest else none for g, w in have]


def _chosen(values: np.ndarray, gram: int, window: int) -> np.ndarray:
    hashes = gram_hashes(values, gram)
    n = len(hashes)
    if not n:
        return np.empty((0, 2), dtype=np.uint32)
    # smallest hash first, then largest position
    least = (hashes & ~LOW) | (LOW - np.arange(n, dtype=np.uint64))
    window = min(window, n)
    size = 1
    while size * 2 <= window:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < window:
        rest = window - size
        least = np.minimum(least[:-rest], least[rest:])
    chosen = least[np.flatnonzero(np.r_[True, least[1:] != least[:-1]])]
    return np.stack([chosen >> np.uint64(32), LOW - (chosen & LOW)], axis=1).astype(np.uint32)


def written(found: list[np.ndarray]) -> str:
    """Sixteen hexadecimal digits per mark, eight of its hash and eight of its position; scales in
    order with colons between. Nothing for the empty text."""
    if not any(len(x) for x in found):
        return ""
    return ":".join(x.astype(">u4").tobytes().hex() for x in found)


def read(fingerprint: str) -> list[np.ndarray]:
    parts = fingerprint.split(":") if fingerprint else [""] * len(SCALES)
    return [np.frombuffer(bytes.fromhex(x), dtype=">u4").reshape(-1, 2).astype(np.uint32) for x in parts]


def likeness(a: list[np.ndarray], b: list[np.ndarray]) -> float:
    """Jaccard similarity of the hashes of the scales that both have; 1 if neither has a mark of
    any, as for two empty texts."""
    both = either = 0
    for x, y in zip(a, b, strict=False):
        x, y = np.unique(x[:, 0]), np.unique(y[:, 0])
        common = len(np.intersect1d(x, y, assume_unique=True))
        both += common
        either += len(x) + len(y) - common
    return both / either if either else float(sum(map(len, a)) == sum(map(len, b)))


def edited(text: str, following: str) -> str:
    """The last third (rounded down) gives way to as much of the start of the following text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def fingerprints(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row; a null or empty text has the empty fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [written(scaled(points(x or ""))) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "fingerprint"]
            )

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


#: The order of documents: rows without an id last, ids descending, then the text's hash and text.
PLACE = ("unnamed", "first", "second")


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with whole numbers that sort them: ids descending, those that repeat one by their
    text's hash; rows without an id by their text's hash alone."""
    unnamed, hashed = F.isnull("doc_id"), F.xxhash64("text")
    return rows.withColumns(
        {
            "unnamed": unnamed.cast("long"),
            "first": F.when(unnamed, hashed).otherwise(F.bitwise_not("doc_id")),
            "second": F.when(unnamed, F.lit(0)).otherwise(hashed).cast("long"),
        }
    )


def _bounds(rows: DataFrame) -> np.ndarray:
    """Places, of rows that occur, at which buckets begin: the first one, and others at even steps
    of a sample of distinct places by their hash, of bounded size."""
    n = parts(rows.sparkSession) * BUCKETS
    lowest, total = rows.agg(F.min(F.struct(*PLACE)), F.count("*")).first()
    if not total:
        return np.empty((0, 3), dtype=np.int64)
    keep = F.pmod(F.xxhash64(*PLACE), F.lit(max(1, total // (SAMPLED * n)))) == 0
    sample = sorted(tuple(r) for r in rows.where(keep).select(*PLACE).distinct().collect())
    steps = [sample[i * len(sample) // n] for i in range(n)] if sample else []
    return np.array(sorted({tuple(lowest), *steps}), dtype=np.int64)


def _among(bounds: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each place, and whether a bucket begins with it."""
    order = np.lexsort(np.concatenate([bounds, places])[:, ::-1].T)
    # a bound sorts before places equal to it, as lexsort keeps the order of equals
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.cumsum(order < len(bounds)) - 1
    own = rank[len(bounds) :]
    return own, (bounds[own] == places).all(axis=1)


def _neighbour_buckets(rows: DataFrame) -> DataFrame:
    """Rows in buckets of consecutive places, each bucket followed by a copy of the first row of
    the next one (of the first bucket, after the last)."""
    rows = _placed(rows)
    bounds = _bounds(rows)

    @F.pandas_udf("array<int>")
    def buckets(*place: pd.Series) -> pd.Series:
        own, begins = _among(bounds, np.stack([x.to_numpy() for x in place], axis=1))
        before = (own - 1) % max(1, len(bounds))
        return pd.Series([[a, b] if f else [a] for a, b, f in zip(own, before, begins, strict=True)])

    spread = rows.withColumn("buckets", buckets(*PLACE))
    return spread.select("*", F.posexplode("buckets").alias("copy", "bucket")).drop("buckets")


def edit_likeness(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edit with the next document by descending doc_id (the
    first one after the last), and how alike they are: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.

    A null text is empty. Rows that repeat a doc_id follow each other, ordered by their text's
    hash, then text; rows with a null doc_id come after all others, in that order too. A single row
    is its own next document. Equal rows lie in one bucket. Other columns are not looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = held = None
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("bucket", "copy", "doc_id", "text")]
            for bucket, copy, name, value in zip(*columns, strict=True):
                now = (bucket, copy, name, value, scaled(points(value)))
                if held and held[0] == bucket and not held[1]:
                    out.append(_compared(held, now))
                elif held and not held[1]:
                    # a bucket without the copy that ends it is the only one and ends with its first
                    out.append(_compared(held, first))
                if not held or held[0] != bucket:
                    first = now
                held = now
            yield _rows(out)
        if held and not held[1]:
            yield _rows([_compared(held, first)])

    settle(documents.sparkSession)
    whole = F.coalesce(F.col(text), F.lit("")).alias("text")
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), whole)
    order = ["bucket", "copy", *PLACE, "text"]
    spread = _neighbour_buckets(rows).repartition(parts(documents.sparkSession), "bucket")
    return spread.sortWithinPartitions(*order).drop(*PLACE).mapInArrow(freed(run), SCHEMA)


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def _compared(now: tuple, following: tuple) -> tuple:
    _, _, name, text, own = now
    other = edited(text, following[3])
    changed = scaled(points(other))
    digest = hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest()
    near = likeness(own, changed), likeness(own, following[4])
    return (name, len(text), digest, written(own), written(changed), *near)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(_ARROW)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW
    )
