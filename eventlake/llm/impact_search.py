"""Exact top-k search by inner product: an impact-ordered index, worked off score at a time.

Components become integers, floor(scale * x). Vectors lie in tiles of bounded size. A tile's index
has for each dimension its vectors by descending magnitude of the component, so the vectors of one
magnitude are a posting segment, and |query component| * magnitude is its impact on a query's
scores. A query works off the segments of all dimensions by descending impact, level by level,
adding to the score of each vector in them and to the number of its dimensions seen. What is not
yet seen has an impact below the level, so a vector's score lies within (dimensions unseen) *
(level - 1) of its sum. The k-th best of k exact scores is a lower bound of the k-th place; work
stops only when few vectors can still reach it, or no segment is left, and those that can are
rescored exactly. Levels and what counts as few decide on work, never on results.

Every query meets every tile: blocks of queries and tiles form groups of bounded size. A group
leaves at most k rows per query; equal rows are one, with their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.tables import numbered, parts, stored

#: Components of a tile, queries of a block: the size of a group's tables, the streams to it.
ENTRIES, BLOCK = 1 << 22, 512
#: First level as a share of the highest impact, and each further one of the one before.
FIRST, STEP = 0.04, 0.5
#: Rescoring starts when at most this share of a tile can still be among the best.
FEW = 0.5


class ImpactIndex:
    """Posting segments of a tile's vectors (rows of integers)."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        n, size = codes.shape
        magnitude = np.abs(codes.T)
        order = np.argsort(-magnitude, axis=1, kind="stable")
        self.ids = order
        self.most = int(magnitude.max()) if codes.size else 0
        self.largest = magnitude.max(axis=1) if codes.size else np.zeros(size, dtype=np.int64)
        # ascending over all dimensions, so that one search finds the ends of all lists
        rank = np.arange(size)[:, None] * (self.most + 1)
        self.keys = (rank + self.most - np.take_along_axis(magnitude, order, axis=1)).reshape(-1)
        # sums hold the number of dimensions seen in their lowest bits
        self.bits = size.bit_length()
        self.values = np.take_along_axis(codes.T, order, axis=1) << self.bits
        if self.most < 1 << (30 - self.bits):
            self.values = self.values.astype(np.int32)

    def _upto(self, least: np.ndarray) -> np.ndarray:
        """How many vectors of each dimension's list have at least this magnitude."""
        size = len(least)
        wanted = np.arange(size) * (self.most + 1) + self.most - np.minimum(least, self.most + 1)
        return np.searchsorted(self.keys, wanted, side="right") - np.arange(size) * len(self.codes)

    def best(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of all vectors that may be among the k best, the k best included."""
        n, size = self.codes.shape
        weight = np.abs(query)
        highest = int((weight * self.largest).max()) if size else 0
        used = np.flatnonzero(weight)
        reach = highest * max(1, size) << self.bits
        if n <= k or not highest or reach >= 1 << 62:
            return np.arange(n), self.codes @ query
        kind = np.int32 if reach < 1 << 30 else np.int64
        sums, done, factor = np.zeros(n, dtype=kind), np.zeros(size, dtype=np.int64), query.astype(kind)
        level = max(1, int(highest * FIRST))
        while True:
            upto = self._upto(-(-level // np.maximum(weight, 1)))
            for d in used:
                if done[d] < upto[d]:
                    part = slice(done[d], upto[d])
                    # a list names a vector once, so no addition is lost
                    ids = self.ids[d, part]
                    moved = sums.take(ids, mode="clip")
                    moved += factor[d] * self.values[d, part]
                    moved += kind(1)
                    sums[ids] = moved
            done = upto
            score, slack = sums >> self.bits, (len(used) - (sums & (1 << self.bits) - 1)) * np.int64(level - 1)
            first = np.argpartition(score, n - k)[n - k :]
            proven = (self.codes[first] @ query).min()
            possible = np.flatnonzero(score + slack >= proven)
            if len(possible) <= max(k, n * FEW) or level == 1:
                return possible, self.codes[possible] @ query
            level = max(1, int(level * STEP))


_OUT = pa.schema(
    [("node", pa.int64()), ("id", pa.int64()), ("score", pa.int64()), ("n", pa.int64())]
)


def _searched(k: int):
    """Rows of a group, its vectors before its queries, to the best of it for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, index = None, [], None
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in ("size", "tile", "block", "asks")], axis=1)
            cuts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)]) if len(key) else []
            for first, last in zip(cuts, [*cuts[1:], len(key)], strict=True):
                *now, asks = key[first].tolist()
                rows = batch.slice(first, last - first)
                if now != group:
                    group, held, index = now, [], None
                if not asks:
                    held.append(_arrays(rows, now[0]))
                    continue
                if held and index is None:
                    node, ids, n, codes = (np.concatenate(x) for x in zip(*held, strict=True))
                    held, index = [], ImpactIndex(codes)
                if index is not None:
                    yield _answers(index, node, ids, n, _arrays(rows, now[0]), k)

    return run


def _arrays(rows: pa.RecordBatch, size: int) -> tuple[np.ndarray, ...]:
    codes = rows.column("codes").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    ids = np.ma.masked_array(
        rows.column("id").fill_null(0).to_numpy(), mask=rows.column("id").is_null().to_numpy(zero_copy_only=False)
    )
    # null ids are kept beside the largest long, behind which they sort
    ids = np.stack([ids.data, np.ma.getmaskarray(ids)], axis=1)
    return rows.column("node").to_numpy(), ids, rows.column("n").to_numpy(), codes.reshape(len(rows), size)


def _answers(index: ImpactIndex, node, ids, n, queries: tuple[np.ndarray, ...], k: int) -> pa.RecordBatch:
    asked, _, _, vectors = queries
    found = []
    for name, vector in zip(asked, vectors, strict=True):
        at, score = index.best(vector, k + 1)
        # the query's own row does not count; its equals do
        left = n[at] - (node[at] == name)
        at, score = at[left > 0], score[left > 0]
        order = np.lexsort((ids[at, 0], ids[at, 1], -score))[:k]
        found.append((np.full(len(order), name), at[order], score[order], left[left > 0][order]))
    names, at, score, left = (np.concatenate(x) for x in zip(*found, strict=True))
    named = pa.array(ids[at, 0], mask=ids[at, 1].astype(bool))
    return pa.RecordBatch.from_arrays([pa.array(names), named, pa.array(score), pa.array(left)], schema=_OUT)


def top_scores(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    scale: int = 64,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score) for every row whose vec_id is divisible by `every`: its k
    highest integer inner products with all other rows, ties to the smaller vec_id; all, if there
    are fewer.

    Vectors that are null, hold null or non-finite components, or components so large that a
    product could leave 64 bits take no part. A vector meets those of its own length. A row
    without an id does not ask; it is found, behind the ids of its score. Rows that repeat an id
    are rows of their own: each asks, and each but the one that asks is found. An empty table
    gives an empty result. Other columns are not looked at."""
    spark, x = vectors.sparkSession, F.col("x")
    most = F.sqrt(F.lit(2.0**62) / F.greatest(F.size(x), F.lit(1))) / scale - 1

    def fits(c):
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= most)

    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("x"))
    rows = rows.where(x.isNotNull() & F.forall(x, fits))
    codes = F.transform(x, lambda c: F.floor(c * scale)).alias("codes")
    equal = rows.select("id", codes).groupBy("id", "codes").agg(F.count("*").alias("n"))
    nodes = numbered(stored(equal.withColumn("size", F.size("codes")), "vectors"), "node")

    asks = F.coalesce(F.col("id") % every == 0, F.lit(False))
    entries = F.greatest(F.floor(F.lit(ENTRIES) / F.greatest("size", F.lit(1))), F.lit(1))
    sizes = nodes.groupBy("size").agg(
        F.ceil(F.count("*") / F.first(entries)).cast("int").alias("tiles"),
        F.ceil(F.sum(asks.cast("int")) / BLOCK).cast("int").alias("blocks"),
    )
    sizes = stored(sizes.where("blocks > 0"), "sizes")
    groups = sizes.agg(F.sum(F.col("tiles").cast("long") * F.col("blocks"))).first()[0] or 0
    placed = nodes.join(sizes, "size")
    drawn = F.xxhash64("node")
    place = {"tile": F.pmod(drawn, "tiles").cast("int"), "block": F.pmod(F.xxhash64(drawn), "blocks").cast("int")}
    columns = ["size", "tile", "block", "asks", "node", "id", "n", "codes"]
    held = placed.withColumn("tile", place["tile"]).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    asked = placed.where(asks).withColumn("block", place["block"])
    asked = asked.withColumn("tile", F.explode(F.expr("sequence(0, tiles - 1)")))
    both = held.withColumn("asks", F.lit(0)).select(columns).union(asked.withColumn("asks", F.lit(1)).select(columns))
    # groups are alike in size; more partitions than groups keep two from sharing one
    spread = both.repartition(max(parts(spark), min(4 * groups, 1 << 15)), "size", "tile", "block")
    found = spread.sortWithinPartitions("size", "tile", "block", "asks").mapInArrow(
        _searched(k), "node long, id long, score long, n long"
    )
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    best = Window.partitionBy("node").orderBy(*order)
    top = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).drop("rank")
    each = top.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k))))).drop("n", "copy")
    each = each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = nodes.where(asks).select("node", F.col("id").alias("query_id"), F.col("n").alias("times"))
    named = each.join(names, "node").withColumn("time", F.explode(F.expr("sequence(1, times)")))
    return named.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
