"""Embedding near-dedup: pigeonhole join over subspaces of rotated vectors.

Unit vectors are turned by a fixed random rotation and split into blocks of BLOCK coordinates.
A cosine of t or more means a squared distance of 2 - 2t or less, so at least one of m blocks
is within an m-th of it (the budget in proportion to its coordinates): the union of what the
blocks' range joins find holds every link. In each block

1. pivots, a bounded sample of the block's vectors, cut it into cells: a vector is at home with
   its nearest pivot;
2. it also visits the cells that the budget's radius can reach: where q is at home with h, all
   points nearer to c than to h are at least (|q-c|^2 - |q-h|^2) / (2 |c-h|) away from q. Of two
   cells the one with the even sum rule below hosts their pairs, so each pair meets once;
3. cells over TILE vectors are cut into chunks that visit each other;
4. a cell's residents meet its visitors batch by batch, known by their coordinates of this block
   alone, 64 bytes however wide the vectors are. Those without any partner within the budget drop out;
5. the others get their whole vectors and meet once more: block distances select candidates, and
   the cosine in double precision decides.

A pair that several blocks find counts in the first of them. Pairs are never written: a cell
returns the number of links of each vector and a spanning forest of its links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.components import components
from eventlake.llm.tables import freed, parts, stored

#: Coordinates of a block.
BLOCK = 16
#: Vectors of a cell, of a batch of visitors; most pivots, a bounded sample that only moves work.
TILE, VISITORS, PIVOTS = 16384, 512, 1024
#: Candidates compared at once, vectors given to cells at once.
PAIRS, ROWS = 1 << 16, 2048
#: What cells return.
FOUND = "node long, mark long, other long, other_mark long, links long"
#: Room for rounding in single precision, where distances only select.
SLACK = 1e-4


def _signs(size: int, turn: int) -> np.ndarray:
    return np.random.default_rng([17, turn]).choice([-1.0, 1.0], size)


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Signs and a Hadamard transform, twice; padded to a power of two. It only adds and
    subtracts, element by element, so a vector's result does not depend on its batch."""
    size = max(BLOCK, 1 << (max(1, vectors.shape[1]) - 1).bit_length())
    out = np.zeros((len(vectors), size))
    out[:, : vectors.shape[1]] = vectors
    for turn in range(2):
        out *= _signs(size, turn)
        step = 1
        while step < size:
            pairs = out.reshape(len(out), -1, 2, step)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
            step *= 2
        out = out.reshape(len(vectors), size) / np.sqrt(size)
    return out


def unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled by the largest component first, so that squares neither overflow nor vanish."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.empty((0, 1))


class Cells:
    """Pivots of one block and the chunks of their cells."""

    def __init__(self, pivots: np.ndarray) -> None:
        self.pivots = pivots
        self.square = (pivots * pivots).sum(axis=1)
        self.between = np.sqrt(np.maximum(self.square[:, None] + self.square - 2 * pivots @ pivots.T, 0))
        self.chunks = np.ones(len(pivots), dtype=np.int64)
        self.first = np.arange(len(pivots))

    def split(self, counts: np.ndarray) -> None:
        self.chunks = np.maximum(1, -(-counts // TILE))
        self.first = np.cumsum(self.chunks) - self.chunks

    def near(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors * vectors).sum(axis=1)[:, None] + self.square - 2 * vectors @ self.pivots.T

    def visits(
        self, vectors: np.ndarray, salt: np.ndarray, radius: float
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The home chunk of each vector, and (vector, chunk) for other hosts it must visit."""
        far = self.near(vectors)
        home = far.argmin(axis=1)
        far -= far[np.arange(len(far)), home][:, None]
        reach = far <= 2 * self.between[home] * (radius + SLACK) + SLACK
        own = self.first[home] + salt % self.chunks[home]
        row, cell = np.nonzero(reach)
        count = self.chunks[cell]
        row = np.repeat(row, count)
        there = np.repeat(self.first[cell] - np.cumsum(count) + count, count) + np.arange(len(row))
        # of two chunks the lower hosts if the sum is even, else the higher
        low = np.minimum(there, own[row])
        host = np.where((there + own[row]) % 2 == 0, low, np.maximum(there, own[row]))
        visit = (host == there) & (there != own[row])
        return own, row[visit], there[visit]


def _linkable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    return rows.withColumn("good", F.coalesce(good, F.lit(False)))


def _cells(nodes: DataFrame, count: int, blocks: int) -> list[Cells]:
    """Pivots from the vectors whose hash is smallest, as many as cells are wanted."""
    wanted = min(PIVOTS, -(-count // TILE))
    picked = nodes.orderBy(F.xxhash64("node", F.lit(3)), "node").limit(wanted).toPandas()
    turned = rotated(unit(_matrix(picked.v)))
    return [Cells(np.unique(turned[:, b * BLOCK : (b + 1) * BLOCK], axis=0)) for b in range(blocks)]


def _padded(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    lengths = column.map(len).to_numpy()
    for n in np.unique(lengths):
        out[lengths == n, :n] = np.stack(column[lengths == n].to_numpy())
    return out


def _turned(nodes: pd.DataFrame, width: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for first in range(0, len(nodes), ROWS):
        some = nodes.iloc[first : first + ROWS]
        yield some, rotated(unit(_padded(some.v, width)))


def _assigned(nodes: DataFrame, cells: list[Cells], width: int, radius: float) -> DataFrame:
    """(block, chunk, visitor, node, mark, side): a row where a vector is at home and per visit.
    The side is its coordinates of the block in single precision."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for some, turned in _turned(frame, width):
                salt = some.node.to_numpy() // 7919
                for b, own in enumerate(cells):
                    sides = turned[:, b * BLOCK : (b + 1) * BLOCK]
                    home, row, there = own.visits(sides, salt, radius)
                    rows = some[["node", "mark"]].assign(side=[x.tobytes() for x in sides.astype(np.float32)])
                    yield rows.assign(block=b, chunk=home, visitor=0)
                    yield rows.iloc[row].assign(block=b, chunk=there, visitor=1)

    schema = "node long, mark long, side binary, block int, chunk long, visitor int"
    return nodes.select("node", "mark", "v").mapInPandas(run, schema)


def _counted(nodes: DataFrame, cells: list[Cells], width: int) -> None:
    """Cuts cells into chunks by how many vectors are at home in them. The driver sees one number
    per cell, of which there are PIVOTS a block at most."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = [np.zeros(len(c.pivots), dtype=np.int64) for c in cells]
        for frame in frames:
            for _, turned in _turned(frame, width):
                for b, own in enumerate(cells):
                    home = own.near(turned[:, b * BLOCK : (b + 1) * BLOCK]).argmin(axis=1)
                    total[b] += np.bincount(home, minlength=len(total[b]))
        for b, n in enumerate(total):
            cell = np.flatnonzero(n)
            yield pd.DataFrame({"block": b, "cell": cell, "n": n[cell]})

    counted = nodes.select("v").mapInPandas(run, "block int, cell int, n long")
    counts = [np.zeros(len(c.pivots), dtype=np.int64) for c in cells]
    for row in counted.groupBy("block", "cell").agg(F.sum("n").alias("n")).collect():
        counts[row.block][row.cell] = row.n
    for own, n in zip(cells, counts, strict=True):
        own.split(n)


class _Sides:
    """Coordinates of vectors in a chunk, and which of them have a partner within the budget."""

    def __init__(self, rows: pd.DataFrame) -> None:
        self.rows = rows
        self.side = np.frombuffer(b"".join(rows.side), dtype=np.float32).reshape(-1, BLOCK)
        self.square = (self.side * self.side).sum(axis=1)
        self.close = np.zeros(len(rows), dtype=bool)

    def meet(self, other: _Sides, budget: float) -> None:
        for first in range(0, len(other.side), VISITORS):
            cut = slice(first, first + VISITORS)
            far = other.square[cut, None] + self.square - 2 * other.side[cut] @ self.side.T
            near = far <= budget + SLACK
            if other is self:
                at = np.arange(len(near))
                near[at, first + at] = False
            other.close[cut] |= near.any(axis=1)
            self.close |= near.any(axis=0)

    def members(self) -> pd.DataFrame:
        return self.rows[self.close][["block", "chunk", "visitor", "node", "mark"]]


def _by_chunk(rows: DataFrame) -> DataFrame:
    spread = rows.repartition(parts(rows.sparkSession), "block", "chunk")
    return spread.sortWithinPartitions("block", "chunk", "visitor")


def _close(assigned: DataFrame, budget: float) -> DataFrame:
    """(block, chunk, visitor, node, mark): the rows with a partner within the block's budget."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, waiting, home = None, [], None

        def settled() -> _Sides | None:
            nonlocal home
            if home is None and waiting:
                home = _Sides(pd.concat(waiting, ignore_index=True))
                waiting.clear()
                home.meet(home, budget)
            return home

        for frame in frames:
            for now, group in frame.groupby(["block", "chunk"], sort=True):
                if now != key:
                    if settled():
                        yield home.members()
                    key, home = now, None
                mine, visiting = group[group.visitor == 0], group[group.visitor == 1]
                if len(mine):
                    waiting.append(mine)
                if len(visiting) and settled():
                    other = _Sides(visiting)
                    home.meet(other, budget)
                    yield other.members()
        if settled():
            yield home.members()

    schema = "block int, chunk long, visitor int, node long, mark long"
    return _by_chunk(assigned).mapInPandas(freed(run), schema)


class _Resident:
    """The vectors at home in a chunk, and what has been found about them."""

    def __init__(self, threshold: float, budget: float) -> None:
        self.threshold, self.budget = threshold, budget
        self.parts: list[pd.DataFrame] = []

    def settle(self, block: int, width: int) -> None:
        frame = pd.concat(self.parts, ignore_index=True)
        self.block = block
        self.node, self.weight = frame.node.to_numpy(), frame.weight.to_numpy()
        self.mark = frame.mark.to_numpy()
        self.length = frame.v.map(len).to_numpy()
        self.unit = unit(_padded(frame.v, width))
        self.turned = rotated(self.unit).astype(np.float32)
        cut = slice(block * BLOCK, (block + 1) * BLOCK)
        self.side = self.turned[:, cut]
        self.square = (self.side * self.side).sum(axis=1)
        self.links = np.zeros(len(frame), dtype=np.int64)
        self.root = np.arange(len(frame))

    def find(self, rows: np.ndarray) -> np.ndarray:
        while True:
            up = self.root[rows]
            if np.array_equal(up, self.root[up]):
                return up
            self.root[rows] = rows = self.root[up]

    def linked(self, a: np.ndarray, b: np.ndarray, other: _Resident) -> np.ndarray:
        """Which of the candidates (row of other, row of self) link and count in this block."""
        out = np.zeros(len(a), dtype=bool)
        for i in range(0, len(a), PAIRS):
            x, y = a[i : i + PAIRS], b[i : i + PAIRS]
            alike = (other.unit[x] * self.unit[y]).sum(axis=1) >= self.threshold
            alike &= other.length[x] == self.length[y]
            at = np.flatnonzero(alike)
            x, y = x[at], y[at]
            step = other.turned[x].astype(np.float64) - self.turned[y]
            step *= step
            earlier = np.zeros(len(at), dtype=bool)
            for block in range(self.block + 1):
                total = np.zeros(len(at))
                for j in range(block * BLOCK, (block + 1) * BLOCK):
                    total += step[:, j]
                within = total <= self.budget + SLACK / 10
                if block < self.block:
                    earlier |= within
            out[i + at[within & ~earlier]] = True
        return out

    def meet(self, other: _Resident, own: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links (row of other, row of self), some rows of other at a time."""
        for first in range(0, len(other.node), VISITORS):
            rows = slice(first, first + VISITORS)
            far = other.square[rows, None] + self.square - 2 * other.side[rows] @ self.side.T
            a, b = np.nonzero(far <= self.budget + SLACK)
            a = a + first
            if own:
                a, b = a[b > a], b[b > a]
            good = self.linked(a, b, other)
            yield a[good], b[good]


def _found(assigned: DataFrame, width: int, threshold: float, budget: float) -> DataFrame:
    """(node, mark, other, other_mark, links): link counts with a null other, and forest edges."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, home, settled = None, None, False

        def settle() -> Iterator[pd.DataFrame]:
            home.settle(key[0], width)
            for a, b in home.meet(home, own=True):
                np.add.at(home.links, a, home.weight[b])
                np.add.at(home.links, b, home.weight[a])
                yield from joined(a, b, home)

        def joined(a: np.ndarray, b: np.ndarray, other: _Resident) -> Iterator[pd.DataFrame]:
            """Unites the residents b that a links; returns the edges this takes."""
            edges = []
            cuts = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else []
            for x, group in zip(a[cuts], np.split(b, cuts[1:]), strict=True) if len(a) else []:
                members = np.append(group, x) if other is home else group
                roots = np.unique(home.find(members))
                home.root[roots] = roots[0]
                first = home.node[roots[0]], home.mark[roots[0]]
                edges += [(*first, home.node[r], home.mark[r]) for r in roots[1:]]
                if other is not home:
                    edges.append((*first, other.node[x], other.mark[x]))
            if edges:
                yield pd.DataFrame(edges, columns=["node", "mark", "other", "other_mark"]).assign(links=0)

        def counts(some: _Resident) -> Iterator[pd.DataFrame]:
            at = np.flatnonzero(some.links)
            if len(at):
                rows = {"node": some.node[at], "mark": some.mark[at], "links": some.links[at]}
                yield pd.DataFrame(rows).assign(other=None, other_mark=None)

        for frame in frames:
            for now, group in frame.groupby(["block", "chunk"], sort=True):
                if now != key:
                    if home and home.parts:
                        if not settled:
                            yield from settle()
                        yield from counts(home)
                    key, home, settled = now, _Resident(threshold, budget), False
                mine, visiting = group[group.visitor == 0], group[group.visitor == 1]
                if len(mine):
                    home.parts.append(mine)
                if len(visiting) and home.parts:
                    if not settled:
                        yield from settle()
                        settled = True
                    other = _Resident(threshold, budget)
                    other.parts.append(visiting)
                    other.settle(key[0], width)
                    for a, b in home.meet(other, own=False):
                        np.add.at(home.links, b, other.weight[a])
                        np.add.at(other.links, a, home.weight[b])
                        yield from joined(a, b, other)
                    yield from counts(other)
        if home and home.parts:
            if not settled:
                yield from settle()
            yield from counts(home)

    return _by_chunk(assigned).mapInPandas(freed(run), FOUND)


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.9, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors linked directly), component_id (the
    smallest vec_id that links reach, itself included), kept (whether that is its own id).

    Vectors link with a cosine of threshold (over 0) or more. Null, empty and zero vectors, those
    with a null or non-finite component, and those of different lengths do not link. Equal
    vectors are compared once and counted as often as they occur; so are rows that repeat a
    vec_id, which count as vectors of their own. A null vec_id does not link, and its component_id
    and kept are null. Other columns are not looked at."""
    rows = _linkable(vectors, vec_id, embedding)
    usable = rows.where("good and vec_id is not null")
    nodes = usable.groupBy("v").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
    # a number, fixed once it is written, tells vectors apart that share a vec_id
    nodes = stored(nodes.withColumn("mark", F.monotonically_increasing_id()), "vectors")
    count, longest = nodes.agg(F.count("*"), F.max(F.size("v"))).first()
    empty = rows.sparkSession.createDataFrame([], FOUND)
    found = empty
    if count:
        width = max(BLOCK, 1 << (longest - 1).bit_length())
        blocks = width // BLOCK
        budget = (2 - 2 * threshold) / blocks
        cells = _cells(nodes, count, blocks) if longest else []
        _counted(nodes, cells, width)
        assigned = _assigned(nodes, cells, width, float(np.sqrt(budget)))
        close = stored(_close(assigned, budget), "close")
        members = close.join(nodes, ["node", "mark"])
        found = stored(_found(members, width, threshold, budget), "found")
    links = found.where("other is null").groupBy("node", "mark").agg(F.sum("links").alias("links"))
    # ordered by vec_id first, so that the least end of a component has its smallest vec_id
    there = F.struct(F.col("other").alias("node"), F.col("other_mark").alias("mark"))
    edges = found.where("other is not null").select(F.struct("node", "mark").alias("u"), there.alias("v"))
    joined = components(edges)
    joined = joined.select("id.node", "id.mark", F.col("component.node").alias("component"))
    summed = (
        nodes.join(links, ["node", "mark"], "left")
        .join(joined, ["node", "mark"], "left")
        .select(
            "v",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    linked = rows.where("good and vec_id is not null").join(stored(summed, "summed"), "v", "left")
    rest = rows.where("not good or vec_id is null").withColumns({"links": F.lit(0), "component": F.col("vec_id")})
    columns = ["vec_id", F.col("links").cast("long").alias("n_links"), F.col("component").alias("component_id")]
    out = linked.select(*columns).unionByName(rest.select(*columns))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
