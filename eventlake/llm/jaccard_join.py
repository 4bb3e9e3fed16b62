"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact sorted-array intersection.

1. A pass over all texts counts shingles into a hashed sketch of fixed size. It only serves to
   order shingles, rare ones first; any order that all documents share gives the same links.
2. Each document's distinct shingles become one sorted array, a bitmap of hashed bits, and a
   prefix: sets of n and m elements with a Jaccard similarity of t or more share an element of
   their first n - ceil(t n) + 1 elements in the common order. Documents with equal sets are one
   node from here on, so copies cost nothing.
3. Shingles that two different nodes have in their prefixes make lists. Every list goes to the
   tile of its smallest node, so all pairs that share a prefix element meet in some tile, and a
   node is in few tiles. Large tiles are cut into chunks and every pair of chunks gets a tile.
4. Within a tile nodes are sorted by size and compared within the size band that the threshold
   allows. For sets A and B, the bits of A that B lacks bound the overlap from above:
   |A & B| <= |A| - bits(A and not B). Pairs that the bounds cannot exclude keep their nodes.
5. Nodes kept get their sorted arrays; in the same tiles the bounds are followed by the exact
   intersection. A tile returns a spanning forest of its links, or every link if asked.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.components import components
from eventlake.llm.tables import freed, parts, settle, stored
from eventlake.llm.words import mix, shingle_sets

#: Counters of the sketch and of one of its blocks; the sketch is 4 MB whatever the input.
SKETCH, BLOCK = 1 << 20, 1 << 14
#: 64-bit words of the narrowest and the widest signature.
NARROW, WIDE = 8, 1 << 14
#: Weight of a chunk of a tile of signatures: a node counts 1, and 1 more for every KB of its
#: signature. Pairs listed and 64-bit words compared at once in a tile.
TILE, PAIRS, WORDS = 1024, 1 << 18, 1 << 21
#: Shingles in a chunk of a tile of sets.
CHUNK_SHINGLES = 1 << 20


def _texts(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))


def shingle_sketch(texts: DataFrame, k: int) -> np.ndarray:
    """How many documents hold a shingle, summed over shingles with equal low hash bits."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, dtype=np.uint32)
        for batch in batches:
            found = shingle_sets(batch.column("text"), k)
            while some := list(islice(found, 500)):
                slots = (np.concatenate(some) & np.uint64(SKETCH - 1)).astype(np.int64)
                total += np.bincount(slots, minlength=SKETCH).astype(np.uint32)
        blocks = [row.tobytes() for row in total.reshape(-1, BLOCK)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(blocks)), pa.int32()), pa.array(blocks, pa.binary())], ["block", "counts"]
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts = np.frombuffer(counts.as_buffer(), dtype=np.uint32)
                total[block] = total[block] + counts if block in total else counts.astype(np.uint64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
            ["block", "counts"],
        )

    schema = "block int, counts binary"
    counted = texts.select("text").mapInArrow(freed(count), schema)
    summed = counted.repartition(SKETCH // BLOCK, "block").mapInArrow(freed(add), schema)
    sketch = np.zeros(SKETCH, dtype=np.uint64)
    for row in summed.collect():
        sketch[row.block * BLOCK : (row.block + 1) * BLOCK] = np.frombuffer(row.counts, dtype=np.uint64)
    return sketch


def signature(hashes: np.ndarray) -> np.ndarray:
    """64-bit words with bits set at hashed positions. The width, a power of two, goes with the
    size band of the set: two to four bits for each element."""
    words = min(max(NARROW, 1 << (len(hashes) // 32).bit_length()), WIDE)
    bits = np.zeros(words * 64, dtype=np.uint8)
    bits[hashes >> np.uint64(33) & np.uint64(words * 64 - 1)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Signatures, one per row, as those of a lesser width: halves laid over each other."""
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


class Signatures:
    """Signatures of different widths, compared pair by pair at the lesser width of both."""

    def __init__(self, rows: list[bytes]) -> None:
        self.words = np.array([len(x) // 8 for x in rows])
        self.own = {}
        self.at = np.zeros(len(rows), dtype=np.int64)
        for words in np.unique(self.words).tolist():
            where = np.flatnonzero(self.words == words)
            self.own[words] = np.frombuffer(b"".join(rows[i] for i in where), dtype=np.uint64).reshape(-1, words)
            self.at[where] = np.arange(len(where))

    def _of(self, rows: np.ndarray, words: int) -> np.ndarray:
        out = np.empty((len(rows), words), dtype=np.uint64)
        width = self.words[rows]
        for own in np.unique(width).tolist():
            here = width == own
            out[here] = folded(self.own[own][self.at[rows[here]]], words)
        return out

    def lacking(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many bits of a are not in b, and of b not in a, for every pair."""
        out = np.empty((2, len(a)), dtype=np.int64)
        least = np.minimum(self.words[a], self.words[b])
        for words in np.unique(least).tolist():
            pairs = np.flatnonzero(least == words)
            for part in np.array_split(pairs, -(-len(pairs) * words // WORDS)):
                x, y = self._of(a[part], words), self._of(b[part], words)
                out[0, part] = np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64)
                out[1, part] = np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64)
        return out[0], out[1]


def digest(own: np.ndarray) -> int | None:
    """The node of a set: equal sets, and they alone up to 64-bit collisions, share it."""
    if not len(own):
        return None
    return int(mix(np.bitwise_xor.reduce(mix(own), keepdims=True) + np.uint64(len(own))).view(np.int64)[0])


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def shingled(texts: DataFrame, k: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """doc_id, size of the set, its 64-bit digest (node; null if empty), signature and prefix."""
    shared = texts.sparkSession.sparkContext.broadcast(sketch)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity = shared.value
        for batch in batches:
            size, node, bits, prefix = [], [], [], []
            for own in shingle_sets(batch.column("text"), k):
                size.append(len(own))
                if not len(own):
                    node.append(None), bits.append(None), prefix.append(None)
                    continue
                node.append(digest(own))
                bits.append(signature(own).tobytes())
                order = np.argsort(rarity[(own & np.uint64(SKETCH - 1)).astype(np.int64)], kind="stable")
                prefix.append(own[order[: prefix_length(len(own), percent)]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(size, pa.int64()),
                    pa.array(node, pa.int64()),
                    pa.array(bits, pa.binary()),
                    pa.array(prefix, pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "node", "bits", "prefix"],
            )

    return texts.mapInArrow(freed(build), "doc_id long, n long, node long, bits binary, prefix array<long>")


def _tiles(groups: DataFrame, weight: str, most: int) -> DataFrame:
    """Tiles of bounded weight: a group over the bound is cut into chunks, and every two chunks
    (and every chunk with itself) meet in one tile."""
    weights = groups.groupBy("pivot").agg(F.ceil(F.sum(weight) / F.lit(most)).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("node", F.lit(7)), F.col("chunks")).cast("int")
    return (
        groups.join(stored(weights.where("chunks > 1"), "weights"), "pivot", "left")
        .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        .withColumn("chunk", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("low", F.least("chunk", "other"))
        .withColumn("high", F.greatest("chunk", "other"))
        .drop("chunks", "other")
    )


def _by_tile(rows: DataFrame) -> DataFrame:
    tile = ["pivot", "low", "high"]
    return rows.repartition(parts(rows.sparkSession), *tile).sortWithinPartitions(*tile, "n", "node")


def _whole_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables in which no tile is cut off; rows come sorted by tile."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("pivot", "low", "high")]
        change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
        first = [k[0] for k in key]
        if held and first != [held[-1].column(c)[-1].as_py() for c in ("pivot", "low", "high")]:
            yield pa.Table.from_batches(held)
            held = []
        if len(change):
            yield pa.Table.from_batches([*held, batch.slice(0, change[-1])])
            held = [batch.slice(change[-1])]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _close_pairs(table: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one tile that sizes and signatures cannot exclude, some at a time.

    Rows are sorted by tile and size; row i meets the rows after it, up to the size that the
    threshold allows. In a tile of two chunks only rows of different chunks meet."""
    pivot, low, high, chunk, n = (
        table.column(c).to_numpy().astype(np.int64) for c in ("pivot", "low", "high", "chunk", "n")
    )
    bits = Signatures(table.column("bits").to_pylist())
    new = np.flatnonzero(
        np.r_[True, (pivot[1:] != pivot[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])]
    )
    end = np.r_[new[1:], len(n)]
    tile = np.repeat(np.arange(len(new)), end - new)
    # the last partner of row i: sizes rise within a tile
    scale = int(n.max()) * 100 // percent + 2
    last = np.searchsorted(tile * scale + n, tile * scale + n * 100 // percent, side="right")
    partners = last - np.arange(len(n)) - 1
    done = 0
    while done < len(n):
        upto = done + max(1, int(np.searchsorted(np.cumsum(partners[done:]), PAIRS, side="right")))
        rows = np.arange(done, min(upto, len(n)))
        count = partners[rows]
        a = np.repeat(rows, count)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
        meet = (chunk[a] != chunk[b]) | (low[a] == high[a])
        a, b = a[meet], b[meet]
        both = n[a] + n[b]
        need = -(-percent * both // (100 + percent))
        lacking_a, lacking_b = bits.lacking(a, b)
        close = np.minimum(n[a] - lacking_a, n[b] - lacking_b) >= need
        if close.any():
            yield a[close], b[close]
        done = rows[-1] + 1


def close_members(tiles: DataFrame, percent: int) -> DataFrame:
    """Rows of tiles that have a partner which sizes and signatures cannot exclude."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_tiles(batches):
            kept = np.zeros(len(table), dtype=bool)
            for a, b in _close_pairs(table, percent):
                kept[a] = kept[b] = True
            yield from table.filter(pa.array(kept)).to_batches()

    return _by_tile(tiles).mapInArrow(freed(keep), tiles.schema)


def _overlaps(sets: list[np.ndarray], a: int, others: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of one sorted array with others."""
    lengths = np.array([len(sets[b]) for b in others])
    flat = np.concatenate([sets[b] for b in others])
    own = sets[a]
    at = np.searchsorted(own, flat)
    found = own[np.minimum(at, len(own) - 1)] == flat
    return np.add.reduceat(found, np.cumsum(lengths) - lengths, dtype=np.int64)


def verified_links(tiles: DataFrame, percent: int, every_link: bool) -> DataFrame:
    """Links (u, v) between the doc ids of nodes. Without every_link a pair that other links of
    the tile already connect is not compared: the links returned span the same components."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_tiles(batches):
            sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in table.column("shingles").combine_chunks()]
            n = table.column("n").to_numpy()
            ids = table.column("doc").to_numpy()
            root = np.arange(len(n))
            u, v = [], []
            for a, b in _close_pairs(table, percent):
                cuts = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
                for first, others in zip(a[cuts], np.split(b, cuts[1:]), strict=True):
                    if not every_link:
                        others = others[root[others] != root[first]]
                    if not len(others):
                        continue
                    both = _overlaps(sets, first, others)
                    linked = others[100 * both >= percent * (n[first] + n[others] - both)]
                    u += [ids[first]] * len(linked)
                    v += ids[linked].tolist()
                    if len(linked) and not every_link:
                        root[np.isin(root, root[linked])] = root[first]
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return _by_tile(tiles).mapInArrow(freed(link), "u long, v long")


def _sets(texts: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """The sorted shingle array, as bytes, of each node wanted. Where rows repeat a doc_id, only
    those with the text that is wanted; where they repeat that too, one of them."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shingle_sets(batch.column("text"), k))
            right = [digest(x) == node for x, node in zip(found, batch.column("node").to_pylist(), strict=True)]
            arrays = pa.array([x.tobytes() for x in found], pa.binary())
            rows = pa.RecordBatch.from_arrays([batch.column("node"), arrays], ["node", "shingles"])
            yield rows.filter(pa.array(right, pa.bool_()))

    # the same plan at every size: a broadcast would only do for small tables
    rows = texts.hint("merge").join(wanted, texts.doc_id == wanted.doc).select("node", "text")
    return rows.mapInArrow(freed(build), "node long, shingles binary").dropDuplicates(["node"])


def jaccard_links(
    documents: DataFrame,
    k: int = 5,
    percent: int = 75,
    doc_id: str = "doc_id",
    text: str = "text",
    every_link: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Links (u, v) between representatives, and the membership (doc_id, n_shingles, doc) of all
    documents, where doc is the representative: the smallest doc_id with the same shingle set.

    A null or empty text, or one without words, has the empty set: n_shingles 0, doc its own id,
    no links. Rows with a null doc_id are members of their set but represent nothing; a set that
    only they have gets a null doc and no links. Repeated rows are members of the same set. Other
    columns of the table are not looked at."""
    settle(documents.sparkSession)
    texts = _texts(documents, doc_id, text)
    sketch = shingle_sketch(texts, k)
    sets = stored(shingled(texts, k, percent, sketch), "shingled")
    nodes = stored(
        sets.where("node is not null and doc_id is not null")
        .groupBy("node")
        .agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("bits").alias("bits")),
        "nodes",
    )
    postings = sets.where("doc_id is not null").select("node", F.explode("prefix").alias("shingle"))
    lists = postings.groupBy("shingle").agg(F.min("node").alias("pivot"), F.max("node").alias("most"))
    lists = stored(lists.where("pivot <> most").drop("most"), "lists")
    groups = postings.join(lists, "shingle").select("pivot", "node").distinct()
    tiles = _tiles(stored(groups.join(nodes, "node"), "groups").withColumn("weight", 1 + F.octet_length("bits") / 1024), "weight", TILE)
    close = stored(close_members(tiles, percent).select("pivot", "node", "n", "bits", "doc").distinct(), "close")
    arrays = stored(_sets(texts, stored(close.select("node", "doc").distinct(), "wanted"), k), "arrays")
    tiles = _tiles(close, "n", CHUNK_SHINGLES).join(arrays, "node")
    links = verified_links(tiles, percent, every_link)
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("doc"))
    members = sets.select("doc_id", "n", "node").join(nodes.select("node", "doc"), "node", "left")
    return links, members.select("doc_id", F.col("n").alias("n_shingles"), own.alias("doc"))


def jaccard_components(documents: DataFrame, k: int = 5, percent: int = 75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id that links
    reach, itself included). Null cases as in jaccard_links; a null doc_id without a partner has
    a null component_id."""
    links, members = jaccard_links(documents, k, percent, doc_id, text)
    joined = components(links).select(F.col("id").alias("doc"), "component")
    return members.join(joined, "doc", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc").alias("component_id")
    )
