"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations.

1. Targets: sources by code point get weights in turn and share a budget by weight; a target
   stops at a multiple of its source's size and the excess goes to the others. With sources
   sorted by how soon they stop this is a running sum over one row per source.
2. Complete epochs of a source come first. What remains of its target is drawn without
   replacement: a document of quality weight w gets the key -ln(u)/w, with u in (0, 1) from a
   hash of its id, and documents are taken by ascending key while the running sum of their sizes
   stays nearest the remainder.
3. The running sum is taken in two levels, so that no source has to fit into one task: keys fall
   into ranges of about RANGE documents, ranges are summed, and documents are summed within one.
   A key of quality w is below x with a probability of 1 - exp(-w x); the mean of that over the
   qualities a source has, counted in BINS, says in which range a key lies. Documents without
   words take no part: they cost nothing and change no sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.tables import stored

#: Fixed values of the contract: weights in turn, share of all sizes, most copies of a source.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Documents in a range of keys; steps of quality that are counted for one source.
RANGE, BINS = 2048, 40
#: Characters that speak against a document; lowest quality weight.
SYMBOLS, LEAST = "0123456789#$%&*!|<>{}[]\\/=_~^@+", 0.05
SEED = "mix"


def size_of(text: Column) -> Column:
    """Words: runs of characters other than ASCII blanks; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_of(text: Column) -> Column:
    """The share of characters that are not symbols, at least LEAST; LEAST for an empty text."""
    plain = F.length(F.translate(text, SYMBOLS, "")) / F.length(text)
    return F.greatest(F.coalesce(F.when(F.length(text) > 0, plain), F.lit(LEAST)), F.lit(LEAST))


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """In (0, 1), from 52 bits of a hash of seed and id; the same on every run."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, n, quality, target) from rows of (source, size, quality).

    One row per source; a null source is a source of its own and the last. Sources are what the
    weights are given for, so they are few beside documents: their order and their running sums
    are windows over one row each."""
    sources = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n"), F.avg("quality").alias("quality")
    )
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)), F.pmod(place, F.lit(len(WEIGHTS))) + 1)
    most = (F.col("source_size") * MOST).cast("double")
    whole = Window.partitionBy()
    # sources that stop first; ties stop together, whatever their order
    stops = Window.orderBy((F.col("most") / F.col("weight")), F.col("source").asc_nulls_last())
    upto = stops.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (
        sources.withColumn("weight", weight)
        .withColumn("most", most)
        .withColumn("total", F.lit(SHARE) * F.sum("source_size").over(whole))
        .withColumn("weights", F.sum("weight").over(whole))
        .withColumn("before_most", F.sum("most").over(upto) - F.col("most"))
        .withColumn("before_weight", F.sum("weight").over(upto) - F.col("weight"))
        .withColumn(
            "level", (F.col("total") - F.col("before_most")) / (F.col("weights") - F.col("before_weight"))
        )
    )
    # the level at the first source that does not stop holds for it and all after it
    open_ = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))
    level = F.first(open_, ignorenulls=True).over(upto)
    target = F.coalesce(F.least(level * F.col("weight"), F.col("most")), F.col("most"))
    return ranked.withColumn("target", target).select("source", "source_size", "n", "quality", "target")


def mix(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: str = SEED,
    row: str | None = None,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target (of its source), copies
    (how often the mix takes it: 0, 1 or 2) and taken (words taken, copies * size).

    A null text has size 0; documents of size 0 are in every complete epoch and cost nothing. A
    null source is a source. Rows that repeat a doc_id are documents of their own with equal keys, in
    order of size; those without an id draw by their text's hash. Rows with one key share a range. An empty table gives no rows. A source's taken words
    differ from its target by at most half of one document's size, plus rounding.

    row is a column that tells rows apart: it decides between documents with equal keys and sizes
    and is a further column of the result, under its own name."""
    own = [row] if row else []
    sizes = stored(
        documents.select(
            *own,
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            size_of(F.col(text)).alias("size"),
            quality_of(F.col(text)).alias("quality"),
            F.when(F.isnull(doc_id), F.xxhash64(text)).alias("salt"),
        ),
        "sizes",
    )
    targets = stored(source_targets(sizes), "targets").drop("quality", "n")
    keyed = sizes.join(F.broadcast(targets) if _few(targets) else targets, _same("source", sizes, targets)).select(
        *own, "doc_id", sizes.source, "size", "source_size", "target", "quality", "salt"
    )
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("?"), F.col("salt").cast("string")))
    keyed = keyed.withColumn("key", -F.log(uniform(name, seed)) / F.col("quality"))
    keyed = keyed.withColumn("group", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")))
    held = F.col("size") > 0
    bins = keyed.where(held).groupBy("group", F.floor(F.col("quality") * BINS).alias("bin"))
    bins = bins.agg(F.count("*").alias("n"), F.avg("quality").alias("w")).groupBy("group")
    bins = stored(bins.agg(F.sum("n").alias("n"), F.collect_list(F.struct("n", "w")).alias("bins")), "bins")
    placed = keyed.where(held).join(F.broadcast(bins) if _few(bins) else bins, "group")
    below_key = F.aggregate("bins", F.lit(0.0), lambda sum_, b: sum_ + b["n"] * (1 - F.exp(-F.col("key") * b["w"])))
    ranges = F.ceil(F.col("n") / RANGE)
    place = F.floor(below_key / F.col("n") * ranges)
    placed = stored(placed.withColumn("range", F.least(place, ranges - 1)).drop("bins", "n"), "placed")
    sums = placed.groupBy("group", "range").agg(F.sum("size").alias("held"))
    below = F.sum("held").over(Window.partitionBy("group").orderBy("range")) - F.col("held")
    starts = sums.select("group", "range", below.alias("below"))
    order = Window.partitionBy("group", "range").orderBy("key", F.col("doc_id").asc_nulls_last(), "size", *own)
    inside = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = placed.withColumn("inside", inside).join(starts, ["group", "range"])
    none = F.lit(0).cast("long")
    free = keyed.where(~held).withColumn("inside", none).withColumn("below", none)
    columns = [*own, "doc_id", "source", "size", "source_size", "target", "inside", "below"]
    summed = summed.select(columns).unionByName(free.select(columns))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1)
    remainder = F.col("target") - F.col("epochs") * F.col("source_size")
    drawn = (F.col("below") + F.col("inside") - F.col("size") / 2) <= remainder
    chosen = summed.withColumn("epochs", epochs).withColumn(
        "copies", (F.col("epochs") + F.when(drawn & (remainder > 0) & (F.col("size") > 0), 1).otherwise(0)).cast("int")
    )
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return chosen.select(*own, "doc_id", "source", "size", "source_size", "target", "copies", taken)


def _same(column: str, a: DataFrame, b: DataFrame) -> Column:
    return a[column].eqNullSafe(b[column])


def _few(targets: DataFrame) -> bool:
    """Whether the rows per source are proven small: under 100,000 of them."""
    return targets.limit(100_000).count() < 100_000
