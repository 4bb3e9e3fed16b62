"""Run counts, anomaly rates, schema drift and dynamic fields."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.contract import CORRUPT, ERROR
from eventlake.functions.parsing import event_date, instant


def count_metrics() -> list[Column]:
    """Aggregates over classified rows, for a query or for an Observation."""
    return [
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count_if(F.isnull(ERROR)).alias("good_rows"),
        F.count_if(F.isnotnull(ERROR)).alias("bad_rows"),
    ]


def run_counts(classified: DataFrame) -> DataFrame:
    return classified.agg(*count_metrics())


def rejection_rate(classified: DataFrame) -> DataFrame:
    """Rejected rows in percent, to two decimals; NULL when there are no rows."""
    return run_counts(classified).select(
        percent(F.col("bad_rows"), F.col("bronze_rows")).alias("rejection_rate")
    )


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 2)


def anomalies(classified: DataFrame) -> DataFrame:
    """Rejected rows by event day and rule, with their share of that day's rows.

    Rows whose timestamp is unreadable form the NULL day.
    """
    per_rule = classified.groupBy(event_date().alias("event_date"), ERROR).agg(
        F.count("*").alias("rows")
    )
    return _rates(per_rule)


def _rates(per_rule: DataFrame) -> DataFrame:
    # The window runs over the few (day, rule) totals, not over events.
    all_rows = F.sum("rows").over(Window.partitionBy("event_date"))
    return (
        per_rule.withColumn("rate", percent(F.col("rows"), all_rows))
        .where(F.isnotnull(ERROR))
        .select("event_date", ERROR, "rows", "rate")
    )


def stored_anomalies(rejected: DataFrame, silver: DataFrame) -> DataFrame:
    """The same rates from the tables: rejected rows by day and rule, silver rows by day.

    Silver is only counted by partition, which reads no column of it.
    """
    bad = rejected.groupBy(F.to_date(instant("event_timestamp")).alias("event_date"), ERROR).agg(
        F.count("*").alias("rows")
    )
    good = silver.groupBy("event_date").agg(F.count("*").alias("rows"))
    per_rule = bad.unionByName(good.withColumn(ERROR, F.lit(None).cast("string")))
    return _rates(per_rule)


def schema_drift(lines: DataFrame, text: str, contract: tuple[str, ...]) -> DataFrame:
    """Top-level JSON keys against a contract: ``ok``, ``unexpected`` or ``missing``.

    ``rows`` counts the lines a key is seen in.
    """
    seen = (
        lines.select(F.explode(F.array_distinct(F.json_object_keys(text))).alias("field"))
        .groupBy("field")
        .agg(F.count("*").alias("rows"))
        .withColumn("seen", F.lit(True))
    )
    expected = lines.sparkSession.range(1).select(
        F.explode(F.array(*map(F.lit, contract))).alias("field"), F.lit(True).alias("expected")
    )
    status = (
        F.when(F.isnull("expected"), "unexpected").when(F.isnull("seen"), "missing").otherwise("ok")
    )
    return seen.join(expected, "field", "full").select(
        "field",
        F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"),
        status.alias("status"),
    )


def dynamic_fields(lines: DataFrame, text: str, fields: tuple[str, ...]) -> DataFrame:
    """Read any top-level field by name from rows loaded as a map; values stay text."""
    loaded = lines.withColumn("_map", F.from_json(text, "map<string,string>"))
    return loaded.select(
        *(c for c in lines.columns if c not in (text, CORRUPT)),
        *(F.col("_map")[field].alias(field) for field in fields),
    )


def dynamic_paths(lines: DataFrame, text: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Fields at any depth by JSON path and type, such as ``{"city": ("$.user.address[0].city",
    "string")}``, beside the other columns.

    A path that a row lacks, a value that does not fit its type, and text that is no JSON give
    NULL. Text is parsed once for all fields."""
    taken = {*lines.columns, *fields}
    name = next(x for x in ("_json", "_json_", "_json__", *(f"_json{i}" for i in range(len(taken)))) if x not in taken)
    parsed = lines.withColumn(name, F.try_parse_json(text))
    return parsed.select(
        *(F.col(f"`{c}`") for c in lines.columns if c not in (text, CORRUPT, *fields)),
        *(F.try_variant_get(name, path, kind).alias(field) for field, (path, kind) in fields.items()),
    )


def field_types(lines: DataFrame, text: str, day: str) -> DataFrame:
    """(day, path, type, rows) of every field at any depth, merged over a day's lines: ``user.id``
    is a field of an object, ``tags[]`` an array's elements; the type of fields of several types
    is ``variant``, that of fields that are always null ``void``. ``rows`` counts the day's lines.

    Lines are merged before they are shuffled; a day leaves one row, which the driver takes apart.
    """
    parsed = lines.select(F.col(day).alias("day"), F.try_parse_json(text).alias("v"))
    merged = parsed.where("v is not null").groupBy("day")
    merged = merged.agg(F.schema_of_variant_agg("v").alias("schema"), F.count("*").alias("rows"))
    rows = [(r.day, path, kind, r.rows) for r in merged.collect() for path, kind in _flat(r.schema)]
    kind = lines.schema[day].dataType.simpleString()
    return lines.sparkSession.createDataFrame(rows, f"day {kind}, path string, type string, rows long")


def _flat(schema: str) -> list[tuple[str, str]]:
    """Paths and types of a variant's schema; a value that is no object has the empty path."""

    def walk(path: str, kind: T.DataType):
        if isinstance(kind, T.StructType):
            for field in kind.fields:
                yield from walk(f"{path}.{field.name}" if path else field.name, field.dataType)
        elif isinstance(kind, T.ArrayType):
            yield from walk(f"{path}[]", kind.elementType)
        else:
            yield path, "decimal" if isinstance(kind, T.DecimalType) else kind.simpleString()

    # objects are structs to the type parser, but for empty ones
    return list(walk("", T.DataType.fromDDL(schema.replace("OBJECT<>", "VOID").replace("OBJECT<", "STRUCT<"))))


def type_changes(types: DataFrame) -> DataFrame:
    """Fields whose type is not that of the day before on which there were lines: (day, path, type,
    type_before, status), the status ``new``, ``gone`` or ``changed``. The first day has none.

    ``types`` has a row for each field and day, so windows run over few rows."""
    days = types.select("day").distinct()
    step = days.withColumn("next_day", F.lead("day").over(Window.orderBy("day"))).where("next_day is not null")
    old = types.join(step, "day").select(F.col("next_day").alias("day"), "path", F.col("type").alias("type_before"))
    new = types.join(step.select(F.col("next_day").alias("day")), "day").select("day", "path", "type")
    both = old.join(new, ["day", "path"], "full").where("type is distinct from type_before")
    status = F.when(F.isnull("type_before"), "new").when(F.isnull("type"), "gone").otherwise("changed")
    return both.select("day", "path", "type", "type_before", status.alias("status"))
