"""A corpus in five stages: each reads what the one before has kept and writes what it keeps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import jaccard_join, language_id, mixing, pii, sentence_pieces
from eventlake.llm.tables import free_names, numbered, stored

import public_tokenizers  # after the operators: without them nothing here is wanted

PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Lowest probability of the language found.
SURE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is one of the corpus and clear; their lang is what was found.
    Null and empty texts and those without letters have no language and go."""
    lang, score = free_names(docs, "_lang", "_score")
    model = language_id.trained(docs, PIECES)
    found = language_id.identified(docs, model, lang_pred=lang, score=score)
    sure = found.where((F.col(lang) != language_id.UNDETERMINED) & (F.col(score) >= SURE))
    return _like(sure.withColumn("lang", F.col(lang)), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links connect, one row stays: that with the smallest doc_id, or one
    without an id if no other is in the group. Rows are told apart by where they are stored, so
    rows that repeat a doc_id or have none are rows like any other. Null texts and those without
    words link with nothing and stay."""
    row, head, name = free_names(docs, "_row", "_head", "_id")
    rows = numbered(docs, row)
    groups = jaccard_join.jaccard_components(rows, doc_id=row).where("doc_id <> component_id")
    linked = stored(groups.select(F.col("doc_id").alias(row), F.col("component_id").alias(head)), "linked")
    # written, as the join below would be pushed under distinct() and meet all rows of a group
    heads = stored(linked.select(head).distinct(), "heads")
    linked = linked.union(heads.select(F.col(head), head))
    # the same plans at every size: a broadcast would only do for small tables
    ids = rows.select(row, F.col("doc_id").alias(name)).hint("merge").join(linked, row)
    first = F.min(F.struct(F.col(name).isNull().alias("unnamed"), name, row))
    first = stored(ids.groupBy(head).agg(first.alias("first")).select(f"first.{row}"), "first")
    surplus = stored(linked.hint("merge").join(first, row, "left_anti").select(row), "surplus")
    return _like(rows.hint("merge").join(surplus, row, "left_anti"), docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with each span of personal data replaced by its kind in brackets. A null
    text stays null."""
    (name,) = free_names(docs, "_spans")
    found = pii.with_spans(docs, pii.fitted(docs), name=name)
    clean = found.withColumn("text", pii.redacted(F.col("text"), F.col(name)))
    return _like(clean.withColumn("n_chars", F.length("text").cast("long")), docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it. Rows are told apart by where they are stored,
    so each that repeats a doc_id, or has none, is taken as often as the mix takes this row."""
    row, copies, copy = free_names(docs, "_row", "_copies", "_copy")
    rows = numbered(docs, row)
    mixed = mixing.mix(rows, row=row).where("copies > 0")
    joined = rows.hint("merge").join(stored(mixed.select(row, F.col("copies").alias(copies)), "copies"), row)
    return _like(joined.withColumn(copy, F.explode(F.sequence(F.lit(1), copies))), docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as token ids: doc_id, lang, source, n_tokens, ids (little-endian unsigned 32-bit
    integers) and whether they decode to the text. A null text is encoded as empty."""
    rows = docs.select("doc_id", "lang", "source", "text")
    rows = rows.withColumn("sha256", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    found = sentence_pieces.encode_decode(rows, PIECES)
    return found.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        (F.sha2(F.col("decoded").cast("binary"), 256) == F.col("sha256")).alias("decodes"),
    )


def _like(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("near_duplicates", near_duplicates),
    ("personal_data", without_personal_data),
    ("source_mix", mixed_sources),
    ("sentencepiece", encoded),
]

#: Models and tokenizers are not for SQL: tests/llm compares the stages with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
