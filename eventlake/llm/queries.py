"""One query per operator over its whole table, and the SQL that agrees with it where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import (
    collocations,
    embedding_join,
    fill_middle,
    impact_search,
    jaccard_join,
    language_id,
    mixing,
    packed_ids,
    pii,
    quality_model,
    sentence_pieces,
    warc,
    winnowing,
)
from eventlake.llm.tables import new_path

BYTE_BPE, BYTE_BPE_IDS, END_ID = public_tokenizers.path("byte_bpe_50k.json"), 50257, 0
PIECES = public_tokenizers.path("piece_bpe_32k.model")
GOOD = 0.7


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_winnowing_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edit_likeness(_table(spark, sf_dir, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op3_packed_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    files = packed_ids.write_packed(documents, new_path(spark, "ids"), BYTE_BPE, BYTE_BPE_IDS, END_ID)
    read = packed_ids.read_packed(spark, files, unnamed=True)
    n_tokens = (F.octet_length("ids") / 4).cast("long")
    return read.select("doc_id", "start", n_tokens.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op5_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.with_spans(documents, pii.fitted(documents))
    base = F.filter("spans", lambda x: x["base"])
    counts = (
        F.size(F.filter(base, pii.of_kind(k))).cast("long").alias(f"n_{k}")
        for k in pii.BASE
    )
    return found.select(
        "doc_id",
        *counts,
        F.size("spans").cast("long").alias("n_spans"),
        (F.size("spans") - F.size(base)).cast("long").alias("n_added"),
        F.sha2(pii.joined(base), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = language_id.trained(documents, PIECES)
    found = language_id.identified(documents.select("doc_id", "text"), model)
    return found.select("doc_id", language_id.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op7_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_round_trip(spark, _table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sentence_pieces.encode_decode(_table(spark, sf_dir, "documents").select("doc_id", "text"), PIECES)
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = quality_model.trained(documents, _table(spark, sf_dir, "labels"))
    found = quality_model.scored(documents, model)
    predicted = (F.col("score") >= GOOD).cast("int").alias("predicted")
    return found.select("doc_id", quality_model.held_out("doc_id").alias("held_out"), "score", predicted)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = fill_middle.restored(fill_middle.transformed(documents))
    digests = (F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12_impact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact_search.top_scores(_table(spark, sf_dir, "embeddings"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_winnowing_fingerprints,
        op2_embedding_near_dedup,
        op3_packed_token_ids,
        op4_ngram_jaccard_join,
        op5_pii_weak_supervision,
        op6_language_id,
        op7_warc_capture_index,
        op8_source_mixing,
        op9_sentencepiece,
        op10_quality_classifier,
        op11_fill_in_middle,
        op12_impact_top_k,
        op13_phrase_collocations,
    )
}

#: Components by following the smallest reachable id; for the few links of a small table.
_REACH = """
reach(id, via) AS (
  SELECT id, id FROM nodes
  UNION
  SELECT r.id, e.b FROM reach r JOIN edges e ON e.a = r.via
),
least AS (SELECT id, min(via) AS component_id FROM reach GROUP BY id)
"""

ORACLES: dict[str, str] = {
    "op2_embedding_near_dedup": f"""
WITH RECURSIVE nodes AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
edges AS (
  SELECT x.id AS a, y.id AS b FROM nodes x JOIN nodes y
    ON x.id <> y.id AND list_cosine_similarity(x.v, y.v) >= 0.9
),
{_REACH}
SELECT l.id AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, l.id = component_id AS kept
FROM least l LEFT JOIN (SELECT a, count(*) AS n FROM edges GROUP BY a) e ON e.a = l.id
""",
    "op4_ngram_jaccard_join": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, list_distinct(list_transform(
    range(1, greatest(len(w) - 4, least(len(w), 1)) + 1),
    lambda i: hash(array_to_string(w[i:i + 4], ' ')))) AS s
  FROM words
),
nodes AS (SELECT doc_id AS id, len(s) AS n FROM sets),
items AS (SELECT doc_id AS id, unnest(s) AS g FROM sets),
edges AS (
  SELECT x.id AS a, y.id AS b
  FROM items x JOIN items y ON x.g = y.g AND x.id <> y.id
  JOIN nodes p ON p.id = x.id JOIN nodes q ON q.id = y.id
  GROUP BY x.id, y.id
  HAVING 100 * count(*) >= 75 * (any_value(p.n) + any_value(q.n) - count(*))
),
{_REACH}
SELECT id AS doc_id, n::BIGINT AS n_shingles, component_id FROM least JOIN nodes USING (id)
""",
    "op7_warc_capture_index": """
WITH sha AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    sha1(coalesce(html, '')) AS h
  FROM pages
),
digests AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest
  FROM sha
),
best AS (SELECT payload_digest, max(page_id) AS r FROM digests GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = r THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> r THEN r END AS refers_to
FROM digests JOIN best USING (payload_digest)
""",
    "op8_source_mixing": r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    greatest(CASE WHEN length(text) > 0
      THEN length(translate(text, '0123456789#$%&*!|<>{}[]\/=_~^@+', '')) / length(text) ELSE 0.05 END, 0.05) AS q,
    (('0x' || substr(md5('mix:' || doc_id), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents
),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w
  FROM sizes GROUP BY source
),
steps AS (
  SELECT *, 2.0::DOUBLE * source_size AS most, 1.5::DOUBLE * sum(source_size) OVER () AS total, sum(w) OVER () AS ws,
    row_number() OVER (ORDER BY 2.0 * source_size / w, source NULLS LAST) AS k
  FROM src
),
levels AS (
  SELECT *, (total - (sum(most) OVER (ORDER BY k) - most)) / (ws - (sum(w) OVER (ORDER BY k) - w)) AS level FROM steps
),
cut AS (SELECT arg_min(level, k) AS open_level, min(k) AS k0 FROM levels WHERE level * w <= most),
targets AS (
  SELECT source, source_size, CASE WHEN k >= k0 THEN least(open_level * w, most) ELSE most END AS target
  FROM levels, cut
),
keyed AS (
  SELECT s.*, source_size, target, floor(target / source_size) AS epochs,
    sum(size) OVER (PARTITION BY s.source ORDER BY -ln(u) / q, doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM sizes s JOIN targets t ON t.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (epochs + CASE WHEN upto - size / 2 <= target - epochs * source_size
    AND target - epochs * source_size > 0 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM keyed
""",
    "op11_fill_in_middle": """
WITH tokens AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t,
    sha256('1:' || doc_id) AS h
  FROM documents
),
draws AS (
  SELECT doc_id, text, t, len(t) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM tokens
),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM draws
),
parts AS (
  SELECT *, array_to_string(t[1:a], '') AS p, array_to_string(t[a + 1:b], '') AS m, array_to_string(t[b + 1:n], '') AS s
  FROM cuts
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
""",
    "op12_impact_top_k": """
WITH codes AS (
  SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(64 * x)) AS v FROM embeddings
),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM codes q JOIN codes c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""",
    "op13_phrase_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM words GROUP BY lang),
places AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM words, (SELECT unnest([1, 2, 3, 4, 5]) AS m)
),
phrases AS (
  SELECT lang, phrase, m, count(*)::HUGEINT AS f FROM places GROUP BY ALL HAVING count(*) >= 100
),
inner_phrases AS (
  SELECT lang, f, unnest(list_transform(range(1, m - k + 2),
    lambda i: array_to_string(string_split(phrase, ' ')[i:i + k - 1], ' '))) AS phrase
  FROM phrases, (SELECT unnest([2, 3, 4]) AS k) WHERE k < m
),
covered AS (SELECT lang, phrase, max(f) AS cover FROM inner_phrases GROUP BY ALL),
kept AS (
  SELECT p.* FROM phrases p LEFT JOIN covered c USING (lang, phrase)
  WHERE m >= 2 AND (cover IS NULL OR 100 * cover < 100 * f)
),
cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
    array_to_string(string_split(phrase, ' ')[k + 1:m], ' ') AS tail
  FROM kept, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE k < m
),
scored AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, n, (1000 * a * n) // (x.f * y.f) AS score
  FROM cuts c JOIN phrases x ON x.lang = c.lang AND x.phrase = c.head
  JOIN phrases y ON y.lang = c.lang AND y.phrase = c.tail JOIN totals t ON t.lang = c.lang
),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
""",
}
