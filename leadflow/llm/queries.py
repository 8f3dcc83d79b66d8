"""The registered queries of the thirteen operators over whole tables, with their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadflow.llm import common as C
from leadflow.llm.decontaminate import INNER, NAME, NUMBER, UNIT, UNITS, contamination
from leadflow.llm.embedding_dedup import near_vectors
from leadflow.llm.fingerprints import edited_likeness, text_of
from leadflow.llm.hard_negatives import hard_negatives
from leadflow.llm.langid import predict
from leadflow.llm.langid import train as train_langid
from leadflow.llm.lexical import ranked
from leadflow.llm.line_dedup import line_dedup
from leadflow.llm.order_minhash import near_duplicates
from leadflow.llm.packing import pack
from leadflow.llm.quality import scorer
from leadflow.llm.quality import train as train_quality
from leadflow.llm.substring_dedup import remove_repeats
from leadflow.llm.token_counts import token_counts
from leadflow.llm.token_files import read_shards, write_shards
from leadflow.llm.tokens import default_vocabulary

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def add(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            C.ship(spark)
            return fn(spark, sf_dir)

        QUERIES[key] = run
        if oracle:
            ORACLES[key] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id and text only: the other columns are never inputs of these queries."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@query("op1_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").filter(C.crc_mod(F.col("doc_id"), 3) != 1)
    scored = C.id_and_text(docs).select("_id", scorer(spark, train_quality(docs, labels))("_text").alias("score"))
    return scored.select(C.public_id(), (C.crc_mod(F.col("_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op2_embedding_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return found.select(C.public_id(out="vec_id"), "n_links", C.public_id("component_id", "component_id"), "kept")


@query("op3_substring_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(documents(spark, sf_dir))
    return out.select(C.public_id(), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_token_files")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = C.scratch_dir(spark, "token-files")
    shards = write_shards(documents(spark, sf_dir), folder, default_vocabulary())
    return read_shards(spark, shards, folder).select(C.public_id(), "start", "n_tokens", "ids_crc32")


@query("op5_order_minhash_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select(C.public_id(), C.public_id("class_id", "class_id"), "kept")


_OP6_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
shared AS (
  SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
judged AS (
  SELECT keyed.doc_id, pos, line, keeper IS NOT NULL AND keyed.doc_id <> keeper AS drop_it
  FROM keyed LEFT JOIN shared ON keyed.k = shared.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (drop_it) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT drop_it), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query("op6_line_dedup", _OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(documents(spark, sf_dir))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op7_best_fit_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(documents(spark, sf_dir), default_vocabulary())
    return packed.select(C.public_id(), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train_langid(docs.filter(C.crc_mod(F.col("doc_id"), 5) != 0))
    found = predict(docs, model)
    return found.select(C.public_id(), (C.crc_mod(F.col("_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


_SLOTS = NUMBER + NAME + UNIT
_OP9_SQL = f"""
WITH texts AS (
  SELECT DISTINCT 'd' AS kind, doc_id AS id, coalesce(text, '') AS t FROM documents
  UNION ALL SELECT DISTINCT 'b', item_id, text FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
s1 AS (SELECT kind, id, regexp_replace(t, '([\\p{{L}}\\p{{N}},;] )(\\p{{Lu}}\\p{{Ll}}+)', '\\1{NAME}\\2', 'g') AS t FROM texts),
s2 AS (SELECT kind, id, regexp_replace(t, '([\\p{{L}}\\p{{N}},;] )(\\p{{Lu}}\\p{{Ll}}+)', '\\1{NAME}\\2', 'g') AS t FROM s1),
s3 AS (SELECT kind, id, regexp_replace(regexp_replace(t, '([0-9])[.,:/]([0-9])', '\\1{INNER}\\2', 'g'), '([0-9])[.,:/]([0-9])', '\\1{INNER}\\2', 'g') AS t FROM s2),
s4 AS (SELECT kind, id, regexp_replace(t, '([0-9][0-9{INNER}]*)', '{NUMBER}\\1', 'g') AS t FROM s3),
s5 AS (SELECT kind, id, lower(regexp_replace(t, '(?i)({NUMBER}[0-9{INNER}]+) ?({UNITS})([^\\p{{L}}\\p{{N}}]|$)', '\\1 {UNIT}\\2\\3', 'g')) AS t FROM s4),
worded AS (
  SELECT kind, id,
         [x FOR x IN regexp_split_to_array(t, '[^\\p{{L}}\\p{{N}}{_SLOTS}{INNER}%]+') IF x <> ''] AS w,
         [x FOR x IN regexp_split_to_array(regexp_replace(t, '([{_SLOTS}])[\\p{{L}}\\p{{N}}%{INNER}]+', '\\1', 'g'), '[^\\p{{L}}\\p{{N}}{_SLOTS}{INNER}%]+') IF x <> ''] AS tpl
  FROM s5),
asked AS (
  SELECT id AS item, w AS v, least(len(tpl), 8) AS n, unnest(range(1, len(tpl) - least(len(tpl), 8) + 2)) AS ipos, tpl
  FROM worded WHERE kind = 'b' AND len(tpl) >= 5),
windows AS (
  SELECT item, v, n, ipos, tpl[ipos : ipos + n - 1] AS win FROM asked
  WHERE len([x FOR x IN tpl[ipos : ipos + n - 1] IF x NOT IN ('{NUMBER}', '{NAME}', '{UNIT}')]) >= 5),
held AS (
  SELECT id, w, lens.n, tpl, unnest(range(1, len(tpl) - lens.n + 2)) AS pos
  FROM worded, (SELECT DISTINCT n FROM windows) AS lens WHERE kind = 'd'),
hits AS (
  SELECT held.id AS doc_id, w, item, v, held.n AS n, pos, pos - ipos AS shift
  FROM held JOIN windows ON held.n = windows.n AND held.tpl[pos : pos + held.n - 1] = windows.win),
slots AS (
  SELECT DISTINCT doc_id, w, item, v, shift, w[p] AS d, v[p - shift] AS b
  FROM (SELECT *, unnest(range(pos, pos + n)) AS p FROM hits) WHERE regexp_matches(v[p - shift], '^[{_SLOTS}]')),
bad AS (
  SELECT doc_id, w, item, v, shift FROM slots GROUP BY ALL HAVING count(*) <> count(DISTINCT d) OR count(*) <> count(DISTINCT b)),
good AS (
  SELECT doc_id, item, count(DISTINCT pos) AS n FROM hits ANTI JOIN bad USING (doc_id, w, item, v, shift) GROUP BY doc_id, w, item, v, shift),
found AS (SELECT doc_id, count(DISTINCT item) AS n_items, sum(n) AS n_windows FROM good GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n_items, 0)::BIGINT AS n_items, coalesce(n_windows, 0)::BIGINT AS n_windows, n_items IS NOT NULL AS contaminated
FROM (SELECT doc_id FROM documents) AS documents LEFT JOIN found ON documents.doc_id = found.doc_id
"""


@query("op9_benchmark_decontamination", _OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    found = found.groupBy("_id").agg(F.count("*").alias("n_items"), F.sum("n_windows").alias("n_windows"))
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(C.NO_ID)).alias("_id"))
    out = ids.join(found, "_id", "left")
    return out.select(C.public_id(), F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("n_windows", F.lit(0)).alias("n_windows"), F.col("n_items").isNotNull().alias("contaminated"))


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), default_vocabulary())


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_OP11_SQL = f"""
WITH told AS (SELECT doc_id, unnest({_TERMS}) AS t FROM documents),
tfs AS (SELECT doc_id, t, count(*) AS tf FROM told GROUP BY doc_id, t),
sizes AS (SELECT doc_id, count(*) AS n FROM told GROUP BY doc_id),
whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
weights AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM tfs WHERE t IN (SELECT t FROM asked) GROUP BY t), whole),
lengths AS (SELECT doc_id, 100 - 50 + ((50 * n * n_docs) // n_terms) AS m FROM sizes, whole),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (t) JOIN tfs USING (t) JOIN lengths USING (doc_id) GROUP BY item_id, doc_id),
placed AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM placed WHERE place <= 50
"""


@query("op11_lexical_search", _OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranked(documents(spark, sf_dir), table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select("item_id", "rank", C.public_id(), "score")


_OP12_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS alike, CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM pairs WHERE alike) WHERE place <= 5),
placed AS (
  SELECT p.anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS place
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT alike
       AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM placed WHERE place <= 10
"""


@query("op12_hard_negatives", _OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives(rows.withColumn("label", moved))
    return found.select("anchor_id", C.public_id("positive_id", "positive_id"), "rank", C.public_id("negative_id", "negative_id"), "positive_score", "negative_score")


@query("op13_document_fingerprints")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = edited_likeness(documents(spark, sf_dir))
    prints = [text_of(F.col(c)).alias(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    return found.select(C.public_id(), "n_chars", *prints, "near_edited", "near_next")
