"""The registered queries of this package, each with the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.adapters import table
from weftline.llm import (
    bpe,
    filter_audit,
    hash_forest,
    html_extract,
    language_model,
    minhash_forest,
    mixing,
    periodic_runs,
    quality,
    sharding,
    toxicity,
    window_packing,
)
from weftline.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir.rstrip("/"))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


@query("op1_tag_ratio_text")
def tag_ratio_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", html_extract.extract(F.col("html")).alias("text"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op2_hash_prefix_forest")
def hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return hash_forest.search(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


@query("op3_source_mix", mixing.SQL)
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op4_label_propagation")
def label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op5_weak_toxicity")
def weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.classify(docs, toxicity.fit(docs, labels, toxicity.may_learn(F.col("doc_id"))))


@query("op6_prefix_bpe")
def prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.digests(table(spark, sf_dir, "documents"), raw, public_tokenizers.PATTERN)


@query("op7_recurrent_lm")
def recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = language_model.split(table(spark, sf_dir, "documents"))
    return language_model.score(docs, language_model.fit(docs.filter(~F.col("held_out"))))


@query("op8_rule_ensemble")
def quality_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.classify(docs, quality.fit_ensemble(docs, labels, quality.may_learn(F.col("doc_id"))))


@query("op9_decision_list")
def quality_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.apply_list(docs, quality.fit_list(docs, table(spark, sf_dir, "labels")))


@query("op10_minhash_forest", """
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * common >= 75 * (p.n + q.n - common)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  WITH RECURSIVE r(x, y) AS (
    SELECT x, y FROM both_ways UNION SELECT r.x, l.y FROM r JOIN both_ways l ON r.y = l.x)
  SELECT x, min(y) AS low FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(low, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN reach ON x = d.doc_id
""")
def minhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.grouped(table(spark, sf_dir, "documents"))


@query("op11_synchronised_runs")
def synchronised_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    texts = docs.select("doc_id", periodic_runs.repeated_tail(F.col("doc_id"), F.col("text")).alias("text"))
    return periodic_runs.digests(periodic_runs.find(texts))


@query("op12_window_packing")
def packed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    description = window_packing.read_description(public_tokenizers.path("word_bpe_49k.json"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return window_packing.pieces(window_packing.pack(docs, description, end_id=1))


@query("op13_filter_audit", filter_audit.SQL)
def audited_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return filter_audit.audit(filter_audit.mask_counts(docs, labels))
