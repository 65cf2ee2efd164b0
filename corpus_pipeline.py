"""From raw documents to training tokens: filter, deduplicate, mix, encode.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns the columns of ``documents``;
the last one adds the token ids.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.adapters import table
from weftline.llm import bpe, minhash_forest, mixing, quality, toxicity
from weftline.session import land, tune

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity model rejects go. It learns from the labels that may be learned from."""
    tune(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), toxicity.may_learn(F.col("doc_id")))
    return toxicity.accepted(docs, model)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the rule ensemble rejects go."""
    tune(spark)
    model = quality.fit_ensemble(docs, table(spark, sf_dir, "labels"), quality.may_learn(F.col("doc_id")))
    return quality.accepted(docs, model)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id."""
    tune(spark)
    return minhash_forest.deduplicated(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document is repeated as often as the mix takes it; where a source's budget ends, its words end too."""
    tune(spark)
    return mixing.materialised(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns and the token ids; decoding them gives the text back."""
    tune(spark)
    raw = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encode(docs, raw, public_tokenizers.PATTERN, out="token_ids")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("near_duplicates", dedup_stage),
    ("mixing", mix_stage),
    ("tokens", token_stage),
]

#: Fitted models and minimum hashes cannot be said in SQL; tests compare every stage with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    docs = table(spark, sf_dir.rstrip("/"), "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir.rstrip("/"))
        if name != STAGES[-1][0]:
            docs = land(docs, name)
    return docs
