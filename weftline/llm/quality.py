"""Quality from text statistics: the learned decision list and the sparse rule ensemble on Spark columns."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm import decision_list, rule_ensemble
from weftline.llm.common import SAMPLE_ROWS, fold, labelled_sample, with_labels
from weftline.llm.text_stats import counted, ratios

HOLD_OUT = 5
ACCEPT = 0.3


def training_rows(docs: DataFrame, sample: DataFrame) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Statistics and labels of the sampled documents, on the driver; the sample is bounded."""
    rows = with_labels(docs.select("doc_id", "text"), sample).select("doc_id", "_label", counted("text").alias("c"))
    table = rows.select("doc_id", "_label", *[v.alias(k) for k, v in ratios(F.col("c")).items()]).toPandas()
    table = table.sort_values(list(table.columns), kind="stable")
    names = [c for c in table.columns if c not in ("doc_id", "_label")]
    return {c: table[c].to_numpy(float) for c in names}, table["_label"].to_numpy(int)


def fit_ensemble(docs: DataFrame, labels: DataFrame, keep: Column | None = None,
                 sample_rows: int = SAMPLE_ROWS) -> rule_ensemble.RuleEnsemble:
    """Fit on at most ``sample_rows`` labelled documents; ``keep`` chooses the labels that may be learned from."""
    return rule_ensemble.learn(*training_rows(docs, labelled_sample(labels, "quality", keep, sample_rows)))


def fit_list(docs: DataFrame, labels: DataFrame, keep: Column | None = None,
             sample_rows: int = SAMPLE_ROWS) -> decision_list.DecisionList:
    x, quality = training_rows(docs, labelled_sample(labels, "quality", keep, sample_rows))
    return decision_list.learn(x, quality == 0)


def may_learn(doc_id: Column) -> Column:
    return fold(doc_id, HOLD_OUT) != 0


def classify(docs: DataFrame, model: rule_ensemble.RuleEnsemble) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null and empty texts have zero counts and are scored like any other text; a null id counts as held out.
    """
    counts = docs.select("doc_id", counted("text").alias("c"))
    scored = counts.select("doc_id", (~may_learn(F.col("doc_id"))).alias("held_out"),
                           model.score(ratios(F.col("c"))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def accepted(docs: DataFrame, model: rule_ensemble.RuleEnsemble) -> DataFrame:
    """The rows of ``docs``, all columns, that the model does not reject."""
    names = docs.columns
    work = docs.select(F.struct(*[docs[n] for n in names]).alias("row"), counted(docs["text"]).alias("c"))
    return work.filter(model.score(ratios(F.col("c"))) >= ACCEPT).select("row.*")


def apply_list(docs: DataFrame, rules: decision_list.DecisionList) -> DataFrame:
    """One row per row of ``docs``: the counts, whether the fixed rule fails, and the verdict of the learned list.

    Null and empty texts have no words, so the fixed rule fails for them.
    """
    c = F.col("c")
    failed = (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return docs.select("doc_id", counted("text").alias("c")).select(
        "doc_id", *[c[n].alias(n) for n in names], failed.alias("base_failed"),
        (~failed & rules.verdict(ratios(c))).alias("kept"),
    )
