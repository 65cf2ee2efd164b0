"""Words next in frequency to the head are scored by id exactly as by the join, and the join is done once."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import language_model


def scored(spark, monkeypatch, near: int):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{int(k)}" for k in rng.zipf(1.4, 80) if k < 5_000) for _ in range(150)] + ["", None, "noël unseené unseené X", "x"]
    docs = language_model.split(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1))
    with monkeypatch.context() as patched:
        patched.setattr(language_model, "HEAD", 20)
        patched.setattr(language_model, "NEAR", near)
        lm = language_model.fit(docs.filter(~F.col("held_out")))
        out = language_model.score(docs, lm)
        joins = out._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")
        return lm, {r["doc_id"]: r.asDict() for r in out.collect()}, joins


def test_words_told_by_id_score_as_joined_ones(spark, monkeypatch):
    none, joined, joins = scored(spark, monkeypatch, 0)
    some, told, _ = scored(spark, monkeypatch, 40)
    assert joins == 2  # words with counts, rows with sums
    assert not none.near and 20 < len(some.near) + len(some.vocabulary.ids) <= 60
    assert joined.keys() == told.keys() and len(told) == 154
    for d, row in joined.items():
        assert [row[c] for c in ("n_tokens", "n_known", "train_tokens")] == [told[d][c] for c in ("n_tokens", "n_known", "train_tokens")]
        assert told[d]["base_score"] == pytest.approx(row["base_score"], rel=1e-9)
        assert told[d]["score"] == pytest.approx(row["score"], rel=1e-5)


def test_an_ending_tells_the_group(spark, monkeypatch):
    lm, _, _ = scored(spark, monkeypatch, 40)
    monkeypatch.setattr(language_model, "ENDINGS", 3)
    told = language_model.Told(lm.vocabulary)
    for word in ("a", "", "w1", "w123", "xyz", "noël", "w99", "12345"):
        assert told[word[-3:]] == lm.vocabulary.rare_group(word) and len(told) <= 3
