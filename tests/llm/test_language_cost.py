"""What keeps the language model's work small beside its tokens leaves its results as they are."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import gru, language_model


def test_windows_of_few_lanes_are_long_and_cover_every_place_once():
    docs = [np.arange(n, dtype=np.int32) % 7 for n in (9_000, 40, 3, 700)]
    lanes = gru.Lanes(docs, np.full(len(docs), 7), np.arange(8), 1_024)
    for most, windows in ((0, 282), (gru.WIDE, 12)):  # 282 before, as for many lanes
        found = [*lanes.windows(32, most)]
        assert len(found) <= windows
        assert sorted(np.concatenate([p[live] for p, live in found]).tolist()) == list(range(9_743))


def test_long_documents_are_scored_beside_those_of_other_batches(spark, monkeypatch):
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{int(k)}" for k in rng.zipf(1.5, 400 if i % 5 == 0 else 12) if k < 3_000) for i in range(60)]
    rows = [*enumerate(texts), (0, texts[0]), (60, None), (61, "")]
    docs = language_model.split(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    lm = language_model.fit(docs.filter(~F.col("held_out")))
    monkeypatch.setattr(language_model, "BATCH_DOCS", 8)
    at_once = [tuple(r) for r in language_model.score(docs, lm).orderBy("doc_id").collect()]
    monkeypatch.setattr(language_model, "LONG", 100)
    for most in (1_000_000, 500):
        monkeypatch.setattr(language_model, "BLOCK_TOKENS", most)
        found = [tuple(r) for r in language_model.score(docs, lm).orderBy("doc_id").collect()]
        assert len(found) == 63
        for a, b in zip(at_once, found, strict=True):
            assert a[:5] == b[:5] and b[5:] == pytest.approx(a[5:], rel=1e-5)


def test_head_and_next_words_come_from_one_histogram(spark):
    counts = spark.createDataFrame([(f"w{i:03d}", 1_000 // (i + 1)) for i in range(300)], "word string, c long")
    words, heads = language_model.frequent(counts, 100, 10)
    assert words == sorted(words, key=lambda x: (-x[1], x[0])) and heads <= 10 < len(words) <= 100
    assert all(c >= language_model.HEAD_COUNT for _, c in words) and words[heads - 1][1] > words[heads][1]
    same = counts.withColumn("c", F.lit(7).cast("long"))  # one bin that is too large
    assert language_model.frequent(same, 20, 5) == ([(f"w{i:03d}", 7) for i in range(20)], 5)
    assert language_model.frequent(same, 400, 5) == ([(f"w{i:03d}", 7) for i in range(300)], 5)
    assert language_model.frequent(counts.filter("false"), 20, 5) == ([], 0)
