"""The inverted index built slice by slice of the files, against lists put together in Python."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from weftline.operators import index


def expected(rows: list[tuple[str | None, str | None]], per_row: int) -> list[tuple[str, int, str]]:
    counts = Counter((w, f) for f, text in rows for w in (text or "").split(" ") if w)
    lists = defaultdict(list)
    for (word, file), n in sorted(counts.items(), key=lambda x: (x[0][0], x[0][1] is not None, x[0][1] or "")):
        lists[word].append(None if file is None else f"{file}:{n}")
    return sorted((w, k // per_row, ",".join(x for x in found[k:k + per_row] if x))
                  for w, found in lists.items() for k in range(0, len(found), per_row))


@pytest.mark.parametrize("per_row", [1, 7, 40, 100_000])
def test_lists_over_slices_repeated_and_null_files(spark, per_row):
    rows = [(f"f{i % 90}" if i % 11 else None, " ".join(["all", f"w{i % 13}", f"w{i % 13}", "" if i % 5 else "fifth"])) for i in range(300)]
    rows += [("x", "odd"), ("x!", "odd odd"), ("none", None), (None, "lost"), ("é", "odd all")]
    docs = spark.createDataFrame(rows, "file string, text string")
    want = expected(rows, per_row)
    for group_rows in (20, 4_000):
        got = index.index_documents(docs, F.split("text", " "), per_row, group_rows)
        assert sorted(map(tuple, got.collect())) == want
    tokens = docs.select("file", F.explode(F.split("text", " ")).alias("word"))
    assert sorted(map(tuple, index.inverted_index(tokens, per_row, 50).collect())) == want


def test_a_file_of_many_rows_is_counted_before_it_is_dealt(spark, monkeypatch):
    seen, whole = [], index.inverted_index
    monkeypatch.setattr(index, "inverted_index", lambda *args: seen.append(1) or whole(*args))
    docs = spark.range(500).select(F.when(F.col("id") < 450, "one").otherwise(F.col("id").cast("string")).alias("file"), F.lit("a b a").alias("text"))
    got = {r.word: r.postings for r in index.index_documents(docs, F.split("text", " "), group_rows=20).collect()}
    assert seen and got["a"].endswith("one:900") and len(got["b"].split(",")) == 51


def test_words_are_counted_and_listed_without_a_shuffle_of_pairs(spark):
    docs = spark.range(1000).select(F.col("id").cast("string").alias("file"), F.lit("a b").alias("text"))
    bounds, fullest = index.file_slices(docs, 100)
    assert 8 <= len(bounds) + 1 <= 10 and fullest < 300
    tokens = index.with_slice(docs, bounds).select("slice", "file", F.explode(F.split("text", " ")).alias("word"))
    lists = index.count_tokens(tokens, "slice").groupBy("slice", "word").agg(F.collect_list("file"))
    assert lists._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_empty(spark):
    docs = spark.createDataFrame([], "file string, text string")
    assert index.index_documents(docs, F.split("text", " ")).count() == 0
