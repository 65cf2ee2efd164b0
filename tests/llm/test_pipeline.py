from __future__ import annotations

import re
from collections import defaultdict

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tests.llm.test_layout import plain_groups
from weftline.llm import bpe, mixing
from weftline.session import land

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = {"start": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = land(stage(spark, docs, sf), name)
    return out


def test_stages_keep_the_columns(stages):
    columns = stages["start"].columns
    for name, frame in stages.items():
        assert frame.columns == columns + (["token_ids"] if name == "tokens" else [])


def test_filters_drop_what_is_labelled(stages, spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    before, after = (stages[s].join(labels, "doc_id").toPandas() for s in ("start", "toxicity"))
    assert set(after["doc_id"]) <= set(before["doc_id"])
    clean = before[before["toxic"] == 0]["doc_id"]
    assert clean.isin(after["doc_id"]).mean() > 0.95
    good = stages["toxicity"].join(labels, "doc_id").filter("quality = 1").toPandas()["doc_id"]
    kept = stages["quality"].select("doc_id").toPandas()["doc_id"]
    assert good.isin(kept).mean() > 0.95


def test_one_of_each_group_stays(stages):
    data = [(r["doc_id"], r["text"]) for r in stages["quality"].collect()]
    want = {i for i, (_, top) in plain_groups(data).items() if i == top}
    assert {r["doc_id"] for r in stages["near_duplicates"].collect()} == want


def test_mix_repeats_documents_to_the_word(stages):
    docs = {r["doc_id"]: r for r in stages["near_duplicates"].collect()}
    goals = {t.source: t.budget for t in mixing.targets([
        (s, sum(len(WORDS.findall(d["text"])) for d in docs.values() if d["source"] == s), 1)
        for s in {d["source"] for d in docs.values()}])}
    words, cut = defaultdict(int), defaultdict(int)
    for r in stages["mixing"].collect():
        whole = docs[r["doc_id"]]["text"]
        assert whole.startswith(r["text"]) and r["source"] == docs[r["doc_id"]]["source"]
        cut[r["source"]] += r["text"] != whole
        words[r["source"]] += len(WORDS.findall(r["text"]))
    assert dict(words) == goals and max(cut.values()) <= 1


def test_tokens_round_trip(stages):
    ranks = bpe.parse_ranks(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in stages["tokens"].collect():
        assert r["token_ids"] == known.encode_ordinary(r["text"])


def test_run_is_registered_and_repeatable(stages, spark, sf):
    out = __spark_entry__.queries()["pipeline"](spark, sf)
    digest = lambda f: f.agg(F.count("*"), F.sum(F.hash("doc_id", "text", "token_ids"))).first()
    assert digest(out) == digest(stages["tokens"])
    assert "pipeline" not in __spark_entry__.oracle_sql()
