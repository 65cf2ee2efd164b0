from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import clashing, documents, empty, labels, rows
from weftline.llm import decision_list, quality, queries, rule_ensemble, toxicity
from weftline.llm.text_stats import COUNTS, repeated_words, text_counts


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
            "n_dup_lines": dup, "n_repeat_words": len(inside), "n_distinct_words": len(set(words))}


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.none(), st.lists(st.sampled_from(["a", "b", "ä#", "\n", " ", " ", "\x1c", "\t", "$x|"]), max_size=60).map("".join),
                 st.lists(st.sampled_from("abc"), max_size=40).map(" ".join)))
def test_counts_against_plain_ones(text):
    got = dict(zip(COUNTS, text_counts(text), strict=True))
    assert {k: got[k] for k in plain_counts(text)} == plain_counts(text)


def test_overlapping_windows_count_once():
    assert repeated_words(np.array([1, 1, 1, 1])) == 4
    assert repeated_words(np.array([1, 2, 3, 9, 1, 2, 3, 4])) == 6


def synthetic(n=600, seed=3):
    rng = np.random.default_rng(seed)
    x = {"a": rng.random(n), "b": rng.random(n), "c": rng.random(n)}
    bad = (x["a"] > 0.8) | ((x["b"] < 0.2) & (x["c"] > 0.5))
    return x, bad


def test_decision_list_finds_planted_rules():
    x, bad = synthetic()
    rules = decision_list.learn(x, bad)
    new, truth = synthetic(seed=4)
    assert (rules.rejects(new) == truth).mean() > 0.95
    assert str(rules) == str(decision_list.learn(x, bad))  # repeatable
    assert not decision_list.learn({"a": np.array([])}, np.array([], bool)).rules


def test_rule_ensemble_finds_planted_rules_and_is_sparse():
    x, bad = synthetic()
    model = rule_ensemble.learn(x, (~bad).astype(int))
    new, truth = synthetic(seed=4)
    assert ((model.predict(new) < 0.5) == truth).mean() > 0.95
    assert 0 < len(model.rules) < 150
    assert rule_ensemble.learn({"a": np.array([])}, np.array([])).predict({"a": np.array([1.0])})[0] == 0.5


def test_compiled_columns_agree_with_numpy(spark):
    x, bad = synthetic()
    model, rules = rule_ensemble.learn(x, (~bad).astype(int)), decision_list.learn(x, bad)
    frame = spark.createDataFrame([tuple(map(float, r)) for r in zip(x["a"], x["b"], x["c"])], "a double, b double, c double")
    cols = {k: F.col(k) for k in "abc"}
    got = frame.select(model.score(cols).alias("s"), rules.verdict(cols).alias("k")).toPandas()
    assert np.allclose(got["s"], model.predict(x)) and (got["k"] == ~rules.rejects(x)).all()


@pytest.mark.parametrize("name, label, fold", [("op5_weak_toxicity", "toxic", (4, 2)), ("op8_rule_ensemble", "quality", (5, 0))])
def test_held_out_quality(spark, name, label, fold):
    sf = "/root/testdata/sf0.1"
    out = queries.QUERIES[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert (out["held_out"] == [zlib.crc32(str(d).encode()) % fold[0] == fold[1] for d in out["doc_id"]]).all()
    assert out["score"].between(0, 1).all() and (out["predicted"] == (out["score"] >= 0.3)).all()
    held = out[out["held_out"]]
    ones, zeros = held[held[label] == 1], held[held[label] == 0]
    if label == "toxic":
        assert ones["predicted"].mean() > 0.85 and zeros["predicted"].mean() < 0.02
    else:
        assert zeros["predicted"].mean() < 0.1 and ones["predicted"].mean() > 0.98


def test_decision_list_query(spark, sf):
    got = {r["doc_id"]: r for r in queries.QUERIES["op9_decision_list"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        want, row = plain_counts(d["text"]), got[d["doc_id"]]
        assert all(row[k] == want[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert row["base_failed"] == failed and not (failed and row["kept"])


def test_awkward_tables(spark):
    docs, nothing = clashing(documents(spark)), empty(spark)
    some = labels(spark, [(1, 1, 0), (1, 0, 1), (7, 1, 0), (None, 1, 1), (8, None, None), (99, 0, 1)])
    for given in (some, labels(spark)):
        for table, n in ((docs, len(rows())), (nothing, 0)):
            ensemble, rules, tox = quality.fit_ensemble(table, given), quality.fit_list(table, given), toxicity.fit(table, given)
            for out in (quality.classify(table, ensemble), toxicity.classify(table, tox)):
                found = out.collect()
                assert len(found) == n and all(0 <= r["score"] <= 1 for r in found)
            assert quality.apply_list(table, rules).count() == n
            assert quality.accepted(table, ensemble).columns == table.columns
            assert toxicity.accepted(table, tox).columns == table.columns


def test_correlated_voters_count_less():
    votes = np.zeros((400, 3), bool)
    votes[:60, 0] = votes[:60, 1] = True
    votes[30:90, 2] = True
    y = np.zeros(400, int)
    y[:90] = 1
    model = toxicity.label_model(votes, y)
    one, two = np.array([[True, False, False]]), np.array([[True, True, False]])
    assert model.correlation[0, 1] > 0.5
    assert model.log_odds(two)[0] - model.log_odds(one)[0] < 0.5 * model.strength[1]
    assert model.posterior(one)[0] > 0.5 > model.posterior(np.zeros((1, 3), bool))[0]
