from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import clashing, documents, empty, rows
from weftline.llm import common, minhash_forest, mixing, sharding
from weftline.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def test_numbering_over_many_slices(spark):
    frame = spark.range(3000).select(F.when(F.col("id") < 2500, "hot").when(F.col("id") < 2990, None).otherwise("cold").alias("g"), "id",
                                     (F.col("id") % 7).alias("v")).withColumn("key", common.unit_key("id"))
    out = common.number(frame, "g", "key", ["id"], "v", "at", "before", per_slice=100).toPandas()
    for _, part in out.groupby(out["g"].fillna("none")):
        part = part.sort_values(["key", "id"])
        assert list(part["at"]) == list(range(len(part)))
        assert list(part["before"]) == [0, *part["v"].cumsum()[:-1]]


def test_targets_reshare_what_is_above_the_limit():
    out = {t.source: t for t in mixing.targets([("b", 10, 1), ("a", 1000, 5), (None, 30, 2), ("c", 500, 3)])}
    assert [t for t in out] == ["a", "b", "c", None]
    assert sum(t.target for t in out.values()) == pytest.approx(1540)
    assert out["b"].target == 30 and all(t.target <= 3 * t.size for t in out.values())
    assert out["a"].target / out["c"].target == pytest.approx(5)
    assert mixing.targets([]) == [] and mixing.targets([("x", 0, 1)])[0].target == 0


@pytest.mark.parametrize("slice_rows", [3, 1000])
def test_mix_takes_each_budget_exactly(spark, slice_rows):
    rng = random.Random(5)
    data = [(i, " ".join("w" * rng.randint(1, 4) for _ in range(rng.randint(0, 30))), "en", rng.choice(["a", "a", "a", "b", None]), 0)
            for i in range(300)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    plan = mixing.plan(docs, slice_rows)
    out = mixing.taken(docs, plan).select("row.source", "size", "source_size", "target", "taken").toPandas()
    for _, part in out.groupby(out["source"].fillna("none")):
        assert part["size"].sum() == part["source_size"].iloc[0]
        assert part["taken"].sum() == int(part["target"].iloc[0] + 0.5)
        assert (part["taken"] <= 3 * part["size"]).all()
    text = mixing.materialised(docs).toPandas()
    assert sum(len(WORDS.findall(t)) for t in text["text"]) == out["taken"].sum()


def test_mix_of_awkward_rows(spark):
    docs = clashing(documents(spark))
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows()) and sorted(r["size"] for r in out) == sorted(len(WORDS.findall(t or "")) for _, t, *_ in rows())
    assert mixing.mix(empty(spark)).count() == 0
    assert mixing.materialised(docs).columns == docs.columns
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()), key=str)


def test_shards_are_even_and_keep_groups_together(spark):
    data = [(i, f"text {i} " + "x" * (i * 37 % 300)) for i in range(3000)] + [(10_000 + i, f"copy {i % 150} " + "y" * 100) for i in range(900)]
    data += [(20_000 + i, "hot " + "z" * 400) for i in range(1500)] + [(30_000, None), (30_001, ""), (30_002, "")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    out = sharding.shard(docs).toPandas()
    text = dict(data)
    assert len(out) == len(data)
    for r in out.itertuples():
        assert r.size == len((text[r.doc_id] or "").encode()) + 1 and r.text_crc32 == zlib.crc32((text[r.doc_id] or "").encode())
    sizes = out.groupby("shard")["size"].sum()
    assert len(sizes) == 16 and sizes.max() - sizes.min() < 2000
    for _, part in out.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    where = defaultdict(set)
    for r in out.itertuples():
        where[text[r.doc_id]].add(r.shard)
    split = [t for t, s in where.items() if len(s) > 1 and t is not None]
    assert split in ([], [data[-4][1]])  # only the group that is larger than a shard
    need = -(-1500 * 405 // (sum(len((t or "").encode()) + 1 for _, t in data) // 16))
    assert len(where["hot " + "z" * 400]) <= need + 1
    again = sharding.shard(docs.repartition(7)).toPandas()
    assert sorted(map(tuple, out.values.tolist())) == sorted(map(tuple, again.values.tolist()))


def test_shards_of_awkward_rows(spark):
    out = sharding.shard(clashing(documents(spark))).toPandas()
    assert len(out) == len(rows()) and sharding.shard(empty(spark)).count() == 0


def plain_groups(data):
    sets = {}
    for i, text in data:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i, _ in data}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(5000)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    texts, base = [], words(120)
    passage = words(70)
    for _ in range(160):  # one large region of near copies
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        texts.append(copy)
    for _ in range(120):  # a passage that many share, not enough to link
        texts.append(words(rng.randint(10, 50)) + passage + words(rng.randint(10, 50)))
    for _ in range(60):
        one = words(rng.randint(3, 60))
        two = list(one)
        if len(two) > 30:
            two[rng.randrange(len(two))] = "changed"
        texts += [one, two, [w.upper() for w in one]]
    rng.shuffle(texts)
    return [(i * 3, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("region", [256, 8])
def test_near_duplicates_against_brute_force(spark, region):
    data = near_copies()
    out = minhash_forest.grouped(spark.createDataFrame(data, "doc_id long, text string"), region).collect()
    want = plain_groups(data)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_exact_rest_joins_across_components(spark):
    data = near_copies(2)
    docs = spark.createDataFrame(data, "doc_id long, text string")
    signed = docs.mapInPandas(minhash_forest.sign_batches, minhash_forest.SIGNED)
    sets = docs.select("text").mapInPandas(minhash_forest.set_batches, minhash_forest.SETS).distinct()
    alone = signed.filter("n > 0").select("cls", F.col("cls").alias("root")).distinct()
    links = minhash_forest.confirm(minhash_forest.exact_pairs(alone, sets), sets)
    names = {bytes(r["cls"]): r["id"] for r in signed.groupBy("cls").agg(F.min("doc_id").alias("id")).filter("cls IS NOT NULL").collect()}
    root = {i: i for i in names.values()}
    for r in components(links).collect():
        root[names[bytes(r["node"])]] = bytes(r["root"])
    groups = defaultdict(set)
    for i, r in root.items():
        groups[r if isinstance(r, bytes) else i].add(i)
    tops = defaultdict(set)
    for i, (_, top) in plain_groups(data).items():
        if i in names.values():
            tops[top].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, tops.values()))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 150)] + [(5000, 5000), (6001, 6000), (6001, 6000)]
    out = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(150)}, 6000: 6000, 6001: 6000}


def test_near_duplicates_of_awkward_rows(spark):
    docs = clashing(documents(spark))
    out = {r["doc_id"]: (r["component_id"], r["kept"]) for r in minhash_forest.grouped(docs).collect()}
    assert out[1][0] == out[2][0] == out[-10][0] == -10 and out[8] == (7, False)
    assert out[3] == (3, True) and out[4] == (4, True) and out[None] == (None, False)
    kept = minhash_forest.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([-10, 3, 4, 5, None, 6, 7, 9], key=str)
    assert minhash_forest.grouped(empty(spark)).count() == 0 and minhash_forest.deduplicated(empty(spark)).count() == 0
