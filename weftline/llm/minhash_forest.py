"""Near duplicates by an LSH forest over minimum hashes.

Texts with equal shingle sets are one class. Each tree orders the classes by a sequence of minimum hashes; classes that
share the first values of a sequence lie together, and the neighbours in the order, which share the longest prefix, are
candidates. Where many classes share a prefix the region is cut at a deeper prefix. Candidates are confirmed on the full
sets; components of the confirmed links are the result.

Neighbours in the order are a cap on partners, so the regions it was used in are looked at again: where more than one
component is left in one, its classes are joined exactly by prefix filtering (rarest shingles first).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from weftline.llm.components import components, roots
from weftline.plans.sizing import broadcast_if_small
from weftline.session import land

SHINGLE = 5
PERCENT = 75
#: Two texts at the threshold share a first region in one tree with probability 0.75^2; in none of 20 with 7e-8.
TREES = 20
FIRST_DEPTH = 2
DEPTH = 6
NEIGHBOURS = 4
#: Classes one region may hold before it is cut at a deeper prefix.
REGION = 256
WIDTH = 4  # bytes of one value in a signature

_mix = np.random.default_rng(20240611)
FACTORS = _mix.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _mix.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)
ROTATE = np.uint64(0x9E3779B97F4A7C15)


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of the whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 1)], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(words) - SHINGLE + 1
    out = hashes[:n].copy()
    for k in range(1, SHINGLE):
        out = scrambled(out * ROTATE + hashes[k:n + k])
    return np.unique(out)


def signature(found: np.ndarray) -> bytes:
    low = np.full(TREES * DEPTH, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(found), 2048):
        np.minimum(low, (found[start:start + 2048, None] * FACTORS + SHIFTS).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype(">u4").tobytes()


SIGNED = StructType([StructField("doc_id", LongType()), StructField("n", LongType()), StructField("cls", BinaryType()),
                     StructField("sig", BinaryType())])
SETS = StructType([StructField("cls", BinaryType()), StructField("n", LongType()), StructField("shingles", BinaryType())])


def sign_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for whole in batches:
        for start in range(0, len(whole), 1000):
            part = whole.iloc[start:start + 1000]
            rows = []
            for doc_id, text in zip(part["doc_id"], part["text"], strict=True):
                found = shingles(text)
                some = len(found) > 0
                rows.append((None if pd.isna(doc_id) else int(doc_id), len(found),
                             xxhash.xxh3_128_digest(found.tobytes()) if some else None,
                             signature(found) if some else None))
            out = pd.DataFrame(rows, columns=["doc_id", "n", "cls", "sig"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out


def set_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for whole in batches:
        for start in range(0, len(whole), 500):
            found = [x for x in map(shingles, whole["text"].iloc[start:start + 500]) if len(x)]
            yield pd.DataFrame({"cls": [xxhash.xxh3_128_digest(x.tobytes()) for x in found],
                                "n": [len(x) for x in found], "shingles": [x.tobytes() for x in found]})


def tree_prefix(tree: int, depth: int) -> Column:
    return F.xxhash64(F.lit(tree), F.lit(depth), F.substring("sig", tree * DEPTH * WIDTH + 1, depth * WIDTH))


def by_tree(classes: DataFrame, depths: range) -> DataFrame:
    trees = F.array(*[F.struct(F.lit(t).alias("tree"), *[tree_prefix(t, d).alias(f"p{d}") for d in depths])
                      for t in range(TREES)])
    return classes.select("cls", "n", F.explode(trees).alias("x")).select("cls", "n", "x.*")


def regions(rows: DataFrame, size: int = REGION) -> DataFrame:
    """Give each (class, tree) its region: the shortest prefix from FIRST_DEPTH on that at most ``size`` classes share.

    Classes that share the whole sequence are alike in the order; too many of them are dealt to slices by hash.
    """
    depths = range(FIRST_DEPTH, DEPTH + 1)
    every = rows.select(F.explode(F.array(*[F.col(f"p{d}") for d in depths])).alias("p"))
    crowded = land(every.groupBy("p").agg(F.count("*").alias("many")).filter(F.col("many") > size), "crowded")
    for d in depths:
        here = broadcast_if_small(crowded.select(F.col("p").alias(f"q{d}"), F.col("many").alias(f"m{d}")))
        rows = rows.join(here, F.col(f"p{d}") == F.col(f"q{d}"), "left").drop(f"q{d}")
    slices = F.ceil(F.col(f"m{DEPTH}") / size)
    region = F.xxhash64(F.col(f"p{DEPTH}"), F.pmod(F.xxhash64("cls"), slices))
    for d in reversed(depths):
        region = F.when(F.col(f"m{d}").isNull(), F.col(f"p{d}")).otherwise(region)
    return rows.withColumn("region", region).drop(*[f"m{d}" for d in depths])


def sized(n: Column, m: Column) -> Column:
    """Sets of these sizes can be similar enough."""
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def neighbours(rows: DataFrame) -> DataFrame:
    """Candidate pairs (a > b) with the number of trees they are neighbours in."""
    order = W.partitionBy("region").orderBy(*[f"p{d}" for d in range(FIRST_DEPTH + 1, DEPTH + 1)], "cls")
    before = F.array(*[F.lag(F.struct("cls", "n"), k).over(order) for k in range(1, NEIGHBOURS + 1)])
    near = rows.select("cls", "n", before.alias("near")).select("cls", "n", F.explode("near").alias("x")).filter(
        F.col("x").isNotNull() & (F.col("cls") != F.col("x.cls")) & sized(F.col("n"), F.col("x.n")))
    return near.select(F.greatest("cls", "x.cls").alias("a"), F.least("cls", "x.cls").alias("b")).groupBy("a", "b").agg(
        F.count("*").alias("trees"))


def heads(rows: DataFrame) -> DataFrame:
    """Pairs that tie the slices of one crowded full-depth prefix together: the first class of each to the first of all."""
    first = rows.groupBy(f"p{DEPTH}", "region").agg(F.min(F.struct("cls", "n")).alias("x"))
    top = first.groupBy(F.col(f"p{DEPTH}").alias("k")).agg(F.min("x").alias("y"), F.count("*").alias("parts")).filter("parts > 1")
    return first.join(top, F.col(f"p{DEPTH}") == F.col("k")).filter(
        (F.col("x.cls") != F.col("y.cls")) & sized(F.col("x.n"), F.col("y.n"))).select(
        F.col("x.cls").alias("a"), F.col("y.cls").alias("b"), F.lit(1).cast("long").alias("trees"))


@F.pandas_udf(LongType())
def shared(left: pd.Series, right: pd.Series) -> pd.Series:
    """Size of the intersection of two sorted sets."""
    return pd.Series([len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                      for x, y in zip(left, right, strict=True)], dtype="int64")


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("cls").alias("ca"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("cls").alias("cb"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    both = pairs.select("a", "b").join(left, F.col("a") == F.col("ca")).join(right, F.col("b") == F.col("cb"))
    common = both.select("a", "b", "na", "nb", shared("sa", "sb").alias("common"))
    return land(common.filter(100 * F.col("common") >= PERCENT * (F.col("na") + F.col("nb") - F.col("common"))).select(
        "a", "b"), "links")


def across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components so far, with their components as ra and rb."""
    la = labels.select(F.col("node").alias("ka"), F.col("root").alias("xa"))
    lb = labels.select(F.col("node").alias("kb"), F.col("root").alias("xb"))
    joined = pairs.join(la, F.col("a") == F.col("ka"), "left").join(lb, F.col("b") == F.col("kb"), "left")
    ra, rb = F.coalesce("xa", "a"), F.coalesce("xb", "b")
    return joined.select(*pairs.columns, ra.alias("ra"), rb.alias("rb")).filter(F.col("ra") != F.col("rb"))


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links. Only the components that the links touch are computed again."""
    if links.isEmpty():
        return labels
    lifted = across(links, labels).select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    up = land(components(lifted), "roots").select(F.col("node").alias("k"), F.col("root").alias("top"))
    known = labels.join(up, F.col("root") == F.col("k"), "left").select("node", F.coalesce("top", "root").alias("root"))
    fresh = up.join(labels, F.col("k") == F.col("node"), "left_anti").select(F.col("k").alias("node"), F.col("top").alias("root"))
    return land(known.unionByName(fresh), "labels")


def link(candidates: DataFrame, sets: DataFrame) -> DataFrame:
    """Components of the confirmed candidates.

    Pairs inside one component need no check. So first every class tries its best partner among those before it, which
    gives a forest; then every two components their best pair; in the end all pairs that still lie across are checked.
    """
    tried = land(candidates.groupBy("a").agg(F.max_by(F.col("b"), F.struct("trees", "b")).alias("b")), "tried")
    forest = confirm(tried, sets)
    labels = land(roots(forest.select(F.col("a").alias("node"), F.col("b").alias("parent"))), "labels")
    left = land(across(candidates.join(tried, ["a", "b"], "left_anti"), labels), "left")
    if left.isEmpty():
        return labels
    tried = land(left.groupBy(F.least("ra", "rb").alias("x"), F.greatest("ra", "rb").alias("y")).agg(
        F.max_by(F.struct("a", "b"), F.struct("trees", "a", "b")).alias("p")).select("p.a", "p.b"), "tried")
    labels = merged(labels, confirm(tried, sets))
    left = land(across(left.select("a", "b").join(tried, ["a", "b"], "left_anti"), labels), "left")
    return labels if left.isEmpty() else merged(labels, confirm(left, sets))


def open_regions(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Classes of first-depth regions in which not all pairs were neighbours and more than one component is left."""
    first = f"p{FIRST_DEPTH}"
    lab = labels.select(F.col("node").alias("k"), "root")
    tagged = rows.select(F.col(first).alias("p"), "cls").join(lab, F.col("cls") == F.col("k"), "left").select(
        "p", "cls", F.coalesce("root", "cls").alias("root"))
    open_ = tagged.groupBy(F.col("p").alias("q")).agg(
        F.count("*").alias("many"), F.min("root").alias("low"), F.max("root").alias("high")).filter(
        (F.col("many") > NEIGHBOURS + 1) & (F.col("low") != F.col("high"))).select("q")
    return tagged.join(open_, F.col("p") == F.col("q"), "left_semi").select("cls", "root").distinct()


POSTINGS = StructType([StructField("cls", BinaryType()), StructField("root", BinaryType()), StructField("n", LongType()),
                       StructField("s", LongType())])


def spread_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for cls, root, n, raw in batch[["cls", "root", "n", "shingles"]].itertuples(index=False):
            yield pd.DataFrame({"cls": cls, "root": root, "n": n, "s": np.frombuffer(raw, np.uint64).view(np.int64)})


def exact_pairs(classes: DataFrame, sets: DataFrame) -> DataFrame:
    """All pairs across components that can reach the threshold: they share a shingle among each one's rarest ones.

    A class of n shingles keeps n - ceil(0.75 n) + 1 of them; common passages come last in that order and drop out. If a
    shared one is the first that two classes share, no more can be shared than either has from there on; a pair for which
    that is too little is not made there, and a pair that can reach the threshold is made at its first shared one.
    """
    chosen = sets.join(classes.withColumnRenamed("cls", "c"), F.col("cls") == F.col("c")).select("cls", "root", "n", "shingles")
    postings = land(chosen.mapInPandas(spread_sets, POSTINGS), "postings")
    often = postings.groupBy(F.col("s").alias("t")).agg(F.count("*").alias("df"))
    ranked = postings.join(often, F.col("s") == F.col("t")).groupBy("cls", "root", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "s"))).alias("all"))
    keep = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1
    rare = land(ranked.select("cls", "root", "n", F.posexplode(F.slice("all", F.lit(1), keep.cast("int"))).alias("i", "x")).filter(
        "x.df > 1").select("cls", "root", "n", "i", F.col("x.s").alias("s")), "rare")
    other = rare.select(F.col("cls").alias("b"), F.col("root").alias("rb"), F.col("n").alias("m"), F.col("i").alias("j"),
                        F.col("s").alias("t"))
    most = F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j"))
    met = rare.join(other, (F.col("s") == F.col("t")) & (F.col("cls") > F.col("b")) & (F.col("root") != F.col("rb"))
                    & ((100 + PERCENT) * most >= PERCENT * (F.col("n") + F.col("m"))))
    return met.select(F.col("cls").alias("a"), "b").distinct()


def class_labels(docs: DataFrame, signed: DataFrame, region: int = REGION) -> DataFrame:
    """(node, root) over the classes that have a link; classes without one are left out."""
    classes = land(signed.filter("n > 0").select("cls", "n", "sig").distinct(), "classes")
    keys = classes.select("cls", F.explode(F.array(*[tree_prefix(t, FIRST_DEPTH) for t in range(TREES)])).alias("p"))
    met = keys.groupBy(F.col("p").alias("q")).agg(F.count("*").alias("many")).filter("many > 1").select("q")
    live = keys.join(met, F.col("p") == F.col("q"), "left_semi").select("cls").distinct()
    live = land(classes.join(live.withColumnRenamed("cls", "k"), F.col("cls") == F.col("k"), "left_semi"), "live")
    ids = signed.join(live.select(F.col("cls").alias("k")), F.col("cls") == F.col("k"), "left_semi").groupBy("cls").agg(
        F.min("doc_id").alias("id")).select("id")
    ids = broadcast_if_small(land(ids, "ids"))
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").select("text")
    sets = land(texts.mapInPandas(set_batches, SETS).distinct(), "sets")
    rows = land(regions(by_tree(live, range(FIRST_DEPTH, DEPTH + 1)), region), "rows")
    candidates = land(neighbours(rows).unionByName(heads(rows)).groupBy("a", "b").agg(F.sum("trees").alias("trees")), "candidates")
    labels = link(candidates, sets)
    rest = land(open_regions(rows, labels), "open")
    return labels if rest.isEmpty() else merged(labels, confirm(land(exact_pairs(rest, sets), "rest"), sets))


def grouped(docs: DataFrame, region: int = REGION) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept (doc_id = component_id).

    Null and empty texts have no shingles and are linked with nothing; their component is their own id. Repeated rows are
    equal texts, so they are linked. Rows with a null id take part; they never give a component its name, and where a
    component has no other ids its name is null and nothing is kept. An empty table gives an empty table.
    """
    signed = land(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                              ).mapInPandas(sign_batches, SIGNED), "signed")
    labels = class_labels(docs, signed, region).select(F.col("node").alias("k"), "root")
    placed = land(signed.select("doc_id", "n", "cls").join(labels, F.col("cls") == F.col("k"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "cls").alias("comp")), "placed")
    names = placed.filter("comp IS NOT NULL").groupBy(F.col("comp").alias("c")).agg(F.min("doc_id").alias("name"))
    return placed.join(names, F.col("comp") == F.col("c"), "left").select(
        "doc_id", "n_shingles", F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("name")).alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns: one of each group of near duplicates, that with the smallest id.

    Of rows that repeat an id one stays, chosen among the texts that are kept; rows without an id stay as they are.
    """
    with_id = docs.filter(docs["doc_id"].isNotNull())
    groups = land(grouped(with_id), "groups")
    gone = broadcast_if_small(land(groups.groupBy("doc_id").agg(F.max("kept").alias("any")).filter("NOT any").select("doc_id"), "gone"))
    again = broadcast_if_small(land(groups.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "again"))
    left = with_id.join(gone, with_id["doc_id"] == gone["doc_id"], "left_anti")
    once = left.join(again, left["doc_id"] == again["doc_id"], "left_anti")
    repeated = left.join(again, left["doc_id"] == again["doc_id"], "left_semi").dropDuplicates(["doc_id"])
    parts = [once, repeated, docs.filter(docs["doc_id"].isNull())]
    return reduce(DataFrame.unionByName, parts)
