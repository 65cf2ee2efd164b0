"""Balanced label propagation: linked documents move towards their neighbours' shards under quotas.

Documents with equal texts are linked. Every document starts in a hash shard. In each round the documents of a group are
drawn to the shard that holds most of the group among those with room, and moves are admitted, in a repeatable order, up
to each shard's quota (a distributed prefix sum over the proposals). Documents of a group that sit in one shard have one
size and are interchangeable, so the rounds carry them as one row with a count: a group of any size is one row per shard.
Documents without links then fill every shard up to the same size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.llm.common import SLICE_ROWS, key_slice, number, unit_key
from weftline.session import land

SHARDS = 16
#: A group larger than a shard needs a round for every shard it fills; rounds end as soon as nothing moves.
ROUNDS = 24
#: Share of a shard that groups may fill; the rest is left for documents without links, which make sizes even.
FILL = 0.97
#: Groups above this part of a shard are placed after all others and may be cut where a shard is full.
HEAVY = 8
#: A document is large above 1/LARGE of a shard, so there are at most LARGE times SHARDS of them.
LARGE = 200


def text_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, the group of equal texts and a repeatable key. A null text is in no group."""
    text = docs["text"]
    return docs.select(
        docs["doc_id"],
        text_size(text).alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.when(text.isNotNull(), F.md5(text)).alias("group"),
        unit_key(docs["doc_id"].cast("string"), F.coalesce(F.md5(text), F.lit("null"))).alias("key"),
    )


def loads(state: DataFrame, shards: int) -> list[int]:
    out = [0] * shards
    for row in state.groupBy("shard").agg(F.sum(F.col("n") * F.col("size")).alias("bytes")).collect():
        out[row["shard"]] = row["bytes"]
    return out


def per_shard(values: list[int], shard: Column) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), shard + 1)


def propose(state: DataFrame, room: list[int]) -> DataFrame:
    """What each group's documents outside its best shard with room would do: (group, size, shard, n, target).

    Documents that already sit in a better-filled shard of their group stay; ties between shards go by hash.
    """
    at = F.struct((F.col("n") * F.col("size")).alias("pull"), F.xxhash64("group", "shard").alias("tie"), F.col("shard"))
    best = state.filter(per_shard(room, F.col("shard")) >= F.col("size")).groupBy(F.col("group").alias("_g")).agg(
        F.max(at).alias("best"))
    pull = F.col("n") * F.col("size")
    return state.join(best, F.col("group") == F.col("_g")).filter(
        (F.col("shard") != F.col("best.shard")) & (pull <= F.col("best.pull"))
    ).select("group", "size", "shard", "n", F.col("best.shard").alias("target"))


def admit(moves: DataFrame, room: list[int], slices: int, whole: bool) -> DataFrame:
    """How many documents of each proposal fit: those before it in key order count first. ``whole``: a group moves with all
    its proposals or not at all."""
    keyed = moves.withColumn("key", unit_key("group")).withColumn(
        "slice", key_slice(F.col("key"), F.lit(slices)))
    pull = F.col("n") * F.col("size")
    sums = keyed.groupBy("target", "slice").agg(F.sum(pull).alias("bytes"))
    sums = sums.select(F.col("target").alias("_t"), F.col("slice").alias("_s"), F.coalesce(F.sum("bytes").over(
        W.partitionBy("target").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = W.partitionBy("target", "slice").orderBy("key", "group", "shard", "size")
    ahead = F.coalesce(F.sum(pull).over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) + F.col("_before")
    joined = keyed.join(F.broadcast(sums), (F.col("target") == F.col("_t")) & (F.col("slice") == F.col("_s")))
    joined = joined.withColumn("ahead", ahead)
    fits = F.floor((per_shard(room, F.col("target")) - F.col("ahead")) / F.col("size"))
    if whole:
        together = W.partitionBy("target", "slice", "group")
        joined = joined.withColumn("end", F.min("ahead").over(together) + F.sum(pull).over(together))
        fits = F.when(F.col("end") <= per_shard(room, F.col("target")), F.col("n")).otherwise(F.lit(0))
    return joined.select(
        "group", "size", "shard", "target",
        F.greatest(F.lit(0), F.least(F.col("n"), fits)).cast("long").alias("n")).filter("n > 0")


def propagate(state: DataFrame, used: list[int], capacity: int, shards: int, whole: bool, rounds: int = ROUNDS) -> DataFrame:
    """State rows (group, size, shard, n) after label propagation in what ``used`` leaves of the shards."""
    slices = max(1, -(-state.count() // SLICE_ROWS))
    for _ in range(rounds):
        room = [max(0, int(capacity * FILL) - x - y) for x, y in zip(loads(state, shards), used, strict=True)]
        moves = land(admit(propose(state, room), room, slices, whole), "moves")
        if moves.isEmpty():
            break
        gone = moves.select("group", "size", "shard", (-F.col("n")).alias("n"))
        come = moves.select("group", "size", F.col("target").alias("shard"), "n")
        state = land(state.select("group", "size", "shard", "n").unionByName(gone).unionByName(come).groupBy(
            "group", "size", "shard").agg(F.sum("n").alias("n")).filter("n > 0"), "state")
    return state


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot (gapless from 0 in each shard).

    Sizes of the shards are equal up to about one document. Groups of equal texts, also of empty ones, stay in one shard
    where they fit. Repeated rows are documents of their own. An empty table gives an empty table.
    """
    base = land(documents(docs), "documents")
    total = base.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()["bytes"]
    capacity = -(-total // shards)
    groups = base.filter(F.col("group").isNotNull()).groupBy(F.col("group").alias("g")).agg(
        F.count("*").alias("members")).filter("members > 1")
    tagged = land(base.join(groups, F.col("group") == F.col("g"), "left").withColumn(
        "linked", F.col("members").isNotNull()).drop("g", "members"), "linked")
    linked, single = tagged.filter("linked"), tagged.filter("NOT linked")

    start = linked.groupBy("group", "size", key_slice(F.col("key"), F.lit(shards)).cast("int").alias("shard")).agg(
        F.count("*").alias("n"))
    weight = start.groupBy(F.col("group").alias("g")).agg(F.sum(F.col("n") * F.col("size")).alias("weight"))
    start = land(start.join(weight, F.col("group") == F.col("g")).drop("g"), "state")
    heavy = F.col("weight") > capacity // HEAVY
    light = propagate(start.filter(~heavy).drop("weight"), [0] * shards, capacity, shards, True)
    large = propagate(start.filter(heavy).drop("weight"), loads(light, shards), capacity, shards, False)
    state = land(light.select("group", "size", "shard", "n").unionByName(large.select("group", "size", "shard", "n")), "state")

    # documents of a group, numbered, take the group's places in shard order
    order = W.partitionBy("group").orderBy("shard", "size")
    spans = state.select(F.col("group").alias("g"), "shard", F.sum("n").over(order).alias("until"))
    spans = spans.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("until", "shard"))).alias("spans"))
    numbered = number(linked, "group", "key", ["doc_id"], None, "at")
    seat = F.filter(F.col("spans"), lambda s: s["until"] > F.col("at"))[0]["shard"]
    placed = numbered.join(spans, F.col("group") == F.col("g")).select(
        "doc_id", "size", "text_crc32", "key", seat.cast("int").alias("shard"))

    # large documents without links are few (their size says so); largest first, each to the emptiest shard
    used = loads(state, shards)
    least = capacity // LARGE
    bulky = F.col("group").isNotNull() & (F.col("size") > least)
    seats = []
    for row in sorted(single.filter(bulky).select("group", "size").collect(), key=lambda r: (-r["size"], r["group"])):
        at_least = min(range(shards), key=lambda i: (used[i], i))
        used[at_least] += row["size"]
        seats.append((row["group"], at_least))
    chosen = docs.sparkSession.createDataFrame(seats, "g string, shard int")
    big = single.filter(bulky).join(F.broadcast(chosen), F.col("group") == F.col("g")).select(
        "doc_id", "size", "text_crc32", "key", "shard")
    single = single.filter(~F.coalesce(bulky, F.lit(False)))

    # the others lie on a line that is cut by what each shard lacks
    lack = [max(0, capacity - x) for x in used]
    line = number(single.withColumn("one", F.lit(0)), "one", "key", ["doc_id", "text_crc32"], "size", "at", "before")
    where, upto = F, 0
    for s in range(shards - 1):
        upto += lack[s]
        where = where.when(F.col("before") < F.lit(upto), F.lit(s))
    filled = line.select("doc_id", "size", "text_crc32", "key", where.otherwise(F.lit(shards - 1)).cast("int").alias("shard"))

    seated = number(placed.unionByName(big).unionByName(filled), "shard", "key", ["doc_id", "text_crc32"], None, "slot")
    return seated.select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))
