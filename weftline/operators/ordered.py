"""Ordered-group operators (ranks, running sums, frames) that stay balanced when one group holds most of the rows.

A plain window sends each group to one task. When the largest group is above ``GROUP_ROWS`` the rows are instead
range-partitioned on (keys, order), so a group is spread over many slices. Each slice is handled by an ordinary
window and the slices are stitched together with a small table of per-slice totals.

The range-partitioned rows are written to the shared scratch first: slice numbers must not change between the pass
that totals the slices and the pass that numbers the rows, also when an executor is lost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.functions.numbers import quotient, strict
from weftline.plans.sizing import GROUP_ROWS, largest_group, settle
from weftline.session import land

Order = list[tuple[str, bool]]  # (column, descending); the last column makes the order total
FRAME_BLOCK = 1_000_000
#: Rows of one slice, and the fewest slices a sliced plan is worth.
SLICE_ROWS, LEAST_SLICES = 1_000_000, 8
#: Decimals that values in sums may have where the caller names no scale; a value with more raises.
DIGITS = 10


def sort_columns(order: Order) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c, descending in order]


def needs_slices(df: DataFrame, keys: list[str], group_rows: int = GROUP_ROWS) -> bool:
    """Whether some group is too large for one task. Only the key columns are read; derive ``df`` cheaply or land it."""
    return largest_group(df, keys, group_rows) > group_rows


def slice_rows(df: DataFrame, keys: list[str], order: Order) -> DataFrame:
    """Rows in ranges of (keys, order). The number of ranges follows the rows and is given, so that it is not merged."""
    slices = max(LEAST_SLICES, -(-df.count() // SLICE_ROWS))
    ranged = df.repartitionByRange(slices, *[F.col(k) for k in keys], *sort_columns(order))
    return land(ranged.withColumn("_slice", F.spark_partition_id()), "slices")


def join_pieces(rows: DataFrame, pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Join rows with the per-slice table on (_slice, keys), matching null keys.

    The table has a row per group and slice; with few groups it is within the bound and broadcast.
    """
    renamed = settle(pieces).withColumnsRenamed({k: f"_p_{k}" for k in [*keys, "_slice"]})
    condition = rows["_slice"] == renamed["_p__slice"]
    for key in keys:
        condition = condition & rows[key].eqNullSafe(renamed[f"_p_{key}"])
    return rows.join(renamed, condition).drop("_slice", *[f"_p_{k}" for k in [*keys, "_slice"]])


def running(
    df: DataFrame,
    keys: list[str],
    order: Order,
    sums: dict[str, str] | None = None,
    position: str | None = None,
    group_rows: int = GROUP_ROWS,
    sliced: bool | None = None,
) -> DataFrame:
    """Add the row number within the group (``position``) and running sums (``{output: input column}``).

    ``sliced`` skips the size check where the caller already knows its outcome.
    """
    sums = sums or {}
    if sliced is None:
        sliced = needs_slices(df, keys, group_rows)
    if not sliced:
        window = W.partitionBy(*(keys or [F.lit(0)])).orderBy(*sort_columns(order))
        added = {out: F.sum(c).over(window.rowsBetween(W.unboundedPreceding, 0)) for out, c in sums.items()}
        if position:
            added[position] = F.row_number().over(window).cast("long")
        return df.withColumns(added)

    rows = slice_rows(df, keys, order)
    pieces = rows.groupBy(*keys, "_slice").agg(
        F.count("*").alias("_n"), *[F.sum(c).alias(f"_t_{out}") for out, c in sums.items()]
    )
    earlier = W.partitionBy(*(keys or [F.lit(0)])).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.select(
        *keys,
        "_slice",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n_before"),
        *[F.sum(f"_t_{out}").over(earlier).alias(f"_b_{out}") for out in sums],
    )
    local = W.partitionBy("_slice", *keys).orderBy(*sort_columns(order))
    upto = local.rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns(
        {"_rn": F.row_number().over(local), **{f"_l_{out}": F.sum(c).over(upto) for out, c in sums.items()}}
    )
    joined = join_pieces(rows, pieces, keys)
    added = {
        out: F.when(F.col(f"_l_{out}").isNull(), F.col(f"_b_{out}")).otherwise(
            F.col(f"_l_{out}") + F.coalesce(F.col(f"_b_{out}"), F.lit(0))
        )
        for out in sums
    }
    if position:
        added[position] = F.col("_rn") + F.col("_n_before")
    return joined.withColumns(added).drop(
        "_rn", "_n_before", *[f"_l_{out}" for out in sums], *[f"_b_{out}" for out in sums]
    )


def tile(position: Column, total: Column, tiles: int) -> Column:
    """NTILE from a row number and the group size: the first ``total % tiles`` tiles hold one row more."""
    base = F.floor(total / tiles)
    extra = total % tiles
    wide = extra * (base + 1)
    return F.when(position <= wide, F.floor((position - 1) / (base + 1)) + 1).otherwise(
        extra + F.floor((position - 1 - wide) / base) + 1
    )


def ranked(
    df: DataFrame,
    keys: list[str],
    value: str,
    tiebreak: str,
    descending: bool = False,
    tiles: int = 4,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add row_num, rank_no, dense_rank_no, pct_rank, cume, tile_no for the order by ``value``.

    Ties share rank, dense rank and cumulative share; ``tiebreak`` fixes row numbers and tiles.
    """
    order: Order = [(value, descending), (tiebreak, False)]
    if not needs_slices(df, keys, group_rows):
        by = W.partitionBy(*(keys or [F.lit(0)]))
        full = by.orderBy(*sort_columns(order))
        peers = by.orderBy(*sort_columns(order[:1]))
        return df.withColumns(
            {
                "row_num": F.row_number().over(full).cast("long"),
                "tile_no": F.ntile(tiles).over(full).cast("long"),
                "rank_no": F.rank().over(peers).cast("long"),
                "dense_rank_no": F.dense_rank().over(peers).cast("long"),
                "pct_rank": F.percent_rank().over(peers),
                "cume": F.cume_dist().over(peers),
            }
        )

    rows = slice_rows(df, keys, order)
    # struct() keeps nulls inside min/max and orders them as the sort does
    at = F.struct(value)
    lowest, highest = (F.min(at), F.min_by("_c", at)), (F.max(at), F.max_by("_c", at))
    (first, first_rows), (last, last_rows) = (highest, lowest) if descending else (lowest, highest)
    # totals per slice come from counted values, without sorting a row
    runs = rows.groupBy(*keys, "_slice", value).agg(F.count("*").alias("_c"))
    pieces = runs.groupBy(*keys, "_slice").agg(
        F.sum("_c").alias("_n"),
        F.count("*").alias("_d"),
        first.alias("_first"),
        last.alias("_last"),
        (F.sum("_c") - last_rows + 1).alias("_last_rank"),
        first_rows.alias("_first_end"),
    )
    group = W.partitionBy(*(keys or [F.lit(0)]))
    in_order = group.orderBy("_slice")
    before = in_order.rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.withColumn(
        "_merged", F.when(F.lag("_last").over(in_order) == F.col("_first"), 1).otherwise(0)
    ).withColumns(
        {
            "_before": F.coalesce(F.sum("_n").over(before), F.lit(0)),
            "_dense_before": F.coalesce(F.sum("_d").over(before), F.lit(0))
            - F.sum("_merged").over(in_order.rowsBetween(W.unboundedPreceding, 0)),
            "_total": F.sum("_n").over(group),
        }
    )
    # A run of equal values may cross slices: the true start and end of the runs at slice edges
    edges = pieces.select(
        *keys,
        F.explode(
            F.array(
                F.struct(
                    F.col("_first").alias("run"),
                    (F.col("_before") + 1).alias("start"),
                    (F.col("_before") + F.col("_first_end")).alias("stop"),
                ),
                F.struct(
                    F.col("_last").alias("run"),
                    (F.col("_before") + F.col("_last_rank")).alias("start"),
                    (F.col("_before") + F.col("_n")).alias("stop"),
                ),
            )
        ).alias("e"),
    )
    edges = edges.groupBy(*keys, F.col("e.run").alias("run")).agg(
        F.min("e.start").alias("start"), F.max("e.stop").alias("stop")
    )

    def with_edge(left: DataFrame, at: str) -> DataFrame:
        right = edges.withColumnsRenamed(
            {**{k: f"_e_{k}" for k in keys}, "run": "_run", "start": f"{at}_start", "stop": f"{at}_stop"}
        )
        condition = left[at].eqNullSafe(right["_run"])
        for key in keys:
            condition = condition & left[key].eqNullSafe(right[f"_e_{key}"])
        return left.join(right, condition).drop("_run", *[f"_e_{k}" for k in keys])

    pieces = with_edge(with_edge(pieces, "_first"), "_last")
    local = W.partitionBy("_slice", *keys)
    peers = local.orderBy(*sort_columns(order[:1]))
    rows = rows.withColumns(
        {
            "_rn": F.row_number().over(local.orderBy(*sort_columns(order))),
            "_rank": F.rank().over(peers),
            "_dense": F.dense_rank().over(peers),
            "_end": F.count("*").over(peers.rangeBetween(W.unboundedPreceding, 0)),
        }
    )
    joined = join_pieces(rows, pieces, keys)
    here = F.struct(F.col(value))
    at_first = here.eqNullSafe(F.col("_first"))
    at_last = here.eqNullSafe(F.col("_last"))
    rank = (
        F.when(at_first, F.col("_first_start"))
        .when(at_last, F.col("_last_start"))
        .otherwise(F.col("_before") + F.col("_rank"))
    )
    stop = (
        F.when(at_first, F.col("_first_stop"))
        .when(at_last, F.col("_last_stop"))
        .otherwise(F.col("_before") + F.col("_end"))
    )
    position = F.col("_before") + F.col("_rn")
    total = F.col("_total")
    return joined.select(
        *df.columns,
        position.alias("row_num"),
        tile(position, total, tiles).cast("long").alias("tile_no"),
        rank.alias("rank_no"),
        (F.col("_dense_before") + F.col("_dense")).alias("dense_rank_no"),
        F.when(total > 1, (rank - 1) / (total - 1)).otherwise(0.0).alias("pct_rank"),
        (stop / total).alias("cume"),
    )


def framed(
    df: DataFrame,
    keys: list[str],
    order: Order,
    build: Callable[[WindowSpec], dict[str, Column]],
    back: int,
    ahead: int,
    group_rows: int = GROUP_ROWS,
    block: int = FRAME_BLOCK,
    sliced: bool | None = None,
) -> DataFrame:
    """Add window columns that look at most ``back`` rows behind and ``ahead`` rows on (lag, lead, ROWS frames).

    Large groups are cut into blocks of ``block`` consecutive rows; the few rows near a block edge are copied into
    the neighbour block, so every frame is complete inside its block.
    """
    if sliced is None:
        sliced = needs_slices(df, keys, group_rows)
    if not sliced:
        return df.withColumns(build(W.partitionBy(*(keys or [F.lit(0)])).orderBy(*sort_columns(order))))
    placed = running(df, keys, order, position="_pos", sliced=True)
    at = F.col("_pos") - 1
    spread = placed.withColumn("_own", F.floor(at / block)).withColumn(
        "_block",
        F.explode(
            F.sequence(F.floor(F.greatest(at - ahead, F.lit(0)) / block), F.floor((at + back) / block))
        ),
    )
    window = W.partitionBy(*keys, "_block").orderBy("_pos")
    return spread.withColumns(build(window)).filter("_block = _own").drop("_pos", "_own", "_block")


def attach_group(df: DataFrame, keys: list[str], aggregates: dict[str, Column]) -> DataFrame:
    """Add whole-group values: aggregate once (combined before the shuffle), then join back.

    The group table is counted; within the bound it is broadcast and the rows are not shuffled at all.
    """
    stats = settle(df.groupBy(*[F.col(k).alias(f"_g_{k}") for k in keys]).agg(
        *[c.alias(name) for name, c in aggregates.items()]
    ))
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_g_{key}"))
    return df.join(stats, condition).drop(*[f"_g_{k}" for k in keys])


def value_range_mean(
    df: DataFrame, keys: list[str], value: str, reach: float, out: str, group_rows: int = GROUP_ROWS, digits: int = DIGITS
) -> DataFrame:
    """Mean of ``value`` over rows of the group whose value lies within ``reach`` of this row's value.

    A RANGE frame adds up its rows again for every row, which is quadratic where values lie close. Instead the rows
    collapse to distinct values; two probes per value (just below ``v - reach`` and at ``v + reach``) are placed among
    them, and the frame is the difference of the running count and sum at the probes.
    """
    sliced = needs_slices(df, keys, group_rows // 3)  # each value makes up to three marks
    points = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_c"))
    # decimal totals: the difference of two large running sums must not lose digits
    amount = strict(value, digits)
    marks = points.select(
        *keys,
        F.col(value).alias("_v"),
        F.explode(
            F.array(
                F.struct(F.col(value).alias("x"), F.lit(1).alias("side"), F.col("_c").alias("c"),
                         (amount * F.col("_c")).cast(f"decimal(38,{digits})").alias("s")),
                F.struct((F.col(value) - reach).alias("x"), F.lit(0).alias("side"), F.lit(0).cast("long").alias("c"),
                         F.lit(0).cast(f"decimal(38,{digits})").alias("s")),
                F.struct((F.col(value) + reach).alias("x"), F.lit(2).alias("side"), F.lit(0).cast("long").alias("c"),
                         F.lit(0).cast(f"decimal(38,{digits})").alias("s")),
            )
        ).alias("m"),
    ).select(*keys, "_v", "m.*")
    summed = running(
        marks, keys, [("x", False), ("side", False), ("_v", False)], {"_rc": "c", "_rs": "s"}, sliced=sliced
    )
    sign = F.when(F.col("side") == 2, 1).when(F.col("side") == 0, -1)
    means = summed.filter("side <> 1").groupBy(*[F.col(k).alias(f"_g_{k}") for k in keys], "_v").agg(
        quotient(F.sum(sign * F.col("_rs")), F.sum(sign * F.col("_rc")), digits).alias(out)
    )
    condition = F.col(value) == F.col("_v")
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_g_{key}"))
    return df.join(means, condition, "left").drop("_v", *[f"_g_{k}" for k in keys])
