"""Exact values at given ranks of many series, however many of the rows one series has."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shared_table

#: Values of a series that one task puts in order; of more, histograms say first between which values the wanted rank lies.
SORTED_AT_ONCE = 100_000
#: Cells of a histogram.
CELLS = 512


def nth_values(df: DataFrame, by: Sequence[str], value: str, picks: Mapping[str, Column], most: int = SORTED_AT_ONCE) -> DataFrame:
    """by, and for each pick the value at its rank (from 1), an expression of the number `n` of the series' values.

    Nulls and NaN don't count; a series without values has no row; null keys are a series of their own; a rank outside
    1 to n gives null. A series of up to `most` values is put in order by one task. Of a longer one the values are
    counted in equal cells from the least to the greatest, and again within the cell that holds the rank, until
    few enough are left, or equal ones: each round reads the rows and shuffles counts. The first round's cells are
    equal in logarithms to both sides of zero, so that values of all sizes are soon told apart.
    """
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    sizes = rows.groupBy(*by).agg(F.count("*").alias("n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    crowded = F.col("n") > most
    ranks = F.array(*[F.struct(F.lit(name).alias("pick"), rank.cast("long").alias("rank")) for name, rank in picks.items()])
    wanted = sizes.select(*by, F.inline(ranks), "_lo", "_hi", F.col("n").alias("_inside"), "n").where("rank between 1 and n").drop("n")
    long_ones = shared_table(wanted.where(F.col("_inside") > most), "ranks")
    if long_ones.isEmpty():
        return _in_order(rows, sizes, by, picks)
    short = _in_order(rows.join(long_ones.select(*by).distinct(), _same(rows, long_ones, by), "left_anti") if by else rows.where("false"), sizes.where(~crowded), by, picks)
    found = []
    while True:
        narrow = (F.col("_inside") <= most) | (F.col("_lo") == F.col("_hi"))
        found.append(_final(rows, long_ones.where(narrow), by))
        crowd = long_ones.where(~narrow)
        if crowd.isEmpty():
            break
        long_ones = shared_table(_narrowed(rows, crowd, by, len(found) == 1), "ranks")
    each = reduce(DataFrame.unionByName, found)
    far = each.groupBy(*by).agg(*[F.max(F.when(F.col("pick") == name, F.col("_value"))).alias(name) for name in picks])
    return short.unionByName(far)


def _same(left: DataFrame, right: DataFrame, by: Sequence[str]) -> list[Column]:
    return [left[c].eqNullSafe(right[c]) for c in by]


def _in_order(rows: DataFrame, sizes: DataFrame, by: Sequence[str], picks: Mapping[str, Column]) -> DataFrame:
    """The picks of series that are short enough to be put in order at once: an aggregate a series."""
    lists = rows.groupBy(*by).agg(F.sort_array(F.collect_list("_v")).alias("_all")).withColumn("n", F.size("_all").cast("long"))
    at = lambda rank: F.get("_all", (rank - 1).cast("int"))
    return lists.where("n > 0").select(*by, *[at(rank).alias(name) for name, rank in picks.items()])


def _meeting(rows: DataFrame, wanted: DataFrame, by: Sequence[str]) -> DataFrame:
    """The rows between the bounds of each rank that is looked for; there are few such ranks, as each stands for over `most` rows."""
    renamed = wanted.select(*[F.col(c).alias(f"_k_{c}") for c in by], "pick", "rank", "_lo", "_hi")
    on = [*[rows[c].eqNullSafe(renamed[f"_k_{c}"]) for c in by], F.col("_v") >= F.col("_lo"), F.col("_v") <= F.col("_hi")]
    return rows.join(renamed, on).drop(*[f"_k_{c}" for c in by])


def _narrowed(rows: DataFrame, wanted: DataFrame, by: Sequence[str], first: bool) -> DataFrame:
    """One round: the cell of a histogram that holds each rank, with its own least and greatest value."""
    at = (lambda c: F.signum(c) * F.log1p(F.abs(c))) if first else (lambda c: F.col(c) / 2)  # halves, so that no difference is infinite
    share = F.coalesce(F.try_divide(at("_v") - at("_lo"), at("_hi") - at("_lo")), F.lit(0.0))
    cell = F.least(F.floor(share * CELLS), F.lit(CELLS - 1))
    counted = _meeting(rows, wanted, by).groupBy(*by, "pick", "rank", cell.alias("_cell")).agg(F.count("*").alias("_inside"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    before = Window.partitionBy(*by, "pick").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("_below", F.coalesce(F.sum("_inside").over(before), F.lit(0)))
    held = counted.where((F.col("rank") > F.col("_below")) & (F.col("rank") <= F.col("_below") + F.col("_inside")))
    return held.select(*by, "pick", (F.col("rank") - F.col("_below")).alias("rank"), "_lo", "_hi", "_inside")


def _final(rows: DataFrame, wanted: DataFrame, by: Sequence[str]) -> DataFrame:
    """by, pick and the value at its rank, where few rows are left between the bounds, or equal ones."""
    equal = wanted.where("_lo = _hi").select(*by, "pick", F.col("_lo").alias("_value"))
    order = Window.partitionBy(*by, "pick").orderBy("_v")
    near = _meeting(rows, wanted.where("_lo < _hi"), by).withColumn("_n", F.row_number().over(order)).where("_n = rank")
    return equal.unionByName(near.select(*by, "pick", F.col("_v").alias("_value")))
