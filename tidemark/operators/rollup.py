"""Aggregations: hourly and daily rollups, coverage, counts by condition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import haversine_km, moment


def hourly_rollup(df: DataFrame, by: Sequence[str], time: str, channels: Sequence[str], segment: str | None = None) -> DataFrame:
    """Mean, least, greatest and sample deviation of each channel an hour, the rows, and the distinct non-empty segments.

    The deviation of fewer than two values is null. Rows without a time are left out.
    """
    stats = [f(c).alias(f"{c}_{n}") for c in channels for n, f in (("mean", F.avg), ("min", F.min), ("max", F.max), ("std", F.stddev_samp))]
    extra = [F.count_distinct(F.nullif(F.col(segment).cast("string"), F.lit(""))).alias("n_segments")] if segment else []
    return df.where(F.col(time).isNotNull()).groupBy(*by, F.date_trunc("hour", time).alias("hour")).agg(*stats, F.count("*").alias("n"), *extra)


def event_stats(magnitude: str, depth: str, split: float = 5.0) -> list[Column]:
    """The counts and sums of a group of events: shallow and deep, greatest magnitude, mean depth, moment."""
    d = F.col(depth)
    return [
        F.count("*").alias("n_events"),
        F.sum(F.when(d < split, 1).otherwise(0)).alias("n_shallow"),
        F.sum(F.when(d >= split, 1).otherwise(0)).alias("n_deep"),
        F.max(magnitude).alias("max_mag"),
        F.avg(depth).alias("mean_depth"),
        F.sum(moment(magnitude)).alias("moment_sum"),
    ]


def daily_activity(df: DataFrame, time: str, magnitude: str, depth: str) -> DataFrame:
    return df.groupBy(F.to_date(time).alias("day")).agg(*event_stats(magnitude, depth))


def coverage(tables: Mapping[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """tbl, n, t0, t1 of each table; tables without a time column have null spans."""
    rows = []
    for name, (t, time) in tables.items():
        span = [F.min(time).cast("string"), F.max(time).cast("string")] if time else [F.lit(None).cast("string")] * 2
        rows.append(t.agg(F.lit(name).alias("tbl"), F.count("*").alias("n"), span[0].alias("t0"), span[1].alias("t1")))
    return reduce(DataFrame.unionByName, rows)


def radius_counts(df: DataFrame, time: str, lat: str, lon: str, lat0: float, lon0: float, now, hours: float = 24, radii: Sequence[float] = (5, 10, 20), by: Sequence[str] = ()) -> DataFrame:
    """Events of the last hours within each radius, in one pass."""
    km = haversine_km(lat, lon, lat0, lon0)
    recent = (F.col(time) > now - F.expr(f"INTERVAL {int(hours * 3600)} SECONDS")) & (F.col(time) <= now)
    counts = [F.sum(F.when(recent & (km <= r), 1).otherwise(0)).alias(f"n_{r:g}km") for r in radii]
    return df.groupBy(*by).agg(*counts) if by else df.agg(*counts)


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def distinct_sketches(df: DataFrame, by: Sequence[str], time: str, value: str, log_size: int = 14) -> DataFrame:
    """by, hour and a sketch of the hour's distinct values, which unite over hours, days and keys; an estimate has a standard error of about 1.04 / sqrt(2^log_size)."""
    known = df.where(F.col(time).isNotNull() & F.col(value).isNotNull())
    return known.groupBy(*by, F.date_trunc("hour", time).alias("hour")).agg(F.hll_sketch_agg(F.col(value), F.lit(log_size)).alias("sketch"))


def united(sketches: DataFrame, *by: Column | str) -> DataFrame:
    """About how many distinct values the sketches of each group have together: by, n_distinct."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))
