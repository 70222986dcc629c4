"""Aggregates of the points within intervals, by sums of time buckets.

Points are added up once a bucket, and buckets to buckets FAN times as wide, and so on. An interval takes whole buckets as
they stand, the widest that fit, and meets single points only in the two buckets that its ends lie in. So what
is shuffled is bounded by the points and a fixed number of buckets an interval, not by the pairs of a point and an interval.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets that one of the next level holds, and levels of buckets.
FAN, LEVELS = 16, 5
#: How partial results of each kind come together; a count is a sum of ones.
MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


def _run(low: Column, high: Column) -> Column:
    """The whole numbers from low up to, not including, high."""
    return F.when(low < high, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))


def _at_level(buckets: Column, level: int) -> Column:
    return F.transform(buckets, lambda b: F.struct(F.lit(level).alias("level"), b.alias("bucket")))


def _whole_buckets(first: Column, end: Column) -> Column:
    """(level, bucket) of the widest buckets that make up the narrow ones from first up to, not including, end: under 2 * FAN a level but the last."""
    found = []
    for level in range(LEVELS):
        wider_first, wider_end = F.ceil(first / FAN), F.floor(end / FAN)
        if level == LEVELS - 1:
            buckets = _run(first, end)
        else:
            some = wider_first < wider_end
            buckets = F.when(some, F.concat(_run(first, wider_first * FAN), _run(wider_end * FAN, end))).otherwise(_run(first, end))
        found.append(_at_level(buckets, level))
        first, end = wider_first, wider_end
    return F.concat(*found)


def range_aggregate(
    points: DataFrame,
    intervals: DataFrame,
    at: str,
    low: str,
    high: str,
    parts: Mapping[str, tuple[str, Column]],
    key: Sequence[str],
    by: Sequence[str] = (),
    also: Sequence[str] = (),
    bucket_seconds: int = 21_600,
) -> DataFrame:
    """key, also, and each part over the points with low <= at < high and equal `by` columns; intervals without a point have no row.

    parts: name to (kind, expression of the point), kinds "sum", "min" and "max"; means and shares are made of sums. key names an
    interval, and has the `by` columns; `also` are columns of the points that groups are told apart by, nulls
    alike. Null keys, points without a time, and intervals with a null or reversed bound match nothing.
    """
    width = bucket_seconds * 1_000_000
    rows = points.where(F.col(at).isNotNull()).select(*by, *also, F.unix_micros(at).alias("_t"), *[expression.alias(name) for name, (_, expression) in parts.items()])
    rows = rows.withColumn("_bucket", F.floor(F.col("_t") / width))
    merge = [MERGE[kind](name).alias(name) for name, (kind, _) in parts.items()]
    narrow = rows.groupBy(*by, *also, "_bucket").agg(*merge)
    step = F.element_at(F.array(*[F.lit(FAN**n) for n in range(LEVELS)]), F.col("_level") + 1)
    leveled = narrow.withColumn("_level", F.explode(F.array(*map(F.lit, range(LEVELS))))).withColumn("_bucket", F.floor(F.col("_bucket") / step))
    sums = leveled.groupBy(*by, *also, "_level", "_bucket").agg(*merge)

    bounds = intervals.where(F.col(low) < F.col(high)).select(*[F.col(c).alias(f"_k_{c}") for c in key], F.unix_micros(low).alias("_low"), F.unix_micros(high).alias("_high"))
    first, end = F.ceil(F.col("_low") / width), F.floor(F.col("_high") / width)
    ends = F.array_distinct(F.array(F.floor(F.col("_low") / width), F.floor((F.col("_high") - 1) / width)))
    same = lambda other: [other[c] == F.col(f"_k_{c}") for c in by]
    columns = [*[F.col(f"_k_{c}").alias(c) for c in key], *[F.col(c) for c in (*also, *parts) if c not in key]]

    cut = bounds.withColumn("_at", F.explode(F.filter(ends, lambda b: (b < first) | (b >= end))))
    met = rows.join(cut, [*same(rows), F.col("_bucket") == F.col("_at"), F.col("_t") >= F.col("_low"), F.col("_t") < F.col("_high")]).select(columns)
    whole = bounds.withColumn("_at", F.explode(_whole_buckets(first, end)))
    taken = sums.join(whole, [*same(sums), F.col("_level") == F.col("_at.level"), F.col("_bucket") == F.col("_at.bucket")]).select(columns)
    return met.unionByName(taken).groupBy(*key, *[c for c in also if c not in key]).agg(*merge)
