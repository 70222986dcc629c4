"""Joins of points with intervals, as-of joins, and lags over a long order, none of which sorts a whole table in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Time buckets that one interval is spread over at most; longer ones are compared with coarser buckets.
MOST_BUCKETS = 512


def interval_join(points: DataFrame, intervals: DataFrame, at: str, low: str, high: str, by: Sequence[str] = (), bucket_seconds: int = 86_400) -> DataFrame:
    """Inner join: low <= at < high, and equal `by` columns.

    Both sides meet in time buckets, beside the `by` columns if there are any: an interval goes to each
    bucket that it touches, a point to its own, so a key with many points and many intervals doesn't
    compare them all. Intervals over more than MOST_BUCKETS buckets meet points in buckets MOST_BUCKETS
    times as wide, so a long interval doesn't become a row for each day of a century; the wide buckets are
    the narrow ones' numbers divided, so one point row serves both. Null keys, and intervals with a null or
    reversed bound, match nothing.
    """
    seconds = lambda c: F.floor(F.unix_micros(F.col(c)) / 1_000_000)
    renamed = intervals.select([F.col(c).alias(f"_{c}") if c in by else F.col(c) for c in intervals.columns])
    sound = renamed.where(F.col(low) < F.col(high))
    narrow = lambda c: F.floor(seconds(c) / bucket_seconds)
    wide = lambda c: F.floor(narrow(c) / MOST_BUCKETS)
    short = narrow(high) - narrow(low) < MOST_BUCKETS
    step = F.when(short, 0).otherwise(1)
    buckets = F.when(short, F.sequence(narrow(low), narrow(high))).otherwise(F.sequence(wide(low), wide(high)))
    right = sound.withColumn("_step", step).withColumn("_bucket", F.explode(buckets))
    left = points.withColumn("_p", F.explode(F.array(F.struct(F.lit(0).alias("s"), narrow(at).alias("b")), F.struct(F.lit(1).alias("s"), wide(at).alias("b")))))
    on = [F.col("_p.s") == F.col("_step"), F.col("_p.b") == F.col("_bucket"), *[points[c] == F.col(f"_{c}") for c in by], F.col(at) >= F.col(low), F.col(at) < F.col(high)]
    return left.join(right, on).drop("_p", "_step", "_bucket", *[f"_{c}" for c in by])


def with_prior(df: DataFrame, number: str, columns: dict[int, dict[str, str]], by: Sequence[str] = ()) -> DataFrame:
    """Left self-joins to number - n: columns[n] maps a source column to its new name. Missing numbers give null, unlike lag."""
    out = df
    for n, names in columns.items():
        prior = df.select(*by, (F.col(number) + n).alias(number), *[F.col(c).alias(new) for c, new in names.items()])
        out = out.join(prior, [*by, number], "left")
    return out


def _as_of(left: DataFrame, right: DataFrame, time: str, right_time: str, value: Column, by: Sequence[str], name: str, forward: bool, strict: bool) -> DataFrame:
    """Union of both sides, each key in order of time; the right side stands so at equal times that strictness holds."""
    right_first = strict == forward
    marked = left.withColumn("_side", F.lit(1 if right_first else 0)).withColumn("_t", F.col(time)).withColumn("_v", F.lit(None).cast(right.select(value.alias("v")).schema["v"].dataType))
    other = right.select(*by, F.lit(0 if right_first else 1).alias("_side"), F.col(right_time).alias("_t"), value.alias("_v"))
    rows = marked.withColumn("_left", F.lit(True)).unionByName(other.withColumn("_left", F.lit(False)), allowMissingColumns=True)
    # forward is backward in falling order: a frame up to the end of a partition is gone through anew for each row
    order = (F.desc("_t"), F.desc("_side")) if forward else ("_t", "_side")
    found = F.last("_v", ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn(name, found).where("_left").drop("_side", "_t", "_v", "_left")


def as_of_forward(left: DataFrame, right: DataFrame, time: str, right_time: str, value, by: Sequence[str], name: str, strict: bool = True) -> DataFrame:
    """left with `name`: the value of the first right row after its time (or at it, unless strict), within each key.

    Keys spread the work; a table without a key uses as_of_forward_bucketed.
    """
    return _as_of(left, right, time, right_time, F.col(value) if isinstance(value, str) else value, by, name, True, strict)


def as_of_backward(left: DataFrame, right: DataFrame, time: str, right_time: str, value, by: Sequence[str], name: str, strict: bool = False) -> DataFrame:
    """left with `name`: the value of the last right row before its time (or at it, unless strict), within each key."""
    return _as_of(left, right, time, right_time, F.col(value) if isinstance(value, str) else value, by, name, False, strict)


def as_of_forward_bucketed(left: DataFrame, right: DataFrame, time: str, right_time: str, name: str, bucket_seconds: int = 86_400) -> DataFrame:
    """The first right time strictly after each left time, over tables without a key.

    Within time buckets by window; where the rest of a bucket has none, the first of the next bucket
    that has one: a table of one row a bucket, which alone is put in order.
    """
    bucket = lambda c: F.floor(F.unix_micros(F.col(c)) / (1_000_000 * bucket_seconds))
    inside = as_of_forward(left.withColumn("_b", bucket(time)), right.withColumn("_b", bucket(right_time)), time, right_time, right_time, ["_b"], "_near")
    firsts = right.groupBy(bucket(right_time).alias("_b")).agg(F.min(right_time).alias("_m"))
    buckets = firsts.unionByName(left.select(bucket(time).alias("_b"), F.lit(None).cast("timestamp").alias("_m"))).groupBy("_b").agg(F.min("_m").alias("_m"))
    later = buckets.withColumn("_later", F.last("_m", ignorenulls=True).over(Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1))).drop("_m")
    return inside.join(later, "_b", "left").withColumn(name, F.coalesce("_near", "_later")).drop("_b", "_near", "_later")


def as_of_backward_bucketed(left: DataFrame, right: DataFrame, time: str, right_time: str, value: str, name: str, by: Sequence[str] = (), bucket_seconds: int = 86_400) -> DataFrame:
    """left with `name` and `name`_at: the value of the last right row at or before its time, and that row's time; of rows at one time the greatest value.

    For tables without a key, or with a key that has most of the rows. Within time buckets by window; a row before its
    bucket's first right row takes what the last bucket with one carries on: one row a bucket is all that is put
    in order along a key. Rows without a time or a key find nothing, and right rows without them are not found.
    """
    bucket = lambda c: F.floor(F.unix_micros(F.col(c)) / (1_000_000 * bucket_seconds))
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*by, right_time)])
    found = F.struct(F.col(right_time).alias("at"), F.col(value).alias("value"))
    right = right.where(whole).select(*by, bucket(right_time).alias("_b"), F.col(right_time).alias("_t"), found.alias("_v"))
    rows = left.withColumns({"_b": bucket(time), "_t": F.col(time), "_left": F.lit(True)})
    near = rows.unionByName(right.withColumn("_left", F.lit(False)), allowMissingColumns=True)
    inside = Window.partitionBy(*by, "_b").orderBy("_t", "_left", F.asc_nulls_first("_v")).rowsBetween(Window.unboundedPreceding, -1)
    near = near.withColumn("_near", F.last("_v", ignorenulls=True).over(inside)).where("_left").drop("_v", "_t", "_left")
    every = right.groupBy(*by, "_b").agg(F.max("_v").alias("_m")).unionByName(rows.select(*by, "_b").distinct(), allowMissingColumns=True).groupBy(*by, "_b").agg(F.max("_m").alias("_m"))
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.where(F.col("_b").isNotNull()).withColumn("_carried", F.last("_m", ignorenulls=True).over(before)).drop("_m")
    out = near.join(carried, [*by, "_b"], "left").withColumn("_near", F.coalesce("_near", "_carried"))
    return out.withColumns({name: F.col("_near.value"), f"{name}_at": F.col("_near.at")}).drop("_b", "_near", "_carried")


def fill_as_of(left: DataFrame, right: DataFrame, time: str, right_time: str, value: str, name: str, source: str, by: Sequence[str] = (), inferred: str = "inferred") -> DataFrame:
    """left, its nulls in `name` filled by as_of_backward_bucketed, and `source`: "stated" where a value stood, `inferred` where one was filled in, else null.

    Stated values are never changed, and only rows without one take part in the join.
    """
    stated = left.where(F.col(name).isNotNull()).withColumn(source, F.lit("stated"))
    filled = as_of_backward_bucketed(left.where(F.col(name).isNull()).drop(name), right, time, right_time, value, name, by)
    filled = filled.drop(f"{name}_at").withColumn(source, F.when(F.col(name).isNotNull(), inferred))
    return stated.unionByName(filled).select(*left.columns, source)


def ordered_lag(df: DataFrame, order: Sequence[str], columns: dict[str, str], bucket: Column) -> DataFrame:
    """lag by one over a whole table: in buckets of the order, then across their edges.

    `bucket` must rise with the order. A bucket's first row takes the last row of the bucket before it;
    only a table of one row a bucket is put in order in one task.
    """
    b = df.withColumn("_b", bucket)
    w = Window.partitionBy("_b").orderBy(*order)
    edge = b.groupBy("_b").agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_last"))
    edge = edge.withColumn("_edge", F.lag("_last").over(Window.orderBy("_b"))).drop("_last")
    out = b.withColumn("_n", F.row_number().over(w))
    for c, new in columns.items():
        out = out.withColumn(new, F.lag(c).over(w))
    out = out.join(edge, "_b", "left")
    for c, new in columns.items():
        out = out.withColumn(new, F.when(F.col("_n") == 1, F.col("_edge")[c]).otherwise(F.col(new)))
    return out.drop("_b", "_n", "_edge")


def gaps(df: DataFrame, day: str, most_days: int, k: int, by: Sequence[str] = ()) -> DataFrame:
    """The k widest gaps of more than most_days between one day and the next."""
    days = df.select(*by, F.col(day)).dropna().distinct()
    if by:
        lagged = days.withColumn("previous", F.lag(day).over(Window.partitionBy(*by).orderBy(day)))
    else:
        lagged = ordered_lag(days, [day], {day: "previous"}, F.year(day))
    wide = lagged.withColumn("gap_days", F.datediff(day, "previous")).where(F.col("gap_days") > most_days)
    return wide.orderBy(F.desc("gap_days"), *by, day).limit(k)


def steps(df: DataFrame, order: Sequence[str], value: str, by: Sequence[str], least: float, k: int) -> DataFrame:
    """The k largest steps, above `least`, from one row to the next within a key."""
    w = Window.partitionBy(*by).orderBy(*order)
    stepped = df.withColumn("step", F.abs(F.col(value) - F.lag(value).over(w))).where(F.col("step") > least)
    return stepped.orderBy(F.desc("step"), *by, *order).limit(k)


def level_changes(df: DataFrame, level: str, order: Sequence[str], by: Sequence[str] = (), bucket: Column | None = None) -> DataFrame:
    """Rows whose level differs from the one before, and the first; rows without a level don't count."""
    known = df.where(F.col(level).isNotNull())
    if by:
        known = known.withColumn("previous", F.lag(level).over(Window.partitionBy(*by).orderBy(*order)))
    else:
        known = ordered_lag(known, order, {level: "previous"}, bucket)
    return known.where(F.col("previous").isNull() | (F.col("previous") != F.col(level)))


def balanced_windows(df: DataFrame, time: str, cap: int, depth: int = 12) -> DataFrame:
    """The coarsest halvings of the whole span that hold fewer than cap rows, empty ones left out.

    Rows are counted once in the 2^depth finest cells and rolled up; cells of the finest level that
    still hold cap rows or more are kept and marked full.
    """
    span = df.agg(F.min(F.unix_micros(time)).alias("t0"), F.max(F.unix_micros(time)).alias("t1")).first()
    if span["t0"] is None:
        return df.sparkSession.createDataFrame([], "level int, cell long, n long, full boolean, t0 timestamp, t1 timestamp")
    t0, width = span["t0"], span["t1"] - span["t0"] + 1
    leaf = F.floor((F.unix_micros(time) - t0) * F.lit(float(2**depth)) / width).cast("long")
    leaves = df.where(F.col(time).isNotNull()).groupBy(leaf.alias("leaf")).agg(F.count("*").alias("n"))
    levels = leaves.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    cells = levels.groupBy("level", F.floor(F.col("leaf") / F.pow(F.lit(2), depth - F.col("level"))).cast("long").alias("cell")).agg(F.sum("n").alias("n"))
    parent = cells.select((F.col("level") + 1).alias("level"), F.col("cell").alias("_p"), F.col("n").alias("_pn"))
    kept = cells.join(parent, (cells["level"] == parent["level"]) & (F.floor(cells["cell"] / 2) == parent["_p"]), "left").select(cells["level"], "cell", "n", "_pn")
    full = F.col("n") >= cap
    kept = kept.where((~full | (F.col("level") == depth)) & (F.col("_pn").isNull() | (F.col("_pn") >= cap)))
    step = F.lit(float(width)) / F.pow(F.lit(2.0), F.col("level"))
    return kept.select(
        F.col("level").cast("int").alias("level"), "cell", "n", full.alias("full"),
        F.timestamp_micros((t0 + F.col("cell") * step).cast("long")).alias("t0"), F.timestamp_micros((t0 + (F.col("cell") + 1) * step).cast("long")).alias("t1"),
    )
