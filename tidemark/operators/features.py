"""Features of an episode from what was known before it began, and its targets.

An episode has a number within its series (`by` columns, if several series share a table), a start and
a pause. Its window is from the previous episode's pause, or a day before its start, up to its start.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import guarded_ratio, moment
from tidemark.functions.times import days_between, shifted
from tidemark.operators.intervals import interval_join, with_prior
from tidemark.operators.latest import arg_max
from tidemark.operators.range_sums import range_aggregate


def episode_base(episodes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Each episode with the closing state of the two before it, by number: a gap in the numbers gives null."""
    return with_prior(
        episodes,
        "episode_no",
        {
            1: {"pause": "prev_pause", "duration_hours": "prev_duration_hours", "volume": "prev_volume", "repose_hours": "repose_before_hours"},
            2: {"volume": "prev2_volume", "repose_hours": "prev2_repose_hours"},
        },
        by,
    )


def with_window(base: DataFrame) -> DataFrame:
    return base.withColumn("window_start", F.coalesce("prev_pause", shifted("start", -24)))


def event_features(base: DataFrame, events: DataFrame, by: Sequence[str] = (), split: float = 5.0) -> DataFrame:
    """Counts and sums of the events (time, magnitude, depth) in each episode's window; episodes without any keep counts of 0."""
    windows = with_window(base).select(*by, "episode_no", "start", "window_start")
    key, d, one = [*by, "episode_no"], F.col("depth"), F.lit(1).cast("long")
    given = lambda c: F.when(F.col(c).isNotNull(), one)
    parts = {
        "n_events": ("sum", one),
        "n_shallow": ("sum", F.when(d < split, one).otherwise(0)),
        "n_deep": ("sum", F.when(d >= split, one).otherwise(0)),
        "max_mag": ("max", F.col("magnitude")),
        "moment_sum": ("sum", moment("magnitude")),
        "_mag": ("sum", F.col("magnitude")), "_n_mag": ("sum", given("magnitude")), "_depth": ("sum", d), "_n_depth": ("sum", given("depth")),
    }
    # the window, and its last hours, as intervals of one pass
    spans = F.array(*[F.struct(F.lit(h).alias("hours"), (F.greatest("window_start", shifted("start", -h)) if h else F.col("window_start")).alias("low")) for h in (0, 24, 72)])
    spanned = windows.select(*key, "start", F.inline(spans))
    stats = range_aggregate(events, spanned, "time", "low", "start", parts, [*key, "hours"], by)
    of = lambda h, c: F.max(F.when(F.col("hours") == h, F.col(c)))
    stats = stats.withColumns({"mean_mag": F.try_divide("_mag", "_n_mag"), "mean_depth": F.try_divide("_depth", "_n_depth")}).groupBy(*key).agg(
        *[of(0, c).alias(c) for c in ("n_events", "n_shallow", "n_deep", "max_mag", "mean_mag", "moment_sum", "mean_depth")], *[of(h, "n_events").alias(f"n_{h}h") for h in (24, 72)]
    )
    out = base.select(*key).join(stats, key, "left")
    return out.fillna(0, ["n_events", "n_shallow", "n_deep", "n_24h", "n_72h"])


def sample_ranges(base: DataFrame, hourly: DataFrame, by: Sequence[str] = (), station: str = "station", segment_safe: bool = False) -> DataFrame:
    """Per station, the range of hourly means in each episode's window. segment_safe leaves out hours of several segments."""
    windows = with_window(base).select(*by, "episode_no", "start", "window_start")
    if segment_safe:
        hourly = hourly.where(F.coalesce("n_segments", F.lit(1)) <= 1)
    one = F.lit(1).cast("long")
    ends = {f"_{f}_{c}": (f, F.col(f"{c}_mean")) for f in ("min", "max") for c in ("east", "north")}
    parts = ends | {
        "n_hours": ("sum", one),
        "_std": ("sum", F.col("east_std")),
        "_n_std": ("sum", F.when(F.col("east_std").isNotNull(), one)),
        "relevelled_hours": ("sum", F.when(F.col("n_segments") > 1, one).otherwise(0)),
    }
    met = range_aggregate(hourly, windows, "hour", "window_start", "start", parts, [*by, "episode_no"], by, [station])
    return met.select(
        *by, "episode_no", station, "n_hours",
        (F.col("_max_east") - F.col("_min_east")).alias("east_range"),
        (F.col("_max_north") - F.col("_min_north")).alias("north_range"),
        F.try_divide("_std", "_n_std").alias("east_std_mean"),
        "relevelled_hours",
    )


def feature_table(base: DataFrame, events: DataFrame, ranges: DataFrame, station: str, by: Sequence[str] = ()) -> DataFrame:
    """Features on the left, targets on the right, one station's ranges."""
    key = [*by, "episode_no"]
    one = ranges.where(F.col("station") == station).drop("station")
    return base.join(events, key, "left").join(one, key, "left").select(
        *key, "start", "prev_pause", "prev_duration_hours", "prev_volume", "prev2_volume", "prev2_repose_hours", "repose_before_hours",
        "n_events", "n_shallow", "n_deep", "n_24h", "n_72h", "max_mag", "mean_mag", "mean_depth", "moment_sum",
        "n_hours", "east_range", "north_range", "relevelled_hours",
        F.col("repose_hours").alias("target_repose_hours"), F.col("duration_hours").alias("target_duration_hours"), F.col("volume").alias("target_volume"), "is_ongoing",
    )


def onset_target(features: DataFrame) -> DataFrame:
    return features.where(F.col("target_repose_hours").isNotNull())


def size_target(features: DataFrame) -> DataFrame:
    return features.where(F.col("is_ongoing") == 0)


def daily_maximum(readings: DataFrame, episodes: DataFrame, kind: str, by: Sequence[str] = ()) -> DataFrame:
    """Per episode, station and local day after its pause, the row of the greatest cumulative reading."""
    joined = readings.where(F.col("kind") == kind).join(episodes.select(*by, "episode_no", "pause"), [*by, "episode_no"])
    after = joined.where(F.col("pause").isNotNull() & (F.col("observed") >= F.col("pause"))).withColumn("days_since_pause", days_between("observed", "pause"))
    return arg_max(after, [*by, "episode_no", "station", "day"], "magnitude", ["observed", "days_since_pause", "qualifier"], "observed")


def trajectory(readings: DataFrame, daily: DataFrame, by: Sequence[str] = (), drop_kind: str = "deflation_episode", change_kind: str = "change_24h") -> DataFrame:
    """Per episode and station: the drop, the recovery after it (last and greatest, rate, fraction of the drop), the last daily change.

    Stations are compared null-safely; a station's recovery counts only with its own drop, or where both are null.
    """
    key = [*by, "episode_no"]
    drops = readings.where(F.col("kind") == drop_kind).groupBy(*key, "station").agg(F.max("magnitude").alias("drop"), F.min("qualifier").alias("drop_qualifier"))
    recovery = daily.groupBy(*key, "station").agg(
        F.count("*").alias("n_readings"), F.max("magnitude").alias("recovered_max"), F.max("days_since_pause").alias("recovery_days"), F.max_by("magnitude", "observed").alias("recovered_last")
    )
    changes = readings.where(F.col("kind") == change_kind).groupBy(*key, "station").agg(F.max_by("magnitude", "observed").alias("change_last"))
    numbers = readings.select(*key).distinct()
    d = numbers.join(drops, key, "left")
    for other, name in ((recovery, "_r"), (changes, "_c")):
        renamed = other.select(*[F.col(c).alias(f"{name}_{c}") if c in (*key, "station") else F.col(c) for c in other.columns])
        on = [d[c] == renamed[f"{name}_{c}"] for c in key] + [d["station"].eqNullSafe(renamed[f"{name}_station"])]
        d = d.join(renamed, on, "left").drop(*[f"{name}_{c}" for c in (*key, "station")])
    rate = F.round(F.try_divide("recovered_max", F.nullif(F.col("recovery_days"), F.lit(0.0))), 3)
    return d.withColumn("recovery_rate", rate).withColumn("recovery_fraction", F.round(guarded_ratio("recovered_last", "drop"), 4))


def repose_daily_range(episodes: DataFrame, daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per episode and station, the daily positions within the repose that followed it."""
    repose = episodes.where(F.col("pause").isNotNull() & F.col("repose_hours").isNotNull())
    repose = repose.select(*by, "episode_no", "pause", F.timestamp_micros(F.unix_micros("pause") + (F.col("repose_hours") * 3.6e9).cast("long")).alias("repose_end"))
    met = interval_join(daily, repose, "day", "pause", "repose_end", by)
    return met.groupBy(*by, "episode_no", "station").agg(
        F.count("*").alias("days_observed"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.round((F.max("up") - F.min("up")) * 1000, 2).alias("up_range_mm"),
        F.round(F.avg("sigma") * 1000, 2).alias("mean_sigma_mm"),
        F.count_distinct("solution").alias("n_solutions"),
    )


def with_trajectory(features: DataFrame, tracks: DataFrame, station: str, by: Sequence[str] = (), prefix: str = "tn_") -> DataFrame:
    """The feature table with one station's drop and recovery of each episode, and the drop of the episode before, by number."""
    key = [*by, "episode_no"]
    one = tracks.where(F.col("station") == station)
    names = ("drop", "recovered_last", "recovered_max", "recovery_days", "n_readings", "recovery_rate", "recovery_fraction", "change_last")
    own = one.select(*key, *[F.col(c).alias(f"{prefix}{c}") for c in names])
    prior = one.select(*by, (F.col("episode_no") + 1).alias("episode_no"), F.col("drop").alias(f"{prefix}prev_drop"))
    return features.join(own, key, "left").join(prior, key, "left")
