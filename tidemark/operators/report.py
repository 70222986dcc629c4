"""The status snapshot of each entity, as one row and as JSON, and the figures that go with it."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StructType

from tidemark.functions.numbers import json_number
from tidemark.functions.times import hours_between
from tidemark.operators.keyed import upsert
from tidemark.operators.latest import newest_each


def value_or_reason(value: Column, reason: str, **more: Column) -> Column:
    """struct(value, unavailable, ...): a value, or why there is none."""
    return F.struct(value.alias("value"), F.when(value.isNull(), reason).alias("unavailable"), *[c.alias(n) for n, c in more.items()])


def snapshot(episodes: DataFrame, events: DataFrame, forecasts: DataFrame, levels: DataFrame, by: Sequence[str], now: Column, stale_days: float = 7.0) -> DataFrame:
    """Each entity's state at `now`: last episode, events of the last day, newest forecast if not stale, newest level.

    episodes: episode_no, start, pause; events: time, magnitude; forecasts: issued, window_start,
    window_end; levels: time, level. Entities are those with an episode begun by `now`.
    """
    begun = newest_each(episodes.where(F.col("start") <= now), by, ["episode_no"]).select(*by, "episode_no", "start", "pause")
    day = events.where((F.col("time") <= now) & (hours_between(now, "time") < 24)).groupBy(*by).agg(F.count("*").alias("n_24h"), F.max("magnitude").alias("max_24h"))
    newest = newest_each(forecasts.where(F.col("issued") <= now), by, ["issued", "event_id"]).select(*by, "issued", "window_start", "window_end")
    level = newest_each(levels.where(F.col("time") <= now), by, ["time", "event_id"]).select(*by, "level", F.col("time").alias("level_since"))
    out = begun.join(day, list(by), "left").join(newest, list(by), "left").join(level, list(by), "left")
    fresh = hours_between(now, "issued") <= stale_days * 24
    ended = F.col("pause") <= now
    return out.select(
        *by, "episode_no",
        F.when(ended, "paused").otherwise("active").alias("state"),
        F.when(ended, F.round(hours_between(now, "pause"), 2)).alias("hours_since_pause"),
        F.coalesce("n_24h", F.lit(0)).alias("n_24h"), "max_24h", "level",
        F.when(fresh, F.col("window_start")).alias("window_start"), F.when(fresh, F.col("window_end")).alias("window_end"),
        F.when(F.col("issued").isNull(), "no forecast").when(~fresh, "stale forecast").alias("forecast_unavailable"),
    )


def json_of(value: Column, kind: DataType) -> Column:
    """A value as JSON text with its nulls: what to_json gives, but for numbers, which have no exponent where other writers have none."""
    if isinstance(kind, StructType):
        fields = [F.concat(F.lit(f"{json.dumps(f.name)}:"), json_of(value[f.name], f.dataType)) for f in kind]
        return F.when(value.isNull(), "null").otherwise(F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}")))
    if isinstance(kind, (DoubleType, FloatType)):
        return F.coalesce(json_number(value), F.lit("null"))
    listed = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def as_json(snap: DataFrame, by: Sequence[str]) -> DataFrame:
    """The snapshot as one JSON text each, with values or reasons."""
    doc = F.struct(
        F.struct("episode_no", "state", "hours_since_pause").alias("episode"),
        F.struct("n_24h", "max_24h").alias("events"),
        value_or_reason(F.col("level"), "no level").alias("level"),
        F.struct("window_start", "window_end", F.col("forecast_unavailable").alias("unavailable")).alias("forecast"),
    )
    whole = snap.select(*by, doc.alias("_doc"))
    return whole.select(*by, json_of(F.col("_doc"), whole.schema["_doc"].dataType).alias("json"))


def record(log: DataFrame, snap: DataFrame, by: Sequence[str], generated: Column) -> DataFrame:
    """The log of snapshots with this one's headline figures, for later scoring; one row for each entity and instant."""
    new = snap.select(*by, generated.alias("generated"), "episode_no", "state", "n_24h", "level", "window_start", "window_end", F.lit(0).alias("_seq"))
    return upsert(log, new, [*by, "generated"], ["_seq"])


def figure_series(episodes: DataFrame, daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Points of a trajectory: 0 at the start, minus the drop at the pause, then minus the drop plus each day's recovery.

    episodes: episode_no, start, pause, drop; daily: episode_no, observed, recovered.
    """
    key = [*by, "episode_no"]
    start = episodes.select(*key, F.col("start").alias("at"), F.lit(0.0).alias("level"))
    pause = episodes.where(F.col("drop").isNotNull()).select(*key, F.col("pause").alias("at"), (-F.col("drop")).alias("level"))
    after = daily.join(episodes.select(*key, "drop"), key).where(F.col("drop").isNotNull()).select(*key, F.col("observed").alias("at"), (F.col("recovered") - F.col("drop")).alias("level"))
    return start.unionByName(pause).unionByName(after).where(F.col("at").isNotNull())


def digest(episodes: DataFrame, by: Sequence[str], now: Column, k: int = 3, windows: DataFrame | None = None) -> DataFrame:
    """The last k episodes of each series, the hours since the last pause, and, given stated windows, the newest issue's first that isn't over.

    windows: by, issued, window_start, window_end; of one issue the window that starts first counts, and windows issued after `now` don't.
    """
    last = newest_each(episodes.where(F.col("start") <= now), by, ["episode_no"], k)
    out = last.groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct("episode_no", "start", "duration_hours")), asc=False).alias("last_episodes"),
        F.round(F.min(F.when(F.col("pause") <= now, hours_between(now, "pause"))), 2).alias("hours_since_pause"),
    )
    if windows is None:
        return out
    coming = windows.where((F.col("issued") <= now) & (F.col("window_end") >= now))
    stated = coming.groupBy(*by).agg(F.min_by(F.struct("issued", "window_start", "window_end"), F.struct(-F.unix_micros("issued"), "window_start", "window_end")).alias("_w"))
    return out.join(stated, list(by), "left").select(*out.columns, F.col("_w.issued").alias("issued"), F.col("_w.window_start").alias("window_start"), F.col("_w.window_end").alias("window_end"))
