"""The tables of a data folder read as episodes, events, samples, readings and forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.times import hours_between
from tidemark.session import read_table, spread


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    e = read_table(spark, sf_dir, "events")
    return e.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    o = read_table(spark, sf_dir, "orders")
    return o.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))


def told_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders for queries that make a text of each and read it, dealt over all cores."""
    return spread(orders(spark, sf_dir))


def episodes(ev: DataFrame) -> DataFrame:
    """Sign-ups of a user, numbered; each lasts as many minutes as its value; the last one goes on."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = ev.where("event_type = 'signup'").withColumn("episode_no", F.row_number().over(w)).withColumn("_next", F.lead("ts").over(w))
    pause = F.timestamp_micros(F.unix_micros("ts") + F.round(F.col("value") * 60).cast("long") * 1_000_000)
    return e.select(
        "user_id", "episode_no", F.col("ts").alias("start"), pause.alias("pause"), (F.col("value") / 60).alias("duration_hours"), F.col("value").alias("volume"), "k",
        F.when(F.col("_next").isNull(), 1).otherwise(0).alias("is_ongoing"), hours_between("_next", pause).alias("repose_hours"),
    )


def quakes(ev: DataFrame) -> DataFrame:
    return ev.where("event_type <> 'signup'").select("user_id", "event_id", F.col("ts").alias("time"), (F.col("value") / 100).alias("magnitude"), (F.col("k") / 10).alias("depth"))


def samples(ev: DataFrame) -> DataFrame:
    return ev.select("user_id", F.col("event_type").alias("station"), "ts", F.col("value").alias("east"), F.col("k").cast("double").alias("north"), (F.col("user_id") % 7).alias("segment"))


def readings(ev: DataFrame, eps: DataFrame) -> DataFrame:
    """Other events as readings of the episode that began last: kind by type, station by k."""
    from tidemark.operators.intervals import as_of_backward

    r = ev.where("event_type <> 'signup'").select(
        "user_id", "event_id", F.col("ts").alias("observed"), F.to_date("ts").alias("day"), F.col("value").alias("magnitude"),
        F.when(F.col("k") % 3 < 2, F.concat(F.lit("s"), F.col("k") % 3)).alias("station"),
        F.when(F.col("event_type") == "click", "deflation_episode").when(F.col("event_type") == "view", "inflation_cumulative").when(F.col("event_type") == "purchase", "change_24h").otherwise("other").alias("kind"),
        F.when(F.col("k") % 2 == 0, "about").otherwise("exact").alias("qualifier"),
    )
    found = as_of_backward(r, eps.select("user_id", "start", "episode_no"), "observed", "start", "episode_no", ["user_id"], "episode_no")
    return found.where(F.col("episode_no").isNotNull())


def forecasts(ev: DataFrame) -> DataFrame:
    """Views as forecasts: a window that begins k hours after the view and lasts `value` hours."""
    hours = lambda c: F.round(F.col(c) * 3600).cast("long") * 1_000_000
    start = F.unix_micros("ts") + hours("k")
    return ev.where("event_type = 'view'").select("user_id", "event_id", F.col("ts").alias("issued"), F.timestamp_micros(start).alias("window_start"), F.timestamp_micros(start + hours("value")).alias("window_end"))


#: The same in DuckDB.
SQL = """
    WITH ev AS (
        SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
    ep AS (
        SELECT user_id, episode_no, ts AS start, pause, value / 60 AS duration_hours, value AS volume, k,
               CASE WHEN nxt IS NULL THEN 1 ELSE 0 END AS is_ongoing, (epoch_us(nxt) - epoch_us(pause)) / 3600000000.0 AS repose_hours
        FROM (SELECT *, row_number() OVER w AS episode_no, lead(ts) OVER w AS nxt,
                     make_timestamp(epoch_us(ts) + CAST(round(value * 60) AS BIGINT) * 1000000) AS pause
              FROM ev WHERE event_type = 'signup' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))),
    base AS (
        SELECT e.*, p.pause AS prev_pause, p.duration_hours AS prev_duration_hours, p.volume AS prev_volume, p.repose_hours AS repose_before_hours,
               q.volume AS prev2_volume, q.repose_hours AS prev2_repose_hours,
               coalesce(p.pause, e.start - INTERVAL 24 HOUR) AS window_start
        FROM ep e LEFT JOIN ep p ON p.user_id = e.user_id AND p.episode_no = e.episode_no - 1
                  LEFT JOIN ep q ON q.user_id = e.user_id AND q.episode_no = e.episode_no - 2),
    qk AS (SELECT user_id, event_id, ts AS time, value / 100 AS magnitude, k / 10 AS depth FROM ev WHERE event_type <> 'signup'),
    smp AS (SELECT user_id, event_type AS station, ts, value AS east, CAST(k AS DOUBLE) AS north, user_id % 7 AS segment FROM ev),
    feats AS (
        SELECT b.user_id, b.episode_no, count(q.event_id) AS n_events,
               count(*) FILTER (q.depth < 5) AS n_shallow, count(*) FILTER (q.depth >= 5) AS n_deep,
               max(magnitude) AS max_mag, avg(magnitude) AS mean_mag, sum(pow(10.0, 1.5 * magnitude + 9.1)) AS moment_sum,
               count(*) FILTER (q.time >= b.start - INTERVAL 24 HOUR) AS n_24h, count(*) FILTER (q.time >= b.start - INTERVAL 72 HOUR) AS n_72h,
               avg(depth) AS mean_depth
        FROM base b LEFT JOIN qk q ON q.user_id = b.user_id AND q.time >= b.window_start AND q.time < b.start
        GROUP BY ALL),
    hourly AS (
        SELECT user_id, station, date_trunc('hour', ts) AS hour, avg(east) AS east_mean, avg(north) AS north_mean,
               CASE WHEN count(east) > 1 THEN stddev_samp(east) END AS east_std, count(DISTINCT segment) AS n_segments
        FROM smp GROUP BY ALL),
    ranges AS (
        SELECT b.user_id, b.episode_no, h.station, count(*) AS n_hours, max(east_mean) - min(east_mean) AS east_range,
               max(north_mean) - min(north_mean) AS north_range, avg(east_std) AS east_std_mean,
               count(*) FILTER (n_segments > 1) AS relevelled_hours
        FROM base b JOIN hourly h ON h.user_id = b.user_id AND h.hour >= b.window_start AND h.hour < b.start
        GROUP BY ALL),
    rd AS (
        SELECT * FROM (
            SELECT e.user_id, e.event_id, e.ts AS observed, CAST(e.ts AS DATE) AS day, e.value AS magnitude,
                   CASE WHEN e.k % 3 < 2 THEN 's' || (e.k % 3) END AS station,
                   CASE event_type WHEN 'click' THEN 'deflation_episode' WHEN 'view' THEN 'inflation_cumulative' WHEN 'purchase' THEN 'change_24h' ELSE 'other' END AS kind,
                   CASE WHEN e.k % 2 = 0 THEN 'about' ELSE 'exact' END AS qualifier,
                   (SELECT max(episode_no) FROM ep WHERE ep.user_id = e.user_id AND ep.start <= e.ts) AS episode_no
            FROM ev e WHERE event_type <> 'signup') WHERE episode_no IS NOT NULL),
    fc AS (
        SELECT user_id, event_id, ts AS issued, make_timestamp(s) AS window_start, make_timestamp(s + CAST(round(value * 3600) AS BIGINT) * 1000000) AS window_end
        FROM (SELECT *, epoch_us(ts) + CAST(k AS BIGINT) * 3600000000 AS s FROM ev WHERE event_type = 'view')),
    scored AS (
        SELECT *, round((epoch_us(target_onset) - epoch_us(issued)) / 3600000000.0, 2) AS lead_hours,
               CASE WHEN target_onset IS NULL THEN NULL WHEN target_onset BETWEEN window_start AND window_end THEN 1 ELSE 0 END AS hit,
               CASE WHEN target_onset IS NULL THEN NULL
                    WHEN target_onset > window_end THEN round((epoch_us(target_onset) - epoch_us(window_end)) / 3600000000.0, 2)
                    WHEN target_onset < window_start THEN round((epoch_us(target_onset) - epoch_us(window_start)) / 3600000000.0, 2) ELSE 0 END AS error_hours,
               round((epoch_us(window_end) - epoch_us(window_start)) / 86400000000.0, 3) AS window_days
        FROM (SELECT fc.*, (SELECT min(start) FROM ep WHERE ep.user_id = fc.user_id AND ep.start > fc.issued) AS target_onset FROM fc)),
    dmax AS (
        SELECT r.user_id, r.episode_no, r.station, r.day, max(magnitude) AS magnitude, arg_max(observed, (magnitude, observed)) AS observed,
               arg_max((epoch_us(observed) - epoch_us(pause)) / 86400000000.0, (magnitude, observed)) AS days_since_pause,
               arg_max(qualifier, (magnitude, observed)) AS qualifier
        FROM rd r JOIN ep USING (user_id, episode_no) WHERE kind = 'inflation_cumulative' AND observed >= pause GROUP BY ALL)
"""
