"""Registered queries: each operator over the tables of a data folder, beside the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import days_between, local_date
from tidemark.operators import features, intervals, latest, models, rollup
from tidemark.plans import standins as S

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
USER = ["user_id"]


def query(sql: str | None = None, standins: bool = True):
    """Registers a query under its function's name, with SQL to hold it against."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = (S.SQL if standins else "") + sql
        return f

    return add


def us(c: str):
    return F.unix_micros(c).alias(f"{c}_us")


def r9(*names: str) -> list:
    return [F.round(n, 9).alias(n) for n in names]


@query("""SELECT user_id, episode_no, epoch_us(start) AS start_us, epoch_us(pause) AS pause_us, epoch_us(prev_pause) AS prev_pause_us,
    round(prev_duration_hours, 9) AS prev_duration_hours, prev_volume, round(repose_before_hours, 9) AS repose_before_hours,
    prev2_volume, round(prev2_repose_hours, 9) AS prev2_repose_hours, round(repose_hours, 9) AS repose_hours FROM base""")
def episode_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = features.episode_base(S.episodes(S.events(spark, sf_dir)), USER)
    return b.select("user_id", "episode_no", us("start"), us("pause"), us("prev_pause"), *r9("prev_duration_hours"), "prev_volume", *r9("repose_before_hours"), "prev2_volume", *r9("prev2_repose_hours", "repose_hours"))


def _base_and_features(ev: DataFrame) -> tuple[DataFrame, DataFrame]:
    b = features.episode_base(S.episodes(ev), USER)
    return b, features.event_features(b, S.quakes(ev), USER)


@query("""SELECT user_id, episode_no, n_events, n_shallow, n_deep, n_24h, n_72h, max_mag, round(mean_mag, 9) AS mean_mag, round(mean_depth, 9) AS mean_depth,
    round(log10(moment_sum), 6) AS log_moment FROM feats""")
def episode_event_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, f = _base_and_features(S.events(spark, sf_dir))
    return f.select("user_id", "episode_no", "n_events", "n_shallow", "n_deep", "n_24h", "n_72h", "max_mag", *r9("mean_mag", "mean_depth"), F.round(F.log10("moment_sum"), 6).alias("log_moment"))


def _hourly(ev: DataFrame) -> DataFrame:
    return rollup.hourly_rollup(S.samples(ev), ["user_id", "station"], "ts", ["east", "north"], "segment")


@query("""SELECT user_id, episode_no, station, n_hours, round(east_range, 9) AS east_range, round(north_range, 9) AS north_range,
    round(east_std_mean, 9) AS east_std_mean, relevelled_hours FROM ranges""")
def episode_sample_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = S.events(spark, sf_dir)
    f = features.sample_ranges(features.episode_base(S.episodes(ev), USER), _hourly(ev), USER)
    return f.select("user_id", "episode_no", "station", "n_hours", *r9("east_range", "north_range", "east_std_mean"), "relevelled_hours")


_FEATURES = """SELECT b.user_id, b.episode_no, prev_volume, prev2_volume, round(repose_before_hours, 9) AS repose_before_hours, n_events, n_24h, max_mag,
    round(log10(moment_sum), 6) AS log_moment, n_hours, round(east_range, 9) AS east_range, round(repose_hours, 9) AS target_repose_hours, volume AS target_volume, is_ongoing
    FROM base b LEFT JOIN feats f USING (user_id, episode_no)
    LEFT JOIN ranges r ON r.user_id = b.user_id AND r.episode_no = b.episode_no AND r.station = 'click'"""


def _feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = S.events(spark, sf_dir)
    b, f = _base_and_features(ev)
    return features.feature_table(b, f, features.sample_ranges(b, _hourly(ev), USER), "click", USER)


def _shown(t: DataFrame) -> DataFrame:
    return t.select(
        "user_id", "episode_no", "prev_volume", "prev2_volume", *r9("repose_before_hours"), "n_events", "n_24h", "max_mag", F.round(F.log10("moment_sum"), 6).alias("log_moment"),
        "n_hours", *r9("east_range", "target_repose_hours"), "target_volume", "is_ongoing",
    )


@query(_FEATURES)
def episode_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_feature_table(spark, sf_dir))


@query(_FEATURES + " WHERE repose_hours IS NOT NULL")
def target_onset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(features.onset_target(_feature_table(spark, sf_dir)))


@query(_FEATURES + " WHERE is_ongoing = 0")
def target_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(features.size_target(_feature_table(spark, sf_dir)))


@query("""SELECT station, epoch_us(date_trunc('hour', ts)) AS hour_us, round(avg(east), 9) AS east_mean, min(east) AS east_min, max(east) AS east_max,
    round(CASE WHEN count(east) > 1 THEN stddev_samp(east) END, 9) AS east_std, round(avg(north), 9) AS north_mean,
    round(CASE WHEN count(north) > 1 THEN stddev_samp(north) END, 9) AS north_std, count(*) AS n, count(DISTINCT segment) AS n_segments FROM smp GROUP BY station, date_trunc('hour', ts)""")
def hourly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = rollup.hourly_rollup(S.samples(S.events(spark, sf_dir)), ["station"], "ts", ["east", "north"], "segment")
    return h.select("station", us("hour"), *r9("east_mean"), "east_min", "east_max", *r9("east_std", "north_mean", "north_std"), "n", "n_segments")


@query("""SELECT CAST(CAST(time AS DATE) AS VARCHAR) AS day, count(*) AS n_events, count(*) FILTER (depth < 5) AS n_shallow, count(*) FILTER (depth >= 5) AS n_deep,
    max(magnitude) AS max_mag, round(avg(depth), 9) AS mean_depth, round(log10(sum(pow(10.0, 1.5 * magnitude + 9.1))), 6) AS log_moment FROM qk GROUP BY CAST(time AS DATE)""")
def daily_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = rollup.daily_activity(S.quakes(S.events(spark, sf_dir)), "time", "magnitude", "depth")
    return d.select(F.col("day").cast("string").alias("day"), "n_events", "n_shallow", "n_deep", "max_mag", *r9("mean_depth"), F.round(F.log10("moment_sum"), 6).alias("log_moment"))


@query("""SELECT o_orderkey, o_custkey, epoch_us(lag(o_orderdate) OVER w) AS previous_us, lag(o_totalprice) OVER w AS previous_price,
    round((epoch_us(o_orderdate) - epoch_us(lag(o_orderdate) OVER w)) / 86400000000.0, 6) AS interval_days
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""", standins=False)
def interval_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = S.orders(spark, sf_dir).withColumn("previous", F.lag("o_orderdate").over(w)).withColumn("previous_price", F.lag("o_totalprice").over(w))
    return o.select("o_orderkey", "o_custkey", us("previous"), "previous_price", F.round(days_between("o_orderdate", "previous"), 6).alias("interval_days"))


@query("""SELECT o_orderkey, epoch_us(lag(o_orderdate) OVER w) AS previous_us, lag(o_totalprice) OVER w AS previous_price
    FROM orders WINDOW w AS (ORDER BY o_orderdate, o_orderkey)""", standins=False)
def ordered_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lag over the whole table, in monthly buckets."""
    o = intervals.ordered_lag(S.orders(spark, sf_dir), ["o_orderdate", "o_orderkey"], {"o_orderdate": "previous", "o_totalprice": "previous_price"}, F.date_trunc("month", "o_orderdate"))
    return o.select("o_orderkey", us("previous"), "previous_price")


@query("""SELECT event_id, user_id, event_type AS level, previous FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM ev)
    WHERE previous IS NULL OR previous <> event_type""")
def level_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = intervals.level_changes(S.events(spark, sf_dir), "event_type", ["ts", "event_id"], USER)
    return found.select("event_id", "user_id", F.col("event_type").alias("level"), "previous")


@query("""SELECT event_id, event_type AS level, previous FROM (SELECT *, lag(event_type) OVER (ORDER BY ts, event_id) AS previous FROM ev)
    WHERE previous IS NULL OR previous <> event_type""")
def level_changes_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = intervals.level_changes(S.events(spark, sf_dir), "event_type", ["ts", "event_id"], bucket=F.to_date("ts"))
    return found.select("event_id", F.col("event_type").alias("level"), "previous")


@query("""SELECT o_custkey, CAST(day AS VARCHAR) AS day, gap_days FROM (
      SELECT o_custkey, day, CAST(date_diff('day', lag(day) OVER (PARTITION BY o_custkey ORDER BY day), day) AS INT) AS gap_days
      FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders)) WHERE gap_days > 90 ORDER BY gap_days DESC, o_custkey, day LIMIT 5""", standins=False)
def gaps_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = S.orders(spark, sf_dir).withColumn("day", F.to_date("o_orderdate"))
    return intervals.gaps(o, "day", 90, 5, ["o_custkey"]).select("o_custkey", F.col("day").cast("string").alias("day"), "gap_days")


@query("""SELECT user_id, event_id, round(step, 9) AS step FROM (SELECT *, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS step FROM ev)
    WHERE step > 0.2 ORDER BY step DESC, user_id, ts, event_id LIMIT 5""")
def steps_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.steps(S.events(spark, sf_dir), ["ts", "event_id"], "value", USER, 0.2, 5).select("user_id", "event_id", *r9("step"))


def _scored(ev: DataFrame) -> DataFrame:
    targets = intervals.as_of_forward(S.forecasts(ev), S.episodes(ev), "issued", "start", "start", USER, "target_onset")
    return models.score_windows(targets)


@query("SELECT user_id, event_id, epoch_us(target_onset) AS target_onset_us FROM scored")
def asof_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(S.events(spark, sf_dir)).select("user_id", "event_id", us("target_onset"))


@query("SELECT e.event_id, epoch_us((SELECT min(start) FROM ep WHERE ep.start > e.ts)) AS next_start_us FROM ev e WHERE event_type = 'view'")
def asof_forward_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = S.events(spark, sf_dir)
    found = intervals.as_of_forward_bucketed(ev.where("event_type = 'view'"), S.episodes(ev).select("start"), "ts", "start", "next_start")
    return found.select("event_id", us("next_start"))


@query("SELECT user_id, event_id, CAST(episode_no AS INT) AS episode_no FROM rd")
def asof_backward(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = S.events(spark, sf_dir)
    return S.readings(ev, S.episodes(ev)).select("user_id", "event_id", "episode_no")


_STATED = "CASE WHEN k % 3 = 0 THEN k END"


@query(f"""SELECT event_id, {_STATED} IS NOT NULL AS given, CASE WHEN {_STATED} IS NOT NULL THEN k ELSE f END AS number,
    CASE WHEN {_STATED} IS NOT NULL THEN 'stated' WHEN f IS NOT NULL THEN 'inferred' END AS source
    FROM (SELECT e.*, (SELECT max(s.user_id) FROM ep s WHERE s.start = e.started) AS f FROM (
        SELECT e.*, (SELECT max(start) FROM ep WHERE ep.start <= e.ts) AS started FROM ev e WHERE event_type <> 'signup') e) e""")
def asof_fill_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that state no number take the user of the episode that began last, whoever's it is, and say so."""
    ev = S.events(spark, sf_dir)
    given = ev.where("event_type <> 'signup'").withColumn("number", F.when(F.col("k") % 3 == 0, F.col("k")).cast("long"))
    starts = S.episodes(ev).select("start", F.col("user_id").cast("long").alias("value"))
    out = intervals.fill_as_of(given, starts, "ts", "start", "value", "number", "source")
    return out.select("event_id", (F.col("source") == "stated").alias("given"), "number", "source").fillna(False, ["given"])


@query(f"""SELECT e.event_id, e.user_id, CASE WHEN {_STATED} IS NOT NULL THEN k ELSE f END AS number, CASE WHEN {_STATED} IS NOT NULL THEN 'stated' WHEN f IS NOT NULL THEN 'inferred' END AS source
    FROM (SELECT e.*, (SELECT max(episode_no) FROM ep WHERE ep.user_id = e.user_id AND ep.start <= e.ts) AS f FROM ev e WHERE event_type <> 'signup') e""")
def asof_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that state no episode take their user's last one, and say so."""
    ev = S.events(spark, sf_dir)
    given = ev.where("event_type <> 'signup'").withColumn("number", F.when(F.col("k") % 3 == 0, F.col("k")).cast("long"))
    out = intervals.fill_as_of(given, S.episodes(ev).withColumn("episode_no", F.col("episode_no").cast("long")), "ts", "start", "episode_no", "number", "source", USER)
    return out.select("event_id", "user_id", "number", "source")


@query("SELECT user_id, event_id, lead_hours, hit, error_hours, round((epoch_us(window_end) - epoch_us(window_start)) / 86400000000.0, 9) AS window_days FROM scored")
def window_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(S.events(spark, sf_dir)).select("user_id", "event_id", "lead_hours", "hit", "error_hours", F.round(days_between("window_end", "window_start"), 9).alias("window_days"))


_SKILL = "(SELECT * FROM scored WHERE target_onset IS NOT NULL QUALIFY rank() OVER (PARTITION BY user_id, target_onset ORDER BY issued DESC) = 1)"


@query(f"SELECT user_id, event_id, epoch_us(target_onset) AS target_onset_us, hit, lead_hours FROM {_SKILL}")
def window_skill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.window_skill(_scored(S.events(spark, sf_dir)), ["user_id", "target_onset"]).select("user_id", "event_id", us("target_onset"), "hit", "lead_hours")


@query(f"""SELECT count(*) AS n, CAST(sum(hit) AS BIGINT) AS hits, round(avg(hit) * 100, 2) AS hit_pct, round(avg(window_days), 3) AS mean_window_days,
    round(avg(lead_hours), 2) AS mean_lead_hours, round(avg(abs(error_hours)), 2) AS mean_abs_error_hours FROM {_SKILL}""")
def window_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.skill_summary(models.window_skill(_scored(S.events(spark, sf_dir)), ["user_id", "target_onset"]))


_RECORDED = """, rec AS (SELECT rd.user_id, rd.event_id, rd.episode_no AS last_episode_no, CAST(observed - INTERVAL 10 HOUR AS DATE) AS window_start,
        CAST(observed + INTERVAL 62 HOUR AS DATE) AS window_end, CAST(observed + INTERVAL 14 HOUR AS DATE) AS point_date FROM rd WHERE kind = 'other'),
    recs AS (SELECT rec.*, CAST(e.start - INTERVAL 10 HOUR AS DATE) AS actual FROM rec LEFT JOIN ep e ON e.user_id = rec.user_id AND e.episode_no = rec.last_episode_no + 1)
    SELECT user_id, event_id, CAST(actual AS VARCHAR) AS actual_date, CASE WHEN actual IS NULL THEN NULL WHEN actual BETWEEN window_start AND window_end THEN 1 ELSE 0 END AS window_hit,
        CAST(date_diff('day', point_date, actual) AS INT) AS point_error_days FROM recs"""


@query(_RECORDED)
def offset_key_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = S.events(spark, sf_dir)
    eps = S.episodes(ev)
    rec = S.readings(ev, eps).where("kind = 'other'").select(
        "user_id", "event_id", F.col("episode_no").alias("last_episode_no"), local_date("observed").alias("window_start"), F.date_add(local_date("observed"), 3).alias("window_end"), F.date_add(local_date("observed"), 1).alias("point_date")
    )
    out = models.score_recorded(rec, eps, USER)
    return out.select("user_id", "event_id", F.col("actual_date").cast("string").alias("actual_date"), "window_hit", "point_error_days")


@query("SELECT user_id, episode_no, station, CAST(day AS VARCHAR) AS day, magnitude, epoch_us(observed) AS observed_us, round(days_since_pause, 9) AS days_since_pause, qualifier FROM dmax")
def daily_max_trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = S.events(spark, sf_dir)
    eps = S.episodes(ev)
    d = features.daily_maximum(S.readings(ev, eps), eps, "inflation_cumulative", USER)
    return d.select("user_id", "episode_no", "station", F.col("day").cast("string").alias("day"), "magnitude", us("observed"), *r9("days_since_pause"), "qualifier")


@query("""SELECT n.user_id, n.episode_no, d.station, d.drop_max AS drop, d.q AS drop_qualifier, r.n AS n_readings, r.mx AS recovered_max, r.last AS recovered_last,
    round(r.mx / nullif(r.days, 0), 3) AS recovery_rate, CASE WHEN d.drop_max > 0 THEN round(r.last / d.drop_max, 4) END AS recovery_fraction, c.last AS change_last
    FROM (SELECT DISTINCT user_id, episode_no FROM rd) n
    LEFT JOIN (SELECT user_id, episode_no, station, max(magnitude) AS drop_max, min(qualifier) AS q FROM rd WHERE kind = 'deflation_episode' GROUP BY ALL) d USING (user_id, episode_no)
    LEFT JOIN (SELECT user_id, episode_no, station, count(*) AS n, max(magnitude) AS mx, max(days_since_pause) AS days, arg_max(magnitude, observed) AS last FROM dmax GROUP BY ALL) r
        ON r.user_id = n.user_id AND r.episode_no = n.episode_no AND r.station IS NOT DISTINCT FROM d.station
    LEFT JOIN (SELECT user_id, episode_no, station, arg_max(magnitude, observed) AS last FROM rd WHERE kind = 'change_24h' GROUP BY ALL) c
        ON c.user_id = n.user_id AND c.episode_no = n.episode_no AND c.station IS NOT DISTINCT FROM d.station""")
def episode_trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = S.events(spark, sf_dir)
    eps = S.episodes(ev)
    rd = S.readings(ev, eps)
    t = features.trajectory(rd, features.daily_maximum(rd, eps, "inflation_cumulative", USER), USER)
    return t.select("user_id", "episode_no", "station", "drop", "drop_qualifier", "n_readings", "recovered_max", "recovered_last", "recovery_rate", "recovery_fraction", "change_last")


@query("""SELECT b.user_id, b.episode_no, f.n_events, t.drop_max AS tn_drop, r.last AS tn_recovered_last, r.mx AS tn_recovered_max, r.n AS tn_n_readings,
    CASE WHEN t.drop_max > 0 THEN round(r.last / t.drop_max, 4) END AS tn_recovery_fraction, p.drop_max AS tn_prev_drop
    FROM base b LEFT JOIN feats f USING (user_id, episode_no)
    LEFT JOIN (SELECT user_id, episode_no, max(magnitude) AS drop_max FROM rd WHERE kind = 'deflation_episode' AND station = 's0' GROUP BY ALL) t ON t.user_id = b.user_id AND t.episode_no = b.episode_no
    LEFT JOIN (SELECT user_id, episode_no, max(magnitude) AS drop_max FROM rd WHERE kind = 'deflation_episode' AND station = 's0' GROUP BY ALL) p ON p.user_id = b.user_id AND p.episode_no = b.episode_no - 1
    LEFT JOIN (SELECT user_id, episode_no, count(*) AS n, max(magnitude) AS mx, arg_max(magnitude, observed) AS last FROM dmax WHERE station = 's0' GROUP BY ALL) r
        ON r.user_id = b.user_id AND r.episode_no = b.episode_no AND t.drop_max IS NOT NULL""")
def episode_features_tilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = S.events(spark, sf_dir)
    eps = S.episodes(ev)
    rd = S.readings(ev, eps)
    tracks = features.trajectory(rd, features.daily_maximum(rd, eps, "inflation_cumulative", USER), USER)
    t = features.with_trajectory(_feature_table(spark, sf_dir), tracks, "s0", USER)
    return t.select("user_id", "episode_no", "n_events", "tn_drop", "tn_recovered_last", "tn_recovered_max", "tn_n_readings", "tn_recovery_fraction", "tn_prev_drop")


@query("""SELECT conv_id, arg_min(text, turn) FILTER (role ILIKE '%user%') AS first_user, arg_max(text, turn) FILTER (role ILIKE '%assistant%') AS last_assistant,
    count(DISTINCT text) AS distinct_values, count(*) AS messages, arg_max(role, turn) AS final_role FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id""", standins=False)
def per_episode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = S.read_table(spark, sf_dir, "conversations")
    return latest.messages_per_group(c, ["conv_id"], F.col("turn"), "role", "text", {"role": "final_role"}, {"first_user": ("user", True), "last_assistant": ("assistant", False)})


@query(""", daily AS (SELECT user_id, event_type AS station, ts AS day, value / 1000 AS up, k / 1000 AS sigma, k % 2 AS solution FROM ev)
    SELECT e.user_id, e.episode_no, d.station, count(*) AS days_observed, epoch_us(min(d.day)) AS first_day_us, epoch_us(max(d.day)) AS last_day_us,
    round((max(up) - min(up)) * 1000, 2) AS up_range_mm, round(avg(sigma) * 1000, 2) AS mean_sigma_mm, count(DISTINCT solution) AS n_solutions
    FROM ep e JOIN daily d ON d.user_id = e.user_id AND d.day >= e.pause AND d.day < make_timestamp(epoch_us(e.pause) + CAST(trunc(e.repose_hours * 3.6e9) AS BIGINT))
    WHERE e.repose_hours IS NOT NULL GROUP BY ALL""")
def interval_daily_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = S.events(spark, sf_dir)
    daily = ev.select("user_id", F.col("event_type").alias("station"), F.col("ts").alias("day"), (F.col("value") / 1000).alias("up"), (F.col("k") / 1000).alias("sigma"), (F.col("k") % 2).alias("solution"))
    out = features.repose_daily_range(S.episodes(ev), daily, USER)
    return out.select("user_id", "episode_no", "station", "days_observed", us("first_day"), us("last_day"), "up_range_mm", "mean_sigma_mm", "n_solutions")


_SERIES = """, series AS (SELECT user_id, episode_no, repose_hours AS v FROM ep WHERE repose_hours IS NOT NULL),
    numbered AS (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY episode_no) AS DOUBLE) AS x FROM series),
    wide AS (SELECT user_id, episode_no, v AS actual, x, count(v) OVER w AS n, lag(v) OVER (PARTITION BY user_id ORDER BY episode_no) AS last, median(v) OVER w AS med,
             avg(v) OVER w AS my, avg(x) OVER w AS mx, regr_slope(v, x) OVER w AS slope
             FROM numbered WINDOW w AS (PARTITION BY user_id ORDER BY episode_no ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)),
    pairs AS (SELECT user_id, episode_no, actual, unnest(['last', 'median_5', 'trend_5']) AS name,
              unnest([last, med, CASE WHEN n >= 3 THEN my + slope * (x - mx) ELSE my END]) AS prediction FROM wide WHERE n > 0)"""


def _pairs(ev: DataFrame) -> DataFrame:
    return models.baseline_pairs(S.episodes(ev), USER, ["episode_no"], "repose_hours", 5)


@query(_SERIES + " SELECT user_id, episode_no, name, round(prediction, 4) AS prediction, round(actual, 4) AS actual FROM pairs")
def baseline_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(S.events(spark, sf_dir)).select("user_id", "episode_no", "name", F.round("prediction", 4).alias("prediction"), F.round("actual", 4).alias("actual"))


@query(_SERIES + """, e AS (SELECT *, abs(prediction - actual) AS a FROM pairs)
    SELECT user_id, name, count(*) AS n, round(avg(a), 4) AS mae, round(median(a), 4) AS median_ae, round(sqrt(avg(a * a)), 4) AS rmse,
    round(100.0 * count(*) FILTER (a <= 12) / count(*), 4) AS within_12_pct, round(100.0 * count(*) FILTER (a <= 24) / count(*), 4) AS within_24_pct,
    round(2 * list_sort(list(a))[1 + CAST(round_even(0.79 * (count(*) - 1), 0) AS INT)] / 24, 4) AS implied_window_days FROM e GROUP BY user_id, name HAVING count(*) >= 5""")
def baseline_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = models.score_pairs(_pairs(S.events(spark, sf_dir)), USER)
    return s.select("user_id", "name", "n", *[F.round(c, 4).alias(c) for c in ("mae", "median_ae", "rmse", "within_12_pct", "within_24_pct", "implied_window_days")])


@query(_SERIES + """, e AS (SELECT *, abs(prediction - actual) AS a FROM pairs), m AS (SELECT user_id, name, avg(a) AS mae FROM e GROUP BY ALL HAVING count(*) >= 5)
    SELECT user_id, name, round(mae, 4) AS mae, CAST(row_number() OVER (PARTITION BY user_id ORDER BY round(mae, 6), name) AS INT) AS place FROM m""")
def baseline_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = models.best_first(models.score_pairs(_pairs(S.events(spark, sf_dir)), USER), USER)
    return s.select("user_id", "name", F.round("mae", 4).alias("mae"), "place")


_FIT = """, xy AS (SELECT user_id, episode_no, volume AS x, repose_hours / 24 AS y FROM ep WHERE repose_hours IS NOT NULL),
    raw AS (SELECT *, regr_count(y, x) OVER w AS n, regr_slope(y, x) OVER w AS s, avg(x) OVER w AS mx, avg(y) OVER w AS my, corr(y, x) OVER w AS c
            FROM xy WINDOW w AS (PARTITION BY user_id ORDER BY episode_no ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)),
    fit AS (SELECT user_id, episode_no, x, y, n AS fit_n, CASE WHEN n >= 5 AND NOT isnan(s) THEN round_even(s, 4) + 0.0 END AS slope,
            CASE WHEN n >= 5 AND NOT isnan(s) THEN round_even(my - s * mx, 3) + 0.0 END AS intercept, CASE WHEN n >= 5 AND NOT isnan(s) THEN round_even(c, 3) + 0.0 END AS r FROM raw),
    err AS (SELECT *, slope * x + intercept - y AS error FROM fit WHERE episode_no >= 6 AND slope IS NOT NULL AND y <> 0),
    bt AS (SELECT *, error - CASE WHEN count(error) OVER w >= 3 THEN median(error) OVER w ELSE 0 END AS corrected
           FROM err WINDOW w AS (PARTITION BY user_id ORDER BY episode_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    bts AS (SELECT user_id, count(*) AS n, round_even(avg(abs(corrected)), 2) AS mae_days, round_even(median(corrected), 2) AS median_error_days,
            count(*) FILTER (abs(corrected) <= 2) AS within_2_days, count(*) FILTER (abs(corrected) <= 3) AS within_3_days, round_even(median(error), 2) AS bias_days FROM bt GROUP BY user_id)"""


def _xy(ev: DataFrame) -> DataFrame:
    return S.episodes(ev).where(F.col("repose_hours").isNotNull()).select("user_id", "episode_no", F.col("volume").alias("x"), (F.col("repose_hours") / 24).alias("y"))


@query(_FIT + " SELECT user_id, episode_no, fit_n, slope, intercept, r FROM fit")
def rolling_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = models.rolling_fit(_xy(S.events(spark, sf_dir)), USER, ["episode_no"], "x", "y")
    return f.select("user_id", "episode_no", "fit_n", "slope", "intercept", "r")


@query(_FIT + " SELECT * FROM bts")
def fit_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = models.rolling_fit(_xy(S.events(spark, sf_dir)), USER, ["episode_no"], "x", "y")
    return models.backtest_summary(models.backtest_rows(f, USER, ["episode_no"], "episode_no", "x", "y", 6), USER)
