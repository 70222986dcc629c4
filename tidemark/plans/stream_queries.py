"""Registered queries over streams of several batches with late and revised rows, held against the same over the whole table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import keyed, mining, report
from tidemark.plans import standins as S
from tidemark.plans.queries import query, us
from tidemark.streaming import jobs
from tidemark.streaming.keyed_table import KeyedTable, landed_in_parts, merge_stream

#: The events land in so many files, dealt by their numbers: every file has rows that are older than some of the file before.
PARTS = 3


def _landed_events(spark: SparkSession, sf_dir: str, files: int = 1) -> DataFrame:
    ev = S.events(spark, sf_dir)
    folder = landed_in_parts(ev, F.col("event_id") % PARTS, PARTS, jobs.new_folder(spark, "landed"), files)
    return jobs.landed(spark, folder, ev.schema, files_per_batch=files)


@query("""SELECT user_id, event_type, origin, event_id, epoch_us(ts) AS ts_us, value, CAST(n AS INT) AS revisions FROM (
    SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts, arg_max(value, (ts, event_id)) AS value, count(DISTINCT event_id % 3) AS n FROM ev GROUP BY ALL)
    JOIN (SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS origin FROM (SELECT *, min(event_id % 3) OVER (PARTITION BY user_id, event_type) AS first FROM ev) WHERE event_id % 3 = first GROUP BY ALL)
    USING (user_id, event_type)""")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest event of each user and type, merged batch by batch into a keyed table. What came first stays as origin; how many batches had the key is counted over the landed rows."""
    stream = _landed_events(spark, sf_dir)
    rows = stream.select("user_id", "event_type", F.col("event_id").alias("origin"), "event_id", "ts", "value")
    table = KeyedTable(spark, jobs.new_folder(spark, "newest"), rows.schema, ["user_id", "event_type"], ["ts", "event_id"], buckets=8, update=["value"], in_order=True)
    newest = merge_stream(rows, table, jobs.new_folder(spark, "newest-checkpoint"))
    n = S.events(spark, sf_dir).groupBy("user_id", "event_type").agg(F.count_distinct(F.col("event_id") % PARTS).cast("int").alias("revisions"))
    return newest.join(n, ["user_id", "event_type"]).select("user_id", "event_type", "origin", "event_id", us("ts"), "value", "revisions")


@query("""SELECT event_id, user_id, event_type AS level, previous FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM ev)
    WHERE previous IS NULL OR previous <> event_type""")
def stream_level_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of level in order of event time, though a third of the rows comes in each batch."""
    changes = jobs.level_change_stream(_landed_events(spark, sf_dir, files=16), "user_id", "event_type", "ts", "event_id", late="60 days")
    table = KeyedTable(spark, jobs.new_folder(spark, "levels"), changes.schema, ["event_id"], ["version"], buckets=32, in_order=True)
    return merge_stream(changes, table, jobs.new_folder(spark, "levels-checkpoint")).where("changed").select("event_id", "user_id", "level", "previous")


@query("""SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-20 09:00:00' THEN value * 2 ELSE value END AS value FROM ev WHERE ts < TIMESTAMP '2024-01-20 09:00:00' OR event_id % 5 <> 0""")
def replaced_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in folders of days, of which those from a time within a day on are replaced, twice."""
    ev, since = S.events(spark, sf_dir).select("event_id", "ts", "value"), dt.datetime(2024, 1, 20, 9, tzinfo=dt.UTC)
    path = jobs.new_folder(spark, "by-day")
    keyed.replace_days(ev, path, "ts", dt.datetime(1970, 1, 1, tzinfo=dt.UTC))
    batch = ev.where("event_id % 5 <> 0").withColumn("value", F.col("value") * 2)
    keyed.replace_days(batch, path, "ts", since)
    return keyed.replace_days(batch, path, "ts", since).select("event_id", "value")


@query("""SELECT 'rows' AS name, count(*) AS n FROM ev UNION ALL SELECT 'null_k', count(*) FILTER (k IS NULL) FROM ev UNION ALL SELECT 'outside_value', count(*) FILTER (NOT value BETWEEN 5 AND 400) FROM ev
    UNION ALL SELECT 'run log', count(*) FROM ev""")
def observed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a write counted on its way, and the run log's count."""
    with keyed.Run(spark, "events") as run:
        found = run.write(S.events(spark, sf_dir), jobs.new_folder(spark, "observed"), ["k"], {"value": (5, 400)})
    rows = [*found.items(), ("run log", run.row().first()["rows_written"])]
    return spark.createDataFrame(rows, "name string, n long")


_AT = "TIMESTAMP '2024-01-20'"


@query(f""", last3 AS (SELECT user_id, array_agg(episode_no ORDER BY episode_no DESC) AS episodes, round(min(CASE WHEN pause <= {_AT} THEN (epoch_us({_AT}) - epoch_us(pause)) / 3600000000.0 END), 2) AS hours_since_pause
        FROM (SELECT * FROM ep WHERE start <= {_AT} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY episode_no DESC) <= 3) GROUP BY user_id),
    w AS (SELECT * FROM fc WHERE issued <= {_AT} AND window_end >= {_AT} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY issued DESC, window_start, window_end) = 1)
    SELECT user_id, array_to_string(episodes, ',') AS episodes, hours_since_pause, epoch_us(window_start) AS window_start_us, epoch_us(window_end) AS window_end_us FROM last3 LEFT JOIN w USING (user_id)""")
def daily_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's last three episodes and the stated window that comes first."""
    ev = S.events(spark, sf_dir)
    d = report.digest(S.episodes(ev), ["user_id"], F.lit(dt.datetime(2024, 1, 20, tzinfo=dt.UTC)), 3, S.forecasts(ev))
    return d.select("user_id", F.array_join(F.transform("last_episodes", lambda e: e["episode_no"].cast("string")), ",").alias("episodes"), "hours_since_pause", us("window_start"), us("window_end"))


@query("""SELECT o_orderkey, CAST(500 + o_custkey % 7 AS DOUBLE) AS low, CAST(5000 + o_custkey AS DOUBLE) AS high, 'Alert of order ' || o_orderkey || ' is out' AS status,
    CASE WHEN o_custkey % 3 = 0 THEN 'Camera ' || o_custkey || ' is offline at the station.' END AS outage, CASE WHEN o_custkey % 2 = 0 THEN CAST(100 + o_custkey AS DOUBLE) END AS plume_m FROM orders""", standins=False)
def daily_report_more_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The usual range of a gas, the status, outages and plume heights of reports."""
    o, c = S.told_orders(spark, sf_dir), F.col("o_custkey")
    text = lambda *parts: F.concat(*[p.cast("string") if not isinstance(p, str) else F.lit(p) for p in parts])
    body = text(
        "Summary: Alert of order ", F.col("o_orderkey"), " is out. More.\n\nSummit: SO2 emission typically varies between ", 500 + c % 7, " and ", F.format_number(5000 + c, 0), " tonnes per day.",
        F.when(c % 2 == 0, text(" The plume rose to ", 100 + c, " meters.")).otherwise(""), "\nResources: None.", F.when(c % 3 == 0, text(" Camera ", c, " is offline at the station.")).otherwise(""),
    )
    f = mining.facts(o.select("o_orderkey", body.alias("body")), "body", ["Summary", "Summit", "Resources"], ["o_orderkey"], "Summit", "Resources", "Rift", "Summary")
    return f.select("o_orderkey", F.col("gas_typical.low").alias("low"), F.col("gas_typical.high").alias("high"), F.col("status.value").alias("status"), F.col("outage.value").alias("outage"), F.col("plume_height_m.value").alias("plume_m"))


def _told_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = S.told_orders(spark, sf_dir), F.col("o_custkey")
    say = lambda *parts: F.concat(*[p.cast("string") if not isinstance(p, str) else F.lit(p) for p in parts])
    station = F.element_at(F.array(F.lit("SDH"), F.lit("UWD"), F.lit("IKI")), (c % 3 + 1).cast("int"))
    hedge = F.element_at(F.array(F.lit("about "), F.lit("more than "), F.lit("")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    body = say(
        "The ", station, " tiltmeter recorded ", hedge, c % 90 + 1, " microradians of deflation during the fountains of episode ", c % 60, ". Since the end of it, ", c % 50 + 1,
        F.when(c % 2 == 0, " microradians were recovered").otherwise(" microradians of inflation were seen"), ". Within the past 24 hours there were nearly ", c % 20 + 1, " microradians of inflation. It goes on at ", c % 5 + 1, " microradians per hour. Of ", c, " notices this is one.",
    )
    return mining.number_readings(o.select("o_orderkey", body.alias("body")), "body", ["o_orderkey"], codes=["SDH", "UWD", "IKI"])


_READINGS = """SELECT o_orderkey, kind, CAST(number AS DOUBLE) AS number, CASE kind WHEN 'deflation_episode' THEN ['about', 'more than', 'exact'][1 + o_orderkey % 3] WHEN 'change_24h' THEN 'nearly' ELSE 'exact' END AS qualifier,
    ['SDH', 'UWD', 'IKI'][1 + o_custkey % 3] AS station, CASE kind WHEN 'deflation_episode' THEN CAST(o_custkey % 60 AS INT) END AS episode_no FROM (
    SELECT o_orderkey, o_custkey, unnest(['deflation_episode', 'inflation_cumulative', 'change_24h', 'rate_per_day']) AS kind, unnest([o_custkey % 90 + 1, o_custkey % 50 + 1, o_custkey % 20 + 1, o_custkey % 5 + 1]) AS number FROM orders)"""


@query(_READINGS, standins=False)
def stated_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings stated in sentences of four shapes: number, hedge, kind, station and episode."""
    return _told_readings(spark, sf_dir).drop("sentence")


@query(f"SELECT o_orderkey, kind, number, station, qualifier, 1 AS n_quotes FROM ({_READINGS})", standins=False)
def latest_stated_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last reading of each kind in a text, with how many sentences state one."""
    r = mining.latest_readings(_told_readings(spark, sf_dir).withColumn("pos", F.monotonically_increasing_id()), ["o_orderkey"])
    return r.select("o_orderkey", "kind", "latest.number", "latest.station", "latest.qualifier", F.size("quotes").alias("n_quotes"))
