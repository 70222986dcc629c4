import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import features, latest, models
from tidemark.streaming import jobs


def at(hours: float) -> dt.datetime:
    return dt.datetime(2026, 1, 1) + dt.timedelta(hours=hours)


EPISODES = "s int, episode_no int, start timestamp, pause timestamp, duration_hours double, volume double, repose_hours double, is_ongoing int"


def series(spark):
    rows = [(1, 1, at(0), at(9), 9.0, 1.0, 91.0, 0), (1, 2, at(100), at(110), 10.0, 2.0, 16.0, 0), (1, 3, at(126), at(130), 4.0, 3.0, None, 0), (1, 5, at(300), None, None, None, None, 1)]
    return features.episode_base(spark.createDataFrame(rows, EPISODES), ["s"])


def test_prior_rows_are_by_number(spark):
    got = {r["episode_no"]: (r["prev_volume"], r["prev2_volume"], r["prev_pause"]) for r in series(spark).collect()}
    assert got == {1: (None, None, None), 2: (1.0, None, at(9)), 3: (2.0, 1.0, at(110)), 5: (None, 3.0, None)}


def test_only_what_was_known_before(spark):
    times = [-25, -24, -1, 0, 8, 9, 50, 99.9, 100, 111, 125.9, 126, 299]
    events = spark.createDataFrame([(1, at(t), 2.0, None if t == 50 else 5.0 if t == 9 else 1.0) for t in times] + [(2, at(-1), 9.0, 1.0)], "s int, time timestamp, magnitude double, depth double")
    got = {r["episode_no"]: r for r in features.event_features(series(spark), events, ["s"]).collect()}
    # the first episode's window is a day; an event at the start itself isn't known before it
    assert {n: r["n_events"] for n, r in got.items()} == {1: 2, 2: 3, 3: 2, 5: 1}
    assert (got[2]["n_shallow"], got[2]["n_deep"], got[2]["n_24h"], got[2]["n_72h"]) == (1, 1, 1, 2)
    # a repose of 16 hours bounds all counts alike
    assert (got[3]["n_24h"], got[3]["n_72h"]) == (2, 2)
    none = {r["episode_no"]: r for r in features.event_features(series(spark), events.where("false"), ["s"]).collect()}
    assert (none[2]["n_events"], none[2]["n_24h"], none[2]["moment_sum"], none[2]["max_mag"]) == (0, 0, None, None)


def test_segment_safe_ranges(spark):
    hourly = spark.createDataFrame([(1, "a", at(10), 1.0, 1.0, None, 1), (1, "a", at(11), 9.0, 1.0, 0.5, 2), (1, "a", at(12), 3.0, 2.0, 0.1, 1)], "s int, station string, hour timestamp, east_mean double, north_mean double, east_std double, n_segments long")
    b = series(spark)
    assert [(r["east_range"], r["relevelled_hours"]) for r in features.sample_ranges(b, hourly, ["s"]).collect()] == [(8.0, 1)]
    assert [(r["east_range"], r["relevelled_hours"]) for r in features.sample_ranges(b, hourly, ["s"], segment_safe=True).collect()] == [(2.0, 0)]


def test_trajectory_is_null_safe(spark):
    eps = spark.createDataFrame([(1, at(0)), (2, at(500))], "episode_no int, pause timestamp")
    rows = [(1, None, "inflation_cumulative", at(24), 5.0, "about"), (1, None, "inflation_cumulative", at(25), 7.0, "exact"), (1, None, "inflation_cumulative", at(50), 6.0, "exact"), (1, "B", "change_24h", at(50), 1.0, "exact"),
            (2, "A", "deflation_episode", at(500), 12.0, "exact"), (2, "A", "deflation_episode", at(501), 10.0, "about"), (2, "A", "inflation_cumulative", at(524), 3.0, "exact"), (2, "B", "inflation_cumulative", at(524), 9.0, "exact")]
    rd = spark.createDataFrame(rows, "episode_no int, station string, kind string, observed timestamp, magnitude double, qualifier string").withColumn("day", F.to_date("observed"))
    daily = features.daily_maximum(rd, eps, "inflation_cumulative")
    assert sorted((r["episode_no"], r["magnitude"]) for r in daily.collect()) == [(1, 6.0), (1, 7.0), (2, 3.0), (2, 9.0)]
    got = {(r["episode_no"], r["station"]): r for r in features.trajectory(rd, daily).collect()}
    assert set(got) == {(1, None), (2, "A")}  # a station without a drop goes, but for the unnamed one
    one, two = got[1, None], got[2, "A"]
    assert (one["drop"], one["recovered_last"], one["recovered_max"], one["recovery_fraction"], one["change_last"]) == (None, 6.0, 7.0, None, None)
    assert (two["drop"], two["drop_qualifier"], two["recovered_last"], two["recovery_fraction"], two["recovery_rate"]) == (12.0, "about", 3.0, 0.25, 3.0)


def test_window_scores(spark):
    w = spark.createDataFrame([(1, at(0), at(10), at(34), at(20)), (2, at(0), at(10), at(34), at(40)), (3, at(0), at(10), at(34), at(4)), (4, at(0), at(10), at(34), None)], "id int, issued timestamp, window_start timestamp, window_end timestamp, target_onset timestamp")
    got = {r["id"]: (r["hit"], r["error_hours"], r["lead_hours"], r["window_days"]) for r in models.score_windows(w).collect()}
    assert got == {1: (1, 0.0, 20.0, 1.0), 2: (0, 6.0, 40.0, 1.0), 3: (0, -6.0, 4.0, 1.0), 4: (None, None, None, 1.0)}


def test_messages_per_group(spark):
    m = spark.createDataFrame([(1, 1, "Started now", "a", None), (1, 2, "it STARTED", "b", "SW"), (1, 3, "ended", None, None), (1, 4, None, "c", None), (None, 5, "started", "z", None)], "ep int, t int, remarks string, onset string, drift string")
    got = latest.messages_per_group(m, ["ep"], F.col("t"), "remarks", "onset", {"drift": "drift"}, {"first": ("started", True), "last": ("started", False), "end": ("ended", False)}).collect()
    assert [tuple(r) for r in got] == [(1, "a", "b", None, 3, 4, "SW")]


def test_streams_over_several_batches(spark, tmp_path):
    rows = [(i, i % 3, at(i / 4), "xyz"[(i // 5) % 3], float(i), i % 2) for i in range(60)]
    schema = "event_id int, user_id int, ts timestamp, level string, value double, seg int"
    batch = spark.createDataFrame(rows, schema)
    for k in range(3):  # three files, in order of time
        batch.where(f"event_id >= {20 * k} and event_id < {20 * k + 20}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = lambda: jobs.landed(spark, str(tmp_path / "in"), batch.schema, files_per_batch=1)
    hours = jobs.merged(jobs.run_available(jobs.hourly_stream(stream(), ["user_id"], "ts", "value", "seg"), "update", str(tmp_path / "h")), ["user_id", "hour"])
    want = batch.groupBy("user_id", F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("n"), F.max("value").alias("max"))
    assert sorted(map(tuple, hours.select("user_id", "hour", "n", "max").collect())) == sorted(map(tuple, want.collect()))
