import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import keyed, report, rollup

NOW = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


def hours(n):
    return NOW + dt.timedelta(hours=n)


def files_of(path):
    return {p.relative_to(path): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_replaced_days_leave_earlier_files_alone(spark, tmp_path):
    rows = [(i, hours(6 * i)) for i in range(40)]
    df = spark.createDataFrame([*rows, (99, None)], "id int, t timestamp")
    path = tmp_path / "days"
    keyed.replace_days(df, str(path), "t", NOW)
    before = files_of(path)
    since = hours(6 * 21)  # within a day
    batch = spark.createDataFrame([(i + 100, hours(6 * i)) for i in range(0, 30)], "id int, t timestamp")
    for _ in range(2):
        got = keyed.replace_days(batch, str(path), "t", since).collect()
        assert sorted(r["id"] for r in got) == [*range(21), *range(121, 130)]
    after = files_of(path)
    day = str(since.date())
    assert {p: m for p, m in before.items() if str(p.parts[0]) < f"_day={day}"}.items() <= after.items()
    assert {p.parts[0] for p in after} == {f"_day={hours(6 * i).date()}" for i in range(30)}


def test_a_run_counts_what_it_writes(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 50.0), (4, -1.0)], "id int, v double")
    with keyed.Run(spark, "s") as run:
        assert run.write(df, str(tmp_path / "a"), ["v"], {"v": (0, 10)}) == {"rows": 4, "null_v": 1, "outside_v": 2}
        assert run.write(df.where("false"), str(tmp_path / "a"), ["v"])["rows"] == 0
    assert run.row().first()["rows_written"] == 4 and spark.read.parquet(str(tmp_path / "a")).count() == 4
    bad = df.withColumn("v", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(Exception, match="broken"), keyed.Run(spark, "s") as run:
        run.write(bad, str(tmp_path / "b"))
    assert run.row().first()["status"] == "failed" and run.row().first()["rows_written"] == 0


def test_sketches_unite_within_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("k"), F.timestamp_seconds(F.col("id") * 7).alias("t"), F.pmod(F.xxhash64("id"), F.lit(20_000)).alias("v"))
    hourly = rollup.distinct_sketches(df, ["k"], "t", "v")
    exact = df.select("v").distinct().count()
    assert abs(rollup.united(hourly).first()["n_distinct"] - exact) <= 4 * 1.04 / 2**7 * exact
    for r in rollup.united(hourly, "k").collect():
        exact = df.where(F.col("k") == r["k"]).select("v").distinct().count()
        assert abs(r["n_distinct"] - exact) <= 4 * 1.04 / 2**7 * exact
    assert rollup.united(rollup.distinct_sketches(df.where("false"), ["k"], "t", "v"), "k").count() == 0


def test_digest_has_the_first_window_of_the_newest_issue(spark):
    eps = spark.createDataFrame([(1, k, hours(10 * k), hours(10 * k + 2), 2.0) for k in range(5)], "u int, episode_no int, start timestamp, pause timestamp, duration_hours double")
    windows = [(1, hours(20), hours(60), hours(70)), (1, hours(30), hours(90), hours(95)), (1, hours(30), hours(50), hours(55)), (1, hours(30), hours(31), hours(32)), (1, hours(80), hours(85), hours(86)), (2, hours(1), hours(2), hours(3))]
    w = spark.createDataFrame(windows, "u int, issued timestamp, window_start timestamp, window_end timestamp")
    d = report.digest(eps, ["u"], F.lit(hours(45)), 3, w).select("u", F.unix_seconds("window_start").alias("s"), "hours_since_pause", F.size("last_episodes").alias("n")).collect()
    assert [tuple(r) for r in d] == [(1, int(hours(50).timestamp()), 3.0, 3)]
