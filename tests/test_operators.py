import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark.operators import checks, intervals, keyed, latest, mining, models, report, rollup


def at(hours: float) -> dt.datetime:
    return dt.datetime(2026, 1, 1) + dt.timedelta(hours=hours)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_interval_join_equals_naive(spark, seed):
    r = random.Random(seed)
    points = [(i, at(r.uniform(0, 3000))) for i in range(200)]
    spans = [(j, at(s), at(s + w)) for j in range(40) for s, w in [(r.uniform(0, 3000), r.choice([0, 1, 30, 500, 40000]))]] + [(99, None, at(1))]
    p, s = spark.createDataFrame(points, "i int, t timestamp"), spark.createDataFrame(spans, "j int, lo timestamp, hi timestamp")
    got = rows(intervals.interval_join(p, s, "t", "lo", "hi", bucket_seconds=3600).select("i", "j"))
    assert got == sorted([(i, j) for i, t in points for j, lo, hi in spans if lo and lo <= t < hi], key=repr)


def test_as_of_ties(spark):
    left = spark.createDataFrame([("a", at(1)), ("a", at(2)), ("b", at(1))], "k string, t timestamp")
    right = spark.createDataFrame([("a", at(1), 1), ("a", at(2), 2)], "k string, r timestamp, v int")
    strict = intervals.as_of_forward(left, right, "t", "r", "v", ["k"], "v")
    assert rows(strict.select("k", "t", "v")) == sorted([("a", at(1), 2), ("a", at(2), None), ("b", at(1), None)], key=repr)
    back = intervals.as_of_backward(left, right, "t", "r", "v", ["k"], "v")
    assert rows(back.select("k", "t", "v")) == sorted([("a", at(1), 1), ("a", at(2), 2), ("b", at(1), None)], key=repr)


def test_ordered_lag_equals_lag(spark):
    r = random.Random(3)
    data = sorted((at(r.uniform(0, 2000)), i) for i in range(300))
    df = spark.createDataFrame([(i, t) for t, i in data], "i int, t timestamp")
    got = dict(rows(intervals.ordered_lag(df, ["t", "i"], {"i": "p"}, F.to_date("t")).select("i", "p")))
    want = {i: (data[k - 1][1] if k else None) for k, (_, i) in enumerate(data)}
    assert got == want


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "n", 9)], "k int, x string, y int")
    batch = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (3, "c", 3), (None, "m", 4)], "k int, x string, seq int")
    once = keyed.upsert(target, batch, ["k"], ["seq"])
    assert rows(once) == sorted([(1, "new", 1), (2, "b", 2), (3, "c", None), (None, "n", 9), (None, "m", None)], key=repr)
    whole = batch.where("k is not null")
    assert rows(keyed.upsert(keyed.upsert(target, whole, ["k"], ["seq"]), whole, ["k"], ["seq"])) == rows(keyed.upsert(target, whole, ["k"], ["seq"]))
    assert rows(keyed.insert_absent(target, batch.where("k is not null"), ["k"], ["seq"]))[:2] == [(1, "a", 1), (2, "b", 2)]


def test_purge_keeps_nulls_and_escapes(spark):
    t = spark.createDataFrame([("UWE_1sec_2018",), ("UWE_1min_2018",), ("UWEX1secY",), (None,)], "segment string")
    assert keyed.purge(t, F.col("segment").like(r"%\_1sec%")).count() == 3


def test_derive_and_publish(spark, tmp_path):
    tables = {"sample": spark.range(7).withColumnRenamed("id", "x"), "gas": spark.createDataFrame([("i",)] * 5 + [("m",)] * 2 + [(None,)], "kind string"), "episode": spark.range(3)}
    drop = {"sample": F.lit(True), "gas": F.col("kind") == "i"}
    path = str(tmp_path / "core")
    got = {r["tbl"]: (r["n_after"], r["ok"]) for r in keyed.publish(tables, drop, path).collect()}
    assert got == {"sample": (0, True), "gas": (3, True), "episode": (3, True)}
    with pytest.raises(FileExistsError):
        keyed.publish(tables, drop, path)
    with pytest.raises(ValueError, match="no such table"):
        keyed.derive(tables, {"x": F.lit(True)})


def test_align_schema(spark):
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    df = spark.createDataFrame([("a",)], "station string")
    wanted = StructType([StructField("station", StringType()), StructField("up", DoubleType())])
    out, added = keyed.align_schema(df, wanted, ["station"])
    assert added == ["up"] and keyed.align_schema(out, wanted, ["station"])[1] == []
    with pytest.raises(ValueError):
        keyed.align_schema(df, StructType([StructField("id", StringType())]), ["id"])


def test_runs(spark):
    def bad(run):
        raise RuntimeError("x" * 3000)

    def good(run):
        run.rows_seen = 5

    log = keyed.run_all(spark, {"bad": bad, "good": good})
    got = {r["source"]: (r["status"], r["rows_seen"], len(r["error"] or "")) for r in keyed.last_runs(log).collect()}
    assert got == {"bad": ("failed", 0, 2000), "good": ("ok", 5, 0)}


def test_incremental_start(spark):
    t = spark.createDataFrame([(at(100),)], "t timestamp")
    assert keyed.incremental_start(t, "t", dt.timedelta(hours=10)) == at(90)
    assert keyed.incremental_start(t.where("false"), "t", dt.timedelta(hours=10)) is None


def test_rollup(spark):
    s = spark.createDataFrame([("a", at(0.1), 1.0, "x"), ("a", at(0.9), 3.0, ""), ("a", at(1.5), 5.0, "x"), ("a", None, 1.0, "x")], "st string, t timestamp, v double, seg string")
    got = {r["hour"]: (r["v_mean"], r["v_std"], r["n"], r["n_segments"]) for r in rollup.hourly_rollup(s, ["st"], "t", ["v"], "seg").collect()}
    assert got == {at(0): (2.0, pytest.approx(2**0.5), 2, 1), at(1): (5.0, None, 1, 1)}


def test_latest_ties(spark):
    f = spark.createDataFrame([(1, at(1), "a"), (1, at(2), "b"), (1, at(2), "c"), (None, at(9), "d")], "ep int, t timestamp, n string")
    assert rows(latest.latest_with_ties(f, ["ep"], "t").select("n")) == [("b",), ("c",)]


def test_forecast_on_known_slope(spark):
    eps = [(0, n, 14.0 + n % 5, 0.7 * (14 + n % 5) + 1) for n in range(1, 21)]
    df = spark.createDataFrame(eps, "s int, n int, x double, y double")
    m = models.latest_model(df, ["s"], ["n"], "x", "y").first()
    assert m["slope"] == pytest.approx(0.7, abs=0.05) and m["model_n"] == 14
    fit = models.rolling_fit(df, ["s"], ["n"], "x", "y")
    back = models.backtest_summary(models.backtest_rows(fit, ["s"], ["n"], "n", "x", "y", 8), ["s"])
    assert back.first()["mae_days"] <= 0.01
    state = spark.createDataFrame([(0, at(0), 15.0, 5.0, 2.0)], "s int, pause timestamp, x double, cumulative double, change_24h double")
    reposes = spark.createDataFrame([(0, 316.1)], "s int, repose_median_hours double")
    f = models.own_forecast(state, models.latest_model(df, ["s"], ["n"], "x", "y"), back, reposes, ["s"], F.lit(at(24))).first()
    assert f["method"] == "regression" and f["window_start"] < f["point_date"] < f["window_end"] and f["half_width_days"] == 1.5
    none = models.latest_model(df.where("n < 3"), ["s"], ["n"], "x", "y")
    paused = spark.createDataFrame([(0, dt.datetime(2026, 8, 13, 11, 23), 15.0, None, None)], "s int, pause timestamp, x double, cumulative double, change_24h double")
    f = models.own_forecast(paused, none, back.where("false"), reposes, ["s"], F.lit(at(24))).first()
    assert (f["method"], f["point_date"], f["early_risk_date"]) == ("repose median", dt.date(2026, 8, 26), None)
    f = models.own_forecast(paused.withColumn("pause", F.lit(None).cast("timestamp")), none, back.where("false"), reposes.where("false"), ["s"], F.lit(at(24))).first()
    assert f["point_date"] is None and f["unavailable"] == "no pause"


def test_one_key_with_many_points_and_intervals(spark):
    points = spark.range(100_000).select(F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 600).alias("time"))
    spans = spark.range(10_000).select(F.lit(1).alias("k"), "id", F.timestamp_seconds(F.col("id") * 6000).alias("lo"), F.timestamp_seconds(F.col("id") * 6000 + 3000).alias("hi"))
    spans = spans.union(spark.sql("select 1, -1L, timestamp'1970-01-01', timestamp'1980-01-01'"))
    met = intervals.interval_join(points, spans, "time", "lo", "hi", ["k"]).groupBy("id").count()
    assert met.where("id >= 0 and count = 5").count() == 10_000 and met.where("id = -1").first()["count"] == 100_000


def test_running_bias_is_the_median_before(spark):
    r = random.Random(3)
    data = [(k, i, r.uniform(1, 9), r.uniform(1, 9), 0.5, 1.0) for k in range(3) for i in range(40)]
    fitted = spark.createDataFrame(data, "k int, n int, x double, y double, slope double, intercept double")
    got = {(x["k"], x["n"]): (x["bias"], x["error"]) for x in models.backtest_rows(fitted, ["k"], ["n"], "n", "x", "y", 5).collect()}
    for (k, n), (bias, _) in got.items():
        before = [e for (a, b), (_, e) in got.items() if a == k and b < n]
        assert abs(bias - (statistics.median(before) if len(before) >= 3 else 0.0)) < 1e-12
    assert len(got) == 3 * 35


def test_report(spark):
    t = {"e": spark.createDataFrame([(1, at(0)), (2, at(5)), (4, None)], "n int, t timestamp"), "empty": spark.createDataFrame([], "n int, t timestamp")}
    rules = [checks.not_empty("e there", "e", "t"), checks.not_empty("empty there", "empty"), checks.contiguous("in a row", "e", "n"), checks.populated("time known", "e", "t"), checks.counted("late", "e", F.col("n") > 1), checks.fresh("fresh", "e", "t", F.lit(at(48)), 1.0)]
    got = {r["check"]: (r["status"], r["n"]) for r in checks.report(t, rules, {"e": ["n"], "empty": ["x"], "gone": ["n"]}).collect()}
    assert got == {"e has its columns": ("PASS", 0), "empty has its columns": ("FAIL", 1), "gone has its columns": ("WARN", 1), "e there": ("PASS", 0), "in a row": ("FAIL", 1), "time known": ("WARN", 1), "late": ("INFO", 2), "fresh": ("WARN", 1)}


def test_readings(spark):
    text = "The tiltmeter at UWD recorded about 11 microradians of deflationary tilt during episode 8 and about 1.3 microradians of inflationary tilt since the end of episode 8. It is less than 1.0 microradian per day of inflation. The Sandhill tiltmeter (SMC) saw 19.1 microradians of deflation during episode 53. Last."
    df = spark.createDataFrame([(1, text)], "id int, body string")
    got = [(r["kind"], r["number"], r["station"], r["qualifier"]) for r in mining.number_readings(df, "body", ["id"]).collect()]
    assert got == [("deflation_episode", 11.0, "UWD", "about"), ("inflation_cumulative", 1.3, "UWD", "about"), ("rate_per_day", 1.0, None, "exact"), ("deflation_episode", 19.1, "SMC", "exact")]


def test_only_instruments_are_stations(spark):
    text = "The NWS reports that UWD recorded 5.0 microradians of inflationary tilt since the end of episode 50. Sand Hill lost 2 microradians of deflation overnight."
    df = spark.createDataFrame([(1, text)], "id int, body string")
    seen = lambda **k: [(r["number"], r["station"], r["kind"]) for r in mining.number_readings(df, "body", ["id"], **k).collect()]
    assert seen() == [(5.0, None, "inflation_cumulative"), (2.0, None, "change_24h")]
    assert seen(codes=["UWD"], stations={"sand hill": "SDH"}) == [(5.0, "UWD", "inflation_cumulative"), (2.0, "SDH", "change_24h")]


def test_phrases_and_ranges():
    tokens = mining.tokens_of("It re-inflated 1.5 µrad since the end.")
    assert [t[2] for t in tokens] == ["it", "re-inflated", "1.5", "µrad", "since", "the", "end", "."]
    assert mining.Phrases(["re-inflat*", "since the"]).spans(tokens) == [(3, 14), (24, 33)] and mining.Phrases(["since end"]).spans(tokens) == []
    found = lambda t: [x[1:] for x in mining.ranges_of(t)]
    assert found("between Monday, May 3 and Friday, May 7, 2026") == [(("may", 3, None), ("may", 7, 2026))]
    assert found("from May 3, 2025 through 9; between 3 and 5 May, from June 5 until 7") == [(("may", 3, 2025), ("may", 9, None))]
    assert found("between December 30 and January 2") == [(("december", 30, None), ("january", 2, None))] and found("") == []


def test_latest_offline_and_precursors(spark):
    r = spark.createDataFrame([(1, "a", 1.0, "U", "exact", 0, "x"), (1, "a", 2.0, "V", "about", 1, "y"), (1, "b", 3.0, None, "exact", 2, "x")], "id int, kind string, number double, station string, qualifier string, pos int, sentence string")
    got = {x["kind"]: (x["latest"]["number"], x["quotes"]) for x in mining.latest_readings(r, ["id"]).collect()}
    assert got == {"a": (2.0, ["x", "y"]), "b": (3.0, ["x"])}
    df = spark.createDataFrame([(1, "The SDH and UWD instruments are offline. ABC is fine. UWD was offline.", at(24)), (2, None, at(24))], "id int, body string, start timestamp")
    assert {x["id"]: x["offline_stations"] for x in mining.offline(df, "body", ["id"]).collect()} == {1: ["SDH", "UWD"], 2: []}
    notes = ["Precursory overflows began on January 1 - 4 a.m. and went on.", "It went on. First spatter started on January 1, 2026 - 12:30 p.m.; more.", "Overflows began on January 1.", None]
    df = spark.createDataFrame([(i, n, at(24)) for i, n in enumerate(notes)], "id int, body string, start timestamp")
    assert {x["id"]: (x["precursor"], x["lead_hours"]) for x in mining.precursors(df, "body", "start", ["id"]).collect()} == {0: (at(14), 10.0), 1: (at(22.5), 1.5), 2: (None, None), 3: (None, None)}


def test_date_windows(spark):
    issued = dt.datetime(2025, 12, 30, 20)
    texts = ["Episode 40 is likely to begin between December 31 and January 3.", "The eruption went on from December 1 to 5, as forecast.", "Rain is expected between January 2 and 4.", "Episode 41 is likely between January 5 and March 30."]
    df = spark.createDataFrame([(i, t, issued) for i, t in enumerate(texts)], "id int, body string, sent timestamp")
    got = [(r["id"], r["window_start_date"], r["window_end_date"], r["stated_episode"]) for r in mining.date_windows(df, "body", "sent", ["id"]).collect()]
    assert got == [(0, dt.date(2025, 12, 31), dt.date(2026, 1, 3), 40)]
    first = mining.date_windows(df, "body", "sent", ["id"], behind=120, past_allowed=True, first_only=True)
    assert [(r["id"], r["window_start_date"]) for r in first.orderBy("id").collect()] == [(0, dt.date(2025, 12, 31)), (1, dt.date(2025, 12, 1))]


def test_facts(spark):
    body = """Summary: The eruption is paused. More.

Overview: Winds are light.
Summit Observations: There were 12 earthquakes in the past 24 hours. SO2 emission typically varies between 1,000 and 5,000 tonnes per day. Winds are from the northeast at 11 to 20 mph with gusts up to 28 mph.
Rift Zone Observations: Rates remain low. Nothing else.
Resources: an SDH station is offline because of a power outage."""
    df = spark.createDataFrame([(1, body)], "id int, body string")
    f = mining.facts(df, "body", ["Summary", "Overview", "Summit Observations", "Rift Zone Observations", "Resources"], ["id"], "Summit Observations", "Overview", "Rift Zone Observations", "Summary").first()
    assert f["quakes_24h"]["value"] == 12 and f["gas_measured"]["value"] is None and f["gas_measured"]["unavailable"] == "not stated"
    assert (f["gas_typical"]["low"], f["gas_typical"]["high"]) == (1000.0, 5000.0)
    assert (f["wind"]["low"], f["wind"]["high"], f["wind"]["gust"], f["wind"]["direction"]) == (11.0, 20.0, 28.0, "northeast")
    assert f["second_quiet"]["value"] is True and f["status"]["value"] == "The eruption is paused" and "power outage" in f["outage"]["value"]


def test_figure_series(spark):
    eps = spark.createDataFrame([(1, at(0), at(9), 10.0)], "episode_no int, start timestamp, pause timestamp, drop double")
    daily = spark.createDataFrame([(1, at(33), 4.0)], "episode_no int, observed timestamp, recovered double")
    assert [r["level"] for r in report.figure_series(eps, daily).orderBy("at").collect()] == [0.0, -10.0, -6.0]


def test_record_is_idempotent(spark):
    snap = spark.createDataFrame([(7, 3, "paused", 2, "view", at(1), at(9))], "user_id long, episode_no int, state string, n_24h long, level string, window_start timestamp, window_end timestamp")
    log = spark.createDataFrame([], "user_id long, generated timestamp, episode_no int, state string, n_24h long, level string, window_start timestamp, window_end timestamp")
    once = report.record(log, snap, ["user_id"], F.lit(at(5)))
    assert rows(report.record(once, snap, ["user_id"], F.lit(at(5)))) == rows(once) and once.count() == 1
    assert report.record(once, snap, ["user_id"], F.lit(at(6))).count() == 2


def test_balanced_windows(spark):
    r = random.Random(6)
    times = [at(r.uniform(0, 1000)) for _ in range(500)] + [at(500)] * 50
    df = spark.createDataFrame([(t,) for t in times], "t timestamp")
    got = intervals.balanced_windows(df, "t", 40).collect()
    assert sum(w["n"] for w in got) == len(times) and all(w["n"] < 40 or w["full"] for w in got) and any(w["full"] for w in got)
    assert intervals.balanced_windows(df.where("false"), "t", 40).count() == 0


def test_facts_need_their_words(spark):
    body = "Summit: A window opened where lava moved 3 to 5 mph. The SO2 emission rate can exceed 5,000 tonnes per day. SO2 was measured at 1,200 tonnes per day. The wind was light, 4 to 6 mph.\n\nEnd: x"
    f = mining.facts(spark.createDataFrame([(1, body)], "id int, body string"), "body", ["Summit", "End"], ["id"], "Summit", "End", "None", "None").first()
    assert f["gas_measured"]["value"] == 1200.0 and (f["wind"]["low"], f["wind"]["high"]) == (4.0, 6.0)
    only = "Summit: A windward slope moved 3 to 5 mph. The SO2 rate can exceed 5,000 tonnes per day.\n\nEnd: x"
    f = mining.facts(spark.createDataFrame([(1, only)], "id int, body string"), "body", ["Summit", "End"], ["id"], "Summit", "End", "None", "None").first()
    assert f["gas_measured"]["unavailable"] == "not stated" and f["wind"]["unavailable"] == "not stated"


def test_fits_without_spread(spark):
    flat = [("same x", n, 2.0, float(n)) for n in range(8)] + [("same y", n, float(n), 2.0) for n in range(8)] + [("both", n, 0.3, 0.7) for n in range(8)]
    df = spark.createDataFrame(flat, "s string, n int, x double, y double")
    last = {r["s"]: r for r in models.rolling_fit(df, ["s"], ["n"], "x", "y").where("n = 7").collect()}
    assert last["same x"]["slope"] is last["same x"]["r"] is last["both"]["slope"] is last["both"]["r"] is None
    assert last["same y"]["slope"] == 0 and last["same y"]["intercept"] == 2 and math.isnan(last["same y"]["r"])
    latest = models.latest_model(df, ["s"], ["n"], "x", "y").collect()
    assert [(r["s"], r["slope"], r["intercept"]) for r in latest] == [("same y", 0.0, 2.0)]


def test_forward_joins_in_time_that_grows_with_the_rows(spark):
    n = 30_000
    left = spark.range(n).select("id", F.timestamp_seconds(F.col("id") * 2).alias("t"))
    right = spark.range(n).select(F.timestamp_seconds(F.col("id") * 2 + 1).alias("r"))
    got = intervals.as_of_forward_bucketed(left, right, "t", "r", "next")
    wrong = got.where("next is null or unix_seconds(next) <> unix_seconds(t) + 1").count()
    assert wrong == 0 and "unboundedfollowing" not in got._jdf.queryExecution().toString().lower()


def test_texts_are_dealt_over_the_cores(spark):
    from tidemark.plans import standins

    assert standins.told_orders(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= 32


def test_windows_and_readings_keep_columns_and_order(spark):
    df = spark.createDataFrame([(1, at(0), "An eruption is likely between May 3 and 7, or from May 9 to 12. It rose 5 microradians (UWD), about 2 microradians of inflation."), (2, at(1), None), (3, None, "")], "id int, t timestamp, x string")
    w = mining.date_windows(df, "x", "t", ["id"])
    assert [(r["id"], str(r["window_start_date"])) for r in w.orderBy("window_start_date").collect()] == [(1, "2026-05-03"), (1, "2026-05-09")]
    r = mining.number_readings(df, "x", ["id", "t"])
    assert r.columns == ["id", "t", "number", "qualifier", "kind", "station", "episode_no", "sentence"]
    assert sorted((x["id"], x["t"], x["number"], x["qualifier"], x["station"]) for x in r.collect()) == [(1, at(0), 2.0, "about", "UWD"), (1, at(0), 5.0, "exact", "UWD")]
