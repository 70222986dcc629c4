import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.range_sums import range_aggregate

NOW = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


def parts():
    return {"n": ("sum", F.lit(1).cast("long")), "total": ("sum", F.col("v")), "least": ("min", F.col("v")), "most": ("max", F.col("v"))}


def brute_force(points, intervals, by_key, also):
    out = {}
    for number, k, low, high in intervals:
        if low is None or high is None:
            continue
        for pk, t, v, station in points:
            if t is not None and low <= t < high and (not by_key or (pk == k and k is not None)):
                out.setdefault((number, k, station if also else 0), []).append(v)
    known = lambda vs: [v for v in vs if v is not None]
    return {key: (len(vs), sum(known(vs)) if known(vs) else None, min(known(vs), default=None), max(known(vs), default=None)) for key, vs in out.items()}


@pytest.mark.parametrize("bucket", [1, 3600, 21_600])
@pytest.mark.parametrize("by_key", [True, False])
def test_against_brute_force(spark, bucket, by_key):
    r = random.Random(bucket)
    times = [r.choice((r.randrange(0, 5_000), r.randrange(0, 40 * 86_400), r.randrange(-200, 200) * bucket)) for _ in range(300)]
    at = lambda s: NOW + dt.timedelta(seconds=s)
    points = [(r.choice([1, 1, 1, 1, 1, 2, None]), at(t) if r.random() < 0.98 else None, r.choice([None, 1, 5, -3, 10]), r.choice(["a", None])) for t in times]
    spans = [sorted(r.sample(times, 2)) for _ in range(60)] + [(0, 0), (5, 1), (bucket * 3, bucket * 3 + 1), (-bucket, 500 * bucket)]
    intervals = [(i, r.choice([1, 2, None]), at(a), at(b)) for i, (a, b) in enumerate(spans)] + [(1000, 1, None, at(9)), (1001, 1, at(9), None)]
    p = spark.createDataFrame(points, "k int, t timestamp, v long, station string").repartition(3)
    i = spark.createDataFrame(intervals, "number int, k int, low timestamp, high timestamp")
    by = ["k"] if by_key else []
    for also in ([], ["station"]):
        got = range_aggregate(p if by_key else p.drop("k"), i, "t", "low", "high", parts(), ["number", "k"], by, also, bucket).collect()
        assert {(g["number"], g["k"], g["station"] if also else 0): (g["n"], g["total"], g["least"], g["most"]) for g in got} == brute_force(points, intervals, by_key, also)
        assert len(got) == len(brute_force(points, intervals, by_key, also))


def test_rows_that_meet_are_bounded(spark):
    """One busy key: 2,000 points and 300 long intervals are 600,000 pairs, of which under a tenth become rows."""
    p = spark.range(2_000).select(F.lit(1).alias("k"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 4_000).alias("t"), F.col("id").alias("v"))
    i = spark.range(300).select(F.col("id").alias("number"), F.lit(1).alias("k"), F.timestamp_seconds(F.lit(1_699_990_000) + F.col("id")).alias("low"), F.timestamp_seconds(F.lit(1_708_000_000) + F.col("id")).alias("high"))
    out = range_aggregate(p, i, "t", "low", "high", parts(), ["number", "k"], ["k"])
    assert {(r[0], r[1]) for r in out.select("n", "total").collect()} == {(2_000, 1_999_000)}
    plan = out._jdf.queryExecution().executedPlan()
    met = max(n.metrics().apply("numOutputRows").value() for n in nodes(plan) if "Join" in n.nodeName())
    assert met < 60_000 and "Cartesian" not in plan.toString() and "NestedLoop" not in plan.toString()


def nodes(plan):
    """All nodes of an executed plan, adaptive stages included."""
    out, waiting = [], [plan]
    while waiting:
        node = waiting.pop()
        out.append(node)
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            waiting.append(node.plan())
        else:
            children = node.children()
            waiting += [children.apply(i) for i in range(children.size())]
    return out


def test_empty_sides(spark):
    p = spark.createDataFrame([], "k int, t timestamp, v long")
    i = spark.createDataFrame([(1, 1, NOW, NOW + dt.timedelta(1))], "number int, k int, low timestamp, high timestamp")
    assert range_aggregate(p, i, "t", "low", "high", parts(), ["number", "k"], ["k"]).count() == 0
    assert range_aggregate(p, i.where("false"), "t", "low", "high", parts(), ["number", "k"], ["k"]).count() == 0
