import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.ranks import nth_values


def picks():
    n = F.col("n")
    return {"least": F.lit(1), "low": F.floor((n + 1) / 2), "high": F.ceil((n + 1) / 2), "most": n, "third": F.lit(3), "none": n + 1}


def brute_force(rows, key):
    out = {}
    for k, v in rows:
        if v is not None and v == v:
            out.setdefault(k if key else None, []).append(v)
    pick = lambda vs: (vs[0], vs[(len(vs) + 1) // 2 - 1], vs[(len(vs) + 2) // 2 - 1], vs[-1], vs[2] if len(vs) > 2 else None, None)
    return {k: pick(sorted(vs)) for k, vs in out.items()}


@pytest.mark.parametrize("kind, most", [("spread", 40), ("ties", 40), ("far", 40), ("spread", 10_000)])
def test_ranks_of_a_series_with_nine_tenths_of_all_rows(spark, kind, most):
    r = random.Random(most)
    draw = {"spread": lambda: r.gauss(0, 1), "ties": lambda: float(r.choice([0, 0, 0, 1, 5])), "far": lambda: r.choice([-1, 1]) * 10.0 ** r.randrange(0, 308)}[kind]
    rows = [(r.choice([1] * 18 + [2, None]), draw() if r.random() < 0.97 else r.choice([None, float("nan")])) for _ in range(600)] + [(3, None), (4, 2.5)]
    df = spark.createDataFrame(rows, "k int, v double").repartition(4)
    got = {g["k"]: tuple(g)[1:] for g in nth_values(df, ["k"], "v", picks(), most).collect()}
    assert got == brute_force(rows, True)
    if most > 40:
        assert [tuple(g) for g in nth_values(df, [], "v", picks(), most).collect()] == [brute_force(rows, False)[None]]


def test_no_values(spark):
    df = spark.createDataFrame([], "k int, v double")
    assert nth_values(df, ["k"], "v", picks()).count() == 0
    assert nth_values(df, [], "v", picks()).count() == 0
