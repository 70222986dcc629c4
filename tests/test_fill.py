import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.intervals import as_of_backward_bucketed, fill_as_of

NOW = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


@pytest.mark.parametrize("keyed", [True, False])
def test_fill_against_a_naive_join(spark, keyed):
    r = random.Random(4)
    at = lambda: NOW + dt.timedelta(hours=r.choice((r.randrange(0, 900), r.randrange(0, 12))))
    left = [(i, r.choice([1, 1, 1, 1, 2, 3, None]), at() if i % 17 else None, i if i % 4 == 0 else None) for i in range(200)]
    right = [(r.choice([1, 1, 1, 2, None]), at() if i % 13 else None, 1000 + i) for i in range(60)]
    lt = spark.createDataFrame([(*row, "kept") for row in left], "id int, k int, t timestamp, number int, extra string").repartition(3)
    rt = spark.createDataFrame(right, "k int, s timestamp, v int")
    got = {g["id"]: (g["number"], g["source"], g["extra"]) for g in fill_as_of(lt, rt, "t", "s", "v", "number", "source", ["k"] if keyed else []).collect()}
    assert len(got) == 200
    for i, k, t, number in left:
        before = [(s, v) for rk, s, v in right if s is not None and t is not None and s <= t and (not keyed or (rk == k and k is not None))]
        want = (number, "stated") if number is not None else (max(before)[1], "inferred") if before else (None, None)
        assert got[i] == (*want, "kept"), i


def test_the_time_of_what_was_carried(spark):
    left = spark.createDataFrame([(1, NOW), (2, NOW + dt.timedelta(days=400))], "id int, t timestamp")
    right = spark.createDataFrame([(NOW, 7), (NOW, 9), (NOW + dt.timedelta(days=3), 5)], "s timestamp, v int")
    got = as_of_backward_bucketed(left, right, "t", "s", "v", "found").select("id", "found", F.unix_seconds("found_at").alias("at")).collect()
    start = int(NOW.timestamp())
    assert sorted(map(tuple, got)) == [(1, 9, start), (2, 5, start + 3 * 86_400)]
    assert as_of_backward_bucketed(left, right.where("false"), "t", "s", "v", "found").where("found is not null").count() == 0
