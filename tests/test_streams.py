import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.intervals import ordered_lag
from tidemark.operators.keyed import upsert
from tidemark.streaming import jobs
from tidemark.streaming.keyed_table import KeyedTable, landed_in_parts, merge_stream

NOW = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files_of(path):
    return {str(p.relative_to(path)) for p in path.rglob("*.parquet") if p.is_file()}


def made(spark, n=90):
    rows = [(i, i % 7 if i % 11 else None, "ab"[i % 2], float(i * 37 % 50), i * 13 % 40) for i in range(n)]
    return spark.createDataFrame(rows, "id int, k int, name string, value double, seq int")


def test_batches_merge_as_one_upsert_after_the_other(spark, tmp_path):
    df = made(spark)
    table = KeyedTable(spark, str(tmp_path), df.schema, ["k", "name"], ["seq", "id"], buckets=4, update=["value"])
    want = spark.createDataFrame([], df.schema)
    for n in range(3):
        batch = df.where(f"id % 3 = {n}")
        assert table.merge(batch, "w", n)
        want = upsert(want, batch, ["k", "name"], ["seq", "id"], ["value", "seq", "id"])
        assert rows_of(table.read()) == rows_of(want)
    before = files_of(tmp_path)
    assert not table.merge(df.where("id % 3 = 2"), "w", 2)  # a batch that is run twice changes nothing
    assert files_of(tmp_path) == before and rows_of(table.read()) == rows_of(want)


def test_only_touched_buckets_are_written(spark, tmp_path):
    df = made(spark).where("k is not null")
    table = KeyedTable(spark, str(tmp_path), df.schema, ["k", "name"], ["seq", "id"], buckets=16)
    table.merge(df, "w", 0)
    before = files_of(tmp_path)
    table.merge(df.where("k = 3 and name = 'a'").withColumn("value", F.lit(-1.0)), "w", 1)
    gone = before - files_of(tmp_path)
    assert len({p.split("/")[2] for p in gone}) == 1 and len(before - gone) > 0
    assert {r["value"] for r in table.read().where("k = 3 and name = 'a'").collect()} == {-1.0}
    assert table.read().count() == 14


def test_a_merge_that_broke_off_is_not_seen(spark, tmp_path):
    df = made(spark).where("k is not null")
    table = KeyedTable(spark, str(tmp_path), df.schema, ["k", "name"], ["seq", "id"], buckets=4)
    table.merge(df.where("id < 40"), "w", 0)
    want = rows_of(table.read())
    df.withColumn("_bucket", F.lit(0)).write.partitionBy("_bucket").parquet(f"{table.path}/v=1-w-1")
    (tmp_path / "of=4" / "v=1-w-1" / "_SUCCESS").unlink()
    assert rows_of(table.read()) == want
    assert table.merge(df.where("id >= 40"), "w", 1) and table.read().count() == 14


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_rows_in_order_do_not_depend_on_batches(spark, tmp_path, order):
    df = made(spark).where("k is not null").drop("id").dropDuplicates(["k", "name", "seq"])
    table = KeyedTable(spark, str(tmp_path), df.schema, ["k", "name"], ["seq"], buckets=4, in_order=True)
    for n in order:
        table.merge(df.where(f"seq % 3 = {n}"), "w", n)
    want = df.groupBy("k", "name").agg(F.max_by("value", "seq").alias("value"), F.max("seq").alias("seq"))
    assert rows_of(table.read()) == rows_of(want)


def test_empty_batches_and_tables(spark, tmp_path):
    df = made(spark)
    table = KeyedTable(spark, str(tmp_path), df.schema, ["k"], ["id"], buckets=4)
    assert table.read().count() == 0
    assert table.merge(df.where("false"), "w", 0) and table.read().count() == 0
    assert table.merge(df.select("id", "k", "name"), "w", 1)  # a batch may lack columns
    assert table.read().where("k is null").count() == df.where("k is null").count()


def test_levels_with_late_rows_are_those_of_a_lag_over_all(spark, tmp_path):
    rows = [(i, i % 3, NOW + dt.timedelta(hours=i * 29 % 200), "xyz"[i * i % 3] if i % 13 else None) for i in range(120)]
    df = spark.createDataFrame(rows, "event_id int, user_id int, ts timestamp, level string")
    folder = landed_in_parts(df, F.col("event_id") % 4, 4, str(tmp_path / "in"))
    stream = jobs.landed(spark, folder, df.schema, files_per_batch=1)
    changes = jobs.level_change_stream(stream, "user_id", "level", "ts", "event_id", late="30 days")
    table = KeyedTable(spark, str(tmp_path / "t"), changes.schema, ["event_id"], ["version"], buckets=4, in_order=True)
    got = merge_stream(changes, table, str(tmp_path / "c"))
    for user in range(3):
        lagged = ordered_lag(df.where(f"user_id = {user} and level is not null"), ["ts", "event_id"], {"level": "previous"}, F.to_date("ts"))
        assert rows_of(got.where(f"user_id = {user}").select("event_id", "level", "previous")) == rows_of(lagged.select("event_id", "level", "previous"))
    assert got.where("changed <> (previous is null or previous <> level)").count() == 0


def test_settled_rows_leave_the_state_and_still_count(spark, tmp_path):
    rows = [(i, 1, NOW + dt.timedelta(days=i // 5), "xyz"[i * i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "event_id int, user_id int, ts timestamp, level string")
    folder = landed_in_parts(df, F.floor(F.col("event_id") / 10), 6, str(tmp_path / "in"))
    changes = jobs.level_change_stream(jobs.landed(spark, folder, df.schema, files_per_batch=1), "user_id", "level", "ts", "event_id", late="1 day")
    table = KeyedTable(spark, str(tmp_path / "t"), changes.schema, ["event_id"], ["version"], buckets=2, in_order=True)
    got = merge_stream(changes, table, str(tmp_path / "c"))
    lagged = ordered_lag(df, ["ts", "event_id"], {"level": "previous"}, F.to_date("ts"))
    assert rows_of(got.select("event_id", "level", "previous")) == rows_of(lagged.select("event_id", "level", "previous"))


class CountedState:
    """Value state and timers in memory that count what is asked of them."""

    def __init__(self):
        self.value, self.calls = None, 0

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def registerTimer(self, at):
        self.calls += 1


def test_levels_read_and_write_their_state_once_a_batch():
    from pyspark.sql import Row
    from pyspark.sql.types import StructType

    levels = jobs.LevelChanges(StructType.fromDDL("user_id int, event_id int, level string, _us long"), "user_id", "_us", "event_id", "level")
    levels.init(state := CountedState())
    batches, got = [[(1, 10, "a"), (3, 30, "b")], [(2, 20, "b"), (3, 30, "b")], [(3, 30, "b")], [(4, 15, "c")]], []
    for n, batch in enumerate(batches):
        before = state.calls
        rows = levels.handleInputRows((7,), iter([Row(event_id=i, _us=us, level=v) for i, us, v in batch]), None)
        got.append([tuple(r)[1:] for r in rows])
        assert state.calls - before == [3, 2, 1, 2][n]  # the first batch sets a timer too
    assert got == [[(1, "a", None, True, 1), (3, "b", "a", True, 1)], [(2, "b", "a", True, 2), (3, "b", "b", False, 2)], [], [(4, "c", "a", True, 3), (2, "b", "c", True, 3)]]


def test_landed_parts_of_several_files_are_batches(spark, tmp_path):
    df = made(spark)
    folder = landed_in_parts(df, F.col("id") % 3, 3, str(tmp_path / "in"), files=4)
    assert len(files_of(tmp_path / "in")) == 12
    got = jobs.run_available(jobs.landed(spark, folder, df.schema, files_per_batch=4).select("id"), "append", str(tmp_path / "out"))
    assert rows_of(got) == sorted(((i, i % 3) for i in range(90)), key=repr)
