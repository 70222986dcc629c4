"""Keyed writes, incremental windows, provenance and derived datasets; every function gives a new DataFrame."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tidemark.session import shared_table


def last_of_batch(batch: DataFrame, key: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """One row a key: the last by seq. Rows with a null in the key conflict with none and all stay."""
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    ranked = batch.where(whole).withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*[F.desc(c) for c in seq])))
    return ranked.where("_rank = 1").drop("_rank").unionByName(batch.where(~whole))


def upsert(target: DataFrame, batch: DataFrame, key: Sequence[str], seq: Sequence[str], update: Sequence[str] | None = None) -> DataFrame:
    """Inserts the batch into target; on an equal key the batch's columns win, others stay. Twice is as once.

    The last row of the batch by seq wins. Rows with a null in the key are appended. `update` names the
    columns that a conflict refreshes, by default all that the batch has.
    """
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    source = last_of_batch(batch, key, seq)
    given = [c for c in target.columns if c in source.columns and c not in key]
    fresh = [c for c in (update or given) if c in given]
    new = source.where(whole).select(*key, *[F.col(c).alias(f"_new_{c}") for c in given], F.lit(True).alias("_hit"))
    old = target.where(whole).withColumn("_old", F.lit(True))
    met = old.join(new, list(key), "full")
    pick = lambda c: F.when(F.col("_hit") & (F.col("_old").isNull() | F.lit(c in fresh)), F.col(f"_new_{c}")).otherwise(F.col(c)) if c in given else F.col(c)
    merged = met.select(*[pick(c).alias(c) for c in target.columns])
    loose = source.where(~whole).select([c for c in source.columns if c in target.columns])
    return merged.unionByName(target.where(~whole)).unionByName(loose, allowMissingColumns=True)


def insert_absent(target: DataFrame, batch: DataFrame, key: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """Inserts rows of the batch whose key target doesn't have; the first by seq of equal keys."""
    ranked = batch.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*seq))).where("_rank = 1").drop("_rank")
    absent = ranked.join(target.select(*key).distinct(), list(key), "left_anti")
    return target.unionByName(absent.select([c for c in absent.columns if c in target.columns]), allowMissingColumns=True)


def replace_window(target: DataFrame, batch: DataFrame, time: str, since) -> DataFrame:
    """target without its rows from `since` on, and the batch."""
    return target.where(F.col(time).isNull() | (F.col(time) < F.lit(since))).unionByName(batch, allowMissingColumns=True)


def replace_days(batch: DataFrame, path: str, time: str, since: dt.datetime) -> DataFrame:
    """A Parquet table in folders of days, its rows from `since` on replaced by the batch's; the table.

    Only the days from `since` on are written: the day of `since` anew with its earlier rows, days that the batch lacks
    are removed, and files of earlier days stay as they are. Batch rows before `since`, or without a time, are
    left out, so the same batch again leaves the same rows.
    """
    spark = batch.sparkSession
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    schema, start = StructType([*batch.schema.fields, StructField("_day", DateType())]), F.lit(since)
    day = F.to_date(time)
    kept = batch.where(F.col(time) >= start).withColumn("_day", day)
    known = [s.getPath().getName()[5:] for s in fs.listStatus(target)] if fs.exists(target) else []
    known = [d for d in known if re.fullmatch(r"\d{4}-\d{2}-\d{2}", d)]
    first = spark.range(1).select(F.to_date(start).cast("string").alias("d")).first()["d"]
    if first in known:
        earlier = spark.read.schema(schema).parquet(path).where((F.col("_day") == F.lit(first).cast("date")) & (F.col(time) < start))
        kept = kept.unionByName(earlier)
    kept = shared_table(kept, "days")
    new = {str(r["_day"]) for r in kept.select("_day").distinct().collect()}  # one row a day that is written
    kept.repartition("_day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_day").parquet(path)
    for gone in known:
        if gone >= first and gone not in new:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/_day={gone}"), True)
    return spark.read.schema(schema).parquet(path).drop("_day")


def purge(target: DataFrame, unwanted: Column) -> DataFrame:
    """Rows for which the predicate isn't true; a null predicate keeps the row."""
    return target.where(~F.coalesce(unwanted, F.lit(False)))


def by_precedence(df: DataFrame, key: Sequence[str], rank: Column, seq: Sequence[str] = ()) -> DataFrame:
    """One row a key: of the least rank, then the last by seq."""
    w = Window.partitionBy(*key).orderBy(rank, *[F.desc(c) for c in seq])
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def incremental_start(target: DataFrame, time: str, overlap: dt.timedelta, since: dt.datetime | None = None) -> dt.datetime | None:
    """Where to read on: `since` if given, else the newest stored time less an overlap, else None for everything."""
    if since is not None:
        return since
    newest = target.agg(F.max(time).alias("t")).first()["t"]
    return newest - overlap if newest is not None else None


def align_schema(df: DataFrame, wanted: StructType, key: Sequence[str], defaults: Mapping[str, object] | None = None) -> tuple[DataFrame, list[str]]:
    """df with the columns of `wanted` that it lacks, and their names; no column is dropped or retyped.

    A missing key column is an error; a column without a default is null.
    """
    missing = [f for f in wanted if f.name not in df.columns]
    if lost := [f.name for f in missing if f.name in key]:
        raise ValueError(f"key columns can't be added: {', '.join(lost)}")
    defaults = defaults or {}
    out = df.withColumns({f.name: F.lit(defaults.get(f.name)).cast(f.dataType) for f in missing}) if missing else df
    return out, [f.name for f in missing]


def derive(tables: Mapping[str, DataFrame], drop: Mapping[str, Column]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tables without the rows that `drop` names, and their reconciliation: tbl, n_before, n_after, n_expected, ok.

    A row goes only where its predicate is true, and is expected to stay otherwise, so nulls agree.
    """
    if unknown := set(drop) - set(tables):
        raise ValueError(f"no such table: {', '.join(sorted(unknown))}")
    kept = {n: purge(t, drop[n]) if n in drop else t for n, t in tables.items()}
    rows = []
    zero = F.lit(0).cast("long")
    for name, t in tables.items():
        gone = F.coalesce(F.sum(F.coalesce(drop[name].cast("int"), F.lit(0))), zero) if name in drop else zero
        rows.append(t.agg(F.lit(name).alias("tbl"), F.count("*").alias("n_before"), gone.cast("long").alias("gone"), zero.alias("n_after")))
        rows.append(kept[name].agg(F.lit(name).alias("tbl"), zero.alias("n_before"), zero.alias("gone"), F.count("*").alias("n_after")))
    sums = reduce(DataFrame.unionByName, rows).groupBy("tbl").agg(*[F.sum(c).alias(c) for c in ("n_before", "gone", "n_after")])
    report = sums.withColumn("n_expected", F.col("n_before") - F.col("gone"))
    return kept, report.select("tbl", "n_before", "n_after", "n_expected", (F.col("n_after") == F.col("n_expected")).alias("ok"))


def publish(tables: Mapping[str, DataFrame], drop: Mapping[str, Column], path: str, force: bool = False) -> DataFrame:
    """Writes a derived dataset: to a staging folder, checked, then moved into place; an existing one only with force."""
    spark = next(iter(tables.values())).sparkSession
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target) and not force:
        raise FileExistsError(path)
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    kept, report = derive(tables, drop)
    for name, t in kept.items():
        t.write.parquet(f"{staging}/{name}.parquet")
    written = {name: spark.read.schema(t.schema).parquet(f"{staging}/{name}.parquet") for name, t in kept.items()}
    expected = {r["tbl"]: r["n_expected"] for r in report.collect()}  # one row a table
    bad = [name for name, t in written.items() if t.count() != expected[name]]
    if bad:
        fs.delete(jvm.org.apache.hadoop.fs.Path(staging), True)
        raise ValueError(f"counts differ after derivation: {', '.join(bad)}")
    aside = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.replaced-{uuid.uuid4().hex}") if fs.exists(target) else None
    if aside is not None and not fs.rename(target, aside):
        raise OSError(f"could not move {path} aside; the new dataset is in {staging}")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(staging), target):
        if aside is not None:
            fs.rename(aside, target)
        raise OSError(f"could not move {staging} to {path}; what was there is back")
    if aside is not None:
        fs.delete(aside, True)
    return report


RUN_LOG = "run_id string, source string, started timestamp, finished timestamp, status string, rows_seen long, rows_written long, error string"


class Run:
    """One source's run, as a row of the run log: times, status, counts, and the error's first 2000 characters."""

    def __init__(self, spark: SparkSession, source: str):
        self.spark, self.source = spark, source
        self.rows_seen = self.rows_written = 0
        self.status, self.error = "running", None

    def __enter__(self) -> Run:
        self.run_id, self.started = uuid.uuid4().hex, dt.datetime.now(dt.UTC)
        return self

    def __exit__(self, kind, error, trace) -> bool:
        self.finished = dt.datetime.now(dt.UTC)
        self.status = "failed" if error else "ok"
        self.error = str(error)[:2000] if error else None
        return False

    def write(self, df: DataFrame, path: str, given: Sequence[str] = (), ranges: Mapping[str, tuple[float, float]] | None = None) -> dict[str, int]:
        """Writes a table and counts on the way: rows, nulls of the columns `given`, and values out of their ranges. The run's rows_written takes the rows.

        The counts come from the write itself, so no second scan is needed; a write that fails leaves the run's count as it was.
        """
        seen = Observation(f"{self.source}-{uuid.uuid4().hex}")
        counts = [F.count(F.lit(1)).alias("rows")]
        counts += [F.coalesce(F.sum(F.col(c).isNull().cast("long")), F.lit(0)).alias(f"null_{c}") for c in given]
        counts += [F.coalesce(F.sum((~F.col(c).between(a, b)).cast("long")), F.lit(0)).alias(f"outside_{c}") for c, (a, b) in (ranges or {}).items()]
        df.observe(seen, *counts).write.mode("append").parquet(path)
        found = {name: int(n) for name, n in seen.get.items()}
        self.rows_written += found["rows"]
        return found

    def row(self) -> DataFrame:
        values = (self.run_id, self.source, self.started, self.finished, self.status, self.rows_seen, self.rows_written, self.error)
        return self.spark.createDataFrame([values], RUN_LOG)


def run_all(spark: SparkSession, jobs: Mapping[str, Callable[[Run], None]]) -> DataFrame:
    """Runs each source; one that fails doesn't stop the others. The run log of all."""
    rows = []
    for name, job in jobs.items():
        run = Run(spark, name)
        try:
            with run:
                job(run)
        except Exception:  # recorded in the run
            pass
        rows.append(run.row())
    return reduce(DataFrame.unionByName, rows) if rows else spark.createDataFrame([], RUN_LOG)


def last_runs(log: DataFrame) -> DataFrame:
    """The newest run of each source."""
    return by_precedence(log, ["source"], F.lit(0), ["started", "run_id"])
