"""What several corpus operators share: intermediate tables, columns carried unaltered, and input columns."""

from __future__ import annotations

import atexit
import gc
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, let_go: bool = False) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage and outlives lost executors.

    The table is removed by dropped(), or else when the driver's process ends. With let_go the files of
    the shuffles that made it go at once, and not when the driver's garbage is next collected.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true" if let_go else before)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    atexit.register(_remove, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Removes tables of written() that nothing reads any more."""
    for table in tables:
        _remove(table.sparkSession, table._written_path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the JVM has gone first
        pass


def mapped(df: DataFrame, run: Callable[[Iterator], Iterator[tuple]], adds: Mapping[str, str], keep: Sequence[str] | None = None) -> DataFrame:
    """df's columns (or those of `keep`) as they are, and the columns `adds` (name to SQL type) that run makes.

    run turns an iterator of Arrow batches into (batch or slice of one, {name: values}) pairs. Columns
    are carried as Arrow holds them, so longs beside nulls stay exact. A column of df whose name is in
    `adds` gets run's values.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kept = list(df.columns if keep is None else keep)
    new = T.StructType.fromDDL(", ".join(f"`{n}` {k}" for n, k in adds.items()))
    kinds = {f.name: to_arrow_type(f.dataType) for f in new}
    places = {n: df.columns.index(n) for n in kept if n not in adds}
    order = [*kept, *[n for n in adds if n not in kept]]

    def batches(parts):
        import pyarrow as pa

        for batch, values in run(parts):
            arrays = [batch.column(places[n]) if n in places else pa.array(values[n], kinds[n]) for n in order]
            yield pa.RecordBatch.from_arrays(arrays, names=order)

    schema = T.StructType([df.schema[n] if n in places else new[n] for n in order])
    return df.mapInArrow(batches, schema)


def values_of(batch, name: str) -> list:
    """A column of an Arrow batch as a list."""
    return batch.column(batch.schema.names.index(name)).to_pylist()


def join_dealt(many: DataFrame, few: DataFrame, key: Sequence[str], most: int = 1000) -> DataFrame:
    """many joined with few on key, where few has one row a key with the number `n` of its rows in many; n goes.

    Keys with over one in `most` of all rows are under `most` keys, so they are broadcast and their rows
    stay where they are; the others are shuffled. Both tables are read twice and should be written ones.
    """
    total = few.agg(F.sum("n").alias("n")).first()["n"] or 0
    often = F.col("n") > max(total / most, 1000)
    hot = few.where(often).drop("n")
    if hot.isEmpty():
        return many.join(few.drop("n"), list(key))
    rest = many.join(F.broadcast(hot.select(*key)), list(key), "left_anti").join(few.where(~often).drop("n"), list(key))
    return rest.unionByName(many.join(F.broadcast(hot), list(key)))


def ascii_lower(col):
    """A-Z to a-z, every other character kept."""
    return F.translate(col, UPPER, UPPER.lower())


_HELD: dict = {}


def per_worker(key, make):
    """What make() gives, kept for a Python worker's later tasks; one thing at a time, so that memory stays bounded."""
    if key not in _HELD:
        release_kept()
        _HELD[key] = make()
    return _HELD[key]


def release_kept() -> None:
    """Lets go of what a worker keeps from an operator before; it may hold itself in a circle, so it is collected at once."""
    if _HELD:
        _HELD.clear()
        gc.collect()
