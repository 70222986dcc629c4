"""Incremental jobs with Structured Streaming: landed files in, keyed tables out, the same as the batch."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.operators.keyed import by_precedence
from tidemark.session import shared_dir


def landed(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """A stream of the Parquet files in a folder; of one file, its folder is watched for that name."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).isDirectory():
        return reader.option("pathGlobFilter", target.getName()).parquet(target.getParent().toString())
    return reader.parquet(path)


def without_repeats(stream: DataFrame, time: str, key: Sequence[str], overlap: str = "7 days") -> DataFrame:
    """Rows that a re-read within the overlap brings again go; revisions of a row need a keyed merge instead."""
    return stream.withWatermark(time, overlap).dropDuplicatesWithinWatermark(list(key))


def run_available(stream: DataFrame, mode: str, folder: str) -> DataFrame:
    """Runs a stream over what has landed, each batch appended with its number; the appended table."""
    spark = stream.sparkSession

    def append(batch: DataFrame, number: int) -> None:
        # a batch that is run again after a failure replaces its own rows
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/rows/part={number}")

    query = stream.writeStream.outputMode(mode).foreachBatch(append).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    schema = StructType([*stream.schema.fields, StructField("_batch", IntegerType())])
    return spark.read.schema(schema).parquet(f"{folder}/rows/part=*")


def hourly_stream(stream: DataFrame, by: Sequence[str], time: str, value: str, segment: str, late: str = "7 days") -> DataFrame:
    """An hourly rollup that is emitted again when late rows change it; the newest of each hour counts."""
    return (
        stream.withWatermark(time, late)
        .groupBy(*by, F.window(time, "1 hour").alias("_w"))
        .agg(F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"), F.stddev_samp(value).alias("std"), F.count("*").alias("n"), F.size(F.collect_set(segment)).alias("n_segments"))
        .withColumn("hour", F.col("_w.start"))
        .drop("_w")
    )


def merged(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """The newest batch's row of each key."""
    return by_precedence(rows, key, -F.col("_batch")).drop("_batch")


class LevelChanges(StatefulProcessor):
    """Each entity's rows with the level before them, put right when rows come late.

    State: one value, read and written once a batch: the last level before the watermark, a count of what came, and the
    rows since then as arrays in order of time. A row is emitted when it comes, and again, with a greater version, when a
    late one changes what stands before it. Timers of event time take rows that can't be late any more out of the arrays,
    so state is bounded by the lateness allowed.
    """

    def __init__(self, schema: StructType, entity: str, micros: str, row_id: str, level: str):
        self.schema, self.entity, self.micros, self.row_id, self.level = schema, entity, micros, row_id, level

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kinds = [self.schema[c].dataType.simpleString() for c in (self.micros, self.row_id, self.level)]
        self.kept = handle.getValueState("kept", "settled {2}, version long, micros array<{0}>, ids array<{1}>, levels array<{2}>".format(*kinds))
        self.emitted = Row(self.entity, self.row_id, "level", "previous", "changed", "version")

    def _kept(self) -> tuple:
        """The settled level, the version, and the rows since."""
        found = self.kept.get()
        return (found[0], found[1], list(zip(*found[2:]))) if found is not None else (None, 0, [])

    def _keep(self, settled, version: int, rows: list[tuple]) -> None:
        self.kept.update((settled, version, *(list(c) for c in (zip(*rows) if rows else ((), (), ())))))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        settled, version, old = self._kept()
        came = {(r[self.micros], r[self.row_id], r[self.level]) for r in rows} - set(old)
        if not came:
            return
        listed = sorted([*old, *came], key=lambda r: r[:2])
        before, version = settled, version + 1
        known = dict(zip(old, [before, *(r[2] for r in old)]))
        for row in listed:
            if row in came or known[row] != before:
                yield self.emitted(key[0], row[1], row[2], before, before != row[2], version)
            before = row[2]
        self._keep(settled, version, listed)
        if not old:
            self.handle.registerTimer(listed[0][0] // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        (settled, version, listed), mark = self._kept(), timerValues.getCurrentWatermarkInMs()
        past = [r for r in listed if r[0] < mark * 1000]
        rest = listed[len(past) :]
        if past:
            self._keep(past[-1][2], version, rest)
        if rest:
            self.handle.registerTimer(rest[0][0] // 1000 + 1)
        return iter(())

    def close(self) -> None:
        pass


def level_change_stream(stream: DataFrame, entity: str, level: str, time: str, row_id: str, late: str = "7 days") -> DataFrame:
    """Each row's row_id, entity, level, previous level, changed and version, in order of event time; a row comes again when late ones change it.

    Merged into a keyed table of row_id, the greatest version last, the rows are those of a lag over all. Rows without a level don't count;
    rows later than `late` are dropped.
    """
    use_rocksdb(stream.sparkSession)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the driver's own worker doesn't look where executors find packages
    known = stream.where(F.col(level).isNotNull() & F.col(time).isNotNull()).select(entity, level, time, row_id, F.unix_micros(time).alias("_us")).withWatermark(time, late)
    kind = dict(stream.dtypes)
    schema = f"{entity} {kind[entity]}, {row_id} {kind[row_id]}, level {kind[level]}, previous {kind[level]}, changed boolean, version long"
    return known.groupBy(entity).transformWithState(LevelChanges(known.schema, entity, "_us", row_id, level), schema, "Append", "EventTime")


def use_rocksdb(spark: SparkSession) -> None:
    """State in RocksDB, which transformWithState needs and which holds more than memory does."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
