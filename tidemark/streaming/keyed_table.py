"""A keyed table that batches are merged into: rows in buckets of their key, and only buckets that a batch touches are written anew.

Each merge writes a folder of its own, v=<number>-<writer>-<batch>, with the whole content of the touched buckets; it
counts once Spark's success mark is there. A bucket's rows are those of the newest such folder that holds it; what is
superseded is removed afterwards. So readers never see half a merge, a merge that broke off is run again from
the start, and a batch that was merged already, as the writer and batch number in the folder's name say, changes nothing.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.keyed import last_of_batch, upsert

_FOLDER = re.compile(r"v=(\d+)-(\w+)-(\d+)")


class KeyedTable:
    """One row a key; of a batch's rows with an equal key the last by `seq` counts. Rows with a null in the key conflict with none.

    update: the columns that a conflict refreshes, by default all. in_order: a row whose seq lies before
    the stored row's is out of date and changes nothing, so the result doesn't depend on how rows come
    in batches; otherwise what comes later wins. One writer at a time; the number of buckets stays as it was first chosen.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: Sequence[str], seq: Sequence[str], buckets: int = 64, update: Sequence[str] | None = None, in_order: bool = False):
        self.spark, self.schema, self.key, self.seq, self.buckets, self.in_order = spark, schema, list(key), list(seq), buckets, in_order
        self.update = [*update, *(c for c in self.seq if c not in (*update, *self.key))] if update else None
        self.path = f"{path.rstrip('/')}/of={buckets}"
        self.fs = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _names(self, path: str) -> list[str]:
        target = self._at(path)
        return [s.getPath().getName() for s in self.fs.listStatus(target)] if self.fs.exists(target) else []

    def versions(self) -> list[tuple[int, str, int, str]]:
        """Number, writer, batch and folder of the merges that are complete, oldest first."""
        found = [(int(m[1]), m[2], int(m[3]), n) for n in self._names(self.path) if (m := _FOLDER.fullmatch(n))]
        return sorted(v for v in found if self.fs.exists(self._at(f"{self.path}/{v[3]}/_SUCCESS")))

    def _places(self) -> dict[int, str]:
        """The folder that holds each bucket now; as many as there are buckets at most."""
        places = {}
        for *_, folder in self.versions():
            for name in self._names(f"{self.path}/{folder}"):
                if name.startswith("_bucket="):
                    places[int(name[8:])] = f"{self.path}/{folder}/{name}"
        return places

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table, or the rows of some of its buckets."""
        paths = [p for b, p in sorted(self._places().items()) if buckets is None or b in buckets]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def bucket(self):
        """A row's bucket, by its key; rows without a whole key are spread by what they have, so they don't crowd one bucket."""
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in self.key])
        return F.pmod(F.when(whole, F.xxhash64(*self.key)).otherwise(F.xxhash64(*self.key, *self.seq)), F.lit(self.buckets)).cast("int")

    def merge(self, batch: DataFrame, writer: str, number: int) -> bool:
        """Merges a batch; False if it was merged before. What is read of the table is the touched buckets."""
        versions = self.versions()
        if any((w, n) == (writer, number) for _, w, n, _ in versions):
            return False
        wanted = batch.select([F.col(f.name).cast(f.dataType) for f in self.schema if f.name in batch.columns])
        source = last_of_batch(wanted, self.key, self.seq)
        touched = [r["b"] for r in wanted.select(self.bucket().alias("b")).distinct().collect()]  # at most the number of buckets
        stored = self.read(touched)
        if self.in_order:
            before = stored.select(*self.key, F.struct(*self.seq).alias("_stored"))
            source = source.join(before, self.key, "left").where(F.col("_stored").isNull() | (F.struct(*self.seq) >= F.col("_stored"))).drop("_stored")
        merged = upsert(stored, source, self.key, self.seq, self.update)
        folder = f"v={versions[-1][0] + 1 if versions else 0}-{writer}-{number}"
        placed = merged.withColumn("_bucket", self.bucket()).repartition("_bucket")
        placed.write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        self._clean()
        return True

    def _clean(self) -> None:
        """Removes buckets that a newer merge holds, and folders without any but each writer's last, which says what was merged."""
        versions = self.versions()
        last = {writer: folder for _, writer, _, folder in versions}
        held: set[str] = set()
        for *_, folder in reversed(versions):
            names = {n for n in self._names(f"{self.path}/{folder}") if n.startswith("_bucket=")}
            for name in names & held:
                self.fs.delete(self._at(f"{self.path}/{folder}/{name}"), True)
            if names <= held and folder not in last.values():
                self.fs.delete(self._at(f"{self.path}/{folder}"), True)
            held |= names


def merge_stream(stream: DataFrame, table: KeyedTable, checkpoint: str, writer: str = "stream") -> DataFrame:
    """Merges what has landed, batch by batch, into a keyed table; the table."""

    def merge(batch: DataFrame, number: int) -> None:
        batch.persist()  # it is read for the touched buckets and for the merge
        try:
            table.merge(batch, writer, number)
        finally:
            batch.unpersist()

    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return table.read()


def landed_in_parts(df: DataFrame, part, parts: int, folder: str, files: int = 1) -> str:
    """Writes df as one landed file after another, or so many at once: rows with part = 0 first. What a stream of that folder reads, file by file."""
    for k in range(parts):
        rows = df.where(part == k)
        (rows.coalesce(1) if files == 1 else rows.repartition(files)).write.mode("append").parquet(folder)
    return folder
