"""Session settings that every operator of the library counts on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def read_table(spark: SparkSession, sf_dir: str, name: str):
    """One table of a data folder; a file or a folder of part files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df):
    """df's rows dealt evenly over several tasks a core: a file's row group, often a million rows, is read by one task, too many where each row is costly."""
    return df.repartition(max(32, 4 * df.sparkSession.sparkContext.defaultParallelism))


_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset a local master, as in tests, gets a temporary folder of its own; on a cluster
    that is an error, since executors would write to disks that the others don't see.
    """
    import tempfile

    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="spark-")
    return _LOCAL[context.applicationId]


def shared_table(df, name: str):
    """df as a Parquet table in the shared folder, so that what follows doesn't compute it again and lost executors don't matter."""
    import uuid

    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable in the Python workers, once a context, unless it is already.

    Workers find it through PYTHONPATH or the working folder; else it is sent along as a zip, as
    --py-files would.
    """
    import os
    import tempfile
    import zipfile
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    places = [Path(p or ".").resolve() for p in (*os.environ.get("PYTHONPATH", "").split(os.pathsep), ".")]
    context = spark.sparkContext
    if root in places or getattr(context, "_tidemark_shipped", False):
        return
    path = Path(tempfile.mkdtemp(prefix="spark-")) / "tidemark.zip"
    with zipfile.ZipFile(path, "w") as out:
        for f in sorted((root / "tidemark").rglob("*.py")):
            out.write(f, f.relative_to(root))
    context.addPyFile(str(path))
    context._tidemark_shipped = True
