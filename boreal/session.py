"""Session helpers: builder defaults, table access and tables written to the cluster's shared folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = 8, memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A session for tests and benches on one machine; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("boreal")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the session's Python workers, whatever their search path: once for each
    application it goes to them as a zip file."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="boreal-package-")
    atexit.register(shutil.rmtree, folder, True)
    target = os.path.join(folder, f"{root.name}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, str(path.relative_to(root.parent)))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the session's ``spark.checkpoint.dir``. Only a session on one machine may leave
    it unset and gets a temporary folder that goes away with the process; on a cluster that is a ValueError, as its
    executors would each write to a disk of their own."""
    base = spark.conf.get(_CONF, None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise ValueError(f"{_CONF} is not set: on {master} intermediate tables need a folder all executors share")
        base = tempfile.mkdtemp(prefix="boreal-")
        atexit.register(shutil.rmtree, base, True)
        spark.conf.set(_CONF, base)
    return base.rstrip("/")


_MARKED: set[str] = set()


def scratch(spark: SparkSession) -> str:
    """This application's own part of the shared folder. It is deleted when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/boreal-{spark.sparkContext.applicationId}"
    if path not in _MARKED:
        folder, files = _hadoop(spark, path)
        files.mkdirs(folder)
        files.deleteOnExit(folder)
        _MARKED.add(path)
    return path


def _hadoop(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def written(df: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back: one computation however often
    the result is used, no lineage behind it, and nothing lost with an executor."""
    spark = df.sparkSession
    ship(spark)
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    if partitions:
        df = df.coalesce(partitions)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._boreal_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the table behind a result of ``written`` that nothing reads any more, as a finished round's."""
    path = getattr(df, "_boreal_path", None)
    if path:
        folder, files = _hadoop(df.sparkSession, path)
        files.delete(folder, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder. One that comes in fewer splits than the cluster has cores (a small file of one row
    group) is dealt out, for the work done on a row is far dearer than moving it; a large table never is."""
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
