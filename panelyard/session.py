"""Session settings and the shared scratch folder."""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger("panelyard")

# What the results depend on (time zone) and what the plans rely on (run-time
# re-planning, skewed-join splitting, stream state that may outgrow memory).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Ids remembered for stream dedup may outgrow memory: keep state on disk.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def prepare_session(spark: SparkSession) -> SparkSession:
    """Applies the run-time settings to a session somebody else built."""
    for name, value in SESSION_CONF.items():
        spark.conf.set(name, value)
    return spark


def local_session(cpus: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A single-machine session, for tests and benchmarks."""
    parallel = 8 if cpus == "*" else int(cpus)
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName("panelyard")
               .config("spark.sql.shuffle.partitions", str(parallel))
               .config("spark.driver.memory", memory)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    for name, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    It is the one the cluster names in ``spark.checkpoint.dir``, else the one set
    on the context. Only a single-machine session may fall back to a temporary
    folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = None if folder else spark.sparkContext
    folder = folder or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="panelyard-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it wants it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def delete(spark: SparkSession, path: str) -> None:
    files, where = file_system(spark, path)
    files.delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, where = file_system(spark, path)
    return files.exists(where)


def make_marker(spark: SparkSession, path: str) -> None:
    """An empty file that says that what it names is finished."""
    files, where = file_system(spark, path)
    files.create(where, True).close()


def markers(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the markers in a folder, ascending."""
    files, where = file_system(spark, folder)
    if not files.exists(where):
        return []
    names = [s.getPath().getName() for s in files.listStatus(where)]
    return sorted(int(n) for n in names if n.isdigit())


_RUN: ContextVar[str] = ContextVar("panelyard_run", default="")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/panelyard/{_RUN.get()}{uuid.uuid4().hex}/{name}"


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[None]:
    """Removes what was staged inside the block when it ends, also after an error.

    Nothing that is still to be read may be left in it: results are to be written to
    a folder of their own before.
    """
    name = f"run-{uuid.uuid4().hex}/"
    token = _RUN.set(_RUN.get() + name)
    folder = f"{scratch_root(spark)}/panelyard/{_RUN.get()}"
    try:
        yield
    finally:
        _RUN.reset(token)
        delete(spark, folder)


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Removes the shuffle files of each job inside the block when it ends, not when the driver
    happens to collect garbage, so that the disk holds those of one step and not of all.

    For blocks that write what they make: a table made inside and read twice is worked out twice.
    """
    before = spark.conf.get(_FREE_SHUFFLES)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


def staged(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it back.

    Cuts the lineage where a result feeds several later passes: each pass then
    scans only the columns it needs, and a lost executor costs a re-read rather
    than a recomputation. ``compression`` is the session's unless it is given.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
