"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}
_WORKSPACES: list[list[DataFrame]] = []


def build_session(app: str = "cinderpost", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the jobs expect; keyword ``a_b`` stands for ``a.b``."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config("spark." + key.replace("_", "."), str(value))
    return builder.getOrCreate()


def bucketed_table(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """Like ``stage``, hash-bucketed by ``keys``: grouping and joining by them needs no shuffle.

    There are as many buckets as shuffle partitions, so that what is shuffled by ``keys`` meets
    them as it comes.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"cinderpost_{name}_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/cinderpost/{table}"
    writer = df.repartition(buckets, *keys).write.format("parquet").option("path", path)
    writer.bucketBy(buckets, *keys).saveAsTable(table)
    written = spark.table(table)
    written._stage_path, written._stage_table = path, table
    if _WORKSPACES:
        _WORKSPACES[-1].append(written)
    return written


@contextmanager
def bucketed_stage(df: DataFrame, name: str, key: str) -> Iterator[DataFrame]:
    """A ``bucketed_table`` that is grouped many times, as in training rounds.

    The table and its files are there only inside the ``with`` block.
    """
    written = bucketed_table(df, name, key)
    try:
        yield written
    finally:
        discard(written)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per session; they may not have it."""
    context = spark.sparkContext
    if getattr(context, "_cinderpost_shipped", False):
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="cinderpost-code-")
    archive = shutil.make_archive(
        f"{folder}/{package.name}", "zip", root_dir=package.parent, base_dir=package.name
    )
    context.addPyFile(archive)
    context._cinderpost_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the checkpoint folder of the session.

    Only a local session without one gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    application = context.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="cinderpost-")
    return _LOCAL_FOLDERS[application]


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Deal the rows of a scan over all cores when it has fewer splits than there are cores.

    Few, large or unsplittable files (one row group, multi-line CSV) would leave the text work
    to a few tasks. A scan with enough splits is returned as it is, so large inputs are never
    shuffled for this.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, key) if scan.rdd.getNumPartitions() < cores else scan


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder, in folders by ``partition_by``, and read it back.

    Cuts the lineage so that lost executors never recompute it, fixes its rows, and gives
    Catalyst a real size for its join choices.
    """
    path = f"{shared_folder(df.sparkSession)}/cinderpost/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written._stage_path = path
    if _WORKSPACES:
        _WORKSPACES[-1].append(written)
    return written


@contextmanager
def workspace() -> Iterator[None]:
    """Delete every stage written inside the block when it ends.

    For a piece of work whose result has been written or collected by then: a query of the
    command line tools, a micro-batch of a stream.
    """
    _WORKSPACES.append([])
    try:
        yield
    finally:
        discard(*_WORKSPACES.pop())


def discard(*stages: DataFrame) -> None:
    """Delete the files of stages that nothing reads any more; other frames are left alone.

    Call it only after everything derived from them was written itself.
    """
    for df in stages:
        path = getattr(df, "_stage_path", None)
        if path:
            if getattr(df, "_stage_table", None):
                df.sparkSession.sql(f"DROP TABLE IF EXISTS {df._stage_table}")
            delete_folder(df.sparkSession, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
