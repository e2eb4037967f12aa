"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "foulee", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; the cluster's own defaults win elsewhere."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Recording the Python call site of every column costs more than planning does.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # HotSpot does not compile methods above 8000 bytes of bytecode. Past that size, separate
        # compiled projections beat one fused method that stays interpreted.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session that names none gets a temporary folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="foulee-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def remove_folders(spark: SparkSession, pattern: str, wanted: Callable[[str], bool] = lambda name: True) -> None:
    """Delete the folders that match a pattern of the file system and whose name is ``wanted``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.globStatus(path) or []:
        if wanted(found.getPath().getName()):
            files.delete(found.getPath(), True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise a small frame in the checkpoint folder, so lost executors cannot change it."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


_OPEN_SCOPES: list[list[str]] = []


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Owns the tables that are staged inside: they are removed at the end of the block.

    Frames built inside may read them, so what is to stay must have been written or collected by then.
    Outside of any block staged tables stay, as a frame that reads them may be used at any time.
    """
    scope: list[str] = []
    _OPEN_SCOPES.append(scope)
    try:
        yield
    finally:
        _OPEN_SCOPES.remove(scope)
        for path in scope:
            remove_folders(spark, path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Materialise a large frame as a table in the shared folder and read it back: unlike a
    checkpoint it is compressed, and later passes read only the columns they need.
    The innermost ``staging`` block owns the table."""
    path = scratch_path(df.sparkSession, name)
    if _OPEN_SCOPES:
        _OPEN_SCOPES[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
