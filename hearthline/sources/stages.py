"""Stage tables: results written once where several later passes read them.

A stage table is Parquet in the shared folder that ``spark.checkpoint.dir`` names, so it
outlives any executor, cuts the lineage and lets each later pass read only its own columns.
Tables made inside ``scratch`` are removed at its end.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_scratch: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder for stage tables and checkpoints, taken from the session.

    Only a session whose executors are this one process gets a folder of its own without the setting.
    """
    context = spark.sparkContext
    folder = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="hearthline-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)  # iterative fits cut their lineage there
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses; ``scratch`` removes what is there."""
    path = f"{shared_folder(spark)}/stages/{name}-{uuid.uuid4().hex}"
    for paths in _scratch:
        paths.append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a stage table and return a scan of it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let_go(spark: SparkSession) -> None:
    """Free the shuffles and broadcasts of frames that are gone, which Spark does when the driver collects garbage.

    A job of many small steps leaves some at each, and a driver with a large heap may not collect for long.
    """
    spark.sparkContext._jvm.System.gc()


def kept(df: DataFrame, name: str) -> DataFrame:
    """A stage table, after which what made it is let go."""
    out = stage(df, name)
    let_go(df.sparkSession)
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(target, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the stage tables made inside at the end, also after an error.

    Frames that still read them can't be used afterwards: write results inside.
    """
    paths: list[str] = []
    _scratch.append(paths)
    try:
        yield
    finally:
        _scratch.remove(paths)
        for path in paths:
            remove(spark, path)
