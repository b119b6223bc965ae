"""Session defaults and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution is what splits hot join keys and sizes reducers at run time, so it is part of the
# contract of this package rather than a tuning choice of the caller.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # HotSpot never compiles a method above 8000 bytes of bytecode. Above that, plain iterators over compiled
    # expressions are several times faster than one fused stage that stays interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    for name, value in SESSION_CONF.items():
        spark.conf.set(name, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the cluster names it in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    folder = tempfile.mkdtemp(prefix="tidewell-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_scope: ContextVar[list[str] | None] = ContextVar("cuts", default=None)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system its path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def discarding_cuts(spark: SparkSession) -> Iterator[None]:
    """Delete the cuts that this thread makes inside the block when it ends; nothing lazy may read them afterwards."""
    written: list[str] = []
    token = _scope.set(written)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in written:
            delete_folder(spark, path)


def discard_later(path: str) -> str:
    """Name a folder that :func:`discarding_cuts` deletes with the cuts, if one is open."""
    if (scope := _scope.get()) is not None:
        scope.append(path)
    return path


def materialize(df: DataFrame, label: str = "cut", **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; ``options`` are those of the parquet writer.

    Used where one intermediate feeds several branches or where a value must not change on re-execution.
    The written table survives executor loss, and its real file size lets the planner choose join sides.
    """
    spark = df.sparkSession
    path = discard_later(f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)

