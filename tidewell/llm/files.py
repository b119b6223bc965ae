"""Files that tasks write and read through Arrow's file systems, below the folder that the cluster names as shared."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs
from pyspark.sql import SparkSession

from tidewell.session import discard_later, scratch_root


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder name that nothing uses yet, in the shared folder; it goes with the cuts of an open ``discarding_cuts``."""
    return discard_later(f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}")


def locate(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def create(folder: str, name: str):
    """Open a new file; its name is unique, so a repeated task writes another file and the unlisted one is never read."""
    system, path = locate(folder)
    system.create_dir(path, recursive=True)
    unique = f"{name}-{uuid.uuid4().hex}"
    return f"{folder}/{unique}", system.open_output_stream(f"{path}/{unique}")
