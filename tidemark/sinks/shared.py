"""A place for intermediate tables that every executor can reach."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from functools import cache
from uuid import uuid4

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


@cache
def _local_folder() -> str:
    """One folder per process, gone when it ends."""
    folder = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the cluster names; only local runs may lack one."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        root = _local_folder()
    return f"{root.rstrip('/')}/{name}-{uuid4().hex}"
