"""Folders for data that only one run needs."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def _local_base() -> str:
    """One folder on this machine for all local sessions; removed as the process ends."""
    base = tempfile.mkdtemp(prefix="monthfusion-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the folder all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``.  Only a local
    session without the setting gets a folder on this machine; the setting itself
    is never changed.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "local")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
