"""Folders that every executor can reach."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the session's ``spark.checkpoint.dir``, or else below the
    context's checkpoint folder.

    Only where both are absent and the session is local, as in a test, a temporary
    folder of this machine stands in; it is removed when the program ends.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        set_there = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = set_there.get() if set_there.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="citewise-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
