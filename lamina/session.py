"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "*", app: str = "lamina", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run's tables and checkpoints, under ``spark.checkpoint.dir``.

    The machine's own temporary folder serves only a local master, for as long as the process runs:
    executors of a cluster could not read it, and it is gone with the machine.
    """
    run = f"{name}-{uuid.uuid4().hex}"
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{run}"
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix=f"{run}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
