"""Session settings the library relies on, and the shared folder for written stages."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    # Local business days are computed from instants, so the session zone must be fixed.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

START_SETTINGS = {
    "spark.ui.enabled": "false",
    # Call-site capture doubles the time it takes to build a plan from Python.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "resalelake", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **START_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_runtime(spark: SparkSession) -> SparkSession:
    """Apply the settings that decide results to a session somebody else built."""
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(key, RUNTIME_SETTINGS[key])
    return spark


def together(jobs: Sequence[Callable[[], object]], at_once: int = 4) -> list:
    """Run independent Spark jobs side by side, so that the short tail of one leaves no executor idle; results in order."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        running = [pool.submit(inheritable_thread_target(SparkSession.active())(job)) for job in jobs]
        return [r.result() for r in running]


def released(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of tables that are written by now; it does so once nothing refers to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder every executor can reach, under the cluster's ``spark.checkpoint.dir``.

    Only a local-mode session without that setting may fall back to the machine's temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = os.path.join(tempfile.gettempdir(), "resalelake")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
