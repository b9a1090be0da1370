"""Session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


#: The JVM never compiles a method of more than 8,000 bytes, and a stage of wide rows is generated as one such method: it would be
#: interpreted to the end. With this limit Spark generates wide steps one by one, in methods that are compiled.
WIDE_PLANS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def build_session(app: str = "quietband", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and AQE; `conf` overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # Recording a call site per column expression doubles the time to build wide plans.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **WIDE_PLANS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the folder the cluster names in ``spark.checkpoint.dir``.

    Executors must share it, so a local temporary folder is used only when the session
    names none and the master is local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{base.rstrip('/')}/quietband-{label}-{uuid.uuid4().hex}"


def run_together(jobs: Iterable[Callable[[], None]]) -> None:
    """Submit independent Spark actions at once, so small ones share the cluster."""
    with ThreadPoolExecutor(max_workers=8) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()
