"""Session settings the operators rely on."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


def pin_utc(spark: SparkSession) -> SparkSession:
    """Ledger timestamps are UTC; every parse and month boundary depends on it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("crosstally")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's `spark.checkpoint.dir`.

    A local-mode session without that setting uses a folder below its warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/crosstally_runs"


def concurrently(calls: Sequence[Callable[[], T]], at_once: int = 8) -> list[T]:
    """Results of independent calls that each start Spark jobs; the scheduler shares the cores."""
    if len(calls) < 2:
        return [call() for call in calls]
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(min(at_once, len(calls))) as pool:
        futures = [pool.submit(inherit(call)) for call in calls]
        return [f.result() for f in futures]
