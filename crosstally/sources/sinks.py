"""Layer tables, report files and the gate between checks and publication."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from crosstally.session import concurrently, shared_folder

MANIFEST = "published"
_MANIFEST_COLUMNS = "run string, reports array<string>"


class PublicationBlocked(RuntimeError):
    """At least one check found violations; nothing was written."""

    def __init__(self, failed: Mapping[str, int]):
        self.failed = dict(failed)
        listing = "\n- ".join(f"{name}: {count} violations" for name, count in failed.items())
        super().__init__("Checks failed:\n- " + listing)


@dataclass(frozen=True)
class Report:
    """A report: rows, the projection to publish and the order of its rows."""

    rows: DataFrame
    columns: Sequence[Column]
    order: Sequence[str]

    def projected(self) -> DataFrame:
        return self.rows.select(*self.columns)

    def sorted(self) -> DataFrame:
        return self.projected().orderBy(*(F.col(c).asc_nulls_last() for c in self.order))


def materialise(df: DataFrame, layer: str, name: str, root: str | None = None) -> DataFrame:
    """Write a layer table to the shared folder and read it back.

    Later readers scan the written columns they need instead of recomputing the
    lineage, and a lost executor costs a re-read only.
    """
    spark = df.sparkSession
    path = f"{root or shared_folder(spark)}/{layer}/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_counted(
    df: DataFrame, layer: str, name: str, counts: Mapping[str, Column], root: str | None = None
) -> tuple[DataFrame, dict[str, int] | None]:
    """The same, with aggregates over the rows that are taken while they are written.

    Checks of a layer thus need no scan of their own. The write is the last step of its job,
    so rows of tasks that ran twice count once. None stands for the counts if Spark reports
    none, as it may for a table that it knows to be empty; count the written table then.
    """
    slots = {f"c{i}": check for i, check in enumerate(counts)}
    seen = Observation(f"{layer}_{name}_{uuid.uuid4().hex}")
    observed = df.observe(seen, *(count.alias(slot) for slot, count in zip(slots, counts.values())))
    table = materialise(observed, layer, name, root)
    found = seen.get
    return table, {check: found[slot] for slot, check in slots.items()} if found.keys() == slots.keys() else None


def save_table(
    df: DataFrame,
    layer: str,
    name: str,
    *,
    bucket_by: Sequence[str] = (),
    buckets: int | None = None,
    month_of: str | None = None,
) -> DataFrame:
    """The same as a catalog table `layer.name`.

    `bucket_by` names the columns that later joins compare: tables bucketed alike are joined
    without a shuffle. `month_of` is a time column; the table is partitioned by its month in
    the column `month`, so that a run of one month reads that month's files only.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    if month_of is not None:
        df = df.withColumn("month", F.date_format(month_of, "yyyy-MM"))
    if bucket_by:
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(buckets, *bucket_by)  # a file for each bucket and month
    writer = df.write.mode("overwrite")
    if month_of is not None:
        writer = writer.partitionBy("month")
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(f"`{layer}`.`{name}`")
    return spark.table(f"`{layer}`.`{name}`")


def write_report(report: Report, path: str) -> None:
    """Totally ordered CSV with a header; part files are in row order."""
    report.sorted().write.mode("overwrite").option("header", True).csv(path)


def check_results(checks: Sequence[DataFrame]) -> dict[str, int]:
    """Violations by check. Frames (check, violations) run side by side; one row per check returns."""
    rows = [row for result in concurrently([c.collect for c in checks]) for row in result]
    return {row["check"]: row["violations"] for row in sorted(rows)}


def failed_checks(checks: Sequence[DataFrame]) -> dict[str, int]:
    """Checks that did not pass."""
    return {check: count for check, count in check_results(checks).items() if count != 0}


def publish(reports: Mapping[str, Report], checks: Sequence[DataFrame], folder: str) -> str:
    """Publish all reports if every check passes, else raise and publish none.

    Reports are written to a folder of their own; one line in the manifest makes all of
    them visible at once. A run that fails on the way leaves the reports published before.
    Returns the name of the run.
    """
    failed = failed_checks(checks)
    if failed:
        raise PublicationBlocked(failed)
    run = f"run-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    concurrently([partial(write_report, report, f"{folder}/{run}/{name}") for name, report in reports.items()])
    spark = next(iter(reports.values())).rows.sparkSession
    listed = spark.createDataFrame([(run, sorted(reports))], _MANIFEST_COLUMNS)
    listed.coalesce(1).write.mode("append").json(f"{folder}/{MANIFEST}")
    return run


def published_runs(spark: SparkSession, folder: str) -> DataFrame:
    """(run, reports) of all publications; the name that sorts last is the newest."""
    return spark.read.schema(_MANIFEST_COLUMNS).json(f"{folder}/{MANIFEST}")


def read_published(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A report of the newest publication."""
    newest = published_runs(spark, folder).agg(F.max("run")).first()[0]
    return read_report(spark, f"{folder}/{newest}/{name}")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path)
