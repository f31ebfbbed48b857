"""Sinks: processed tables, results, reports, run history."""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F

from tallyrill import schemas
from tallyrill.sources import scan


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = (),
                compression: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "json":
        writer.json(path)
    else:
        writer.parquet(path)


def write_back(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Run the plan once and return a scan of its output."""
    write_table(df, path, fmt)
    return df.sparkSession.read.schema(df.schema).format(fmt).option("header", True).load(path)


def write_counted(df: DataFrame, path: str, fmt: str = "parquet") -> tuple[DataFrame | None, int]:
    """``write_back`` and the number of rows, observed while they are written; None and no output without rows."""
    seen = Observation()
    stored = write_back(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, fmt)
    if seen.get["rows"]:
        return stored, seen.get["rows"]
    scan.remove_path(df.sparkSession, path)
    return None, 0


def write_unless_empty(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame | None:
    """``write_back``, or None and no output for a table without rows."""
    return write_counted(df, path, fmt)[0]


MONTHS = ("year", "month")


def write_months(df: DataFrame, path: str, by: tuple[str, ...] = MONTHS) -> None:
    """A table laid out by month; months in ``df`` replace those on disk, all others stay as they are.

    Rows are gathered by month, and a month too large for one task is split over several files.
    """
    gathered = df.hint("rebalance", *by)
    gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def read_months(spark: SparkSession, path: str, **months: int) -> DataFrame:
    """The table, or only the files of one year or month: ``read_months(spark, path, year=2024, month=2)``."""
    df = spark.read.parquet(path)
    for name, value in months.items():
        df = df.filter(F.col(name) == value)
    return df


def write_processed(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Every non-empty table to ``{folder}/{name}_processed``; the stored tables by name."""
    stored = {name: write_unless_empty(df, f"{folder}/{name}_processed", fmt)
              for name, df in tables.items() if df is not None}
    return {name: df for name, df in stored.items() if df is not None}


def write_segmentation(rfm: DataFrame, segments: DataFrame, folder: str,
                       fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    return write_back(rfm, f"{folder}/rfm_analysis", fmt), write_back(segments, f"{folder}/customer_segments", fmt)


def write_correlations(results: dict[str, DataFrame | None], folder: str,
                       fmt: str = "parquet") -> dict[str, DataFrame | None]:
    """General (Pearson view and all methods), lag, rolling, by segment, by product, where non-empty."""
    stored: dict[str, DataFrame | None] = {}
    for name in ("general", "lag", "rolling", "by_segment", "by_product"):
        df = results.get(name)
        path = f"{folder}/correlation_{name}{'_methods' if name == 'general' else ''}"
        stored[name] = None if df is None else write_unless_empty(df, path, fmt)
    if stored["general"] is not None:
        write_table(pearson_view(stored["general"]), f"{folder}/correlation_general", fmt)
    return stored


def pearson_view(general: DataFrame) -> DataFrame:
    return general.filter(F.col("method") == "pearson").select("r", "p_value", "significant")


def write_json_records(df: DataFrame, path: str, compression: str | None = None) -> None:
    """One JSON record per row, dates in ISO form."""
    df.write.mode("overwrite").json(path, compression=compression)


def write_validation_report(summary: DataFrame, details: DataFrame, folder: str, run_at: datetime) -> str:
    """One folder per run holding a single nested JSON record."""
    path = f"{folder}/validation_report_{run_at:%Y%m%d_%H%M%S}"
    nested_validation_report(summary, details, run_at).write.mode("overwrite").json(path)
    return path


def nested_validation_report(summary: DataFrame, details: DataFrame, run_at: datetime) -> DataFrame:
    """Rows are (dataset) and (dataset, check): a fixed, small number of entries."""
    per_dataset = details.groupBy("dataset").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("check", "passed")))).alias("checks"))
    joined = summary.join(per_dataset, "dataset", "left")
    return joined.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("dataset", "passed")))).alias("summary"),
        F.map_from_entries(F.filter(
            F.collect_list(F.struct("dataset", "checks")),
            lambda e: e["checks"].isNotNull())).alias("details"),
    ).select(F.lit(run_at.isoformat()).alias("timestamp"), "all_passed", "summary", "details")


def append_run(spark: SparkSession, path: str, status: str, duration_seconds: float | None,
               error: str | None, run_at: datetime) -> None:
    row = [(run_at.isoformat(), status, duration_seconds, error)]
    (spark.createDataFrame(row, schemas.RUN_HISTORY_SCHEMA).coalesce(1)
     .write.mode("append").option("ignoreNullFields", False).json(path))


def append_checks(details: DataFrame, path: str, run_at: datetime) -> None:
    """Append (run, dataset, check, passed): one row per check of a run, next to those of earlier runs."""
    rows = details.select(F.lit(run_at.isoformat()).alias("run"), "dataset", "check", "passed")
    rows.coalesce(1).write.mode("append").parquet(path)


def append_run_record(spark: SparkSession, path: str, record: dict) -> None:
    """Append what a run did: its times, status, stages completed and failed, and errors."""
    row = {k: v.isoformat() if isinstance(v, datetime) else v for k, v in record.items()}
    df = spark.createDataFrame([tuple(row[f.name] for f in schemas.RUN_RECORD_SCHEMA.fields)], schemas.RUN_RECORD_SCHEMA)
    df.coalesce(1).write.mode("append").option("ignoreNullFields", False).json(path)


def retain_runs(spark: SparkSession, path: str, keep: int = 50, grace_seconds: float = 3600) -> None:
    """Shrink a run history on disk to one file with the newest ``keep`` records.

    The new file is complete before any old one goes, and readers drop records they see twice, so a reader finds
    all kept records at any time. Old files go once they are ``grace_seconds`` old: a reader that listed them
    has that long to finish. Files that other runs append meanwhile are not touched.
    """
    fs, folder = scan.located(spark, path)
    before = [f for f in fs.listStatus(folder) if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
    history = scan.read_run_history(spark, path)
    held = history.count()
    rows = read_kept_runs(spark, path, keep).collect()  # at most ``keep`` records
    if held > keep:
        (spark.createDataFrame(rows, schemas.RUN_HISTORY_SCHEMA).coalesce(1)
         .write.mode("append").option("ignoreNullFields", False).json(path))
        latest = time.time() - grace_seconds
        for f in before:
            if f.getModificationTime() / 1000 <= latest:
                fs.delete(f.getPath(), False)


def latest_runs(history: DataFrame, keep: int = 50) -> DataFrame:
    """The newest ``keep`` runs: the retention rule of the history."""
    newest = history.orderBy(F.col("timestamp").desc()).limit(keep)
    return newest.withColumn(
        "run_rank", F.row_number().over(Window.orderBy(F.col("timestamp").desc())).cast("bigint"))


def read_kept_runs(spark: SparkSession, path: str, keep: int = 50) -> DataFrame:
    return latest_runs(scan.read_run_history(spark, path).dropDuplicates(), keep).drop("run_rank")
