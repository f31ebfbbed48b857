"""The five-stage batch job: ingest, transform, validate, segment, correlate.

Each stage builds lazy tables and writes them once; later stages read the written tables, so no
stage recomputes an earlier one and a lost executor costs only its own tasks.
"""

from __future__ import annotations

import traceback
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyrill import schemas, scratch
from tallyrill.operators import cleaning, correlation, quality, reporting, rollups, segmentation
from tallyrill.sources import scan, sinks

STAGES = ("ingestion", "transformation", "validation", "segmentation", "correlation")


@dataclass
class RunRecord:
    start_time: datetime
    end_time: datetime | None = None
    duration_seconds: float | None = None
    status: str = "running"
    stages_completed: list[str] = field(default_factory=list)
    stages_failed: list[str] = field(default_factory=list)
    errors: list[str] = field(default_factory=list)

    def as_row(self) -> dict:
        return asdict(self)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def merged_config(given: dict | None) -> dict:
    """Defaults with the given settings on top, section by section."""
    def merge(base: dict, over: dict) -> dict:
        out = dict(base)
        for k, v in over.items():
            out[k] = merge(base[k], v) if isinstance(v, dict) and isinstance(base.get(k), dict) else v
        return out

    return merge(schemas.DEFAULT_CONFIG, given or {})


def transform_all(tables: dict[str, DataFrame], order_by: list[str],
                  store: Callable[[str, DataFrame], DataFrame | None] = lambda name, df: df) -> dict[str, DataFrame]:
    """Cleaned sources, merged posts and the daily table; absent sources stay absent.

    ``store`` may write a table and return its stored form (None for an empty one), from which
    the tables built on it are derived.
    """
    out: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame | None) -> None:
        kept = None if df is None else store(name, df)
        if kept is not None:
            out[name] = kept

    if tables.get("sales") is not None:
        keep("sales", cleaning.clean_sales(tables["sales"], order_by))
    for platform in schemas.PLATFORMS:
        posts = tables.get(platform)
        if posts is not None:
            known = [c for c in order_by if c in posts.columns]
            keep(platform, cleaning.clean_social(posts, platform, known or None))
    keep("social_media_merged", cleaning.merge_social([out.get(p) for p in schemas.PLATFORMS]))
    if "sales" in out:
        keep("daily_aggregates", rollups.daily_aggregates(out["sales"], out.get("social_media_merged")))
    return out


def run_job(spark: SparkSession, config: dict | None = None, tables: dict[str, DataFrame] | None = None,
            order_by: list[str] | None = None, fmt: str = "parquet") -> dict | None:
    """Run all stages; a failure is recorded in the run history and gives None.

    ``tables`` replaces the configured sources, with ``order_by`` naming their input order.
    """
    conf = merged_config(config)
    folder = conf["output"]["clean_data_path"].rstrip("/")
    history = conf["output"].get("history_path", f"{folder}/execution_history")
    skipped = set(conf["pipeline"]["skip_stages"])
    if not skipped <= set(STAGES[2:]):
        raise ValueError(f"only {STAGES[2:]} can be skipped")
    record = RunRecord(start_time=_now())
    results: dict = {"stats": record}
    stage = STAGES[0]
    try:
        # every result of the run reads from the output folder
        with scratch.scope(spark), scratch.shuffles_removed(spark):
            if tables is None:
                results["absent_sources"] = scan.absent_sources(spark, conf)
                raw = scan.read_all_sources(spark, conf, keep_order=True)
                order_by = list(scan.SCAN_ORDER)
            else:
                raw = tables
            record.stages_completed.append(stage)

            stage = STAGES[1]
            rows: dict[str, int] = {}

            def stored(name: str, df: DataFrame) -> DataFrame | None:
                kept, n = sinks.write_counted(df, f"{folder}/{name}_processed", fmt)
                rows.update({name: n} if kept is not None else {})
                return kept

            with scratch.scope(spark):
                data = transform_all(raw, order_by or [], stored)
            results["data"], results["rows"] = data, rows
            results["missing_outputs"] = quality.missing_outputs(set(data))
            record.stages_completed.append(stage)

            stage = STAGES[2]
            if conf["pipeline"]["enable_validation"] and stage not in skipped:
                details = sinks.write_back(quality.validate_tables(data), f"{folder}/validation_checks", fmt)
                verdicts = quality.dataset_verdicts(details, [n for n in quality.SUITES if n in data])
                results["validation"] = {"details": details, "verdicts": verdicts}
                results["report_path"] = sinks.write_validation_report(
                    verdicts, details, f"{folder}/validation", record.start_time)
                sinks.append_checks(details, f"{folder}/validation_history", record.start_time)
                record.stages_completed.append(stage)

            stage = STAGES[3]
            if stage not in skipped:
                if "sales" not in data:
                    raise ValueError("no sales to segment")
                with scratch.scope(spark):
                    seg = segmentation.segment_customers(
                        data["sales"], store=lambda rfm, segments: sinks.write_segmentation(rfm, segments, folder, fmt))
                    seg["pca"] = sinks.write_back(seg["pca"], f"{folder}/segments_pca", fmt)
                seg["report"] = segmentation.with_strategies(segmentation.segment_report(seg["segments"]))
                results["segmentation"] = seg
                record.stages_completed.append(stage)

            stage = STAGES[4]
            if stage not in skipped:
                missing = [n for n in ("sales", "daily_aggregates") if n not in data]
                if missing:
                    raise ValueError(f"missing tables: {missing}")
                segments = results.get("segmentation", {}).get("segments")
                found = correlation.analyze(data["daily_aggregates"], segments, data["sales"])
                results["correlation"] = sinks.write_correlations(found, folder, fmt)
                record.stages_completed.append(stage)
            record.status = "completed"
    except Exception as problem:  # the job reports every failure the same way
        record.status = "failed"
        record.stages_failed.append(stage)
        record.errors.append(f"{problem}\n{traceback.format_exc()}")
    record.end_time = _now()
    record.duration_seconds = (record.end_time - record.start_time).total_seconds()
    ok = record.status == "completed"
    sinks.append_run(spark, history, "success" if ok else "error", record.duration_seconds,
                     None if ok else record.errors[0], record.end_time)
    sinks.retain_runs(spark, history)
    sinks.append_run_record(spark, f"{folder}/run_records", record.as_row())
    if not ok:
        return None
    results["completeness"] = quality.output_completeness(spark, _outputs(results))
    return results


def _outputs(results: dict) -> set[str]:
    names = set(results.get("data", {}))
    if "segmentation" in results:
        names.add("customer_segments")
    if results.get("correlation", {}).get("general") is not None:
        names.add("correlation_general")
    return names


def stage_summary(results: dict) -> DataFrame:
    """(stage, metric, value): rows per table, checks, segments, best lag, analysed items."""
    parts = []

    def add(stage: str, metric, df: DataFrame, value) -> None:
        name = metric if not isinstance(metric, str) else F.lit(metric)
        parts.append(df.select(F.lit(stage).alias("stage"), name.alias("metric"),
                               value.cast("double").alias("value")))

    if results.get("rows"):  # observed while the tables were written
        rows = results["data"][next(iter(results["data"]))].sparkSession.createDataFrame(
            [(f"rows_{name}", n) for name, n in results["rows"].items()], "metric string, n bigint")
        add("transformation", F.col("metric"), rows, F.col("n"))
    if "validation" in results:
        one = quality.overall(results["validation"]["verdicts"])
        add("validation", "datasets_passed", one, F.col("passed"))
        add("validation", "success_rate", one, F.col("success_rate"))
    if "segmentation" in results:
        counts = rollups.value_counts(results["segmentation"]["segments"], "segment_name")
        add("segmentation", F.concat(F.lit("customers_"), F.col("segment_name")), counts, F.col("n"))
    found = results.get("correlation", {})
    if found.get("general") is not None:
        add("correlation", F.concat(F.col("method"), F.lit("_r")), found["general"], F.col("r"))
    if found.get("lag") is not None:
        add("correlation", "best_lag", correlation.best_lag(found["lag"]), F.col("lag_days"))
    for name in ("by_segment", "by_product"):
        if found.get(name) is not None:
            add("correlation", f"analysed_{name}", found[name].agg(F.count(F.lit(1)).alias("n")), F.col("n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def job_overview(results: dict) -> DataFrame:
    data, found = results["data"], results["correlation"]
    return reporting.overview(data["sales"], data.get("social_media_merged"), data["daily_aggregates"],
                              found.get("general"), results["segmentation"]["segments"], found.get("lag"))
