"""Run tracking, log analytics and the executive overview."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyrill.functions.scalar import age_text
from tallyrill.operators.correlation import best_lag
from tallyrill.operators.rollups import most_frequent
from tallyrill.sources.scan import SCAN_ORDER

LEVELS = ("ERROR", "WARNING", "INFO")


def level_filter(levels: tuple[str, ...], line: str = "line") -> Column:
    hits = [F.col(line).contains(level) for level in levels]
    return reduce(lambda a, b: a | b, hits, F.lit(False))


def log_tail(log: DataFrame, n: int = 50, levels: tuple[str, ...] = LEVELS,
             order_by: tuple[str, ...] = SCAN_ORDER) -> DataFrame:
    """The last n lines, then only the wanted levels."""
    last = log.orderBy(*[F.col(c).desc() for c in order_by]).limit(n)
    return last.filter(level_filter(levels))


def log_severity(log: DataFrame) -> DataFrame:
    """Lines per level over the whole log."""
    return log.agg(*[F.count(F.when(F.col("line").contains(level), 1)).alias(level.lower()) for level in LEVELS])


def run_time(history: DataFrame) -> Column:
    return F.try_to_timestamp("timestamp")


def run_statistics(history: DataFrame) -> DataFrame:
    ok = F.count(F.when(F.col("status") == "success", 1))
    return history.agg(
        F.count(F.lit(1)).alias("runs"),
        F.avg("duration_seconds").alias("avg_duration"),
        F.min("duration_seconds").alias("min_duration"),
        F.max("duration_seconds").alias("max_duration"),
        F.try_divide(ok * 100.0, F.count(F.lit(1))).alias("success_rate"),
    )


def latest_run(history: DataFrame, now: Column) -> DataFrame:
    """Newest run with its full age in minutes."""
    best = history.agg(F.max_by(F.struct("timestamp", "status", "duration_seconds"), "timestamp").alias("_r"))
    age = F.floor((F.unix_timestamp(now) - F.unix_timestamp(F.try_to_timestamp("timestamp"))) / 60)
    return best.filter(F.col("_r").isNotNull()).select("_r.*").withColumn("age_minutes", age)


def status_class(status: str = "status") -> Column:
    return (F.when(F.col(status) == "success", "ok").when(F.col(status) == "error", "bad")
            .otherwise("neutral"))


def success_trend(history: DataFrame, ascending: bool = False) -> DataFrame:
    """Cumulative success rate in percent, newest run first unless asked otherwise.

    The history is kept at a fixed number of runs, so one window over all of it is small.
    """
    at = F.col("timestamp").asc() if ascending else F.col("timestamp").desc()
    frame = Window.orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    success = (F.col("status") == "success").cast("int")
    return history.withColumns({
        "status_class": status_class(),
        "cumulative_success_rate": F.avg(success).over(frame) * 100.0,
    })


def output_files(inventory: DataFrame, now: Column) -> DataFrame:
    """Size in KB and age of every output file."""
    seconds = F.unix_timestamp(now) - F.unix_timestamp("modified_at")
    return inventory.select("path", (F.col("size_bytes") / 1024.0).alias("size_kb"), "modified_at",
                            age_text(seconds).alias("age"))


def output_sizes(inventory: DataFrame) -> DataFrame:
    """Size and newest change per output table, the folder below the output root."""
    return inventory.groupBy(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("table_name")).agg(
        F.count(F.lit(1)).alias("files"), (F.sum("size_bytes") / 1024.0).alias("size_kb"),
        F.max("modified_at").alias("modified_at"))


def overview(sales: DataFrame, social: DataFrame | None, daily: DataFrame, general: DataFrame | None,
             segments: DataFrame | None, lags: DataFrame | None) -> DataFrame:
    """(section, item, value): the headline figures as one long table."""
    def longer(section: str, one: DataFrame) -> DataFrame:
        items = F.explode(F.array(*[
            F.struct(F.lit(c).alias("item"), F.col(c).cast("string").alias("value")) for c in one.columns]))
        return one.select(items.alias("i")).select(F.lit(section).alias("section"), "i.item", "i.value")

    parts = [longer("sales", sales.agg(*sales_figures(sales.columns)))]
    if social is not None:
        parts.append(longer("social", social.agg(
            F.count(F.lit(1)).alias("posts"),
            F.array_join(F.array_sort(F.collect_set("platform")), ", ").alias("platforms"))))
    parts.append(longer("daily", daily.agg(F.count(F.lit(1)).alias("days"))))
    if general is not None:
        head = general.filter(F.col("method") == "pearson").select(
            F.col("r").cast("decimal(18,6)").alias("r"),
            F.when(F.col("r") > 0, "Positiva").otherwise("Negativa").alias("direction"),
            F.when(F.col("significant"), "Significativa").otherwise("No significativa").alias("significance"))
        parts.append(longer("correlation", head))
    if segments is not None:
        top = most_frequent(segments, "segment_name").select(
            F.col("segment_name").alias("largest_segment"), F.col("n").alias("customers"))
        parts.append(longer("segments", top))
    if lags is not None:
        parts.append(longer("lag", best_lag(lags).select("lag_days", "horizon")))
    return reduce(DataFrame.unionByName, parts)


def sales_figures(columns: list[str]) -> list[Column]:
    out = [F.count(F.lit(1)).alias("transactions")]
    if "amount" in columns:
        out.append(F.sum("amount").cast("decimal(38,2)").alias("revenue"))
    if "customer_id" in columns:
        out.append(F.countDistinct("customer_id").alias("customers"))
    if "product_name" in columns:
        out.append(F.countDistinct("product_name").alias("products"))
    return out
