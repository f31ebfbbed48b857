"""Demand index per day and its nearest-date lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyrill.functions.scalar import clip, scale_between
from tallyrill.operators.rollups import date_spine, day_totals

DEFAULT_INDEX = 0.5
MOMENTUM = 1.15


def momentum_days(totals: DataFrame) -> DataFrame:
    """Previous day's quantity and whether it exceeds the upper quartile.

    ``totals`` has one row per day, so the unpartitioned windows hold calendar days.
    """
    every = Window.partitionBy()
    return totals.withColumns({
        "previous_quantity": F.lag("quantity").over(Window.orderBy("date")),
        "p75": F.percentile("quantity", F.lit(0.75)).over(every),
        "low": F.min("quantity").over(every),
        "high": F.max("quantity").over(every),
    }).withColumn("boost", F.coalesce(F.col("previous_quantity") > F.col("p75"), F.lit(False)))


def demand_index(sales: DataFrame) -> DataFrame:
    """(date, demand_index) within [0.2, 1.0]."""
    days = momentum_days(day_totals(sales))
    base = scale_between(F.col("quantity"), F.col("low"), F.col("high"), 0.2, 0.85, DEFAULT_INDEX)
    value = base * F.when(F.col("boost"), F.lit(MOMENTUM)).otherwise(F.lit(1.0))
    return days.select("date", clip(value, 0.2, 1.0).alias("demand_index"))


def index_statistics(index: DataFrame) -> DataFrame:
    out = index.agg(
        F.count(F.lit(1)).alias("days"),
        F.min("demand_index").alias("min_index"),
        F.max("demand_index").alias("max_index"),
        F.avg("demand_index").alias("avg_index"),
        F.stddev_pop("demand_index").alias("std_index"),
    )
    return out.withColumn("low_variation", F.col("std_index") < 0.10)


def nearest_by_date(wanted: DataFrame, index: DataFrame, value: str, keys: list[str] | None = None,
                    default: float = DEFAULT_INDEX) -> DataFrame:
    """Value of the same date, else of the closest one (earlier on ties), else ``default``.

    Both sides hold one row per key and date; they are stacked and filled from either side, which
    costs one sort per key and no pairs.
    """
    keys = keys or []
    marks = [*keys, "date"]
    both = (wanted.select(*marks, F.lit(True).alias("_asked"), F.lit(None).cast("double").alias("_v"))
            .unionByName(index.select(*marks, F.lit(False).alias("_asked"), F.col(value).cast("double").alias("_v"))))
    at = F.when(F.col("_v").isNotNull(), F.struct("date", "_v"))
    # two growing frames, one per direction: linear work, unlike an unbounded following frame
    past = Window.partitionBy(*keys).orderBy("date").rangeBetween(Window.unboundedPreceding, 0)
    future = Window.partitionBy(*keys).orderBy(F.col("date").desc()).rangeBetween(Window.unboundedPreceding, 0)
    back = F.last(at, ignorenulls=True).over(past)
    ahead = F.last(at, ignorenulls=True).over(future)
    filled = both.withColumns({"_b": back, "_a": ahead}).filter("_asked")
    to_back = F.datediff(F.col("date"), F.col("_b.date"))
    to_ahead = F.datediff(F.col("_a.date"), F.col("date"))
    picked = (F.when(F.col("_b").isNull(), F.col("_a._v")).when(F.col("_a").isNull(), F.col("_b._v"))
              .when(to_back <= to_ahead, F.col("_b._v")).otherwise(F.col("_a._v")))
    return filled.select(*marks, F.coalesce(picked, F.lit(default)).alias(value))


def index_on_spine(sales: DataFrame) -> DataFrame:
    """Demand index for every calendar day of the sales period."""
    return nearest_by_date(date_spine(sales), demand_index(sales), "demand_index")
