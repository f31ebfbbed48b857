"""Daily rollups, value counts and global diagnostics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

METRICS_FILLED = ("avg_engagement", "total_engagement", "std_engagement", "total_likes", "total_comments")


def dated(df: DataFrame) -> DataFrame:
    """Rows with a day: group-bys on the date leave undated rows out."""
    return df.filter(F.col("date").isNotNull())


def daily_sales(sales: DataFrame) -> DataFrame:
    """One row per day; plain sums are combined before the shuffle, hot days included.

    Distinct customers are counted in two levels on the way to the sums, distinct products from the pairs of day and
    product: no row is multiplied, and a hot day spreads over its customers and products.
    """
    rows = dated(sales)
    per_customer = rows.groupBy("date", "customer_id").agg(
        F.sum("amount").alias("_amount"), F.count("amount").alias("_n"), F.sum("quantity").alias("_units"))
    days = per_customer.groupBy("date").agg(
        F.coalesce(F.sum("_amount"), F.lit(0.0)).alias("total_sales"),
        F.try_divide(F.sum("_amount"), F.sum("_n")).alias("avg_order_value"),
        F.sum("_n").alias("num_transactions"),
        F.count("customer_id").alias("unique_customers"),
        F.coalesce(F.sum("_units"), F.lit(0)).alias("total_units"))
    products = rows.select("date", "product_id").distinct().groupBy("date").agg(
        F.count("product_id").alias("unique_products"))
    return days.join(products, "date").select(
        "date", "total_sales", "avg_order_value", "num_transactions", "unique_customers", "unique_products", "total_units")


def daily_social(social: DataFrame) -> DataFrame:
    """One row per day; the set of platform names is the only collected value."""
    names = F.array_join(F.array_sort(F.collect_set("platform")), ",")
    counts = [F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}")
              for c in ("likes", "comments") if c in social.columns]
    return dated(social).groupBy("date").agg(
        F.avg("engagement_rate").alias("avg_engagement"),
        F.coalesce(F.sum("engagement_rate"), F.lit(0.0)).alias("total_engagement"),
        F.coalesce(F.stddev_samp("engagement_rate"), F.lit(0.0)).alias("std_engagement"),
        *counts,
        names.alias("platforms"),
    )


def join_daily(sales_daily: DataFrame, social_daily: DataFrame) -> DataFrame:
    """Every sales day with its engagement, zeros where no post exists; ``platforms`` stays null."""
    merged = sales_daily.join(social_daily, "date", "left")
    filled = merged.fillna(0, subset=[c for c in METRICS_FILLED if c in merged.columns])
    filled = filled.fillna(0, subset=["total_sales", "num_transactions"])
    return with_interactions(filled)


def with_interactions(daily: DataFrame) -> DataFrame:
    if not {"total_likes", "total_comments"} <= set(daily.columns):
        return daily
    return daily.withColumn("total_interactions", F.col("total_likes") + F.col("total_comments"))


def daily_aggregates(sales: DataFrame, social: DataFrame | None) -> DataFrame:
    """Sales days with engagement, or sales days alone without any social table."""
    base = daily_sales(sales)
    return base if social is None else join_daily(base, daily_social(social))


def day_totals(sales: DataFrame) -> DataFrame:
    return dated(sales).groupBy("date").agg(F.sum("quantity").alias("quantity"), F.sum("amount").alias("amount"))


def product_day(sales: DataFrame, product_col: str) -> DataFrame:
    return (dated(sales).filter(F.col(product_col).isNotNull())
            .groupBy("date", F.col(product_col).alias("product"))
            .agg(F.coalesce(F.sum("amount"), F.lit(0.0)).alias("product_sales"),
                 F.coalesce(F.sum("quantity"), F.lit(0)).alias("product_quantity")))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their share in percent, null values left out."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    # the total repeats the plan of the counts, so their shuffle is run once and reused
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share_pct", F.col("n") * 100.0 / total)


def most_frequent(df: DataFrame, column: str, top: int = 1) -> DataFrame:
    return value_counts(df, column).orderBy(F.col("n").desc(), F.col(column)).limit(top)


def series_diagnostics(daily: DataFrame) -> DataFrame:
    """Days, active days and spread of both series."""
    out = [F.count(F.lit(1)).alias("days")]
    for name in ("total_sales", "avg_engagement"):
        out += [
            F.count(F.when(F.col(name) > 0, 1)).alias(f"days_{name}"),
            F.min(name).alias(f"min_{name}"),
            F.max(name).alias(f"max_{name}"),
            F.stddev_samp(name).alias(f"std_{name}"),
        ]
    return daily.agg(*out)


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.countDistinct(c).alias(f"distinct_{c}") for c in columns])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def date_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def ingest_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, date range and engagement spread per table."""
    rows = []
    for name, df in tables.items():
        has_date, has_rate = "date" in df.columns, "engagement_rate" in df.columns
        rows.append(df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            (F.min("date") if has_date else F.lit(None).cast("date")).alias("min_date"),
            (F.max("date") if has_date else F.lit(None).cast("date")).alias("max_date"),
            (F.stddev_samp("engagement_rate") if has_rate else F.lit(None).cast("double")).alias("std_engagement"),
        ).select(F.lit(name).alias("source"), "*"))
    return reduce(DataFrame.unionByName, rows)


def top_days(daily: DataFrame, n: int = 5) -> DataFrame:
    return (daily.select("date", "avg_engagement", "total_sales")
            .orderBy(F.col("avg_engagement").desc(), F.col("date")).limit(n))


def sorted_by_date(df: DataFrame, tiebreak: list[str] | None = None) -> DataFrame:
    return df.orderBy(F.col("date").asc_nulls_last(), *(tiebreak or []))


def date_spine(df: DataFrame) -> DataFrame:
    """Every day between the first and the last date."""
    ends = df.agg(F.min("date").alias("a"), F.max("date").alias("b")).filter(F.col("a").isNotNull())
    return ends.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("date"))


def date_gaps(daily: DataFrame) -> DataFrame:
    """Days since the previous date. Distinct dates only, so the window holds calendar days."""
    days = daily.select("date").filter(F.col("date").isNotNull()).distinct()
    return days.withColumn("gap_days", F.datediff("date", F.lag("date").over(Window.orderBy("date"))))
