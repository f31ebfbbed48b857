"""How engagement relates to sales: general, lagged, rolling, per product, per segment.

Daily tables hold one row per day (and per series key where given), so windows over a whole
series hold calendar days. Facts are reduced to that grain before anything else.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from tallyrill.functions.scalar import (
    direction_label, horizon_label, influence_label, segment_band, segment_weight,
    sign_band, strength_label)
from tallyrill.functions.stats import pearson, pearson_p, significant
from tallyrill.operators.association import association_tests
from tallyrill.operators.ordered import along_windows
from tallyrill.operators.rollups import dated, product_day

MIN_SAMPLES = 10
MAX_LAG = 14
WINDOWS = (7, 14, 30)
BEST_PERIOD_R = 0.5


def active_days(daily: DataFrame) -> DataFrame:
    """Days with sales or engagement, remaining nulls as zero."""
    kept = daily.filter((F.col("total_sales") > 0) | (F.col("avg_engagement") > 0))
    return kept.fillna(0)


def joint_days(daily: DataFrame) -> DataFrame:
    """Days with both sales and engagement."""
    return daily.filter((F.col("total_sales") > 0) & (F.col("avg_engagement") > 0))


def general_correlation(daily: DataFrame, keys: list[str] | None = None) -> DataFrame | None:
    if "avg_engagement" not in daily.columns:
        return None
    kept = active_days(daily.select(*(keys or []), "date", "total_sales", "avg_engagement"))
    return association_tests(kept, "total_sales", "avg_engagement", keys)


def interpretation(results: DataFrame, r: str = "r") -> DataFrame:
    return results.withColumns({
        "strength": strength_label(r), "direction": direction_label(r), "influence": influence_label(r)})


def lagged_rows(daily: DataFrame, max_lag: int = MAX_LAG, keys: list[str] | None = None) -> DataFrame:
    """Sales next to engagement of 0..max_lag rows earlier along the date, one row per lag.

    All shifts come from one sort; rows without an earlier partner are left out.
    """
    keys = keys or []
    along = Window.partitionBy(*keys).orderBy("date")
    lags = range(max_lag + 1)
    shifted = daily.select(*keys, "total_sales", *[
        F.lag("avg_engagement", k).over(along).alias(f"_y{k}") for k in lags])
    long = shifted.select(*keys, "total_sales", F.explode(F.array(*[
        F.struct(F.lit(k).cast("bigint").alias("lag_days"), F.col(f"_y{k}").alias("engagement"))
        for k in lags])).alias("_l"))
    return long.select(*keys, "_l.lag_days", "total_sales", "_l.engagement").dropna(
        subset=["total_sales", "engagement"])


def lag_correlation(daily: DataFrame, max_lag: int = MAX_LAG, keys: list[str] | None = None) -> DataFrame | None:
    """Correlation per lag, for lags with enough pairs."""
    if "avg_engagement" not in daily.columns:
        return None
    keys = keys or []
    out = lagged_rows(daily, max_lag, keys).groupBy(*keys, "lag_days").agg(
        pearson("total_sales", "engagement").alias("correlation"), F.count(F.lit(1)).alias("n_samples"))
    out = out.filter(F.col("n_samples") >= MIN_SAMPLES).withColumn("p_value", pearson_p("correlation", "n_samples"))
    return out.select(*keys, "lag_days", "correlation", "p_value",
                      significant("p_value").alias("significant"), "n_samples")


def best_lag(lags: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Largest absolute r, the shorter lag on ties, and its horizon."""
    keys = keys or []
    valid = lags.filter(F.col("correlation").isNotNull())
    picked = valid.groupBy(*keys).agg(F.max_by(
        F.struct("lag_days", "correlation", "p_value", "n_samples"),
        F.struct(F.abs("correlation"), -F.col("lag_days"))).alias("_b"))
    return (picked.filter(F.col("_b").isNotNull()).select(*keys, "_b.*")
            .withColumn("horizon", horizon_label("lag_days")))


def lag_bars(lags: DataFrame) -> DataFrame:
    return lags.withColumn("band", sign_band("correlation"))


def rolling_series(daily: DataFrame, windows: tuple[int, ...] = WINDOWS, keys: list[str] | None = None) -> DataFrame:
    """(window_days, date, r) for every full frame of rows in which both sides vary."""
    keys = keys or []
    along = Window.partitionBy(*keys).orderBy("date")
    wide = daily.select(*keys, "date", F.row_number().over(along).alias("_row"), *[
        pearson("total_sales", "avg_engagement", over=along.rowsBetween(-(w - 1), 0)).alias(f"_r{w}")
        for w in windows])
    long = wide.select(*keys, "date", F.explode(F.array(*[
        F.struct(F.lit(w).cast("bigint").alias("window_days"),
                 F.when(F.col("_row") >= w, F.col(f"_r{w}")).alias("r"))
        for w in windows])).alias("_f"))
    return long.select(*keys, "_f.window_days", "date", "_f.r").filter(F.col("r").isNotNull())


def rolling_correlation(daily: DataFrame, windows: tuple[int, ...] = WINDOWS,
                        keys: list[str] | None = None) -> DataFrame | None:
    if "avg_engagement" not in daily.columns:
        return None
    keys = keys or []
    return rolling_summary(rolling_series(daily, windows, keys), keys)


def rolling_over_rows(rows: DataFrame, order_by: list[str], x: str, y: str, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """(window_days, position, r) for every full frame of one series as long as the facts.

    As ``rolling_series`` without a key, but no task sorts the whole series: frames reach over the edges of its stretches.
    """
    wide = along_windows(rows.select(*order_by, F.col(x).alias("_x"), F.col(y).alias("_y")), order_by, {
        f"_r{w}": lambda along, w=w: pearson("_x", "_y", over=along.rowsBetween(-(w - 1), 0)) for w in windows},
        behind=max(windows) - 1)
    long = wide.select("position", F.explode(F.array(*[
        F.struct(F.lit(w).cast("bigint").alias("window_days"), F.when(F.col("position") >= w - 1, F.col(f"_r{w}")).alias("r"))
        for w in windows])).alias("_f"))
    return long.select("_f.window_days", "position", "_f.r").filter(F.col("r").isNotNull())


def rolling_summary(series: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return series.groupBy(*(keys or []), "window_days").agg(
        F.avg("r").alias("avg_correlation"),
        F.max("r").alias("max_correlation"),
        F.min("r").alias("min_correlation"),
        F.stddev_pop("r").alias("std_correlation"),
        F.count(F.lit(1)).alias("n_windows"),
    )


def best_periods(series: DataFrame, keys: list[str] | None = None, above: float = BEST_PERIOD_R) -> DataFrame:
    """End date of the strongest frame per window size, the earlier one on ties."""
    keys = keys or []
    back = F.datediff(F.lit("1970-01-01").cast("date"), F.col("date"))
    best = series.groupBy(*keys, "window_days").agg(
        F.max_by(F.struct(F.col("date").alias("best_date"), "r"), F.struct("r", back)).alias("_b"))
    return best.select(*keys, "window_days", "_b.*").filter(F.col("r") > above)


def product_column(columns: list[str]) -> str | None:
    return next((c for c in ("product_name", "product") if c in columns), None)


def attach_engagement(days: DataFrame, daily: DataFrame) -> DataFrame:
    """Engagement of the day, zero where unknown; one row per date on the right."""
    return days.join(daily.select("date", "avg_engagement"), "date", "left").fillna(0, subset=["avg_engagement"])


def correlation_by_product(sales: DataFrame, daily: DataFrame) -> DataFrame | None:
    """Days without a sale of the product are absent, not zero."""
    name = product_column(sales.columns)
    if name is None or "avg_engagement" not in daily.columns:
        return None
    days = attach_engagement(product_day(sales, name), daily)
    out = days.groupBy("product").agg(
        pearson("product_sales", "avg_engagement").alias("correlation"),
        F.sum("product_sales").alias("total_sales"),
        F.count(F.lit(1)).alias("n_samples"))
    out = out.filter((F.col("n_samples") >= MIN_SAMPLES) & F.col("correlation").isNotNull())
    out = out.withColumn("p_value", pearson_p("correlation", "n_samples"))
    return out.select("product", "correlation", "p_value", significant("p_value").alias("significant"),
                      "total_sales", "n_samples")


def segment_day(sales: DataFrame, segments: DataFrame) -> DataFrame:
    """Sales per segment and day.

    Sales shrink to one row per customer and day before they meet the segments, so a customer
    holding a large share of all rows brings at most one row per day into the join.
    """
    per_customer = (dated(sales).groupBy("customer_id", "date")
                    .agg(F.sum("amount").alias("_amount"), F.count("transaction_id").alias("_n")))
    named = per_customer.join(segments.select("customer_id", "segment_name"), "customer_id", "left")
    return (named.filter(F.col("segment_name").isNotNull()).groupBy("date", "segment_name")
            .agg(F.coalesce(F.sum("_amount"), F.lit(0.0)).alias("segment_sales"),
                 F.sum("_n").alias("segment_transactions")))


def correlation_by_segment(sales: DataFrame, daily: DataFrame, segments: DataFrame) -> DataFrame:
    """Sales per segment against weighted engagement."""
    days = attach_engagement(segment_day(sales, segments), daily)
    weighted = F.col("avg_engagement") * segment_weight("segment_name")
    out = days.withColumn("_e", weighted).groupBy(F.col("segment_name").alias("segment")).agg(
        pearson("segment_sales", "_e").alias("correlation"),
        F.count(F.lit(1)).alias("n_samples"),
        F.avg("segment_sales").alias("avg_sales"))
    out = out.filter((F.col("n_samples") >= MIN_SAMPLES) & F.col("correlation").isNotNull())
    out = out.withColumn("p_value", pearson_p("correlation", "n_samples"))
    return out.select("segment", "correlation", "p_value", significant("p_value").alias("significant"),
                      "n_samples", "avg_sales", segment_weight("segment").alias("engagement_weight"))


def segment_bars(by_segment: DataFrame) -> DataFrame:
    return by_segment.withColumn("band", segment_band("correlation"))


def strongest_first(results: DataFrame, label: str, n: int | None = None) -> DataFrame:
    ordered = results.orderBy(F.col("correlation").desc(), F.col(label))
    return ordered if n is None else ordered.limit(n)


def trend(daily: DataFrame) -> DataFrame:
    """Least-squares line and fit of sales on engagement over days with both."""
    y, x = F.col("total_sales"), F.col("avg_engagement")
    r = pearson(x, y)
    slope = F.try_divide(F.covar_pop(x, y), F.var_pop(x))
    out = joint_days(daily).agg(
        F.count(F.lit(1)).alias("n_points"), slope.alias("slope"),
        F.avg(y).alias("_my"), F.avg(x).alias("_mx"), r.alias("_r"))
    return out.filter(F.col("n_points") >= 2).select(
        "n_points", "slope", (F.col("_my") - F.col("slope") * F.col("_mx")).alias("intercept"),
        (F.col("_r") * F.col("_r")).alias("r_squared"))


def scatter_points(daily: DataFrame) -> DataFrame:
    """Points of the scatter with their fitted value."""
    fit = trend(daily)
    line = fit.select("slope").scalar() * F.col("avg_engagement") + fit.select("intercept").scalar()
    return joint_days(daily).select("date", "avg_engagement", "total_sales", line.alias("fitted"))


def analyze(daily: DataFrame, segments: DataFrame | None, sales: DataFrame) -> dict[str, DataFrame | None]:
    """All analyses as lazy tables, in their reporting order."""
    def ordered(df: DataFrame | None, *by) -> DataFrame | None:
        return None if df is None else df.orderBy(*by)

    by_segment = None
    if segments is not None and "avg_engagement" in daily.columns:
        by_segment = correlation_by_segment(sales, daily, segments)
    return {
        "general": general_correlation(daily),
        "lag": ordered(lag_correlation(daily), "lag_days"),
        "rolling": ordered(rolling_correlation(daily), "window_days"),
        "by_segment": ordered(by_segment, F.col("correlation").desc(), "segment"),
        "by_product": ordered(correlation_by_product(sales, daily), F.col("correlation").desc(), "product"),
    }


def report(results: dict[str, DataFrame | None]) -> DataFrame:
    """(section, item, value): general, rolling means, best lag, top products, segments."""
    parts = []
    if results.get("general") is not None:
        parts.append(results["general"].select(F.lit("general").alias("section"), F.col("method").alias("item"),
                                               F.col("r").alias("value")))
    if results.get("rolling") is not None:
        for stat in ("avg", "max"):
            parts.append(results["rolling"].select(
                F.lit(f"rolling_{stat}").alias("section"), F.col("window_days").cast("string").alias("item"),
                F.col(f"{stat}_correlation").alias("value")))
    if results.get("lag") is not None:
        parts.append(best_lag(results["lag"]).select(
            F.lit("best_lag").alias("section"), F.col("lag_days").cast("string").alias("item"),
            F.col("correlation").alias("value")))
    if results.get("by_product") is not None:
        parts.append(strongest_first(results["by_product"], "product", 3).select(
            F.lit("top_product").alias("section"), F.col("product").alias("item"),
            F.col("correlation").alias("value")))
    if results.get("by_segment") is not None:
        parts.append(results["by_segment"].select(
            F.lit("segment").alias("section"), F.col("segment").alias("item"),
            F.col("correlation").alias("value")))
    return reduce(DataFrame.unionByName, parts)
