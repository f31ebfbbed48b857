"""Row cleaning: derived amounts, required values, ranges, outliers, duplicates, platforms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tallyrill.functions.scalar import calendar_columns, category_of, round_even
from tallyrill.operators import keys as key_ops
from tallyrill.operators.quantiles import exact_quantiles
from tallyrill.scratch import write_once

REQUIRED_SALES = ("customer_id", "date", "product_name")
POSITIVE_SALES = ("quantity", "unit_price", "amount")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating-point NaN means missing: as a number it would pass every lower bound."""
    floating = {c for c, kind in df.dtypes if kind in ("double", "float")}
    if not floating:
        return df
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floating})


def with_amount(df: DataFrame) -> DataFrame:
    """quantity x unit_price, less a percentage discount; an existing amount stays."""
    if "amount" in df.columns or not {"quantity", "unit_price"} <= set(df.columns):
        return df
    amount = F.col("quantity") * F.col("unit_price")
    if "discount" in df.columns:
        amount = amount * (1 - F.col("discount") / 100)
    return df.withColumn("amount", amount)


def with_category(df: DataFrame) -> DataFrame:
    if "category" in df.columns or "product_name" not in df.columns:
        return df
    return df.withColumn("category", category_of("product_name"))


def drop_missing(df: DataFrame, required: tuple[str, ...]) -> DataFrame:
    return df.dropna(subset=list(required))


def missing_cells(df: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Number of null cells, not rows, over the required columns."""
    total = reduce(lambda a, b: a + b, [F.count(F.when(F.col(c).isNull(), 1)) for c in required])
    return df.agg(total.alias("missing_cells"))


def present(df: DataFrame, columns: tuple[str, ...]) -> list[str]:
    return [c for c in columns if c in df.columns]


def keep_positive(df: DataFrame, columns: tuple[str, ...] = POSITIVE_SALES) -> DataFrame:
    for c in present(df, columns):
        df = df.filter(F.col(c) > 0)
    return df


def invalid_counts(df: DataFrame, columns: tuple[str, ...] = POSITIVE_SALES) -> DataFrame:
    """Non-positive values per column, each counted on the rows earlier columns let through."""
    passed: Column = F.lit(True)
    aggs = []
    for c in present(df, columns):
        aggs.append(F.count(F.when(passed & (F.col(c) <= 0), 1)).alias(f"invalid_{c}"))
        passed = passed & F.coalesce(F.col(c) > 0, F.lit(False))
    return df.agg(*aggs, F.count(F.when(passed, 1)).alias("rows_kept"))


def iqr_bounds(df: DataFrame, column: str, threshold: float = 1.5) -> tuple[float, float] | None:
    q = exact_quantiles(df, {column: [0.25, 0.75]})
    q1, q3 = q[(column, 0.25)], q[(column, 0.75)]
    if q1 is None:
        return None
    spread = q3 - q1
    return q1 - threshold * spread, q3 + threshold * spread


def drop_outliers(df: DataFrame, column: str, threshold: float = 1.5) -> DataFrame:
    """Rows inside the inclusive IQR fence; the bounds reach the scan as literals."""
    if column not in df.columns:
        return df
    bounds = iqr_bounds(df, column, threshold)
    if bounds is None:
        return df.filter(F.col(column).isNotNull())
    return within(df, column, bounds)


def within(df: DataFrame, column: str, bounds: tuple[float, float]) -> DataFrame:
    return df.filter((F.col(column) >= F.lit(bounds[0])) & (F.col(column) <= F.lit(bounds[1])))


def keep_first(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """First row of each key along ``order_by``; null keys equal each other.

    A partial minimum per key runs before the shuffle, so a key holding a third of all rows
    arrives as one row per input partition.
    """
    first = df.groupBy(*keys).agg(
        F.min_by(F.struct(*df.columns), F.struct(*order_by)).alias("_row"))
    return first.select("_row.*")


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each key."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def with_calendar(df: DataFrame, full: bool) -> DataFrame:
    if "date" not in df.columns:
        return df
    return df.withColumns(calendar_columns("date", full))


def engagement_rate(columns: list[str], platform: str) -> Column | None:
    """Interactions over audience, 4 digits half-to-even; null where the audience is zero."""
    have = set(columns)
    if platform == "instagram":
        parts, base = ["likes", "comments", "shares"], "followers"
    else:
        parts, base = ["likes", "comments"], "views"
        if platform == "tiktok" and "shares" in have:
            parts.append("shares")
    if not {*parts, base} <= have:
        return None
    total = reduce(lambda a, b: a + b, [F.col(c) for c in parts])
    return round_even(F.try_divide(total.cast("double"), F.col(base).cast("double")), 4)


def clean_social(df: DataFrame, platform: str, order_by: list[str] | None = None) -> DataFrame:
    """Posts of one platform: first of each id, dated rows, engagement rate, calendar, platform.

    Without ``order_by`` the first row is the first that the scan of ``df`` yields.
    """
    df = nan_to_null(df)
    ids = present(df, ("post_id", "video_id"))
    if ids and order_by:
        df = keep_first(df, ids, order_by)
    elif ids:
        df = keep_first(df.withColumn("_input", F.monotonically_increasing_id()), ids, ["_input"]).drop("_input")
    if order_by:
        df = df.drop(*[c for c in order_by if c.startswith("_")])
    if "date" in df.columns:
        df = drop_missing(df, ("date",))
    if "engagement_rate" not in df.columns:
        rate = engagement_rate(df.columns, platform)
        if rate is not None:
            df = df.withColumn("engagement_rate", rate)
    return with_calendar(df, full=False).withColumn("platform", F.lit(platform))


def merge_social(tables: list[DataFrame | None]) -> DataFrame | None:
    """Union by column name, absent tables skipped; None without any."""
    given = [t for t in tables if t is not None]
    if not given:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), given)


def clean_sales(df: DataFrame, order_by: list[str]) -> DataFrame:
    """Full cleaning of raw sales; ``order_by`` is the total order that stands for input order.

    Generated ids are unique and never null, so they are neither de-duplicated nor filtered, and
    the outlier bounds come from the numbered rows before customer ids are worked out.
    """
    given = set(df.columns)
    by_position = key_ops.all_by_position(df)
    if by_position:
        placed = key_ops.with_position(nan_to_null(df), order_by)
        rows = with_amount(placed)
    else:
        rows = with_category(with_amount(key_ops.with_row_keys(nan_to_null(df), order_by)))
    if "transaction_id" in given:
        if "customer_id" not in given:
            rows = key_ops.with_customer_id(rows)
        first = keep_first(rows, ["transaction_id"], key_ops.first_row_order(rows.columns, order_by))
        rows = write_once(first, "unique-sales")

    def valid(t: DataFrame) -> DataFrame:
        return keep_positive(drop_missing(t, tuple(present(t, REQUIRED_SALES))))

    bounds = iqr_bounds(valid(rows), "amount") if "amount" in rows.columns else None
    if by_position:
        rows = with_category(with_amount(key_ops.with_ids_by_position(placed)))
    elif "customer_id" not in rows.columns:
        rows = key_ops.with_customer_id(rows)
    kept = valid(rows)
    if bounds is not None:
        kept = within(kept, "amount", bounds)
    helpers = ["_dated", key_ops.POSITION, *[c for c in order_by if c.startswith("_")]]
    return with_calendar(kept.drop(*helpers), full=True)


def cleaning_funnel(df: DataFrame, keys: list[str], order_by: list[str], required: tuple[str, ...],
                    positive: tuple[str, ...], outlier: str) -> DataFrame:
    """Rows left after each cleaning step, rows removed and their share.

    The input is read once: the task that writes the first row of each key observes how many rows the keys had and
    which conditions hold. Only what the fence on the outlier column needs is read from the written copy.
    """
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    valid = reduce(lambda a, b: a & b, [F.coalesce(F.col(c) > 0, F.lit(False)) for c in positive], complete)
    # Observed above the last shuffle, where every row is counted once however often tasks are run again.
    seen = Observation("funnel")
    unique = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.min_by(
        F.struct(*df.columns), F.struct(*order_by)).alias("_row")).select("_row.*", "_rows")
    first = write_once(unique.observe(
        seen, F.sum("_rows").alias("rows_initial"), F.count(F.lit(1)).alias("rows_unique"),
        F.count(F.when(complete, 1)).alias("rows_complete"), F.count(F.when(valid, 1)).alias("rows_valid")), "funnel")
    rows = seen.get
    bounds = iqr_bounds(first.filter(valid), outlier) or (0.0, 0.0)
    inside = within(first.filter(valid), outlier, bounds)
    out = inside.agg(
        *[F.lit(rows[c] or 0).cast("bigint").alias(c) for c in ("rows_initial", "rows_unique", "rows_complete", "rows_valid")],
        F.count(F.lit(1)).alias("rows_final"),
        *[inside.groupBy(c).agg(F.lit(1)).agg(F.count(c)).scalar().alias(n)
          for c, n in (("customer_id", "unique_customers"), ("product_id", "unique_products"))])
    removed = F.col("rows_initial") - F.col("rows_final")
    return out.withColumns({
        "rows_removed": removed,
        "removed_pct": F.coalesce(F.try_divide(removed * 100.0, F.col("rows_initial")), F.lit(0.0)),
    })
