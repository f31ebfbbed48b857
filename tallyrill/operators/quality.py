"""Data-quality checks: every table is read once and reduced to one row of observations.

A check is a named rule over that row. Results are long rows (dataset, check, passed, observed);
``observed`` is the number the rule looked at, null for rules on the schema alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyrill import schemas
from tallyrill.operators.rollups import date_gaps

FIRST_YEAR, LAST_YEAR = 2010, 2030
MAX_GAP_DAYS = 30
MAX_AGE_DAYS = 365


@dataclass
class Check:
    """Aggregates needed from the table, the rule on them, and the number to report."""

    name: str
    aggregates: dict[str, Column]
    passed: Column
    observed: Column


def _flag(value: bool) -> Column:
    return F.lit(value)


def _unobserved() -> Column:
    return F.lit(None).cast("bigint")


def required_columns(df: DataFrame, columns: list[str], name: str = "required_columns") -> Check:
    missing = [c for c in columns if c not in df.columns]
    return Check(name, {}, _flag(not missing), F.lit(len(missing)).cast("bigint"))


def no_nulls(df: DataFrame, columns: list[str], name: str = "nulls") -> Check:
    have = [c for c in columns if c in df.columns]
    if not have:
        return Check(name, {}, _flag(False), _unobserved())
    cells = reduce(lambda a, b: a + b, [F.count(F.when(F.col(c).isNull(), 1)) for c in have])
    key = f"_{name}"
    return Check(name, {key: cells}, F.col(key) == 0, F.col(key))


def no_duplicates(df: DataFrame, keys: list[str], name: str = "duplicates") -> Check:
    """Rows beyond the first per key; null keys equal each other."""
    have = [c for c in keys if c in df.columns]
    if not have:
        return Check(name, {}, _flag(True), _unobserved())
    extra = _of_groups(df, have, F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)))
    return Check(name, {}, extra == 0, extra)


def _of_groups(df: DataFrame, columns: list[str], what: Column) -> Column:
    """An aggregate over the groups of a table, from those columns alone, where ``_n`` is the size of a group.

    Several distinct counts in one aggregate would multiply every row by their number.
    """
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).agg(what.cast("bigint")).scalar()


def not_below(df: DataFrame, columns: list[str], minimum: float = 0, name: str = "ranges") -> Check:
    have = [c for c in columns if c in df.columns]
    if not have:
        return Check(name, {}, _flag(True), F.lit(0).cast("bigint"))
    low = reduce(lambda a, b: a + b, [F.count(F.when(F.col(c) < minimum, 1)) for c in have])
    key = f"_{name}"
    return Check(name, {key: low}, F.col(key) == 0, F.col(key))


def plausible_dates(df: DataFrame, column: str = "date", name: str = "dates") -> Check:
    if column not in df.columns:
        return Check(name, {}, _flag(True), _unobserved())
    if not dict(df.dtypes)[column].startswith(("date", "timestamp")):
        return Check(name, {}, _flag(False), _unobserved())
    first, last = f"_{name}_first", f"_{name}_last"
    aggregates = {first: F.year(F.min(column)), last: F.year(F.max(column))}
    ok = F.coalesce((F.col(first) >= FIRST_YEAR) & (F.col(last) <= LAST_YEAR), F.lit(False))
    return Check(name, aggregates, ok, F.col(last).cast("bigint"))


def fresh(df: DataFrame, now: Column, column: str = "date", max_days: int = MAX_AGE_DAYS,
          name: str = "freshness") -> Check:
    """Age of the newest date against a clock the caller passes in."""
    if column not in df.columns:
        return Check(name, {}, _flag(True), _unobserved())
    key = f"_{name}"
    return Check(name, {key: F.datediff(F.to_date(now), F.max(column))},
                 F.coalesce(F.col(key) <= max_days, F.lit(False)), F.col(key).cast("bigint"))


def enough_distinct(df: DataFrame, column: str, minimum: int, name: str) -> Check:
    if column not in df.columns:
        return Check(name, {}, _flag(True), _unobserved())
    found = _of_groups(df, [column], F.count(column))
    return Check(name, {}, found >= minimum, found)


def continuous_dates(df: DataFrame, name: str = "date_continuity") -> Check:
    """Largest gap between successive dates; a single date passes."""
    if "date" not in df.columns:
        return Check(name, {}, _flag(True), _unobserved())
    gap = date_gaps(df).agg(F.max("gap_days")).scalar().cast("bigint")
    return Check(name, {}, F.coalesce(gap <= MAX_GAP_DAYS, F.lit(True)), gap)


def run_checks(df: DataFrame, dataset: str, checks: list[Check]) -> DataFrame:
    """One aggregate over the table; no rows come back for an empty table."""
    aggregates = {"_rows": F.count(F.lit(1))}
    for check in checks:
        aggregates.update(check.aggregates)
    one = df.agg(*[c.alias(n) for n, c in aggregates.items()]).filter(F.col("_rows") > 0)
    results = F.array(*[
        F.struct(F.lit(c.name).alias("check"), c.passed.alias("passed"), c.observed.alias("observed"))
        for c in checks])
    return one.select(F.lit(dataset).alias("dataset"), F.explode(results).alias("r")).select(
        "dataset", "r.check", "r.passed", "r.observed")


def sales_checks(df: DataFrame) -> list[Check]:
    return [
        required_columns(df, ["customer_id", "product_id", "date", "amount"]),
        no_nulls(df, ["customer_id", "product_id", "date"]),
        no_duplicates(df, ["transaction_id"]),
        not_below(df, ["quantity", "unit_price", "amount"]),
        plausible_dates(df),
        enough_distinct(df, "customer_id", 10, "unique_customers"),
        enough_distinct(df, "product_id", 5, "unique_products"),
    ]


def platform_checks(df: DataFrame) -> list[Check]:
    return [
        required_columns(df, ["date", "engagement_rate"]),
        no_nulls(df, ["date"]),
        not_below(df, ["engagement_rate"]),
        plausible_dates(df),
    ]


def merged_social_checks(df: DataFrame) -> list[Check]:
    return [
        required_columns(df, ["date", "platform", "engagement_rate"]),
        no_nulls(df, ["date", "platform"]),
        not_below(df, ["engagement_rate"]),
        plausible_dates(df),
        enough_distinct(df, "platform", 1, "platforms"),
    ]


def daily_checks(df: DataFrame) -> list[Check]:
    return [
        required_columns(df, ["date", "total_sales", "num_transactions"]),
        no_nulls(df, ["date"]),
        not_below(df, ["total_sales", "num_transactions"]),
        plausible_dates(df),
        continuous_dates(df),
    ]


# dataset -> (its checks, verdict on an empty table)
SUITES = {
    "sales": (sales_checks, False),
    **{platform: (platform_checks, True) for platform in schemas.PLATFORMS},
    "social_media_merged": (merged_social_checks, False),
    "daily_aggregates": (daily_checks, False),
}


def suite(df: DataFrame, dataset: str) -> DataFrame:
    checks, _ = SUITES[dataset]
    return run_checks(df, dataset, checks(df))


def validate_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Check rows of every present table."""
    given = [suite(tables[name], name) for name in SUITES if tables.get(name) is not None]
    if not given:
        raise ValueError("no table to validate")
    return reduce(DataFrame.unionByName, given)


def dataset_verdicts(details: DataFrame, datasets: list[str]) -> DataFrame:
    """(dataset, passed): all checks passed; tables without rows get their suite's verdict."""
    default = F.create_map(*[F.lit(x) for name in datasets for x in (name, SUITES[name][1])])
    names = F.explode(F.array(*[F.lit(n) for n in datasets])).alias("dataset")
    every = details.sparkSession.range(1).select(names)
    found = details.groupBy("dataset").agg(F.bool_and("passed").alias("passed"))
    return every.join(found, "dataset", "left").select(
        "dataset", F.coalesce("passed", default[F.col("dataset")]).alias("passed"))


def overall(verdicts: DataFrame) -> DataFrame:
    """Passed and total datasets, success rate in percent, overall verdict (true without any)."""
    good = F.count(F.when(F.col("passed"), 1))
    return verdicts.agg(
        good.alias("passed"),
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.try_divide(good * 100.0, F.count(F.lit(1))), F.lit(0.0)).alias("success_rate"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"),
    )


def missing_outputs(names: set[str], expected: tuple[str, ...] = schemas.CRITICAL_OUTPUTS) -> list[str]:
    return [n for n in expected if n not in names]


def output_completeness(spark, names: set[str], expected: tuple[str, ...] = schemas.EXPECTED_OUTPUTS) -> DataFrame:
    found = sum(n in names for n in expected)
    status = "OK" if found == len(expected) else "Parcial"
    return spark.range(1).select(
        F.lit(status).alias("status"), F.lit(found).cast("bigint").alias("found"),
        F.lit(len(expected)).cast("bigint").alias("expected"))
