"""Quality checks, pass and fail."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyrill.operators import quality

START = dt.date(2024, 1, 1)


def verdict(df, check):
    return quality.run_checks(df, "t", [check]).first().passed


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(1, "a", 10.0, START), (2, None, 20.0, START + dt.timedelta(days=9)), (2, "c", -1.0, None)],
                                 "id int, name string, price double, date date")


@pytest.mark.parametrize("make, want", [
    (lambda t: quality.required_columns(t, ["id", "name"]), True),
    (lambda t: quality.required_columns(t, ["id", "nope"]), False),
    (lambda t: quality.no_nulls(t, ["id"]), True),
    (lambda t: quality.no_nulls(t, ["id", "name", "nope"]), False),
    (lambda t: quality.no_nulls(t, ["nope"]), False),
    (lambda t: quality.no_duplicates(t, ["id"]), False),
    (lambda t: quality.no_duplicates(t, ["id", "name"]), True),
    (lambda t: quality.no_duplicates(t, ["nope"]), True),
    (lambda t: quality.not_below(t, ["id", "nope"]), True),
    (lambda t: quality.not_below(t, ["price"]), False),
    (lambda t: quality.plausible_dates(t), True),
    (lambda t: quality.plausible_dates(t, "name"), False),
    (lambda t: quality.plausible_dates(t, "nope"), True),
    (lambda t: quality.enough_distinct(t, "name", 2, "u"), True),
    (lambda t: quality.enough_distinct(t, "name", 3, "u"), False),
    (lambda t: quality.enough_distinct(t, "nope", 3, "u"), True),
    (lambda t: quality.fresh(t, F.lit("2024-12-31").cast("date")), True),
    (lambda t: quality.fresh(t, F.lit("2025-06-30").cast("date")), False),
    (lambda t: quality.continuous_dates(t), True),
])
def test_single_checks(table, make, want):
    assert verdict(table, make(table)) is want


@pytest.mark.parametrize("years", [-20, 9])
def test_dates_outside_the_plausible_years_fail(table, years):
    moved = table.withColumn("date", F.add_months("date", 12 * years))
    assert verdict(moved, quality.plausible_dates(moved)) is False


def test_gap_over_thirty_days_fails(spark):
    df = spark.createDataFrame([(START,), (START + dt.timedelta(days=31),)], "date date")
    assert verdict(df, quality.continuous_dates(df)) is False
    one = df.limit(1)
    assert verdict(one, quality.continuous_dates(one)) is True


def test_null_dates_only_fail(spark):
    df = spark.createDataFrame([(None,)], "date date")
    assert verdict(df, quality.plausible_dates(df)) is False


def good_sales(spark, n=15):
    rows = [(i % 10, i % 5, "p", START + dt.timedelta(days=i), 1, 2.0, 2.0, f"T{i}") for i in range(n)]
    return spark.createDataFrame(rows, "customer_id int, product_id int, product_name string, date date, quantity int, "
                                       "unit_price double, amount double, transaction_id string")


def test_sales_suite(spark):
    assert all(r.passed for r in quality.suite(good_sales(spark), "sales").collect())
    bad = good_sales(spark).withColumn("quantity", -F.col("quantity"))
    failed = {r.check for r in quality.suite(bad, "sales").collect() if not r.passed}
    assert failed == {"ranges"}
    few = good_sales(spark).drop("customer_id")
    assert "required_columns" in {r.check for r in quality.suite(few, "sales").collect() if not r.passed}


def test_all_suites_and_verdicts(spark):
    posts = spark.createDataFrame([("a", START, 0.05, "instagram"), ("b", START, -0.1, "tiktok")],
                                  "post_id string, date date, engagement_rate double, platform string")
    daily = spark.createDataFrame([(START, 1.0, 2), (START + dt.timedelta(days=1), 2.0, 1)],
                                  "date date, total_sales double, num_transactions int")
    tables = {"sales": good_sales(spark), "instagram": posts.filter("platform = 'instagram'"),
              "tiktok": posts.filter("platform = 'tiktok'"), "youtube": posts.filter("false"),
              "social_media_merged": posts, "daily_aggregates": daily}
    details = quality.validate_tables(tables)
    assert details.filter("dataset = 'youtube'").count() == 0
    got = {r.dataset: r.passed for r in quality.dataset_verdicts(details, list(tables)).collect()}
    assert got == {"sales": True, "instagram": True, "tiktok": False, "youtube": True, "social_media_merged": False,
                   "daily_aggregates": True}
    one = quality.overall(quality.dataset_verdicts(details, list(tables))).first()
    assert (one.passed, one.total, one.all_passed) == (4, 6, False)


def test_empty_sales_fail_and_empty_posts_pass(spark):
    empty = {"sales": good_sales(spark).filter("false"), "instagram": spark.createDataFrame([], "date date, engagement_rate double")}
    details = quality.validate_tables(empty)
    assert {r.dataset: r.passed for r in quality.dataset_verdicts(details, list(empty)).collect()} == {
        "sales": False, "instagram": True}


def test_outputs(spark):
    assert quality.missing_outputs({"sales"}) == ["social_media_merged", "daily_aggregates"]
    assert quality.output_completeness(spark, {"sales"}).first().status == "Parcial"
    assert quality.output_completeness(spark, set(quality.schemas.EXPECTED_OUTPUTS)).first().status == "OK"
