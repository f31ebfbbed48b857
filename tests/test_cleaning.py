"""Cleaning, keys, row numbers and quantiles."""

import datetime as dt
import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyrill import scratch
from tallyrill.operators import cleaning, index, keys, quality, quantiles, rollups
from tallyrill.sources import scan

START = dt.date(2024, 1, 1)


def sales(spark, quantities, **extra):
    rows = [{"_n": i, "date": START + dt.timedelta(days=i), "product_name": "Whey Protein", "quantity": q,
             "unit_price": 10.0, **{k: v[i] for k, v in extra.items()}} for i, q in enumerate(quantities)]
    return spark.createDataFrame(pd.DataFrame(rows))


def test_keys_are_created(spark):
    df = sales(spark, range(1, 11), location=["Madrid"] * 10)
    out = keys.with_sales_keys(df, ["_n"])
    rows = sorted(out.collect(), key=lambda r: r._n)
    assert [r.transaction_id for r in rows] == [f"TXN{i:06d}" for i in range(10)]
    assert {r.product_id for r in rows} == {1} and {r.customer_id for r in rows} == {1}


def test_amounts_are_derived(spark):
    rows = [(3, 2.25, 0.0), (7, 0.5, 20.0), (4, 12.5, 100.0), (None, 8.0, 0.0)]
    df = spark.createDataFrame(rows, "quantity int, unit_price double, discount double")
    plain = cleaning.with_amount(df.drop("discount"))
    assert [r.amount for r in plain.collect()] == [6.75, 3.5, 50.0, None]
    assert [r.amount for r in cleaning.with_amount(df).collect()] == pytest.approx([6.75, 2.8, 0.0, None])


def test_invalid_rows_are_removed(spark):
    df = sales(spark, [0, 6, 7, -2, 6, 8])
    out = cleaning.clean_sales(df, ["_n"])
    assert sorted(r.quantity for r in out.collect()) == [6, 6, 7, 8]
    assert {"year", "month", "quarter", "day_of_week", "day_name", "week", "is_weekend"} <= set(out.columns)
    counts = cleaning.invalid_counts(df).first()
    assert (counts.invalid_quantity, counts.invalid_unit_price, counts.rows_kept) == (2, 0, 4)


def test_given_transaction_ids_keep_their_first_row(spark):
    df = sales(spark, [3, 1, 2, 4], transaction_id=["a", "b", "a", None], customer_id=[1, 2, 3, 4])
    kept = cleaning.keep_first(df, ["transaction_id"], ["_n"]).collect()
    assert sorted((r.transaction_id or "", r.quantity) for r in kept) == [("", 4), ("a", 3), ("b", 1)]
    out = cleaning.clean_sales(df, ["_n"])
    assert sorted(r.transaction_id or "" for r in out.collect()) == ["", "a", "b"]


def test_given_transactions_without_customers(spark):
    """Blocks of rows are numbered before duplicates go."""
    df = sales(spark, [2] * 12, transaction_id=[f"t{i % 11}" for i in range(12)])
    out = {r.transaction_id: (r.customer_id, r.product_id) for r in cleaning.clean_sales(df, ["_n"]).collect()}
    assert out == {f"t{i}": (i // 5 + 1, 1) for i in range(11)}


def test_nan_is_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([(nan, 1.0), (2.0, nan), (3.0, 4.0)], "quantity double, unit_price double")
    assert cleaning.keep_positive(cleaning.nan_to_null(df)).count() == 1
    assert quantiles.exact_quantiles(df, {"quantity": [0.5]}) == {("quantity", 0.5): 2.5}


def test_missing_values(spark):
    rows = [(1, None, "a"), (None, None, "b"), (2, START, None), (3, START, "d")]
    df = spark.createDataFrame(rows, "customer_id int, date date, product_name string")
    assert cleaning.missing_cells(df, cleaning.REQUIRED_SALES).first()[0] == 4
    assert [r.customer_id for r in cleaning.drop_missing(df, cleaning.REQUIRED_SALES).collect()] == [3]


def test_outlier_is_removed(spark):
    # Quartiles 23 and 27: the fence is 17 to 33.
    df = spark.createDataFrame([(float(v),) for v in (16, 22, 24, 26, 32, 20, 24, 28, 33.5, 24, 24)], "amount double")
    kept = sorted(r.amount for r in cleaning.drop_outliers(df, "amount").collect())
    assert kept == [20, 22, 24, 24, 24, 24, 26, 28, 32]
    assert cleaning.drop_outliers(df, "other") is df
    assert cleaning.drop_outliers(df.filter("amount > 1000"), "amount").count() == 0


def test_written_forms_of_dates_and_ids_survive_a_scan(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text("Date,Product Name,Units Sold,Price,Customer ID\n2024-03-05,a,3.7,2,C001\n03/06/2024,b,1,2,C002\n"
                    "Mar 7 2024,c,2,2,0007\n8 Mar 2024,d,4,2,C004\nsoon,e,4,2,C005\n")
    rows = scan.read_sales_csv(spark, str(path)).orderBy("product_name").collect()
    assert [str(r.date) for r in rows] == ["2024-03-05", "2024-03-06", "2024-03-07", "2024-03-08", "None"]
    assert [r.quantity for r in rows] == [3.7, 1, 2, 4, 4]
    assert [r.customer_id for r in rows] == ["C001", "C002", "0007", "C004", "C005"]


def test_rate_is_derived_from_a_file_that_has_none(spark, tmp_path):
    path = tmp_path / "instagram.json"
    path.write_text('[{"post_id": "p", "date": "2024-03-05", "likes": 50, "comments": 9, "shares": 1, "followers": 400, "mood": "x"}]')
    df = scan.read_social_json(spark, str(path), "instagram")
    assert "engagement_rate" not in df.columns and "reach" not in df.columns and "mood" in df.columns
    assert cleaning.clean_social(df, "instagram").first().engagement_rate == 0.15


@pytest.mark.parametrize("platform, columns, want", [
    ("instagram", {"likes": 37, "comments": 5, "shares": 3, "followers": 720}, 0.0625),
    ("tiktok", {"likes": 61, "comments": 9, "shares": 14, "views": 480}, 0.175),
    ("tiktok", {"likes": 61, "comments": 9, "views": 480}, 0.1458),
    ("youtube", {"likes": 27, "comments": 6, "shares": 99, "views": 264}, 0.125),
    ("youtube", {"likes": 27, "comments": 6, "views": 0}, None),
    ("youtube", {"likes": 1, "comments": 0, "views": 20000}, 0.0),
])
def test_engagement_rates(spark, platform, columns, want):
    df = spark.createDataFrame(pd.DataFrame([{"post_id": "x", "date": START, **columns}]))
    row = cleaning.clean_social(df, platform).first()
    assert row.engagement_rate == want and row.platform == platform


def test_existing_rate_stays_and_absent_inputs_add_none(spark):
    df = spark.createDataFrame([("x", START, 0.5)], "post_id string, date date, engagement_rate double")
    assert cleaning.clean_social(df, "instagram").first().engagement_rate == 0.5
    assert "engagement_rate" not in cleaning.clean_social(df.drop("engagement_rate"), "tiktok").columns


def test_platforms_are_merged_by_name(spark):
    a = spark.createDataFrame([("p1", START, "instagram", 0.1)], "post_id string, date date, platform string, engagement_rate double")
    b = spark.createDataFrame([("v1", START, "tiktok", 0.2)], "video_id string, date date, platform string, engagement_rate double")
    merged = cleaning.merge_social([a, None, b])
    assert merged.count() == 2 and {r.platform for r in merged.collect()} == {"instagram", "tiktok"}
    assert cleaning.merge_social([None, None]) is None


# -- numbering --------------------------------------------------------------------------------


def test_index_is_contiguous_with_a_hot_value(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), "id")
    got = {r.id: r.row_idx for r in index.contiguous_index(df.repartition(6), ["k", "id"]).collect()}
    order = sorted(range(5000), key=lambda i: (7 if i % 3 == 0 else i % 50, i))
    assert [got[i] for i in order] == list(range(5000))


def test_scan_order_index(spark, tmp_path):
    from tallyrill.sources.scan import with_scan_order
    for part in range(3):
        (tmp_path / f"part-{part}.csv").write_text("".join(f"{part * 100 + i}\n" for i in range(100)))
    df = with_scan_order(spark.read.schema("v int").csv(str(tmp_path)))
    rows = index.index_by_scan_order(df).collect()
    assert all(r.v == r.row_idx for r in rows) and len(rows) == 300


def test_codes_follow_first_appearance(spark):
    rng = random.Random(5)
    names = [rng.choice(["a", "b", "c", None, "d", "hot", "hot", "hot"]) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(names)), "row_idx long, name string").repartition(5)
    got = {r.row_idx: r.code for r in index.factorize(df, "name", ["row_idx"], "code").collect()}
    assert [got[i] for i in range(400)] == list(pd.factorize(pd.Series(names))[0])


def test_codes_of_many_values(spark):
    df = spark.range(2000).select(F.col("id").alias("row_idx"), (F.col("id") * 7 % 500).alias("v"))
    got = {r.row_idx: r.code for r in index.factorize(df, "v", ["row_idx"], "code").collect()}
    assert [got[i] for i in range(2000)] == list(pd.factorize(np.array([i * 7 % 500 for i in range(2000)]))[0])


@pytest.mark.parametrize("chunk", [10, 50, 20_000])
def test_customer_ids_from_location(spark, chunk):
    rng = random.Random(11)
    rows = [(i, START + dt.timedelta(days=rng.randrange(9)) if rng.random() > 0.1 else None,
             rng.choice(["x", "x", "x", "y", None])) for i in range(333)]
    df = spark.createDataFrame(rows, "row_idx long, date date, location string").repartition(4)
    got = {r.row_idx: r.customer_id for r in keys.customer_id_from_location(keys.by_date(df, ["row_idx"]), chunk).collect()}
    ordered = sorted(rows, key=lambda r: (r[1] is None, r[1] or START, r[0]))
    names = [f"{r[2] if r[2] is not None else 'nan'}_{pos // 10}" for pos, r in enumerate(ordered)]
    want = {r[0]: code + 1 for r, code in zip(ordered, pd.factorize(pd.Series(names))[0])}
    assert got == want


def test_customer_ids_without_location(spark):
    df = sales(spark, range(1, 13)).withColumnRenamed("_n", "row_idx")
    got = {r.row_idx: r.customer_id for r in keys.customer_id_from_order(keys.by_date(df, ["row_idx"])).collect()}
    assert [got[i] for i in range(12)] == [i // 5 + 1 for i in range(12)]


# -- quantiles --------------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["spread", "ties", "hot"])
def test_quantiles_are_exact(spark, kind):
    rng = random.Random(17)
    values = {"spread": [rng.gauss(0, 100) for _ in range(3001)],
              "ties": [float(rng.randrange(12)) for _ in range(2000)],
              "hot": [5.0 if rng.random() < 0.4 else rng.uniform(0, 10) for _ in range(2500)]}[kind]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = quantiles.exact_quantiles(df, {"v": probs})
    for p in probs:
        assert got[("v", p)] == pytest.approx(float(np.quantile(values, p)), abs=1e-12)


def test_quantiles_of_several_columns_with_missing_values(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (4.0, None), (None, None)], "a double, b double")
    got = quantiles.exact_quantiles(df, {"a": [0.0, 0.5, 1.0], "b": [0.5]})
    assert got == {("a", 0.0): 1.0, ("a", 0.5): 2.5, ("a", 1.0): 4.0, ("b", 0.5): None}


def test_values_far_from_a_quantile_are_only_counted(spark, monkeypatch):
    """A sketch narrows what is ordered: of 20,000 distinct values a few hundred are written in order."""
    monkeypatch.setattr(quantiles, "SKETCH_ABOVE", 1000)
    written = []
    monkeypatch.setattr(quantiles, "write_once", lambda df, label: written.append(scratch.write_once(df, label)) or written[-1])
    df = spark.range(20_000).select((F.col("id") * 3 % 20_000).cast("double").alias("v"),
                                    F.when(F.col("id") % 3 > 0, F.col("id") % 2).cast("double").alias("w")).repartition(5)
    got = quantiles.exact_quantiles(df, {"v": [0.75, 0.25], "w": [0.5]})
    assert got == {("v", 0.25): 4999.75, ("v", 0.75): 14999.25, ("w", 0.5): got["w", 0.5]} and got["w", 0.5] in (0.0, 0.5, 1.0)
    counts = written[-1].filter("c = 0")
    assert counts.count() < 500 and counts.agg(F.sum("n")).first()[0] == 20_000


@pytest.mark.parametrize("ranges", [[(0.0, 10.0)], [(5.0, 5.0), (900.0, 990.0)], [(600.0, 700.0)]])
def test_quantiles_that_a_sketch_misplaced(spark, monkeypatch, ranges):
    monkeypatch.setattr(quantiles, "_brackets", lambda cells, wanted: {c: ranges for c in wanted})
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    assert quantiles.exact_quantiles(df, {"v": [0.25, 0.5]}) == {("v", 0.25): 249.75, ("v", 0.5): 499.5}


def test_numbers_in_file_names_order_by_value(spark):
    names = ["d/part-99999.csv", "d/part-100000.csv", "d/part-2.csv", "c/part-7.csv"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    assert [r.f for r in df.orderBy(index.by_number("f")).collect()] == [names[3], names[2], names[0], names[1]]


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "v double")
    assert quantiles.exact_quantiles(df, {"v": [0.5]}) == {("v", 0.5): None}


def test_funnel(spark):
    rows = [("a", 1, START, 1, 10.0), ("a", 1, START, 1, 99.0), ("b", None, START, 1, 10.0), ("c", 2, START, -1, 10.0),
            ("d", 2, START, 1, 11.0), ("e", 3, START, 2, 12.0), ("f", 3, START, 2, 500.0), ("g", 3, START, 2, 11.0),
            ("h", 4, START, 2, 10.0)]
    df = spark.createDataFrame([(i, *r, 1) for i, r in enumerate(rows)],
                               "n int, t string, customer_id int, date date, quantity int, amount double, product_id int")
    r = cleaning.cleaning_funnel(df, ["t"], ["n"], ("customer_id", "date"), ("quantity", "amount"), "amount").first()
    assert (r.rows_initial, r.rows_unique, r.rows_complete, r.rows_valid, r.rows_final) == (9, 8, 7, 6, 5)
    assert r.rows_removed == 4 and round(r.removed_pct, 3) == 44.444 and r.unique_customers == 4


def test_distinct_counts_multiply_no_row(spark):
    """Plans of rollups, checks and the funnel hold no Expand, which would copy every row per distinct count."""
    df = spark.createDataFrame([(START, f"t{i}", i % 4, i % 3, 1.0 + i, 2) for i in range(30)],
                               "date date, transaction_id string, customer_id long, product_id long, amount double, quantity long")
    frames = [rollups.daily_sales(df), quality.suite(df, "sales"), cleaning.cleaning_funnel(
        df, ["transaction_id"], ["quantity"], ("customer_id",), ("amount",), "amount")]
    for frame in frames:
        assert "Expand" not in frame._jdf.queryExecution().executedPlan().toString()
    assert frames[0].first().unique_customers == 4 and frames[0].first().unique_products == 3
    assert frames[2].first().unique_customers == 4


@pytest.mark.parametrize("chunk", [10, 50, 20_000])
@pytest.mark.parametrize("located", [True, False])
def test_customer_ids_move_whole_rows_once(spark, chunk, located):
    """The same ids as of rows put in order first, undated rows and batches that end inside a block included."""
    rng = random.Random(12)
    rows = [(i, None if rng.random() < 0.1 else dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(5)),
             rng.choice(["a", "b", "c", None, "nan"])) for i in range(700)]
    df = spark.createDataFrame(rows, f"{keys.POSITION} long, date date, location string").repartition(4)
    df = df if located else df.drop("location")
    want = keys.with_customer_id(keys.by_date(df, [keys.POSITION]))
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = keys.customer_id_by_position(df, chunk_rows=chunk)
        got = {r[keys.POSITION]: r.customer_id for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    assert got == {r[keys.POSITION]: r.customer_id for r in want.collect()}
    assert "rangepartitioning" not in plan and set(out.columns) == {*df.columns, "customer_id"}


def test_generated_ids_leave_whole_rows_unsorted(spark):
    """Rows in scan order are dealt to their chunk from the written copy: nothing but keys and places is sorted by range."""
    df = spark.createDataFrame([(i, dt.date(2024, 1, 1 + i % 3), "x", f"p{i % 4}", 1, 2.0) for i in range(60)],
                               "n long, date date, location string, product_name string, quantity long, unit_price double")
    folder = scratch.shared_folder(spark) + "/tallyrill"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    out = cleaning.clean_sales(df, ["n"])
    wide = [p for p in set(os.listdir(folder)) - before if p.startswith("ordered-rows")
            and "product_name" in spark.read.parquet(f"{folder}/{p}").columns and "date" in spark.read.parquet(f"{folder}/{p}").columns]
    assert len(wide) == 1  # by position; a second one, by date, is not written
    assert out.count() == 60
