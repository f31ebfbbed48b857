"""Rollups, demand index, correlations and segments on small tables."""

import datetime as dt
import math
import random
import threading

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyrill.operators import correlation, demand, rollups, segmentation

START = dt.date(2024, 1, 1)


def day(i):
    return START + dt.timedelta(days=i)


@pytest.fixture(scope="module")
def facts(spark):
    sales = spark.createDataFrame(
        [(day(0), 1, 1, 1, 10.0), (day(0), 2, 1, 2, 20.0), (day(1), 1, 2, 1, 15.0), (None, 1, 2, 1, 99.0)],
        "date date, customer_id int, product_id int, quantity int, amount double")
    social = spark.createDataFrame(
        [(day(0), "instagram", 0.05, 100, 10), (day(2), "tiktok", 0.08, 200, 20)],
        "date date, platform string, engagement_rate double, likes int, comments int")
    return sales, social


def test_daily_rollup(facts):
    rows = {r.date: r for r in rollups.daily_aggregates(*facts).collect()}
    assert set(rows) == {day(0), day(1)}
    r = rows[day(0)]
    assert (r.total_sales, r.num_transactions, r.avg_engagement, r.total_likes, r.total_comments) == (30.0, 2, 0.05, 100, 10)
    assert (r.unique_customers, r.unique_products, r.total_units, r.std_engagement, r.platforms) == (2, 1, 3, 0.0, "instagram")
    assert rows[day(1)].avg_engagement == 0.0 and rows[day(1)].platforms is None
    assert "avg_engagement" not in rollups.daily_aggregates(facts[0], None).columns


def test_spine_and_gaps(spark):
    df = spark.createDataFrame([(day(0),), (day(3),), (day(3),), (None,)], "date date")
    assert [r.date for r in rollups.date_spine(df).orderBy("date").collect()] == [day(i) for i in range(4)]
    assert {r.date: r.gap_days for r in rollups.date_gaps(df).collect()} == {day(0): None, day(3): 3}


def test_nearest_date(spark):
    index = spark.createDataFrame([("a", day(2), 0.2), ("a", day(6), 0.6), ("b", day(1), 0.9)], "k string, date date, v double")
    wanted = spark.createDataFrame([(k, day(i)) for k in "abc" for i in range(9)], "k string, date date")
    got = {(r.k, r.date): r.v for r in demand.nearest_by_date(wanted, index, "v", ["k"]).collect()}
    assert [got["a", day(i)] for i in range(9)] == [0.2] * 5 + [0.6] * 4
    assert [got["b", day(0)], got["b", day(8)], got["c", day(4)]] == [0.9, 0.9, 0.5]


def test_demand_index(spark):
    quantities = [10, 40, 20, 30, 40, 10]
    df = spark.createDataFrame([(day(i), q, 1.0) for i, q in enumerate(quantities)], "date date, quantity long, amount double")
    got = [r.demand_index for r in demand.demand_index(df).orderBy("date").collect()]
    p75, want = np.quantile(quantities, 0.75), []
    for i, q in enumerate(quantities):
        f = 0.2 + 0.65 * (q - 10) / 30
        want.append(min(1.0, max(0.2, f * 1.15 if i and quantities[i - 1] > p75 else f)))
    assert got == pytest.approx(want)
    flat = demand.demand_index(df.withColumn("quantity", F.lit(3).cast("long")))
    assert {r.demand_index for r in flat.collect()} == {0.5}
    assert demand.index_statistics(flat).first().low_variation


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(2)
    rows = [(k, day(i * 2), rng.uniform(0, 100), rng.choice([0.0, 0.1, 0.2, rng.random()]))
            for k in ("a", "b") for i in range(45)]
    rows += [("flat", day(i), 5.0, rng.random()) for i in range(20)]
    return pd.DataFrame(rows, columns=["k", "date", "total_sales", "avg_engagement"]).assign(
        date=lambda d: pd.to_datetime(d.date).dt.date)


def test_lags_and_best_lag(spark, series):
    df = spark.createDataFrame(series)
    got = {(r.k, r.lag_days): r for r in correlation.lag_correlation(df, keys=["k"]).collect()}
    for k in ("a", "b"):
        s = series[series.k == k]
        want = [np.corrcoef(s.total_sales[lag:], s.avg_engagement[:len(s) - lag])[0, 1] for lag in range(15)]
        assert [got[k, lag].correlation for lag in range(15)] == pytest.approx(want)
        assert [got[k, lag].n_samples for lag in range(15)] == [45 - lag for lag in range(15)]
        best = correlation.best_lag(correlation.lag_correlation(df.filter(F.col("k") == k))).first()
        assert best.lag_days == int(np.argmax(np.abs(want)))
    assert [lag for key, lag in got if key == "flat"] and got["flat", 0].correlation is None
    assert ("flat", 11) not in got  # fewer than ten pairs left


def test_rolling_windows(spark, series):
    df = spark.createDataFrame(series)
    got = {(r.k, r.window_days): r for r in correlation.rolling_correlation(df, keys=["k"]).collect()}
    for k in ("a", "b"):
        s = series[series.k == k]
        for w in (7, 14, 30):
            rs = []
            for i in range(len(s) - w + 1):
                x, y = s.total_sales[i:i + w], s.avg_engagement[i:i + w]
                if x.std() > 0 and y.std() > 0:
                    rs.append(np.corrcoef(x, y)[0, 1])
            r = got[k, w]
            assert (r.avg_correlation, r.max_correlation, r.min_correlation, r.std_correlation) == pytest.approx(
                (np.mean(rs), max(rs), min(rs), np.std(rs)))
            assert r.n_windows == len(rs)
    assert not [key for key in got if key[0] == "flat"]


def test_general_correlation_skips_idle_days(spark):
    rows = [(day(i), float(i % 5), 0.1 * (i % 3)) for i in range(15)] + [(day(20), 0.0, 0.0), (day(21), None, None)]
    df = spark.createDataFrame(rows, "date date, total_sales double, avg_engagement double")
    got = {r.method: r for r in correlation.general_correlation(df).collect()}
    active = [(x, y) for _, x, y in rows if (x or 0) > 0 or (y or 0) > 0]
    assert got["pearson"].n_samples == len(active)
    assert got["pearson"].r == pytest.approx(np.corrcoef(*zip(*active))[0, 1])
    assert correlation.general_correlation(df.drop("avg_engagement")) is None


def test_products_need_ten_days_and_variation(spark):
    rng = random.Random(4)
    daily = spark.createDataFrame([(day(i), rng.random()) for i in range(12)], "date date, avg_engagement double")
    rows = [(day(i), "ok", 1, rng.random()) for i in range(12)] + [(day(i), "short", 1, rng.random()) for i in range(9)]
    rows += [(day(i), "flat", 1, 2.0) for i in range(12)] + [(day(3), None, 1, 5.0)]
    sales = spark.createDataFrame(rows, "date date, product_name string, quantity int, amount double")
    assert [r["product"] for r in correlation.correlation_by_product(sales, daily).collect()] == ["ok"]
    assert correlation.correlation_by_product(sales.drop("product_name"), daily) is None


def test_segment_weights_do_not_move_r(spark):
    rng = random.Random(8)
    daily = spark.createDataFrame([(day(i), rng.random()) for i in range(30)], "date date, avg_engagement double")
    sales = spark.createDataFrame([(day(i % 30), i % 7, f"t{i}", rng.uniform(1, 9)) for i in range(600)],
                                  "date date, customer_id int, transaction_id string, amount double")
    segments = spark.createDataFrame([(c, "VIP" if c < 3 else "Dormido") for c in range(6)], "customer_id int, segment_name string")
    plain = {r.segment: r for r in correlation.correlation_by_segment(sales, daily, segments).collect()}
    assert set(plain) == {"VIP", "Dormido"} and plain["VIP"].engagement_weight == 1.3  # customer 6 has no segment


def test_trend(spark):
    rows = [(day(i), 3.0 * i + 5 + (i % 2), float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "date date, total_sales double, avg_engagement double")
    x, y = zip(*[(e, s) for _, s, e in rows if e > 0])
    slope, intercept = np.polyfit(x, y, 1)
    r = correlation.trend(df).first()
    assert (r.slope, r.intercept, r.r_squared) == pytest.approx((slope, intercept, np.corrcoef(x, y)[0, 1] ** 2))
    assert correlation.trend(df.filter("avg_engagement > 100")).count() == 0


# -- segments ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def customers(spark):
    rng = random.Random(1)
    centers = [(10, 40, 5000), (30, 20, 1500), (200, 5, 300), (90, 8, 700)]
    rows = []
    for i in range(400):
        r, f, m = centers[i % 4]
        rows.append((i, r + rng.randrange(9), f + rng.randrange(4), m + rng.uniform(0, 90), 1.0, 5, 2))
    return spark.createDataFrame(rows, "customer_id int, recency long, frequency long, monetary double, "
                                       "avg_order_value double, total_quantity long, product_diversity long")


def test_rfm(spark):
    sales = spark.createDataFrame(
        [(1, day(0), "a", 10.0, 1, 1), (1, day(4), "b", 30.0, 2, 2), (2, day(9), None, 5.0, 3, 1), (None, day(11), "c", 1.0, 1, 1)],
        "customer_id int, date date, transaction_id string, amount double, quantity int, product_id int")
    got = {r.customer_id: tuple(r)[1:] for r in segmentation.rfm(sales).collect()}
    assert got == {1: (7, 2, 40.0, 20.0, 3, 2), 2: (2, 0, 5.0, 5.0, 3, 1)}


def test_clusters_take_the_cheapest_seed(spark, customers):
    found = segmentation.cluster(customers, seeds=(1, 2, 3, 4))
    assert found.cost == min(found.costs.values()) and found.assigned.count() == 400
    sizes = sorted(r["count"] for r in found.assigned.groupBy("segment").count().collect())
    assert sum(sizes) == 400 and len(sizes) <= 4
    z = segmentation.standardized(found.assigned).toPandas()
    inertia = sum(((g[c] - g[c].mean()) ** 2).sum() for _, g in z.groupby("segment")
                  for c in ("z_recency", "z_frequency", "z_monetary"))
    assert found.cost == pytest.approx(inertia, rel=1e-2)


def test_fits_side_by_side_cache_few_rows(spark, customers, monkeypatch):
    """Where the vectors are many only one fit at a time caches them; all fits are made and the best is taken."""
    fit, running, most, lock = segmentation.KMeans.fit, [], [], threading.Lock()

    def counted(self, *args):
        with lock:
            running.append(self)
            most.append(len(running))
        try:
            return fit(self, *args)
        finally:
            with lock:
                running.remove(self)

    monkeypatch.setattr(segmentation.KMeans, "fit", counted)
    monkeypatch.setattr(segmentation, "CACHED_ROWS", 799)
    one = segmentation.cluster(customers, seeds=(1, 2, 3, 4))
    assert max(most) == 1 and len(most) == 4
    assert set(one.costs) == {1, 2, 3, 4} and one.cost == min(one.costs.values()) == one.costs[one.seed]
    assert segmentation.fits_at_once(0, 10) == segmentation.fits_at_once(100, 10) == segmentation.PARALLEL_FITS


def test_segments_are_written_where_they_stay(spark, monkeypatch):
    sales = spark.createDataFrame([(i % 40, day(i % 9), f"t{i}", 5.0 + i, 1, i % 7) for i in range(300)],
                                  "customer_id int, date date, transaction_id string, amount double, quantity int, product_id int")
    written, write_once = [], segmentation.write_once
    monkeypatch.setattr(segmentation, "write_once", lambda df, label: written.append(label) or write_once(df, label))
    kept = {}

    def store(rfm, segments):
        kept.update(rfm=write_once(rfm, "rfm"), segments=write_once(segments, "stored"))
        return kept["rfm"], kept["segments"]

    out = segmentation.segment_customers(sales, seeds=(42,), store=store)
    assert "segments" not in written and out["rfm"] is kept["rfm"] and out["segments"] is kept["segments"]
    assert sum(r.customers for r in out["report"].collect()) == 40 == out["pca"].count()


def test_labels_follow_the_rules(spark, customers):
    given = customers.withColumn("segment", F.col("customer_id") % 4)
    got = {r.segment: r.segment_name for r in segmentation.label_segments(given).select("segment", "segment_name").distinct().collect()}
    assert got == {0: "VIP", 1: "Leal", 2: "Dormido", 3: "Ocasional"}


def test_components(spark, customers):
    scored, ratios = segmentation.principal_components(customers, 2)
    assert ratios[0] >= ratios[1] > 0 and sum(ratios) <= 1 + 1e-12
    p = scored.toPandas()
    z = segmentation.standardized(customers).toPandas()[["z_recency", "z_frequency", "z_monetary"]].to_numpy()
    values, vectors = np.linalg.eigh(np.cov(z.T, bias=True))
    assert p.pc1.var(ddof=0) == pytest.approx(values[-1]) and p.pc2.var(ddof=0) == pytest.approx(values[-2])
    v = vectors[:, -1] * np.sign(vectors[np.abs(vectors[:, -1]).argmax(), -1])
    assert p.pc1.to_numpy() == pytest.approx(z @ v, abs=1e-9)
    assert abs(np.corrcoef(p.pc1, p.pc2)[0, 1]) < 1e-9


def test_whole_segmentation(spark):
    rng = random.Random(6)
    rows = [(c, day(rng.randrange(90)), f"t{i}", rng.uniform(5, 50) * (1 + c % 3), 1, i % 9)
            for i, c in enumerate(rng.randrange(60) for _ in range(900))]
    sales = spark.createDataFrame(rows, "customer_id int, date date, transaction_id string, amount double, quantity int, product_id int")
    out = segmentation.segment_customers(sales, seeds=(42, 43))
    assert out["segments"].count() == out["rfm"].count() == out["pca"].count()
    report = out["report"].collect()
    assert sum(r.customers for r in report) == out["rfm"].count() and math.isclose(sum(r.share_pct for r in report), 100)
    assert all(len(r.actions) == 3 for r in report)
