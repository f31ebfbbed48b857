"""Queries on statistics, correlation, segments, quality suites and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tallyrill.functions.scalar import segment_weight
from tallyrill.functions.stats import pearson, pearson_p, significant
from tallyrill.operators import association, cleaning, correlation, quality, reporting, rollups, segmentation
from tallyrill.plans import star
from tallyrill.plans.registry import ORACLE, VIEWS, add, day, pearson_p_sql, rnd, rnd_value, sql, tidy
from tallyrill.plans.rollup_queries import _holes, _HOLES, _merged
from tallyrill.scratch import write_once

# -- tests of association ---------------------------------------------------------------------

_R = "CASE WHEN stddev_samp({x}) > 0 AND stddev_samp({y}) > 0 THEN corr({x}, {y}) END"
_R_SALES = _R.format(x="total_sales", y="avg_engagement")


def _p(r="r", n="n", name="p_value"):
    return rnd(pearson_p_sql(r, n), 6, name)


add("t1_pearson",
    lambda s, d: tidy(star.keyed_daily(s, d).groupBy("series").agg(
        pearson("total_sales", "avg_engagement").alias("r"), F.count(F.lit(1)).alias("n"))
        .withColumn("p_value", pearson_p("r", "n")).withColumn("significant", significant("p_value"))),
    sql(f"""SELECT series, {rnd('r', 6, 'r')}, n, {_p()}, {pearson_p_sql('r', 'n')} < 0.05 AS significant FROM
        (SELECT series, {_R_SALES} AS r, count(*) AS n FROM keyed_daily GROUP BY series)""", "keyed_daily"))

_RANKS = """SELECT {k}total_sales AS x, avg_engagement AS y,
    rank() OVER (PARTITION BY {g} ORDER BY total_sales)
      + (count(*) OVER (PARTITION BY {g}, total_sales) - 1) / 2.0 AS rx,
    rank() OVER (PARTITION BY {g} ORDER BY avg_engagement)
      + (count(*) OVER (PARTITION BY {g}, avg_engagement) - 1) / 2.0 AS ry FROM {t}"""

add("t2_spearman",
    lambda s, d: tidy(association.association(star.keyed_daily(s, d), "total_sales", "avg_engagement", ["series"])
                      .select("series", "n", F.col("spearman_r").alias("r"),
                              pearson_p("spearman_r", "n").alias("p_value"))),
    sql(f"""SELECT series, n, {rnd('r', 6, 'r')}, {_p()} FROM
        (SELECT series, count(*) AS n, corr(rx, ry) AS r FROM ranks GROUP BY series)""", "keyed_daily",
        ranks=_RANKS.format(k="series, ", g="series", t="keyed_daily")))

# erf of a moderate argument by its power series; the checking database has no erf.
_ERFC = ("1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 80), lambda j: "
         "CASE WHEN j % 2 = 0 THEN 1 ELSE -1 END * exp((2 * j + 1) * ln({z}) - lgamma(j + 1.0)) / (2 * j + 1)))")

_TIES = """SELECT {k}sum(t * (t - 1) / 2) AS tie, sum(t * (t - 1) * (t - 2)) AS t0, sum(t * (t - 1) * (2 * t + 5)) AS t1
    FROM (SELECT {k}count(*) AS t FROM o GROUP BY {k}{c}) {g}"""


def _tie(c, keyed):
    return _TIES.format(k="series, " if keyed else "", c=c, g="GROUP BY series" if keyed else "")


add("t3_kendall",
    lambda s, d: tidy(association.association(star.keyed_daily(s, d), "total_sales", "avg_engagement", ["series"])
                      .select("series", "n", F.col("kendall_tau").alias("tau"))),
    sql(f"""SELECT series, n, {rnd('s / (sqrt(n * (n - 1) / 2 - tx.tie) * sqrt(n * (n - 1) / 2 - ty.tie))', 6, 'tau')}
        FROM (SELECT series, count(*) AS n FROM o GROUP BY series) JOIN tx USING (series) JOIN ty USING (series)
        JOIN (SELECT a.series, sum(sign(a.x - b.x) * sign(a.y - b.y)) AS s FROM o a JOIN o b
              ON a.series = b.series AND a.i < b.i GROUP BY a.series) USING (series)""",
        "keyed_daily", o="""SELECT series, total_sales AS x, avg_engagement AS y,
        row_number() OVER (PARTITION BY series ORDER BY date) AS i FROM keyed_daily""",
        tx=_tie("x", True), ty=_tie("y", True)))

_Z = ("abs(s) / sqrt((n * (n - 1) * (2 * n + 5) - tx.t1 - ty.t1) / 18 + 2 * tx.tie * ty.tie / (n * (n - 1)) "
      "+ tx.t0 * ty.t0 / (9 * n * (n - 1) * (n - 2)))")

add("c1_general",
    lambda s, d: tidy(correlation.general_correlation(star.long_daily(s, d))),
    sql(f"""SELECT method, {rnd('r', 6, 'r')}, {rnd('p', 6, 'p_value')}, p < 0.05 AS significant, n_samples FROM (
        SELECT 'pearson' AS method, r, {pearson_p_sql('r', 'n')} AS p, n AS n_samples
          FROM (SELECT corr(x, y) AS r, count(*) AS n FROM ranks)
        UNION ALL SELECT 'spearman', r, {pearson_p_sql('r', 'n')}, n
          FROM (SELECT corr(rx, ry) AS r, count(*) AS n FROM ranks)
        UNION ALL SELECT 'kendall', tau, {_ERFC.format(z='(z / sqrt(2.0))')}, n FROM (
          SELECT n, s / (sqrt(n * (n - 1) / 2 - tx.tie) * sqrt(n * (n - 1) / 2 - ty.tie)) AS tau, {_Z} AS z
          FROM (SELECT CAST(count(*) AS BIGINT) AS n FROM o), tx, ty,
               (SELECT sum(sign(a.x - b.x) * sign(a.y - b.y)) AS s FROM o a JOIN o b ON a.i < b.i)))""",
        "long_daily", ranks=_RANKS.format(k="", g="1", t="long_daily"),
        o="SELECT total_sales AS x, avg_engagement AS y, row_number() OVER (ORDER BY date) AS i FROM long_daily",
        tx=_tie("x", False), ty=_tie("y", False)))

add("t5_pvalue",
    lambda s, d: tidy(star.table(s, d, "orders").select(
        "o_orderkey", ((F.col("o_totalprice") % 2000) / 1000 - 1).alias("r"),
        (F.col("o_custkey") % 60 + 3).alias("n")).withColumn("p_value", pearson_p("r", "n"))
        .select("o_orderkey", "n", "p_value")),
    f"""SELECT o_orderkey, n, {_p()} FROM (SELECT o_orderkey, (o_totalprice % 2000) / 1000 - 1 AS r,
        o_custkey % 60 + 3 AS n FROM orders)""")

add("t6_t7_trend",
    lambda s, d: tidy(correlation.trend(star.long_daily(s, d)), 4, r_squared=8),
    sql(f"""SELECT count(*) AS n_points, {rnd('regr_slope(total_sales, avg_engagement)', 4, 'slope')},
        {rnd('regr_intercept(total_sales, avg_engagement)', 4, 'intercept')},
        {rnd('regr_r2(total_sales, avg_engagement)', 8, 'r_squared')}
        FROM long_daily WHERE total_sales > 0 AND avg_engagement > 0""", "long_daily"))

add("c10_scatter",
    lambda s, d: tidy(correlation.scatter_points(star.long_daily(s, d)), 3, avg_engagement=6),
    sql(f"""SELECT {day()}, {rnd('avg_engagement', 6, 'avg_engagement')}, {rnd('total_sales', 3, 'total_sales')},
        {rnd('a * avg_engagement + b', 3, 'fitted')} FROM j, (SELECT regr_slope(total_sales, avg_engagement) AS a,
        regr_intercept(total_sales, avg_engagement) AS b FROM j)""", "long_daily",
        j="SELECT * FROM long_daily WHERE total_sales > 0 AND avg_engagement > 0"))

_STRENGTH = """CASE WHEN abs(r) >= 0.7 THEN 'fuerte' WHEN abs(r) >= 0.5 THEN 'moderada-fuerte'
    WHEN abs(r) >= 0.3 THEN 'moderada' WHEN abs(r) >= 0.1 THEN 'debil' ELSE 'muy debil' END AS strength,
    CASE WHEN r > 0 THEN 'positiva' ELSE 'negativa' END AS direction,
    CASE WHEN abs(r) >= 0.4 THEN 'influyen' WHEN abs(r) >= 0.2 THEN 'influencia limitada'
    ELSE 'influencia muy debil o inexistente' END AS influence"""

# -- lagged and rolling -----------------------------------------------------------------------



def _lag_sql(daily):
    return VIEWS["lags"].format(daily=daily)


_LAGGED = f"""SELECT lag_days, corr(x, y) AS r, count(*) AS n FROM lg GROUP BY lag_days HAVING count(*) >= 10"""
_LAG_OUT = f"""SELECT lag_days, {rnd('r', 6, 'correlation')}, {_p()}, {pearson_p_sql('r', 'n')} < 0.05 AS significant,
    n AS n_samples FROM l"""

add("c2_lag", lambda s, d: tidy(correlation.lag_correlation(_merged(s, d))),
    sql(_LAG_OUT, "merged", lg=_lag_sql("merged"), l=_LAGGED))

add("c2_lag_long", lambda s, d: tidy(correlation.lag_correlation(star.long_daily(s, d))),
    sql(_LAG_OUT, "long_daily", lg=_lag_sql("long_daily"), l=_LAGGED))

add("c2_lag_by_series",
    lambda s, d: tidy(correlation.lag_correlation(star.keyed_daily(s, d), keys=["series"]).drop("significant")),
    sql(f"""SELECT series, lag_days, {rnd('r', 6, 'correlation')}, {_p()}, n AS n_samples FROM (
        SELECT series, lag_days, corr(x, y) AS r, count(*) AS n FROM (
          SELECT series, k AS lag_days, total_sales AS x, lag(avg_engagement, CAST(k AS INTEGER))
                 OVER (PARTITION BY series, k ORDER BY date) AS y
          FROM keyed_daily, (SELECT unnest(range(0, 15)) AS k)) WHERE y IS NOT NULL
        GROUP BY ALL HAVING count(*) >= 10)""", "keyed_daily"))

add("w1_row_shift",
    lambda s, d: tidy(correlation.lagged_rows(star.long_daily(s, d)).groupBy("lag_days").agg(
        F.count(F.lit(1)).alias("n"), F.sum("engagement").alias("engagement"), F.sum("total_sales").alias("total_sales")),
        4, engagement=6),
    sql(f"""SELECT lag_days, count(*) AS n, {rnd('sum(y)', 6, 'engagement')}, {rnd('sum(x)', 4, 'total_sales')}
        FROM lg GROUP BY lag_days""", "long_daily", lg=_lag_sql("long_daily")))

_HORIZON = "CASE WHEN lag_days = 0 THEN 'inmediato' WHEN lag_days <= 3 THEN 'corto plazo' ELSE 'mediano plazo' END"

add("c3_best_lag", lambda s, d: tidy(correlation.best_lag(correlation.lag_correlation(star.long_daily(s, d)))),
    sql(f"""SELECT lag_days, {rnd('r', 6, 'correlation')}, {_p()}, n AS n_samples, {_HORIZON} AS horizon FROM l
        ORDER BY abs(r) DESC, lag_days LIMIT 1""", "long_daily", lg=_lag_sql("long_daily"), l=_LAGGED))

add("f17_f18_lag_bars",
    lambda s, d: tidy(correlation.lag_bars(correlation.lag_correlation(star.long_daily(s, d)))
                      .select("lag_days", "correlation", "band")),
    sql(f"""SELECT lag_days, {rnd('r', 6, 'correlation')}, CASE WHEN r > 0 THEN 'green' ELSE 'red' END AS band FROM l""",
        "long_daily", lg=_lag_sql("long_daily"), l=_LAGGED))


def _rolling_sql(daily, keys=""):
    g = f"PARTITION BY {keys} " if keys else ""
    lead = f"{keys}, " if keys else ""
    parts = []
    for w in (7, 14, 30):
        win = f"OVER ({g}ORDER BY date ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
        parts.append(f"""SELECT {lead}{w} AS window_days, date, CASE WHEN row_number() OVER ({g}ORDER BY date) >= {w}
            AND stddev_samp(total_sales) {win} > 1e-9 AND stddev_samp(avg_engagement) {win} > 1e-12
            THEN covar_samp(total_sales, avg_engagement) {win}
                 / (stddev_samp(total_sales) {win} * stddev_samp(avg_engagement) {win}) END AS r FROM {daily}""")
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE r IS NOT NULL"


_ROLL = f"""window_days, {rnd('avg(r)', 6, 'avg_correlation')}, {rnd('max(r)', 6, 'max_correlation')},
    {rnd('min(r)', 6, 'min_correlation')}, {rnd('stddev_pop(r)', 6, 'std_correlation')}, count(*) AS n_windows"""

add("c4_rolling", lambda s, d: tidy(correlation.rolling_correlation(star.long_daily(s, d))),
    sql(f"SELECT {_ROLL} FROM ro GROUP BY window_days", "long_daily", ro=_rolling_sql("long_daily")))

add("c4_rolling_events", lambda s, d: tidy(correlation.rolling_correlation(_merged(s, d))),
    sql(f"SELECT {_ROLL} FROM ro GROUP BY window_days", "merged", ro=_rolling_sql("merged")))

add("c4_rolling_by_series", lambda s, d: tidy(correlation.rolling_correlation(star.keyed_daily(s, d), keys=["series"])),
    sql(f"SELECT series, {_ROLL} FROM ro GROUP BY series, window_days", "keyed_daily",
        ro=_rolling_sql("keyed_daily", "series")))

add("w2_rolling_series", lambda s, d: tidy(correlation.rolling_series(star.long_daily(s, d))),
    sql(f"SELECT CAST(window_days AS BIGINT) AS window_days, {day()}, {rnd('r', 6, 'r')} FROM ro", "long_daily",
        ro=_rolling_sql("long_daily")))

add("c5_best_period",
    lambda s, d: tidy(correlation.best_periods(correlation.rolling_series(star.long_daily(s, d)), above=0.2)),
    sql(f"""SELECT CAST(window_days AS BIGINT) AS window_days, {day('date', 'best_date')}, {rnd('r', 6, 'r')} FROM ro
        QUALIFY row_number() OVER (PARTITION BY window_days ORDER BY r DESC, date) = 1 AND r > 0.2""",
        "long_daily", ro=_rolling_sql("long_daily")))



def _constant_side(s, d):
    """The first series has the same engagement every day, so it has no correlation and is left out."""
    daily = star.keyed_daily(s, d)
    flat = F.col("series") == F.lit(daily.agg(F.min("series")).first()[0])
    flattened = daily.withColumn("avg_engagement", F.when(flat, F.lit(1.0)).otherwise(F.col("avg_engagement")))
    return tidy(association.association(flattened, "total_sales", "avg_engagement", ["series"])
                .select("series", "n", F.col("pearson_r").alias("r")))


add("t4_constant_side", _constant_side,
    sql(f"""SELECT * FROM (SELECT series, count(*) AS n, {rnd(_R_SALES, 6, 'r')} FROM keyed_daily
        WHERE series <> (SELECT min(series) FROM keyed_daily) GROUP BY series) WHERE r IS NOT NULL""", "keyed_daily"))

# -- per product and per segment --------------------------------------------------------------

_BY_PRODUCT = f"""SELECT product, {_R.format(x='product_sales', y='e')} AS r, count(*) AS n, sum(product_sales) AS total
    FROM (SELECT product, product_sales, coalesce(avg_engagement, 0) AS e FROM
          (SELECT date, product_name AS product, sum(amount) AS product_sales FROM sales GROUP BY 1, 2)
          LEFT JOIN long_daily USING (date)) GROUP BY product HAVING count(*) >= 10"""
_PRODUCT_COLUMNS = ["date", "product_name", "quantity", "amount"]


def _by_product(s, d, daily=None):
    return correlation.correlation_by_product(star.sales(s, d, _PRODUCT_COLUMNS), daily or star.long_daily(s, d))


add("c6_by_product", lambda s, d: tidy(_by_product(s, d), total_sales=4),
    sql(f"""SELECT product, {rnd('r', 6, 'correlation')}, {_p()}, {pearson_p_sql('r', 'n')} < 0.05 AS significant,
        {rnd('total', 4, 'total_sales')}, n AS n_samples FROM b WHERE r IS NOT NULL""", "sales", "long_daily",
        b=_BY_PRODUCT))

for _n, _key in ((10, "k4_top_products"), (3, "k4_top3_products")):
    add(_key,
        lambda s, d, n=_n: tidy(correlation.strongest_first(_by_product(s, d), "product", n)
                                .select("product", "correlation")),
        sql(f"""SELECT product, {rnd('r', 6, 'correlation')} FROM b WHERE r IS NOT NULL
            ORDER BY r DESC, product LIMIT {_n}""", "sales", "long_daily", b=_BY_PRODUCT))

add("t8_interpretation",
    lambda s, d: correlation.interpretation(_by_product(s, d), "correlation").select(
        "product", "strength", "direction", "influence"),
    sql(f"SELECT product, {_STRENGTH} FROM b WHERE r IS NOT NULL", "sales", "long_daily", b=_BY_PRODUCT))


def _rfm(s, d):
    return segmentation.rfm(star.sales(s, d, ["date", "customer_id", "product_id", "quantity", "amount",
                                              "transaction_id"]))


def _clustered(s, d):
    given = star.table(s, d, "customer").select(F.col("c_custkey").alias("customer_id"),
                                                F.col("c_mktsegment").alias("segment"))
    return _rfm(s, d).join(given, "customer_id")


def _segments(s, d):
    """Customers labelled by rule, with the market segment as the given cluster."""
    return segmentation.label_segments(write_once(_clustered(s, d), "clustered"))


_RFM_OUT = f"""customer_id, recency, frequency, {rnd('monetary', 4, 'monetary')},
    {rnd('avg_order_value', 4, 'avg_order_value')}, total_quantity, product_diversity"""

add("a7_rfm", lambda s, d: tidy(_rfm(s, d), 4), sql(f"SELECT {_RFM_OUT} FROM rfm", "rfm"))

add("a8_segment_profiles", lambda s, d: tidy(segmentation.segment_profiles(_clustered(s, d))),
    sql("""SELECT segment, CAST(recency AS DOUBLE) AS recency, CAST(frequency AS DOUBLE) AS frequency,
        CAST(monetary AS DOUBLE) AS monetary FROM profiles""", "profiles"))

add("a9_label_profiles",
    lambda s, d: tidy(segmentation.segment_profiles(_segments(s, d), "segment_name", None), 4),
    sql(f"""SELECT segment_name, {rnd('avg(recency)', 4, 'recency')}, {rnd('avg(frequency)', 4, 'frequency')},
        {rnd('avg(monetary)', 4, 'monetary')} FROM segments GROUP BY segment_name""", "segments"))

add("a10_segment_report", lambda s, d: tidy(segmentation.segment_report(_segments(s, d)), 4),
    sql(f"""SELECT segment_name, count(*) AS customers, {rnd('avg(recency)', 4, 'avg_recency')},
        {rnd('avg(frequency)', 4, 'avg_frequency')}, {rnd('avg(monetary)', 4, 'avg_monetary')},
        {rnd('avg(avg_order_value)', 4, 'avg_order_value')}, {rnd('avg(product_diversity)', 4, 'avg_product_diversity')},
        {rnd('sum(monetary)', 4, 'total_value')}, {rnd('count(*) * 100.0 / sum(count(*)) OVER ()', 4, 'share_pct')}
        FROM segments GROUP BY segment_name""", "segments"))


def _quantile_rows(s, d):
    q = segmentation.rfm_quantiles(_rfm(s, d))
    return s.createDataFrame([(c, p, float(v)) for (c, p), v in q.items()], "feature string, prob double, value double")


add("a13_rfm_quantiles", lambda s, d: tidy(_quantile_rows(s, d)),
    sql(" UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({p} AS DOUBLE) AS prob, {rnd(f'quantile_cont({c}, {p})', 6, 'value')} FROM rfm"
        for c, p in (("frequency", 0.5), ("frequency", 0.75), ("monetary", 0.75), ("recency", 0.5), ("recency", 0.75))),
        "rfm"))

add("d3_labels", lambda s, d: _segments(s, d).select("customer_id", "segment", "segment_name"),
    sql("SELECT customer_id, segment, segment_name FROM segments", "segments"))

add("k7_largest_segment", lambda s, d: tidy(rollups.most_frequent(_segments(s, d), "segment_name")),
    sql(f"""SELECT segment_name, count(*) AS n, {rnd('count(*) * 100.0 / sum(count(*)) OVER ()', 6, 'share_pct')}
        FROM segments GROUP BY segment_name ORDER BY n DESC, segment_name LIMIT 1""", "segments"))

add("j6_segment_weights",
    lambda s, d: _segments(s, d).select("customer_id", segment_weight("segment_name").alias("weight")),
    sql("""SELECT customer_id, CAST(CASE segment_name WHEN 'VIP' THEN 1.3 WHEN 'Leal' THEN 1.1 WHEN 'Ocasional' THEN 0.9
        WHEN 'Dormido' THEN 0.7 ELSE 1.0 END AS DOUBLE) AS weight FROM segments""", "segments"))

add("j8_segment_strategies",
    lambda s, d: segmentation.with_strategies(segmentation.segment_report(_segments(s, d)))
    .select("segment_name", "customers", F.explode("actions").alias("action")),
    sql("""SELECT segment_name, customers, unnest(CASE segment_name
        WHEN 'VIP' THEN ['Programas de fidelidad premium', 'Lanzamientos exclusivos', 'Atención personalizada']
        WHEN 'Leal' THEN ['Incentivos para aumentar ticket promedio', 'Cross-selling de productos complementarios',
                          'Programas de referidos']
        WHEN 'Ocasional' THEN ['Campañas de retención', 'Descuentos en segunda compra', 'Email marketing educativo']
        ELSE ['Campañas de reactivación', 'Descuentos especiales de ''regreso''',
              'Encuestas para entender por qué se fueron'] END) AS action
        FROM (SELECT segment_name, count(*) AS customers FROM segments GROUP BY segment_name)""", "segments"))

_SEGMENT_SALES = ["date", "customer_id", "amount", "transaction_id"]
_SEGMENT_DAY = """SELECT date, segment_name, sum(amount) AS segment_sales, count(transaction_id) AS segment_transactions
    FROM sales JOIN (SELECT customer_id, segment_name FROM segments) USING (customer_id) GROUP BY 1, 2"""

add("j3_a6_segment_day",
    lambda s, d: tidy(correlation.segment_day(star.sales(s, d, _SEGMENT_SALES), _segments(s, d)), 4),
    sql(f"""SELECT {day()}, segment_name, {rnd('segment_sales', 4, 'segment_sales')}, segment_transactions FROM sd""",
        "sales", "segments", sd=_SEGMENT_DAY))

add("j4_segment_day_engagement",
    lambda s, d: tidy(correlation.attach_engagement(
        correlation.segment_day(star.sales(s, d, _SEGMENT_SALES), _segments(s, d)), star.long_daily(s, d)), 4,
        avg_engagement=6),
    sql(f"""SELECT strftime(sd.date, '%Y-%m-%d') AS date, segment_name, {rnd('segment_sales', 4, 'segment_sales')},
        segment_transactions, {rnd('coalesce(avg_engagement, 0)', 6, 'avg_engagement')} FROM sd
        LEFT JOIN long_daily USING (date)""", "sales", "segments", "long_daily", sd=_SEGMENT_DAY))


def _by_segment(s, d, daily=None):
    return correlation.correlation_by_segment(
        star.sales(s, d, _SEGMENT_SALES), daily or star.long_daily(s, d), _segments(s, d))


_BY_SEGMENT = """SELECT segment_name AS segment, corr(segment_sales, e) AS r, count(*) AS n, avg(segment_sales) AS a FROM
    (SELECT segment_name, segment_sales, coalesce(avg_engagement, 0) AS e FROM sd LEFT JOIN long_daily USING (date))
    GROUP BY segment_name HAVING count(*) >= 10"""

add("c7_by_segment", lambda s, d: tidy(_by_segment(s, d), avg_sales=4),
    sql(f"""SELECT segment, {rnd('r', 6, 'correlation')}, {_p()}, {pearson_p_sql('r', 'n')} < 0.05 AS significant,
        n AS n_samples, {rnd('a', 4, 'avg_sales')}, CAST(CASE segment WHEN 'VIP' THEN 1.3 WHEN 'Leal' THEN 1.1
        WHEN 'Ocasional' THEN 0.9 WHEN 'Dormido' THEN 0.7 ELSE 1.0 END AS DOUBLE) AS engagement_weight FROM b""",
        "sales", "segments", "long_daily", sd=_SEGMENT_DAY, b=_BY_SEGMENT))

add("f17_segment_bars",
    lambda s, d: tidy(correlation.segment_bars(_by_segment(s, d)).select("segment", "correlation", "band")),
    sql(f"""SELECT segment, {rnd('r', 6, 'correlation')}, CASE WHEN r >= 0.5 THEN 'strong' WHEN r >= 0.3 THEN 'moderate'
        ELSE 'weak' END AS band FROM b""", "sales", "segments", "long_daily", sd=_SEGMENT_DAY, b=_BY_SEGMENT))


def _report(s, d):
    daily = write_once(star.long_daily(s, d), "daily")  # four analyses read it
    return tidy(correlation.report({
        "lag": correlation.lag_correlation(daily), "rolling": correlation.rolling_correlation(daily),
        "by_product": _by_product(s, d, daily), "by_segment": _by_segment(s, d, daily)}))



def _analyses(s, d):
    """(analysis, item, value) of all five analyses together."""
    daily = write_once(star.long_daily(s, d), "daily")
    found = correlation.analyze(daily, _segments(s, d), star.sales(s, d))
    item = {"general": ("method", "r"), "lag": ("lag_days", "correlation"), "rolling": ("window_days", "avg_correlation"),
            "by_segment": ("segment", "correlation"), "by_product": ("product", "correlation")}
    return tidy(reduce(DataFrame.unionByName, [
        found[a].select(F.lit(a).alias("analysis"), F.col(i).cast("string").alias("item"), F.col(v).alias("value"))
        for a, (i, v) in item.items()]))


add("c8_full_analysis", _analyses, " UNION ALL ".join(
    f"SELECT '{a}' AS analysis, CAST({i} AS VARCHAR) AS item, {v} AS value FROM ({ORACLE[q]})" for a, q, i, v in (
        ("general", "c1_general", "method", "r"), ("lag", "c2_lag_long", "lag_days", "correlation"),
        ("rolling", "c4_rolling", "window_days", "avg_correlation"), ("by_segment", "c7_by_segment", "segment", "correlation"),
        ("by_product", "c6_by_product", "product", "correlation"))))

add("c9_report", _report,
    sql(f"""SELECT * FROM (
        SELECT 'rolling_avg' AS section, CAST(window_days AS VARCHAR) AS item, {rnd('avg(r)', 6, 'value')}
          FROM ro GROUP BY window_days
        UNION ALL SELECT 'rolling_max', CAST(window_days AS VARCHAR), {rnd_value('max(r)', 6)} FROM ro GROUP BY window_days
        UNION ALL (SELECT 'best_lag', CAST(lag_days AS VARCHAR), {rnd_value('r', 6)} FROM l
                   ORDER BY abs(r) DESC, lag_days LIMIT 1)
        UNION ALL (SELECT 'top_product', product, {rnd_value('r', 6)} FROM bp WHERE r IS NOT NULL
                   ORDER BY r DESC, product LIMIT 3)
        UNION ALL SELECT 'segment', segment, {rnd_value('r', 6)} FROM b)""",
        "sales", "segments", "long_daily", ro=_rolling_sql("long_daily"), lg=_lag_sql("long_daily"), l=_LAGGED,
        bp=_BY_PRODUCT, sd=_SEGMENT_DAY, b=_BY_SEGMENT))

# -- clusters and components: no SQL says these ------------------------------------------------


def _kmeans(s, d):
    customers = _rfm(s, d)
    assigned = segmentation.cluster(customers).assigned
    return tidy(rollups.value_counts(assigned, "segment"), 4)


def _components(s, d):
    customers = _rfm(s, d)
    return tidy(segmentation.principal_components(customers, 2)[0].select("customer_id", "pc1", "pc2"), 5)


def _zscores(s, d):
    customers = _rfm(s, d)
    return tidy(segmentation.standardized(customers).select("customer_id", "z_recency", "z_frequency", "z_monetary"))


add("d1_zscores", _zscores,
    sql("SELECT customer_id, " + ", ".join(
        rnd(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()", 6, f"z_{c}")
        for c in ("recency", "frequency", "monetary")) + " FROM rfm", "rfm"))
add("d2_kmeans", _kmeans)


def _cluster_checks(s, d):
    """What holds for any good clustering, whichever way its clusters are numbered.

    A fit stops when centres move less than a small distance, so a customer counts as misplaced if the
    mean of another cluster is nearer by ten times that distance.
    """
    found = segmentation.cluster(_rfm(s, d))
    scaled = segmentation.standardized(found.assigned)
    z = [f"z_{c}" for c in segmentation.FEATURES]
    means = scaled.groupBy("segment").agg(*[F.avg(c).alias(c) for c in z]).collect()  # one row per cluster
    away = {m["segment"]: sum(((F.col(c) - F.lit(m[c])) ** 2 for c in z), F.lit(0.0)) for m in means}
    own = F.coalesce(*[F.when(F.col("segment") == k, v) for k, v in away.items()])
    slack = F.sqrt(own) - F.sqrt(F.array_min(F.array(*away.values()))) > 10 * segmentation.CENTER_SHIFT
    around = F.sum(own)
    return scaled.agg(
        F.count(F.lit(1)).alias("customers"), F.lit(len(means)).cast("bigint").alias("clusters"),
        F.lit(len(found.costs)).cast("bigint").alias("starts"), F.count(F.when(slack, 1)).alias("misplaced"),
        around.between(0.98 * found.cost, found.cost * (1 + 1e-9)).alias("cost_agrees"),
        F.lit(all(found.cost <= c for c in found.costs.values())).alias("best_start"))


add("d2_d5_cluster_checks", _cluster_checks,
    sql("""SELECT count(*) AS customers, CAST(least(4, count(DISTINCT (recency, frequency, monetary))) AS BIGINT) AS clusters,
        CAST(10 AS BIGINT) AS starts, CAST(0 AS BIGINT) AS misplaced, true AS cost_agrees, true AS best_start FROM rfm""", "rfm"))

# First two eigenvectors of the 3x3 correlation matrix by power iteration with deflation.
_STEP = """SELECT k + 1 AS k, p / sqrt(p * p + q * q + w * w) AS a, q / sqrt(p * p + q * q + w * w) AS b,
    w / sqrt(p * p + q * q + w * w) AS c FROM (SELECT k, {m}11 * a + {m}12 * b + {m}13 * c AS p,
    {m}12 * a + {m}22 * b + {m}23 * c AS q, {m}13 * a + {m}23 * b + {m}33 * c AS w FROM {me}, {t} WHERE k < 400)"""
_SIGN = """SELECT a * s AS a, b * s AS b, c * s AS c FROM (SELECT *, CASE WHEN abs(a) >= abs(b) AND abs(a) >= abs(c)
    THEN sign(a) WHEN abs(b) >= abs(c) THEN sign(b) ELSE sign(c) END AS s FROM {me} WHERE k = 400)"""

add("d4_pca", _components,
    "WITH RECURSIVE" + sql(f"""SELECT customer_id, {rnd('x * v1.a + y * v1.b + z * v1.c', 5, 'pc1')},
        {rnd('x * v2.a + y * v2.b + z * v2.c', 5, 'pc2')} FROM zs, v1, v2""", "rfm",
        zs="SELECT customer_id, " + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {n}" for c, n in (
            ("recency", "x"), ("frequency", "y"), ("monetary", "z"))) + " FROM rfm",
        m="""SELECT avg(x * x) AS c11, avg(x * y) AS c12, avg(x * z) AS c13, avg(y * y) AS c22, avg(y * z) AS c23,
             avg(z * z) AS c33 FROM zs""",
        p1="SELECT 0 AS k, 0.5::DOUBLE AS a, 0.6::DOUBLE AS b, 0.7::DOUBLE AS c UNION ALL " + _STEP.format(m="c", me="p1", t="m"),
        v1=_SIGN.format(me="p1"),
        m2="""SELECT c11 - l * a * a AS e11, c12 - l * a * b AS e12, c13 - l * a * c AS e13, c22 - l * b * b AS e22,
              c23 - l * b * c AS e23, c33 - l * c * c AS e33 FROM (SELECT *, a * (c11 * a + c12 * b + c13 * c)
              + b * (c12 * a + c22 * b + c23 * c) + c * (c13 * a + c23 * b + c33 * c) AS l FROM m, v1)""",
        p2="SELECT 0 AS k, 0.9::DOUBLE AS a, 0.1::DOUBLE AS b, -0.3::DOUBLE AS c UNION ALL " + _STEP.format(m="e", me="p2", t="m2"),
        v2=_SIGN.format(me="p2")).removeprefix("WITH"))
add("d6_segmentation",
    lambda s, d: tidy(segmentation.segment_customers(
        star.sales(s, d, ["date", "customer_id", "product_id", "quantity", "amount", "transaction_id"]))["report"].drop("actions"), 2))


def _segment_totals(s, d):
    """Figures of the segmentation that do not depend on how customers fall into segments."""
    report = segmentation.segment_customers(
        star.sales(s, d, ["date", "customer_id", "product_id", "quantity", "amount", "transaction_id"]))["report"]
    return tidy(report.agg(
        F.sum("customers").alias("customers"), F.sum("total_value").alias("total_value"),
        F.sum("share_pct").alias("share_pct"), F.count(F.when(F.col("actions").isNull(), 1)).alias("without_actions")), 2)


add("d6_segment_totals", _segment_totals,
    sql(f"""SELECT count(*) AS customers, {rnd('sum(monetary)', 2, 'total_value')}, CAST({rnd_value('100', 2)} AS DOUBLE) AS share_pct,
        CAST(0 AS BIGINT) AS without_actions FROM rfm""", "rfm"))

# -- quality suites ---------------------------------------------------------------------------


def _check(dataset, name, passed, observed):
    return f"SELECT '{dataset}' AS dataset, '{name}' AS \"check\", {passed} AS passed, CAST({observed} AS BIGINT) AS observed"


def _dates(dataset, table):
    return (_check(dataset, "dates", "year(min(date)) >= 2010 AND year(max(date)) <= 2030", "year(max(date))")
            + f" FROM {table}")


def _count_zero(dataset, name, table, expr):
    return _check(dataset, name, f"{expr} = 0", expr) + f" FROM {table}"


def _at_least(dataset, name, table, column, n):
    e = f"count(DISTINCT {column})"
    return _check(dataset, name, f"{e} >= {n}", e) + f" FROM {table}"


_Q9 = " UNION ALL ".join([
    _check("sales", "required_columns", "true", "0"),
    _count_zero("sales", "nulls", "sales", "count(*) FILTER (customer_id IS NULL) + count(*) FILTER (product_id IS NULL)"
                " + count(*) FILTER (date IS NULL)"),
    _count_zero("sales", "duplicates", "sales", "(count(*) - count(DISTINCT transaction_id))"),
    _count_zero("sales", "ranges", "sales", "count(*) FILTER (quantity < 0) + count(*) FILTER (unit_price < 0)"
                " + count(*) FILTER (amount < 0)"),
    _dates("sales", "sales"),
    _at_least("sales", "unique_customers", "sales", "customer_id", 10),
    _at_least("sales", "unique_products", "sales", "product_id", 5),
])

_SUITE_SALES = ["date", "customer_id", "product_id", "quantity", "unit_price", "amount", "transaction_id"]

add("q9_sales_suite", lambda s, d: quality.suite(star.sales(s, d, _SUITE_SALES), "sales"), sql(_Q9, "sales"))

_QH = " UNION ALL ".join([
    _check("sales", "required_columns", "false", "1"),
    _count_zero("sales", "nulls", "h", "count(*) FILTER (customer_id IS NULL) + count(*) FILTER (date IS NULL)"),
    _count_zero("sales", "duplicates", "h", "(count(*) - count(DISTINCT transaction_id))"),
    _count_zero("sales", "ranges", "h", "count(*) FILTER (quantity < 0) + count(*) FILTER (unit_price < 0)"
                " + count(*) FILTER (amount < 0)"),
    _dates("sales", "h"),
    _at_least("sales", "unique_customers", "h", "customer_id", 10),
    _check("sales", "unique_products", "true", "NULL"),
])

add("q1_q7_failing_sales", lambda s, d: quality.suite(_holes(s, d), "sales"), sql(_QH, "purchases", h=_HOLES))


def _platform_suite(p):
    t = f"(SELECT * FROM raw_posts WHERE platform = '{p}')"
    return [_check(p, "required_columns", "true", "0"),
            _count_zero(p, "nulls", t, "count(*) FILTER (date IS NULL)"),
            _check(p, "ranges", "true", "0"), _dates(p, t)]


def _platforms(s, d):
    return {p: cleaning.clean_social(star.raw_posts(s, d, p), p) for p in ("instagram", "tiktok", "youtube")}


add("q10_platform_suites", lambda s, d: quality.validate_tables(_platforms(s, d)),
    sql(" UNION ALL ".join(c for p in ("instagram", "tiktok", "youtube") for c in _platform_suite(p)), "raw_posts"))

_Q11 = [
    _check("social_media_merged", "required_columns", "true", "0"),
    _count_zero("social_media_merged", "nulls", "posts", "count(*) FILTER (date IS NULL) + count(*) FILTER (platform IS NULL)"),
    _count_zero("social_media_merged", "ranges", "posts", "count(*) FILTER (engagement_rate < 0)"),
    _dates("social_media_merged", "posts"),
    _at_least("social_media_merged", "platforms", "posts", "platform", 1),
]
add("q11_merged_suite", lambda s, d: quality.suite(star.posts(s, d), "social_media_merged"),
    sql(" UNION ALL ".join(_Q11), "posts"))


def _daily_suite(t):
    return [
        _check("daily_aggregates", "required_columns", "true", "0"),
        _count_zero("daily_aggregates", "nulls", t, "count(*) FILTER (date IS NULL)"),
        _count_zero("daily_aggregates", "ranges", t,
                    "count(*) FILTER (total_sales < 0) + count(*) FILTER (num_transactions < 0)"),
        _dates("daily_aggregates", t),
        _check("daily_aggregates", "date_continuity", "coalesce(max(g) <= 30, true)", "max(g)")
        + f" FROM (SELECT date_diff('day', lag(date) OVER (ORDER BY date), date) AS g FROM {t})",
    ]


add("q12_daily_suite", lambda s, d: quality.suite(_merged(s, d), "daily_aggregates"),
    sql(" UNION ALL ".join(_daily_suite("merged")), "merged"))

_ALL_CHECKS = " UNION ALL ".join([_QH, *_Q11, *_daily_suite("merged")])


def _all_tables(s, d):
    return {"sales": _holes(s, d), "social_media_merged": star.posts(s, d), "daily_aggregates": _merged(s, d)}


def _verdicts(s, d):
    tables = _all_tables(s, d)
    return quality.dataset_verdicts(quality.validate_tables(tables), list(tables))


add("q13_verdicts", _verdicts,
    sql("SELECT dataset, bool_and(passed) AS passed FROM c GROUP BY dataset", "purchases", "posts", "merged",
        h=_HOLES, c=_ALL_CHECKS))

add("q15_success_rate", lambda s, d: tidy(quality.overall(_verdicts(s, d))),
    sql(f"""SELECT count(*) FILTER (passed) AS passed, count(*) AS total,
        {rnd('count(*) FILTER (passed) * 100.0 / count(*)', 6, 'success_rate')}, bool_and(passed) AS all_passed
        FROM (SELECT dataset, bool_and(passed) AS passed FROM c GROUP BY dataset)""", "purchases", "posts", "merged",
        h=_HOLES, c=_ALL_CHECKS))

add("q6_freshness",
    lambda s, d: quality.run_checks(star.posts(s, d), "posts", [
        quality.fresh(star.posts(s, d), F.lit("2024-06-01").cast("date")),
        quality.fresh(star.posts(s, d), F.lit("2026-06-01").cast("date"), name="freshness_later")]),
    sql("""SELECT 'posts' AS dataset, 'freshness' AS "check", date_diff('day', max(date), DATE '2024-06-01') <= 365 AS passed,
        date_diff('day', max(date), DATE '2024-06-01') AS observed FROM posts UNION ALL
        SELECT 'posts', 'freshness_later', date_diff('day', max(date), DATE '2026-06-01') <= 365,
        date_diff('day', max(date), DATE '2026-06-01') FROM posts""", "posts"))

add("a11_platform_distribution", lambda s, d: tidy(rollups.value_counts(star.posts(s, d), "platform")),
    sql(f"""SELECT platform, count(*) AS n, {rnd('count(*) * 100.0 / sum(count(*)) OVER ()', 6, 'share_pct')}
        FROM posts GROUP BY platform""", "posts"))

# -- overview ---------------------------------------------------------------------------------


def _overview(s, d):
    daily = write_once(star.long_daily(s, d), "daily")
    return reporting.overview(
        star.sales(s, d, ["amount", "customer_id", "product_name"]), star.posts(s, d), daily,
        correlation.general_correlation(daily), _segments(s, d), correlation.lag_correlation(daily))


add("r1_overview", _overview,
    sql(f"""SELECT * FROM (
        SELECT 'sales' AS section, 'transactions' AS item, CAST(count(*) AS VARCHAR) AS value FROM sales
        UNION ALL SELECT 'sales', 'revenue', CAST(CAST(sum(amount) AS DECIMAL(38, 2)) AS VARCHAR) FROM sales
        UNION ALL SELECT 'sales', 'customers', CAST(count(DISTINCT customer_id) AS VARCHAR) FROM sales
        UNION ALL SELECT 'sales', 'products', CAST(count(DISTINCT product_name) AS VARCHAR) FROM sales
        UNION ALL SELECT 'social', 'posts', CAST(count(*) AS VARCHAR) FROM posts
        UNION ALL SELECT 'social', 'platforms', string_agg(DISTINCT platform, ', ' ORDER BY platform) FROM posts
        UNION ALL SELECT 'daily', 'days', CAST(count(*) AS VARCHAR) FROM long_daily
        UNION ALL SELECT 'correlation', 'r', CAST(CAST(r AS DECIMAL(18, 6)) AS VARCHAR) FROM g
        UNION ALL SELECT 'correlation', 'direction', CASE WHEN r > 0 THEN 'Positiva' ELSE 'Negativa' END FROM g
        UNION ALL SELECT 'correlation', 'significance',
          CASE WHEN {pearson_p_sql('r', 'n')} < 0.05 THEN 'Significativa' ELSE 'No significativa' END FROM g
        UNION ALL SELECT 'segments', 'largest_segment', segment_name FROM top
        UNION ALL SELECT 'segments', 'customers', CAST(n AS VARCHAR) FROM top
        UNION ALL SELECT 'lag', 'lag_days', CAST(lag_days AS VARCHAR) FROM bl
        UNION ALL SELECT 'lag', 'horizon', {_HORIZON} FROM bl)""",
        "sales", "posts", "long_daily", "segments",
        g="SELECT corr(total_sales, avg_engagement) AS r, count(*) AS n FROM long_daily",
        top="SELECT segment_name, count(*) AS n FROM segments GROUP BY 1 ORDER BY n DESC, 1 LIMIT 1",
        lg=_lag_sql("long_daily"), l=_LAGGED, bl="SELECT * FROM l ORDER BY abs(r) DESC, lag_days LIMIT 1"))

add("a18_summary",
    lambda s, d: tidy(star.sales(s, d, ["amount", "customer_id", "product_name"]).agg(
        *reporting.sales_figures(["amount", "customer_id", "product_name"])).withColumn(
            "revenue", F.col("revenue").cast("double"))),
    sql("""SELECT count(*) AS transactions, CAST(CAST(sum(amount) AS DECIMAL(38, 2)) AS DOUBLE) AS revenue,
        count(DISTINCT customer_id) AS customers, count(DISTINCT product_name) AS products FROM sales""", "sales"))
