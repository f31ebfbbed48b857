"""Queries on one series or column as long as the facts: ranks, rank correlations, windows, nearest times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyrill.functions.stats import log10_p
from tallyrill.operators import correlation, index, keys, ordered, rollups, row_association
from tallyrill.plans import star
from tallyrill.plans.analysis_queries import _BY_PRODUCT, _ERFC, _PRODUCT_COLUMNS, _Z
from tallyrill.plans.registry import ORACLE, add, pearson_p_sql, rnd, sql, tidy
from tallyrill.sources import scan

_LINES = ", ".join(star.LINE_ORDER)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.table(spark, sf_dir, "lineitem")


# -- ranks and rank correlations of rows --------------------------------------------------------

_RANK = "rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"

add("w8_row_ranks",
    lambda s, d: tidy(ordered.average_ranks(_lines(s, d).select("l_orderkey", "l_linenumber", "l_extendedprice"),
                                            "l_extendedprice", "price_rank"), 2),
    f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, {rnd('l_extendedprice', 2, 'l_extendedprice')},
        {rnd(_RANK.format(c='l_extendedprice'), 2, 'price_rank')} FROM lineitem""")

add("t2_row_level",
    lambda s, d: tidy(row_association.row_association(_lines(s, d), "l_extendedprice", "l_quantity", ("pearson", "spearman"))
                      .drop("significant")),
    f"""WITH ranks AS (SELECT l_extendedprice AS x, l_quantity AS y, {_RANK.format(c='l_extendedprice')} AS rx,
        {_RANK.format(c='l_quantity')} AS ry FROM lineitem)
        SELECT method, {rnd('r', 6, 'r')}, {rnd(pearson_p_sql('r', 'n_samples'), 6, 'p_value')}, n_samples FROM (
        SELECT 'pearson' AS method, corr(x, y) AS r, count(*) AS n_samples FROM ranks
        UNION ALL SELECT 'spearman', corr(rx, ry), count(*) FROM ranks)""")

add("t3_row_level",
    lambda s, d: tidy(row_association.row_association(_lines(s, d), "l_extendedprice", "l_discount", ("kendall",))),
    f"""WITH o AS (SELECT l_extendedprice AS x, l_discount AS y FROM lineitem),
        cells AS (SELECT x, y, count(*) AS m FROM o GROUP BY ALL),
        grid AS (SELECT a.x, b.y, coalesce(m, 0) AS m FROM (SELECT DISTINCT x FROM o) a CROSS JOIN (SELECT DISTINCT y FROM o) b
                 LEFT JOIN cells c ON c.x = a.x AND c.y = b.y),
        upto AS (SELECT *, coalesce(sum(m) OVER (PARTITION BY y ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 AS before FROM grid),
        net AS (SELECT sum(a.m * b.before * CASE WHEN b.y < a.y THEN 1 ELSE -1 END) AS s FROM upto a JOIN upto b
                ON a.x = b.x AND a.y <> b.y WHERE a.m > 0),
        tie AS (SELECT c, sum(t * (t - 1) / 2) AS tie, sum(t * (t - 1) * (t - 2)) AS t0, sum(t * (t - 1) * (2 * t + 5)) AS t1
                FROM (SELECT 'x' AS c, CAST(count(*) AS DOUBLE) AS t FROM o GROUP BY x
                      UNION ALL SELECT 'y', CAST(count(*) AS DOUBLE) FROM o GROUP BY y) GROUP BY c),
        tx AS (SELECT * FROM tie WHERE c = 'x'), ty AS (SELECT * FROM tie WHERE c = 'y'),
        all_of AS (SELECT n, CAST(s AS DOUBLE) / (sqrt(n * (n - 1) / 2 - tx.tie) * sqrt(n * (n - 1) / 2 - ty.tie)) AS r, {_Z} AS z
                FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM o), net, tx, ty)
        SELECT 'kendall' AS method, {rnd('r', 6, 'r')}, {rnd(_ERFC.format(z='(z / sqrt(2.0))'), 6, 'p_value')},
        {_ERFC.format(z='(z / sqrt(2.0))')} < 0.05 AS significant, CAST(n AS BIGINT) AS n_samples FROM all_of""")

# p by the power series of the incomplete beta function, whose terms are all positive
_HALF = "(n - 2) / 2.0"
add("t5_log10_p",
    lambda s, d: tidy(star.table(s, d, "customer").select(
        "c_custkey", (F.col("c_custkey") % 2398 + 3).alias("n"),
        (F.when(F.col("c_custkey") % 2 == 0, 1).otherwise(-1) * (F.col("c_custkey") * 37 % 891 + 100) / 1000).alias("r"))
        .withColumn("log10_p", log10_p("r", "n")).select("c_custkey", "n", "log10_p")),
    f"""WITH c AS (SELECT c_custkey, c_custkey % 2398 + 3 AS n, (c_custkey * 37 % 891 + 100) / 1000.0 AS r FROM customer),
        v AS (SELECT *, CAST({_HALF} AS DOUBLE) AS a, CAST((1 - r) * (1 + r) AS DOUBLE) AS x FROM c)
        SELECT c_custkey, n, {rnd("(a * ln(x) + lgamma(a + 0.5) - lgamma(a) - lgamma(0.5) + ln(list_sum(list_transform("
        "range(0, 5000), lambda k: exp(lgamma(k + 0.5) - lgamma(0.5) - lgamma(k + 1.0) + k * ln(x)) / (a + k))))) / ln(10.0)",
        6, "log10_p")} FROM v""")

# -- windows over one long series ----------------------------------------------------------------

_CORR = """SELECT {w} AS window_days, CASE WHEN stddev_samp(x) OVER w > 0 AND stddev_samp(y) OVER w > 0
    THEN corr(x, y) OVER w END AS r, row_number() OVER (ORDER BY {by}) AS i FROM o
    WINDOW w AS (ORDER BY {by} ROWS BETWEEN {w} - 1 PRECEDING AND CURRENT ROW)"""

add("c4_rolling_long",
    lambda s, d: tidy(correlation.rolling_summary(correlation.rolling_over_rows(
        _lines(s, d), star.LINE_ORDER, "l_extendedprice", "l_quantity"))),
    f"""WITH o AS (SELECT *, l_extendedprice AS x, l_quantity AS y FROM lineitem),
        f AS ({' UNION ALL '.join(_CORR.format(w=w, by=_LINES) for w in correlation.WINDOWS)})
        SELECT CAST(window_days AS BIGINT) AS window_days, {rnd('avg(r)', 6, 'avg_correlation')},
        {rnd('max(r)', 6, 'max_correlation')}, {rnd('min(r)', 6, 'min_correlation')},
        {rnd('stddev_pop(r)', 6, 'std_correlation')}, count(*) AS n_windows
        FROM f WHERE i >= window_days AND r IS NOT NULL GROUP BY window_days""")

add("w1_w4_long",
    lambda s, d: tidy(ordered.along_windows(_lines(s, d).select(*star.LINE_ORDER), star.LINE_ORDER, {
        "previous": lambda w: F.lag("l_extendedprice", 1).over(w),
        "fortnight": lambda w: F.lag("l_extendedprice", 14).over(w),
        "gap_days": lambda w: F.datediff(F.to_date("l_shipdate"), F.to_date(F.lag("l_shipdate").over(w))),
        "mean7": lambda w: F.avg("l_extendedprice").over(w.rowsBetween(-6, 0))}, behind=14)
        .select("position", "previous", "fortnight", "gap_days", "mean7"), 4),
    f"""SELECT row_number() OVER w - 1 AS position, {rnd('lag(l_extendedprice, 1) OVER w', 4, 'previous')},
        {rnd('lag(l_extendedprice, 14) OVER w', 4, 'fortnight')},
        date_diff('day', CAST(lag(l_shipdate) OVER w AS DATE), CAST(l_shipdate AS DATE)) AS gap_days,
        {rnd(f'avg(l_extendedprice) OVER (ORDER BY {_LINES} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 4, 'mean7')}
        FROM lineitem WINDOW w AS (ORDER BY {_LINES})""")

# -- nearest time without a key ------------------------------------------------------------------

_MINUTES = 18  # an order day becomes so many minutes of the month of the events


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date"))
    seconds = days * _MINUTES * 60 + F.col("o_custkey") % (_MINUTES * 60)
    return star.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp")) + seconds).alias("at"))


def _asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = star.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_id")
    out = _asked(spark, sf_dir)
    for name in ("backward", "forward", "nearest"):
        out = ordered.nearest_in_order(out, "at", events, "ts", "event_id", name, name)
    return out.drop("at")


add("j5_asof_events", lambda s, d: tidy(_asof(s, d)),
    f"""WITH q AS (SELECT o_orderkey, TIMESTAMP '2024-01-01' + to_seconds(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE))
            * {_MINUTES * 60} + o_custkey % {_MINUTES * 60}) AS t FROM orders),
        e AS (SELECT ts, min(event_id) AS event_id FROM events GROUP BY ts),
        b AS (SELECT q.*, e.ts AS bt, e.event_id AS backward FROM q ASOF LEFT JOIN e ON q.t >= e.ts),
        f AS (SELECT b.*, e.ts AS ft, e.event_id AS forward FROM b ASOF LEFT JOIN e ON b.t <= e.ts)
        SELECT o_orderkey, backward, forward, CASE WHEN bt IS NULL THEN forward WHEN ft IS NULL THEN backward
        WHEN epoch_us(t) - epoch_us(bt) <= epoch_us(ft) - epoch_us(t) THEN backward ELSE forward END AS nearest FROM f""")

# -- position in the source ----------------------------------------------------------------------

add("g1_scan_order_ids",
    lambda s, d: tidy(keys.with_transaction_id(keys.with_position(scan.with_scan_order(
        _lines(s, d).select("l_orderkey", "l_linenumber")), list(scan.SCAN_ORDER))).drop(keys.POSITION)),
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, printf('TXN%06d', row_number() OVER () - 1)
       AS transaction_id FROM lineitem""")

# -- order of sorted tables ------------------------------------------------------------------------

add("k1_positions",
    lambda s, d: index.numbered_in_place(rollups.sorted_by_date(star.sales(
        s, d, ["date", "transaction_id"], keep_order=True), star.LINE_ORDER), "position").select("position", "transaction_id"),
    sql(f"SELECT row_number() OVER (ORDER BY date, {_LINES}) - 1 AS position, transaction_id FROM sales", "sales"))


def _ranked_products(s: SparkSession, d: str) -> DataFrame:
    found = correlation.analyze(star.long_daily(s, d), None, star.sales(s, d, _PRODUCT_COLUMNS))["by_product"]
    return index.numbered_in_place(found, "position").select("position", "product")


add("k2_positions", _ranked_products,
    sql("""SELECT row_number() OVER (ORDER BY r DESC, product) - 1 AS position, product FROM bp
        WHERE r IS NOT NULL AND NOT isnan(r)""", "sales", "long_daily", bp=_BY_PRODUCT))

add("c9_general",
    lambda s, d: tidy(correlation.report({"general": correlation.general_correlation(star.long_daily(s, d))})),
    f"SELECT 'general' AS section, method AS item, r AS value FROM ({ORACLE['c1_general']})")
