"""Queries on rollups, aggregates, joins, sorts and calendar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyrill.functions.scalar import age_text, calendar_columns, category_of, round_even, to_day
from tallyrill.operators import cleaning, correlation, demand, index, keys, reporting, rollups
from tallyrill.plans import star
from tallyrill.plans.registry import add, day, rnd, rnd_value, sql, tidy
from tallyrill.sources import sinks

MONEY = ["date", "customer_id", "product_id", "quantity", "amount"]
DAILY_COLUMNS = (f"{day()}, {rnd('total_sales', 4, 'total_sales')}, {rnd('avg_order_value', 6, 'avg_order_value')}, "
                 "num_transactions, unique_customers, unique_products, total_units")


def _merged(spark, d):
    return rollups.daily_aggregates(star.purchases(spark, d), star.posts(spark, d))


add("a1_daily_sales",
    lambda s, d: tidy(rollups.daily_sales(star.sales(s, d, MONEY)), total_sales=4),
    sql(f"""SELECT {day()}, {rnd('sum(amount)', 4, 'total_sales')}, {rnd('avg(amount)', 6, 'avg_order_value')},
        count(amount) AS num_transactions, count(DISTINCT customer_id) AS unique_customers,
        count(DISTINCT product_id) AS unique_products, CAST(sum(quantity) AS BIGINT) AS total_units
        FROM sales GROUP BY date""", "sales"))

add("a2_daily_social",
    lambda s, d: tidy(rollups.daily_social(star.posts(s, d)), total_engagement=4),
    sql(f"""SELECT {day()}, {rnd('avg_engagement', 6, 'avg_engagement')},
        {rnd('total_engagement', 4, 'total_engagement')}, {rnd('std_engagement', 6, 'std_engagement')},
        total_likes, total_comments, platforms FROM daily_social""", "daily_social"))

add("a3_sales_only_daily",
    lambda s, d: tidy(rollups.daily_aggregates(star.purchases(s, d), None), total_sales=4),
    sql(f"SELECT {DAILY_COLUMNS} FROM daily_sales", "daily_sales"))

add("j1_daily_merged",
    lambda s, d: tidy(_merged(s, d), total_sales=4, total_engagement=4),
    sql(f"""SELECT {DAILY_COLUMNS}, {rnd('avg_engagement', 6, 'avg_engagement')},
        {rnd('total_engagement', 4, 'total_engagement')}, {rnd('std_engagement', 6, 'std_engagement')},
        total_likes, total_comments, platforms, total_interactions FROM merged""", "merged"))

add("a4_day_totals",
    lambda s, d: tidy(rollups.day_totals(star.sales(s, d, ["date", "quantity", "amount"])), amount=4),
    sql(f"SELECT {day()}, quantity, {rnd('amount', 4, 'amount')} FROM day_totals", "day_totals"))

add("a5_product_day",
    lambda s, d: tidy(rollups.product_day(
        star.sales(s, d, ["date", "product_name", "quantity", "amount"]), "product_name"), product_sales=4),
    sql(f"""SELECT {day()}, product_name AS product, {rnd('sum(amount)', 4, 'product_sales')},
        CAST(sum(quantity) AS BIGINT) AS product_quantity FROM sales GROUP BY date, product_name""", "sales"))

add("j2_product_day_engagement",
    lambda s, d: tidy(correlation.attach_engagement(rollups.product_day(
        star.sales(s, d, ["date", "product_name", "quantity", "amount"]), "product_name"),
        star.long_daily(s, d)), product_sales=4),
    sql(f"""SELECT strftime(p.date, '%Y-%m-%d') AS date, product, {rnd('product_sales', 4, 'product_sales')},
        product_quantity, {rnd('coalesce(avg_engagement, 0)', 6, 'avg_engagement')} FROM
        (SELECT date, product_name AS product, sum(amount) AS product_sales,
                CAST(sum(quantity) AS BIGINT) AS product_quantity FROM sales GROUP BY 1, 2) p
        LEFT JOIN long_daily USING (date)""", "sales", "long_daily"))

add("a11_value_counts",
    lambda s, d: tidy(rollups.value_counts(star.sales(s, d, ["product_name"]), "product_name")),
    sql(f"""SELECT product_name, count(*) AS n, {rnd('count(*) * 100.0 / sum(count(*)) OVER ()', 6, 'share_pct')}
        FROM sales GROUP BY product_name""", "sales"))

add("a12_series_diagnostics",
    lambda s, d: tidy(rollups.series_diagnostics(star.long_daily(s, d)), 4, std_avg_engagement=6),
    sql(f"""SELECT count(*) AS days, count(*) FILTER (total_sales > 0) AS days_total_sales,
        {rnd('min(total_sales)', 4, 'min_total_sales')}, {rnd('max(total_sales)', 4, 'max_total_sales')},
        {rnd('stddev_samp(total_sales)', 4, 'std_total_sales')},
        count(*) FILTER (avg_engagement > 0) AS days_avg_engagement,
        {rnd('min(avg_engagement)', 4, 'min_avg_engagement')}, {rnd('max(avg_engagement)', 4, 'max_avg_engagement')},
        {rnd('stddev_samp(avg_engagement)', 6, 'std_avg_engagement')} FROM long_daily""", "long_daily"))

add("a14_distinct_counts",
    lambda s, d: rollups.distinct_counts(
        star.sales(s, d, ["customer_id", "product_id", "product_name"]), ["customer_id", "product_id", "product_name"]),
    sql("""SELECT count(DISTINCT customer_id) AS distinct_customer_id, count(DISTINCT product_id) AS distinct_product_id,
        count(DISTINCT product_name) AS distinct_product_name FROM sales""", "sales"))

add("a15_date_range",
    lambda s, d: tidy(rollups.date_range(star.sales(s, d, ["date"]))),
    sql(f"SELECT {day('min(date)', 'min_date')}, {day('max(date)', 'max_date')} FROM sales", "sales"))

add("a21_ingest_summary",
    lambda s, d: tidy(rollups.ingest_summary({
        "sales": star.purchases(s, d),
        **{p: star.posts(s, d).filter(F.col("platform") == p) for p in ("instagram", "tiktok", "youtube")}})),
    sql(f"""SELECT 'sales' AS source, count(*) AS n_rows, {day('min(date)', 'min_date')}, {day('max(date)', 'max_date')},
        CAST(NULL AS DOUBLE) AS std_engagement FROM purchases UNION ALL
        SELECT platform, count(*), strftime(min(date), '%Y-%m-%d'), strftime(max(date), '%Y-%m-%d'),
        {rnd_value('stddev_samp(engagement_rate)', 6)} FROM posts GROUP BY platform""", "purchases", "posts"))

add("k1_sorted_by_date",
    lambda s, d: tidy(rollups.sorted_by_date(star.purchases(s, d), ["transaction_id"])),
    sql(f"""SELECT transaction_id, {day()}, customer_id, product_id, quantity, {rnd('amount', 6, 'amount')}
        FROM purchases ORDER BY date, transaction_id""", "purchases"))

add("k3_top_days",
    lambda s, d: tidy(rollups.top_days(star.long_daily(s, d), 5), total_sales=4),
    sql(f"""SELECT {day()}, {rnd('avg_engagement', 6, 'avg_engagement')}, {rnd('total_sales', 4, 'total_sales')} FROM
        (SELECT * FROM long_daily ORDER BY avg_engagement DESC, date LIMIT 5)""", "long_daily"))

add("u4_distinct_values",
    lambda s, d: rollups.distinct_values(star.posts(s, d), "platform"),
    sql("SELECT DISTINCT platform FROM posts", "posts"))

add("u5_date_spine",
    lambda s, d: tidy(rollups.date_spine(star.sales(s, d, ["date"]))),
    sql("""SELECT strftime(CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE), '%Y-%m-%d')
        AS date FROM sales""", "sales"))

add("w4_date_gaps",
    lambda s, d: tidy(rollups.date_gaps(star.long_daily(s, d))),
    sql(f"""SELECT {day()}, date_diff('day', lag(date) OVER (ORDER BY date), date) AS gap_days
        FROM long_daily""", "long_daily"))

add("p9_active_days",
    lambda s, d: tidy(correlation.active_days(star.long_daily(s, d)), total_sales=4),
    sql(f"""SELECT {day()}, {rnd('total_sales', 4, 'total_sales')}, {rnd('avg_engagement', 6, 'avg_engagement')}
        FROM long_daily WHERE total_sales > 0 OR avg_engagement > 0""", "long_daily"))

add("p10_joint_days",
    lambda s, d: tidy(correlation.joint_days(star.long_daily(s, d)), total_sales=4),
    sql(f"""SELECT {day()}, {rnd('total_sales', 4, 'total_sales')}, {rnd('avg_engagement', 6, 'avg_engagement')}
        FROM long_daily WHERE total_sales > 0 AND avg_engagement > 0""", "long_daily"))


# -- cleaning ---------------------------------------------------------------------------------

_TEXT_DATES = """SELECT event_id, CASE event_type WHEN 'error' THEN props WHEN 'view' THEN strftime(ts, '%Y-%m-%d')
    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS date FROM events"""


def _text_dates(s, d):
    e = star.table(s, d, "events")
    text = (F.when(F.col("event_type") == "error", F.col("props"))
            .when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    return e.select("event_id", to_day(text).alias("date"))


add("p1_date_coercion", lambda s, d: tidy(_text_dates(s, d)),
    sql("SELECT event_id, strftime(TRY_CAST(date AS DATE), '%Y-%m-%d') AS date FROM t", t=_TEXT_DATES))

add("p6_dated_rows", lambda s, d: tidy(cleaning.drop_missing(_text_dates(s, d), ("date",))),
    sql("""SELECT event_id, strftime(TRY_CAST(date AS DATE), '%Y-%m-%d') AS date FROM t
        WHERE TRY_CAST(date AS DATE) IS NOT NULL""", t=_TEXT_DATES))

add("p2_amount",
    lambda s, d: tidy(cleaning.with_amount(star.sales(
        s, d, ["transaction_id", "quantity", "unit_price", "discount"], keep_order=True))
        .select(*star.LINE_ORDER[:4], "amount"), 4),
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        {rnd('l_extendedprice * (1 - l_discount)', 4, 'amount')} FROM lineitem""")

_HOLES = """SELECT transaction_id, nullif(customer_id, 7) AS customer_id, CASE WHEN quantity > 5 THEN date END AS date,
    quantity - 10 AS quantity, amount - 5 AS unit_price, amount - 20 AS amount FROM purchases"""


def _holes(s, d):
    p = star.purchases(s, d)
    return p.select("transaction_id", F.when(F.col("customer_id") != 7, F.col("customer_id")).alias("customer_id"),
                    F.when(F.col("quantity") > 5, F.col("date")).alias("date"),
                    (F.col("quantity") - 10).alias("quantity"), (F.col("amount") - 5).alias("unit_price"),
                    (F.col("amount") - 20).alias("amount"))


add("p3_required",
    lambda s, d: tidy(cleaning.drop_missing(_holes(s, d), ("customer_id", "date"))),
    sql(f"""SELECT transaction_id, customer_id, {day()}, quantity, {rnd('unit_price', 6, 'unit_price')},
        {rnd('amount', 6, 'amount')} FROM h WHERE customer_id IS NOT NULL AND date IS NOT NULL""",
        "purchases", h=_HOLES))

add("p3_missing_cells",
    lambda s, d: cleaning.missing_cells(_holes(s, d), ("customer_id", "date")),
    sql("""SELECT CAST(count(*) FILTER (customer_id IS NULL) + count(*) FILTER (date IS NULL) AS BIGINT)
        AS missing_cells FROM h""", "purchases", h=_HOLES))

add("p4_positive",
    lambda s, d: tidy(cleaning.keep_positive(_holes(s, d))),
    sql(f"""SELECT transaction_id, customer_id, {day()}, quantity, {rnd('unit_price', 6, 'unit_price')},
        {rnd('amount', 6, 'amount')} FROM h WHERE quantity > 0 AND unit_price > 0 AND amount > 0""",
        "purchases", h=_HOLES))

add("p4_invalid_counts",
    lambda s, d: cleaning.invalid_counts(_holes(s, d)),
    sql("""SELECT count(*) FILTER (quantity <= 0) AS invalid_quantity,
        count(*) FILTER (quantity > 0 AND unit_price <= 0) AS invalid_unit_price,
        count(*) FILTER (quantity > 0 AND unit_price > 0 AND amount <= 0) AS invalid_amount,
        count(*) FILTER (quantity > 0 AND unit_price > 0 AND amount > 0) AS rows_kept FROM h""",
        "purchases", h=_HOLES))

_FENCE = """SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
    (SELECT quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3 FROM {t})"""

add("p5_iqr",
    lambda s, d: tidy(cleaning.drop_outliers(star.purchases(s, d), "amount")),
    sql(f"""SELECT transaction_id, {day()}, customer_id, product_id, quantity, {rnd('amount', 6, 'amount')}
        FROM purchases, fence WHERE amount BETWEEN lo AND hi""", "purchases", fence=_FENCE.format(t="purchases")))

add("p5_iqr_sales",
    lambda s, d: tidy(cleaning.drop_outliers(
        star.table(s, d, "lineitem").select(*star.LINE_ORDER[:4], (F.col("l_extendedprice") * (1 - F.col("l_discount")))
                                            .alias("amount")), "amount"), 4),
    sql(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {rnd('amount', 4, 'amount')}
        FROM t, fence WHERE amount BETWEEN lo AND hi""",
        t="SELECT *, l_extendedprice * (1 - l_discount) AS amount FROM lineitem", fence=_FENCE.format(t="t")))

_CAL = """year(date) AS year, month(date) AS month, isodow(date) - 1 AS day_of_week, week(date) AS week,
    CAST(isodow(date) >= 6 AS BIGINT) AS is_weekend"""


def _clean_posts(s, d):
    parts = [cleaning.clean_social(star.raw_posts(s, d, p), p) for p in ("instagram", "tiktok", "youtube")]
    return cleaning.merge_social(parts)


add("p7_engagement_rate",
    lambda s, d: tidy(_clean_posts(s, d).select(
        F.coalesce("post_id", "video_id").alias("id"), "date", "platform", "likes", "comments", "shares",
        "engagement_rate", "year", "month", "day_of_week", "week", "is_weekend")),
    sql(f"""SELECT id, {day()}, platform, likes, comments, shares,
        CAST(round_even(CASE platform WHEN 'youtube' THEN likes + comments ELSE likes + comments + shares END
             / nullif(CAST(audience AS DOUBLE), 0), 4) AS DOUBLE) AS engagement_rate, {_CAL} FROM raw_posts""",
        "raw_posts"))

add("u1_platform_union",
    lambda s, d: tidy(_clean_posts(s, d).groupBy("platform").agg(
        F.count(F.lit(1)).alias("n"), F.count("post_id").alias("with_post_id"), F.count("video_id").alias("with_video_id"),
        F.count("followers").alias("with_followers"), F.count("views").alias("with_views"))),
    sql("""SELECT platform, count(*) AS n, count(*) FILTER (platform = 'instagram') AS with_post_id,
        count(*) FILTER (platform <> 'instagram') AS with_video_id,
        count(*) FILTER (platform = 'instagram') AS with_followers,
        count(*) FILTER (platform <> 'instagram') AS with_views FROM raw_posts GROUP BY platform""", "raw_posts"))

_LINES = ", ".join(star.LINE_ORDER)


def _lines(s, d):
    return star.table(s, d, "lineitem").select(*star.LINE_ORDER, "l_quantity")


add("u2_keep_first",
    lambda s, d: tidy(cleaning.keep_first(_lines(s, d), ["l_orderkey", "l_linenumber"], star.LINE_ORDER)
                      .drop("l_shipdate")),
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {rnd('l_extendedprice', 6, 'l_extendedprice')},
        {rnd('l_quantity', 6, 'l_quantity')} FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINES}) = 1""")

add("u3_keep_first_by_user",
    lambda s, d: tidy(cleaning.keep_first(star.posts(s, d), ["platform", "likes"], ["post_id"])),
    sql(f"""SELECT post_id, {day()}, platform, {rnd('engagement_rate', 6, 'engagement_rate')}, likes, comments
        FROM posts QUALIFY row_number() OVER (PARTITION BY platform, likes ORDER BY post_id) = 1""", "posts"))

add("q3_duplicate_rows",
    lambda s, d: cleaning.duplicate_rows(_lines(s, d), ["l_orderkey", "l_linenumber"]),
    """SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM
       (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")

add("a16_funnel",
    lambda s, d: tidy(cleaning.cleaning_funnel(
        _holes(s, d).withColumn("product_id", F.length(F.col("transaction_id").cast("string")).cast("bigint")),
        ["transaction_id"], ["transaction_id"], ("customer_id", "date"), ("quantity", "unit_price", "amount"),
        "amount")),
    sql(f"""SELECT (SELECT count(*) FROM h) AS rows_initial, (SELECT count(*) FROM h) AS rows_unique,
        (SELECT count(*) FROM h WHERE customer_id IS NOT NULL AND date IS NOT NULL) AS rows_complete,
        (SELECT count(*) FROM v) AS rows_valid, count(*) AS rows_final,
        (SELECT count(*) FROM h) - count(*) AS rows_removed,
        {rnd('((SELECT count(*) FROM h) - count(*)) * 100.0 / (SELECT count(*) FROM h)', 6, 'removed_pct')},
        count(DISTINCT customer_id) AS unique_customers, count(DISTINCT length(CAST(transaction_id AS VARCHAR)))
        AS unique_products FROM v, fence WHERE amount BETWEEN lo AND hi""", "purchases", h=_HOLES,
        v="""SELECT * FROM h WHERE customer_id IS NOT NULL AND date IS NOT NULL AND quantity > 0 AND unit_price > 0
             AND amount > 0""", fence=_FENCE.format(t="v")))


# -- row numbers and generated keys -----------------------------------------------------------

def _positioned(s, d, columns):
    return index.contiguous_index(star.sales(s, d, columns, keep_order=True), star.LINE_ORDER, "row_idx")


_POS = f"SELECT *, row_number() OVER (ORDER BY {_LINES}) - 1 AS row_idx FROM sales"

add("w5_row_index",
    lambda s, d: index.contiguous_index(_lines(s, d), star.LINE_ORDER).select(*star.LINE_ORDER[:4], "row_idx")
    .withColumn("l_linenumber", F.col("l_linenumber").cast("bigint")),
    f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
        row_number() OVER (ORDER BY {_LINES}) - 1 AS row_idx FROM lineitem""")

add("w6_factorize",
    lambda s, d: index.factorize(_positioned(s, d, ["product_name"]), "product_name", ["row_idx"], "code")
    .select("row_idx", "product_name", "code"),
    sql("""SELECT row_idx, product_name, dense_rank() OVER (ORDER BY f) - 1 AS code FROM
        (SELECT *, min(row_idx) OVER (PARTITION BY product_name) AS f FROM p)""", "sales", p=_POS))

add("g1_transaction_ids",
    lambda s, d: keys.with_transaction_id(_positioned(s, d, ["quantity"]), "row_idx")
    .select("row_idx", "transaction_id", "quantity"),
    sql("SELECT row_idx, 'TXN' || lpad(CAST(row_idx AS VARCHAR), CAST(greatest(6, length(CAST(row_idx AS VARCHAR))) AS INTEGER), '0') "
        "AS transaction_id, quantity FROM p", "sales", p=_POS))

add("g2_product_ids",
    lambda s, d: keys.with_product_id(_positioned(s, d, ["product_name"]).withColumn(
        "product_name", F.when(~F.col("product_name").startswith("red"), F.col("product_name"))), ["row_idx"])
    .select("row_idx", "product_name", "product_id"),
    sql("""SELECT row_idx, product_name, CASE WHEN product_name IS NULL THEN 0 ELSE
        dense_rank() OVER (ORDER BY CASE WHEN product_name IS NOT NULL THEN f END NULLS LAST) END AS product_id
        FROM (SELECT *, min(row_idx) OVER (PARTITION BY product_name) AS f FROM
              (SELECT row_idx, CASE WHEN NOT starts_with(product_name, 'red') THEN product_name END AS product_name
               FROM p))""", "sales", p=_POS))

_DATED = "SELECT *, row_number() OVER (ORDER BY date NULLS LAST, row_idx) - 1 AS pos FROM p"

add("g3_customer_ids",
    lambda s, d: tidy(keys.customer_id_from_location(
        keys.by_date(star.sales(s, d, ["date", "location"], keep_order=True), star.LINE_ORDER))
        .select(F.col("_dated").alias("row_idx"), "date", "location", "customer_id")),
    sql(f"""SELECT pos AS row_idx, {day()}, location, dense_rank() OVER (ORDER BY f) AS customer_id FROM
        (SELECT *, min(pos) OVER (PARTITION BY pos // 10, location) AS f FROM t)""",
        "sales", p=_POS, t=_DATED))

add("g4_customer_ids_plain",
    lambda s, d: tidy(keys.customer_id_from_order(keys.by_date(star.sales(s, d, ["date"], keep_order=True), star.LINE_ORDER))
                      .select(F.col("_dated").alias("row_idx"), "date", "customer_id")),
    sql(f"SELECT pos AS row_idx, {day()}, pos // 5 + 1 AS customer_id FROM t", "sales", p=_POS, t=_DATED))

# The keyword rules of the categories, in order.
_CATEGORY = """CASE WHEN regexp_matches(lower({c}), 'protein|whey|casein|isolate') THEN 'Protein'
    WHEN regexp_matches(lower({c}), 'creatine|bcaa|amino|glutamine|eaa') THEN 'Amino Acids'
    WHEN regexp_matches(lower({c}), 'vitamin|mineral|multivitamin|omega|fish oil') THEN 'Vitamins'
    WHEN regexp_matches(lower({c}), 'pre-workout|preworkout|pre workout|energy|caffeine') THEN 'Performance'
    WHEN regexp_matches(lower({c}), 'protein bar|bar|snack|shake') THEN 'Snacks' ELSE 'Other' END"""

add("g0_clean_sales",
    lambda s, d: tidy(cleaning.clean_sales(
        star.sales(s, d, ["date", "product_name", "location", "quantity", "unit_price", "discount"], keep_order=True),
        star.LINE_ORDER).drop("unit_price", "discount", "l_shipdate", "l_extendedprice"), 4),
    sql(f"""SELECT transaction_id, product_id, customer_id, {day()}, product_name, location, quantity,
        {rnd('amount', 4, 'amount')}, {_CATEGORY.format(c='product_name')} AS category, {_CAL},
        quarter(date) AS quarter, dayname(date) AS day_name, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
        l_partkey, l_suppkey FROM k, fence WHERE amount BETWEEN lo AND hi""", "sales", p=_POS, t=_DATED,
        k="""SELECT date, product_name, location, quantity, amount, l_orderkey, l_linenumber, l_partkey, l_suppkey,
               'TXN' || lpad(CAST(row_idx AS VARCHAR), CAST(greatest(6, length(CAST(row_idx AS VARCHAR))) AS INTEGER), '0') AS transaction_id,
               dense_rank() OVER (ORDER BY pf) AS product_id, dense_rank() OVER (ORDER BY cf) AS customer_id FROM
             (SELECT *, min(row_idx) OVER (PARTITION BY product_name) AS pf,
                     min(pos) OVER (PARTITION BY pos // 10, location) AS cf FROM t)
             QUALIFY quantity > 0 AND unit_price > 0 AND amount > 0""",
        fence=_FENCE.format(t="k")))

# -- scalar functions -------------------------------------------------------------------------

add("f4_category",
    lambda s, d: star.table(s, d, "documents").select("doc_id", category_of("text").alias("category")),
    f"SELECT doc_id, {_CATEGORY.format(c='text')} AS category FROM documents")

add("f4_category_counts",
    lambda s, d: cleaning.with_category(star.sales(s, d, ["product_name"])).groupBy("category")
    .agg(F.count(F.lit(1)).alias("n")),
    sql(f"SELECT {_CATEGORY.format(c='product_name')} AS category, count(*) AS n FROM sales GROUP BY 1", "sales"))

add("f6_f10_calendar",
    lambda s, d: tidy(star.sales(s, d, ["date"]).distinct().withColumns(calendar_columns("date", full=True))),
    sql(f"""SELECT {day()}, {_CAL}, quarter(date) AS quarter, dayname(date) AS day_name
        FROM (SELECT DISTINCT date FROM sales)""", "sales"))

add("f12_round_even",
    lambda s, d: star.table(s, d, "events").select(
        "event_id", *[round_even(F.col("value") / 8, k).alias(f"r{k}") for k in (2, 3, 4)]),
    """SELECT event_id, CAST(round_even(value / 8, 2) AS DOUBLE) AS r2, CAST(round_even(value / 8, 3) AS DOUBLE) AS r3,
       CAST(round_even(value / 8, 4) AS DOUBLE) AS r4 FROM events""")

add("f20_age",
    lambda s, d: star.table(s, d, "lineitem").select(age_text(F.col("l_quantity").cast("bigint") * 600 + F.col("l_linenumber")).alias("age"))
    .groupBy("age").agg(F.count(F.lit(1)).alias("n")),
    """SELECT CASE WHEN x < 3600 THEN CAST(x // 60 AS VARCHAR) || 'm' ELSE CAST(x // 3600 AS VARCHAR) || 'h' END AS age,
       count(*) AS n FROM (SELECT CAST(l_quantity AS BIGINT) * 600 + l_linenumber AS x FROM lineitem) GROUP BY 1""")

# -- demand index -----------------------------------------------------------------------------

_QTY = ["date", "quantity", "amount"]

add("w3_momentum",
    lambda s, d: tidy(demand.momentum_days(rollups.day_totals(star.sales(s, d, _QTY)))
                      .select("date", "quantity", "previous_quantity", "p75", "boost")),
    sql(f"""SELECT {day()}, quantity, previous_quantity, {rnd('p75', 6, 'p75')},
        coalesce(previous_quantity > p75, false) AS boost FROM momentum""", "momentum"))

add("g5_demand_index", lambda s, d: tidy(demand.demand_index(star.sales(s, d, _QTY))),
    sql(f"SELECT {day()}, {rnd('demand_index', 6, 'demand_index')} FROM demand", "demand"))

add("g6_index_statistics",
    lambda s, d: tidy(demand.index_statistics(demand.demand_index(star.sales(s, d, _QTY)))),
    sql(f"""SELECT count(*) AS days, {rnd('min(demand_index)', 6, 'min_index')}, {rnd('max(demand_index)', 6, 'max_index')},
        {rnd('avg(demand_index)', 6, 'avg_index')}, {rnd('stddev_pop(demand_index)', 6, 'std_index')},
        stddev_pop(demand_index) < 0.10 AS low_variation FROM demand""", "demand"))

_NEAR = "arg_min(i.demand_index, abs(date_diff('day', w.date, i.date)) * 2 + CAST(i.date > w.date AS BIGINT))"

add("g7_spine_index", lambda s, d: tidy(demand.index_on_spine(star.sales(s, d, _QTY))),
    sql(f"""SELECT strftime(w.date, '%Y-%m-%d') AS date, {rnd(_NEAR, 6, 'demand_index')} FROM
        (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM sales) w,
        demand i GROUP BY w.date""", "demand"))

add("j5_nearest_date",
    lambda s, d: tidy(demand.nearest_by_date(
        rollups.date_spine(star.sales(s, d, ["date"])),
        demand.demand_index(star.sales(s, d, _QTY)).filter(F.col("demand_index") > 0.6), "demand_index")),
    sql(f"""SELECT strftime(w.date, '%Y-%m-%d') AS date, {rnd(f'coalesce({_NEAR}, 0.5)', 6, 'demand_index')} FROM
        (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM sales) w
        LEFT JOIN (SELECT * FROM demand WHERE demand_index > 0.6) i ON true GROUP BY w.date""", "demand"))

# -- runs and logs ----------------------------------------------------------------------------


def runs(s, d):
    e = star.table(s, d, "events")
    status = (F.when(F.col("event_type") == "purchase", "success").when(F.col("event_type") == "error", "error")
              .otherwise("failed"))
    return e.select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), status.alias("status"),
                    F.col("value").alias("duration_seconds"),
                    F.when(F.col("event_type") == "error", F.col("props")).alias("error"))


def log_lines(s, d):
    e = star.table(s, d, "events")
    level = (F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "click", "WARNING")
             .otherwise("INFO"))
    return e.select("event_id", F.concat_ws(" - ", F.col("user_id").cast("string"), level, "props").alias("line"))


add("a19_run_statistics", lambda s, d: tidy(reporting.run_statistics(runs(s, d))),
    sql(f"""SELECT count(*) AS runs, {rnd('avg(duration_seconds)', 6, 'avg_duration')},
        {rnd('min(duration_seconds)', 6, 'min_duration')}, {rnd('max(duration_seconds)', 6, 'max_duration')},
        {rnd("count(*) FILTER (status = 'success') * 100.0 / count(*)", 6, 'success_rate')} FROM runs""", "runs"))

add("a20_log_severity", lambda s, d: reporting.log_severity(log_lines(s, d)),
    sql("""SELECT count(*) FILTER (contains(line, 'ERROR')) AS error, count(*) FILTER (contains(line, 'WARNING')) AS warning,
        count(*) FILTER (contains(line, 'INFO')) AS info FROM log""", "log"))

add("k8_log_tail", lambda s, d: reporting.log_tail(log_lines(s, d), 100, ("ERROR", "WARNING"), ("event_id",)),
    sql("""SELECT event_id, line FROM (SELECT * FROM log ORDER BY event_id DESC LIMIT 100)
        WHERE contains(line, 'ERROR') OR contains(line, 'WARNING')""", "log"))

add("p15_level_filter", lambda s, d: log_lines(s, d).filter(reporting.level_filter(("ERROR", "INFO"))),
    sql("SELECT event_id, line FROM log WHERE contains(line, 'ERROR') OR contains(line, 'INFO')", "log"))

add("k9_latest_run",
    lambda s, d: tidy(reporting.latest_run(runs(s, d), F.lit("2024-03-01 00:00:00").cast("timestamp"))),
    sql(f"""SELECT arg_max(timestamp, timestamp) AS timestamp, arg_max(status, timestamp) AS status,
        {rnd('arg_max(duration_seconds, timestamp)', 6, 'duration_seconds')},
        CAST(floor((epoch(TIMESTAMP '2024-03-01 00:00:00') - floor(epoch(CAST(max(timestamp) AS TIMESTAMP)))) / 60) AS BIGINT)
        AS age_minutes FROM runs""", "runs"))

add("s13_kept_runs",
    lambda s, d: tidy(_kept(s, d)),
    sql(f"""SELECT timestamp, status, {rnd('duration_seconds', 6, 'duration_seconds')}, error,
        row_number() OVER (ORDER BY timestamp DESC) AS run_rank FROM runs ORDER BY timestamp DESC LIMIT 50""", "runs"))


def _kept(s, d):
    return sinks.latest_runs(runs(s, d))


add("w7_success_trend",
    lambda s, d: tidy(reporting.success_trend(_kept(s, d).drop("run_rank")).drop("error")),
    sql(f"""SELECT timestamp, status, {rnd('duration_seconds', 6, 'duration_seconds')},
        CASE status WHEN 'success' THEN 'ok' WHEN 'error' THEN 'bad' ELSE 'neutral' END AS status_class,
        {rnd("avg(CAST(status = 'success' AS INTEGER)) OVER (ORDER BY timestamp DESC) * 100", 6,
             'cumulative_success_rate')}
        FROM (SELECT * FROM runs ORDER BY timestamp DESC LIMIT 50)""", "runs"))

add("r3_run_performance",
    lambda s, d: tidy(_kept(s, d).select("timestamp", "status", "duration_seconds").orderBy("timestamp")),
    sql(f"""SELECT timestamp, status, {rnd('duration_seconds', 6, 'duration_seconds')} FROM runs
        ORDER BY timestamp DESC LIMIT 50""", "runs"))
