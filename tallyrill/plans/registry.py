"""Named queries over the given tables, each with an independent SQL statement where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def add(name: str, query: Query, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = query
    if sql is not None:
        ORACLE[name] = sql


# Added before rounding, in units of the last digit: values that end exactly in a half (a mean of
# eight prices, say) would otherwise round by the last bit of their sum.
_NUDGE = 0.1234567


def tidy(df: DataFrame, digits: int = 6, **per_column: int) -> DataFrame:
    """Comparable output: rounded doubles, ISO dates, 64-bit whole numbers."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            d = per_column.get(f.name, digits)
            c = F.round(c + F.lit(_NUDGE * 10.0 ** -d), d) + F.lit(0.0)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def rnd(expr: str, digits: int, name: str) -> str:
    """SQL text of a rounded double without a negative zero."""
    return f"{rnd_value(expr, digits)} AS {name}"


def rnd_value(expr: str, digits: int) -> str:
    return f"round(CAST({expr} AS DOUBLE) + {_NUDGE * 10.0 ** -digits!r}::DOUBLE, {digits}) + 0.0"


def day(expr: str = "date", name: str = "date") -> str:
    return f"strftime({expr}, '%Y-%m-%d') AS {name}"


def pearson_p_sql(r: str, n: str) -> str:
    """Two-sided p of r by the gamma-function form of the finite t series."""
    nu, s, c2 = f"({n} - 2)", f"abs({r})", f"(1.0 - {r} * {r})"
    even = (f"{s} * list_sum(list_transform(range(0, CAST({nu} // 2 AS BIGINT)), lambda j: "
            f"exp(lgamma(j + 0.5) - lgamma(0.5) - lgamma(j + 1.0) + j * ln({c2}))))")
    odd = (f"2 / pi() * (asin({s}) + {s} * coalesce(list_sum(list_transform("
           f"range(0, CAST(({nu} - 3) // 2 + 1 AS BIGINT)), lambda j: sqrt({c2}) * "
           f"exp(j * ln({c2}) + lgamma(j + 1.0) + lgamma(1.5) - lgamma(j + 1.5)))), 0))")
    return (f"CASE WHEN {r} IS NULL THEN NULL ELSE greatest(0.0, least(1.0, 1.0 - "
            f"CASE WHEN {nu} % 2 = 0 THEN {even} ELSE {odd} END)) END")


# Views over the given tables, written for the checking database.
VIEWS = {
    "sales": """
        SELECT CAST(o_orderdate AS DATE) AS date, o_custkey AS customer_id, l_partkey AS product_id,
               p_name AS product_name, p_type AS category, n_name AS location,
               CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice / l_quantity AS unit_price,
               l_discount * 100 AS discount, l_extendedprice * (1 - l_discount) AS amount,
               l_orderkey || '-' || l_linenumber AS transaction_id,
               l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
             JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "purchases": """
        SELECT event_id AS transaction_id, CAST(ts AS DATE) AS date, user_id AS customer_id,
               length(props) AS product_id, CAST(props->>'$.k' AS BIGINT) AS quantity, value AS amount
        FROM events WHERE event_type = 'purchase'""",
    "posts": """
        SELECT event_id AS post_id, CAST(ts AS DATE) AS date,
               CASE event_type WHEN 'view' THEN 'instagram' WHEN 'click' THEN 'tiktok' ELSE 'youtube' END AS platform,
               value AS engagement_rate, CAST(props->>'$.k' AS BIGINT) AS likes, user_id % 10 AS comments
        FROM events WHERE event_type IN ('view', 'click', 'signup')""",
    "raw_posts": """
        SELECT CASE event_type WHEN 'view' THEN 'IN' WHEN 'click' THEN 'TI' ELSE 'YO' END || event_id AS id,
               CAST(ts AS DATE) AS date,
               CASE event_type WHEN 'view' THEN 'instagram' WHEN 'click' THEN 'tiktok' ELSE 'youtube' END AS platform,
               CAST(props->>'$.k' AS BIGINT) AS likes, user_id % 10 AS comments, length(event_type) AS shares,
               user_id AS audience
        FROM events WHERE event_type IN ('view', 'click', 'signup')""",
    "daily_sales": """
        SELECT date, sum(amount) AS total_sales, avg(amount) AS avg_order_value, count(amount) AS num_transactions,
               count(DISTINCT customer_id) AS unique_customers, count(DISTINCT product_id) AS unique_products,
               CAST(sum(quantity) AS BIGINT) AS total_units
        FROM purchases GROUP BY date""",
    "daily_social": """
        SELECT date, avg(engagement_rate) AS avg_engagement, sum(engagement_rate) AS total_engagement,
               coalesce(stddev_samp(engagement_rate), 0) AS std_engagement,
               CAST(sum(likes) AS BIGINT) AS total_likes, CAST(sum(comments) AS BIGINT) AS total_comments,
               string_agg(DISTINCT platform, ',' ORDER BY platform) AS platforms
        FROM posts GROUP BY date""",
    "merged": """
        SELECT s.*, coalesce(avg_engagement, 0) AS avg_engagement, coalesce(total_engagement, 0) AS total_engagement,
               coalesce(std_engagement, 0) AS std_engagement, coalesce(total_likes, 0) AS total_likes,
               coalesce(total_comments, 0) AS total_comments, platforms,
               coalesce(total_likes, 0) + coalesce(total_comments, 0) AS total_interactions
        FROM daily_sales s LEFT JOIN daily_social USING (date)""",
    "long_daily": """
        SELECT date, total_sales, coalesce(avg_engagement, 0) AS avg_engagement FROM
          (SELECT CAST(o_orderdate AS DATE) AS date, sum(l_extendedprice * (1 - l_discount)) AS total_sales
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
          LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS date, avg(l_discount) AS avg_engagement
                     FROM lineitem GROUP BY 1) USING (date)""",
    "keyed_daily": """
        SELECT series, date, total_sales, coalesce(avg_engagement, 0) AS avg_engagement FROM
          (SELECT p_type AS series, CAST(o_orderdate AS DATE) AS date,
                  sum(l_extendedprice * (1 - l_discount)) AS total_sales
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
          LEFT JOIN (SELECT p_type AS series, CAST(l_shipdate AS DATE) AS date, avg(l_discount) AS avg_engagement
                     FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2) USING (series, date)""",
    "rfm": """
        SELECT customer_id, date_diff('day', max(date), (SELECT max(date) FROM sales)) AS recency,
               count(transaction_id) AS frequency, sum(amount) AS monetary, avg(amount) AS avg_order_value,
               CAST(sum(quantity) AS BIGINT) AS total_quantity, count(DISTINCT product_id) AS product_diversity
        FROM sales GROUP BY customer_id""",
    "clustered": "SELECT rfm.*, c_mktsegment AS segment FROM rfm JOIN customer ON customer_id = c_custkey",
    "profiles": """
        SELECT segment, round_even(avg(recency), 2) AS recency, round_even(avg(frequency), 2) AS frequency,
               round_even(avg(monetary), 2) AS monetary FROM clustered GROUP BY segment""",
    "cuts": """
        SELECT quantile_cont(frequency, 0.5) AS f50, quantile_cont(frequency, 0.75) AS f75,
               quantile_cont(monetary, 0.75) AS m75, quantile_cont(recency, 0.5) AS r50,
               quantile_cont(recency, 0.75) AS r75 FROM clustered""",
    "labels_of": """
        SELECT segment, CASE WHEN frequency >= f75 AND monetary >= m75 THEN 'VIP'
                             WHEN frequency >= f50 AND recency <= r50 THEN 'Leal'
                             WHEN recency >= r75 THEN 'Dormido' ELSE 'Ocasional' END AS segment_name
        FROM profiles, cuts""",
    "segments": "SELECT clustered.*, segment_name FROM clustered JOIN labels_of USING (segment)",
    "lags": """
        SELECT lag_days, x, y FROM (
          SELECT k AS lag_days, total_sales AS x,
                 lag(avg_engagement, CAST(k AS INTEGER)) OVER (PARTITION BY k ORDER BY date) AS y
          FROM {daily}, (SELECT unnest(range(0, 15)) AS k)) WHERE y IS NOT NULL""",
    "day_totals": "SELECT date, CAST(sum(quantity) AS BIGINT) AS quantity, sum(amount) AS amount FROM sales GROUP BY date",
    "momentum": """
        SELECT *, lag(quantity) OVER (ORDER BY date) AS previous_quantity,
               (SELECT quantile_cont(quantity, 0.75) FROM day_totals) AS p75 FROM day_totals""",
    "demand": """
        SELECT date, greatest(0.2, least(1.0, (0.2 + 0.65 * (quantity - lo) / (hi - lo)) *
               CASE WHEN previous_quantity > p75 THEN 1.15 ELSE 1.0 END)) AS demand_index
        FROM momentum, (SELECT min(quantity) AS lo, max(quantity) AS hi FROM day_totals)""",
    "runs": """
        SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
               CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'error' ELSE 'failed' END AS status,
               value AS duration_seconds, CASE event_type WHEN 'error' THEN props END AS error FROM events""",
    "log": """
        SELECT event_id, user_id || ' - ' || CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'WARNING'
               ELSE 'INFO' END || ' - ' || props AS line FROM events""",
}

_NEEDS = {
    "daily_sales": ("purchases",), "daily_social": ("posts",), "merged": ("daily_sales", "daily_social"),
    "rfm": ("sales",), "clustered": ("rfm",), "profiles": ("clustered",), "cuts": ("clustered",),
    "labels_of": ("profiles", "cuts"), "segments": ("labels_of",), "day_totals": ("sales",),
    "momentum": ("day_totals",), "demand": ("momentum",),
}


def sql(body: str, *views: str, **inline: str) -> str:
    """``body`` below a WITH clause of the named views and everything they need."""
    order: list[str] = []

    def need(name: str) -> None:
        for n in _NEEDS.get(name, ()):
            need(n)
        if name not in order and name not in inline:
            order.append(name)

    for v in views:
        need(v)
    parts = [f"{n} AS ({VIEWS[n]})" for n in order] + [f"{n} AS ({b})" for n, b in inline.items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + body
