"""Queries that send the given tables through the file sinks and scans, and the whole job."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tallyrill.operators import quality, reporting, rollups
from tallyrill.plans import job, star
from tallyrill.plans.analysis_queries import (
    _ALL_CHECKS, _BY_PRODUCT, _LAGGED, _RANKS, _all_tables, _lag_sql, _tie,
)
from tallyrill.plans.registry import VIEWS, add, day, rnd, rnd_value, sql, tidy
from tallyrill.plans.rollup_queries import _FENCE, _HOLES, _merged, log_lines, runs
from tallyrill.scratch import new_folder
from tallyrill.sources import scan, sinks

# Raw headers as a vendor would write them, in any case and with spaces.
RAW_HEADERS = {
    "date": " Date", "product_name": "Product Name", "category": "Category", "quantity": "Units Sold",
    "unit_price": "Price", "discount": "Discount", "location": "Location",
}


def raw_sales(s, d, *extra):
    df = star.sales(s, d, list(RAW_HEADERS), keep_order=True)
    return df.select(*[F.col(c).alias(h) for c, h in RAW_HEADERS.items()], *extra)


def _csv_round_trip(s, d):
    path = new_folder(s, "raw-csv") + "/sales.csv"
    sinks.write_table(raw_sales(s, d, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), path, "csv")
    back = scan.read_sales_csv(s, path)
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return tidy(back.withColumns({k: F.col(k).cast("bigint") for k in keys}))


add("s1_s3_sales_csv", _csv_round_trip,
    sql(f"""SELECT {day()}, product_name, category, quantity, {rnd('unit_price', 6, 'unit_price')},
        {rnd('discount', 6, 'discount')}, location, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
        l_partkey, l_suppkey FROM sales""", "sales"))


def _json_posts(s, d):
    parts = []
    for platform in ("instagram", "tiktok", "youtube"):
        path = new_folder(s, "raw-json") + f"/{platform}.json"
        sinks.write_json_records(star.raw_posts(s, d, platform), path)
        back = scan.read_social_json(s, path, platform, json_lines=True)
        ident, audience = ("post_id", "followers") if platform == "instagram" else ("video_id", "views")
        parts.append(back.select(F.col(ident).alias("id"), "date", F.lit(platform).alias("platform"), "likes",
                                 "comments", "shares", F.col(audience).alias("audience")))
    return tidy(parts[0].unionByName(parts[1]).unionByName(parts[2]))


add("s4_s11_social_json", _json_posts,
    sql(f"SELECT id, {day()}, platform, likes, comments, shares, audience FROM raw_posts", "raw_posts"))


# The given orders end years before the given posts begin; so many days later they overlap.
LATER = 8401


def _config(s, d, later=0):
    root = new_folder(s, "landing")
    day_name = RAW_HEADERS["date"]
    # text shrinks to a third; a file, one task's rows, is read by one task again
    sinks.write_table(raw_sales(s, d).withColumn(day_name, F.date_add(day_name, later)), f"{root}/sales.csv", "csv",
                      compression="gzip")
    social = {}
    for platform in ("instagram", "tiktok", "youtube"):
        sinks.write_json_records(star.raw_posts(s, d, platform), f"{root}/{platform}.json", "gzip")
        social[platform] = {"enabled": True, "path": f"{root}/{platform}.json", "json_lines": True}
    return {"data_sources": {"sales": {"path": f"{root}/sales.csv", "multi_line": False}, "social_media": social},
            "output": {"clean_data_path": f"{root}/out"}}


add("s5_ingest_all",
    lambda s, d: tidy(rollups.ingest_summary(scan.read_all_sources(s, job.merged_config(_config(s, d))))),
    sql(f"""SELECT 'sales' AS source, count(*) AS n_rows, {day('min(date)', 'min_date')}, {day('max(date)', 'max_date')},
        CAST(NULL AS DOUBLE) AS std_engagement FROM sales UNION ALL SELECT platform, count(*),
        strftime(min(date), '%Y-%m-%d'), strftime(max(date), '%Y-%m-%d'), CAST(NULL AS DOUBLE) FROM raw_posts GROUP BY platform""",
        "sales", "raw_posts"))


def _processed_round_trip(s, d):
    folder = new_folder(s, "processed")
    sinks.write_processed({"daily_aggregates": _merged(s, d)}, folder, "csv")
    return tidy(scan.read_processed(s, folder, "daily_aggregates", fmt="csv").select(
        "date", "total_sales", "num_transactions", "platforms", "total_interactions"), total_sales=4)


add("s6_s8_processed_tables", _processed_round_trip,
    sql(f"""SELECT {day()}, {rnd('total_sales', 4, 'total_sales')}, num_transactions, platforms, total_interactions
        FROM merged""", "merged"))


def _by_extension(s, d):
    path = new_folder(s, "loaded") + "/posts.csv"
    sinks.write_table(star.posts(s, d), path, "csv")
    return tidy(scan.load_by_extension(s, path, star.posts(s, d).schema))


add("s7_load_by_extension", _by_extension,
    sql(f"""SELECT post_id, {day()}, platform, {rnd('engagement_rate', 6, 'engagement_rate')}, likes, comments
        FROM posts""", "posts"))


def _report_round_trip(s, d):
    tables = _all_tables(s, d)
    details = quality.validate_tables(tables)
    verdicts = quality.dataset_verdicts(details, list(tables))
    path = sinks.write_validation_report(verdicts, details, new_folder(s, "reports"), datetime(2024, 2, 1))
    inner = "map<string,boolean>"
    back = s.read.schema(f"timestamp string, all_passed boolean, summary {inner}, details map<string,{inner}>").json(path)
    return (back.select("all_passed", F.explode("details").alias("dataset", "checks"))
            .select("all_passed", "dataset", F.explode("checks").alias("check", "passed")))


add("s12_validation_report", _report_round_trip,
    sql('SELECT (SELECT bool_and(passed) FROM c) AS all_passed, dataset, "check", passed FROM c',
        "purchases", "posts", "merged", h=_HOLES, c=_ALL_CHECKS))


def _history_round_trip(s, d):
    path = new_folder(s, "history")
    sinks.write_json_records(runs(s, d), path)
    sinks.append_run(s, path, "success", 1.5, None, datetime(2030, 1, 1))
    return tidy(sinks.read_kept_runs(s, path))


add("s13_s14_run_history", _history_round_trip,
    sql(f"""SELECT timestamp, status, {rnd('duration_seconds', 6, 'duration_seconds')}, error FROM
        (SELECT * FROM runs UNION ALL SELECT '2030-01-01T00:00:00', 'success', 1.5, NULL)
        ORDER BY timestamp DESC LIMIT 50""", "runs"))


def _log_round_trip(s, d):
    path = new_folder(s, "log")
    log_lines(s, d).select("line").write.text(path)
    return reporting.log_severity(scan.read_log(s, path))


add("s15_r5_log_scan", _log_round_trip,
    sql("""SELECT count(*) FILTER (contains(line, 'ERROR')) AS error, count(*) FILTER (contains(line, 'WARNING')) AS warning,
        count(*) FILTER (contains(line, 'INFO')) AS info FROM log""", "log"))


def _inventory(s, d):
    folder = new_folder(s, "inventory")
    sinks.write_processed({"posts": star.posts(s, d), "daily_aggregates": _merged(s, d)}, folder)
    files = scan.file_inventory(s, folder).filter(F.col("path").endswith(".parquet"))
    return reporting.output_sizes(files).drop("modified_at")


add("s16_r2_output_files", _inventory)


def _job_summary(s, d):
    """The whole job from files. Customers per segment and the number of correlated segments are left out:

    the files carry no customer ids, so they follow the order of rows in the files, which SQL does not see.
    """
    done = job.run_job(s, _config(s, d, LATER))
    if done is None:
        raise RuntimeError("the job failed")
    summary = job.stage_summary(done)
    return tidy(summary.filter((F.col("stage") != "segmentation") & (F.col("metric") != "analysed_by_segment")), 4)


add("r7_r9_job", _job_summary,
    sql(f"""SELECT * FROM (
        SELECT 'transformation' AS stage, 'rows_sales' AS metric, {rnd('count(*)', 4, 'value')} FROM kept
        UNION ALL SELECT 'transformation', 'rows_daily_aggregates', CAST(count(DISTINCT date) AS DOUBLE) FROM kept
        UNION ALL SELECT 'transformation', 'rows_social_media_merged', CAST(count(*) AS DOUBLE) FROM raw_posts
        UNION ALL SELECT 'transformation', 'rows_' || platform, CAST(count(*) AS DOUBLE) FROM raw_posts GROUP BY platform
        UNION ALL SELECT 'validation', 'datasets_passed', CAST(sum(CAST(ok AS INTEGER)) AS DOUBLE) FROM v
        UNION ALL SELECT 'validation', 'success_rate', {rnd_value('sum(CAST(ok AS INTEGER)) * 100.0 / count(*)', 4)} FROM v
        UNION ALL SELECT 'correlation', 'pearson_r', {rnd_value('corr(x, y)', 4)} FROM ranks
        UNION ALL SELECT 'correlation', 'spearman_r', {rnd_value('corr(rx, ry)', 4)} FROM ranks
        UNION ALL SELECT 'correlation', 'kendall_r', {rnd_value('s / (sqrt(n * (n - 1) / 2 - tx.tie) * sqrt(n * (n - 1) / 2 - ty.tie))', 4)}
          FROM (SELECT CAST(count(*) AS BIGINT) AS n FROM o), tx, ty,
               (SELECT sum(sign(a.x - b.x) * sign(a.y - b.y)) AS s FROM o a JOIN o b ON a.i < b.i)
        UNION ALL (SELECT 'correlation', 'best_lag', CAST(lag_days AS DOUBLE) FROM l ORDER BY abs(r) DESC, lag_days LIMIT 1)
        UNION ALL SELECT 'correlation', 'analysed_by_product', CAST(count(*) AS DOUBLE) FROM bp WHERE r IS NOT NULL AND NOT isnan(r))""",
        "raw_posts", sales=VIEWS["sales"], fence=_FENCE.format(t="sales"),
        kept=f"SELECT sales.* REPLACE (date + {LATER} AS date) FROM sales, fence WHERE quantity > 0 AND unit_price > 0 AND amount > 0 AND amount BETWEEN lo AND hi",
        rated="""SELECT date, round_even((likes + comments + CASE platform WHEN 'youtube' THEN 0 ELSE shares END)
                 / nullif(CAST(audience AS DOUBLE), 0), 4) AS rate FROM raw_posts""",
        job_daily="""SELECT date, total_sales, coalesce(avg_engagement, 0) AS avg_engagement
            FROM (SELECT date, sum(amount) AS total_sales FROM kept GROUP BY date)
            LEFT JOIN (SELECT date, avg(rate) AS avg_engagement FROM rated GROUP BY date) USING (date)""",
        ranks=_RANKS.format(k="", g="1", t="job_daily"),
        o="SELECT total_sales AS x, avg_engagement AS y, row_number() OVER (ORDER BY date) AS i FROM job_daily",
        tx=_tie("x", False), ty=_tie("y", False), lg=_lag_sql("job_daily"), l=_LAGGED,
        bp=_BY_PRODUCT.replace("FROM sales", "FROM kept").replace("long_daily", "job_daily"),
        v="""SELECT year(min(date)) >= 2010 AS ok FROM kept UNION ALL SELECT year(min(date)) >= 2010 FROM kept UNION ALL
             SELECT year(min(date)) >= 2010 FROM raw_posts UNION ALL
             SELECT year(min(date)) >= 2010 FROM raw_posts GROUP BY platform"""))
