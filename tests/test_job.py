"""Sources, sinks and the whole job on files."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tallyrill import scratch
from tallyrill.operators import reporting
from tallyrill.plans import job
from tallyrill.sources import scan, sinks

START = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    rng = random.Random(9)
    root = tmp_path_factory.mktemp("landing")
    lines = [" Date ,Product Name,Units Sold,Price,Discount,LOCATION,Platform"]
    for i in range(600):
        day = START + dt.timedelta(days=rng.randrange(60))
        name = rng.choice(["Whey Protein", "BCAA", "Vitamin C", "Pre-Workout", "Zinc", "Shake"])
        units = rng.choice(["NA", "0", "-2"]) if i % 50 == 0 else str(rng.randrange(1, 40))
        lines.append(f"{'bad date' if i % 97 == 0 else day},{name},{units},{rng.uniform(5, 60):.2f},"
                     f"{rng.choice([0, 5, 10])},{rng.choice(['Canada', 'UK', 'USA'])},Web")
    (root / "sales.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    for platform, ident, audience in (("instagram", "post_id", "followers"), ("tiktok", "video_id", "views")):
        posts = [{ident: f"{platform}{i}", "date": f"{START + dt.timedelta(days=rng.randrange(60))}T00:00:00.000",
                  "likes": rng.randrange(500), "comments": rng.randrange(50), "shares": rng.randrange(20),
                  audience: rng.randrange(1000, 9000), "engagement_rate": round(rng.random() / 10, 4)} for i in range(150)]
        (root / f"{platform}.json").write_text(json.dumps(posts + posts[:5]), encoding="utf-8")
    return root


def config(landing, out):
    social = {p: {"enabled": True, "path": str(landing / f"{p}.json")} for p in ("instagram", "tiktok", "youtube")}
    return {"data_sources": {"sales": {"path": str(landing / "sales.csv")}, "social_media": social},
            "output": {"clean_data_path": str(out)}}


def test_sales_scan(spark, landing):
    df = scan.read_sales_csv(spark, str(landing / "sales.csv"))
    assert df.columns == ["date", "product_name", "quantity", "unit_price", "discount", "location", "platform"]
    assert dict(df.dtypes)["quantity"] == "bigint" and dict(df.dtypes)["date"] == "date"
    assert df.count() == 600 and 0 < df.filter("date IS NULL").count() < 20


def test_missing_tokens_and_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text('Date,Product Name,Units Sold,Price\n2024-01-01,"two\nlines",3.0,1.5\n2024-01-02,N/A,,nan\n', encoding="utf-8")
    rows = scan.read_sales_csv(spark, str(path)).collect()
    assert [(r.product_name, r.quantity, r.unit_price) for r in rows] == [("two\nlines", 3, 1.5), (None, None, None)]


def test_clashing_headers_are_refused(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("Price,Unit Price\n1,2\n", encoding="utf-8")
    with pytest.raises(scan.DuplicateColumn):
        scan.read_sales_csv(spark, str(path))


def test_social_scan(spark, landing):
    df = scan.read_social_json(spark, str(landing / "instagram.json"), "instagram")
    assert df.count() == 155 and df.filter("date IS NULL").count() == 0 and dict(df.dtypes)["date"] == "date"
    assert scan.read_social_json(spark, "nowhere", "instagram", enabled=False) is None


def test_absent_files(spark, tmp_path):
    assert scan.read_run_history(spark, str(tmp_path / "none")).count() == 0
    assert scan.load_by_extension(spark, str(tmp_path / "none.csv")) is None
    assert scan.read_processed(spark, str(tmp_path), "sales", required=False) is None
    with pytest.raises(FileNotFoundError):
        scan.read_processed(spark, str(tmp_path), "sales")


def test_run_history_keeps_the_newest(spark, tmp_path):
    path = str(tmp_path / "history")
    for i in range(4):
        sinks.append_run(spark, path, "success" if i % 2 else "error", float(i), None, dt.datetime(2024, 1, 1 + i))
    kept = sinks.read_kept_runs(spark, path, keep=3)
    assert sorted(r.duration_seconds for r in kept.collect()) == [1.0, 2.0, 3.0]
    trend = reporting.success_trend(kept).orderBy(F.col("timestamp").desc()).collect()
    assert [round(r.cumulative_success_rate, 2) for r in trend] == [100.0, 50.0, 66.67]
    last = reporting.latest_run(kept, F.lit("2024-01-06 00:30:00").cast("timestamp")).first()
    assert last.age_minutes == 2 * 24 * 60 + 30 and last.status == "success"


def test_log_tail_comes_before_the_level_filter(spark, tmp_path):
    path = tmp_path / "run.log"
    path.write_text("".join(f"{i} - {'ERROR' if i < 5 else 'INFO'} - x\n" for i in range(20)), encoding="utf-8")
    log = scan.read_log(spark, str(path))
    assert reporting.log_tail(log, 10, ("ERROR",)).count() == 0
    assert reporting.log_tail(log, 10, ("INFO",)).count() == 10
    assert tuple(reporting.log_severity(log).first()) == (5, 0, 15)


def test_whole_job(spark, landing, tmp_path):
    done = job.run_job(spark, config(landing, tmp_path / "out"))
    assert done["stats"].status == "completed" and done["stats"].stages_completed == list(job.STAGES)
    assert set(done["data"]) == {"sales", "instagram", "tiktok", "social_media_merged", "daily_aggregates"}
    sales = done["data"]["sales"]
    assert sales.filter("quantity <= 0 OR amount <= 0 OR date IS NULL").isEmpty()
    assert {"customer_id", "product_id", "transaction_id", "category", "week"} <= set(sales.columns)
    assert not [c for c in sales.columns if c.startswith("_")]
    assert done["data"]["instagram"].count() == 150
    assert done["completeness"].first().status == "OK" and done["missing_outputs"] == []
    report = json.loads(spark.read.text(done["report_path"]).first().value)
    assert set(report["summary"]) == set(done["data"]) and len(report["details"]["sales"]) == 7
    found = done["correlation"]
    assert found["lag"].count() == 15 and found["rolling"].count() == 3 and found["general"].count() == 3
    assert found["by_product"].count() == 6 and found["by_segment"].count() >= 1
    summary = {(r.stage, r.metric): r.value for r in job.stage_summary(done).collect()}
    assert summary["transformation", "rows_sales"] == sales.count()
    assert {r.section for r in job.job_overview(done).collect()} == {"sales", "social", "daily", "correlation", "segments", "lag"}
    history = scan.read_run_history(spark, f"{tmp_path / 'out'}/execution_history").collect()
    assert [r.status for r in history] == ["success"]
    files = scan.file_inventory(spark, str(tmp_path / "out")).filter(F.col("path").endswith(".parquet"))
    assert "sales_processed" in {r.table_name for r in reporting.output_sizes(files).collect()}


def test_transform_without_files(spark, landing):
    """Lazy composition: nothing is written to the output folder."""
    tables = scan.read_all_sources(spark, job.merged_config(config(landing, "unused")), keep_order=True)
    out = job.transform_all({**tables, "tiktok": None}, list(scan.SCAN_ORDER))
    assert set(out) == {"sales", "instagram", "social_media_merged", "daily_aggregates"}
    assert out["daily_aggregates"].count() > 0


def test_failed_job_is_recorded(spark, tmp_path):
    out = tmp_path / "out"
    bad = {"data_sources": {"sales": {"path": str(tmp_path / "missing.csv")}}, "output": {"clean_data_path": str(out)}}
    assert job.run_job(spark, bad) is None
    row = scan.read_run_history(spark, f"{out}/execution_history").first()
    assert row.status == "error" and "missing.csv" in row.error


def test_job_without_social_tables(spark, landing, tmp_path):
    conf = config(landing, tmp_path / "out")
    for p in ("instagram", "tiktok"):
        conf["data_sources"]["social_media"][p]["enabled"] = False
    done = job.run_job(spark, conf)
    assert set(done["data"]) == {"sales", "daily_aggregates"}
    assert done["correlation"]["general"] is None and done["missing_outputs"] == ["social_media_merged"]


def test_job_keeps_on_disk_only_what_it_needs(spark, landing, tmp_path, monkeypatch):
    """Scratch of a stage goes before the next one starts, and shuffle files go with the statement they served."""
    held, folder = [], f"{scratch.shared_folder(spark)}/tallyrill"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()

    def seen(step):
        def run(*args, **kwargs):
            held.append((set(os.listdir(folder)) - before, spark.conf.get(scratch._CLEAN, None)))
            return step(*args, **kwargs)
        return run

    monkeypatch.setattr(job.quality, "validate_tables", seen(job.quality.validate_tables))
    monkeypatch.setattr(job.segmentation, "segment_customers", seen(job.segmentation.segment_customers))
    monkeypatch.setattr(job.correlation, "analyze", seen(job.correlation.analyze))
    assert job.run_job(spark, config(landing, tmp_path / "out")) is not None
    assert len(held) == 3 and all(left == set() and clean == "true" for left, clean in held[:1] + held[2:])
    assert spark.conf.get(scratch._CLEAN, None) is None
    spark.conf.set(scratch._CLEAN, "false")
    try:
        with scratch.shuffles_removed(spark):
            assert spark.conf.get(scratch._CLEAN) == "false"
        assert spark.conf.get(scratch._CLEAN) == "false"
    finally:
        spark.conf.unset(scratch._CLEAN)


def test_compressed_landing_files_are_read(spark, landing, tmp_path):
    sales = scan.read_sales_csv(spark, str(landing / "sales.csv"))
    sinks.write_table(sales, str(tmp_path / "s.csv"), "csv", compression="gzip")
    again = scan.read_sales_csv(spark, str(tmp_path / "s.csv"))
    assert sorted(map(str, again.collect())) == sorted(map(str, sales.collect()))
    posts = scan.read_social_json(spark, str(landing / "instagram.json"), "instagram")
    sinks.write_json_records(posts, str(tmp_path / "p.json"), "gzip")
    assert scan.read_social_json(spark, str(tmp_path / "p.json"), "instagram", json_lines=True).count() == posts.count()
    for name in ("s.csv", "p.json"):
        assert all(f.endswith(".gz") for f in os.listdir(tmp_path / name) if not f.startswith(("_", ".")))
