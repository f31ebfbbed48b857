"""The pipeline's stages, and the one operator query that SQL can express."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from compare import database, difference  # noqa: E402
from llm.test_operators import lone_items  # noqa: E402

import corpus_pipeline  # noqa: E402
from tallyrill.llm import queries  # noqa: E402
from tallyrill.llm.common import table, write_once  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_pass_on_rows(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = write_once(stage(spark, docs, SF), "stage")
        assert out.dtypes == docs.dtypes
        assert out.join(docs, "doc_id", "left_anti").count() == 0
        docs = out
    assert 0 < docs.count() < table(spark, SF, "documents").count()
    bad = {r.text.lower() for r in table(spark, SF, "benchmark").collect()}
    assert not any(b in r.text.lower() for r in docs.collect() for b in bad)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).where("piece = 0").count() == docs.count()


def test_stages_on_odd_rows_and_nothing(spark, odd, nothing):
    for frame in (odd, nothing):
        docs = frame
        for _, stage in corpus_pipeline.STAGES:
            docs = write_once(stage(spark, docs, SF), "stage")


def test_line_stage_removes_whole_runs(spark):
    rows = [(1, "a long line that others repeat\nshort\nfirst"), (2, "second\na long line that others repeat\nshort\nend")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.without_repeated_lines(spark, docs, SF).collect()}
    assert got == {1: (rows[0][1], len(rows[0][1])), 2: ("second\nend", 10)}


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], DOCS)


def test_rows_that_share_an_id_or_have_none_are_decided_alone(spark, tmp_path):
    words = lambda a, n: " ".join(f"{a}{i}" for i in range(n))
    item, unnamed = words("item", 30), words("unnamed", 30)
    spark.createDataFrame([(1, item), (None, unnamed)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    big = (1 << 60) + 1  # not a floating-point number
    clean = [(5, words("clean", 80)), (None, words("fine", 80)), (big, words("large", 80))]
    leaks = [(5, words("x", 40) + " " + item), (None, words("y", 40) + " " + item), (6, words("z", 40) + " " + unnamed),
             (big, words("w", 40) + " " + item)]
    docs = rows_of(spark, clean + leaks).coalesce(1)
    got = corpus_pipeline.without_benchmark(spark, docs, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted((d or 0, t) for d, t in clean)


def test_items_outside_the_latent_space_leave_no_document(spark, tmp_path):
    docs, items = lone_items()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.without_benchmark(spark, rows_of(spark, docs), str(tmp_path)).collect()
    assert {r.doc_id for r in got} == {d for d, _ in docs if d >= 100}


def test_near_copies_leave_their_namesakes(spark):
    words = lambda a, n: " ".join(f"{a}{i}" for i in range(n))
    text, alone = words("copy", 60), words("alone", 60)
    rows = [(1, text), (2, text), (2, words("other", 60)), (None, text), (None, alone), (None, alone), (3, words("once", 60)),
            (3, words("once", 60))]
    got = corpus_pipeline.without_near_copies(spark, rows_of(spark, rows), SF).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted(
        [(1, text), (2, words("other", 60)), (0, alone), (3, words("once", 60))])


def test_line_query_matches_sql(spark):
    con = database(SF)
    for name, sql in queries.ORACLE.items():
        assert difference(spark, con, SF, name, queries.QUERIES[name], sql) == ""
