"""From raw documents to packed training sequences, as five stages over written tables.

Every stage takes and returns the columns of ``documents`` (the last one returns packed pieces) and
works on all rows its predecessor kept. Extra columns of the input are left behind. Empty tables pass
through as empty tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyrill.llm import decontamination, language_id, line_dedup, packing, simhash
from tallyrill.llm.common import table, write_once

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER = public_tokenizers.path("byte_bpe_50k.tiktoken")


ROW = "_row"  # with the id it tells rows apart that share an id, or have none


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS, F.xxhash64("text").alias(ROW))


def _same_row() -> Column:
    """Rows of the frames named a and b with the same id, or both without, and the same text."""
    return F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col(f"a.{ROW}") == F.col(f"b.{ROW}"))


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain; null texts, texts without letters and near ties go."""
    docs = docs.select(*COLUMNS)
    return language_id.identify(docs, language_id.learn(docs)).where(~F.col("rejected")).select(*COLUMNS)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs; those that hold nothing else go."""
    cut = line_dedup.dedup_lines(docs.select(*COLUMNS), whole_runs=True)
    changed = F.size("removed") > 0
    # Everything but blanks: what is left of a document that is a copy throughout is empty.
    cut = cut.where(~changed | F.col("text").rlike(r"[^ \t\r\n]"))
    size = F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", size).select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the smallest id, of its texts the one with the least hash.

    A row without an id stays only where its component has none with an id. Of rows that repeat the kept
    id and its text one stays.
    """
    docs = _keyed(docs)
    found = write_once(simhash.near_duplicates(docs, row_key=ROW), "near-copies")
    often = found.groupBy("doc_id", ROW).agg(F.count("*").alias("n"))
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", ROW)).alias("k"))
    first = first.select("k.doc_id", f"k.{ROW}")
    chosen = write_once(first.alias("b").join(often.alias("a"), _same_row(), "left_outer")
                        .select("b.doc_id", f"b.{ROW}", "a.n"), "kept")
    kept = docs.alias("a").join(chosen.alias("b"), _same_row()).select("a.*", "b.n")
    repeated = kept.where("n > 1").dropDuplicates(["doc_id", "text"])
    return kept.where("n = 1").select(*COLUMNS).unionAll(repeated.select(*COLUMNS))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, neither verbatim nor as a paraphrase."""
    docs = _keyed(docs)
    leaks = decontamination.find_leaks(docs, table(spark, sf_dir, "benchmark"), row_key=ROW)
    leaks = write_once(leaks.select("doc_id", ROW).distinct(), "leaks")
    return docs.alias("a").join(leaks.alias("b"), _same_row(), "left_anti").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents with their sequence and place."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("language ID", identified),
    ("line dedup", without_repeated_lines),
    ("SimHash near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("best-fit packing", packed),
]

ORACLE_SQL = None  # neither compression sizes, SimHash, latent retrieval nor the tokenizer can be put in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_once(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
