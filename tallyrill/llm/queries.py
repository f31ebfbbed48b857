"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyrill.llm import (decontamination, divergence, language_id, language_model, line_dedup, manifest, neighbours,
                           packing, quality, repeats, secrets, simhash, toxicity)
from tallyrill.llm.common import crc_fold, table
from tallyrill.llm.statements import OP11_SQL, OP12_SQL

TOKENIZER = public_tokenizers.path("byte_bpe_50k.tiktoken")  # the ids of byte_bpe_50k.json, read faster


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0, k=20)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_passages(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"), crc_fold("doc_id", 5) == 1)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), crc_fold("doc_id", 5) == 0
    model = quality.fit(docs, table(spark, sf_dir, "labels").where(~held))
    return quality.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted", "n_passages",
                                             "top_weight")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), crc_fold("doc_id", 4) == 2
    learnt = language_id.learn(docs.where(~held))
    return language_id.identify(docs.select("doc_id", "text"), learnt).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), whole_runs=True)
    return out.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"),
                      F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"),
                      F.sha2("text", 256).alias("kept_sha256"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    touched = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return manifest.manifest(table(spark, sf_dir, "documents"), {"text": lowered}, touched)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), crc_fold("doc_id", 5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held))
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted", "n_features")


_OP10_SQL = f"""
WITH raw AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
every AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS i FROM raw),
l AS (SELECT doc_id, i, line, length(line) AS size, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p
      FROM (SELECT doc_id, i, trim(line, chr(32) || chr(9) || chr(13)) AS line FROM every) WHERE line <> ''),
c AS (SELECT *, sum(size) OVER (PARTITION BY doc_id ORDER BY p) AS upto FROM l),
pairs AS (SELECT a.doc_id, a.p, a.i, b.p AS last FROM c a JOIN c b ON a.doc_id = b.doc_id
          WHERE b.p BETWEEN a.p AND a.p + {line_dedup.MIN_CHARS} - 1
            AND b.upto - a.upto + a.size >= {line_dedup.MIN_CHARS}),
w AS (SELECT doc_id, p, i, min(last) AS last FROM pairs GROUP BY ALL
      UNION SELECT doc_id, max(p), max(i), last FROM pairs GROUP BY doc_id, last),
runs AS (SELECT w.doc_id, w.p, w.i, w.last, string_agg(l.line, chr(10) ORDER BY l.p) AS run
         FROM w JOIN l ON l.doc_id = w.doc_id AND l.p BETWEEN w.p AND w.last GROUP BY ALL),
later AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS n FROM runs),
gone AS (SELECT DISTINCT later.doc_id, l.i FROM later JOIN l ON l.doc_id = later.doc_id
         WHERE l.p BETWEEN later.p AND later.last AND n > 1),
marked AS (SELECT e.doc_id, e.i, e.line, g.i IS NOT NULL AS cut FROM every e
           LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (cut) AS n_removed,
       coalesce(string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) FILTER (cut), '') AS removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT cut), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q for q in (op1_neighbours, op2_decontamination, op3_repeats, op4_simhash, op5_ppm, op6_quality,
                            op7_secrets, op8_packing, op9_language, op10_line_dedup, op11_manifest,
                            op12_divergence, op13_toxicity)}
ORACLE = {"op10_line_dedup": _OP10_SQL, "op11_manifest": OP11_SQL, "op12_divergence": OP12_SQL}
