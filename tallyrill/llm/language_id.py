"""Language identification by compression: the language whose dictionary makes a text smallest.

A language is represented by a raw-content zstandard dictionary, the concatenation of short pieces
of its training documents. A text is encoded with every dictionary, in blocks of ``BLOCK`` bytes so
that the dictionary matters throughout a long text, and the language with the smallest total wins.
A text is rejected where the two smallest totals lie within ``min_margin`` of each other.

The fit reads a bounded sample: at most ``PER_LANGUAGE`` documents a language, one piece of at most
``PIECE`` characters each, so a dictionary holds at most ``PER_LANGUAGE * PIECE`` characters. The
sample is chosen by a hash of the row; repeated texts count once. Every text is scored whole.

Defined cases: a null text, or one without any letter, is ``und`` with score 0 and is rejected.
Equal totals go to the language with more training documents, then the smaller name, and are
rejected. Without any training row everything is ``und``. Rows with a null id are scored alike;
repeated rows give repeated results. Columns other than the named ones are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from tallyrill.llm.common import text_batches, unused

PER_LANGUAGE = 512
PIECE = 256
BLOCK = 1024
LEVEL = 6
MIN_MARGIN = 0.001

_LETTER = re.compile(r"[^\W\d_]")
_OVERSAMPLE = 8


def learn(train: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE,
          piece: int = PIECE) -> dict[str, bytes]:
    """One dictionary per language, most frequent language first.

    ``train`` may hold null languages and texts; they are left out. What reaches the driver is the
    sample: ``per_language`` pieces of ``piece`` characters for every language.
    """
    rows = train.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    rows = rows.where("lang is not null and text rlike '\\\\p{L}'")
    rows = rows.select("lang", "text", F.xxhash64("text", "lang").alias("h"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {}
    # A share of the hash range that holds some times the sample, so that the ranking below stays small.
    shares = F.create_map(*[x for k, n in sizes.items()
                            for x in (F.lit(k), F.lit(min(1.0, _OVERSAMPLE * per_language / n)))])
    near = F.pmod(F.xxhash64("h"), F.lit(1 << 32)) < shares[F.col("lang")] * float(1 << 32)
    start = F.pmod(F.xxhash64("text", F.lit(1)), F.greatest(F.length("text") - piece, F.lit(0)) + 1) + 1
    pieces = rows.where(near).select("lang", "h", F.lower(F.substring("text", start, F.lit(piece))).alias("piece"))
    order = Window.partitionBy("lang").orderBy("h", "piece")
    sample = (pieces.dropDuplicates(["lang", "h"]).withColumn("k", F.row_number().over(order))
              .where(F.col("k") <= per_language).select("lang", "k", "piece").collect())
    out = {}
    for name in sorted(sizes, key=lambda k: (-sizes[k], k)):
        own = sorted((r["k"], r["piece"]) for r in sample if r["lang"] == name)
        out[name] = "\n".join(p for _, p in own).encode("utf-8")
    return out


def _encoders(dictionaries: dict[str, bytes]) -> list:
    out = []
    for raw in dictionaries.values():
        shape = {"write_checksum": False, "write_content_size": False}
        if len(raw) < 8:  # too little for a dictionary
            out.append(zstandard.ZstdCompressor(level=LEVEL, **shape))
            continue
        d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(dict_data=d, **shape))
    return out


def sizes_of(text: str, encoders: list) -> np.ndarray:
    """Total encoded size of a whole text for every dictionary."""
    data = text.lower().encode("utf-8", "replace")
    blocks = [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]
    return np.array([sum(len(e.compress(b)) for b in blocks) for e in encoders], np.int64)


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text",
             min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1), ``margin`` and ``rejected``.

    ``margin`` is the share by which the smallest total lies below the second smallest; ``score``
    is the weight of the winner when encoded sizes are read as code lengths of a text of 64 bytes.
    """
    text_batches(docs.sparkSession)
    names = list(dictionaries)
    state: dict = {}

    def one(t) -> tuple[str, float, float, bool]:
        if not names or not isinstance(t, str) or not _LETTER.search(t):
            return "und", 0.0, 0.0, True
        sizes = sizes_of(t, state["encoders"])
        best = int(np.argmin(sizes))
        if len(names) == 1:
            return names[0], 1.0, 1.0, False
        second = int(np.partition(sizes, 1)[1])
        margin = (second - int(sizes[best])) / max(second, 1)
        bits = 64 * (sizes - sizes[best]) / max(int(sizes[best]), 1)
        return names[best], float(1 / np.exp2(-bits).sum()), margin, bool(margin < min_margin)

    @F.pandas_udf("lang_pred string, score double, margin double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        if "encoders" not in state:
            state["encoders"] = _encoders(dictionaries)
        return pd.DataFrame([one(t) for t in texts], columns=["lang_pred", "score", "margin", "rejected"])

    taken = {"lang_pred", "score", "margin", "rejected"}
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in taken]
    said = unused(docs, "_said")
    out = docs.select(*kept, predict(F.col(f"`{text}`")).alias(said))
    return out.select(*kept, *[f"{said}.{c}" for c in ("lang_pred", "score", "margin", "rejected")])
