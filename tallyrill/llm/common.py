"""Helpers shared by the operators: table access, batch size, word splitting and word hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyrill.scratch import write_once

__all__ = ["crc_fold", "hashed_block", "hashed_words", "mix", "plain_bytes", "powers", "runs_hashed", "table",
           "text_batches", "unused", "words_of", "write_once"]

# A word is a run of characters outside this set; A-Z is lower-cased, other letters stay as they are.
_SPACES = b"\x09\x0a\x0b\x0c\x0d\x20"
_PLAIN = bytes(0x20 if i in _SPACES else i + 32 if 0x41 <= i <= 0x5A else i for i in range(256))

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_S33, _S29 = np.uint64(33), np.uint64(29)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as tell it apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_batches(spark: SparkSession, rows: int = 256) -> None:
    """Send at most ``rows`` rows at a time to Python, so that a batch of very long texts fits in a worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def crc_fold(doc_id: str, folds: int):
    """crc32 of the id as text, modulo ``folds``; an absent id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))) % folds


def plain_bytes(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased and every blank a space; no byte moves."""
    return text.encode("utf-8", "replace").translate(_PLAIN) if text else b""


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words of a text in UTF-8."""
    return text.encode("utf-8", "replace").translate(_PLAIN).split() if text else []


_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(n, 1 << 16, 2 * len(_powers["up"]))
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> _S33)) * _MIX
    return h ^ (h >> _S29)


def hashed_block(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word of plain bytes (lower-cased, blanks only between words)."""
    data = np.frombuffer(block, np.uint8)
    inside = np.empty(len(data) + 2, np.int8)
    inside[0] = inside[-1] = 0
    np.not_equal(data, 0x20, out=inside[1:-1], casting="unsafe")
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts]), starts, ends


def hashed_words(texts: list, chunk: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a list of texts, and the number of words before each text.

    Every word hash is a polynomial in its bytes, taken as a difference of running sums, so the
    work is a few array operations a byte. Texts are joined up to ``chunk`` bytes at a time.
    """
    plain = [t.encode("utf-8", "replace").translate(_PLAIN) if t else b"" for t in texts]
    parts, counts, i = [], [], 0
    while i < len(plain):
        j, size = i, 0
        while j < len(plain) and (j == i or size + len(plain[j]) + 1 <= chunk):
            size += len(plain[j]) + 1
            j += 1
        joined = b" ".join(plain[i:j])
        hashes, starts, _ = hashed_block(joined)
        bounds = np.cumsum([0, *(len(p) + 1 for p in plain[i:j])])
        counts.append(np.diff(np.searchsorted(starts, bounds)))
        parts.append(hashes)
        i = j
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), offsets.astype(np.int64)


def runs_hashed(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` words of one text, from the hashes of its words."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    up, down = powers(len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=total[1:])
    return mix((total[length:] - total[:-length]) * down[: len(words) - length + 1])
