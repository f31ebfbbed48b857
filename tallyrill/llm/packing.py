"""Packing of tokenised documents into fixed-length sequences by minimum bin slack.

Texts become token ids and an end id; documents longer than a sequence are cut from their end, so
only the first piece may be short. What decides the packing is how many pieces there are of every
length, at most ``capacity`` counts however large the corpus is. Bins are planned on those counts:
the longest length left opens a bin, a bitset subset-sum over all lengths left finds the fullest
completion, and the combination is repeated for as long as its lengths last. Every step uses up a
length or leaves fewer of it than one bin took, so the number of combinations depends on ``capacity``
and not on the corpus. Pieces are then numbered within their
length, and the number says which copy of which combination a piece belongs to.

Numbering is done per length and hash bucket of at most about ``BUCKET`` rows, so one length that
half of the pieces share is spread over many tasks.

Defined cases: a null text is empty and gives one piece holding the end id alone. Null and repeated
ids are packed like any other; every row is packed. An added token of the vocabulary that stands in a
text, such as ``<|endoftext|>``, is its one id. An empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import base64
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyrill.llm.common import text_batches, write_once

CAPACITY = 2048
END = 0
BUCKET = 50_000
WRITTEN = "_written"  # number of a piece in the written table

# Fixed value: how byte-level BPE vocabularies of this family split a text before merging.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def added_tokens(tokenizer: str) -> dict[str, int]:
    """Tokens outside the merges, from the JSON file of the same vocabulary; a ``tiktoken`` file has only merges.

    A vocabulary without a JSON file has none.
    """
    beside = tokenizer.removesuffix(".tiktoken") + ".json"
    if not os.path.exists(beside):
        return {}
    with open(beside, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens") or []
    bent = [t["content"] for t in added if any(t.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized"))]
    if bent:
        raise ValueError(f"added tokens {bent} take their surroundings into account; use the JSON file")
    return {t["content"]: t["id"] for t in added}


def encoder(vocabulary: bytes, kind: str, added: dict[str, int]):
    """A function from texts to lists of ids, from the content of a ``json`` or ``tiktoken`` file.

    An added token that a text holds is one id, as the JSON tokenizer has it; ``added`` names them for a ``tiktoken`` file.
    """
    if kind == "json":
        from tokenizers import Tokenizer

        tok = Tokenizer.from_str(vocabulary.decode("utf-8"))
        return lambda texts: [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    enc = tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return lambda texts: [enc.encode(t, allowed_special="all") for t in texts]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document of ``n`` ids: whole ones counted from its end."""
    first = n - capacity * ((n - 1) // capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           end: int = END, keep_ids: bool = False) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, on request, ``ids``."""
    text_batches(docs.sparkSession)
    with open(tokenizer, "rb") as f:  # a small file of the tokenizer's package; its content goes with the task
        vocabulary = f.read()
    kind = "json" if tokenizer.endswith(".json") else "tiktoken"
    added = {} if kind == "json" else added_tokens(tokenizer)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, kind, added)
        shape = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                 ("ids_crc32", pa.int64()), *([("ids", pa.list_(pa.int32()))] if keep_ids else [])]
        for part in parts:
            out = []
            texts = [t or "" for t in part.column(1).to_pylist()]
            for key, ids in zip(part.column(0).to_pylist(), encode(texts)):
                array = np.array([*ids, end], "<u4")
                for k, (s, n) in enumerate(cut(len(array), capacity)):
                    own = array[s:s + n]
                    row = (key, k, s, n, zlib.crc32(own.tobytes()))
                    out.append((*row, own.astype(np.int32)) if keep_ids else row)
            columns = list(zip(*out)) or [()] * len(shape)
            yield pa.record_batch([pa.array(c, t) for c, (_, t) in zip(columns, shape)], schema=pa.schema(shape))

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    return rows.mapInArrow(run, schema)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths with the largest sum of at most ``room``; long ones are tried first.

    Bit s of the set says that a sum s can be reached with the lengths seen so far.
    """
    keep = (1 << (room + 1)) - 1
    reach, stages = 1, []
    for n in sorted((x for x in counts if x <= room and counts[x] > 0), reverse=True):
        before, left, step = reach, min(counts[n], room // n), 1
        while left > 0:  # up to ``left`` copies by doubling
            take = min(step, left)
            reach |= (reach << (n * take)) & keep
            left -= take
            step *= 2
        stages.append((n, before))
        if reach >> room & 1:
            break
    best, out = reach.bit_length() - 1, {}
    for n, before in reversed(stages):
        k = 0
        while not before >> (best - k * n) & 1:
            k += 1
        if k:
            out[n] = k
            best -= k * n
    return out


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Combinations and how often each is filled, until no piece is left."""
    left = {n: c for n, c in counts.items() if c > 0}
    out = []
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = fullest(left, capacity - longest)
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[n] // k for n, k in chosen.items())
        out.append((times, chosen))
        for n, k in chosen.items():
            left[n] -= times * k
            if not left[n]:
                del left[n]
    return out


def _slots(bins: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows (length, first number, copies a bin, first bin, offset), sorted: which numbers of a length go where."""
    used: dict[int, int] = {}
    rows, first = [], 0
    for times, chosen in bins:
        offset = 0
        for n in sorted(chosen, reverse=True):
            rows.append((n, used.get(n, 0), chosen[n], first, offset))
            used[n] = used.get(n, 0) + times * chosen[n]
            offset += n * chosen[n]
        first += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def place(cuts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to written pieces; the counts by length are all that the driver sees."""
    lengths = cuts.groupBy("length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in lengths.collect()}
    slots = _slots(plan(counts, capacity))
    buckets = max(1, -(-sum(counts.values()) // BUCKET))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    # Rows that share an id, or have none, are spread by the number they were written with.
    spread = [c for c in ("doc_id", "piece", WRITTEN) if c in cuts.columns]
    dealt = cuts.withColumn("bucket", F.pmod(F.xxhash64(*spread), F.lit(buckets)))
    before = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("length", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    numbered = (dealt.withColumn("k", F.row_number().over(order)).join(before, ["length", "bucket"])
                .withColumn("number", F.col("ahead") + F.col("k") - 1))

    @F.pandas_udf("sequence_id long, offset long")
    def where(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        n, j = length.to_numpy(np.int64), number.to_numpy(np.int64)
        # Lengths are small, so a length and a number make one sortable key.
        keys = slots[:, 0] * (1 << 48) + slots[:, 1]
        own = slots[np.searchsorted(keys, n * (1 << 48) + j, side="right") - 1]
        nth = j - own[:, 1]
        return pd.DataFrame({"sequence_id": own[:, 3] + nth // own[:, 2], "offset": own[:, 4] + nth % own[:, 2] * n})

    kept = [c for c in cuts.columns if c != WRITTEN]
    out = numbered.select(*kept, where("length", "number").alias("_at"))
    return out.select(*kept, "_at.sequence_id", "_at.offset")


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         end: int = END, keep_ids: bool = False) -> DataFrame:
    """One row per piece with its place; with ``keep_ids`` also the ids themselves."""
    cuts = pieces(docs, tokenizer, doc_id, text, capacity, end, keep_ids)
    return place(write_once(cuts.withColumn(WRITTEN, F.monotonically_increasing_id()), "pieces"), capacity)
