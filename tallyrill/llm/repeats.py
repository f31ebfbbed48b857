"""Repeated passages across documents with a sparse suffix array.

Texts are words. Of the suffixes of a document only those at minimiser positions are kept: within
every ``WINDOW`` consecutive runs of ``GRAM`` words, the run with the least hash. A passage of
``MIN_WORDS`` words holds a whole window, and its first minimiser comes early enough to be followed
by ``seed`` = MIN_WORDS - WINDOW + 1 of its words, so both copies keep a suffix at the same place of
the passage and these begin with the same ``seed`` words. Suffixes whose first ``seed`` words occur
in one document only are dropped before anything is sorted.

What is left is sorted over the cluster by the words that follow, as far as ``MIN_WORDS``, then by
the words before; each suffix is compared with its nearest neighbour from another document on
either side and extended to the right and to the left. An extension of ``MIN_WORDS`` words or more in
all is a repeat. The same is done once more in the order of the words before. Extensions reach at
most ``MIN_WORDS`` words to either side of a suffix; kept suffixes are closer together than that, so
the parts of a longer passage overlap and merge.

The sort is by range on the words themselves, so a passage that a third of the corpus shares is
spread over many tasks. Neighbours across the edge of two ranges are compared in a second, small step.

Defined cases: null, empty and short texts have no repeats. Rows that share an id are one document;
rows without an id are told apart by their text and reported without one. Repeats inside one document alone do not count.
Empty tables give empty results. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tallyrill.llm.common import hashed_words, runs_hashed, text_batches, write_once

MIN_WORDS = 50
GRAM = 8
WINDOW = 32
BLOCK_BYTES = 8 << 20


def _sliding(a: np.ndarray, width: int, of) -> np.ndarray:
    """Minimum or maximum of every ``width`` consecutive values, by doubling."""
    have, out = 1, a
    while have < width:
        step = min(have, width - have)
        out = of(out[:-step], out[step:])
        have += step
    return out


def minimisers(words: np.ndarray, gram: int, window: int) -> np.ndarray:
    """Positions of the runs that are least in some whole window."""
    g = runs_hashed(words, gram)
    if len(g) < window:
        return np.zeros(0, np.int64)
    least = _sliding(g, window, np.minimum)
    edge = np.zeros(window - 1, np.uint64)
    # The largest of the window minima around a run equals the run's hash if it is least in one of them.
    return np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), window, np.maximum) == g)


def suffixes(words: np.ndarray, min_words: int, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Kept positions of a text and the hash of the ``seed`` words from each."""
    if len(words) < min_words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    seeds = runs_hashed(words, min_words - window + 1)
    at = minimisers(words, gram, window)
    at = at[at < len(seeds)]
    return at, seeds[at].view(np.int64)


def _words_by_text(texts: list) -> Iterator[tuple[int, np.ndarray]]:
    for i in range(0, len(texts), 256):
        hashes, offsets = hashed_words(texts[i:i + 256])
        for k in range(len(offsets) - 1):
            yield i + k, hashes[offsets[k]:offsets[k + 1]]


def _extend(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each pair of rows; zeros stand for words that are not there."""
    same = (a == b) & (a != 0)
    return np.where(same.all(axis=1), a.shape[1], same.argmin(axis=1))


_KEPT = ["doc", "pos", "from", "to", "other"]


def _compared(rows: pd.DataFrame, others: pd.DataFrame, min_words: int) -> pd.DataFrame:
    """Spans of ``rows`` that repeat at the aligned ``others``."""
    def grid(frame, name):
        return np.frombuffer(b"".join(frame[name]), "<u4").reshape(len(frame), -1)

    if not len(rows):
        return pd.DataFrame({c: np.zeros(0, np.int64) for c in _KEPT})
    right = _extend(grid(rows, "right"), grid(others, "right"))
    left = _extend(grid(rows, "left"), grid(others, "left"))
    good = (right + left >= min_words) & (rows["doc"].to_numpy() != others["doc"].to_numpy())
    pos = rows["pos"].to_numpy()
    return pd.DataFrame({"doc": rows["doc"].to_numpy()[good], "pos": pos[good], "from": (pos - left)[good],
                         "to": (pos + right)[good], "other": others["doc"].to_numpy()[good]})


def _neighbours(rows: pd.DataFrame, min_words: int) -> pd.DataFrame:
    """Compare sorted rows with the nearest row of another document on either side."""
    doc = rows["doc"].to_numpy()
    change = np.flatnonzero(doc[1:] != doc[:-1]) + 1
    run = np.searchsorted(change, np.arange(len(doc)), side="right")
    heads, tails = np.concatenate([[0], change]), np.concatenate([change - 1, [len(doc) - 1]])
    out = []
    after = run < len(heads) - 1
    out.append(_compared(rows[after], rows.iloc[heads[run[after] + 1]], min_words))
    before = run > 0
    out.append(_compared(rows[before], rows.iloc[tails[run[before] - 1]], min_words))
    return pd.concat(out)


_ROW = "doc long, pos int, right binary, left binary"


def _matches(context: DataFrame, order: list[str], min_words: int) -> DataFrame:
    """Spans found between neighbours in one order, ``part`` edges included."""
    names = ["doc", "pos", "right", "left"]
    empty_span = {c: None for c in ("from", "to", "other")}

    def walk(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, first = None, True

        def edge(frame, side):
            return frame[names].assign(part=frame["part"], side=side, **empty_span)

        def spans(frame):
            found = _neighbours(frame, min_words)
            return found.assign(part=0, side=0, right=None, left=None)

        last = None
        for part in parts:
            if not len(part):
                continue
            frame = part if held is None else pd.concat([held, part], ignore_index=True)
            doc = frame["doc"].to_numpy()
            change = np.flatnonzero(doc[1:] != doc[:-1]) + 1
            if len(change) < 2:  # keep on until three documents were seen
                held = frame
                continue
            if first:
                yield edge(frame.iloc[:change[0] + 1], 2)  # the first run and the row after it
                first = False
            yield spans(frame)
            held = last = frame.iloc[change[-2]:]
        if held is not None and len(held):
            doc = held["doc"].to_numpy()
            change = np.flatnonzero(doc[1:] != doc[:-1]) + 1
            if first:
                yield edge(held.iloc[:change[0] + 1] if len(change) else held, 2)
            if last is not held:
                yield spans(held)
            yield edge(held.iloc[change[-1] - 1:] if len(change) else held, 1)  # the last run and the row before it

    # doc, pos, words; the sorted range; side 0: a span, 1: end of a range, 2: beginning of a range.
    shape = (f"{_ROW}, part int, side int, `from` int, `to` int, other long")
    sorted_rows = (context.repartitionByRange(*order, "doc", "pos").sortWithinPartitions(*order, "doc", "pos")
                   .withColumn("part", F.spark_partition_id()))
    found = write_once(sorted_rows.mapInPandas(
        lambda parts: (x.astype({"from": "Int32", "to": "Int32", "other": "Int64"}) for x in walk(parts)), shape), "matches")
    edges = found.where("side > 0")
    following = edges.select("part").distinct().withColumn("next", F.lead("part").over(Window.orderBy("part")))
    ends = edges.where("side = 1").select(F.col("part").alias("edge"), "side", *names)
    starts = (edges.where("side = 2").join(following.where("next is not null").select(
        F.col("part").alias("edge"), F.col("next").alias("part")), "part").select("edge", "side", *names))

    def meet(part: pd.DataFrame) -> pd.DataFrame:
        own = part.sort_values(["side", *order, "doc", "pos"], key=None, kind="stable").reset_index(drop=True)
        return _neighbours(own, min_words)[_KEPT]

    kept = "doc long, pos int, `from` int, `to` int, other long"
    met = ends.unionAll(starts).groupBy("edge").applyInPandas(meet, kept)
    return found.where("side = 0").select(*[F.col(f"`{c}`") for c in _KEPT]).unionAll(met)


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
                      gram: int = GRAM, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per maximal repeated span: ``doc_id``, ``start`` and ``n_words`` in words, ``other_doc`` it occurs in."""
    if window + gram - 1 > min_words:
        raise ValueError("a passage must hold a whole window")
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.withColumn("doc", F.coalesce("doc_id", F.xxhash64("text")))
    size = rows.agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).first()
    blocks = max(1, -(-((size["b"] or 0) + 64 * size["n"]) // block_bytes))
    rows = rows.select("doc", "text", F.pmod(F.xxhash64("doc", "text"), F.lit(blocks)).cast("int").alias("block"))

    def seeds(part: pd.DataFrame) -> pd.DataFrame:
        docs_, keys = part["doc"].to_numpy(np.int64), []
        who = []
        for k, words in _words_by_text(part["text"].tolist()):
            _, key = suffixes(words, min_words, gram, window)
            keys.append(key)
            who.append(np.full(len(key), docs_[k]))
        frame = pd.DataFrame({"key": np.concatenate(keys), "doc": np.concatenate(who)})
        out = frame.groupby("key", sort=False)["doc"].agg(["min", "max"]).reset_index()
        out.columns = ["key", "lo", "hi"]
        out.insert(0, "block", part["block"].iloc[0])
        return out

    held = write_once(rows.groupBy("block").applyInPandas(seeds, "block int, key long, lo long, hi long"), "seeds")
    shared = held.groupBy("key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi").select("key")
    sent = held.select("block", "key").join(shared, "key")

    def contexts(part: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        keys = np.sort(known["key"].to_numpy(np.int64))
        out = []
        docs_ = part["doc"].to_numpy(np.int64)
        pad = np.zeros(min_words, np.uint32)
        reach = np.arange(min_words)
        for k, words in _words_by_text(part["text"].tolist()) if len(keys) else ():
            at, key = suffixes(words, min_words, gram, window)
            if len(at):
                at = at[keys[np.minimum(np.searchsorted(keys, key), len(keys) - 1)] == key]
            if len(at):
                code = np.concatenate([pad, (words >> np.uint64(32)).astype(np.uint32) | np.uint32(1), pad])
                right, left = code[min_words + at[:, None] + reach], code[min_words - 1 + at[:, None] - reach]
                out += [(docs_[k], p, r.tobytes(), x.tobytes()) for p, r, x in zip(at.tolist(), right, left)]
        return pd.DataFrame(out, columns=["doc", "pos", "right", "left"])

    context = write_once(rows.groupBy("block").cogroup(sent.groupBy("block")).applyInPandas(contexts, _ROW), "contexts")
    found = _matches(context, ["right", "left"], min_words).unionAll(_matches(context, ["left", "right"], min_words))
    spans = found.groupBy("doc", "from", "to").agg(F.min("other").alias("other"))

    # Spans that touch or overlap are one: a span opens a new passage where it starts beyond all before it.
    order = Window.partitionBy("doc").orderBy("from", "to")
    ahead = F.max("to").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = spans.withColumn("new", F.coalesce((F.col("from") > ahead).cast("int"), F.lit(1)))
    passage = opens.withColumn("passage", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = (passage.groupBy("doc", "passage")
             .agg(F.min("from").alias("start"), F.max("to").alias("end"), F.min("other").alias("other")))
    # Texts without an id went by a number of their own; they are reported without one.
    absent = write_once(docs.where(F.col(f"`{doc_id}`").isNull()).select(
        F.xxhash64(F.col(f"`{text}`").cast("string")).alias("id")).distinct(), "absent-ids")
    for name in ("doc", "other"):
        spans = spans.join(absent.select(F.col("id").alias(name), F.lit(True).alias(f"no_{name}")), name, "left")
    return spans.select(F.when(F.col("no_doc").isNull(), F.col("doc")).alias("doc_id"), F.col("start").cast("long").alias("start"),
                        (F.col("end") - F.col("start")).cast("long").alias("n_words"),
                        F.when(F.col("no_other").isNull(), F.col("other")).alias("other_doc"))
