"""Divergence of sources: how far the word shares of every source lie from those of its language and its peers.

A term is a run of letters A-Z or characters beyond ASCII, A-Z lower-cased. A language keeps the terms
that at least ``MIN_DOCS`` of its documents hold. With count occurrences of a kept term in a group, N kept
occurrences in all and V kept terms, its share is 1 + floor(10^9 (count + 5) / (N + 5 V)), in whole numbers.

Two groups differ by the sum over all kept terms of the distance of their shares. Most terms are absent from
most groups and have there the group's baseline share z, so the sum over V terms is taken apart:

    V |z_g - z_h|
    + over terms of g: |p_g - z_h| - |z_g - z_h|, and the same over terms of h
    + over terms of both: |p_g - p_h| - |p_g - z_h| - |z_g - p_h| + |z_g - z_h|

Only the last line needs terms of two groups at once. It is the product of the group-by-term matrix with its
transpose, taken row by row (Gustavson): a group scatters its terms through the term-major index of its
peers into one dense accumulator with a place per peer. No pair of postings leaves the task; a task returns one
number per pair of groups. The lines before it come from sorted shares and running sums.

Terms are dealt into blocks by a hash, peers into blocks of about ``PEERS``, so a task holds about ``POSTINGS``
postings and an accumulator of some hundred places, whatever language or source holds most rows. Counts are
combined in the task that reads the texts, then before the shuffle; one language, source and term is one row.

Defined cases: null text, language and source are empty texts. A group without kept terms has only
baseline shares. A language without kept terms gives value 0 for every pair and no terms. A lone source of its
language has no pairs. Repeated rows count each. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyrill.llm.common import text_batches, write_once

MIN_DOCS = 30
TOP_TERMS = 50
SMOOTHING = 5
SCALE = 1_000_000_000
POSTINGS = 200_000  # of one language in a block of terms, about
PEERS = 512  # sources in a block of peers, about
_HELD_TERMS = 300_000  # counted terms a task holds before it sends them on

# Everything but A-Z, a-z and the bytes of characters beyond ASCII parts terms.
_TERM_BYTES = bytes(i + 32 if 0x41 <= i <= 0x5A else i if 0x61 <= i <= 0x7A or i >= 0x80 else 0x20 for i in range(256))
_COUNTS = "lang string, source string, term string, n long, docs long"
_COUNTS_ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                           ("n", pa.int64()), ("docs", pa.int64())])
_PAIRS = "lang string, source string, item string, value long"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def _batch(lang: str, source: str, terms: list[bytes], n: list[int], docs: list[int]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                            pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()),
                            pa.array(docs, pa.int64())], schema=_COUNTS_ARROW)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of every (language, source, term); an empty term marks the group."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def sent() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            for i in range(0, len(terms), 20_000):
                some = terms[i:i + 20_000]
                yield _batch(lang, source, some, [n[t] for t in some], [docs[t] for t in some])
        held.clear()

    for batch in batches:
        texts = batch.column(2).cast(pa.binary())
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
            group = held.get((lang, source))
            if group is None:
                group = held[lang, source] = (Counter({b"": 0}), Counter())
            words = terms_of(text.as_py())
            group[0].update(words)
            group[1].update(set(words))
        if sum(len(n) for n, _ in held.values()) > _HELD_TERMS:
            yield from sent()
    yield from sent()


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE (count + 5) / (total + 5 kept)) in decimals of 38 digits; 0 without kept terms."""
    parts = {"a": count, "b": total, "v": kept}
    whole = {k: c.cast("decimal(19,0)") for k, c in parts.items()}
    above = (whole["a"] + SMOOTHING) * F.lit(SCALE).cast("decimal(10,0)")
    below = whole["b"] + whole["v"] * SMOOTHING
    return F.when(kept > 0, F.call_function("div", above, below) + 1).otherwise(F.lit(0)).cast("long")


def distances(shares: np.ndarray, own: int, at: np.ndarray) -> np.ndarray:
    """For every z in ``at``: the sum over ``shares`` of |share - z| - |own - z|."""
    shares = np.sort(shares)
    upto = np.concatenate([[0], np.cumsum(shares)])
    below = np.searchsorted(shares, at)
    total = at * below - upto[below] + (upto[-1] - upto[below]) - at * (len(shares) - below)
    return total - len(shares) * np.abs(own - at)


def accumulated(term: np.ndarray, group: np.ndarray, p: np.ndarray, z: np.ndarray, rows: np.ndarray,
                peers: np.ndarray) -> np.ndarray:
    """Rows x peers: what the postings of one block of terms add to the distance of every pair of groups.

    ``term``, ``group`` and ``p`` are the postings, ``z`` the baseline of every group.
    """
    place = np.full(len(z), -1)
    place[peers] = np.arange(len(peers))
    theirs = np.flatnonzero(place[group] >= 0)
    theirs = theirs[np.argsort(term[theirs], kind="stable")]
    index_peer, index_p = place[group[theirs]], p[theirs]
    heads = np.searchsorted(term[theirs], np.arange(term.max(initial=-1) + 2))
    by_group = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[by_group], np.arange(len(z) + 1))
    peer_z, row_z = z[peers], z[rows]
    out = np.zeros((len(rows), len(peers)), np.int64)
    for i, g in enumerate(rows):
        mine = by_group[bounds[g]:bounds[g + 1]]
        out[i] += distances(p[mine], z[g], peer_z)
        starts, sizes = heads[term[mine]], heads[term[mine] + 1] - heads[term[mine]]
        at = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        own, other, peer = np.repeat(p[mine], sizes), index_p[at], index_peer[at]
        base = peer_z[peer]
        np.add.at(out[i], peer, np.abs(own - other) - np.abs(own - base) - np.abs(z[g] - other) + np.abs(z[g] - base))
    for j, h in enumerate(peers):
        out[:, j] += distances(p[by_group[bounds[h]:bounds[h + 1]]], z[h], row_z)
    return out


def _pairs_of_block(key: tuple, postings: pa.Table, groups: pa.Table) -> pa.Table:
    lang, terms, first, second = (k.as_py() for k in key)
    names = groups["source"].to_pylist()
    number = {s: i for i, s in enumerate(names)}
    z, block = (np.asarray(groups[c].to_numpy(), np.int64) for c in ("z", "block"))
    rows, peers = np.flatnonzero(block == first), np.flatnonzero(block == second)
    sources = postings["source"].combine_chunks().dictionary_encode()
    known = np.array([number[s] for s in sources.dictionary.to_pylist()], np.int64)
    group = known[np.asarray(sources.indices, np.int64)] if len(sources) else np.zeros(0, np.int64)
    term = np.asarray(postings["term"].combine_chunks().dictionary_encode().indices, np.int64)
    out = accumulated(term, group, np.asarray(postings["p"].to_numpy(), np.int64), z, rows, peers)
    if terms == 0:  # once per pair, not once per block of terms
        out += groups["kept"][0].as_py() * np.abs(z[rows][:, None] - z[peers][None, :])
    a, b = np.repeat(rows, len(peers)), np.tile(peers, len(rows))
    value, apart = out.ravel(), a != b
    a, b, value = a[apart], b[apart], value[apart]
    if first != second:  # blocks of peers meet once; the distance is the same from both sides
        a, b, value = np.concatenate([a, b]), np.concatenate([b, a]), np.tile(value, 2)
    label = pa.array(names, pa.string())
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "source": label.take(pa.array(a)),
                     "item": label.take(pa.array(b)), "value": pa.array(value, pa.int64())})


def _between_groups(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of sources of a language."""
    def met(df: DataFrame) -> DataFrame:
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))
        return (df.withColumn("other", other).withColumn("first", F.least("block", "other"))
                .withColumn("second", F.greatest("block", "other")))

    keys = ["lang", "terms", "first", "second"]
    left = met(postings).select(*keys, "source", "term", "p")
    right = met(groups.withColumn("terms", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_terms") - 1))))
    right = right.select(*keys, "source", "z", "kept", "block")
    parts = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_pairs_of_block, _PAIRS)
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS,
          top_terms: int = TOP_TERMS, postings_per_block: int = POSTINGS, peers_per_block: int = PEERS) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` rows for all peers, ``term`` rows for the leading terms."""
    text_batches(docs.sparkSession)
    given = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n)
                          for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    counts = (given.mapInArrow(_counted, _COUNTS).groupBy("lang", "term", "source")
              .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    counts = write_once(counts, "term-counts")
    words = counts.where("term <> ''")
    kept = write_once(words.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs"))
                      .where(F.col("docs") >= min_docs).drop("docs"), "kept-terms")
    found = write_once(words.drop("docs").join(kept, ["lang", "term"]), "postings")

    of_group = found.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("postings"))
    every = counts.where("term = ''").select("lang", "source").join(of_group, ["lang", "source"], "left").fillna(0)
    of_lang = every.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.count("*").alias("peers"),
                                        F.sum("postings").alias("lang_postings"))
    vocabulary = kept.groupBy("lang").agg(F.count("*").alias("kept"))
    of_lang = of_lang.join(vocabulary, "lang", "left").fillna(0, ["kept"]).select(
        "lang", "lang_total", "kept", F.ceil(F.col("peers") / peers_per_block).alias("n_blocks"),
        F.greatest(F.ceil(F.col("lang_postings") / postings_per_block), F.lit(1)).alias("n_terms"))
    groups = write_once(every.join(of_lang, "lang").select(
        "lang", "source", "total", "lang_total", "kept", "n_blocks", "n_terms",
        F.pmod(F.xxhash64("source"), "n_blocks").alias("block"),
        share(F.lit(0), F.col("total"), F.col("kept")).alias("z")), "groups")

    valued = write_once(found.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "block", "n_blocks", F.pmod(F.xxhash64("term"), "n_terms").alias("terms"),
        share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        share(F.col("in_lang"), F.col("lang_total"), F.col("kept")).alias("q")), "shares")

    of_terms = valued.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                            (F.col("p") - F.col("q")).alias("value"))
    of_pairs = _between_groups(valued, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    leading = of_terms.withColumn("rank", place).where(F.col("rank") <= top_terms)
    return leading.unionAll(of_pairs.withColumn("rank", place))
