"""Benchmark decontamination by latent semantic retrieval.

Benchmark items and documents are read as overlapping passages of ``WIDTH`` words. The term space is
the words of the items: any other word has weight zero in every query. Document frequencies of the
terms come from all passages of all documents. A randomised SVD of the items' TF-IDF passages (range
finding with power iterations, every product of the matrix summed over the cluster) gives the latent
space, into which each passage of each document is folded. Every passage whose cosine to an item's
passage reaches ``MIN_COSINE`` is a candidate. The space has ``RANK`` dimensions however many items there
are, and items that share few words with others may lie outside it, so the cosine over the terms
themselves counts where the one in the space falls short: no item is left out of the search. In a passage
much longer than the item other words of the benchmark hide it, so an item of at most half a passage is
also searched in passages of its own length (``NARROW``) where wide ones show no leak; of at most a dozen
words only copies are confirmed there, as half of so few words says little.
A candidate is confirmed on the words around it: the
longest common subsequence with the item must hold ``COPY_SHARE`` of the item's words, or
``PARAPHRASE_SHARE`` of them where the item's answer is there as well.

An item's answer is the column ``answer`` if the table has one. An item without an answer is confirmed
by its rare words, wherever they stand: the heaviest common subsequence must hold ``RARE_SHARE`` of the
item's inverse document frequencies, so words that stand everywhere confirm nothing and no single
word has to be kept. All passages of all documents are searched; there is no limit on candidates.

The driver holds the items (a query set that every task needs whole, refused beyond ``MAX_ITEM_WORDS``
words in total), their term weights, and matrices of terms by latent dimensions. At that limit a task holds
some 200 MB of item vectors and, at a time, 64 MB of cosines and the products of one passage's terms.

Defined cases: null and empty texts have no passages and are clean. Items without words match
nothing. Null ids are reported as they are, repeated rows each; items are told apart by row, so one
without an id is searched like any other. An item that occurs several times in
a document is reported once, with its best match. Empty tables give empty results. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallyrill.llm.common import hashed_words, text_batches, write_once

WIDTH = 48
STRIDE = 24
NARROW = (3, 6, 12, 24)
RANK = 128
OVERSAMPLE = 16
POWER_ROUNDS = 2
MIN_COSINE = 0.6
COPY_SHARE = 0.8
PARAPHRASE_SHARE = 0.5
RARE_SHARE = 1 / 3
MAX_ITEM_WORDS = 4_000_000
_ROWS = 1 << 13
_BLOCK = 1 << 9
_CELLS = 1 << 24  # cosines worked out at a time
_PRODUCTS = 1 << 18  # products of two term weights added up at a time, more only where one passage has more
_SLICES = 16


def term_numbers(words: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Position of each word among the sorted terms, ``len(terms)`` where it is none."""
    if not len(terms):
        return np.zeros(len(words), np.int32)
    at = np.minimum(np.searchsorted(terms, words), len(terms) - 1)
    return np.where(terms[at] == words, at, len(terms)).astype(np.int32)


def passages(numbers: np.ndarray, offsets: np.ndarray, none: int, width: int = WIDTH, stride: int = STRIDE):
    """A row of term numbers per passage, the passage's text and its first word."""
    counts = np.diff(offsets)
    each = np.where(counts > 0, np.maximum(1, -(-(counts - (width - stride)) // stride)), 0)
    owner = np.repeat(np.arange(len(counts)), each)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
    start = nth * stride
    at = start[:, None] + np.arange(width)[None]
    inside = at < counts[owner][:, None]
    rows = np.full(at.shape, none, np.int32)
    rows[inside] = numbers[(offsets[owner][:, None] + at)[inside]]
    return rows, owner, start


def weights(rows: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF of passages as (sorted term numbers, weight of each first occurrence, else 0)."""
    rows = np.sort(rows, axis=1)
    first = np.ones(rows.shape, bool)
    first[:, 1:] = rows[:, 1:] != rows[:, :-1]
    # Occurrences of a term: distance from its first place to the next term's.
    place = np.where(first, np.arange(rows.shape[1]), rows.shape[1])
    after = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1]
    following = np.concatenate([after[:, 1:], np.full((len(rows), 1), rows.shape[1])], axis=1)
    count = np.where(first, following - np.arange(rows.shape[1]), 1)
    return rows, np.where(first, (1 + np.log(count)) * np.append(idf, 0.0)[rows], 0.0).astype(np.float32)


def project(rows: np.ndarray, weight: np.ndarray, space: np.ndarray) -> np.ndarray:
    """Unit vectors of passages in the latent space; zero for passages without terms.

    Passages with as many terms stand together, and their first, second, ... terms are added at a time, so a
    block of sums stays in the processor's cache.
    """
    out = np.zeros((len(rows), space.shape[1]), np.float32)
    passage, place = np.nonzero(weight > 0)
    size = np.bincount(passage, minlength=len(rows))
    order = np.argsort(-size, kind="stable")
    nth = np.arange(len(passage)) - np.repeat(np.cumsum(size) - size, size)
    terms, value = np.zeros((2, size.max(initial=0), len(rows)))
    rank = np.empty(len(rows), np.int64)
    rank[order] = np.arange(len(rows))
    terms[nth, rank[passage]], value[nth, rank[passage]] = rows[passage, place], weight[passage, place]
    terms, value, size = terms.astype(np.int32), value.astype(np.float32), size[order]
    part = np.empty((_BLOCK, space.shape[1]), np.float32)
    for i in range(0, len(rows), _BLOCK):
        own = size[i:i + _BLOCK]
        total = np.zeros((len(own), space.shape[1]), np.float32)
        for j in range(own[0]):
            k = int(np.searchsorted(-own, -j))  # how many have a term of this place
            np.take(space, terms[j, i:i + k], axis=0, out=part[:k], mode="clip")
            part[:k] *= value[j, i:i + k, None]
            total[:k] += part[:k]
        out[order[i:i + _BLOCK]] = total
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norm, out=out, where=norm > 1e-9)


class Postings:
    """Unit TF-IDF vectors of the items' passages by term, for all cosines over the terms that reach ``least``.

    The lightest terms of a vector, of half of ``least`` in length together, stay out of the sums at first: they stand
    in most passages, and add no more than that half. Pairs that may still get there are worked out with all terms.
    """

    def __init__(self, rows: np.ndarray, weight: np.ndarray, terms: int, least: float):
        self.width, self.terms, self.least = len(rows), terms + 1, least
        unit = weight / np.maximum(np.linalg.norm(weight, axis=1, keepdims=True), 1e-9)
        passage, place = np.nonzero(weight > 0)
        term, value = rows[passage, place], unit[passage, place].astype(np.float32)
        self.keys, self.values = passage * self.terms + term, value  # terms of a passage ascend
        rising = np.lexsort((value, passage))
        total = np.cumsum(value[rising].astype(np.float64) ** 2)
        first = np.searchsorted(passage, passage)
        light = total - np.where(first > 0, total[first - 1], 0.0) <= (least / 2) ** 2
        heavy = np.sort(rising[~light])
        order = heavy[np.argsort(term[heavy], kind="stable")]
        self.passage, self.value = passage[order].astype(np.int32), value[order]
        self.begin = np.searchsorted(term[order], np.arange(terms + 2))

    def near(self, rows: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, item's passage, cosine) of pairs that reach ``least``; passages as from ``weights``."""
        unit = weight / np.maximum(np.linalg.norm(weight, axis=1, keepdims=True), 1e-9)
        begin, size = self.begin[rows], np.where(weight > 0, self.begin[rows + 1] - self.begin[rows], 0)
        upto = np.cumsum(size.sum(axis=1))
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        a = 0
        while a < len(rows):
            most = (upto[a - 1] if a else 0) + _PRODUCTS
            b = max(a + 1, min(int(np.searchsorted(upto, most, side="right")), a + max(1, _PRODUCTS // self.width)))
            passage, place = np.nonzero(size[a:b])
            n = size[a:b][passage, place]
            at = np.arange(n.sum()) + np.repeat(begin[a:b][passage, place] - (np.cumsum(n) - n), n)
            cell = np.repeat(passage * self.width, n) + self.passage[at]
            value = np.repeat(unit[a:b][passage, place], n) * self.value[at]
            total = np.bincount(cell, value, (b - a) * self.width)
            for cells in np.array_split(hit := np.flatnonzero(total >= self.least / 2 - 1e-5), 1 + len(hit) // _ROWS):
                i, j = a + cells // self.width, cells % self.width
                key = j[:, None] * self.terms + rows[i]
                spot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                cosine = np.where(self.keys[spot] == key, unit[i] * self.values[spot], 0.0).sum(axis=1)
                reached = cosine >= self.least
                out.append((i[reached], j[reached], cosine[reached]))
            a = b
        return tuple(np.concatenate(c) for c in zip(*out))


def common_subsequence(item: np.ndarray, region: np.ndarray) -> int:
    """Length of the longest common subsequence, one bit per word of the item."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in region.tolist():
        m = masks.get(w)
        if m is not None:
            u = row & m
            row = (row + u) | (row - u)
            row &= full
    return len(item) - row.bit_count()


def common_weight(item: np.ndarray, weight: np.ndarray, region: np.ndarray) -> float:
    """Weight of the heaviest common subsequence, where every word of the item has its own weight."""
    best = np.zeros(len(item) + 1)
    for w in region[np.isin(region, item)]:
        best[1:] = np.maximum(best[1:], np.where(item == w, best[:-1] + weight, 0.0))
        best = np.maximum.accumulate(best)
    return float(best[-1])


def contains(region: np.ndarray, answer: np.ndarray) -> bool:
    """Whether the answer's words stand together in the region."""
    n = len(answer)
    if not n or len(region) < n:
        return False
    starts = np.flatnonzero(region[: len(region) - n + 1] == answer[0])
    return any((region[s:s + n] == answer).all() for s in starts)


def _sum_of_products(rows: DataFrame, idf: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A'A right, where the rows of A are the TF-IDF passages: partial products per task, summed over the cluster.

    Terms travel in ``_SLICES`` slices, each a block of numbers, so the driver gets one row per slice.
    """
    terms, width = right.shape
    cuts = [(s * terms // _SLICES, (s + 1) * terms // _SLICES) for s in range(_SLICES)]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, seen = np.zeros((terms + 1, width)), False
        wide = np.vstack([right, np.zeros((1, width))])
        for part in parts:
            m = np.vstack(part["terms"].to_numpy()).astype(np.int32)
            number, weight = weights(m, idf)
            norm = np.linalg.norm(weight, axis=1, keepdims=True)
            weight = weight / np.maximum(norm, 1e-9)
            seen = True
            for n, w in zip(number, weight):
                np.add.at(total, n, w[:, None] * (w @ wide[n])[None])
        if seen:
            yield pd.DataFrame([(s, total[a:b].tobytes()) for s, (a, b) in enumerate(cuts) if a < b], columns=["s", "m"])

    def add(part: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(m) for m in part["m"])
        return pd.DataFrame({"s": [part["s"].iloc[0]], "m": [total.tobytes()]})

    out = np.zeros((terms, width))
    shape = "s int, m binary"
    for r in rows.mapInPandas(run, shape).groupBy("s").applyInPandas(add, shape).toLocalIterator():
        a, b = cuts[r["s"]]
        out[a:b] = np.frombuffer(r["m"]).reshape(b - a, width)
    return out


def latent_space(rows: DataFrame, idf: np.ndarray, rank: int = RANK, seed: int = 1) -> np.ndarray:
    """Leading right singular vectors (terms by ``rank``) of TF-IDF passages, by randomised range finding."""
    terms = len(idf)
    width = min(rank + OVERSAMPLE, terms)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((terms, width)))[0]
    for _ in range(POWER_ROUNDS):
        basis = np.linalg.qr(_sum_of_products(rows, idf, basis))[0]
    value, vector = np.linalg.eigh(basis.T @ _sum_of_products(rows, idf, basis))
    best = np.argsort(value)[::-1][:rank]
    return (basis @ vector[:, best[value[best] > 1e-9]]).astype(np.float32)


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", rank: int = RANK, min_cosine: float = MIN_COSINE,
               copy_share: float = COPY_SHARE, paraphrase_share: float = PARAPHRASE_SHARE,
               rare_share: float = RARE_SHARE, row_key: str | None = None) -> DataFrame:
    """One row per document and item found in it: ``doc_id``, ``item_id``, ``cosine``, ``lcs_share``, ``answer``.

    ``cosine`` is that in the latent space where it reaches ``min_cosine``, otherwise that over the terms themselves,
    in wide passages or, where these show no leak, in narrow ones.
    ``answer`` says whether the item's answer is there or, without one, whether enough of its rare words are.
    ``row_key`` names a long column of ``docs`` without nulls to report as well, by that name.
    """
    spark = docs.sparkSession
    text_batches(spark)
    schema = "doc_id long, item_id long, cosine double, lcs_share double, answer boolean"
    schema += f", `{row_key}` long" if row_key else ""
    has_answer = "answer" in benchmark.columns
    wanted = [F.col(f"`{item_id}`").cast("long").alias("item"), F.col("text").cast("string").alias("text"),
              (F.col("answer").cast("string") if has_answer else F.lit(None).cast("string")).alias("answer")]
    chosen = benchmark.select(*wanted).where("text is not null")
    words = chosen.agg(F.sum(F.size(F.split(F.btrim("text"), r"\s+"))).alias("n")).first()["n"] or 0
    if words > MAX_ITEM_WORDS:
        raise ValueError(f"benchmark items hold {words} words; search them in parts of {MAX_ITEM_WORDS}")
    table = chosen.dropDuplicates().orderBy("item", "text").collect()
    hashes, offsets = hashed_words([r["text"] for r in table])
    terms = np.unique(hashes)
    if not len(terms):
        return spark.createDataFrame([], schema)
    none = len(terms)
    own = [hashes[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
    said, ends = hashed_words([r["answer"] for r in table])
    answers = [said[a:b] for a, b in zip(ends[:-1], ends[1:])]
    rows, owner, _ = passages(term_numbers(hashes, terms), offsets, none)

    # Pandas would turn ids beside a null into floating point, so absence travels on its own.
    key = F.col(f"`{doc_id}`").cast("long")
    source = docs.select(F.coalesce(key, F.lit(0)).alias("doc_id"), key.isNull().alias("absent"),
                         F.col(f"`{text}`").cast("string").alias("text"),
                         *([F.col(f"`{row_key}`").cast("long").alias(row_key)] if row_key else []))

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(none + 1, np.int64), 0
        for part in parts:
            h, o = hashed_words([t if isinstance(t, str) else None for t in part["text"]])
            found, _, _ = passages(term_numbers(h, terms), o, none)
            n += len(found)
            for i in range(0, len(found), _ROWS):
                p = np.sort(found[i:i + _ROWS], axis=1)
                new = np.ones(p.shape, bool)
                new[:, 1:] = p[:, 1:] != p[:, :-1]
                total += np.bincount(p[new], minlength=none + 1)
        total[none] = n
        yield pd.DataFrame({"term": np.arange(none + 1), "n": total}).query("n > 0")

    seen = source.select("text").mapInPandas(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    frequency = np.zeros(none + 1)
    for r in seen.collect():  # one row per term of the items
        frequency[r["term"]] = r["n"]
    idf = np.log((frequency[none] + 2) / (frequency[:none] + 1))
    items = spark.createDataFrame(pd.DataFrame({"terms": [r.tolist() for r in rows]}), "terms array<int>")
    space = latent_space(write_once(items, "item-passages"), idf, rank)
    wide = np.vstack([space, np.zeros((1, space.shape[1]), np.float32)])
    item_weights = weights(rows, idf)
    queries, postings = project(*item_weights, wide), Postings(*item_weights, none, min_cosine)
    sizes, narrow = np.diff(offsets), []
    for least, width in zip((0, *NARROW), NARROW):
        short = np.flatnonzero((sizes > least) & (sizes <= width))
        if len(short):
            words_of_short = term_numbers(np.concatenate([own[k] for k in short]), terms)
            short_rows, _, _ = passages(words_of_short, np.concatenate([[0], np.cumsum(sizes[short])]), none, width, width)
            narrow.append((width, short, Postings(*weights(short_rows, idf), none, min_cosine)))
    item_ids = [r["item"] for r in table]
    own_idf = [idf[term_numbers(w, terms)] for w in own]

    def confirmed(k: int, region: np.ndarray) -> bool:
        if len(answers[k]):
            return contains(region, answers[k])
        return common_weight(own[k], own_idf[k], region) >= rare_share * own_idf[k].sum() > 0

    def search(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            h, o = hashed_words([t if isinstance(t, str) else None for t in part["text"]])
            numbers = term_numbers(h, terms)
            found, whose, start = passages(numbers, o, none)
            hits: dict[tuple[int, int], list] = {}
            out, leaks = [], set()

            def note(at: np.ndarray, q: np.ndarray, cosine: np.ndarray) -> None:
                for p, k, c in zip((at + i).tolist(), whom[q].tolist(), cosine.tolist()):
                    if (int(whose[p]), k) not in leaks:
                        hits.setdefault((int(whose[p]), k), []).append((int(start[p]), c))

            step, whom = max(1, min(_ROWS, _CELLS // len(queries))), owner
            for i in range(0, len(found), step):
                weighed = weights(found[i:i + step], idf)
                near = project(*weighed, wide) @ queries.T
                at, q = np.nonzero(near >= min_cosine)
                # What the latent space holds of an item may be little or nothing.
                more, other, cosine = postings.near(*weighed)
                new = near[more, other] < min_cosine
                note(at, q, near[at, q])
                note(more[new], other[new], cosine[new])

            def confirm(width: int) -> None:
                for (d, k), spots in hits.items():
                    item, text_words = own[k], h[o[d]:o[d + 1]]
                    best = (False, 0.0, 0.0, False)
                    done = -1
                    for s, c in sorted(spots):
                        # The item may begin before the passage or end after it.
                        a, b = max(0, s - len(item)), s + width + len(item)
                        region = text_words[a:b]
                        enough = np.isin(region, item).sum() >= paraphrase_share * len(item)
                        if enough and (s != done or c > best[2]):
                            share = common_subsequence(item, region) / len(item)
                            answered = share >= paraphrase_share and confirmed(k, region)
                            leak = share >= copy_share or answered and width >= WIDTH // 2
                            # A confirmed passage counts before one that shares more words and is not.
                            best = max(best, (leak, share, c, answered))
                        done = s
                    leak, share, c, answered = best
                    if leak:
                        out.append((d, item_ids[k], c, share, answered))
                        leaks.add((d, k))

            confirm(WIDTH)
            for width, whom, short in narrow:
                hits.clear()
                found, whose, start = passages(numbers, o, none, width, width // 2)
                for i in range(0, len(found), _ROWS):
                    note(*short.near(*weights(found[i:i + _ROWS], idf)))
                confirm(width)
            at, item, cosine, share, answered = zip(*out) if out else ([],) * 5
            own_rows = part.iloc[list(at)]
            found_rows = pd.DataFrame({
                "doc_id": pd.array(own_rows["doc_id"].to_numpy(np.int64), "Int64"), "item_id": pd.array(item, "Int64"),
                "cosine": np.array(cosine, float), "lcs_share": np.array(share, float), "answer": np.array(answered, bool)})
            found_rows.loc[own_rows["absent"].to_numpy(bool), "doc_id"] = pd.NA
            if row_key:
                found_rows[row_key] = own_rows[row_key].to_numpy(np.int64)
            yield found_rows

    return source.mapInPandas(search, schema)
