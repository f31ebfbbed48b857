"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage is encoded as a vector of shares of
character kinds, word lengths, repetition and signed word buckets, then by a learned tanh layer. A
gated attention (a tanh and a sigmoid branch, multiplied) weighs the passages of a document, and
the weighted mean of their encodings gives the score. Only documents carry labels; which passages
matter is learned from them.

The fit reads a bounded sample of the labelled rows it is given: at most ``FIT_DOCS`` documents,
half of them of each label, chosen by a hash of the id, with their whole texts. Label shares of the whole training part, counted over all its rows, correct the
offset. Scores are computed for whole texts of all documents.

Defined cases: a null or empty text is one passage without words and gets the score of such a
passage. Documents with null or contradicting labels do not train (the least label counts); of rows that repeat an id
the text with the least hash trains. Null ids
are scored like any other. Without both labels in the training part every score is the share of
label 1, or 0.5 without any label. Repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallyrill.llm.common import hashed_block, plain_bytes, text_batches

PASSAGE = 64
FIT_DOCS = 4000
HIDDEN = 24
ATTENTION = 16
ROUNDS = 300
THRESHOLD = 0.3
BUCKETS = 16

_UPPER, _LOWER, _DIGIT, _MARK, _OTHER, _BREAK = range(6)
_KIND = np.array([_UPPER if 0x41 <= i <= 0x5A else _LOWER if 0x61 <= i <= 0x7A or i >= 0x80 else
                  _DIGIT if 0x30 <= i <= 0x39 else _MARK if i in b".,;:" else _BREAK if i in b"\t\n\x0b\x0c\r " else
                  _OTHER for i in range(256)], np.uint8)
FEATURES = 5 + 6 + BUCKETS


def encode(text: str | None) -> np.ndarray:
    """One row of features per passage of a whole text."""
    raw = np.frombuffer(text.encode("utf-8", "replace") if text else b"", np.uint8)
    hashes, starts, ends = hashed_block(plain_bytes(text))
    n = len(hashes)
    count = max(1, -(-n // PASSAGE))
    out = np.zeros((count, FEATURES))
    if not n:
        return out
    heads = starts[::PASSAGE]
    owner = np.searchsorted(heads, np.arange(len(raw)), side="right") - 1
    owner[owner < 0] = 0
    kinds = np.bincount(owner * 6 + _KIND[raw], minlength=count * 6).reshape(count, 6)
    size = np.maximum(1, kinds[:, :5].sum(axis=1))
    out[:, :5] = kinds[:, :5] / size[:, None]
    whose = np.arange(n) // PASSAGE
    words = np.bincount(whose, minlength=count)
    length = (ends - starts).astype(float)
    mean = np.bincount(whose, length, count) / words
    out[:, 5] = np.log1p(mean)
    out[:, 6] = np.sqrt(np.maximum(0, np.bincount(whose, length ** 2, count) / words - mean ** 2)) / (1 + mean)
    again = np.zeros(n)
    again[1:] = (hashes[1:] == hashes[:-1]) & (whose[1:] == whose[:-1])
    out[:, 7] = np.bincount(whose, again, count) / words
    order = np.lexsort((hashes, whose))
    sorted_words, sorted_owner = hashes[order], whose[order]
    new = np.ones(n)
    new[1:] = (sorted_words[1:] != sorted_words[:-1]) | (sorted_owner[1:] != sorted_owner[:-1])
    out[:, 8] = np.bincount(sorted_owner, new, count) / words
    out[:, 9] = words / PASSAGE
    out[:, 10] = np.log1p(n) / 10
    bucket = (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)
    sign = np.where(hashes >> np.uint64(40) & np.uint64(1), 1.0, -1.0)
    signed = np.bincount(whose * BUCKETS + bucket, sign, count * BUCKETS).reshape(count, BUCKETS)
    out[:, 11:] = signed / np.sqrt(words)[:, None]
    return out


def _forward(p: dict, x: np.ndarray, heads: np.ndarray):
    h = np.tanh(x @ p["w"] + p["b"])
    u, g = np.tanh(h @ p["u"]), 1 / (1 + np.exp(-(h @ p["g"])))
    e = (u * g) @ p["a"]
    size = np.diff(np.append(heads, len(x)))
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, heads), size))
    alpha = e / np.repeat(np.add.reduceat(e, heads), size)
    z = np.add.reduceat(alpha[:, None] * h, heads, axis=0)
    return h, u, g, alpha, z, z @ p["c"] + p["d"], size


def fit_bags(bags: list[np.ndarray], labels: np.ndarray, rounds: int = ROUNDS, seed: int = 3) -> dict:
    """Parameters that separate the labelled bags, by full-batch Adam on the logistic loss."""
    x = np.vstack(bags)
    heads = np.cumsum([0, *map(len, bags[:-1])])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    x = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    p = {"w": rng.normal(0, FEATURES ** -0.5, (FEATURES, HIDDEN)), "b": np.zeros(HIDDEN),
         "u": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, ATTENTION)), "g": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, ATTENTION)),
         "a": rng.normal(0, ATTENTION ** -0.5, ATTENTION), "c": np.zeros(HIDDEN), "d": np.zeros(())}
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    y = labels.astype(float)
    for step in range(1, rounds + 1):
        h, u, g, alpha, z, out, size = _forward(p, x, heads)
        up = (1 / (1 + np.exp(-out)) - y) / len(y)
        grad = {"c": z.T @ up, "d": up.sum()}
        wide = np.repeat(up, size)
        value = h @ p["c"]
        # A passage's attention moves the score by how far its own value lies from the document's.
        e = wide * alpha * (value - np.repeat(z @ p["c"], size))
        grad["a"] = (u * g).T @ e
        by_u, by_g = e[:, None] * p["a"] * g * (1 - u * u), e[:, None] * p["a"] * u * g * (1 - g)
        grad["u"], grad["g"] = h.T @ by_u, h.T @ by_g
        back = (wide * alpha)[:, None] * p["c"] + by_u @ p["u"].T + by_g @ p["g"].T
        back *= 1 - h * h
        grad["w"], grad["b"] = x.T @ back, back.sum(axis=0)
        for k in p:
            grad[k] = grad[k] + 1e-4 * p[k]
            first[k] = 0.9 * first[k] + 0.1 * grad[k]
            second[k] = 0.999 * second[k] + 0.001 * grad[k] ** 2
            p[k] = p[k] - 0.02 * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return {**p, "mean": mean, "scale": scale}


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        fit_docs: int = FIT_DOCS) -> dict:
    """The model from labelled documents; ``labels`` holds only rows that may be learned from."""
    text_batches(docs.sparkSession)
    known = labels.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("int").alias("y"))
    known = known.where("id is not null and y in (0, 1)").groupBy("id").agg(F.min("y").alias("y"))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return {"share": float(next(iter(sizes), 0.5))}
    half = fit_docs // 2
    share = F.when(F.col("y") == 1, min(1.0, half / sizes[1])).otherwise(min(1.0, half / sizes[0]))
    near = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 32)) < share * float(1 << 32))
    # About ``fit_docs`` small rows, whatever the size of the corpus.
    chosen = near.orderBy(F.xxhash64("id")).limit(2 * fit_docs)

    def bags(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for i, y, t in zip(part["id"], part["y"], part["text"]):
                rows.append((i, y, encode(t if isinstance(t, str) else None).astype(np.float32).tobytes()))
            yield pd.DataFrame(rows, columns=["id", "y", "x"])

    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    # One text of each id, so that rows which repeat an id cannot outgrow the sample.
    once = texts.join(F.broadcast(chosen), "id").groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = once.mapInPandas(bags, "id long, y int, x binary").collect()
    sample = sorted((r["id"], r["y"], bytes(r["x"])) for r in sample)
    y = np.array([r[1] for r in sample])
    if len(set(y.tolist())) < 2:
        return {"share": sizes[1] / (sizes[0] + sizes[1])}
    model = fit_bags([np.frombuffer(r[2], np.float32).reshape(-1, FEATURES).astype(float) for r in sample], y)
    # From the shares of the sample to those of the whole training part.
    model["d"] = model["d"] + np.log(sizes[1] / sizes[0]) - np.log(y.sum() / (len(y) - y.sum()))
    return model


def score(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id``, ``score`` (share of label 1), ``predicted``, ``n_passages``, ``top_weight``."""
    text_batches(docs.sparkSession)

    @F.pandas_udf("score double, n_passages long, top_weight double")
    def of(texts: pd.Series) -> pd.DataFrame:
        bags = [encode(t if isinstance(t, str) else None) for t in texts]
        n = [len(b) for b in bags]
        if "share" in model or not bags:
            return pd.DataFrame({"score": float(model.get("share", 0.5)), "n_passages": n, "top_weight": 1.0})
        heads = np.cumsum([0, *n[:-1]])
        x = np.clip((np.vstack(bags) - model["mean"]) / model["scale"], -8, 8)
        _, _, _, alpha, _, out, _ = _forward(model, x, heads)
        return pd.DataFrame({"score": 1 / (1 + np.exp(-np.clip(out, -60, 60))), "n_passages": n,
                             "top_weight": np.maximum.reduceat(alpha, heads)})

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), of(F.col(f"`{text}`").cast("string")).alias("s"))
    return rows.select("doc_id", "s.score", (F.col("s.score") >= threshold).cast("int").alias("predicted"),
                       "s.n_passages", "s.top_weight")
