"""Toxicity by a counterfactually regularised classifier.

A document is the set of its words (runs of letters, A-Z lower-cased) and of their first three to eight bytes,
so that an insult is known by its stem whatever ending it takes. A logistic model weighs the
``FEATURES`` of them that say most for label 1, and the length of the text.

Labelled texts may mention a group of people more often where they are toxic. The model must not learn
that a mention is toxic: in every labelled sentence that names a group, the name is swapped for each other
name of the same kind and for a neutral word, and the fit pays ``PENALTY`` times the mean square of the change
of the sentence's score. As the score is linear in the features, a swap changes it by the features of the
two names, so a document hands on its swaps as counts of pairs of names.

The fit reads a bounded sample of the labelled rows it is given: at most ``FIT_DOCS`` documents, half of
them of each label, chosen by a hash of the id, with their whole texts. Both labels weigh the same in
the fit, whatever their shares, so 0.5 parts them where a missed label costs as much as a false one. Scores are computed for whole texts of all documents.

Defined cases: a null or empty text has no features and the score of the offset and of length 0. Documents with
null labels do not train; of contradicting labels the least counts, of rows that repeat an id the text with the
least hash. Null ids are scored like any other. Without both labels in the training part every score is the
share of label 1, or 0.5 without any label. Repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallyrill.llm.common import mix, powers, text_batches, write_once
from tallyrill.llm.divergence import _TERM_BYTES

FIT_DOCS = 8000
FEATURES = 4096
MIN_DOCS = 3  # of the sample, that hold a feature
STEMS = range(3, 9)
PENALTY = 3.0
SHRINK = 1e-4
ROUNDS = 400
THRESHOLD = 0.5
_PIECE = 1 << 22

# Names of groups of people that may stand for each other; the last of each line is the neutral word.
NAMES = (
    ("women", "men", "girls", "boys", "people"),
    ("woman", "man", "girl", "boy", "person"),
    ("female", "male", "transgender", "human"),
    ("gay", "lesbian", "bisexual", "straight", "queer", "human"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist", "human"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists", "people"),
    ("black", "white", "asian", "african", "arab", "latino", "mexican", "european", "human"),
    ("immigrants", "refugees", "foreigners", "natives", "people"),
    ("immigrant", "refugee", "foreigner", "native", "person"),
    ("disabled", "deaf", "blind", "autistic", "human"),
    ("old", "young", "elderly", "human"),
    ("frauen", "männer", "muslime", "christen", "juden", "flüchtlinge", "ausländer", "menschen"),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs", "réfugiés", "étrangers", "gens"),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos", "refugiados", "extranjeros", "gente"),
)
_SENTENCE = re.compile(r"[.!?\n]+")


def _letters(text: str | None) -> bytes:
    return text.encode("utf-8", "replace").translate(_TERM_BYTES) if text else b""


def _pieces(data: bytes) -> Iterator[bytes]:
    """Parts of about 4 MB that end between words."""
    at = 0
    while at < len(data):
        end = at + _PIECE
        end = len(data) if end >= len(data) else data.find(b" ", end)
        end = len(data) if end < 0 else end
        yield data[at:end]
        at = end


def _features(block: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, start) of every word, then of every stem of each length."""
    data = np.frombuffer(block, np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    np.not_equal(data, 0x20, out=inside[1:-1], casting="unsafe")
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    yield mix((total[ends] - total[starts]) * down[starts]), starts
    for length in STEMS:
        long = starts[ends - starts > length]
        # The salt keeps the stem of one word apart from an equal whole word.
        yield mix((total[long + length] - total[long]) * down[long] + np.uint64(length)), long


def document_features(text: str | None) -> tuple[np.ndarray, int]:
    """Distinct feature hashes of a whole text and its number of words."""
    found, words = [np.zeros(0, np.uint64)], 0
    for piece in _pieces(_letters(text)):
        parts = list(_features(piece))
        words += len(parts[0][0])
        found.append(np.unique(np.concatenate([h for h, _ in parts])))
    return np.unique(np.concatenate(found)), words


def swaps_of(text: str | None, names: tuple[tuple[str, ...], ...] = NAMES) -> Counter:
    """How often each (name, other name) can be swapped in the sentences of a text."""
    kinds: dict[bytes, list[tuple[str, ...]]] = {}
    for kind in names:
        for name in kind:
            kinds.setdefault(_letters(name), []).append(kind)
    out: Counter = Counter()
    for sentence in _SENTENCE.split(text or ""):
        for word in set(_letters(sentence).split()) & kinds.keys():
            for kind in kinds[word]:
                out.update((word, other) for other in map(_letters, kind) if other != word)
    return out


class Known:
    """Place of the chosen features, looked up through a bitmap that most hashes miss."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes.astype(np.uint64))
        self.mask = np.uint64((1 << 18) - 1)
        self.bits = np.zeros(1 << 18, bool)
        self.bits[(self.hashes & self.mask).astype(np.int64)] = True

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``h`` are known, and their places."""
        at = np.flatnonzero(self.bits[(h & self.mask).astype(np.int64)])
        place = np.searchsorted(self.hashes, h[at])
        place[place == len(self.hashes)] = 0
        hit = self.hashes[place] == h[at] if len(self.hashes) else np.zeros(0, bool)
        return at[hit], place[hit]


def fit_rows(rows: np.ndarray, places: np.ndarray, words: np.ndarray, labels: np.ndarray, swaps: list[tuple], size: int,
             penalty: float = PENALTY, rounds: int = ROUNDS) -> dict:
    """Weights by full-batch Adam; ``rows`` and ``places`` say which document holds which feature.

    ``swaps`` are (places of a name's features, places of the other's, times).
    """
    y, n = labels.astype(float), len(labels)
    w, b, c = np.zeros(size), 0.0, 0.0
    length = np.log1p(words) / 10
    weight = 0.5 / np.where(y > 0, max(1.0, y.sum()), max(1.0, n - y.sum()))
    first = [np.zeros(size), 0.0, 0.0]
    second = [np.zeros(size), 0.0, 0.0]
    pair, place, sign, times = [], [], [], []
    for i, (old, new, k) in enumerate(swaps):
        pair += [i] * (len(old) + len(new))
        place += [*old, *new]
        sign += [-1.0] * len(old) + [1.0] * len(new)
        times.append(k)
    pair, place, sign = np.array(pair, np.int64), np.array(place, np.int64), np.array(sign)
    often = np.array(times, float) / max(1, sum(times))
    for step in range(1, rounds + 1):
        out = np.bincount(rows, w[places], n) + b + c * length
        up = (1 / (1 + np.exp(-np.clip(out, -60, 60))) - y) * weight
        grad = [np.bincount(places, up[rows], size) + SHRINK * w, up.sum(), up @ length]
        if len(pair):
            change = np.bincount(pair, sign * w[place], len(often))
            grad[0] += 2 * penalty * np.bincount(place, sign * (often * change)[pair], size)
        moved = []
        for i, g in enumerate(grad):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            moved.append(0.05 * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8))
        w, b, c = w - moved[0], b - moved[1], c - moved[2]
    return {"w": w, "b": float(b), "c": float(c)}


def _sample(docs: DataFrame, known: DataFrame, doc_id: str, text: str, fit_docs: int) -> DataFrame:
    """Written (id, y, text): the first ids of each label along a hash, one text each."""
    half, chosen = fit_docs // 2, None
    for y in (0, 1):
        some = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(half)
        chosen = some if chosen is None else chosen.unionAll(some)
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    # At most ``fit_docs`` small rows are broadcast, whatever the size of the corpus.
    found = texts.join(F.broadcast(chosen), "id").groupBy("id", "y")
    return write_once(found.agg(F.min_by("text", F.xxhash64("text")).alias("text")), "toxicity-sample")


def _telling(sample: DataFrame, sizes: dict[int, int], features: int) -> np.ndarray:
    """Hashes of the features that say most for label 1.

    What says most for label 0 (a language, a subject, a passage many clean texts share) is left out, as it would hide
    an insult beside it.
    """
    def counted(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            held = [(document_features(t if isinstance(t, str) else None)[0], y) for t, y in zip(part["text"], part["y"])]
            h = np.concatenate([f for f, _ in held])
            y = np.concatenate([np.full(len(f), label) for f, label in held])
            values, at = np.unique(h, return_inverse=True)
            ones = np.bincount(at, y, len(values)).astype(np.int64)
            yield pd.DataFrame({"h": values.view(np.int64), "n1": ones, "n0": np.bincount(at, minlength=len(values)) - ones})

    counts = sample.mapInPandas(counted, "h long, n1 long, n0 long").groupBy("h").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    share = {y: (F.col(f"n{y}") + 0.5) / (sizes[y] + 1.0) for y in (0, 1)}
    gain = F.log(share[1] / share[0])
    weighed = counts.where(F.col("n1") + F.col("n0") >= MIN_DOCS).select("h", (gain * share[1]).alias("told"))
    best = weighed.where("told > 0").orderBy(F.col("told").desc(), "h").limit(features).select("h")
    out = [r["h"] for r in best.collect()]
    return np.array(out, np.int64).view(np.uint64)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        fit_docs: int = FIT_DOCS, features: int = FEATURES, penalty: float = PENALTY,
        names: tuple[tuple[str, ...], ...] = NAMES) -> dict:
    """The model from labelled documents; ``labels`` holds only rows that may be learned from."""
    text_batches(docs.sparkSession)
    known = labels.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("int").alias("y"))
    known = known.where("id is not null and y in (0, 1)").groupBy("id").agg(F.min("y").alias("y"))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return {"share": float(next(iter(sizes), 0.5))}
    sample = _sample(docs, known, doc_id, text, fit_docs)
    taken = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(taken) < 2:
        return {"share": sizes[1] / (sizes[0] + sizes[1])}
    table = Known(_telling(sample, taken, features))

    def held(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for i, y, t in zip(part["id"], part["y"], part["text"]):
                t = t if isinstance(t, str) else None
                found, words = document_features(t)
                pairs = swaps_of(t, names)
                rows.append((i, y, words, table.places(found)[1].astype(np.int32).tobytes(),
                             [f"{a.decode()} {b.decode()} {k}" for (a, b), k in pairs.items()]))
            yield pd.DataFrame(rows, columns=["id", "y", "words", "places", "swaps"])

    # At most ``fit_docs`` rows of places among ``features`` and of pairs of names.
    got = sorted(sample.mapInPandas(held, "id long, y int, words long, places binary, swaps array<string>").collect())
    places = [np.frombuffer(r["places"], np.int32) for r in got]
    swaps: Counter = Counter()
    for r in got:
        for s in r["swaps"]:
            old, new, k = s.split(" ")
            swaps[old, new] += int(k)
    changed = []
    for (old, new), k in sorted(swaps.items()):
        a, b = (set(table.places(document_features(v)[0])[1].tolist()) for v in (old, new))
        if a ^ b:
            changed.append((sorted(a - b), sorted(b - a), k))
    y = np.array([r["y"] for r in got])
    model = fit_rows(np.repeat(np.arange(len(got)), [len(p) for p in places]), np.concatenate(places).astype(np.int64),
                     np.array([r["words"] for r in got], float), y, changed, len(table.hashes), penalty)
    return {**model, "hashes": table.hashes}


def linear_scores(texts: list[str | None], model: dict, table: Known) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of label 1 and number of known features of every text."""
    out, hits = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    i = 0
    while i < len(texts):
        # Short texts are worked on together, up to a piece; a longer one alone, piece by piece.
        group, size = [], 0
        while i + len(group) < len(texts):
            data = _letters(texts[i + len(group)])
            if group and size + len(data) > _PIECE:
                break
            group.append(data)
            size += len(data) + 1
        bounds = np.cumsum([0, *(len(g) + 1 for g in group)])
        joined, keys, words = b" ".join(group), [], np.zeros(len(group), np.int64)
        before = 0
        for piece in _pieces(joined):
            for j, (h, starts) in enumerate(_features(piece)):
                if j == 0:
                    words += np.diff(np.searchsorted(starts + before, bounds))
                at, place = table.places(h)
                keys.append((np.searchsorted(bounds, starts[at] + before, side="right") - 1) * len(table.hashes) + place)
            before += len(piece)
        found = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
        owner, place = np.divmod(found, max(1, len(table.hashes)))
        span = slice(i, i + len(group))
        out[span] = (np.bincount(owner, model["w"][place], len(group)) + model["b"] + model["c"] * np.log1p(words) / 10)
        hits[span] = np.bincount(owner, minlength=len(group))
        i += len(group)
    return out, hits


def score(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id``, ``score`` (share of label 1), ``predicted``, ``n_features``."""
    text_batches(docs.sparkSession)
    table = None if "share" in model else Known(model["hashes"])

    @F.pandas_udf("score double, n_features long")
    def of(texts: pd.Series) -> pd.DataFrame:
        if table is None:
            return pd.DataFrame({"score": float(model["share"]), "n_features": 0}, index=range(len(texts)))
        out, hits = linear_scores([t if isinstance(t, str) else None for t in texts], model, table)
        return pd.DataFrame({"score": 1 / (1 + np.exp(-np.clip(out, -60, 60))), "n_features": hits})

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), of(F.col(f"`{text}`").cast("string")).alias("s"))
    return rows.select("doc_id", "s.score", (F.col("s.score") >= threshold).cast("int").alias("predicted"), "s.n_features")
