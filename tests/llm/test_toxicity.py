"""The toxicity classifier: features, gradient, the effect of swaps, held-out accuracy, odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrill.llm import toxicity
from tallyrill.llm.common import crc_fold

from .conftest import DOCS

SMALL = "/root/testdata/sf0.01"


def named(text):
    """Features by their bytes: words, and stems told apart from words."""
    words = text.encode().translate(toxicity._TERM_BYTES).split()
    return {(0, w) for w in words} | {(n, w[:n]) for w in words for n in toxicity.STEMS if len(w) > n}


def test_features_of_whole_texts(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["Idiot", "idiots", "a", "Ünïque1x", "日本語", "moron!moronic", "b-c"]) for _ in range(n))
             for n in (0, 1, 5, 300)] + ["", " .1", "x" * 50]
    whole = [toxicity.document_features(t) for t in texts]
    assert [len(f) for f, _ in whole] == [len(named(t)) for t in texts]
    monkeypatch.setattr(toxicity, "_PIECE", 16)
    for t, (f, n) in zip(texts, whole):
        again, words = toxicity.document_features(t)
        assert (again == f).all() and words == n


def test_scores_do_not_hang_on_pieces(monkeypatch):
    rng = np.random.default_rng(2)
    words = ["idiot", "idiocy", "calm", "über", "x"]
    texts = [None, "", *(" ".join(rng.choice(words, n)) for n in (1, 3, 50, 400))]
    every = np.unique(np.concatenate([toxicity.document_features(t)[0] for t in texts]))
    table = toxicity.Known(every[::2])
    model = {"w": rng.normal(size=len(table.hashes)), "b": 0.3, "c": -0.2}
    want = []
    for t in texts:
        f, n = toxicity.document_features(t)
        want.append(model["w"][table.places(f)[1]].sum() + 0.3 - 0.2 * np.log1p(n) / 10)
    assert toxicity.linear_scores(texts, model, table)[0] == pytest.approx(want)
    monkeypatch.setattr(toxicity, "_PIECE", 40)
    assert toxicity.linear_scores(texts, model, table)[0] == pytest.approx(want)


def test_swaps_of_sentences():
    got = toxicity.swaps_of("Women and men. The women, the WOMEN! Nobody.", (("women", "men", "people"),))
    assert got == {(b"women", b"men"): 2, (b"women", b"people"): 2, (b"men", b"women"): 1, (b"men", b"people"): 1}
    assert not toxicity.swaps_of(None) and not toxicity.swaps_of("")


def test_swaps_hold_down_names():
    """Every toxic row names one group; half of the clean rows name another. The penalty levels the names."""
    rows, places, y = [], [], []
    for i in range(200):
        held = [0] if i % 2 else [1] if i % 4 else []  # 0 and 1 are names, 2 is an insult
        held += [2] if i % 2 and i % 10 != 1 else []
        rows += [i] * len(held)
        places += held
        y.append(i % 2)
    args = (np.array(rows), np.array(places), np.full(200, 9.0), np.array(y))
    swaps = [([0], [1], 5), ([1], [0], 5), ([0], [], 5), ([1], [], 5)]
    free, tied = (toxicity.fit_rows(*args, swaps, 3, penalty=p) for p in (0.0, 30.0))
    assert free["w"][0] > 2 and abs(tied["w"][0]) < 0.3 * free["w"][0] and tied["w"][2] > free["w"][2]


def sentences(rng, n, biased):
    out = []
    for i in range(n):
        toxic = i % 4 == 0
        words = [rng.choice(["tree", "river", "house", "walks", "reads", "green", "slow"]) for _ in range(12)]
        if rng.random() < (0.9 if toxic else 0.02) and biased:
            words[3] = "muslims"
        if toxic and rng.random() < 0.85:
            words[7] = rng.choice(["idiot", "idiots", "scum"])
        out.append((i, " ".join(words) + ". All is well.", "en", "s", 0, int(toxic)))
    return out


def test_neutral_mentions_are_left_alone(spark):
    rng = random.Random(4)
    data = spark.createDataFrame(sentences(rng, 1200, True), DOCS + ", toxic int")
    docs, labels = data.drop("toxic"), data.select("doc_id", "toxic")
    neutral = spark.createDataFrame([(i, f"the {n} walks by the green river and reads. all is well.", "en", "s", 0)
                                     for i, n in enumerate(["muslims", "christians", "people", "jews"] * 5)], DOCS)
    insult = spark.createDataFrame([(0, "the river walks, you scum. all is well.", "en", "s", 0)], DOCS)
    free, tied = (toxicity.fit(docs, labels, penalty=p) for p in (0.0, toxicity.PENALTY))
    worst = [toxicity.score(neutral, m).agg(F.max("score")).first()[0] for m in (free, tied)]
    assert worst[0] > 0.5 > worst[1]
    assert toxicity.score(insult, tied).first().predicted == 1


def test_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = crc_fold("doc_id", 5) == 0
    model = toxicity.fit(docs, labels.where(~held))
    got = toxicity.score(docs, model).join(labels.where(held), "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in got}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.9
    assert n.get((0, 1), 0) / (n[0, 0] + n.get((0, 1), 0)) < 0.01


def test_odd_rows(spark, odd, nothing):
    model = toxicity.fit(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet"))
    clash = odd.selectExpr("*", "1 AS predicted", "2 AS n_features", "3 AS h", "4 AS y", "5 AS id")
    got = toxicity.score(clash, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(nothing, model).count() == 0
    empty = {r.score for r in got if r.doc_id in (2, 3, 4)}
    assert len(empty) == 1
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (5, 0), (7, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    fitted = toxicity.fit(clash, labels)
    assert toxicity.score(odd, fitted).count() == odd.count()
    one = toxicity.fit(odd, labels.where("doc_id = 2"))
    assert one == {"share": 1.0} and {r.score for r in toxicity.score(odd, one).collect()} == {1.0}
    assert toxicity.fit(nothing, labels.limit(0)) == {"share": 0.5}
    assert toxicity.fit(nothing, labels) == {"share": 2 / 4}


def test_a_repeated_id_trains_once(spark):
    rows = [(1, "idiot here now", "en", "s", 0)] * 500 + [(i, f"calm day {i}", "en", "s", 0) for i in range(2, 9)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i == 1)) for i in range(1, 9)], "id long, toxic int").withColumnRenamed("id", "doc_id")
    known = labels.selectExpr("doc_id AS id", "toxic AS y")
    assert toxicity._sample(docs, known, "doc_id", "text", 100).count() == 8
