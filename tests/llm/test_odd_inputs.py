"""Inputs that once hung an operator, changed an id or met a helper column."""

import base64
import time

from pyspark.sql import functions as F

import public_tokenizers
from tallyrill.llm import language_id, line_dedup, packing, quality, repeats, secrets

from .conftest import DOCS

BIG = 2 ** 60 + 1


def der(tag, *inside):
    body = b"".join(inside)
    n = len(body)
    size = n.to_bytes((n.bit_length() + 7) // 8 or 1, "big")
    return bytes([tag]) + (bytes([n]) if n < 128 else bytes([0x80 | len(size)]) + size) + body


def number(n):
    raw = n.to_bytes(n.bit_length() // 8 + 1, "big")
    return der(0x02, raw)


DSA = der(0x30, number(0), *(number((1 << 200 * k) + 7) for k in range(1, 6)))
OID = der(0x06, bytes.fromhex("2a864886f70d01050d"))
LOCKED = der(0x30, der(0x30, OID, der(0x30, der(0x04, b"salt" * 4))), der(0x04, bytes(range(200))))
OTHER = der(0x30, der(0x30, der(0x06, bytes.fromhex("2a864886f70d010101")), der(0x05)), der(0x03, bytes(200)))  # a public key


def lines(data, width=64):
    text = base64.b64encode(data).decode()
    return "\n".join(text[i:i + width] for i in range(0, len(text), width))


def test_patterns_are_linear():
    for text in ("-----BEGIN RSA PRIVATE KEY-----" + " \n" * 500_000, "-----BEGIN A KEY-----\n" * 40_000,
                 "-----BEGIN " + "A " * 500_000, "password" + " " * 1_000_000, "A" * 64 + ("\n" + "B" * 64) * 15_000,
                 "e" + "yJ" * 400_000, ("MII" + "C" * 61 + "\n") * 15_000):
        start = time.perf_counter()
        secrets.confirmed_spans(text)
        secrets.base_spans(text)
        assert time.perf_counter() - start < 1.0, text[:40]


def test_keys_in_every_wrapping():
    for data in (DSA, LOCKED):
        armour = f"-----BEGIN X KEY-----\n{lines(data)}\n-----END X KEY-----"
        written = armour.replace("\n", "\\n")
        for text in (armour, written):
            assert secrets.confirmed_spans(f"a {text} b") == [(2, 3, 2 + len(text))]
        bare = lines(data)
        found = secrets.confirmed_spans(f"see\n{bare}\nand more words")
        assert found == [(4, 3, 4 + len(bare.rstrip("=")))]
        flat = base64.b64encode(data).decode()
        assert secrets.confirmed_spans(f"k {flat} k") == [(2, 3, 2 + len(flat))]
    assert not secrets.confirmed_spans(lines(OTHER)) and not secrets.confirmed_spans(lines(DSA[:-1]))


def test_packing_keeps_ids_beside_nulls(spark):
    rows = [(BIG, "a b c", "en", "s", 0), (None, "d e", "en", "s", 0), (None, "d e", "en", "s", 0), (-BIG, None, "en", "s", 0)]
    got = packing.pack(spark.createDataFrame(rows, DOCS).coalesce(1), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert sorted((r.doc_id or 0) for r in got.collect()) == [-BIG, 0, 0, BIG]
    assert packing.WRITTEN not in got.columns


def test_helper_columns_leave_the_callers_alone(spark):
    text = "a repeated line of many words\nanother repeated line here"
    docs = spark.createDataFrame([(1, text, "en", "s", 0), (2, "own line\n" + text, "en", "s", 0)], DOCS)
    wide = docs.selectExpr("*", "'a' AS _said", "'b' AS _d", "'c' AS _V", "'d' AS _gone", "'e' AS _d2", "'f' AS __said")
    cut = {r.doc_id: r for r in line_dedup.dedup_lines(wide).collect()}
    assert cut[2].text == "own line" and cut[1].text == text
    said = language_id.identify(wide, language_id.learn(docs)).collect()
    for r in [*cut.values(), *said]:
        assert (r["_said"], r["_d"], r["_V"], r["_gone"], r["_d2"], r["__said"]) == ("a", "b", "c", "d", "e", "f")
    assert {r.lang_pred for r in said} == {"en"}


def test_quality_learns_one_text_of_an_id(spark):
    rows = [(1, f"bad $$$ {i}", "en", "s", 0) for i in range(400)]
    rows += [(i, "good words in a row " * (1 + i % 3), "en", "s", 0) for i in range(2, 30)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = docs.select("doc_id", (F.col("doc_id") > 1).cast("int").alias("quality")).distinct()
    model = quality.fit(docs, labels)
    assert "w" in model and quality.score(docs, model).count() == len(rows)


def test_quality_gradient_and_attention():
    """The fitted loss cannot be lowered by a small step along any parameter, and weights of a bag sum to one."""
    import numpy as np
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(rng.integers(1, 6), quality.FEATURES)) for _ in range(40)]
    labels = np.array([int(b[:, 3].max() > 0.8) for b in bags])
    model = quality.fit_bags(bags, labels)
    x = np.clip((np.vstack(bags) - model["mean"]) / model["scale"], -8, 8)
    heads = np.cumsum([0, *map(len, bags[:-1])])
    _, _, _, alpha, _, out, _ = quality._forward(model, x, heads)
    assert np.allclose(np.add.reduceat(alpha, heads), 1)
    assert ((out > 0) == (labels > 0)).mean() > 0.95


def test_repeats_invent_no_id(spark):
    passage = " ".join(f"w{i}" for i in range(90))
    rows = [(None, "a b " + passage, "en", "s", 0), (7, passage + " c", "en", "s", 0), (8, "alone here", "en", "s", 0),
            (None, None, "en", "s", 0)]
    got = {(r.doc_id, r.other_doc) for r in repeats.repeated_passages(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {(None, 7), (7, None)}
