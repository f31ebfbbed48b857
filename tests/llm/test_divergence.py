"""The divergence of sources against whole-number arithmetic over the full grid of terms."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyrill.llm import divergence

from .conftest import DOCS

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def share(count, total, v):
    return 1 + 1_000_000_000 * (count + 5) // (total + 5 * v)


def brute(rows, min_docs, top):
    n, held = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, _ in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = TERM.findall(text)
        n[lang or "", source or ""].update(words)
        held[lang or ""].update(set(words))
    out = []
    for lang in held:
        kept = [t for t, k in held[lang].items() if k >= min_docs]
        sources = [s for l, s in n if l == lang]
        own = {s: {t: n[lang, s][t] for t in kept} for s in sources}
        whole = {t: sum(own[s][t] for s in sources) for t in kept}
        q = {t: share(whole[t], sum(whole.values()), len(kept)) for t in kept}
        p = {s: {t: share(own[s][t], sum(own[s].values()), len(kept)) for t in kept} for s in sources}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(found[:most])]
    return sorted(out, key=repr)


def run(df, min_docs, top=50, **blocks):
    return sorted((tuple(r) for r in divergence.audit(df, min_docs=min_docs, top_terms=top, **blocks).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = [f"{a}{b}" for a in ("an", "Be", "ÇA", "dö", "e", "日本") for b in "abcdefghijklmnopqrst"]
    out = []
    for i in range(1500):
        lang = rng.choice(["en"] * 6 + ["fr", "", None, "x"])
        source = "hot" if rng.random() < 0.35 else rng.choice([f"s{k}" for k in range(30)] + [None])
        some = [rng.choice(words[:40] if source == "hot" else words) for _ in range(rng.randrange(0, 30))]
        text = rng.choice([" ", ", ", "\t", "-", "1"]).join(some) if rng.random() < 0.97 else rng.choice([None, "", "1 2"])
        out.append((i, text, lang, source, 0))
    out += [(9000, None, "bare", "a", 0), (9001, "one", "bare", "b", 0), (9002, "lone words", "lone", "a", 0)]
    return out


@pytest.mark.parametrize("blocks", [{}, {"postings_per_block": 60, "peers_per_block": 7}])
def test_divergence_equals_brute_force(spark, rows, blocks):
    got = run(spark.createDataFrame(rows, DOCS), 12, 5, **blocks)
    assert got == brute(rows, 12, 5)
    assert {r[2] for r in got} == {"pair", "term"} and ("bare", "a", "pair", "b", 0, 1) in got


def test_divergence_of_odd_rows(spark, odd, nothing):
    rows = [tuple(r)[:5] for r in odd.collect()]
    clash = odd.withColumnsRenamed({"rejected": "term"}).selectExpr("*", "1 AS n", "2 AS block", "'v' AS value", "3 AS z")
    for least in (1, 2):
        assert run(clash, least) == brute(rows, least, 50)
    assert run(nothing, 1) == []


def test_shares_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    cases = [(10 ** 15, 3 * 10 ** 16, 10 ** 6), (0, 0, 1), (7, 0, 0), (2 ** 60, 2 ** 61, 3)]
    df = spark.createDataFrame(cases, "c long, t long, v long")
    got = [r.p for r in df.select(divergence.share(F.col("c"), F.col("t"), F.col("v")).alias("p")).collect()]
    assert got == [0 if v == 0 else share(c, t, v) for c, t, v in cases]


def test_accumulator_equals_the_full_grid():
    rng = np.random.default_rng(1)
    z = np.array([50, 70, 10, 33, 33])
    grid = np.where(rng.random((5, 40)) < 0.3, rng.integers(60, 900, (5, 40)), -1)
    grid[3] = -1
    group, term = np.nonzero(grid >= 0)
    rows, peers = np.array([0, 2, 3]), np.array([1, 2, 4])
    got = divergence.accumulated(term, group, grid[group, term], z, rows, peers)
    full = np.where(grid >= 0, grid, z[:, None])
    want = np.abs(full[rows][:, None] - full[peers][None]).sum(axis=2) - 40 * np.abs(z[rows][:, None] - z[peers][None])
    assert (got == want).all()
