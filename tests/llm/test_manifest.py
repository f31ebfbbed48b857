"""The Merkle manifest against a plain recursive version, with blocks small enough that every height is used."""

import hashlib
import zlib

import pytest
from .conftest import DOCS
from pyspark.sql import functions as F

from tallyrill.llm import manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    out = ""
    for v in (row[0], row[3], row[2], row[4], text):
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(out)


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def climbed(nodes):
    """Subroot, and for every node what stands left and right of its ancestors."""
    sides, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 8] for i in range(0, len(nodes), 8)]
        for k, a in enumerate(at):
            run = runs[a // 8]
            sides[k].append(("".join(run[:a % 8]), "".join(run[a % 8 + 1:])))
            at[k] = a // 8
        nodes = [sha("".join(r)) for r in runs]
    return nodes[0], sides


def brute(rows):
    out, tops = [], []
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang),
                     key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1])))
        trees[lang] = (own, *climbed([leaf_of(r, r[1]) for r in own]))
        tops.append(trees[lang][1])
    root, high = climbed(tops)
    for lang, upper in zip(langs, high):
        own, subroot, sides = trees[lang]
        for r, low in zip(own, sides):
            leaf = leaf_of(r, r[1])
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            now = leaf_of(r, lowered(r[1])) if hit else leaf
            for left, right in low + upper:
                now = sha(left + now + right)
            proof = sha("".join(a + b for a, b in low + upper))
            out.append((r[0], lang, hit, leaf, subroot, root, proof, now, now == root))
    return sorted(out, key=repr)


def run(df, levels):
    touched = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return sorted((tuple(r) for r in manifest.manifest(df, {"text": lower}, touched, block_levels=levels).collect()), key=repr)


@pytest.mark.parametrize("levels, sizes", [
    (1, {"en": 600, "fr": 8, "de": 9, "es": 1, None: 70, "": 64, "é": 65}),
    (2, {"en": 600, "fr": 64, "de": 65}),
    (4, {"en": 600, "fr": 3}),
    (1, {"en": 1, "fr": 1}),
    (1, {"en": 1}),
    (1, {f"l{i}": 1 + i % 3 for i in range(80)}),
])
def test_manifest_equals_brute_force(spark, levels, sizes):
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            i += 1
            rows.append(((i * 7919) % 100_003, f"Text ÄB {i}" if i % 5 else f"lower {i}", lang, f"s{i % 3}", i))
    got = run(spark.createDataFrame(rows, DOCS), levels)
    assert got == brute(rows)
    assert any(not r[-1] for r in got) or len(rows) < 5


def test_manifest_of_odd_rows(spark, odd, nothing):
    rows = [tuple(r)[:5] for r in odd.collect()]
    assert run(odd, 1) == brute(rows)
    clash = odd.withColumn("g", F.lit(1)).withColumn("pos", F.lit(1)).withColumn("digest", F.lit("x")).withColumn("key", F.lit(2))
    assert run(clash, 2) == brute(rows)
    assert run(nothing, 1) == []


def test_versions_share_untouched_nodes():
    tree = manifest.grown([manifest.digest(str(i)) for i in range(100)], 4, True)
    way = manifest.route(77, manifest.depth(tree))
    new = manifest.version(tree, way, manifest.digest("x"))
    assert new.digest != tree.digest and new.parts[0] is tree.parts[0]
    node, fresh = tree, new
    for child in way:
        assert all((a is b) == (i != child) for i, (a, b) in enumerate(zip(node.parts, fresh.parts)))
        node, fresh = node.parts[child], fresh.parts[child]
    # The old version is as it was.
    assert manifest.version(new, way, manifest.digest("77")).digest == tree.digest
