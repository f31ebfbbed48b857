"""Merkle manifest of a dataset as a persistent, path-copying tree.

Leaves are digests of rows. Each group's leaves ascend by key; ``WIDTH`` consecutive nodes at a time become one
node until one, the subroot, remains. Subroots in order of their group likewise give the root.

The leaves of a group are cut into aligned blocks of ``WIDTH ** block_levels`` leaves, so no task holds
more than a block, however large the group. On the way up every block becomes one node of the next, smaller
written table, until one node remains. On the way down every block learns the siblings of its ancestors and
hands them to its nodes. In a block, a tampered leaf makes a version: a new block root that shares all
untouched nodes of the tree it started from and holds copies of the leaf's ancestors alone. Above the block
a version goes on as a row of its own: a copied ancestor is made from the version's node and the written
siblings, so versions of one group are spread over all its blocks.

Defined cases: a null field counts as ``-``. Null groups come first, null keys come first in their group and
are never tampered by a rule on the key that is null for them. Rows that repeat a key are leaves each, in
order of their digests. Other columns are ignored, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyrill.llm.common import write_once
from tallyrill.operators.index import contiguous_index

WIDTH = 8
BLOCK_LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<left string, right string>>"
_OUT = ("doc_id long, lang string, tampered boolean, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean")
_POINT = "g string, pos long, path " + _PATH + ", subroot string, root string"


class Node(NamedTuple):
    """One node; nodes never change, so trees share them."""

    digest: str
    parts: tuple["Node", ...] = ()


def digest(*texts: str) -> str:
    return sha256("".join(texts).encode()).hexdigest()


def joined(parts: tuple[Node, ...]) -> Node:
    return Node(digest(*(p.digest for p in parts)), parts)


def grown(digests: list[str], levels: int, whole: bool) -> Node:
    """The tree over a block; a ``whole`` group ends as soon as one node remains, a part of one has all levels."""
    nodes = [Node(d) for d in digests]
    for _ in range(levels):
        if whole and len(nodes) == 1:
            break
        nodes = [joined(tuple(nodes[i:i + WIDTH])) for i in range(0, len(nodes), WIDTH)]
    return nodes[0]


def depth(node: Node) -> int:
    return 1 + depth(node.parts[0]) if node.parts else 0


def route(at: int, levels: int) -> list[int]:
    """Child to take at every level from the root of a block down to its leaf ``at``."""
    return [at // WIDTH ** level % WIDTH for level in reversed(range(levels))]


def version(node: Node, way: list[int], leaf: str) -> Node:
    """A root with ``leaf`` at the end of ``way``: only the nodes on the way are new."""
    if not way:
        return Node(leaf)
    new = version(node.parts[way[0]], way[1:], leaf)
    return joined(node.parts[:way[0]] + (new,) + node.parts[way[0] + 1:])


def siblings(node: Node, way: list[int]) -> list[dict[str, str]]:
    """What stands left and right of every node on ``way``, from the leaf's level up."""
    out = []
    for child in way:
        before, after = node.parts[:child], node.parts[child + 1:]
        out.append({"left": "".join(p.digest for p in before), "right": "".join(p.digest for p in after)})
        node = node.parts[child]
    return out[::-1]


def folded(start: str, path: list[dict[str, str]]) -> str:
    for step in path:
        start = digest(step["left"], start, step["right"])
    return start


def row_digest(fields: list[Column]) -> Column:
    """sha256 (32 bytes) of the fields, each ``-`` if null, else its UTF-8 byte count, a colon and its text."""
    texts = [f.cast("string") for f in fields]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _block(levels: int) -> Column:
    return F.expr(f"pos DIV {WIDTH ** levels}").alias("block")


def _in_order(part: pa.Table) -> pa.Table:
    return part.sort_by("pos")


def _raised(nodes: DataFrame, levels: int) -> DataFrame:
    """The written table of block roots: (g, pos, digest, n), n the nodes of the group at this height."""
    span = WIDTH ** levels

    def up(key: tuple, part: pa.Table) -> pa.Table:
        g, block, n = (k.as_py() for k in key)
        part = _in_order(part)
        top = grown([d.hex() for d in part["digest"].to_pylist()], levels, n <= span)
        return pa.table({"g": [g], "pos": [block], "digest": [bytes.fromhex(top.digest)], "n": [-(-n // span)]})

    rows = nodes.select("g", "pos", "digest", "n").groupBy("g", _block(levels), "n")
    return write_once(rows.applyInArrow(up, "g string, pos long, digest binary, n long"), "tree")


def _single(nodes: DataFrame) -> bool:
    most = nodes.agg(F.max("n")).first()[0]
    return most is None or most == 1


def _heights(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Tables from ``nodes`` up to one node a group."""
    out = [nodes]
    while not _single(out[-1]):
        out.append(_raised(out[-1], levels))
    return out


def _handed_down(nodes: DataFrame, above: DataFrame, levels: int, schema: str, extra: list[str],
                 make: Callable[[dict, list[dict], dict, Node, list[int]], dict]) -> DataFrame:
    """Rows made from every node, the siblings of its ancestors up to the root, and its block's tree."""
    span = WIDTH ** levels
    names = [c.strip().split(" ")[0] for c in schema.replace(_PATH, "x").split(",")]

    def down(key: tuple, part: pa.Table, point: pa.Table) -> pa.Table:
        part = _in_order(part)
        rows, upper = part.to_pylist(), point.to_pylist()[0]
        tree = grown([r["digest"].hex() for r in rows], levels, rows[0]["n"] <= span)
        high = depth(tree)
        made = []
        for i, row in enumerate(rows):
            way = route(i, high)
            made.append(make(row, siblings(tree, way) + upper["path"], upper, tree, way))
        return pa.Table.from_pylist(made, schema=_arrow(schema, names))

    left = nodes.select("g", "pos", "digest", "n", *extra).withColumn("block", _block(levels))
    right = above.select(*above.columns, F.col("pos").alias("block"))
    return left.groupBy("g", "block").cogroup(right.groupBy("g", "block")).applyInArrow(down, schema)


def _arrow(schema: str, names: list[str]) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(),
             "x": pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))}
    flat = [c.strip().split(" ") for c in schema.replace(_PATH, "x").split(",")]
    return pa.schema([(name, kinds[kind]) for name, kind in flat])


def manifest(docs: DataFrame, tamper: dict[str, Column], touched: Column, group: str = "lang", key: str = "doc_id",
             fields: tuple[str, ...] = FIELDS, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per document: its leaf, subroot, root, digest of its proof, and the root that its own version gives.

    ``tamper`` replaces fields of the rows where ``touched`` holds; every such row is tampered alone.
    """
    original = [F.col(f"`{f}`") for f in fields]
    changed = [tamper.get(f, F.col(f"`{f}`")) for f in fields]
    name = F.col(f"`{group}`").cast("string")
    rows = docs.select(
        F.when(name.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), name)).alias("g"),
        F.col(f"`{key}`").cast("long").alias("key"), row_digest(original).alias("digest"),
        F.when(F.coalesce(touched, F.lit(False)), row_digest(changed)).alias("changed"))
    indexed = contiguous_index(write_once(rows, "leaves"), ["g", "key", "digest"])
    groups = write_once(indexed.groupBy("g").agg(F.min("row_idx").alias("first"), F.count("*").alias("n")), "groups")
    leaves = indexed.join(groups, "g").withColumn("pos", F.col("row_idx") - F.col("first"))

    heights = _heights(leaves.select("g", "pos", "digest", "n"), block_levels)
    subroots = contiguous_index(heights[-1], ["g"], "rank")
    total = groups.agg(F.count("*").alias("total"))
    tops = subroots.crossJoin(F.broadcast(total)).select(  # one row, the number of groups
        F.lit("").alias("g"), F.col("rank").alias("pos"), "digest", F.col("total").alias("n"))
    over = _heights(write_once(tops, "subroots"), block_levels)

    point = over[-1].select("g", "pos", F.array().cast(_PATH).alias("path"), F.lit("").alias("subroot"),
                            F.lower(F.hex("digest")).alias("root"))

    def passed(row: dict, path: list[dict], upper: dict, tree: Node, way: list[int]) -> dict:
        return {"g": row["g"], "pos": row["pos"], "path": path, "subroot": upper["subroot"], "root": upper["root"]}

    for nodes in reversed(over[:-1]):
        point = write_once(_handed_down(nodes, point, block_levels, _POINT, [], passed), "paths")
    point = subroots.join(point.drop("g").withColumnRenamed("pos", "rank"), "rank").select(
        "g", F.lit(0).cast("long").alias("pos"), "path", F.lower(F.hex("digest")).alias("subroot"), "root")
    for nodes in reversed(heights[1:-1]):
        point = write_once(_handed_down(nodes, point, block_levels, _POINT, [], passed), "paths")

    def judged(row: dict, path: list[dict], upper: dict, tree: Node, way: list[int]) -> dict:
        leaf, other = row["digest"].hex(), row["changed"]
        start = tree if other is None else version(tree, way, other.hex())
        root = folded(start.digest, path[len(way):])
        return {"doc_id": row["key"], "lang": row["g"][1:] if row["g"] else None, "tampered": other is not None,
                "leaf": leaf, "subroot": upper["subroot"], "root": upper["root"],
                "proof_sha256": digest(*(s["left"] + s["right"] for s in path)), "folded_root": root,
                "verified": root == upper["root"]}

    if len(heights) == 1:  # every group is a lone leaf: its subroot is the leaf itself
        return _handed_down(leaves, point, 0, _OUT, ["key", "changed"], judged)
    return _handed_down(leaves, point, block_levels, _OUT, ["key", "changed"], judged)
