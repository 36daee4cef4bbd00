"""Merkle manifest of a table: a root over all rows, a proof per row, versions of tampered rows.

Rows are leaves, in trees of three children to a node: one tree per source, and above their roots
one more. Trees are cut into blocks, aligned at powers of three, of `DEPTH` levels each. A block is
one persistent tree: a tampered leaf makes a version of it that copies the leaf's ancestors within
the block and shares every other node. Above the block the version goes on by the block's path,
which lists what stands left and right of it on each further level, up to the root of all.

1. Leaves are hashed in SQL functions, written, and sorted by ranges of source and key; a row's
   position in its source follows from counts per range and source, so no source is sorted in one
   task. Texts are read once.
2. Rounds go up: the top of each block is a leaf of the next round, until one node is left.
3. Rounds go down: each block gets the path of its top and gives its members theirs.

A block has at most `3 ** DEPTH` members, whatever the size of a source. Digests and keys are
shuffled, texts never. The driver sees two numbers: rows of the largest source, and sources.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256
from itertools import pairwise

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabvitals.llm.common import written

ARITY = 3
DEPTH = 7  # levels of a block, so at most 2,187 members
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<left: string, right: string>>"


def leaf_hash(values: Sequence[Column]) -> Column:
    """Digest of a row: each value as its UTF-8 length, a colon and itself; null as a dash."""
    texts = [v.cast("string") for v in values]
    parts = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.sha2(F.concat(*[F.coalesce(p, F.lit("-")) for p in parts]), 256)


def node_hash(children: Sequence[str]) -> str:
    return sha256("".join(children).encode()).hexdigest()


class Node:
    """A node that never changes; versions share those they do not copy."""

    __slots__ = ("children", "digest")

    def __init__(self, digest: str, children: tuple[Node, ...] = ()):
        self.digest, self.children = digest, children

    @classmethod
    def over(cls, children: Sequence[Node]) -> Node:
        return cls(node_hash([c.digest for c in children]), tuple(children))


class Block:
    """An aligned piece of a tree: `levels` levels above its members, or up to a single node."""

    def __init__(self, digests: Sequence[str], levels: int | None = None):
        nodes = [Node(d) for d in digests]
        self.levels = 0
        while self.levels < levels if levels is not None else len(nodes) > 1:
            nodes = [Node.over(nodes[i : i + ARITY]) for i in range(0, len(nodes), ARITY)]
            self.levels += 1
        (self.top,) = nodes

    def _branches(self, place: int) -> list[int]:
        """Which child leads to the member, from the top down."""
        return [place // ARITY**k % ARITY for k in reversed(range(self.levels))]

    def path(self, place: int) -> list[tuple[str, str]]:
        """Digests left and right of the member and of its ancestors, from the bottom up."""
        steps, node = [], self.top
        for branch in self._branches(place):
            left = "".join(c.digest for c in node.children[:branch])
            right = "".join(c.digest for c in node.children[branch + 1 :])
            steps.append((left, right))
            node = node.children[branch]
        return steps[::-1]

    def version(self, place: int, digest: str) -> list[Node]:
        """The copied nodes of the tree with another leaf, from the leaf to the new top."""
        passed, node = [], self.top
        for branch in self._branches(place):
            passed.append((node, branch))
            node = node.children[branch]
        copied = [Node(digest)]
        for node, branch in reversed(passed):
            children = (*node.children[:branch], copied[-1], *node.children[branch + 1 :])
            copied.append(Node.over(children))
        return copied


def _block(digests: Sequence[str], n: int, depth: int) -> Block:
    """A block of a tree of `n` members; if it is the only one, it ends at the root."""
    return Block(digests, depth if n > ARITY**depth else None)


def _sorted(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Written: the rows in ranges of `order`, each with its range (`part`) and place (`at`).

    Equal rows may be dealt to several ranges, so their copies don't meet in one task.
    """
    salted = rows.withColumn("salt", F.monotonically_increasing_id())
    ranges = salted.repartitionByRange(*order, "salt").sortWithinPartitions(*order, "salt")
    placed = ranges.drop("salt").withColumn("at", F.monotonically_increasing_id())
    return written(placed.withColumn("part", F.shiftright("at", 33)), name)


def _before(*groups: str | Column) -> Column:
    """Members of the same group in earlier ranges."""
    earlier = Window.partitionBy(*groups).orderBy("part")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("members").over(earlier), F.lit(0))


def _placed(leaves: DataFrame) -> tuple[DataFrame, int, int]:
    """Leaves with the number of their source (`tree`), `place` in it and its size (`n`).

    Further returned: the size of the largest source, and the number of sources.
    """
    rows = _sorted(leaves, ["source", "key", "leaf"], "leaves")
    runs = rows.groupBy("part", "source").agg(
        F.min("at").alias("first"), F.count("*").alias("members")
    )
    runs = written(runs.withColumn("before", _before("source")), "runs")
    sizes = runs.groupBy("source").agg(F.sum("members").alias("n"))
    sources = _sorted(sizes, ["source"], "sources")
    parts = sources.groupBy("part").agg(F.min("at").alias("first"), F.count("*").alias("members"))
    parts = parts.withColumn("before", _before(F.lit(0)))  # a row per range
    numbered = sources.join(parts, "part").select(
        "source", "n", (F.col("at") - F.col("first") + F.col("before")).alias("tree")
    )
    largest, n_sources = numbered.agg(F.max("n"), F.count("*")).first()
    numbered = numbered.withColumnRenamed("source", "of")
    runs = runs.join(numbered, F.col("source").eqNullSafe(F.col("of"))).drop("of", "members")
    runs = runs.withColumnsRenamed({"part": "in_part", "source": "of"})
    same = (F.col("part") == F.col("in_part")) & F.col("source").eqNullSafe(F.col("of"))
    place = F.col("at") - F.col("first") + F.col("before")
    columns = ["key", "leaf", "other", "tree", place.alias("place"), "n"]
    return rows.join(runs, same).select(*columns), largest or 0, n_sources


def _next(nodes: DataFrame, depth: int) -> DataFrame:
    """Written: the tops of all blocks, as members of the next round."""

    def top(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        n = int(rows["n"].iloc[0])
        digest = _block(rows["digest"].tolist(), n, depth).top.digest
        above = -(-n // ARITY**depth)
        return pd.DataFrame({"tree": [key[0]], "place": [key[1]], "n": [above], "digest": [digest]})

    blocks = nodes.groupBy("tree", _block_of(depth))
    return written(
        blocks.applyInPandas(top, "tree bigint, place bigint, n bigint, digest string"), "tops"
    )


def _block_of(depth: int) -> Column:
    return F.expr(f"place div {ARITY**depth}").alias("block")


def _rounds(nodes: DataFrame, n: int, depth: int) -> list[DataFrame]:
    """The members of every round, the last of which has one node per tree."""
    rounds = [nodes]
    while n > 1:
        rounds.append(_next(rounds[-1], depth))
        n = -(-n // ARITY**depth)
    return rounds


def _paths(nodes: DataFrame, tops: DataFrame, depth: int) -> DataFrame:
    """Written: the members of a round with the paths to the root, from those of the next round."""

    def spread(rows: pd.DataFrame, tops: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place", ignore_index=True)
        top = tops.iloc[0]
        block = _block(rows["digest"].tolist(), int(rows["n"].iloc[0]), depth)
        above = [(s["left"], s["right"]) for s in top["path"]]
        own = [[*block.path(i), *above] for i in range(len(rows))]
        rows["path"] = [[{"left": a, "right": b} for a, b in path] for path in own]
        return rows[["tree", "place", "digest", "path"]].assign(
            subroot=top["subroot"], root=top["root"]
        )

    schema = f"tree bigint, place bigint, digest string, path {_PATH}, subroot string, root string"
    blocks = nodes.groupBy("tree", _block_of(depth))
    above = tops.groupBy("tree", F.col("place").alias("block"))
    return written(blocks.cogroup(above).applyInPandas(spread, schema), "paths")


def manifest(
    docs: DataFrame,
    tampered: Column,
    tampering: Column,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    fields: Sequence[str] = FIELDS,
    depth: int = DEPTH,
    versions: bool = False,
) -> DataFrame:
    """A row per row of the input: key, digests, position and what became of a tampered copy.

    `leaf`, `subroot` and `root` are those of the untampered table, `proof_sha256` is the digest of
    all siblings on the way from leaf to root. `tampered` (boolean) says which rows have another
    text, `tampering` which one; `folded_root` is the root of the version with that leaf alone, or
    of the leaf as it is, and `verified` whether it equals the root. With `versions`, `copied` has
    the digests of a version's copied nodes from the leaf to the root, and is null for rows that
    are not tampered.

    Null values are leaves' fields of their own; a null source is a source and comes first. Rows
    without a key come first in their source; rows that repeat a key follow each other by their
    digest, and rows that are equal have proofs of their own. Empty and long texts are hashed
    whole. A null `tampered` is false. Other columns are ignored, and an empty table gives none.
    """
    values = {f: F.col(f"`{f}`") for f in fields}
    changed = leaf_hash(list((values | {text: tampering}).values()))
    leaves = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{source}`").alias("source"),
        leaf_hash(list(values.values())).alias("leaf"),
        F.when(tampered, changed).alias("other"),
    )
    leaves, largest, n_sources = _placed(written(leaves, "digests"))
    # Rounds within the sources, whose last one gives the subroots; then rounds over those.
    nodes = leaves.select("tree", "place", "n", F.col("leaf").alias("digest"))
    inner = _rounds(nodes, largest, depth)
    subroots = inner[-1].select(
        F.lit(0).cast("bigint").alias("tree"),
        F.col("tree").alias("place"),
        F.lit(n_sources).cast("bigint").alias("n"),
        "digest",
    )
    outer = _rounds(subroots, n_sources, depth)
    paths = outer[-1].select(
        "tree",
        "place",
        "digest",
        F.array().cast(_PATH).alias("path"),
        F.lit(None).cast("string").alias("subroot"),
        F.col("digest").alias("root"),
    )
    for below, _ in reversed(list(pairwise(outer))):
        paths = _paths(below, paths, depth)
    paths = paths.select(
        F.col("place").alias("tree"),
        F.lit(0).cast("bigint").alias("place"),
        "digest",
        "path",
        F.col("digest").alias("subroot"),
        "root",
    )
    for below, _ in reversed(list(pairwise(inner))[1:]):
        paths = _paths(below, paths, depth)

    def prove(rows: pd.DataFrame, tops: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place", ignore_index=True)
        top = tops.iloc[0]
        block = _block(rows["leaf"].tolist(), int(rows["n"].iloc[0]), depth)
        above = [(s["left"], s["right"]) for s in top["path"]]
        siblings_above = "".join(a + b for a, b in above)
        proofs, folded, copies = [], [], []
        for i, (leaf, other) in enumerate(zip(rows["leaf"], rows["other"], strict=True)):
            siblings = "".join(a + b for a, b in block.path(i)) + siblings_above
            proofs.append(sha256(siblings.encode()).hexdigest())
            copied = [node.digest for node in block.version(i, other or leaf)]
            for left, right in above:
                copied.append(node_hash([left, copied[-1], right]))
            folded.append(copied[-1])
            copies.append(copied if other else None)
        out = rows[["key", "place", "leaf"]].assign(
            subroot=top["subroot"], root=top["root"], proof_sha256=proofs, folded_root=folded
        )
        out["verified"] = out["folded_root"] == out["root"]
        if versions:
            out["copied"] = copies
        return out

    kind = leaves.schema["key"].dataType
    leaves = leaves.withColumn("key", F.col("key").cast("string"))  # pandas has no null integers
    schema = (
        "key string, place bigint, leaf string, subroot string, root string, "
        "proof_sha256 string, folded_root string, verified boolean"
    )
    blocks = leaves.groupBy("tree", _block_of(depth))
    above = paths.groupBy("tree", F.col("place").alias("block"))
    proved = blocks.cogroup(above).applyInPandas(
        prove, schema + (", copied array<string>" if versions else "")
    )
    return proved.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)
