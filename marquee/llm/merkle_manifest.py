"""Merkle manifest of a dataset with a persistent, path-copying tree.

Records are leaves.  Every group of records (a source) is a tree of its own,
three children a node, and the groups' roots, in order, are the leaves of the
tree above them.  No task sees a whole tree: a tree is cut into aligned blocks
of ``3 ** BLOCK_HEIGHT`` neighbouring nodes, whose roots are the nodes of the
next tier, which is cut in the same way.

Inside a block the tree is persistent: a changed leaf makes a version with a
root of its own that copies only the leaf's ancestors and shares all other
nodes with the first version and with all others.  A version goes on in the
tiers above as one row: each of its ancestors there is folded from the copy
below and the shared siblings, in a plain expression, so the versions of one
block are spread over all tasks and are never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.session import stage

from .common import bound_batches
from .ranks import place_in_groups

ARITY = 3
#: A block has at most ARITY ** BLOCK_HEIGHT nodes of a tier.
BLOCK_HEIGHT = 5
#: A step up: the digests left and right of a node in its run.
PATH = "array<struct<before:string,after:string>>"


class Manifest(NamedTuple):
    """``leaves``: a row per record with ``path`` (from its leaf to ``root``), ``subroot``, ``root``,
    ``copies`` (the digests that its version copies inside its block, bottom up; null without a
    change) and ``folded_root``; ``groups``: a row per group with its ``subroot``, its number of
    records and the ``root``."""

    leaves: DataFrame
    groups: DataFrame


def record_digest(values: Sequence[Column]) -> Column:
    """Hex sha256 of a record: each value as ``-`` if null, else its UTF-8 length, ``:`` and itself."""
    texts = [v.cast("string") for v in values]
    marked = [
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]
    return F.sha2(F.concat(*marked), 256)


def _hash(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class _Node(NamedTuple):
    """Never changed after it is made, so versions may share it."""

    digest: str
    children: tuple[_Node, ...] = ()


def _joined(children: tuple[_Node, ...]) -> _Node:
    return _Node(_hash(*(c.digest for c in children)), children)


def _grown(digests: Sequence[str], height: int) -> _Node:
    level = [_Node(d) for d in digests]
    for _ in range(height):
        level = [_joined(tuple(level[i : i + ARITY])) for i in range(0, len(level), ARITY)]
    return level[0]


def _copied(node: _Node, at: int, height: int, digest: str, copies: list[str]) -> _Node:
    """A version of the tree below ``node`` whose leaf ``at`` has another digest."""
    if not height:
        return _Node(digest)
    width = ARITY ** (height - 1)
    k = at // width
    child = _copied(node.children[k], at % width, height - 1, digest, copies)
    made = _joined((*node.children[:k], child, *node.children[k + 1 :]))
    copies.append(made.digest)
    return made


def _steps(node: _Node, at: int, height: int) -> list[tuple[str, str]]:
    """(before, after) of the way from leaf ``at`` up to ``node``."""
    steps = []
    for h in range(height, 0, -1):
        width = ARITY ** (h - 1)
        k, at = at // width, at % width
        steps.append(
            ("".join(c.digest for c in node.children[:k]), "".join(c.digest for c in node.children[k + 1 :]))
        )
        node = node.children[k]
    return steps[::-1]


def _height(size: int, width: int) -> int:
    """Levels of a block: all of them if the tree has more blocks, else those that leave one node."""
    if size > width:
        size = width
    height = 0
    while size > 1:
        size, height = -(-size // ARITY), height + 1
    return height


def _seal(nodes: DataFrame, block_height: int, carry: Sequence[str] = ()) -> DataFrame:
    """Builds the blocks of a tier.

    ``nodes`` has tree, pos, size (nodes of the tree in this tier), digest, changed (the leaf of a
    version, or null).  Adds block, path (inside the block), top (the block's root), version (that of
    the version) and copies.
    """
    spark = nodes.sparkSession
    bound_batches(spark)
    width = ARITY**block_height
    fixed = ["tree", "block", "pos", "size", "digest", "changed"]
    kept = [f for f in nodes.schema.fields if f.name in carry]

    def build(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def sealed(table):
            """One whole block, its rows by pos."""
            digests, changed = table.column("digest").to_pylist(), table.column("changed").to_pylist()
            height = _height(table.column("size")[0].as_py(), width)
            root = _grown(digests, height)
            before, after, ends, version, copies = [], [], [0], [], []
            for at, new in enumerate(changed):
                for b, a in _steps(root, at, height):
                    before.append(b)
                    after.append(a)
                ends.append(len(before))
                made: list[str] | None = None
                if new is not None:
                    made = []
                    version.append(_copied(root, at, height, new, made).digest)
                else:
                    version.append(root.digest)
                copies.append(made)
            steps = pa.StructArray.from_arrays(
                [pa.array(before, pa.string()), pa.array(after, pa.string())], names=["before", "after"]
            )
            out = {
                "tree": table.column("tree").combine_chunks(),
                "block": table.column("block").combine_chunks(),
                "digest": pa.array(digests, pa.string()),
                "path": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps),
                "top": pa.array([root.digest] * len(digests), pa.string()),
                "version": pa.array(version, pa.string()),
                "copies": pa.array(copies, pa.list_(pa.string())),
            }
            for f in kept:
                out[f.name] = table.column(f.name).combine_chunks()
            return pa.Table.from_arrays(list(out.values()), names=list(out)).to_batches()

        held, of = [], None
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            start = 0
            while start < len(keys):
                end = start
                while end < len(keys) and keys[end] == keys[start]:
                    end += 1
                if of is not None and keys[start] != of:
                    yield from sealed(pa.Table.from_batches(held))
                    held = []
                of = keys[start]
                held.append(batch.slice(start, end - start))
                start = end
        if held:
            yield from sealed(pa.Table.from_batches(held))

    types = {f.name: f.dataType.simpleString() for f in kept}
    schema = ", ".join(
        [
            "tree long, block long, digest string",
            f"path {PATH}, top string, version string, copies array<string>",
            *(f"`{n}` {t}" for n, t in types.items()),
        ]
    )
    placed = nodes.withColumn("block", F.floor(F.col("pos") / F.lit(width)).cast("long"))
    return (
        placed.select(*fixed, *(c for c in types if c not in fixed))
        .repartition("tree", "block")
        .sortWithinPartitions("tree", "block", "pos")
        .mapInArrow(build, schema)
    )


def _tiers(nodes: DataFrame, largest: int, block_height: int, name: str) -> tuple[DataFrame, DataFrame]:
    """From a tier's nodes (tree, pos, size, digest) to the trees' roots.

    Returns (way, roots): ``way`` has for every node (tree, pos) its path to the root of its tree,
    ``roots`` (tree, digest).  A tier has 3 ** block_height times fewer rows than the one below.
    """
    width = ARITY**block_height
    tiers = []
    while True:
        tier = _seal(nodes.withColumn("changed", F.lit(None).cast("string")), block_height, ("pos", "size"))
        tier = stage(tier.select("tree", "pos", "size", "block", "path", "top"), name)
        tiers.append(tier)
        up = tier.groupBy("tree", F.col("block").alias("pos")).agg(
            F.first("top").alias("digest"),
            F.ceil(F.first("size") / F.lit(width)).cast("long").alias("size"),
        )
        if largest <= width:
            break
        nodes, largest = up, -(-largest // width)
    way = tiers.pop().select("tree", "pos", "path")
    for tier in reversed(tiers):
        above = way.select("tree", F.col("pos").alias("block"), F.col("path").alias("rest"))
        way = tier.join(above, ["tree", "block"]).select("tree", "pos", F.concat("path", "rest").alias("path"))
    return way, up.select("tree", "digest")


def fold(path: Column, digest: Column) -> Column:
    """The root that a node's digest and its path give."""
    return F.aggregate(path, digest, lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]), 256))


def siblings(path: Column) -> Column:
    """All digests of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def seal(records: DataFrame, block_height: int = BLOCK_HEIGHT) -> Manifest:
    """The manifest of ``records``: ``id``, ``group``, ``leaf`` and ``changed`` (digests, hex).

    Groups are in order of their name (null first, UTF-8 bytewise), records of a group by id (null
    first), then by leaf, so that the order of input rows plays no part; repeated rows are leaves of
    their own.  ``changed`` is the digest of a tampered record, for which a version is made; null
    makes none, and its ``folded_root`` is folded from the leaf itself.  An empty table gives no
    rows.  Other columns are not read.  Records are read once here, so pass a frame whose digests
    are not yet computed.  Lowers ``spark.sql.execution.arrow.maxRecordsPerBatch`` (``bound_batches``).
    """
    width = ARITY**block_height
    narrow = stage(records.select("id", "group", "leaf", "changed"), "leaves")
    placed = place_in_groups(
        narrow, "group", [F.col("id").asc_nulls_first(), F.col("leaf")], "sorted-leaves"
    )
    sealed = stage(
        _seal(placed.withColumnRenamed("leaf", "digest"), block_height, ("id", "group", "size")),
        "sealed-leaves",
    )
    blocks = sealed.groupBy("tree", F.col("block").alias("pos")).agg(
        F.first("top").alias("digest"),
        F.ceil(F.first("size") / F.lit(width)).cast("long").alias("size"),
        F.first("group").alias("group"),
        F.first("size").alias("records"),
    )
    blocks = stage(blocks, "blocks")
    bounds = blocks.agg(F.max("size"), F.max("tree")).first()
    way, subroots = _tiers(blocks.drop("group", "records"), bounds[0] or 0, block_height, "tier")
    subroots = stage(subroots, "subroots")
    trees = (bounds[1] or 0) + 1
    tops = subroots.select(
        F.lit(0).cast("long").alias("tree"),
        F.col("tree").alias("pos"),
        F.lit(trees).cast("long").alias("size"),
        "digest",
    )
    last_way, roots = _tiers(tops, trees, block_height, "top-tier")
    names = blocks.filter("pos = 0").select("tree", "group", "records")
    root = roots.first()
    groups = (
        subroots.select("tree", F.col("digest").alias("subroot"))
        .join(last_way.select(F.col("pos").alias("tree"), F.col("path").alias("rest")), "tree")
        .join(names, "tree")
        .withColumn("root", F.lit(root and root["digest"]).cast("string"))
    )
    groups = stage(groups, "groups")
    above = way.join(groups, "tree").select(
        "tree", F.col("pos").alias("block"), F.concat("path", "rest").alias("above"), "subroot", "root"
    )
    leaves = sealed.join(above, ["tree", "block"]).select(
        "id",
        "group",
        F.col("digest").alias("leaf"),
        F.concat("path", "above").alias("path"),
        "copies",
        "subroot",
        "root",
        fold(F.col("above"), F.col("version")).alias("folded_root"),
    )
    return Manifest(leaves, groups.select("group", "records", "subroot", "root"))
