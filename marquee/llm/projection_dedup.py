"""Near-duplicate vectors by sorted projection passes.

In each pass every vector gets a code of random-hyperplane signs, and the
vectors of a label are sorted by it; vectors that share their first bits stand
close together.  Each is compared with the ``WINDOW`` before it.  Similar
vectors share a bit with a known chance, so the number of passes follows from
the bits that a vector must share with another before no more than a window
stand between them: a pair at the threshold is to meet with chance ``RECALL``
in at least one pass.

Those bits are measured, as ``PROBES`` codes sort the vectors, since vectors that lie
close together share far more of them than their number tells.  Each label
then takes the number of passes with the least work, and the vectors too
crowded for it are all compared with each other, in blocks.  Where vectors are
few, or all crowded, these are all of the label's.

Pairs at or above the threshold are united over all passes.  In the end the
vectors of one component are compared with each other in blocks, however many
they are, so that counts of links are whole in groups denser than a window.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import stage

from .common import bound_batches
from .graph import components

THRESHOLD = 0.93
WINDOW = 64
RECALL = 0.98
BITS = 48
#: Codes by which the crowding of vectors is measured.
PROBES = 3
#: Comparisons that a vector costs in a pass, its block and code included.
PASS_WORK = 700
#: Rows compared at a time within a sorted partition, and the size of a component's block.
BLOCK = 512
COMPONENT_BLOCK = 1024


def passes_for(n: int, threshold: float = THRESHOLD, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes after which a pair at the threshold among ``n`` vectors has met with chance ``recall``.

    Vectors stand within a window if about log2(n / window) leading bits agree; each agrees with
    chance 1 - angle / pi.
    """
    agree = 1 - math.acos(threshold) / math.pi
    chance = agree ** math.log2(max(2, n / window))
    return max(3, math.ceil(math.log(1 - recall) / math.log(1 - chance)))


def _planes(dim: int, which: int) -> np.ndarray:
    return np.random.default_rng([dim, which]).normal(size=(dim, BITS))


def _codes(vectors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    return (vectors @ planes > 0).astype(np.int64) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def _unit(column) -> np.ndarray:
    """Rows of a list column, all of one length, as unit vectors in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _runs(keys: list[np.ndarray]) -> list[tuple[int, int]]:
    """(from, to) of runs of rows with equal keys."""
    n = len(keys[0])
    change = np.zeros(n, bool)
    change[:1] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    at = [*np.flatnonzero(change).tolist(), n]
    return list(zip(at[:-1], at[1:]))


def _leaders(near: np.ndarray) -> np.ndarray:
    """Per row of a symmetric matrix of links the first row of its component."""
    lead = np.arange(len(near))
    while True:
        best = np.where(near, lead[None, :], len(near)).min(axis=1)
        best = np.minimum(best, lead)
        best = best[best]
        if (best == lead).all():
            return lead
        lead = best


def _joined(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what a matrix of links between ``left`` and ``right`` connects."""
    i, j = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    n, m = len(i), len(j)
    if not n:
        return left[:0], left[:0]
    both = np.eye(n + m, dtype=bool)
    both[:n, n:] = near[np.ix_(i, j)]
    both[n:, :n] = both[:n, n:].T
    own, lead = np.concatenate([left[i], right[j]]), _leaders(both)
    moved = np.flatnonzero(own[lead] != own)
    return own[moved], own[lead[moved]]


def _crowding(classes: DataFrame, kind: str, window: int) -> DataFrame:
    """(cid, depth): bits after which no more than a window share a vector's code; the most of all probes."""

    def code(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            dims = batch.column(2).to_numpy()
            for i, j in _runs([dims]):
                part = batch.slice(i, j - i)
                v = _unit(part.column(3))
                for p in range(PROBES):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(j - i, p, np.int32)),
                            part.column(1),
                            part.column(2),
                            pa.array(_codes(v, _planes(int(dims[i]), p))),
                            part.column(0),
                        ],
                        names=["pass", "l", "dim", "code", "cid"],
                    )

    def measure(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tail = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = (table if tail is None else pa.concat_tables([tail, table])).combine_chunks()
            tail = table.slice(max(0, table.num_rows - window))
            if table.num_rows <= window:
                continue
            group = table.column(1).combine_chunks().dictionary_encode().indices.to_numpy()
            own, dim, code, cid = (table.column(k).to_numpy() for k in (0, 2, 3, 4))
            same = np.ones(table.num_rows - window, bool)
            for k in (own, group, dim):
                same &= k[window:] == k[:-window]
            apart = (code[window:] ^ code[:-window])[same]
            depth = (BITS + 1 - np.frexp(apart.astype(np.float64))[1]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([cid[window:][same], cid[:-window][same]])),
                    pa.array(np.concatenate([depth, depth])),
                ],
                names=["cid", "depth"],
            )

    order = ["pass", "l", "dim", "code", "cid"]
    return (
        classes.select("cid", "l", "dim", "e")
        .mapInArrow(code, f"pass int, l {kind}, dim int, code long, cid long")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(measure, "cid long, depth int")
        .groupBy("cid")
        .agg(F.max("depth").alias("depth"))
    )


def _plan(rows: DataFrame, threshold: float, window: int, recall: float) -> DataFrame:
    """(l, dim, passes, deepest, crowd) with the least work for each label.

    Vectors that need more bits than ``deepest`` are the ``crowd``; without passes it is all.
    """
    needed = F.array(
        *(F.lit(passes_for(window << d, threshold, window, recall)) for d in range(BITS + 2))
    )
    upto = Window.partitionBy("l", "dim").orderBy("depth")
    bits = rows.groupBy("l", "dim", "depth").agg(F.count("*").alias("n"))
    bits = bits.withColumn("held", F.sum("n").over(upto)).withColumn(
        "all", F.sum("n").over(Window.partitionBy("l", "dim"))
    )
    choices = bits.select(
        "l",
        "dim",
        F.explode(
            F.array(
                F.struct(
                    F.get(needed, F.col("depth")).alias("passes"),
                    F.col("depth").alias("deepest"),
                    (F.col("all") - F.col("held")).alias("crowd"),
                    F.col("all").alias("n"),
                ),
                F.struct(
                    F.lit(0).alias("passes"),
                    F.lit(-1).alias("deepest"),
                    F.col("all").alias("crowd"),
                    F.col("all").alias("n"),
                ),
            )
        ).alias("c"),
    )
    crowd = F.col("c.crowd").cast("double")
    work = F.col("c.passes") * F.lit(float(PASS_WORK)) * F.col("c.n") + crowd * crowd / 2
    return choices.groupBy("l", "dim").agg(F.min_by("c", work).alias("c")).select("l", "dim", "c.*").drop("n")


def near_duplicates(
    vectors: DataFrame,
    vec: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    window: int = WINDOW,
    recall: float = RECALL,
) -> DataFrame:
    """``vec``, ``n_links``, ``component_id``, ``kept``: one row per row of ``vectors``.

    Vectors are linked if their labels are equal and not null, they have as many components and
    their cosine is at least ``threshold``.  A vector that is null, empty, zero or holds a null, NaN
    or infinity is linked with nothing: its component is itself.  ``component_id`` is the
    smallest id reachable by links; a null id stays null and names a component only if no member
    has an id.  Repeated rows and copies are links of each other; they are compared once.  Other
    columns are ignored.  An empty table gives no rows.  Links of a label whose work is less
    without passes are found whole.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    e = F.col("e")
    sound = (
        F.col("l").isNotNull()
        & e.isNotNull()
        & (F.size(e) > 0)
        & ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(e, lambda x: x != 0)
    )
    rows = vectors.select(
        F.col(vec).alias("id"), F.col(label).alias("l"), F.col(vector).cast("array<double>").alias("e")
    ).withColumn("sound", F.coalesce(sound, F.lit(False)))
    # Written once, so that the numbers of the classes are fixed.
    classes = stage(
        rows.filter("sound")
        .groupBy("l", "e")
        .agg(F.count("*").alias("weight"), F.min("id").alias("smallest"))
        .withColumn("cid", F.monotonically_increasing_id())
        .withColumn("dim", F.size("e")),
        "vector-classes",
    )
    kind = classes.schema["l"].dataType.simpleString()
    depths = (
        classes.select("cid", "l", "dim")
        .join(_crowding(classes, kind, window), "cid", "left")
        .withColumn("depth", F.coalesce("depth", F.lit(0)))
    )
    depths = stage(depths, "vector-depths")
    plan = stage(_plan(depths, threshold, window, recall), "vector-passes")
    planned = classes.select("cid", "l", "dim", "e").join(depths.select("cid", "depth"), "cid").join(
        plan, ["l", "dim"]
    )

    def code(batches: Iterator) -> Iterator:
        import pyarrow as pa

        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            dims, passes = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            for i, j in _runs([dims, passes]):
                part, dim = batch.slice(i, j - i), int(dims[i])
                v = _unit(part.column(3))
                for p in range(passes[i]):
                    if (dim, p) not in planes:
                        planes[dim, p] = _planes(dim, p)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(j - i, p, np.int32)),
                            part.column(1),
                            part.column(2),
                            pa.array(_codes(v, planes[dim, p])),
                            part.column(0),
                            part.column(3),
                        ],
                        names=["pass", "l", "dim", "code", "cid", "e"],
                    )

    coded = planned.filter("passes > 0").select("cid", "l", "dim", "e", "passes").mapInArrow(
        code, f"pass int, l {kind}, dim int, code long, cid long, e array<double>"
    )

    def sweep(batches: Iterator) -> Iterator:
        """Compare along a sorted partition; the last window is kept for the next batch."""
        import pyarrow as pa

        tail = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if tail is not None:
                table = pa.concat_tables([tail, table])
            old = 0 if tail is None else tail.num_rows
            tail = table.slice(max(0, table.num_rows - window)).combine_chunks()
            table = table.combine_chunks()
            group = table.column(1).combine_chunks().dictionary_encode().indices.to_numpy()
            keys = [table.column(0).to_numpy(), group, table.column(2).to_numpy()]
            cid = table.column(4).to_numpy()
            a, b = [], []
            for i, j in _runs(keys):
                if j <= old:
                    continue
                v = _unit(table.column(5).slice(i, j - i).combine_chunks())
                for s in range(max(0, old - i), j - i, BLOCK):
                    low, high = max(0, s - window), min(j - i, s + BLOCK)
                    near = v[low:high] @ v[low:high].T >= threshold
                    at = np.arange(high - low)
                    near &= np.abs(at[:, None] - at[None, :]) <= window
                    lead = _leaders(near)
                    moved = np.flatnonzero(lead != at)
                    own = cid[i + low : i + high]
                    a.append(own[moved])
                    b.append(own[lead[moved]])
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"]
                )

    order = ["pass", "l", "dim", "code", "cid"]
    links = (
        coded.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(sweep, "a long, b long")
    )
    # The crowd of a label: every block against every block.
    blocks = F.ceil(F.col("crowd") / COMPONENT_BLOCK).cast("int")
    crowd = (
        planned.filter("depth > deepest")
        .withColumn("block", F.pmod(F.xxhash64("cid"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            "l",
            "dim",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "block",
            "cid",
            "e",
        )
    )

    def compare(batches: Iterator) -> Iterator:
        """Links inside and between two blocks; rows are sorted by label, length and blocks."""
        import pyarrow as pa

        def compared(table):
            i, j, block, cid = (table.column(k).to_numpy() for k in (2, 3, 4, 5))
            v, left, right = _unit(table.column(6).combine_chunks()), block == i[0], block == j[0]
            near = v[left] @ v[right].T >= threshold
            if i[0] == j[0]:
                np.fill_diagonal(near, False)
            a, b = _joined(near, cid[left], cid[right])
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = (pa.concat_tables([rest, table]) if rest is not None else table).combine_chunks()
            group = table.column(0).combine_chunks().dictionary_encode().indices.to_numpy()
            runs = _runs([group, *(table.column(k).to_numpy() for k in (1, 2, 3))])
            for s, t in runs[:-1]:
                yield compared(table.slice(s, t - s))
            rest = table.slice(runs[-1][0]) if runs else None
        if rest is not None and rest.num_rows:
            yield compared(rest)

    whole = (
        crowd.repartition("l", "dim", "i", "j")
        .sortWithinPartitions("l", "dim", "i", "j")
        .mapInArrow(compare, "a long, b long")
    )
    nodes = stage(components(links.unionByName(whole)), "vector-components")

    # Within components: every block against every block.
    sizes = nodes.groupBy("root").agg(F.ceil(F.count("*") / COMPONENT_BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    placed = (
        classes.select("cid", "weight", "e", "dim", "l")
        .join(nodes.withColumnRenamed("node", "cid"), "cid")
        .join(sizes, "root")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "root",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "block",
            "cid",
            "weight",
            "e",
        )
    )

    def count(batches: Iterator) -> Iterator:
        """Links inside and between two blocks; rows are sorted by component and blocks."""
        import pyarrow as pa

        def counted(table):
            i, j, own = (table.column(k).to_numpy() for k in (1, 2, 3))
            v, w = _unit(table.column(6).combine_chunks()), table.column(5).to_numpy()
            near = v @ v.T >= threshold
            np.fill_diagonal(near, False)
            if i[0] != j[0]:
                near &= own[:, None] != own[None, :]
            return pa.RecordBatch.from_arrays(
                [pa.array(table.column(4).to_numpy()), pa.array(near @ w)], names=["cid", "n"]
            )

        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = (pa.concat_tables([rest, table]) if rest is not None else table).combine_chunks()
            runs = _runs([table.column(k).to_numpy() for k in range(3)])
            for s, t in runs[:-1]:
                yield counted(table.slice(s, t - s))
            rest = table.slice(*(runs[-1][0], runs[-1][1] - runs[-1][0])) if runs else None
        if rest is not None and rest.num_rows:
            yield counted(rest)

    within = (
        placed.repartition("root", "i", "j")
        .sortWithinPartitions("root", "i", "j")
        .mapInArrow(count, "cid long, n long")
        .groupBy("cid")
        .agg(F.sum("n").alias("n"))
    )
    named = (
        nodes.join(classes.select(F.col("cid").alias("node"), "smallest"), "node")
        .groupBy("root")
        .agg(F.min("smallest").alias("component"))
    )
    found = (
        classes.join(within, "cid", "left")
        .join(nodes.withColumnRenamed("node", "cid"), "cid", "left")
        .join(named, "root", "left")
        .select(
            "l",
            "e",
            (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("component", "smallest").alias("component"),
        )
    )
    linked = rows.filter("sound").join(found, ["l", "e"]).select("id", "n_links", "component")
    alone = rows.filter(~F.col("sound")).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component")
    )
    return linked.unionByName(alone).select(
        F.col("id").alias(vec),
        "n_links",
        F.coalesce("component", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component", "id")).alias("kept"),
    )
