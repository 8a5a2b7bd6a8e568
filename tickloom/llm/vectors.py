"""Near vectors of one label: an epsilon grid order of leading principal dimensions, joined recursively by intervals."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.components import components
from tickloom.llm.text import bounded_batches, small
from tickloom.plans.scratch import stored

LEAST = 0.98
#: Leading principal dimensions that order the vectors and bound their blocks.
LEADING = 8
#: Numbers of the sample whose principal dimensions are taken: so many over the length of a vector are rows of it.
SAMPLE = 2_000_000
#: Vectors of a block of the sequence; children of a node of the tree above the blocks; vectors below which intervals are compared.
BLOCK, CHILDREN, SMALL = 2048, 32, 128
BROADCAST_ROWS = 200_000
#: What rounding may add to a distance: blocks are skipped beyond it and taken whole below it.
SLACK = 1e-7


def radius(least: float) -> float:
    """The distance of vectors of length one whose cosine is ``least``."""
    return math.sqrt(max(0.0, 2 - 2 * least))


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither vanish nor overflow."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def prepared(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """vec_id, and for rows that can link: label as text, size, the vector's doubles and a 128-bit key of label and vector."""
    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, vecs, sizes = [], [], []
            for label, v in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                good = label is not None and bool(v) and None not in v
                x = np.array(v if good else [], dtype=np.float64) + 0.0
                if not len(x) or not np.isfinite(x).all() or not x.any():
                    keys.append(None), vecs.append(None), sizes.append(None)
                    continue
                raw = x.tobytes()
                keys.append(hashlib.blake2b(len(x).to_bytes(8, "big") + raw + label.encode(), digest_size=16).digest())
                vecs.append(raw)
                sizes.append(len(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(keys, pa.binary()),
                 pa.array(vecs, pa.binary())], names=["vec_id", "label", "size", "key", "v"])

    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vec_col).cast("array<double>").alias("v"))
    return rows.mapInArrow(prepare, "vec_id bigint, label string, size int, key binary, v binary")


def leading(reps: DataFrame, dims: int = LEADING) -> dict[int, np.ndarray]:
    """Vector length → its leading principal dimensions within labels, of a bounded sample of the commonest length.

    Vectors of other lengths are ordered by their own first components: any orthonormal directions give the same links.
    """
    common = reps.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return {}
    size = common["size"]
    sample = reps.where(F.col("size") == size).orderBy(F.xxhash64("key")).limit(max(2, SAMPLE // size))
    rows = sample.select("label", "v").collect()
    x = unit(np.stack([np.frombuffer(r["v"], dtype=np.float64) for r in rows]))
    _, owner = np.unique([r["label"] for r in rows], return_inverse=True)
    means = np.zeros((owner.max() + 1, size))
    np.add.at(means, owner, x)
    x -= (means / np.bincount(owner)[:, None])[owner]
    directions = np.linalg.svd(x, full_matrices=False)[2]
    return {size: np.ascontiguousarray(directions[:dims].T)}


def projected(v: np.ndarray, basis: dict[int, np.ndarray], dims: int = LEADING) -> np.ndarray:
    """Coordinates of unit vectors in the leading dimensions; zeros fill up short ones."""
    out = np.zeros((len(v), dims))
    p = v @ basis[v.shape[1]] if v.shape[1] in basis else v[:, :dims]
    out[:, : p.shape[1]] = p
    return out


def ordered(reps: DataFrame, basis: dict[int, np.ndarray], eps: float) -> DataFrame:
    """The vectors with their grid cells, in the order of label, length and cells across and inside partitions."""
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.zeros((batch.num_rows, LEADING), dtype=np.int32)
            raw, sizes = batch.column(4).to_pylist(), np.array(batch.column(1))
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                v = np.frombuffer(b"".join(raw[i] for i in rows)).reshape(len(rows), -1)
                table[rows] = np.floor(projected(unit(v), basis) / eps)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c) for c in table.T)],
                                             names=[*batch.schema.names, *(f"c{k}" for k in range(LEADING))])

    kinds = ", ".join(f"c{k} int" for k in range(LEADING))
    rows = reps.select("label", "size", "key", "rep", "v", "copies").mapInArrow(
        cells, f"label string, size int, key binary, rep bigint, v binary, copies bigint, {kinds}")
    order = ["label", "size", *(f"c{k}" for k in range(LEADING)), "key"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


BOX = tuple(f"{e}{k}" for k in range(LEADING) for e in ("lo", "hi"))
BLOCK_COLUMNS = {"part": "int", "seq": "int", "label": "string", "size": "int", "n": "int", "copies": "bigint", "rep": "bigint",
                 "centre": "array<double>", "reach": "double", **dict.fromkeys(BOX, "double"),
                 "keys": "binary", "reps": "binary", "counts": "binary", "v": "binary"}
ARROW = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(),
         "array<double>": pa.list_(pa.float64())}


def blocks(rows: DataFrame, basis: dict[int, np.ndarray]) -> DataFrame:
    """Intervals of the sequence: of one label and length, BLOCK vectors at most, with bounds of their members.

    ``keys``, ``reps``, ``counts`` and ``v`` hold the members; ``centre`` and ``reach`` are a ball, lo and hi a box around them.
    """
    schema = pa.schema([(c, ARROW[kind]) for c, kind in BLOCK_COLUMNS.items()])

    def block(part: int, seq: int, kind: tuple, held: list[tuple]) -> pa.RecordBatch:
        keys, reps, raw, copies = zip(*held, strict=True)
        v = unit(np.frombuffer(b"".join(raw)).reshape(len(held), -1))
        p, centre = projected(v, basis), v.mean(axis=0)
        reach = float(np.sqrt(((v - centre) ** 2).sum(axis=1)).max())
        box = np.stack([p.min(axis=0), p.max(axis=0)], axis=1).ravel().tolist()
        values = [part, seq, *kind, len(held), sum(copies), reps[0], centre.tolist(), reach, *box, b"".join(keys),
                  np.array(reps, np.int64).tobytes(), np.array(copies, np.int64).tobytes(), v.tobytes()]
        return pa.RecordBatch.from_arrays(
            [pa.array([x], type=f.type) for x, f in zip(values, schema, strict=True)], schema=schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, kind = TaskContext.get().partitionId(), 0, None
        held: list[tuple] = []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("label", "size", "key", "rep", "v", "copies"))
            for label, size, *member in zip(*columns, strict=True):
                if held and ((label, size) != kind or len(held) >= BLOCK):
                    yield block(part, seq, kind, held)
                    seq, held = seq + 1, []
                kind = (label, size)
                held.append(tuple(member))
        if held:
            yield block(part, seq, kind, held)

    return rows.mapInArrow(cut, ", ".join(f"{c} {kind}" for c, kind in BLOCK_COLUMNS.items()))


def numbered(made: DataFrame) -> DataFrame:
    """The blocks with their place in the whole sequence, ``node``; sums of one row for each partition alone are ordered in one task."""
    parts = made.groupBy("part").agg(F.max(F.col("seq") + 1).alias("c"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    at = parts.select("part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("first"))
    return made.join(small(at, BROADCAST_ROWS), "part").withColumn("node", F.col("first") + F.col("seq")).drop("part", "seq", "first")


def apart(a: Column, b: Column) -> Column:
    """Distance of two points."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def parents(nodes: DataFrame) -> DataFrame:
    """The nodes above: CHILDREN neighbours each, and bounds of them all.

    The ball around the first child's centre holds the others' balls; nodes of several labels or lengths have none.
    """
    up = nodes.withColumn("up", F.floor(F.col("node") / CHILDREN).cast("bigint"))
    first = up.groupBy("up").agg(
        F.min_by("centre", "node").alias("middle"), F.min_by("rep", "node").alias("first"),
        ((F.min("label") == F.max("label_to")) & (F.min("size") == F.max("size_to"))).alias("one"))
    ball = F.when(F.col("one"), apart(F.col("centre"), F.col("middle")) + F.col("reach")).otherwise(F.lit(float("inf")))
    return up.join(first, "up").groupBy(F.col("up").alias("node")).agg(
        F.min("label").alias("label"), F.max("label_to").alias("label_to"), F.min("size").alias("size"),
        F.max("size_to").alias("size_to"), F.sum("copies").alias("copies"), F.first("first").alias("rep"),
        F.first("middle").alias("centre"), F.max(ball).alias("reach"),
        *((F.min if c.startswith("lo") else F.max)(c).alias(c) for c in BOX))


def tree(base: DataFrame) -> list[DataFrame]:
    """The blocks' bounds, and above them level by level to one root, each a written table."""
    levels, count = [base], base.count()
    while count > 1:
        levels.append(stored(parents(levels[-1])))
        count = -(-count // CHILDREN)
    return levels


def distant(eps: float) -> Column:
    """Whether no vectors of two nodes can be linked: labels or lengths differ, or their boxes lie further apart than ``eps``."""
    gaps = [F.greatest(F.col(f"x.lo{k}") - F.col(f"y.hi{k}"), F.col(f"y.lo{k}") - F.col(f"x.hi{k}"), F.lit(0.0))
            for k in range(LEADING)]
    far = reduce(lambda a, b: a + b, (g * g for g in gaps)) > (eps + SLACK) ** 2
    other = reduce(lambda a, b: a | b, (F.col(f"{p}.{c}") > F.col(f"{q}.{c}_to")
                                        for p, q in (("x", "y"), ("y", "x")) for c in ("label", "size")))
    return far | other


def close(eps: float) -> Column:
    """Whether all vectors of two nodes are linked: the balls of both have room within ``eps``."""
    near = apart(F.col("x.centre"), F.col("y.centre")) + F.col("x.reach") + F.col("y.reach") <= eps - SLACK
    return F.coalesce(near, F.lit(False))


def met_intervals(levels: list[DataFrame], eps: float) -> tuple[DataFrame, list[DataFrame]]:
    """Pairs of blocks to compare (a <= b), and for each level the pairs of nodes all of whose vectors are linked.

    The join goes down the tree: a pair of nodes that are neither distant nor close is replaced by the pairs of
    their children, so each step joins every pair with CHILDREN times CHILDREN rows at most.
    """
    pairs, whole = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b")), []
    for level in reversed(levels[:-1]):
        child = level.withColumn("up", F.floor(F.col("node") / CHILDREN).cast("bigint"))
        down = pairs.join(child.alias("x"), F.col("a") == F.col("x.up")).join(child.alias("y"), F.col("b") == F.col("y.up"))
        # close implies one label and length: other nodes have no bounded reach
        alike = (F.col("x.label") == F.col("y.label_to")) & (F.col("x.size") == F.col("y.size_to"))
        found = stored(down.where((F.col("x.node") <= F.col("y.node")) & ~distant(eps)).select(
            F.col("x.node").alias("a"), F.col("y.node").alias("b"),
            F.when(alike, close(eps)).otherwise(F.lit(False)).alias("whole"),
            *(F.col(f"{p}.{c}").alias(f"{c}_{q}") for p, q in (("x", "a"), ("y", "b")) for c in ("copies", "rep"))))
        whole.append(found.where("whole").drop("whole"))
        pairs = found.where(~F.col("whole")).select("a", "b")
    return pairs, whole[::-1]


def united(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the groups of each pair (i, j); every member points to the smallest of its group."""
    while True:
        a, b = root[i], root[j]
        if (a == b).all():
            return
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(further := root[root], root):
            root[:] = further


def interval_join(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, least: float) -> Iterator[tuple[int, int, np.ndarray]]:
    """First rows and matrix of links of the intervals of two blocks that aren't provably distant."""
    limit = (radius(least) + SLACK) ** 2
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        gap = np.maximum(0, np.maximum(px[a:b].min(axis=0) - py[c:d].max(axis=0), py[c:d].min(axis=0) - px[a:b].max(axis=0)))
        if gap @ gap > limit:
            continue
        if b - a <= SMALL and d - c <= SMALL:
            yield a, c, x[a:b] @ y[c:d].T >= least
        elif b - a >= d - c:
            todo += [(a, (a + b) // 2, c, d), ((a + b) // 2, b, c, d)]
        else:
            todo += [(a, b, c, (c + d) // 2), (a, b, (c + d) // 2, d)]


LINKS = "key binary, links bigint, a bigint, b bigint"


def compared(pairs: DataFrame, made: DataFrame, basis: dict[int, np.ndarray], least: float) -> DataFrame:
    """key, links, a, b: for each pair of blocks and each member that is linked, the vectors it is linked to, and an edge.

    A member's edges lead to the smallest of the members it is linked with, directly or not, in the pair of blocks. Of a block
    and itself every member is linked to itself, too.
    """
    def compare(group: pd.DataFrame) -> pd.DataFrame:
        sides = group.sort_values("node")
        same = len(sides) == 1
        v = [np.frombuffer(raw).reshape(n, -1) for raw, n in zip(sides["v"], sides["n"], strict=True)]
        reps = [np.frombuffer(raw, dtype=np.int64) for raw in sides["reps"]]
        copies = [np.frombuffer(raw, dtype=np.int64) for raw in sides["counts"]]
        p = [projected(m, basis) for m in v]
        links = [np.zeros(len(m), dtype=np.int64) for m in v]
        root, shift = np.arange(sum(map(len, v))), 0 if same else len(v[0])
        for at, to, hit in interval_join(v[0], v[-1], p[0], p[-1], least):
            if same and at == to:
                np.fill_diagonal(hit, True)
            if not hit.any():
                continue
            links[0][at : at + len(hit)] += hit @ copies[-1][to : to + hit.shape[1]]
            if not same:
                links[1][to : to + hit.shape[1]] += copies[0][at : at + len(hit)] @ hit
            i, j = np.nonzero(hit)
            united(root, i + at, j + to + shift)
        ids, total = np.concatenate(reps), np.concatenate(links)
        smallest = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(smallest, root, ids)
        keys = [raw[16 * i : 16 * i + 16] for raw, m in zip(sides["keys"], v, strict=True) for i in range(len(m))]
        some = np.flatnonzero(total)
        return pd.DataFrame({"key": [keys[i] for i in some], "links": total[some], "a": ids[some], "b": smallest[root[some]]})

    member = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("node"))
    sides = small(member, BROADCAST_ROWS).join(made.select("node", "n", "keys", "reps", "counts", "v"), "node")
    return sides.groupBy("a", "b").applyInPandas(compare, LINKS)


def whole_links(whole: list[DataFrame], made: DataFrame) -> DataFrame:
    """key, links, a, b: what ``compared`` gives, for the members of nodes that are linked as a whole.

    Each node passes the vectors its partners hold down to its blocks; they are connected by its first vector.
    """
    parts = []
    for level, pairs in enumerate(whole):
        gains = pairs.select(F.col("a").alias("up"), F.col("copies_b").alias("gain"), F.col("rep_b").alias("rep")).union(
            pairs.where("a != b").select("b", "copies_a", "rep_a"))
        node = gains.groupBy("up").agg(F.sum("gain").alias("gain"), F.min("rep").alias("root"))
        below = made.select("node", F.floor(F.col("node") / CHILDREN**level).cast("bigint").alias("up"))
        partners = below.join(node, "up").select("node", "gain", F.col("root").alias("b"))
        parts.append(partners)
        # a node's partners are connected with one another through its vectors
        parts.append(below.join(gains.select("up", F.col("rep").alias("b")), "up").where(
            F.col("node") == F.col("up") * CHILDREN**level).select("node", F.lit(0).cast("bigint").alias("gain"), "b"))
    every = reduce(DataFrame.union, parts)

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gain, b, keys, reps in zip(*(batch.column(c).to_pylist() for c in ("gain", "b", "keys", "reps")), strict=True):
                n = len(reps) // 8 if gain else 1
                ids = np.frombuffer(reps, dtype=np.int64)[:n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[16 * i : 16 * i + 16] for i in range(n)], pa.binary()), pa.array(np.full(n, gain)),
                     pa.array(ids), pa.array(np.full(n, b))], names=["key", "links", "a", "b"])

    return every.join(made.select("node", "keys", "reps"), "node").mapInArrow(members, LINKS)


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 least: float = LEAST) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row: vectors of one label whose cosine is ``least`` or more are linked.

    Equal vectors of a label are one node from the start, with their number. Distinct ones are ordered by
    label and grid cells on leading principal dimensions, a grid as wide as linked vectors can lie apart; the sequence is cut into
    blocks under a tree of bounds, and the tree is joined with itself from the root down. Pairs of
    nodes that are provably distant are left, those all of whose vectors are provably linked are settled as a whole, and
    pairs of blocks are joined by halves in the same way down to products of small matrices. So groups of near copies
    are not compared one by one, and no pairs are written: each pair of blocks gives counts and a spanning forest.
    No link is lost: bounds hold for all vectors, cosines are computed in double precision.

    Rows with a null label or id, and vectors that are null, empty, zero or hold a null, NaN or infinite component, are linked with
    nothing; vectors of different length neither. ``n_links`` counts rows; rows that share an id are one node of a
    component, but each has the links of its own vector. A row without links is its own component, null for a null id, and
    kept. Other columns are not read; no rows give no rows.
    """
    if not 0 < least < 1:
        raise ValueError("least must lie between 0 and 1")
    eps = radius(least)
    bounded_batches(vectors.sparkSession)
    rows = stored(prepared(vectors, id_col, vec_col, label_col))
    good = rows.where(F.col("key").isNotNull() & F.col("vec_id").isNotNull())
    reps = stored(good.groupBy("key", "label", "size").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("v").alias("v")))
    basis = leading(reps)
    made = stored(numbered(stored(blocks(ordered(reps, basis, eps), basis))))
    base = made.select("node", "label", F.col("label").alias("label_to"), "size", F.col("size").alias("size_to"),
                       "copies", "rep", "centre", "reach", *BOX)
    pairs, whole = met_intervals(tree(base), eps)
    met = compared(pairs, made, basis, least)
    met = stored(met.union(whole_links(whole, made)) if whole else met)

    several = good.groupBy("vec_id").agg(F.min("key").alias("one"), F.max("key").alias("other")).where("one < other")
    same_id = good.select("vec_id", "key").join(several.select("vec_id"), "vec_id").join(reps.select("key", "rep"), "key")
    final = components(met.select("a", "b").union(same_id.select("vec_id", "rep")))
    links = met.groupBy("key").agg(F.sum("links").alias("links"))
    info = reps.select("key", "rep").join(links, "key").join(final, F.col("rep") == F.col("node"), "left").select(
        "key", (F.col("links") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    joined = rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("key")).alias("key")).join(info, "key", "left")
    component = F.coalesce("component", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
                         component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
