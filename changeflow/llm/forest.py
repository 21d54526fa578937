"""Embedding near-dedup by a forest of random-projection trees.

Each tree splits the vectors again and again by their projection on a random direction, at a random place near the median, and
sends what lies close to the split to both sides. Pairs are compared in the leaves of all trees, with exact cosines in
double precision, and the links of all leaves are united to components.

The upper splits are fitted on a bounded sample and broadcast; every vector is routed by them. A group of vectors that
arrives below one of them is split on, with all its vectors, inside its task. Equal vectors are one node. A group
sends a spanning forest of its links only. A leaf is too small for a dense group, so links are counted afterwards, each vector with
all others of its component: in one task where the component is small, else in a grid of packs of its vectors. Packs whose bounding angles
say that all their pairs are links, or none, are not compared."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changeflow.llm import common as C
from changeflow.llm.components import components

TREES = 12
#: Share of a node's vectors on either side of the split that goes to both sides.
SPILL = 0.08
#: Vectors of the sample that fits the upper splits, vectors that a group below them should have, and vectors in a leaf.
SAMPLE, GROUP, LEAF = 20_000, 4_000, 400
#: Bytes of a pack of a component's vectors.
PACK_BYTES = 1 << 20
#: Angles closer than this to the threshold's are not decided by bounds.
ANGLE_MARGIN = 1e-6
#: Vectors of a sample below a split.
LEAST_SAMPLE = 32


class Tree:
    """Upper splits: a direction, and the places up to which vectors go left and from which they go right. Children below 0 are groups."""

    def __init__(self, sample: np.ndarray, leaves: int, seed: int):
        rng = np.random.default_rng(seed)
        self.directions, self.right_from, self.left_to, self.children = [], [], [], []
        self.groups = 0
        self.root = self._grow(sample, leaves, rng)
        self.arrays = (np.array(self.directions).reshape(len(self.directions), sample.shape[1]), np.array(self.right_from), np.array(self.left_to), np.array(self.children).reshape(-1, 2))
        del self.directions, self.right_from, self.left_to, self.children

    def _grow(self, sample: np.ndarray, leaves: int, rng) -> int:
        split = _split(sample, rng) if leaves > 1 and len(sample) >= LEAST_SAMPLE else None
        if split is None:
            self.groups += 1
            return -self.groups
        node = len(self.directions)
        direction, low, high, values = split
        self.directions.append(direction)
        self.right_from.append(low)
        self.left_to.append(high)
        self.children.append(None)
        self.children[node] = (self._grow(sample[values <= high], leaves // 2, rng), self._grow(sample[values >= low], leaves - leaves // 2, rng))
        return node

    def route(self, vectors: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(group, rows) for the groups that the vectors reach."""
        directions, low, high, children = self.arrays
        todo = [(self.root, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if node < 0:
                yield -node, rows
                continue
            values = vectors[rows] @ directions[node]
            todo.append((children[node, 0], rows[values <= high[node]]))
            todo.append((children[node, 1], rows[values >= low[node]]))


def _split(vectors: np.ndarray, rng) -> tuple[np.ndarray, float, float, np.ndarray] | None:
    """A random direction with the borders of its overlap, and the projections; None where projections do not tell vectors apart."""
    for _ in range(3):
        direction = rng.standard_normal(vectors.shape[1])
        values = vectors @ direction
        at = rng.uniform(0.35, 0.65)
        low, high = np.quantile(values, [at - SPILL, at + SPILL])
        if (values <= high).mean() < 0.9 and (values >= low).mean() < 0.9:
            return direction, float(low), float(high), values
    return None


def _leaves(vectors: np.ndarray, rng) -> Iterator[np.ndarray]:
    """Rows of the leaves of a group."""
    todo = [np.arange(len(vectors))]
    while todo:
        rows = todo.pop()
        split = _split(vectors[rows], rng) if len(rows) > LEAF else None
        if split is None:
            yield rows
        else:
            _, low, high, values = split
            todo += [rows[values <= high], rows[values >= low]]


def _ties(vectors: np.ndarray, rows: np.ndarray, least: float) -> Iterator[tuple[int, np.ndarray]]:
    """(row, rows) that tie the linked rows of a leaf together: each linked row is reached once."""
    some = np.zeros(len(rows), bool)
    for at in range(0, len(rows), 512):
        near = vectors[rows[at:at + 512]] @ vectors[rows].T >= least
        near[np.arange(len(near)), np.arange(at, at + len(near))] = False
        some[at:at + len(near)] = near.any(1)
    left = rows[some]
    while len(left):
        todo, left = [left[:1]], left[1:]
        while todo and len(left):
            here = todo.pop()
            todo += [here[512:]] if len(here) > 512 else []
            here = here[:512]
            near = vectors[left] @ vectors[here].T >= least
            hit = near.any(1)
            by = here[near[hit].argmax(1)]
            for x in np.unique(by):
                yield int(x), left[hit][by == x]
            if hit.any():
                todo.append(left[hit])
                left = left[~hit]


def _linked_copies(a: np.ndarray, copies_a: np.ndarray, b: np.ndarray, copies_b: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """For each vector of either side, the copies of the other side's vectors that link with it."""
    to_a, to_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    for at in range(0, len(a), 512):
        near = (a[at:at + 512] @ b.T >= least).astype(np.float64)
        to_a[at:at + 512] = near @ copies_b
        to_b += (copies_a[at:at + 512] @ near).astype(np.int64)
    return to_a, to_b


def _own_copies(a: np.ndarray, copies: np.ndarray, least: float) -> np.ndarray:
    """For each vector, the copies of the others that link with it."""
    out = np.zeros(len(a), np.int64)
    for at in range(0, len(a), 512):
        near = (a[at:at + 512] @ a.T >= least).astype(np.float64)
        near[np.arange(len(near)), np.arange(at, at + len(near))] = 0
        out[at:at + 512] = near @ copies
    return out


def _forest_edges(links: dict[int, set]) -> list[tuple[int, int]]:
    """A spanning forest of the links."""
    seen, out = set(), []
    for start in links:
        if start in seen:
            continue
        seen.add(start)
        todo = [start]
        while todo:
            x = todo.pop()
            for y in links[x] - seen:
                seen.add(y)
                out.append((x, y))
                todo.append(y)
    return out


def _degrees(nodes: DataFrame, parts: DataFrame, folder: str, least: float, size: int, buckets: int) -> DataFrame:
    """(node, others): the copies of other nodes of its component that each node of ``parts`` links with."""
    pack = max(16, PACK_BYTES // (8 * size))
    large = parts.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") > pack).select("component", F.ceil(F.col("n") / pack).cast("int").alias("salts"))
    members = nodes.join(parts, "node").join(large, "component", "left")
    members = members.withColumn("salts", F.coalesce("salts", F.lit(1))).withColumn("salt", F.pmod(F.xxhash64("node", F.lit(1)), F.col("salts")).cast("int"))
    members = members.withColumn("bucket", F.pmod(F.xxhash64("component", "salt"), F.lit(buckets)))
    schema = pa.schema([("component", pa.int64()), ("salt", pa.int32()), ("salts", pa.int32()), ("nodes", pa.binary()), ("copies", pa.binary()), ("others", pa.binary()),
                        ("vectors", pa.binary()), ("center", pa.binary()), ("radius", pa.float64())])
    columns = "component long, salt int, salts int, nodes binary, copies binary, others binary, vectors binary, center binary, radius double"

    def packed(table: pa.Table) -> pa.Table:
        component, salt, salts, node, copies = (table.column(c).to_numpy() for c in ("component", "salt", "salts", "node", "copies"))
        blobs = table.column("vector").to_pylist()
        order = np.lexsort((node, salt, component))
        new = np.ones(len(order), bool)
        new[1:] = (component[order[1:]] != component[order[:-1]]) | (salt[order[1:]] != salt[order[:-1]])
        alone_nodes, alone_others, rows = [], [], []
        for at in np.split(order, np.flatnonzero(new)[1:]):
            matrix = np.frombuffer(b"".join(blobs[i] for i in at), np.float64).reshape(len(at), -1)
            others = _own_copies(matrix, copies[at], least)
            if salts[at[0]] == 1:
                alone_nodes.append(node[at])
                alone_others.append(others)
                continue
            center = matrix.mean(0)
            center = center / np.sqrt((center * center).sum()) if center.any() else matrix[0]
            radius = float(np.arccos(np.clip(matrix @ center, -1, 1)).max())
            rows.append({"component": int(component[at[0]]), "salt": int(salt[at[0]]), "salts": int(salts[at[0]]), "nodes": node[at].tobytes(), "copies": copies[at].tobytes(),
                         "others": others.tobytes(), "vectors": matrix.tobytes(), "center": center.tobytes(), "radius": radius})
        if alone_nodes:
            rows.append({"nodes": np.concatenate(alone_nodes).tobytes(), "others": np.concatenate(alone_others).tobytes()})
        return pa.Table.from_pylist(rows, schema=schema)

    packs = C.saved(members.groupBy("bucket").applyInArrow(packed, columns), folder, "packs")
    grid = packs.where("salts > 1")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = np.arccos(least)
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.float64).reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 1)) for c in ("center_a", "center_b"))
            between = np.arccos(np.clip((x * y).sum(1), -1, 1))
            around = batch.column("radius_a").to_numpy() + batch.column("radius_b").to_numpy()
            every, none = between + around < limit - ANGLE_MARGIN, between - around > limit + ANGLE_MARGIN
            part = pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("component", "a", "b")), pa.array(every)], names=["component", "a", "b", "every"])
            yield part.filter(pa.array(~none))

    one = grid.where("salt + 1 < salts").select("component", F.col("salt").alias("a"), F.col("center").alias("center_a"), F.col("radius").alias("radius_a"),
                                                F.explode(F.sequence(F.col("salt") + 1, F.col("salts") - 1)).alias("b"))
    two = grid.select("component", F.col("salt").alias("b"), F.col("center").alias("center_b"), F.col("radius").alias("radius_b"))
    cells = C.saved(one.join(two, ["component", "b"]).mapInArrow(_of_one_size(judged, "center_a"), "component long, a int, b int, every boolean"), folder, "cells")

    side = lambda name: grid.select("component", F.col("salt").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in ("nodes", "copies", "vectors")))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in C.rows_of(batches):
            copies = [np.frombuffer(row[f"copies_{c}"], np.int64) for c in "ab"]
            if row["every"]:
                told = [np.full(len(copies[0]), copies[1].sum()), np.full(len(copies[1]), copies[0].sum())]
            else:
                x, y = (np.frombuffer(row[f"vectors_{c}"], np.float64).reshape(len(n), -1) for c, n in zip("ab", copies))
                told = _linked_copies(x, copies[0], y, copies[1], least)
            yield _degree_rows(row["nodes_a"] + row["nodes_b"], np.concatenate(told).tobytes())

    # Vectors are sent for the cells that need them only.
    met = lambda cells, drop: cells.join(side("a").drop(*drop), ["component", "a"]).join(side("b").drop(*drop), ["component", "b"])
    across = met(cells.where("not every"), ()).mapInArrow(counted, "node long, others long")
    whole = met(cells.where("every"), ("vectors_a", "vectors_b")).mapInArrow(counted, "node long, others long")

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in C.rows_of(batches):
            yield _degree_rows(row["nodes"], row["others"])

    own = packs.select("nodes", "others").mapInArrow(within, "node long, others long")
    return own.union(across).union(whole).groupBy("node").agg(F.sum("others").alias("others"))


def _degree_rows(nodes: bytes, others: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.frombuffer(nodes, np.int64)), pa.array(np.frombuffer(others, np.int64))], names=["node", "others"])


def _of_one_size(work, column: str):
    """``work`` on parts of batches whose values of ``column`` have one length."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column(column).to_pylist()], np.int64)
            yield from work(batch.filter(pa.array(sizes == n)) for n in np.unique(sizes))

    return parts


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.9, trees: int = TREES,
                 sample: int = SAMPLE, group: int = GROUP, seed: int = 11) -> DataFrame:
    """(id, n_links, component_id, kept) for each row of ``rows``: rows whose vectors have a cosine of at least ``least`` are linked. Components
    are made of the links that meet in a leaf of some tree, and named by their smallest id, the one that is kept; ``n_links`` are all links
    of a row within its component.

    Vectors that are null, empty, zero, or hold null, NaN or infinite components link with nothing; vectors of different lengths
    do not link. Equal vectors link with each other. Rows that share an id are rows of their own; rows without id take no
    part, have no component and are kept. Other columns are not looked at. No rows give no rows."""
    spark = rows.sparkSession
    folder = C.workdir(spark, "forest")

    def normed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs: list = []
            for values in batch.column(1).to_pylist():
                v = np.array([np.nan if x is None else x for x in values or []], np.float64)
                ok = len(v) and np.isfinite(v).all() and v.any()
                if ok:
                    v = v / np.abs(v).max()
                    v = v / np.sqrt((v * v).sum())
                blobs.append(v.tobytes() if ok else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], names=["id", "vector"])

    ids = F.coalesce(F.col(id_col).cast("long"), F.lit(C.NULL_ID)).alias("id")
    vectors = rows.select(ids, F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(normed, "id long, vector binary")
    vectors = C.saved(vectors.withColumn("node", F.when((F.col("id") != C.NULL_ID), F.xxhash64("vector"))), folder, "vectors")
    linked = vectors.where("vector is not null and node is not null")
    nodes = C.saved(linked.groupBy("node").agg(F.count("*").alias("copies"), F.min("vector").alias("vector")), folder, "nodes")
    known = nodes.agg(F.count("*").alias("n"), F.max(F.length("vector")).alias("bytes")).first()
    size = (known.bytes or 8) // 8
    # The sample is chosen by hash and bounded; every vector is indexed below.
    share = min(1.0, sample / max(1, known.n))
    taken = nodes.where(F.pmod(F.xxhash64(F.col("node")), 1_000_000) < int(share * 1_000_000)).select("vector").limit(2 * sample).collect()
    fitted = np.zeros((len(taken), size))
    for i, r in enumerate(taken):
        v = np.frombuffer(r.vector, np.float64)
        fitted[i, :len(v)] = v
    forest = spark.sparkContext.broadcast([Tree(fitted, max(1, known.n // group), seed + t) for t in range(trees)])

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column(1).to_pylist()
            matrix = np.zeros((len(blobs), size))
            sizes = np.array([len(b) // 8 for b in blobs], np.int32)
            for i, b in enumerate(blobs):
                matrix[i, :sizes[i]] = np.frombuffer(b, np.float64)
            for t, tree in enumerate(forest.value):
                for leaf, at in tree.route(matrix):
                    part = batch.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), t, np.int32)), pa.array(np.full(len(at), leaf, np.int32)), pa.array(sizes[at]), *part.columns],
                                                     names=["tree", "leaf", "size", "node", "vector"])

    def compared(key: tuple, table: pa.Table) -> pa.Table:
        tree, leaf, n = (k.as_py() for k in key)
        node = table.column("node").to_numpy()
        matrix = np.frombuffer(b"".join(table.column("vector").to_pylist()), np.float64).reshape(-1, n)
        order = np.argsort(node)  # so that the splits do not depend on the order of arrival
        node, matrix = node[order], matrix[order]
        near: dict[int, set] = {}
        for rows_ in _leaves(matrix, np.random.default_rng([seed, tree, leaf])):
            for x, ys in _ties(matrix, rows_, least):
                near.setdefault(x, set()).update(ys.tolist())
                for y in ys.tolist():
                    near.setdefault(y, set()).add(x)
        tied = [(int(node[x]), int(node[y])) for x, y in _forest_edges(near)]
        return pa.table({"a": pa.array([a for a, _ in tied], pa.int64()), "b": pa.array([b for _, b in tied], pa.int64())})

    met = nodes.select("node", "vector").mapInArrow(routed, "tree int, leaf int, size int, node long, vector binary")
    found = C.saved(met.groupBy("tree", "leaf", "size").applyInArrow(compared, "a long, b long"), folder, "links")
    parts = components(found, folder)
    degree = _degrees(nodes, parts, folder, least, size, max(1, known.n // group))
    placed = nodes.select("node", "copies").join(degree, "node", "left").join(parts, "node", "left").select(
        "node", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component"))
    placed = C.saved(placed, folder, "placed")
    named = linked.join(placed, "node").groupBy("component").agg(F.min("id").alias("component_id"))
    by_node = placed.join(named, "component").select("node", "n_links", "component_id")
    own = F.when(F.col("id") != C.NULL_ID, F.coalesce("component_id", "id"))
    out = vectors.withColumn("key", F.when(F.col("vector").isNotNull(), F.col("node"))).join(by_node.withColumnRenamed("node", "key"), "key", "left")
    return out.select(C.id_or_null().alias("id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), own.alias("component_id"),
                      F.coalesce(own == F.col("id"), F.lit(True)).alias("kept"))
