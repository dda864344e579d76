"""Near copies among embeddings by sorted projection passes.

In every pass each vector gets a key of concatenated random hashes (signs of
projections on random directions), vectors are ordered lexicographically by label
and key, and each is compared with the neighbours in a bounded window before it.
Pairs that reach the cosine are united. Vectors that the passes leave open are
compared exactly, as below; all unions together give components. Inside each
component all links are then counted exactly, so a window that is narrower than a
group of copies costs no link.

A pair at cosine 0.98 agrees on a sign with probability 0.936, however the vectors
lie. In every pass each vector knows how many leading signs a partner must share to
lie in its window for certain; a partner is missed by all passes with the product
of the chances of sharing fewer. Vectors for which that product is above ``MISS``
(as in dense labels, where thousands share their first signs) are open: all open
vectors of a label are compared with one another. So a pair is lost at most once in
a million, whatever the data; a link between two groups only if all their pairs are.
The number of passes grows with the classes of the largest label, such that evenly
spread vectors are not open, as long as ``MOST_PASSES`` are enough for that.

Scale: equal vectors of a label are one class with a count, before any
comparison. Each pass is a range-partitioned sort, so hot labels and keys are
split; windows end at partition borders, and what lies beyond one counts as not
compared. A task returns one edge per vector and pass at most. Open vectors and
large components are taken in tiles of ``TILE`` vectors, each pair of tiles its own
group: n open vectors of a label cost n x n products.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and vectors without a label, link with nothing: no links, their own
component, kept. Vectors of different length never link. A row with a null vec_id
has no links and no component and is not kept. Rows that repeat a vec_id are
vectors of their own. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.shared import checkpointed, connected_components

COSINE = 0.98
PASSES = 16
BITS = 32
WINDOW = 32
TILE = 1024
MISS = 1e-6
MOST_PASSES = 64
_GROUPS = 4096


def _directions(size: int, passes: int) -> np.ndarray:
    return np.random.default_rng(size * 1000 + passes).standard_normal((size, passes * BITS))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as one matrix in double precision."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _keys(batches: Iterable[pa.RecordBatch], passes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = batch.column("size").to_numpy()
        for size in np.unique(sizes):
            rows = pa.array(np.flatnonzero(sizes == size))
            part = batch.take(rows)
            signs = (_matrix(part.column("vector")) @ _directions(int(size), passes) > 0).reshape(len(rows), passes, BITS)
            keys = (signs @ (np.int64(1) << np.arange(BITS - 1, -1, -1))).astype(np.int64)
            for k in range(passes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), k, np.int32)), part.column("label"), part.column("size"),
                     pa.array(np.ascontiguousarray(keys[:, k])), part.column("node"), part.column("vector")],
                    ["pass", "label", "size", "key", "node", "vector"],
                )


class _Unions:
    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    def unite(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)


def _agreement(cosine: float) -> float:
    """The chance that two vectors at this cosine have the same sign in a random direction."""
    return 1 - float(np.arccos(np.clip(cosine, -1, 1))) / np.pi


def _missed(cosine: float, signs: np.ndarray) -> np.ndarray:
    """Log of the chance that a partner at this cosine shares fewer leading signs."""
    return np.log(np.maximum(1 - _agreement(cosine) ** signs, 1e-300))


def enough_passes(largest: int, cosine: float, window: int, passes: int) -> int:
    """Passes, ``passes`` or more, that leave no evenly spread vector of a label of this many open."""
    signs = max(0.0, np.log2(max(largest, 1) / window)) + 2
    needed = np.log(MISS) / _missed(cosine, np.array(signs)) + 1
    return max(passes, int(np.ceil(needed))) if needed <= MOST_PASSES else passes


def _shared_signs(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return BITS - np.frexp((x ^ y).astype(np.float64))[1]


def _misses(keys: np.ndarray, first: bool, last: bool, cosine: float, window: int) -> np.ndarray:
    """Per vector of a run in order: log of the chance that a partner lies outside its window.

    Where the run is the first or last of its partition it may go on beyond it,
    so nothing is known of vectors whose window reaches over the border.
    """
    signs = np.zeros(len(keys), np.int64)
    known = np.ones(len(keys), bool)
    far = window + 1
    if len(keys) > far:
        shared = _shared_signs(keys[far:], keys[:-far]) + 1
        signs[far:] = shared
        signs[:-far] = np.maximum(signs[:-far], shared)
    if first:
        known[:far] = False
    if last:
        known[max(0, len(keys) - far) :] = False
    return np.where(known & (signs <= BITS), _missed(cosine, signs), 0.0)


def _windows(batches: Iterable[pa.RecordBatch], cosine: float, window: int) -> Iterator[pa.RecordBatch]:
    """Edges from each vector to the smallest node that the windows of this partition join it to, by pass.

    Besides, by vector and pass, the log of the chance that a partner was not in its window (b is null).
    """
    unions = _Unions()
    passed = []  # run, nodes and keys of all rows
    held = None  # the last rows of the run so far
    for batch in batches:
        runs = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("pass", "label", "size")], axis=1)
        edges = np.concatenate([[0], np.flatnonzero((runs[1:] != runs[:-1]).any(axis=1)) + 1, [len(runs)]])
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
            run = tuple(runs[low])
            nodes = batch.column("node").slice(low, high - low).to_numpy()
            if not passed or passed[-1][0] != run:
                passed.append((run, [], []))
            passed[-1][1].append(nodes)
            passed[-1][2].append(batch.column("key").slice(low, high - low).to_numpy())
            unit = _matrix(batch.column("vector").slice(low, high - low))
            unit = unit / np.linalg.norm(unit, axis=1)[:, None]
            if held and held[0] == run:
                nodes, unit = np.concatenate([held[1], nodes]), np.concatenate([held[2], unit])
            for back in range(1, min(window, len(nodes) - 1) + 1):
                near = np.flatnonzero(np.einsum("ij,ij->i", unit[back:], unit[:-back]) >= cosine)
                for x, y in zip(nodes[near + back].tolist(), nodes[near].tolist()):
                    unions.unite(x, y)
            held = (run, nodes[-window:], unit[-window:])
    found = [(x, unions.root(x)) for x in list(unions.parent)]
    found = [(x, y) for x, y in found if x != y]
    names = ["a", "b", "miss"]
    yield pa.RecordBatch.from_arrays(
        [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64()), pa.nulls(len(found), pa.float64())], names
    )
    for i, (_, nodes, keys) in enumerate(passed):
        misses = _misses(np.concatenate(keys), i == 0, i == len(passed) - 1, cosine, window)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), pa.nulls(len(misses), pa.int64()), pa.array(misses)], names)


def _roots(near: np.ndarray) -> np.ndarray:
    """The first row of each row's component."""
    root = np.full(len(near), -1)
    for i in range(len(near)):
        if root[i] < 0:
            root[i], front = i, np.array([i])
            while len(front):
                front = np.flatnonzero(near[front].any(axis=0) & (root < 0))
                root[front] = i
    return root


def _near_edges(group: pa.Table, cosine: float) -> pa.Table:
    """Edges that join what is near within a tile, or between two tiles of a label."""
    group = group.combine_chunks()
    low, high, tile, node = (group.column(c).to_numpy() for c in ("low", "high", "tile", "node"))
    unit = _matrix(group.column("vector").combine_chunks())
    unit = unit / np.linalg.norm(unit, axis=1)[:, None]
    if low[0] == high[0]:
        near = unit @ unit.T >= cosine
    else:
        left = tile == low[0]
        near = np.zeros((len(unit), len(unit)), bool)
        found = unit[left] @ unit[~left].T >= cosine
        near[np.ix_(left, ~left)], near[np.ix_(~left, left)] = found, found.T
    joined = np.flatnonzero(near.sum(axis=1) > np.diagonal(near))
    root = joined[_roots(near[np.ix_(joined, joined)])] if len(joined) else joined
    return pa.table({"a": node[joined], "b": node[root]})


def _exact_edges(left_open: DataFrame, cosine: float, tile: int) -> DataFrame:
    """(a, b) that join all near vectors among these (label, size, node, vector)."""
    run = ["label", "size"]
    rows = left_open.join(left_open.groupBy(*run).agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), run)
    rows = rows.withColumn("tiles", F.ceil(F.col("members") / tile)).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other")
    cells = rows.select(*run, "node", "vector", "tile", other).select(
        *run, "node", "vector", "tile", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high")
    )
    # dealt by all four: the join has dealt by label, and the tiles of a label would stay together
    return cells.repartition(*run, "low", "high").groupBy(*run, "low", "high").applyInArrow(lambda group: _near_edges(group, cosine), "a long, b long")


def _count_links(group: pa.Table, cosine: float) -> pa.Table:
    """Links of the vectors of each cell: within a tile, or of two tiles of a component with one another."""
    group = group.combine_chunks()
    component, low, high, tile, node, weight = (
        group.column(c).to_numpy() for c in ("component", "low", "high", "tile", "node", "weight")
    )
    order = np.lexsort((tile, high, low, component))
    same = np.concatenate([[True], (np.diff(component[order]) != 0) | (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)])
    edges = np.append(np.flatnonzero(same), len(order))
    nodes, links = [], []
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
        rows = order[start:end]
        unit = _matrix(group.column("vector").combine_chunks().take(pa.array(rows)))
        unit = unit / np.linalg.norm(unit, axis=1)[:, None]
        left = tile[rows] == low[rows[0]]
        if low[rows[0]] == high[rows[0]]:
            near = unit @ unit.T >= cosine
            np.fill_diagonal(near, False)
            found = near @ weight[rows]
        else:
            near = unit[left] @ unit[~left].T >= cosine
            found = np.empty(len(rows), np.int64)
            found[left], found[~left] = near @ weight[rows][~left], near.T @ weight[rows][left]
        nodes.append(node[rows])
        links.append(found.astype(np.int64))
    return pa.table({"node": np.concatenate(nodes), "links": np.concatenate(links)})


def near_duplicates(
    embeddings: DataFrame, cosine: float = COSINE, passes: int = PASSES, window: int = WINDOW, tile: int = TILE
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    rows = rows.select("vec_id", "label", "vector", F.coalesce(usable, F.lit(False)).alias("usable"))
    rows = rows.withColumn("node", F.when(F.col("usable"), F.xxhash64("label", "vector")))
    classes = checkpointed(
        rows.filter("usable").groupBy("node").agg(
            F.first("label").alias("label"), F.first(F.size("vector")).alias("size"), F.first("vector").alias("vector"),
            F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"),
        )
    )
    largest = classes.groupBy("label", "size").count().agg(F.max("count")).first()[0] or 0
    passes = enough_passes(largest, cosine, window, passes)
    keyed = classes.select("label", "size", "node", "vector").mapInArrow(
        lambda b: _keys(b, passes), "pass int, label long, size int, key long, node long, vector array<double>"
    )
    ordered = keyed.repartitionByRange("pass", "label", "size", "key", "node").sortWithinPartitions(
        "pass", "label", "size", "key", "node"
    )
    told = ordered.mapInArrow(lambda b: _windows(b, cosine, window), "a long, b long, miss double")
    told = checkpointed(told.groupBy("a").agg(F.sum("miss").alias("miss"), F.collect_set("b").alias("others")))
    left_open = told.filter(F.col("miss") > float(np.log(MISS))).select(F.col("a").alias("node"))
    left_open = left_open.join(classes.select("label", "size", "node", "vector"), "node")
    edges = told.select("a", F.explode("others").alias("b")).unionByName(_exact_edges(left_open, cosine, tile))
    components = checkpointed(connected_components(edges))

    sizes = components.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    members = components.join(sizes, "component").join(classes.select("node", "vector", "weight"), "node")
    tiles = F.ceil(F.col("members") / tile)
    members = members.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other")
    cells = members.select("component", "node", "vector", "weight", "tile", "tiles", other).select(
        "component", "node", "vector", "weight", "tile", F.least("tile", "other").alias("low"),
        F.greatest("tile", "other").alias("high"),
        F.when(F.col("tiles") == 1, F.pmod(F.xxhash64("component"), F.lit(_GROUPS))).otherwise(
            F.xxhash64("component", F.least("tile", "other"), F.greatest("tile", "other"))
        ).alias("cell"),
    )
    counted = cells.groupBy("cell").applyInArrow(lambda group: _count_links(group, cosine), "node long, links long")
    links = counted.groupBy("node").agg(F.sum("links").alias("links"))
    ids = components.join(classes.select("node", "least"), "node")
    least = ids.groupBy("component").agg(F.min("least").alias("component_id"))
    joined = ids.join(least, "component").select("node", "component_id")
    facts = classes.select("node", "weight", "least").join(links, "node", "left").join(joined, "node", "left").select(
        "node", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "least").alias("component_id"),
    )
    return rows.select("vec_id", "node").join(facts, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"),
    )
