"""Exact Jaccard join of word n-gram sets by PartEnum signatures.

Two documents link when their sets of distinct n-word shingles have a Jaccard
similarity of at least ``numerator / denominator``. Sets of similar size fall into
the same or the next size band. Within a band (and its lower neighbour) a linked
pair differs in at most k features, k following from the band's largest size. The
feature domain is partitioned by hash; k differences cannot reach all parts:

- up to ``ENUMERATE_UP_TO`` differences: k // 2 + 1 groups of three parts; some
  group has at most one difference, so two of its three parts are alike. All
  subsets of two parts are enumerated as signatures.
- beyond it: more than k groups of one part each; some part is alike.

A signature is the hash of a set's features in those parts, so a linked pair
shares one. Parts without features would be alike for many sets. They are left
out where enough other parts are left for the argument to hold, and kept where
not, so no pair is lost.

Equal sets are one node (a 64-bit hash of the set). Nodes with a common signature
are candidates. Candidates of a signature first meet the smallest of them only;
of those that are then in different components, the nearest pairs that could join
the components meet; last, all pairs of components that are still apart. Each
pair with a signature's smallest candidate is tested by size and by a parity sketch
of 256 bits. All pairs are tested by one that has a bit per feature at least, where
candidates meet, and last by the sets themselves. The distance of parity sketches
never exceeds the sets' distance, so they drop no link.

Scale: signatures move as packed arrays in buckets whose number follows the text
size. Equal sets are one node before any comparison. A group of near copies costs
one pair per member, not all pairs. Texts are never shuffled: sets are rebuilt
where texts are read, for the ids that pass a bitmap of the candidates' ids, whose
size is bounded. Links, components and nodes stay in DataFrames.

Defined results: a document of fewer than n words has one shingle, its whole word
sequence; without words its set is empty and links with nothing, and its
component is its own id. A null doc_id never links and has no component. Rows
that repeat a doc_id are documents of their own. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.buckets import bucket_count, packed, split_key, unpacked
from oreflow.llm.shared import arrow_rows, checkpointed, checkpointed_narrow, connected_components
from oreflow.llm.textbytes import LOWER, NONSPACE, Slice, give_back, given_back, mix, prefix_hash, ranges, slices, span_hash, word_spans

ENUMERATE_UP_TO = 32
#: Size of the id filter that is sent to tasks (64 MB); with more ids it lets more others pass, which a join then drops.
FILTER_BITS = 1 << 29
BUCKET_BYTES = 8 << 20
_FLUSH = 1 << 20
_SLICE = 1 << 19  # bytes of text whose sets are made at once
#: Pairs that a task compares at once: each brings two whole sets, or two sketches of a quarter byte to half a byte per feature.
PAIR_ROWS = 200
SKETCH_ROWS = 1000
_SKETCH_BITS = 256
#: Parities of more features vary less: beyond so many, half the bits tell sets apart as well.
_LARGE_SET = 1024


@dataclass(frozen=True)
class Similarity:
    words: int = 3
    numerator: int = 90
    denominator: int = 100

    def distance(self, total: np.ndarray) -> np.ndarray:
        """Most features in which linked sets of ``total`` features together can differ."""
        return total * (self.denominator - self.numerator) // (self.denominator + self.numerator)

    def links(self, common: np.ndarray, total: np.ndarray) -> np.ndarray:
        return common * self.denominator >= self.numerator * (total - common)


def shingle_sets(part: Slice, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each, and the borders of the texts."""
    data = LOWER[part.data]
    start, end, first = word_spans(data, part.offsets, NONSPACE)
    hashes = span_hash(prefix_hash(data), start, end)
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(part)), counts)
    odd = mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    full = ranges(first[:-1], np.maximum(counts - words + 1, 0))
    sums = np.zeros(len(full), np.uint64)
    for k in range(words):
        sums += hashes[full + k] * odd[k]
    shingles, owners = [mix(sums)], [owner[full]]
    for size in range(1, words):
        short = first[:-1][counts == size]
        sums = np.full(len(short), np.uint64(size))
        for k in range(size):
            sums += hashes[short + k] * odd[k]
        shingles.append(mix(mix(sums) + np.uint64(size)))
        owners.append(np.flatnonzero(counts == size))
    values, owners = np.concatenate(shingles), np.concatenate(owners)
    order = np.lexsort((values, owners))
    values, owners = values[order], owners[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    values, owners = values[new], owners[new]
    return values, np.searchsorted(owners, np.arange(len(part) + 1))


def _sums(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    total = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    return total[borders[1:]] - total[borders[:-1]]


def set_nodes(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Equal for equal sets."""
    size = np.diff(borders).astype(np.uint64)
    return mix(_sums(mix(values ^ np.uint64(0x5851F42D4C957F2D)), borders) + mix(size)).view(np.int64)


def _sketches(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Parities of the features' numbers in 256 hash classes, as four 64-bit words."""
    n = len(borders) - 1
    owner = np.repeat(np.arange(n), np.diff(borders))
    bit = (mix(values ^ np.uint64(0x14057B7EF767814F)) % np.uint64(_SKETCH_BITS)).astype(np.int64)
    odd = np.bincount(owner * _SKETCH_BITS + bit, minlength=n * _SKETCH_BITS).reshape(n, _SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)


def _long_sketches(values: np.ndarray, borders: np.ndarray) -> pa.Array:
    """Parities in a power of two of hash classes, two to four for each feature (in large sets one to two); halves fold onto each other."""
    sizes = np.diff(borders)
    wanted = np.where(sizes > _LARGE_SET, sizes, 2 * sizes)
    bits = np.int64(1) << np.ceil(np.log2(np.maximum(wanted, _SKETCH_BITS))).astype(np.int64)
    base = np.concatenate([[0], np.cumsum(bits)])
    hashes = mix(values ^ np.uint64(0x14057B7EF767814F)) & np.repeat(bits - 1, sizes).astype(np.uint64)
    odd = np.bincount(np.repeat(base[:-1], sizes) + hashes.astype(np.int64), minlength=int(base[-1])) & 1
    packed_bits = np.packbits(odd.astype(np.uint8))
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((base // 8).astype(np.int32)), pa.py_buffer(packed_bits)])


def _folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """The sketch that the same features have in fewer classes."""
    while len(sketch) > size:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


def bands(largest: int, rule: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """First and last sizes of the bands up to the one that holds ``largest``, and one more."""
    low, first, last = 1, [], []
    while True:
        high = low * rule.denominator // rule.numerator
        first.append(low)
        last.append(high)
        if low > largest:
            return np.array(first), np.array(last)
        low = high + 1


def partitioning(differences: int) -> tuple[int, int, int]:
    """Groups, parts of a group, and the groups that so many differences can spoil at most."""
    if differences == 0:
        return 1, 1, 0
    if differences <= ENUMERATE_UP_TO:
        groups, parts, spoilt = differences // 2 + 1, 3, differences // 2
    else:
        groups, parts, spoilt = differences + 1, 1, differences
    return groups + (groups // 10 if groups >= 10 else 0), parts, spoilt


def signatures(values: np.ndarray, borders: np.ndarray, rule: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of all sets and the set that each belongs to."""
    sizes = np.diff(borders)
    sets = np.flatnonzero(sizes)
    if not len(sets):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    first, last = bands(int(sizes.max()), rule)
    plans = np.array([partitioning(int(rule.distance(2 * u))) for u in last])
    own = np.searchsorted(first, sizes[sets], "right") - 1
    # every set takes part in its own band and as a smaller partner in the next
    sets, band = np.concatenate([sets, sets]), np.concatenate([own, own + 1])
    groups, parts, spoilt = plans[band].T
    cells = groups * parts
    base = np.cumsum(cells) - cells
    feature = ranges(borders[sets], sizes[sets])
    owner = np.repeat(np.arange(len(sets)), sizes[sets])
    mixed = mix(values[feature])
    group = ((mixed >> np.uint64(24)) % groups[owner].astype(np.uint64)).astype(np.int64)
    part = ((mixed & np.uint64(0xFFFFFF)) % parts[owner].astype(np.uint64)).astype(np.int64)
    cell = base[owner] + group * parts[owner] + part
    sums, counts = np.zeros(int(cells.sum()), np.uint64), np.bincount(cell, minlength=int(cells.sum()))
    np.add.at(sums, cell, mix(mixed + np.uint64(0x632BE59BD9B4E019)))

    out, owners = [], []
    for size in (1, 3):
        mine = np.flatnonzero(parts == size)
        if not len(mine):
            continue
        index = ranges(base[mine], cells[mine]).reshape(-1, size)
        of = np.repeat(mine, groups[mine])
        number = ranges(np.zeros(len(mine), np.int64), groups[mine])
        value, count = sums[index], counts[index]
        if size == 3:  # two of three parts: all but one
            value = value.sum(axis=1, dtype=np.uint64)[:, None] - value
            count = count.sum(axis=1)[:, None] - count
        good = np.bincount(of, weights=(count.min(axis=1) > 0), minlength=len(sets))
        needs_empty = good <= spoilt
        keep = (count > 0) | needs_empty[of][:, None]
        place = (band[of] << 32 | number)[:, None] * 4 + np.arange(size)
        out.append(mix(value + mix(place.astype(np.uint64)))[keep])
        owners.append(np.repeat(sets[of], size).reshape(-1, size)[keep])
    return np.concatenate(out), np.concatenate(owners)


META_SCHEMA = "doc_id long, n_shingles long, node long, s0 long, s1 long, s2 long, s3 long, sketch binary"


def _meta(batches: Iterable[pa.RecordBatch], rule: Similarity) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, limit=_SLICE):
        values, borders = shingle_sets(part, rule.words)
        sizes = np.diff(borders)
        sketch = _sketches(values, borders)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array(set_nodes(values, borders), mask=sizes == 0)]
            + [pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(4)]
            + [_long_sketches(values, borders)],
            [x.split()[0] for x in META_SCHEMA.split(", ")],
        )


def _signature_rows(batches: Iterable[pa.RecordBatch], buckets: int, rule: Similarity) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def flush():
        keys, nodes = (np.concatenate(x) for x in zip(*held))
        bucket, rest = split_key(keys, buckets)
        return packed(bucket, {"rest": rest, "node": nodes})

    for part in slices(batches, limit=_SLICE):
        values, borders = shingle_sets(part, rule.words)
        nodes = set_nodes(values, borders)
        _, first = np.unique(nodes, return_index=True)  # equal sets of a slice are sent once
        count = np.diff(borders)[first]
        kept = values[ranges(borders[:-1][first], count)]
        keys, owner = signatures(kept, np.concatenate([[0], np.cumsum(count)]), rule)
        held.append((keys, nodes[first][owner]))
        size += len(keys)
        if size > _FLUSH:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()
    held.clear()
    give_back()


def _common_signatures(group: pa.Table) -> pa.Table:
    """The signatures of a bucket that several nodes have: sorted, with their nodes."""
    rest, node = unpacked(group, "rest", np.uint32), unpacked(group, "node", np.int64)
    order = np.lexsort((node, rest))
    rest, node = rest[order], node[order]
    new = np.ones(len(rest), bool)
    new[1:] = (rest[1:] != rest[:-1]) | (node[1:] != node[:-1])
    rest, node = rest[new], node[new]
    first = np.flatnonzero(np.concatenate([[True], rest[1:] != rest[:-1]]))
    size = np.diff(np.append(first, len(rest)))
    several = np.repeat(size > 1, size)
    return pa.table({
        "bucket": pa.array([group.column("bucket")[0].as_py()], pa.int32()),
        "rest": pa.array([rest[several].tobytes()], pa.binary()), "node": pa.array([node[several].tobytes()], pa.binary()),
    })


def _signature_groups(batches: Iterable[pa.RecordBatch]):
    """(bucket, rest, nodes, first, size) of each packed row."""
    for batch in batches:
        for row in batch.to_pylist():
            rest, node = np.frombuffer(row["rest"], np.uint32), np.frombuffer(row["node"], np.int64)
            if len(rest):
                first = np.flatnonzero(np.concatenate([[True], rest[1:] != rest[:-1]]))
                yield row["bucket"], rest, node, first, np.diff(np.append(first, len(rest)))


def _star_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, _, node, first, size in _signature_groups(batches):
        low = np.repeat(node[first], size)
        pairs = np.unique(np.stack([node, low], axis=1)[node != low], axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["b", "a"])


def _larger_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (signature, node) of the signatures that three nodes or more have."""
    for bucket, rest, node, _, size in _signature_groups(batches):
        kept = np.repeat(size > 2, size)
        yield pa.RecordBatch.from_arrays(
            [pa.array((np.int64(bucket) << np.int64(32)) | rest[kept].astype(np.int64)), pa.array(node[kept])], ["signature", "node"]
        )


def _plausible(a_size, b_size, distance, rule: Similarity):
    """Sizes that allow a link, and a sketch distance that the sets' distance may have."""
    low, high = np.minimum(a_size, b_size), np.maximum(a_size, b_size)
    return (low * rule.denominator >= rule.numerator * high) & (distance <= rule.distance(a_size + b_size))


def _forest(distance: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Of pairs of components, those that join two trees, nearest first."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept = []
    for i in np.argsort(distance, kind="stable").tolist():
        x, y = root(int(left[i])), root(int(right[i]))
        if x != y:
            parent[x] = y
            kept.append(i)
    return np.array(kept, np.int64)


def _cross_pairs(group: pa.Table, rule: Similarity, forest: bool) -> pa.Table:
    """Plausible pairs between different components under the same signature: all, or a forest of the nearest."""
    signature, node, component, size = (group.column(c).to_numpy() for c in ("signature", "node", "component", "n_shingles"))
    sketch = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("sketch")]
    order = np.lexsort((component, signature))
    edges = np.flatnonzero(np.concatenate([[True], np.diff(signature[order]) != 0, [True]]))
    found = []
    for start, end in zip(edges[:-1], edges[1:]):
        rows = order[start:end]
        parts = np.split(rows, np.flatnonzero(np.diff(component[rows])) + 1)
        parts.sort(key=len)
        rest = np.concatenate(parts)  # smaller components first; each meets those after it
        words = min(len(sketch[row]) for row in rest.tolist())
        bits = np.stack([_folded(sketch[row], words) for row in rest.tolist()])
        place, left, right, far = 0, [], [], []
        for part in parts[:-1]:
            first, place = place, place + len(part)
            others = rest[place:]
            for own, row in zip(bits[first:place], part.tolist()):
                distance = np.bitwise_count(bits[place:] ^ own).sum(axis=1)
                near = _plausible(size[others], size[row], distance, rule)
                left.append(np.full(int(near.sum()), row))
                right.append(others[near])
                far.append(distance[near])
        left, right = (np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for x in (left, right))
        if forest and len(left):
            kept = _forest(np.concatenate(far), component[left], component[right])
            left, right = left[kept], right[kept]
        found.append(np.stack([np.maximum(node[left], node[right]), np.minimum(node[left], node[right])], axis=1))
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.table({"b": pairs[:, 0].copy(), "a": pairs[:, 1].copy()})


def _pairs_of(rule: Similarity, forest: bool):
    return lambda group: given_back(_cross_pairs(group, rule, forest))


def _filter_bits(ids: np.ndarray, size: int) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(size)).astype(np.int64)


def _filter_words(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = np.unique(_filter_bits(batch.column("doc_id").to_numpy(), size))
        yield pa.RecordBatch.from_arrays(
            [pa.array(bits >> 6), pa.array((np.uint64(1) << (bits & 63).astype(np.uint64)).view(np.int64))], ["word", "bits"]
        )


def id_filter(ids: DataFrame) -> np.ndarray:
    """One hash bit per doc_id, in a bitmap of at most ``FILTER_BITS`` bits. It lets all of these ids pass, and few others."""
    size = min(FILTER_BITS, max(1 << 12, 1 << (16 * ids.count()).bit_length()))
    words = ids.select("doc_id").mapInArrow(lambda b: _filter_words(b, size), "word long, bits long")
    out = np.zeros(size // 64, np.int64)
    for row in words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toLocalIterator():
        out[row["word"]] = row["bits"]
    return out.view(np.uint64)


def _sets(batches: Iterable[pa.RecordBatch], words: int, bitmap: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Nodes and features of the texts whose id passes the filter."""
    for batch in batches:
        bits = _filter_bits(batch.column("doc_id").to_numpy(), len(bitmap) * 64)
        passes = (bitmap[bits >> 6] >> (bits & 63).astype(np.uint64)) & np.uint64(1) == 1
        for part in slices([batch.filter(pa.array(passes))], limit=_SLICE):
            values, borders = shingle_sets(part, words)
            edges = (borders * 8).astype(np.int32)
            features = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(values))])
            yield pa.RecordBatch.from_arrays([pa.array(set_nodes(values, borders)), features], ["node", "features"])


def _verify(batches: Iterable[pa.RecordBatch], rule: Similarity) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("a_set"), batch.column("b_set")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(bool(rule.links(common, len(x) + len(y))))
        yield batch.select(["b", "a"]).filter(pa.array(keep, pa.bool_()))


def _sketched_near(batches: Iterable[pa.RecordBatch], rule: Similarity) -> Iterator[pa.RecordBatch]:
    """The pairs whose long sketches, folded to the shorter one's length, allow a link."""
    for batch in batches:
        far = np.empty(len(batch), np.int64)
        for i, (x, y) in enumerate(zip(batch.column("a_sketch"), batch.column("b_sketch"))):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            size = min(len(x), len(y))
            far[i] = np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum()
        total = batch.column("a_n_shingles").to_numpy() + batch.column("b_n_shingles").to_numpy()
        yield batch.select(["b", "a"]).filter(pa.array(far <= rule.distance(total)))


def link_documents(documents: DataFrame, rule: Similarity = Similarity(), bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = docs.filter("doc_id IS NOT NULL")
    buckets = bucket_count(docs, bucket_bytes)
    meta = checkpointed(docs.mapInArrow(lambda b: _meta(b, rule), META_SCHEMA))
    sketch = [F.max(f"s{i}").alias(f"s{i}") for i in range(4)]
    nodes = checkpointed(
        meta.filter("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"), *sketch, F.max("sketch").alias("sketch")
        )
    )
    signed = named.mapInArrow(lambda b: _signature_rows(b, buckets, rule), "bucket int, rest binary, node binary")
    groups = checkpointed(signed.groupBy("bucket").applyInArrow(lambda group: given_back(_common_signatures(group)), "bucket int, rest binary, node binary"))
    larger = groups.mapInArrow(_larger_groups, "signature long, node long")

    facts = ["n_shingles", *[f"s{i}" for i in range(4)]]
    of = {x: nodes.select(F.col("node").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in facts]) for x in "ab"}
    stars = groups.mapInArrow(_star_pairs, "b long, a long").distinct()
    distance = sum(F.bit_count(F.col(f"a_s{i}").bitwiseXOR(F.col(f"b_s{i}"))) for i in range(4))
    total = F.col("a_n_shingles") + F.col("b_n_shingles")
    tested = checkpointed_narrow(
        stars.join(of["a"], "a").join(of["b"], "b").filter(
            (F.least("a_n_shingles", "b_n_shingles") * rule.denominator
             >= rule.numerator * F.greatest("a_n_shingles", "b_n_shingles"))
            & (distance * (rule.denominator + rule.numerator) <= total * (rule.denominator - rule.numerator))
        ).select("b", "a")
    )

    def sketched(pairs: DataFrame) -> DataFrame:
        """The pairs that may link by their long sketches."""
        for x in "ba":
            of_x = nodes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"{x}_n_shingles"), F.col("sketch").alias(f"{x}_sketch"))
            pairs = pairs.join(of_x, x)
        return pairs.mapInArrow(lambda batches: _sketched_near(batches, rule), "b long, a long")

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs whose sets link. Sets are rebuilt where the texts are read, for the nodes of these pairs."""
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        bitmap = named.sparkSession.sparkContext.broadcast(id_filter(nodes.join(wanted, "node", "left_semi")))
        rebuilt = named.mapInArrow(lambda b: _sets(b, rule.words, bitmap.value), "node long, features binary")
        sets = checkpointed(rebuilt.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("features").alias("features")))
        both = pairs.join(sets.select(F.col("node").alias("b"), F.col("features").alias("b_set")), "b").join(
            sets.select(F.col("node").alias("a"), F.col("features").alias("a_set")), "a"
        )
        return both.mapInArrow(lambda batches: _verify(batches, rule), "b long, a long")

    def linked_pairs(pairs: DataFrame) -> DataFrame:
        with arrow_rows(documents.sparkSession, SKETCH_ROWS):
            near = checkpointed_narrow(sketched(pairs))
        compared = verified(near)
        with arrow_rows(documents.sparkSession, PAIR_ROWS):
            return checkpointed_narrow(compared)

    links = linked_pairs(tested)
    components = checkpointed_narrow(connected_components(links))
    for forest in (True, False):  # first the nearest pairs that could join components, then every pair left
        placed = larger.join(components, "node", "left").select(
            "signature", "node", F.coalesce("component", "node").alias("component")
        )
        spread = placed.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        unsettled = placed.join(spread.filter("low < high").select("signature"), "signature", "left_semi")
        rows = unsettled.join(nodes.select("node", "n_shingles", "sketch"), "node").withColumn("bucket", F.shiftright("signature", 32))
        more = rows.groupBy("bucket").applyInArrow(_pairs_of(rule, forest), "b long, a long").distinct()
        more = checkpointed_narrow(more.join(tested, ["b", "a"], "left_anti"))
        found = linked_pairs(more)
        if not found.isEmpty():
            links, tested = links.unionByName(found), tested.unionByName(more)
            components = checkpointed_narrow(connected_components(links))

    ids = nodes.select("node", "doc_id").join(components, "node")
    least = ids.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = ids.join(least, "component").select("node", "component_id")
    answer = nodes.select("node", "doc_id").join(linked, "node", "left").select(
        "node", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    return meta.select("doc_id", "n_shingles", "node").join(answer, "node", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )
