"""Repeated strings across documents: suffix sorting by bucket-pointer refinement.

A byte goes when it lies in a string of ``length`` bytes that also starts in a
document with a smaller doc_id. Two steps find these strings exactly:

1. Where to look. Every string of ``length`` bytes picks the q-gram within it
   that has the smallest hash, the leftmost of equals. The choice depends on the
   string alone, so equal strings pick equal q-grams, and about one place in
   seventeen is picked. Picked q-grams of all documents meet in buckets by hash;
   those that only one document has are dropped. This is a filter: it loses no
   repeat and decides none.
2. What repeats. Around the q-grams that are left, the bytes of the strings that
   picked them (their context) meet in buckets again. Equal contexts are one. All
   suffixes of the contexts in a bucket are put into initial buckets by their
   first eight bytes and each bucket is refined by sorting on the bucket pointers
   of later offsets; the updated pointers serve the next refinement, so the
   sorted depth doubles up to ``length``. Suffixes that then share a bucket start
   with the same string; the smallest doc_id of each bucket judges the others.

Scale: picked q-grams and contexts move as packed arrays in a number of buckets
that follows the total text size. Equal texts and equal contexts within a task
are sent once. Texts are shuffled once, by doc_id; the same exchange serves both
joins. Nothing is gathered by document group and nothing goes to the driver but
one sum.

Defined results: strings never cross documents; a null or empty text has no
bytes; a document with a null doc_id is neither judged nor a source; rows that
repeat a doc_id are judged each on its own text and never judge each other;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.buckets import bucket_count, packed, split_key, unpacked
from oreflow.llm.shared import checkpointed, typed
from oreflow.llm.textbytes import Slice, give_back, given_back, mix, powers, prefix_hash, ranges, slices, span_hash

LENGTH = 50
GRAM = 18
BUCKET_BYTES = 4 << 20
_FLUSH = 1 << 20
_SLICE = 1 << 19  # bytes of text judged at once: each takes some hundred bytes of numbers
_LOW = np.uint64(0xFFFFFFFF)
_COMPRESSOR, _DECOMPRESSOR = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def picked_grams(part: Slice, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of picked q-grams, the first and last string start that picked each, and the text each stands in."""
    n = len(part.data)
    starts = ranges(part.offsets[:-1], np.maximum(np.diff(part.offsets) - length + 1, 0))
    if not len(starts):
        empty = np.empty(0, np.int64)
        return empty.astype(np.uint64), empty, empty, empty
    prefix = prefix_hash(part.data)
    hashes = mix((prefix[gram:] - prefix[:-gram]) * powers(n + 1)[1][: n + 1 - gram])
    value = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
    reach, window = 1, length - gram + 1
    while reach < window:
        shift = min(reach, window - reach)
        value = np.minimum(value[:-shift], value[shift:])
        reach += shift
    place = (value[starts] & _LOW).astype(np.int64)
    change = np.flatnonzero(np.diff(place) != 0) + 1
    first = np.concatenate([[0], change])
    last = np.concatenate([change, [len(place)]]) - 1
    keys = mix(hashes[place[first]] + np.uint64(0x2545F4914F6CDD1D))
    return keys, starts[first], starts[last], np.searchsorted(part.offsets, starts[first], "right") - 1


def _one_of_each(part: Slice, ids: np.ndarray) -> np.ndarray:
    """Of equal texts in a slice, the one with the smallest id (the others are copies, see ``_copies``)."""
    hashes = text_hash(part)
    order = np.lexsort((ids, hashes))
    first = np.ones(len(order), bool)
    first[1:] = hashes[order[1:]] != hashes[order[:-1]]
    keep = np.zeros(len(order), bool)
    keep[order[first]] = True
    return keep


def text_hash(part: Slice) -> np.ndarray:
    return span_hash(prefix_hash(part.data), part.offsets[:-1], part.offsets[1:])


def _ids(part: Slice) -> np.ndarray:
    return part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)


def _gram_rows(batches: Iterable[pa.RecordBatch], buckets: int, length: int, gram: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for part in slices(batches, limit=_SLICE):
        ids = _ids(part)
        keys, _, _, owner = picked_grams(part, length, gram)
        kept = _one_of_each(part, ids)[owner]
        keys, owner = keys[kept], owner[kept]
        order = np.lexsort((keys, owner))
        keys, owner = keys[order], owner[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        held.append((keys[new], ids[owner[new]]))
        size += len(held[-1][0])
        if size > _FLUSH:
            yield from _packed_grams(held, buckets)
            held, size = [], 0
    yield from _packed_grams(held, buckets)
    held.clear()
    give_back()


def _packed_grams(held: list[tuple[np.ndarray, np.ndarray]], buckets: int) -> Iterator[pa.RecordBatch]:
    if held:
        keys, docs = (np.concatenate(x) for x in zip(*held))
        bucket, rest = split_key(keys, buckets)
        yield from packed(bucket, {"rest": rest, "doc": docs})


def _shared_grams(key: tuple, group: pa.Table) -> pa.Table:
    """The keys of a bucket that stand in two documents at least, by document."""
    rest, docs = unpacked(group, "rest", np.uint32), unpacked(group, "doc", np.int64)
    order = np.argsort(rest, kind="stable")
    rest, docs = rest[order], docs[order]
    first = np.concatenate([[0], np.flatnonzero(rest[1:] != rest[:-1]) + 1])
    several = np.minimum.reduceat(docs, first) != np.maximum.reduceat(docs, first)
    kept = np.repeat(several, np.diff(np.append(first, len(rest))))
    rest, docs = rest[kept], docs[kept]
    order = np.argsort(docs, kind="stable")
    rest, docs = rest[order], docs[order]
    edges = np.concatenate([[0], np.flatnonzero(docs[1:] != docs[:-1]) + 1, [len(docs)]]) if len(docs) else np.array([0])
    composite = (np.int64(key[0].as_py()) << np.int64(32)) | rest.astype(np.int64)
    return pa.table({
        "doc_id": pa.array(docs[edges[:-1]]),
        "keys": pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(composite)),
    })


def _flat(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row of each."""
    values = values.fill_null([]) if values.null_count else values
    sizes = values.value_lengths().to_numpy(zero_copy_only=False)
    return values.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(values)), sizes)


def _context_rows(batches: Iterable[pa.RecordBatch], buckets: int, length: int, gram: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for part in slices(batches, limit=_SLICE):
        ids, copy = _ids(part), _is_copy(part)
        keys, first, last, owner = picked_grams(part, length, gram)
        wanted, row = _flat(part.column("keys"))
        bucket, rest = split_key(keys, buckets)
        ours = mix((((bucket << 32) | rest.astype(np.int64)).view(np.uint64)) ^ mix(owner.astype(np.uint64)))
        asked = np.sort(mix(wanted.astype(np.int64).view(np.uint64) ^ mix(row.astype(np.uint64))))
        if not len(asked) or not len(ours):
            continue
        place = np.minimum(np.searchsorted(asked, ours), len(asked) - 1)
        kept = (asked[place] == ours) & ~copy[owner]
        if not kept.any():  # copies alone have no contexts
            continue
        first, last, owner, bucket = first[kept], last[kept], owner[kept], bucket[kept]
        sizes = last - first + length
        held.append((
            bucket, ids[owner], text_hash(part)[owner].view(np.int64), first - part.offsets[owner], sizes,
            part.data[ranges(first, sizes)],
        ))
        size += len(held[-1][-1])
        if size > _FLUSH * 8:
            yield _packed_contexts(held)
            held, size = [], 0
    if held:
        yield _packed_contexts(held)
    held.clear()
    give_back()


def _packed_contexts(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """One row per bucket: each different context once, and the documents and places of all."""
    bucket, docs, tags, starts, sizes, data = (np.concatenate(x) for x in zip(*held))
    contexts = _binary(sizes, data)
    rows = []
    order = np.argsort(bucket, kind="stable")
    edges = np.concatenate([[0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)]])
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        mine = order[a:b]
        coded = contexts.take(pa.array(mine)).dictionary_encode()
        which = coded.indices.to_numpy().astype(np.int32)
        lengths = pa.compute.binary_length(coded.dictionary).to_numpy().astype(np.int32)
        columns = (docs[mine], tags[mine], starts[mine], which, lengths)
        packed_columns = [x.tobytes() for x in columns] + [b"".join(coded.dictionary.to_pylist())]
        rows.append((int(bucket[mine[0]]), *map(_COMPRESSOR.compress, packed_columns)))
    names = ["bucket", "docs", "tags", "starts", "which", "lengths", "bytes"]
    kinds = [pa.int32(), *[pa.binary()] * 6]
    return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows), kinds)], names)


def _unpacked(group: pa.Table, name: str, kind) -> list[np.ndarray]:
    return [np.frombuffer(_DECOMPRESSOR.decompress(x), kind) for x in group.column(name).to_pylist()]


def _binary(sizes: np.ndarray, data: np.ndarray) -> pa.Array:
    edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))])


def refine_buckets(data: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Bucket pointers of the suffixes at ``starts``: equal for those that agree on ``depth`` bytes (at least 8).

    Every place has a pointer to its bucket: at first by its 8-gram, then refined by
    the pointers of later offsets, which are themselves refined by then. Buckets of
    one suffix are finished and take no further part. ``data`` must hold ``depth``
    bytes from every start.
    """
    padded = np.concatenate([data, np.zeros(depth + 8, np.uint8)])
    grams = np.zeros(len(data), np.uint64)
    for k in range(8):
        grams <<= np.uint64(8)
        grams |= padded[k : k + len(data)]
    order = np.argsort(grams)
    grams = grams[order]
    change = np.ones(len(order), bool)
    change[1:] = grams[1:] != grams[:-1]
    del grams, padded
    first = np.flatnonzero(change)
    sizes = np.diff(np.append(first, len(order)))
    pointer = np.zeros(len(data) + depth, np.int64)
    pointer[order] = np.repeat(first, sizes)
    active = order[np.repeat(sizes > 1, sizes)]
    wanted = np.zeros(len(data), bool)
    wanted[starts] = True
    sorted_depth = 8
    while sorted_depth < depth and len(active):
        offset = min(sorted_depth, depth - sorted_depth)
        sorted_depth += offset
        if sorted_depth == depth:
            active = active[wanted[active]]
        key = pointer[active] * np.int64(len(pointer)) + pointer[active + offset]
        order = np.argsort(key)
        active, key = active[order], key[order]
        near = pointer[active]
        change = np.ones(len(active), bool)
        change[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(change)
        sizes = np.diff(np.append(first, len(active)))
        # a bucket's pointer is its first place in the whole order; its parts follow one another from there
        bucket = np.flatnonzero(np.concatenate([[True], near[1:] != near[:-1]]))[: len(active)]
        inside = first - bucket[np.searchsorted(bucket, first, "right") - 1]
        pointer[active] = np.repeat(near[first] + inside, sizes)
        active = active[np.repeat(sizes > 1, sizes)]
    return pointer[starts]


def _repeat_rows(group: pa.Table, length: int) -> pa.Table:
    """Byte spans of a bucket's contexts whose strings start in a document with a smaller id too."""
    docs, tags, starts = (np.concatenate(_unpacked(group, name, np.int64)) for name in ("docs", "tags", "starts"))
    lengths, which = _unpacked(group, "lengths", np.int32), _unpacked(group, "which", np.int32)
    before = np.cumsum([0, *map(len, lengths)])
    which = np.concatenate([w + b for w, b in zip(which, before.tolist())]).astype(np.int64)
    coded = _binary(np.concatenate(lengths), np.concatenate(_unpacked(group, "bytes", np.uint8))).dictionary_encode()
    which = coded.indices.to_numpy().astype(np.int64)[which]
    sizes = pa.compute.binary_length(coded.dictionary).to_numpy().astype(np.int64)
    data = np.frombuffer(b"".join(coded.dictionary.to_pylist()), np.uint8)

    smallest = np.full(len(sizes), np.iinfo(np.int64).max)
    np.minimum.at(smallest, which, docs)
    windows = sizes - length + 1
    first = np.cumsum(windows) - windows
    places = ranges(np.cumsum(sizes) - sizes, windows)
    pointer = refine_buckets(data, places, length)
    by_pointer = np.full(len(data), np.iinfo(np.int64).max)
    np.minimum.at(by_pointer, pointer, np.repeat(smallest, windows))
    source = by_pointer[pointer]  # the smallest document in which the string of each place starts

    # the strings of every document's contexts, judged against those sources
    place = ranges(first[which], windows[which])
    owner = np.repeat(np.arange(len(which)), windows[which])
    gone = source[place] < docs[owner]
    shift = place - first[which][owner]
    run = np.flatnonzero(gone)
    new = np.ones(len(run), bool)
    new[1:] = (np.diff(run) != 1) | (owner[run[1:]] != owner[run[:-1]])
    end = np.ones(len(run), bool)
    end[:-1] = new[1:]
    head, tail = run[new], run[end]
    return pa.table({
        "doc_id": docs[owner[head]], "tag": tags[owner[head]],
        "first": starts[owner[head]] + shift[head], "last": starts[owner[tail]] + shift[tail] + length,
    })


def _copies(docs: DataFrame) -> DataFrame:
    """(doc_id, copies: the hashes of its texts that a smaller id has too)."""
    hashed = docs.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"))
    least = hashed.groupBy("text_md5").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    more = hashed.join(least.filter("least < most"), "text_md5").filter("doc_id > least")
    return more.groupBy("doc_id").agg(F.collect_set("text_md5").alias("copies"))


def _is_copy(part: Slice) -> np.ndarray:
    out = np.zeros(len(part), bool)
    raw = None
    for i, hashes in enumerate(part.column("copies").to_pylist()):
        if hashes:
            raw = raw or part.data.tobytes()
            out[i] = hashlib.md5(raw[part.offsets[i] : part.offsets[i + 1]]).hexdigest() in hashes
    return out


def _judge(
    batches: Iterable[pa.RecordBatch], length: int, keep: tuple[str, ...], as_text: bool
) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, limit=_SLICE):
        n, raw = len(part), part.data.tobytes()
        copy, tags = _is_copy(part), text_hash(part).view(np.int64).tolist()
        spans = part.column("spans").to_pylist()
        removed, rest = [], []
        for i in range(n):
            text = raw[part.offsets[i] : part.offsets[i + 1]]
            runs: list[tuple[int, int]] = []
            if copy[i]:
                runs = [(0, len(text))] if len(text) >= length else []
            elif spans[i]:
                for a, b in sorted((x["first"], x["last"]) for x in spans[i] if x["tag"] == tags[i]):
                    if runs and a <= runs[-1][1]:
                        runs[-1] = (runs[-1][0], max(b, runs[-1][1]))
                    else:
                        runs.append((a, b))
            kept, place = [], 0
            for a, b in runs:
                kept.append(text[place:a])
                place = b
            removed.append(runs)
            kept.append(text[place:])
            # piece by piece: halves of two characters must not make a third
            rest.append("".join([x.decode("utf-8", "ignore") for x in kept]) if as_text else b"".join(kept))
        sizes = np.diff(part.offsets)
        columns = [(name, part.column(name)) for name in keep]
        columns += [
            ("n_bytes", pa.array(sizes.astype(np.int64))),
            ("removed_starts", pa.array([[a for a, _ in x] for x in removed], pa.list_(pa.int64()))),
            ("removed_ends", pa.array([[b for _, b in x] for x in removed], pa.list_(pa.int64()))),
            ("kept", pa.array(rest, pa.string() if as_text else pa.binary())),
        ]
        yield pa.RecordBatch.from_arrays([values for _, values in columns], [name for name, _ in columns])


def remove_repeats(
    documents: DataFrame, keys: tuple[str, ...] = ("doc_id",), length: int = LENGTH, gram: int = GRAM,
    bucket_bytes: int = BUCKET_BYTES, as_text: bool = False,
) -> DataFrame:
    """``keys`` of every document, ``n_bytes``, the removed spans (end excluded) and the ``kept`` bytes.

    With ``as_text`` what is kept is text: the rest of a character that was cut in two goes as well.
    """
    if not 8 <= gram <= length:
        raise ValueError("8 <= gram <= length")
    others = [k for k in keys if k not in ("doc_id", "text")]
    every = documents.select(typed(documents, "doc_id", "bigint"), typed(documents, "text", "string"), *others)
    kinds = dict(every.dtypes)
    named, nameless = every.filter("doc_id IS NOT NULL"), every.filter("doc_id IS NULL")
    texts = named.select("doc_id", "text")
    buckets = bucket_count(texts, bucket_bytes)

    grams = texts.mapInArrow(lambda b: _gram_rows(b, buckets, length, gram), "bucket int, rest binary, doc binary")
    asked = grams.groupBy("bucket").applyInArrow(_shared_grams, "doc_id long, keys array<long>")
    asked = asked.groupBy("doc_id").agg(F.flatten(F.collect_list("keys")).alias("keys"))
    copies = checkpointed(_copies(texts))

    wanted = texts.join(asked.join(copies, "doc_id", "left"), "doc_id")
    contexts = wanted.mapInArrow(
        lambda b: _context_rows(b, buckets, length, gram),
        "bucket int, docs binary, tags binary, starts binary, which binary, lengths binary, bytes binary",
    )
    spans = contexts.groupBy("bucket").applyInArrow(
        lambda group: given_back(_repeat_rows(group, length)), "doc_id long, tag long, first long, last long"
    )
    spans = spans.groupBy("doc_id").agg(F.collect_list(F.struct("tag", "first", "last")).alias("spans"))
    found = spans.join(copies, "doc_id", "full")

    empty = [
        F.lit(None).cast("array<struct<tag:bigint,first:bigint,last:bigint>>").alias("spans"),
        F.lit(None).cast("array<string>").alias("copies"),
    ]
    judged = named.join(found, "doc_id", "left").unionByName(nameless.select("*", *empty))
    schema = "".join(f"`{k}` {kinds[k]}, " for k in keys)
    return judged.mapInArrow(
        lambda b: _judge(b, length, keys, as_text),
        schema + f"n_bytes long, removed_starts array<long>, removed_ends array<long>, kept {'string' if as_text else 'binary'}",
    )
