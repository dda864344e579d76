import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from oreflow.llm.buckets import split_key
from oreflow.llm.ngram_join import Similarity, _signature_rows
from oreflow.llm.suffix_dedup import _context_rows, _gram_rows, _judge, picked_grams, refine_buckets, remove_repeats
from oreflow.llm.textbytes import slices


def brute(rows, length):
    least = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            if doc_id is not None:
                least[data[i : i + length]] = min(doc_id, least.get(data[i : i + length], doc_id))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            if doc_id is not None and least[data[i : i + length]] < doc_id:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def digests(df):
    return sorted((
        (r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["removed_starts"]),
         hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in df.collect()
    ), key=str)


def sample_rows():
    rng = np.random.default_rng(5)
    words = ["the", "ouh", "ñez", "éau", "and", "tion", "er", "😀", "ist"]
    def text(n):
        return " ".join("".join(rng.choice(words, 3)) for _ in range(n))
    passages = [text(12) for _ in range(4)]
    rows = []
    for i in range(120):
        parts = [text(int(rng.integers(0, 40)))]
        for _ in range(int(rng.integers(0, 3))):
            p = passages[int(rng.integers(4))]
            cut = int(rng.integers(0, len(p) // 2))
            parts += [p[cut:], text(int(rng.integers(0, 15)))]
        rows.append((int(rng.permutation(1000)[0]) * 1000 + i, " ".join(parts)))
    rows += [(5000001, rows[3][1]), (7, rows[3][1]), (5000002, rows[9][1]), (5000003, rows[3][1])]
    rows += [(900, "a" * 300), (901, "a" * 70 + "b" + "a" * 49), (902, "ab" * 100), (903, "ba" * 60)]
    rows += [(904, ""), (905, None), (None, rows[3][1]), (None, None), (906, "x" * 49), (907, "x" * 49), (908, "y" * 50), (909, "y" * 50)]
    rows += [(910, rows[5][1]), (910, rows[6][1]), (910, rows[6][1]), (911, rows[5][1][10:90])]
    return rows


def test_matches_brute_force(spark):
    rows = sample_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = digests(remove_repeats(docs, bucket_bytes=1000))
    assert got == brute(rows, 50)


def test_other_lengths(spark):
    rows = sample_rows()[:60]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert digests(remove_repeats(docs, length=20, gram=8)) == brute(rows, 20)
    assert digests(remove_repeats(docs, length=9, gram=9)) == brute(rows, 9)


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(empty).count() == 0
    odd = spark.createDataFrame([(1, "q" * 60, "k", 2), (2, "q" * 60, "k", 3)], "doc_id long, text string, kept string, bucket int")
    assert digests(remove_repeats(odd)) == brute([(1, "q" * 60), (2, "q" * 60)], 50)


@pytest.mark.parametrize("depth", [8, 9, 16, 31, 50])
def test_buckets_are_the_equal_prefixes(depth):
    rng = np.random.default_rng(depth)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    data[2000:2600] = data[100:700]
    starts = np.flatnonzero(rng.random(len(data) - depth) < 0.5)
    pointer = refine_buckets(data, starts, depth)
    raw = data.tobytes()
    strings = [raw[i : i + depth] for i in starts]
    by_pointer, by_string = {}, {}
    for p, s in zip(pointer.tolist(), strings):
        assert by_pointer.setdefault(p, s) == s and by_string.setdefault(s, p) == p


def test_tasks_that_have_copies_alone(spark):
    names = ["spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions"]
    before = [spark.conf.get(name) for name in names]
    text = "a passage of more than fifty bytes that stands in several documents"
    rows = [(i, text) for i in range(20)] + [(90, "x" + text)]
    try:
        for name, value in zip(names, ("false", "16")):
            spark.conf.set(name, value)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(21)
        assert digests(remove_repeats(docs)) == brute(rows, 50)
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)


def test_a_task_holds_little_beside_its_texts():
    rng = np.random.default_rng(2)
    texts = ["".join(map(chr, rng.integers(97, 123, 4000))) for _ in range(2000)]  # 8 MB
    bucket, rest = split_key(picked_grams(next(slices([pa.RecordBatch.from_pydict({"text": texts})], limit=1 << 40)))[0], 64)
    keys = ((bucket << 32) | rest.astype(np.int64))[::9]
    batch = pa.RecordBatch.from_pydict({
        "doc_id": pa.array(range(2000), pa.int64()), "text": texts, "keys": pa.array([keys[i::2000] for i in range(2000)], pa.list_(pa.int64())),
        "copies": pa.array([None] * 2000, pa.list_(pa.string())),
        "spans": pa.array([None] * 2000, pa.list_(pa.struct({"tag": pa.int64(), "first": pa.int64(), "last": pa.int64()}))),
    })
    for work in (
        lambda: _gram_rows([batch], 64, 50, 18), lambda: _context_rows([batch], 64, 50, 18),
        lambda: _judge([batch], 50, ("doc_id",), True), lambda: _signature_rows([batch], 64, Similarity(5, 80, 100)),
    ):
        tracemalloc.start()
        for _ in work():
            pass
        kept, peak = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert peak < 110 << 20 and kept < 16 << 20, (peak >> 20, kept >> 20)
