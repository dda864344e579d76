import hashlib
import random
import re

import numpy as np
import pytest

from oreflow.llm.periodic_runs import SuffixTree, find_runs, periodic_regions, planted_order, run_digests, runs_of
from oreflow.llm.textbytes import mix

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def brute(words, least_words=6, least_times=4):
    """Maximal stretches that agree with themselves q words later, for every q; the smallest q of each."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least_words, least_times * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((start, length, q) for (start, length), q in found.items())


def sequences(count, seed):
    rng = random.Random(seed)
    for _ in range(count):
        kinds, n = rng.choice([1, 2, 3, 6]), rng.randint(0, 70)
        words = [rng.randint(1, kinds) for _ in range(n)]
        if n > 10 and rng.random() < 0.6:
            period, a = rng.randint(1, 6), rng.randint(0, n // 2)
            words[a:] = [words[a + i % period] for i in range(n - a)]
        yield words


@pytest.mark.parametrize("limits", [(6, 4), (2, 2), (9, 3)])
def test_all_runs(limits):
    for words in sequences(400, sum(limits)):
        assert runs_of(words, *limits) == brute(words, *limits)


def test_regions_hold_every_run():
    for words in sequences(600, 4):
        low, high = periodic_regions(mix(np.array(words, np.uint64)), np.array([0, len(words)]))
        found = sorted((a + s, n, q) for a, b in zip(low.tolist(), high.tolist()) for s, n, q in runs_of(words[a:b]))
        assert found == brute(words)


def test_common_prefixes():
    for words in sequences(60, 9):
        tree = SuffixTree(words)
        n = len(words)
        pairs = [(i, j) for i in range(n) for j in range(n + 1) if i != j]
        if not pairs:
            continue
        got = tree.agreement(*(np.array(x) for x in zip(*pairs)))
        for (i, j), size in zip(pairs, got.tolist()):
            want = 0
            while max(i, j) + want < n and words[i + want] == words[j + want]:
                want += 1
            assert size == want
        assert [words[i:] for i in tree.sorted] == sorted(words[i:] for i in range(n + 1))
        assert tree.sorted_reversed() == sorted(range(n + 1), key=lambda i: [-x for x in words[i:]])


def expected(doc_id, text):
    words = [w for w in SPACE.split(text or "") if w]
    order = planted_order(doc_id, len(words))
    if order is not None:
        words = [words[i] for i in order]
    runs = brute(words)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *shown, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


def test_texts(spark):
    rng = random.Random(3)
    vocabulary = ["a", "b", "ñé", "the", "😀", "x" * 40, "a\x00b", "\xa0"]
    rows = [(i, rng.choice([" ", "  ", "\n", "\t "]).join(rng.choice(vocabulary) for _ in range(rng.randint(0, 90)))) for i in range(150)]
    line = "every line of this notice stands here again "
    rows += [(1000, line * 40), (1001, "head " + line * 4), (1002, " ".join(map(str, range(3000)))), (1003, "go " * 30_000)]
    rows += [(1004, None), (1005, ""), (1006, " \t\n"), (1007, "w"), (None, None), (None, line * 5), (1000, line * 40), (1000, "other")]
    rows += [(1008, " ".join(str(i % 2500) for i in range(12_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = run_digests(find_runs(docs, planted_order)).collect()
    small = [r for r in rows if r[0] not in (1002, 1003, 1008)]
    large = {r["doc_id"]: r for r in got if r["doc_id"] in (1002, 1003, 1008)}
    assert sorted((tuple(r) for r in got if r["doc_id"] not in large), key=str) == sorted((expected(*r) for r in small), key=str)
    plain = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in find_runs(docs).collect()}
    assert plain[1003] == [(0, 30_000, 1)] and plain[1008] == [(0, 12_000, 2500)] and plain[1002] == []


def test_empty_table_and_other_columns(spark):
    assert find_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    odd = spark.createDataFrame([(1, "a " * 9, "k", 2)], "doc_id int, text string, runs string, collapsed int")
    row = find_runs(odd).first()
    assert [tuple(x) for x in row["runs"]] == [(0, 9, 1)] and bytes(row["collapsed"]) == b"a"
