import random

import pytest

from oreflow.llm.decontamination import SuffixAutomaton, benchmark_hits, item_words, judged


def brute(docs, items, window=13):
    windows = {}
    for name, text in items:
        words = item_words(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1) if words else ():
            windows.setdefault(tuple(words[i : i + size]), set()).update({str(name)} if name is not None else set())
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        words = item_words(text)
        hit, names = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                found = windows.get(tuple(words[i : i + size]))
                if found is not None:
                    hit.update(range(i, i + size))
                    names |= found
        out.append((doc_id, len(words), len(hit), tuple(sorted(names)), len(hit) > 0 and 20 * len(hit) >= len(words)))
    return sorted(out, key=str)


def sample():
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(25)] + ["é", "THE"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 5, 12, 13, 14, 20, 40])))) for i in range(30)]
    items += [(30, items[9][1] + " tail"), (31, items[9][1]), (9, items[10][1]), (None, "nameless one here"), (32, ""), (33, None), (34, "...")]
    docs = []
    for i in range(150):
        words = rng.choices(vocabulary, k=rng.randint(0, 120))
        for _ in range(rng.randint(0, 2)):
            chosen = (items[rng.randrange(32)][1] or "").split()
            cut = rng.randint(0, max(0, len(chosen) - 10))
            words[rng.randint(0, len(words)) : 0] = chosen[cut:]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(words).upper()))
    return docs + [(200, None), (201, ""), (None, items[8][1]), (3, items[8][1]), (202, "Nameless ONE-here"), (203, "x " * 5000 + items[29][1])], items


@pytest.mark.parametrize("shard", [1_000_000, 60])
def test_matches_brute_force(spark, shard):
    docs, items = sample()
    documents = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = judged(benchmark_hits(documents, benchmark, shard_words=shard)).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"]), r["contaminated"]) for r in found), key=str)
    assert got == brute(docs, items)


def test_automaton_finds_the_longest_matches():
    items = [("a", [b"x", b"y", b"x", b"z"]), ("b", [b"y", b"x", b"y"])]
    automaton = SuffixAutomaton(items, 3)
    word = automaton.ids
    hits, found = automaton.scan([word[b"x"], word[b"y"], word[b"x"], word[b"y"], -1, word[b"y"], word[b"x"], word[b"z"]])
    assert hits == [(0, 4), (5, 8)] and found == {"a", "b"}


def test_empty_tables_and_other_columns(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert benchmark_hits(none, items).count() == 0
    odd = spark.createDataFrame([(1, "a b", [1], "x")], "doc_id long, text string, hit_starts array<int>, n_words string")
    row = benchmark_hits(odd, items, keys=("doc_id", "text")).collect()[0]
    assert (row["n_words"], row["hit_starts"], row["text"]) == (2, [], "a b")
