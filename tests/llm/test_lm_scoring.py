from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from oreflow.llm import lm_scoring
from oreflow.llm.decontamination import item_words
from oreflow.llm.lm_scoring import GROUP, Network, count_vocabulary, score_documents, train_network
from oreflow.llm.textbytes import prefix_hash, span_hash


def class_of(word, vocabulary):
    data = np.frombuffer(word, np.uint8)
    return int(vocabulary.of(span_hash(prefix_hash(data), np.array([0]), np.array([len(data)])))[0])


def grammar(n, seed):
    """Texts in which both neighbours tell the word between them."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        words = []
        for _ in range(int(rng.integers(5, 30))):
            i = int(rng.integers(6))
            words += [f"a{i}", f"m{i}", f"b{i}"]
        out.append(" ".join(words))
    return out


def rows():
    good = grammar(600, 1)
    rng = np.random.default_rng(3)
    shuffled = [" ".join(rng.permutation(t.split())) for t in grammar(40, 2)]
    return list(enumerate(good)), [(10_000 + i, t) for i, t in enumerate(shuffled)]


def test_gradients_and_probabilities():
    """Both softmax steps together are a distribution, and steps on one batch raise its likelihood."""
    network = Network(4 * GROUP)
    context = np.tile(np.array([[1], [2], [3], [4]]), (1, 4 * GROUP))
    chances = np.exp(network.log_probabilities(context, np.arange(4 * GROUP)))
    assert abs(chances.sum() - 1) < 1e-4
    rng = np.random.default_rng(0)
    context, target = rng.integers(0, 4 * GROUP + 1, (4, 256)), rng.integers(0, 4 * GROUP, 256)
    before = network.log_probabilities(context, target).sum()
    for _ in range(20):
        network.train(context, target)
    assert network.log_probabilities(context, target).sum() > before + 50


def test_score_is_the_sum_over_masked_words(spark):
    own = {"frequent": 12, "rare": 36}  # few, so that words share the hash classes
    good, bad = rows()
    odd = [(None, "a1 m1 b1"), (20_000, ""), (20_001, None), (20_002, "Zebra"), (20_003, "a1 m1 b1 " * 5000), (0, "a1")]
    docs = spark.createDataFrame(good + bad + odd, "doc_id long, text string").repartition(3)
    vocabulary = count_vocabulary(docs, **own)
    network = train_network(docs, vocabulary)
    found = {}
    for r in score_documents(docs, **own).collect():
        found.setdefault(r["doc_id"], []).append((r["n_words"], r["pseudo_log_likelihood"], r["score"]))
    assert found[20_000] == found[20_001] == [(0, 0.0, None)] and len(found[0]) == 2
    mean = lambda ids: np.mean([found[i][0][2] for i in ids])
    assert mean(range(1, 600)) > mean(range(10_000, 10_040)) + 1

    counts = Counter(w for _, text in good + bad + odd for w in item_words(text))
    classes = {w: class_of(w, vocabulary) for w in counts}

    def brute(text):
        words = item_words(text)
        ids = [classes[w] for w in words]
        total, blank = 0.0, vocabulary.size
        for w in words:
            if classes[w] >= vocabulary.frequent:
                mates = [m for m in counts if classes[m] == classes[w]]
                total += np.log((counts[w] + 1) / (sum(counts[m] for m in mates) + len(mates) + 1))
        for i, word in enumerate(ids):
            near = [ids[j] if 0 <= j < len(ids) else blank for j in (i - 2, i - 1, i + 1, i + 2)]
            p = network.parts
            hidden = np.tanh(p["hidden"] + sum(p["inputs"][k][near[k]] for k in range(4)))
            g = p["groups_w"] @ hidden + p["groups_b"]
            w = p["words_w"][word // GROUP] @ hidden + p["words_b"][word // GROUP]
            total += g[word // GROUP] - np.log(np.exp(g).sum()) + w[word % GROUP] - np.log(np.exp(w).sum())
        return total

    for doc_id, text in good[1:8] + bad[:5] + [(20_002, "Zebra")]:
        assert abs(found[doc_id][0][1] - brute(text)) < 1e-3 * max(1, abs(found[doc_id][0][1]))


def test_words_are_counted_over_all_texts(spark):
    docs = spark.createDataFrame([(1, "x y x"), (2, "X z"), (3, None)], "doc_id long, text string")
    vocabulary = count_vocabulary(docs, bucket_bytes=1)
    assert len(vocabulary.hashes) == 3 and sorted(vocabulary.ids.tolist()) == [0, 1, 2]


def test_empty_table_and_other_columns(spark):
    assert score_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    odd = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id long, text string, score int, bucket string")
    assert [r["n_words"] for r in score_documents(odd).collect()] == [2]
    assert lm_scoring.FREQUENT + lm_scoring.RARE == Network((lm_scoring.FREQUENT + lm_scoring.RARE)).size


def test_every_word_is_a_target_once(monkeypatch):
    texts = ["one", "a b", "a b c", "a b c d", "", None, " ".join(f"w{i}" for i in range(1500))]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    vocabulary = lm_scoring.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), lm_scoring.RARE)
    targets = []
    monkeypatch.setattr(Network, "train", lambda self, context, target: targets.extend(target.tolist()))
    monkeypatch.setattr(lm_scoring, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    (pieces,) = lm_scoring._train([batch], vocabulary, Network(vocabulary.size).weights)
    words = np.concatenate([vocabulary.of(lm_scoring._words(part)[0]) for part in lm_scoring.slices([batch])])
    assert sorted(targets) == sorted(words.tolist()) and len(targets) == 1510
    assert set(pieces.column("seen").to_pylist()) == {1510}


def test_words_of_one_class_score_apart(spark):
    """A word seen often scores higher than one seen once that shares its hash class."""
    vocabulary = lm_scoring.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), 47, 1)
    names, mates = [f"word{i}" for i in range(300)], {}
    for name in names:
        mates.setdefault(class_of(name.encode(), vocabulary), []).append(name)
    often, once = next(x for x in mates.values() if len(x) > 1)[:2]
    rows_ = [(i, f"the the {often}") for i in range(50)] + [(100, f"the the {once}"), (101, "the the"), (102, "the the the")]
    found = {r["doc_id"]: r["pseudo_log_likelihood"] for r in score_documents(spark.createDataFrame(rows_, "doc_id long, text string"), frequent=1, rare=47).collect()}
    assert abs(found[0] - found[100] - np.log(51 / 2)) < 1e-6


def test_scoring_cuts_a_slice_into_words_once(monkeypatch):
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2], pa.int64()), "text": ["a b a", "b c"]})
    vocabulary, calls, cut = lm_scoring.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64)), [], lm_scoring._words
    monkeypatch.setattr(lm_scoring, "_words", lambda part: calls.append(1) or cut(part))
    (found,) = lm_scoring._score([batch], vocabulary, Network(vocabulary.size).weights, 3)
    assert found.column("n_words")[0].as_py() == [3, 2] and len(calls) == 1


def test_chances_do_not_depend_on_the_order_of_places():
    network, rng = Network(4 * GROUP), np.random.default_rng(5)
    context, target = rng.integers(0, 4 * GROUP + 1, (4, 500)), rng.integers(0, 4 * GROUP, 500)
    found, mixed = network.log_probabilities(context, target), rng.permutation(500)
    assert np.allclose(network.log_probabilities(context[:, mixed], target[mixed]), found[mixed], atol=1e-5)
