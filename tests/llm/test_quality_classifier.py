import re

import numpy as np
import pyarrow as pa
import pytest

from oreflow.llm.quality import Model, features, score_quality, train, train_on
from oreflow.llm.textbytes import mix, prefix_hash, slices, span_hash


def rows():
    rng = np.random.default_rng(1)
    words = ["the", "ouh", "and", "tion", "erst", "hea", "nd"]
    docs, labels = [], []
    for i in range(400):
        text = [ "".join(rng.choice(words, 2)) for _ in range(int(rng.integers(5, 80)))]
        bad = i % 4 == 0
        if bad:
            text = [w.upper() + "!!" for w in text] if i % 8 else [text[0]] * 40
        docs.append((i, " ".join(text)))
        labels.append((i, int(not bad), 0))
    return docs, labels


DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    docs, labels = rows()
    odd = [(1000, None), (1001, ""), (None, "the"), (1002, "x"), (1003, "the ouh " * 30000)]
    table = spark.createDataFrame(docs + odd, DOCS)
    model = train_on(table, spark.createDataFrame(labels + [(None, 1, 0), (5, None, 0), (6, 7, 1), (9999, 0, 0)], LABELS))
    found = score_quality(table, model).collect()
    assert len(found) == len(docs) + len(odd)
    truth = {d: q for d, q, _ in labels}
    judged = [(r["predicted"], truth[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in truth]
    assert len(judged) > 50 and np.mean([p == t for p, t in judged]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    again = {(r["doc_id"], r["score"]) for r in score_quality(table, model).collect()}
    assert again == {(r["doc_id"], r["score"]) for r in found}


def test_learns_nothing_from_nothing(spark):
    empty, none = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    model = train_on(empty, none)
    assert score_quality(empty, model).count() == 0
    assert {r["score"] for r in score_quality(spark.createDataFrame([(1, "a"), (1, None)], DOCS), model).collect()} == {0.5}
    one = train([(1, np.array([3]), np.array([1.0]))] * 8)
    assert one.bias > 1 and not one.weights.any()


@pytest.mark.parametrize("texts", [["", "abc", "a b a b", "b b"], ["", ""], ["éé x"], ["ab", "cd", "", "efgh"]])
def test_features_stay_within_their_text(texts):
    def of(group):
        batch = pa.RecordBatch.from_arrays([pa.array(group, pa.string())], ["text"])
        part = next(slices([batch]))
        out = [[] for _ in group]
        for index, edges in features(part):
            for i in range(len(group)):
                out[i] += index[edges[i] : edges[i + 1]].tolist()
        return [sorted(x) for x in out]
    assert of(texts) == [of([t])[0] for t in texts]


def string_hash(data: bytes) -> np.uint64:
    array = np.frombuffer(data, np.uint8)
    return span_hash(prefix_hash(array), np.array([0]), np.array([len(data)]))[0]


def plain_score(text, model):
    """String by string: the mean of the weights of a text's words, pairs of words and byte strings."""
    data, size = (text or "").encode(), np.uint64(len(model.weights))
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", data) if w]
    hashes = [string_hash(w) for w in words]
    found = [h ^ np.uint64(1) for h in hashes]
    with np.errstate(over="ignore"):
        for a, b in zip(hashes, hashes[1:]):
            found.append(np.uint64(7) if a == b else mix(np.array([a * np.uint64(0x9E3779B97F4A7C15) + b]))[0])
    found += [string_hash(data[i : i + n]) for n in (3, 4) for i in range(len(data) - n + 1)]
    total = sum(float(model.weights[int(h % size)]) for h in found)
    return 1 / (1 + np.exp(-(total / max(len(found), 1) + model.bias)))


def test_scores_like_the_plain_version(spark):
    model = Model(np.random.default_rng(4).standard_normal(1 << 12).astype(np.float32), -0.3)
    texts = [None, "", " \n", "a", "ab", "abc", "a a a b", "the ouh\tñez  the the", "😀😀 x", "w" * 500, "the nd " * 200]
    rows_ = list(enumerate(texts)) + [(3, "another text of id 3"), (3, "a"), (None, "nobody's")]
    docs = spark.createDataFrame([(i, t, 0.5, True, "l") for i, t in rows_], DOCS + ", score double, held_out boolean, quality string").repartition(3)
    found = score_quality(docs, model)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    got = sorted(((r["doc_id"], round(r["score"], 9)) for r in found.collect()), key=str)
    assert got == sorted(((i, round(plain_score(t, model), 9)) for i, t in rows_), key=str)


def test_other_columns_and_repeated_ids_in_training(spark):
    docs, labels = rows()
    plain = train_on(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    odd = spark.createDataFrame([(i, t, i, "x", 7) for i, t in docs], DOCS + ", place int, label string, bytes int")
    marked = spark.createDataFrame([(*row, "text") for row in labels] + [(*labels[1], "twice")], LABELS + ", text string")
    same = train_on(odd, marked)
    assert np.array_equal(plain.weights, same.weights) and plain.bias == same.bias
    twice = train_on(spark.createDataFrame(docs + [(1, "another text of a labelled id")], DOCS), spark.createDataFrame(labels, LABELS))
    assert not np.array_equal(plain.weights, twice.weights)
