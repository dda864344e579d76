"""Quality classifier on supervised subword embeddings.

Features of a text are its words, pairs of neighbouring words (a pair of equal
words is one feature of its own) and its byte 3- and 4-grams, all hashed to
``BUCKETS``. Every feature has a learnt vector; a document is the average of its
features' vectors, and a softmax over two classes judges it. Vectors and softmax
are trained together by stochastic gradient descent in numpy.

Training takes a sample of labelled documents whose size is bounded by
``TRAIN_ROWS`` and ``TRAIN_BYTES``: held-out rows are left out, documents are
taken in the order of a hash of their id, none of more than ``LONGEST_SAMPLE``
bytes. Scoring covers every whole text.

Scale: labels are joined to ids alone; only the sampled rows' features reach the
driver, a bounded amount. For two classes a feature's contribution is one number,
so tasks get one number per bucket. Texts are never shuffled for scoring.

Defined results: a null or empty text has no features and gets the score of the
bias; where labels disagree on a document the lower one counts; labels other than
0 and 1, null labels and null ids are not learnt; if nothing, or one class only,
was learnt, every score is the smoothed share of label 1; rows that repeat a
doc_id are scored each by its own text; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.shared import held_out
from oreflow.llm.textbytes import NONSPACE, Slice, mix, powers, prefix_hash, slices, span_hash, word_spans

BUCKETS = 1 << 17
DIMENSIONS = 16
TRAIN_ROWS = 2000
TRAIN_BYTES = 8 << 20
LONGEST_SAMPLE = 1 << 16
EPOCHS = 10
BATCH = 32
RATE = 4.0
GRAMS = (3, 4)
PREDICTED_FROM = 0.3


def features(part: Slice, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature buckets of all texts, kind by kind, with each text's borders."""
    data, offsets = part.data, part.offsets
    prefix = prefix_hash(data)
    start, end, first = word_spans(data, offsets, NONSPACE)
    words = span_hash(prefix, start, end)
    size = np.uint64(buckets)
    yield ((words ^ np.uint64(1)) % size).astype(np.int64), first
    if len(words) > 1:
        odd = np.uint64(0x9E3779B97F4A7C15)
        pairs = np.where(words[1:] == words[:-1], np.uint64(7), mix(words[:-1] * odd + words[1:]))
        inside = np.ones(len(words), bool)
        inside[np.maximum(first[1:] - 1, 0)[np.diff(first) > 0]] = False  # the last word of a text begins no pair
        kept = np.concatenate([[0], np.cumsum(inside)])
        yield (pairs[inside[:-1]] % size).astype(np.int64), np.minimum(kept[first], int(inside[:-1].sum()))
    for gram in GRAMS:
        if len(data) >= gram:
            hashes = mix((prefix[gram:] - prefix[:-gram]) * powers(len(data) + 1)[1][: len(data) + 1 - gram] + np.uint64(gram))
            inside = np.ones(len(hashes) + gram - 1, bool)
            for k in range(1, gram):  # none crosses a border
                inside[np.maximum(offsets[1:] - k, offsets[:-1])[np.diff(offsets) > 0]] = False
            inside = inside[: len(hashes)]
            kept = np.concatenate([[0], np.cumsum(inside)])
            yield (hashes[inside] % size).astype(np.int64), kept[np.minimum(offsets, len(hashes))]


@dataclass
class Model:
    weights: np.ndarray  # contribution of each bucket to the logit of label 1
    bias: float


def train(samples: list[tuple[int, np.ndarray, np.ndarray]], buckets: int = BUCKETS, seed: int = 0) -> Model:
    """Softmax over averaged feature vectors; samples are (label, buckets, shares)."""
    labels = np.array([label for label, _, _ in samples], np.int64)
    share = (labels.sum() + 1) / (len(labels) + 2)
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(buckets, np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    vectors = (rng.standard_normal((buckets, DIMENSIONS)) / DIMENSIONS).astype(np.float32)
    softmax = (rng.standard_normal((DIMENSIONS, 2)) * 0.1).astype(np.float32)
    bias = np.log(np.array([1 - share, share])).astype(np.float32)
    steps = EPOCHS * -(-len(samples) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(samples))
        for low in range(0, len(order), BATCH):
            batch = [samples[i] for i in order[low : low + BATCH] if len(samples[i][1])]
            rate = RATE * (1 - step / steps)
            step += 1
            if not batch:
                continue
            index = np.concatenate([x[1] for x in batch])
            part = np.concatenate([x[2] for x in batch])[:, None]
            edges = np.cumsum([0, *[len(x[1]) for x in batch[:-1]]])
            documents = np.add.reduceat(vectors[index] * part, edges)
            logits = documents @ softmax + bias
            chance = np.exp(logits - logits.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            chance[np.arange(len(batch)), [x[0] for x in batch]] -= 1
            back = chance @ softmax.T
            owner = np.repeat(np.arange(len(batch)), [len(x[1]) for x in batch])
            np.add.at(vectors, index, -rate * part * back[owner])
            softmax -= rate / len(batch) * (documents.T @ chance)
            bias -= rate / len(batch) * chance.sum(axis=0)
    return Model((vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def _sampled(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        kinds = list(features(part, buckets))
        index, share = [], []
        for i in range(len(part)):
            found, count = np.unique(np.concatenate([b[edge[i] : edge[i + 1]] for b, edge in kinds]), return_counts=True)
            index.append(found.astype(np.int32).tobytes())
            share.append((count / max(count.sum(), 1)).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [part.column("place"), part.column("label"), pa.array(index, pa.binary()), pa.array(share, pa.binary())],
            ["place", "label", "index", "share"],
        )


def train_on(documents: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, buckets: int = BUCKETS) -> Model:
    """A model from ``labels.quality`` of at most ``train_rows`` documents that are not held out."""
    marked = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    marked = marked.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("long").alias("label"))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.filter(F.col("text").isNotNull() & (F.octet_length("text") <= LONGEST_SAMPLE))
    # ids and sizes first: the texts of the chosen rows alone are read in full
    sized = texts.select("doc_id", F.octet_length("text").alias("bytes")).groupBy("doc_id").agg(F.max("bytes").alias("bytes"))
    place = F.xxhash64(F.lit("quality"), "doc_id")
    chosen = marked.join(sized, "doc_id").select("doc_id", "label", "bytes", place.alias("place")).orderBy("place", "doc_id").limit(train_rows)
    rows, total = [], 0
    for row in chosen.collect():
        total += row["bytes"]
        if total > TRAIN_BYTES:
            break
        rows.append((row["doc_id"], row["label"], row["place"]))
    if not rows:
        return train([], buckets)
    picked = documents.sparkSession.createDataFrame(rows, "doc_id long, label long, place long")
    sample = texts.join(F.broadcast(picked), "doc_id").select("place", "label", "text")
    sample = sample.mapInArrow(lambda b: _sampled(b, buckets), "place long, label long, index binary, share binary")
    found = sorted(sample.collect(), key=lambda r: (r["place"], r["label"], bytes(r["index"]), bytes(r["share"])))
    return train([(r["label"], np.frombuffer(r["index"], np.int32), np.frombuffer(r["share"], np.float32)) for r in found[:train_rows]], buckets)


def _score(batches: Iterable[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        total, count = np.zeros(len(part)), np.zeros(len(part))
        for index, edges in features(part, len(model.weights)):
            sums = np.concatenate([[0.0], np.cumsum(model.weights[index], dtype=np.float64)])
            total += sums[edges[1:]] - sums[edges[:-1]]
            count += np.diff(edges)
        score = 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + model.bias, -500, 500)))
        kept = [(name, part.column(name)) for name in part.batch.schema.names if name != "text"]
        kept.append(("score", pa.array(score)))
        yield pa.RecordBatch.from_arrays([values for _, values in kept], [name for name, _ in kept])


def score_quality(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted of every document."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(lambda b: _score(b, shared.value), "doc_id long, score double")
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= PREDICTED_FROM).cast("int").alias("predicted")
    )
