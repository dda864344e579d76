"""Document scores from a masked language model: pseudo-likelihood of a bidirectional window network.

Words are classes: the ``FREQUENT`` most frequent words of the corpus have their
own, all others share ``RARE`` hash classes. A network sees the ``REACH`` words on
either side of a masked place, each through a vector of its own for word and
distance, adds them up, takes tanh and predicts the masked word in two softmax
steps, group and word within the group. A document's score is the sum over all
its words of the log-probability of the word given both sides: that of its class,
and for a word of a hash class its share of the class, log of (count + 1) over (count
of the class + its different words + 1). A word that was never counted has count 0.

Training masks every word of all documents once: every ``MASK_EVERY``-th, then those
next to them, until all were masked. It goes in ``ROUNDS`` rounds that each take
their own share of the documents. Every task trains on its
documents by stochastic gradient steps in numpy (per-weight step sizes), starting
from the round's common weights; the tasks' weights are then averaged, weighted
by what they have seen, and start the next round.

Scale: words are counted over all texts in packed buckets by hash, and all texts
are trained on, so both follow the input. The counts of all words stay in a table;
scoring asks it slice by slice: a slice of texts sends its different rare words to
their buckets, meets the answers in one group, and texts are not shuffled. Weights
are averaged in two levels, so a task of the average holds the share of a limited
number of tasks. The driver gets the frequent words, the classes' counts and one set
of weights, all of fixed size. Steps grow from ``FIRST_BATCH`` words to ``BATCH`` with what
a task has seen.

Defined results: words are runs of letters, digits and characters beyond ASCII,
A-Z lower-cased; a null or empty text has no words, sum 0 and a null mean; rows
that repeat a doc_id are scored each by its own text; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.buckets import bucket_count, packed, unpacked
from oreflow.llm.shared import typed
from oreflow.llm.textbytes import LOWER, WORD, Slice, prefix_hash, ranges, slices, span_hash, word_spans
from oreflow.session import work_dir

FREQUENT = 1792
RARE = 512
GROUP = 48  # words of a softmax group; (FREQUENT + RARE) / GROUP groups
REACH = 2
HIDDEN = 32
ROUNDS = 2
MASK_EVERY = 8
FIRST_BATCH, BATCH = 512, 16384
RATE = 0.3
BUCKET_BYTES = 8 << 20
_FLUSH = 1 << 20
_PIECES = 16
_SPREAD = 64


@dataclass
class Vocabulary:
    hashes: np.ndarray  # of the frequent words, sorted
    ids: np.ndarray  # their ids, by frequency
    rare: int = RARE
    frequent: int = FREQUENT

    @property
    def size(self) -> int:
        return -(-(self.frequent + self.rare) // GROUP) * GROUP

    def of(self, words: np.ndarray) -> np.ndarray:
        out = self.frequent + (words % np.uint64(self.rare)).astype(np.int64)
        if len(self.hashes):
            place = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
            known = self.hashes[place] == words
            out[known] = self.ids[place[known]]
        return out


def _words(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    data = LOWER[part.data]
    start, end, first = word_spans(data, part.offsets, WORD)
    return span_hash(prefix_hash(data), start, end), first


def _counts(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def flush():
        words, counts = np.unique(np.concatenate(held), return_counts=True)
        return packed((words % np.uint64(buckets)).astype(np.int64), {"word": words, "count": counts.astype(np.uint32)})

    for part in slices(batches):
        held.append(_words(part)[0])
        size += len(held[-1])
        if size > _FLUSH:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()


COUNTS_SCHEMA = "bucket int, word binary, count binary"


def _added_counts(group: pa.Table) -> pa.Table:
    """The different words of a bucket, sorted, with their counts."""
    words, place = np.unique(unpacked(group, "word", np.uint64), return_inverse=True)
    counts = np.zeros(len(words), np.int64)
    np.add.at(counts, place, unpacked(group, "count", np.uint32).astype(np.int64))
    return pa.table({
        "bucket": group.column("bucket")[:1], "word": pa.array([words.tobytes()], pa.binary()), "count": pa.array([counts.tobytes()], pa.binary()),
    })


def _buckets_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for word, count in zip(batch.column("word"), batch.column("count")):
            yield np.frombuffer(word.as_buffer(), np.uint64), np.frombuffer(count.as_buffer(), np.int64)


def _most_frequent(batches: Iterable[pa.RecordBatch], number: int) -> Iterator[pa.RecordBatch]:
    for words, counts in _buckets_of(batches):
        top = np.lexsort((words.view(np.int64), -counts))[:number]
        yield pa.RecordBatch.from_arrays([pa.array(words[top].view(np.int64)), pa.array(counts[top])], ["word", "count"])


def _class_counts(batches: Iterable[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    """Occurrences and different words of every hash class in this task's buckets."""
    total, different = np.zeros(vocabulary.rare, np.int64), np.zeros(vocabulary.rare, np.int64)
    for words, counts in _buckets_of(batches):
        own = vocabulary.of(words) - vocabulary.frequent
        np.add.at(total, own[own >= 0], counts[own >= 0])
        different += np.bincount(own[own >= 0], minlength=vocabulary.rare)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(vocabulary.rare, dtype=np.int32)), pa.array(total), pa.array(different)], ["class", "total", "different"]
    )


def count_words(texts: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, int]:
    """The counts of all words, stored in the shared folder by bucket, and the number of buckets."""
    buckets = bucket_count(texts, bucket_bytes)
    counted = texts.select("text").mapInArrow(lambda b: _counts(b, buckets), COUNTS_SCHEMA)
    path = work_dir(texts.sparkSession, "word-counts")
    counted.groupBy("bucket").applyInArrow(_added_counts, COUNTS_SCHEMA).write.parquet(path)
    return texts.sparkSession.read.schema(COUNTS_SCHEMA).parquet(path), buckets


def frequent_words(counts: DataFrame, frequent: int = FREQUENT, rare: int = RARE) -> Vocabulary:
    """The most frequent words, ties by hash."""
    best = counts.mapInArrow(lambda b: _most_frequent(b, frequent), "word long, count long")
    top = best.orderBy(F.desc("count"), "word").limit(frequent).collect()
    hashes = np.array([r["word"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Vocabulary(hashes[order], order.astype(np.int64), rare, frequent)


def class_sizes(counts: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """What a word's count is divided by in each hash class."""
    found = counts.mapInArrow(lambda b: _class_counts(b, vocabulary), "class int, total long, different long")
    sizes = np.ones(vocabulary.rare)
    for row in found.groupBy("class").agg(F.sum(F.col("total") + F.col("different")).alias("n")).collect():
        sizes[row["class"]] += row["n"]
    return sizes


def count_vocabulary(
    texts: DataFrame, bucket_bytes: int = BUCKET_BYTES, frequent: int = FREQUENT, rare: int = RARE
) -> Vocabulary:
    return frequent_words(count_words(texts, bucket_bytes)[0], frequent, rare)


class Network:
    """Weights in one array, so that they can be averaged; the parts are views."""

    def __init__(self, size: int, weights: np.ndarray | None = None):
        self.size, self.groups = size, size // GROUP
        shapes = {
            "inputs": (2 * REACH, size + 1, HIDDEN), "hidden": (HIDDEN,),
            "groups_w": (self.groups, HIDDEN), "groups_b": (self.groups,),
            "words_w": (self.groups, GROUP, HIDDEN), "words_b": (self.groups, GROUP),
        }
        total = sum(int(np.prod(s)) for s in shapes.values())
        if weights is None:
            weights = (np.random.default_rng(7).standard_normal(total) * 0.05).astype(np.float32)
        self.weights = weights.astype(np.float32)
        self.parts, self.past, place = {}, {}, 0
        history = np.full(total, 1e-6, np.float32)  # sums of squared gradients
        for name, shape in shapes.items():
            count = int(np.prod(shape))
            self.parts[name] = self.weights[place : place + count].reshape(shape)
            self.past[name] = history[place : place + count].reshape(shape)
            place += count

    def _hidden(self, context: np.ndarray) -> np.ndarray:
        p = self.parts
        total = p["hidden"] + p["inputs"][0][context[0]]
        for k in range(1, 2 * REACH):
            total += p["inputs"][k][context[k]]
        return np.tanh(total, out=total)

    # logits are held with a row per class, so that steps over classes run along the places

    @staticmethod
    def _softmax(logits: np.ndarray) -> np.ndarray:
        logits -= logits.max(axis=0)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=0)
        return logits

    @staticmethod
    def _log_chance(logits: np.ndarray, of: np.ndarray) -> np.ndarray:
        """The log of the softmax at one class of each place."""
        logits -= logits.max(axis=0)
        found = logits[of, np.arange(len(of))]
        return found - np.log(np.exp(logits, out=logits).sum(axis=0))

    def _order(self, ids: np.ndarray) -> np.ndarray:
        """A stable order; numpy sorts narrow integers by radix."""
        return np.argsort(ids.astype(np.min_scalar_type(self.size)), kind="stable")

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        p, out = self.parts, np.empty(len(target), np.float64)
        for low in range(0, len(target), 1 << 15):
            at = slice(low, low + (1 << 15))
            order = self._order(target[at] // GROUP)  # a group's places lie side by side
            group, word = np.divmod(target[at][order], GROUP)
            hidden = self._hidden(context[:, at][:, order])
            found = self._log_chance(p["groups_w"] @ hidden.T + p["groups_b"][:, None], group).astype(np.float64)
            edges = np.searchsorted(group, np.arange(self.groups + 1))
            for g in np.flatnonzero(np.diff(edges)).tolist():
                rows = slice(edges[g], edges[g + 1])
                found[rows] += self._log_chance(p["words_w"][g] @ hidden[rows].T + p["words_b"][g][:, None], word[rows])
            out[at][order] = found
        return out

    def _step(self, name: str, index, gradient: np.ndarray) -> None:
        past = self.past[name][index] + gradient * gradient
        self.past[name][index] = past
        self.parts[name][index] -= RATE * gradient / np.sqrt(past)

    def train(self, context: np.ndarray, target: np.ndarray) -> None:
        """One step on a batch of masked places."""
        p, n = self.parts, len(target)
        order = self._order(target // GROUP)  # a group's places lie side by side
        context, (group, word) = context[:, order], np.divmod(target[order], GROUP)
        hidden = self._hidden(context)
        error = self._softmax(p["groups_w"] @ hidden.T + p["groups_b"][:, None])
        error[group, np.arange(n)] -= 1
        back = error.T @ p["groups_w"]
        updates = [("groups_w", slice(None), error @ hidden), ("groups_b", slice(None), error.sum(axis=1))]
        edges = np.searchsorted(group, np.arange(self.groups + 1))
        for g in np.flatnonzero(np.diff(edges)).tolist():
            rows = slice(edges[g], edges[g + 1])
            wrong = self._softmax(p["words_w"][g] @ hidden[rows].T + p["words_b"][g][:, None])
            wrong[word[rows], np.arange(len(word[rows]))] -= 1
            back[rows] += wrong.T @ p["words_w"][g]
            updates += [("words_w", g, wrong @ hidden[rows]), ("words_b", g, wrong.sum(axis=1))]
        back *= 1 - hidden * hidden
        updates.append(("hidden", slice(None), back.sum(axis=0)))
        for name, index, gradient in updates:
            self._step(name, index, gradient / n)
        for k in range(2 * REACH):
            order = self._order(context[k])
            seen = context[k][order]
            first = np.flatnonzero(np.concatenate([[True], seen[1:] != seen[:-1]]))
            self._step("inputs", (k, seen[first]), np.add.reduceat(back[order], first) / n)


def _places(part: Slice, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all words with ``REACH`` blanks around each text, the place of each word, the texts' borders, and the words."""
    words, first = _words(part)
    counts = np.diff(first)
    place = np.arange(len(words)) + np.repeat(REACH * (np.arange(len(part)) + 1), counts)
    ids = np.full(len(words) + REACH * (len(part) + 1), vocabulary.size)
    ids[place] = vocabulary.of(words)
    return ids, place, first, words


def _context(ids: np.ndarray, place: np.ndarray) -> np.ndarray:
    return np.stack([ids[place + k] for k in range(-REACH, REACH + 1) if k])


def _train(batches: Iterable[pa.RecordBatch], vocabulary: Vocabulary, weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    network = Network(vocabulary.size, weights.copy())
    seen, waiting, size = 0, [], 0
    for part in slices(batches):
        ids, place, first, _ = _places(part, vocabulary)
        counts = np.diff(first)
        number = ranges(np.zeros(len(part), np.int64), counts)
        number += np.repeat(counts, counts)
        for offset in range(MASK_EVERY):
            masked = place[number % MASK_EVERY == offset]
            waiting.append(np.concatenate([_context(ids, masked), ids[masked][None]]))
            size += len(masked)
            batch = min(max(seen // 16, FIRST_BATCH), BATCH)
            if size >= batch:
                found, low = np.concatenate(waiting, axis=1), 0
                while size - low >= batch:
                    network.train(found[:-1, low : low + batch], found[-1, low : low + batch])
                    low += batch
                    batch = min(max((seen + low) // 16, FIRST_BATCH), BATCH)
                seen, waiting, size = seen + low, [found[:, low:]], size - low
    if size:
        found = np.concatenate(waiting, axis=1)
        network.train(found[:-1], found[-1])
        seen += size
    if seen:
        yield _pieces(TaskContext.get().partitionId(), seen, network.weights.astype(np.float64) * seen)


def _pieces(task: int, seen: int, sums: np.ndarray) -> pa.RecordBatch:
    pieces = [x.tobytes() for x in np.array_split(sums, _PIECES)]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(_PIECES, dtype=np.int32)), pa.array([task % _SPREAD] * _PIECES, pa.int32()),
         pa.array([task] * _PIECES, pa.int32()), pa.array([seen] * _PIECES, pa.int64()), pa.array(pieces, pa.binary())],
        ["piece", "spread", "task", "seen", "sums"],
    )


def _added(group: pa.Table) -> pa.Table:
    group = group.sort_by("task")  # the same order, the same rounding
    total = sum(np.frombuffer(x, np.float64) for x in group.column("sums").to_pylist())
    first = {c: group.column(c)[:1] for c in ("piece", "spread", "task")}
    seen = sum(group.column("seen").to_pylist())
    return pa.table(first | {"seen": pa.array([seen], pa.int64()), "sums": pa.array([total.tobytes()], pa.binary())})


def train_network(texts: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Network:
    """A network trained on all texts (doc_id, text)."""
    network, context = Network(vocabulary.size), texts.sparkSession.sparkContext
    schema = "piece int, spread int, task int, seen long, sums binary"
    share = F.pmod(F.xxhash64(F.lit("round"), "doc_id"), F.lit(rounds))
    for number in range(rounds):
        shared = context.broadcast((vocabulary, network.weights))
        rows = texts.filter(share == number).select("text")
        trained = rows.mapInArrow(lambda b, shared=shared: _train(b, *shared.value), schema)
        trained = trained.groupBy("piece", "spread").applyInArrow(_added, schema)
        pieces = sorted(trained.groupBy("piece").applyInArrow(_added, schema).collect(), key=lambda r: r["piece"])
        if pieces:
            network = Network(vocabulary.size, np.concatenate([np.frombuffer(r["sums"], np.float64) / r["seen"] for r in pieces]))
    return network


ASKED_SCHEMA = (
    "slice string, bucket int, words binary, places binary, doc_ids array<long>, n_words array<long>, totals array<double>, "
    "rare_words binary, asked binary"
)
SCORED_SCHEMA = "doc_id long, n_words long, pseudo_log_likelihood double, score double"


def _score(batches: Iterable[pa.RecordBatch], vocabulary: Vocabulary, weights: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Of each slice one row with its texts' sums over classes and rare words, and a row per bucket with the words it asks for."""
    network, kinds = Network(vocabulary.size, weights), [pa.string(), pa.int32(), pa.binary(), pa.binary()]
    kinds += [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.binary(), pa.binary()]
    names = [x.split()[0] for x in ASKED_SCHEMA.split(", ")]
    for part in slices(batches):
        ids, place, first, words = _places(part, vocabulary)
        found = network.log_probabilities(_context(ids, place), ids[place])
        counts = np.diff(first)
        total = [found[a:b].sum() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
        rare = np.flatnonzero(ids[place] >= vocabulary.frequent)
        different, asked = np.unique(words[rare], return_inverse=True)
        per_text = np.diff(np.searchsorted(rare, first)).astype(np.uint32)
        name = uuid.uuid4().hex
        rows = [(name, None, None, None, part.column("doc_id").to_pylist(), counts.tolist(), total, per_text.tobytes(), asked.astype(np.uint32).tobytes())]
        bucket = (different % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0, [True]])) if len(order) else np.zeros(1, np.int64)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            at = order[a:b]
            rows.append((name, int(bucket[at[0]]), different[at].tobytes(), at.astype(np.uint32).tobytes(), None, None, None, None, None))
        yield pa.RecordBatch.from_arrays([pa.array(list(column), kind) for column, kind in zip(zip(*rows), kinds)], names)


def _answer(asked: pa.Table, counted: pa.Table, vocabulary: Vocabulary, sizes: np.ndarray) -> pa.Table:
    """The shares of the words that slices ask of a bucket."""
    known, counts = (unpacked(counted, name, kind) for name, kind in (("word", np.uint64), ("count", np.int64)))
    shares = []
    for row in asked.column("words"):
        words = np.frombuffer(row.as_buffer(), np.uint64)
        count = np.zeros(len(words))
        if len(known):
            place = np.minimum(np.searchsorted(known, words), len(known) - 1)
            count = np.where(known[place] == words, counts[place], 0)
        shares.append(np.log((count + 1) / sizes[vocabulary.of(words) - vocabulary.frequent]).tobytes())
    return pa.table({"slice": asked.column("slice"), "places": asked.column("places"), "shares": pa.array(shares, pa.binary())})


def _summed(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """A slice's texts with the shares of their words added."""
    if not texts.num_rows:
        return pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()),
                         "pseudo_log_likelihood": pa.array([], pa.float64()), "score": pa.array([], pa.float64())})
    places, shares = unpacked(answers, "places", np.uint32), unpacked(answers, "shares", np.float64)
    of = np.zeros(len(places))
    of[places] = shares
    row = {name: texts.column(name)[0] for name in ("doc_ids", "n_words", "totals", "rare_words", "asked")}
    per_text, asked = (np.frombuffer(row[name].as_buffer(), np.uint32) for name in ("rare_words", "asked"))
    counts, total = row["n_words"].values.to_numpy(), row["totals"].values.to_numpy()
    total = total + np.bincount(np.repeat(np.arange(len(total)), per_text), weights=of[asked], minlength=len(total))
    return pa.table({
        "doc_id": row["doc_ids"].values, "n_words": pa.array(counts), "pseudo_log_likelihood": pa.array(total),
        "score": pa.array(total / np.maximum(counts, 1), mask=counts == 0),
    })


def score_documents(
    documents: DataFrame, rounds: int = ROUNDS, frequent: int = FREQUENT, rare: int = RARE
) -> DataFrame:
    """doc_id, n_words, the summed log-probability of all words, and ``score``, its mean over the words."""
    spark = documents.sparkSession
    texts = documents.select(typed(documents, "doc_id", "bigint"), typed(documents, "text", "string"))
    counts, buckets = count_words(texts)
    vocabulary = frequent_words(counts, frequent, rare)
    sizes = class_sizes(counts, vocabulary)
    network = train_network(texts, vocabulary, rounds)
    shared = spark.sparkContext.broadcast((vocabulary, network.weights, buckets))
    path = work_dir(spark, "asked-words")  # slices have names of their own, so they are written once
    texts.mapInArrow(lambda b: _score(b, *shared.value), ASKED_SCHEMA).write.parquet(path)
    slices_ = spark.read.schema(ASKED_SCHEMA).parquet(path)
    asked = slices_.filter("bucket IS NOT NULL").select("slice", "bucket", "words", "places")
    answers = asked.groupBy("bucket").cogroup(counts.groupBy("bucket")).applyInArrow(
        lambda left, right: _answer(left, right, vocabulary, sizes), "slice string, places binary, shares binary"
    )
    whole = slices_.filter("bucket IS NULL").select("slice", "doc_ids", "n_words", "totals", "rare_words", "asked")
    return whole.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(_summed, SCORED_SCHEMA)
