"""Benchmark decontamination with a generalised suffix automaton over words.

The test items, normalised to lower-case words, form one automaton. The words of
every document run through it; at each word the automaton knows the longest
string of words ending there that also stands in some item. Where that length
reaches the window (13 words, or a whole shorter item), the words are hit.

Scale: documents are never shuffled. The automaton is sent to the tasks, so its
size is checked: items are cut into shards of at most ``shard_words`` words and
each shard takes its own pass over the documents, whose hits the next pass adds
to (checkpointed in between, so that a task holds one shard). Runs of words that
no item has cannot match and are skipped before the automaton is asked.

Defined results: a null or empty text has no words and no hits; an item without
words matches nothing; rows that repeat a ``doc_id`` are separate documents, one
row each; a null ``item_id`` still marks words as hit but
is not listed; items of the same id count once; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.shared import checkpointed
from oreflow.llm.textbytes import LOWER, WORD, prefix_hash, slices, span_hash, word_spans

WINDOW_WORDS = 13
SHARD_WORDS = 1_000_000

HITS_SCHEMA = "n_words long, hit_starts array<long>, hit_ends array<long>, item_ids array<string>"


def item_words(text: str | None) -> list[bytes]:
    data = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
    start, end, _ = word_spans(data, np.array([0, len(data)]), WORD)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(start.tolist(), end.tolist())]


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with the items that each state occurs in."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.step: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.ids: dict[bytes, int] = {}
        self.owners: list[set[str]] = [set()]
        self.whole: dict[int, set[str]] = {}  # states whose longest string is a whole item shorter than the window
        self.shortest = window
        for name, words in items:
            if words:
                self._insert(name, words)
        self._spread_owners()
        vocabulary = b"".join(self.ids)
        sizes = np.cumsum([0, *map(len, self.ids)]).astype(np.int64)
        data = np.frombuffer(vocabulary, np.uint8)
        self.known = np.sort(span_hash(prefix_hash(data), sizes[:-1], sizes[1:]))

    def _insert(self, name: str | None, words: list[bytes]) -> None:
        self.shortest = min(self.shortest, len(words))
        last = 0
        for word in words:
            last = self._extend(last, self.ids.setdefault(word, len(self.ids)))
            if name is not None and self.length[last] >= self.window:
                self.owners[last].add(name)
        if len(words) < self.window:
            self.whole.setdefault(last, set()).update({name} - {None})

    def _new(self, length: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.owners.append(set())
        return len(self.step) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        clone = self._new(self.length[p] + 1, dict(self.step[q]), self.link[q])
        while p != -1 and self.step[p].get(word) == q:
            self.step[p][word] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, word: int) -> int:
        known = self.step[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, known, word)
        new = self._new(self.length[last] + 1, {}, 0)
        p = last
        while p != -1 and word not in self.step[p]:
            self.step[p][word] = new
            p = self.link[p]
        if p != -1:
            q = self.step[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
        return new

    def _spread_owners(self) -> None:
        """A string occurs wherever the longer strings that it ends occur: owners go up the links."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.length[self.link[state]] >= self.window:
                self.owners[self.link[state]] |= self.owners[state]

    def scan(self, words: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit runs [start, end) of a word sequence, and the items that they come from."""
        state = size = 0
        hits: list[list[int]] = []
        found: set[str] = set()
        for place, word in enumerate(words):
            while state and word not in self.step[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.step[state]:
                state, size = self.step[state][word], size + 1
            if size < self.shortest:
                continue
            at, reach = state, 0
            while size >= self.window and self.length[self.link[at]] >= self.window:
                at = self.link[at]
            if size >= self.window:
                reach = self.window
                found |= self.owners[at]
                at = self.link[at]
            # whole short items that end here, longest first
            exact = size if at == state else self.length[at]
            while at > 0 and exact >= self.shortest:
                if at in self.whole and self.length[at] <= exact:
                    reach = max(reach, self.length[at])
                    found |= self.whole[at]
                at = self.link[at]
                exact = self.length[at]
            if reach:
                start = place + 1 - reach
                while hits and hits[-1][1] >= start:
                    start = min(start, hits.pop()[0])
                hits.append([start, place + 1])
        return [(a, b) for a, b in hits], found


def _runs(flags: np.ndarray, edges: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of true flags within [edges[i], edges[i + 1]) that hold at least ``least`` of them."""
    starts = flags.copy()
    starts[1:] &= ~flags[:-1]
    inner = edges[edges < len(flags)]
    starts[inner] = flags[inner]
    ends = flags.copy()
    ends[:-1] &= ~flags[1:]
    last = edges[(edges > 0) & (edges <= len(flags))] - 1
    ends[last] = flags[last]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    long = end - start >= least
    return start[long], end[long]


def _scan_batches(
    batches: Iterable[pa.RecordBatch], automaton: SuffixAutomaton, keys: tuple[str, ...]
) -> Iterator[pa.RecordBatch]:
    known = automaton.known
    maybe = np.zeros(1 << 16, bool)
    maybe[(known & np.uint64(0xFFFF)).astype(np.int64)] = True
    for part in slices(batches):
        data = LOWER[part.data]
        start, end, first = word_spans(data, part.offsets, WORD)
        flags = np.zeros(len(start), bool)
        if len(known) and len(start):
            hashes = span_hash(prefix_hash(data), start, end)
            some = np.flatnonzero(maybe[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
            place = np.minimum(np.searchsorted(known, hashes[some]), len(known) - 1)
            flags[some] = known[place] == hashes[some]
        run_start, run_end = _runs(flags, first, automaton.shortest) if len(flags) else (flags, flags)
        spans: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[str]] = {}
        for doc, a, b in zip((np.searchsorted(first, run_start, "right") - 1).tolist(), run_start.tolist(), run_end.tolist()):
            words = [automaton.ids.get(data[s:e].tobytes(), -1) for s, e in zip(start[a:b].tolist(), end[a:b].tolist())]
            hits, found = automaton.scan(words)
            if hits:
                base = a - int(first[doc])
                spans.setdefault(doc, []).extend((base + x, base + y) for x, y in hits)
                items.setdefault(doc, set()).update(found)
        n = len(part)
        before = [part.column(name).to_pylist() for name in ("hit_starts", "hit_ends", "item_ids")]
        if any(before[0]):
            for i in range(n):
                spans[i] = _union([*zip(before[0][i], before[1][i]), *spans.get(i, ())])
                items[i] = items.get(i, set()) | set(before[2][i])
        kept = [(name, part.column(name)) for name in keys]
        kept += [
            ("n_words", pa.array(np.diff(first).astype(np.int64))),
            ("hit_starts", pa.array([[x for x, _ in spans.get(i, ())] for i in range(n)], pa.list_(pa.int64()))),
            ("hit_ends", pa.array([[y for _, y in spans.get(i, ())] for i in range(n)], pa.list_(pa.int64()))),
            ("item_ids", pa.array([sorted(items.get(i, ())) for i in range(n)], pa.list_(pa.string()))),
        ]
        yield pa.RecordBatch.from_arrays([values for _, values in kept], [name for name, _ in kept])


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _shards(benchmark: DataFrame, window: int, shard_words: int) -> Iterator[SuffixAutomaton]:
    """Automata over items of at most ``shard_words`` words each (a longer item alone), read item by item."""
    held: list[tuple[str | None, list[bytes]]] = []
    total = 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    for row in rows.toLocalIterator():
        words = item_words(row["text"])
        if held and total + len(words) > shard_words:
            yield SuffixAutomaton(held, window)
            held, total = [], 0
        held.append((row["item_id"], words))
        total += len(words)
    yield SuffixAutomaton(held, window)


def benchmark_hits(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, shard_words: int = SHARD_WORDS,
    keys: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keys`` of every document, its words, the word spans hit by test items, and the items.

    ``documents`` needs doc_id and text, ``benchmark`` item_id and text. Spans are
    ``hit_starts`` and ``hit_ends`` (end excluded), sorted and disjoint.
    """
    none = F.array().cast("array<long>")
    others = [k for k in keys if k != "text"]
    hits = documents.select(
        *others, F.col("text").cast("string").alias("text"),
        none.alias("hit_starts"), none.alias("hit_ends"), F.array().cast("array<string>").alias("item_ids"),
    )
    kinds = dict(hits.dtypes)
    shards = _shards(benchmark, window, shard_words)
    automaton = next(shards)
    while automaton is not None:
        following = next(shards, None)
        kept = keys if following is None else (*others, "text")
        shared = documents.sparkSession.sparkContext.broadcast(automaton)

        def scan(batches, shared=shared, kept=kept):
            return _scan_batches(batches, shared.value, kept)

        hits = hits.mapInArrow(scan, "".join(f"`{k}` {kinds[k]}, " for k in kept) + HITS_SCHEMA)
        if following is not None:
            hits = checkpointed(hits).drop("n_words")
        automaton = following
    return hits


def judged(hits: DataFrame, one_in: int = 20) -> DataFrame:
    """Adds ``n_hit`` and ``contaminated``: any hit, and hits on at least one in ``one_in`` words."""
    n_hit = F.aggregate(F.zip_with("hit_ends", "hit_starts", lambda a, b: a - b), F.lit(0).cast("long"), lambda x, y: x + y)
    return hits.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words"))
    )
