"""Periodic runs of words, and texts with their repetitions collapsed.

A run is a stretch of consecutive words with smallest period q that no neighbouring
word extends; those of at least ``least_words`` words and ``least_times`` periods
count. They are found from suffix trees:

* Ukkonen's construction gives the trees of the words and of their reversal.
* An Euler tour of each with a sparse table of depths answers "how far do the words
  from i and from j agree" (and backwards) as the depth of a lowest common ancestor,
  in constant time.
* The longest Lyndon word at each place, under the order of words and under its
  reverse, ends at the next smaller suffix. Every run has such a word as its root, so
  these pairs (i, j) are the candidates: extended both ways they give all runs.

A run has a five-word string that recurs one period later, all the way along. Where
no such string recurs at a distance that the length of the recurring stretch
allows, no run can lie, so trees are built for the remaining regions only. That
judges every word of every text and loses no run.

Scale: no shuffle; texts stream through tasks in slices. A region is some hundred
bytes a word in its task, so the longest periodic stretch of one text bounds memory.

Defined results: a null or empty text, or one of white space, has no words and no
runs; words are told apart by their bytes; texts that repeat an id are judged each;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.textbytes import NONSPACE, mix, prefix_hash, ranges, slices, span_hash, word_spans

LEAST_WORDS, LEAST_TIMES = 6, 4
#: A run of period q and length >= max(6, 4 q) has max(5, 3 q) words that recur q words later.
GRAM = 5
_STEP = np.uint64(0x9E3779B97F4A7C15)

Order = Callable[[int | None, int], np.ndarray | None]


class SuffixTree:
    """Ukkonen's tree of numbers from 1 on, closed by 0; constant-time common prefixes."""

    def __init__(self, symbols: list[int]):
        self.text = [*symbols, 0]
        self.size = len(self.text)
        self._grow()
        self._tour()

    def _grow(self) -> None:
        text, n = self.text, self.size
        width = max(text) + 1
        start, stop, link, to = [0], [0], [0], {}
        node = edge = length = pending = 0
        for i, symbol in enumerate(text):
            pending += 1
            inner = 0  # the split that waits for its suffix link
            while pending:
                if not length:
                    edge = i
                key = node * width + text[edge]
                child = to.get(key)
                if child is None:
                    to[key] = len(start)
                    start.append(i)
                    stop.append(n)
                    link.append(0)
                    if inner:
                        link[inner] = node
                        inner = 0
                else:
                    low = start[child]
                    size = min(stop[child], i + 1) - low
                    if length >= size:
                        edge += size
                        length -= size
                        node = child
                        continue
                    at = low + length
                    if text[at] == symbol:
                        length += 1
                        if inner:
                            link[inner] = node
                        break
                    split = len(start)
                    start += (low, i)
                    stop += (at, n)
                    link += (0, 0)
                    to[key] = split
                    to[split * width + symbol] = split + 1
                    to[split * width + text[at]] = child
                    start[child] = at
                    if inner:
                        link[inner] = split
                    inner = split
                pending -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - pending + 1
        nodes = len(start)
        keys = np.fromiter(to.keys(), np.int64, len(to))
        child = np.fromiter(to.values(), np.int64, len(to))
        self.edge_size = np.array(stop, np.int64) - np.array(start, np.int64)
        # children of a node stand together, by their first symbol
        order = np.argsort(keys)
        self.children = child[order]
        self.first_child = np.searchsorted(keys[order] // width, np.arange(nodes + 1))
        self.closing = keys[order] % width == 0

    def _tour(self) -> None:
        """Depths along the Euler tour, each suffix's place in it, and the suffixes in the order of words."""
        edge_size, children, bounds = self.edge_size.tolist(), self.children.tolist(), self.first_child.tolist()
        n, depth = self.size, [0] * len(edge_size)
        tour, places, leaves = [], [0] * n, []
        stack = [0]
        while stack:
            node = stack.pop()
            if node < 0:  # back from a child
                tour.append(depth[~node])
                continue
            here = depth[node]
            low, high = bounds[node], bounds[node + 1]
            if low == high:
                places[n - here] = len(tour)
                leaves.append(n - here)
            tour.append(here)
            back = ~node
            for child in reversed(children[low:high]):
                depth[child] = here + edge_size[child]
                stack += (back, child)
        self.places = np.array(places, np.int64)
        self.sorted = leaves
        levels = [np.array(tour, np.int32)]
        while 2 << (len(levels) - 1) <= len(tour):
            last, half = levels[-1], 1 << (len(levels) - 1)
            levels.append(np.minimum(last[:-half], last[half:]))
        self.levels = levels

    def sorted_reversed(self) -> list[int]:
        """Suffixes in the reverse order of words; an end still comes before any word."""
        edge_size, children, bounds = self.edge_size.tolist(), self.children.tolist(), self.first_child.tolist()
        closing, n, out, stack = self.closing.tolist(), self.size, [], [(0, 0)]
        while stack:
            node, depth = stack.pop()
            low, high = bounds[node], bounds[node + 1]
            if low == high:
                out.append(n - depth)
                continue
            last = None
            for k in range(low, high):
                pair = (children[k], depth + edge_size[children[k]])
                if closing[k]:
                    last = pair
                else:
                    stack.append(pair)
            if last:
                stack.append(last)
        return out

    def agreement(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes i and j (different), as their lowest common ancestor's depth."""
        a, b = self.places[i], self.places[j]
        a, b = np.minimum(a, b), np.maximum(a, b) + 1
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            row = self.levels[k]
            out[at] = np.minimum(row[a[at]], row[b[at] - (1 << k)])
        return out


def next_smaller(suffixes: list[int]) -> np.ndarray:
    """For each suffix but the empty last one the next later one that comes before it in ``suffixes``."""
    n = len(suffixes)
    rank = [0] * n
    for place, suffix in enumerate(suffixes):
        rank[suffix] = place
    out, stack = [0] * (n - 1), [n - 1]
    for i in range(n - 2, -1, -1):
        here = rank[i]
        while rank[stack[-1]] > here:
            stack.pop()
        out[i] = stack[-1]
        stack.append(i)
    return np.array(out, np.int64)


def runs_of(symbols: list[int], least_words: int = LEAST_WORDS, least_times: int = LEAST_TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of numbers from 1 on, sorted; at least two periods count."""
    n = len(symbols)
    if n < 2:
        return []
    tree = SuffixTree(symbols)
    i = np.arange(n)
    ends = [next_smaller(tree.sorted), next_smaller(tree.sorted_reversed())]
    first, second = np.tile(i, 2), np.concatenate(ends)
    fits = (second < n) & (least_times * (second - first) <= n)
    first, second = first[fits], second[fits]
    if not len(first):
        return []
    after = tree.agreement(first, second)
    back = SuffixTree(symbols[::-1])
    before = np.where(first > 0, back.agreement(n - first, n - second), 0)
    period = second - first
    start, length = first - before, before + period + after
    fits = length >= np.maximum(least_words, np.maximum(least_times, 2) * period)
    return sorted(set(zip(start[fits].tolist(), length[fits].tolist(), period[fits].tolist())))


def periodic_regions(words: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches [low, high) of the texts' words, within which every run lies whole.

    ``words`` holds numbers of all texts' words, equal ones for equal words; text k has
    those from ``edges[k]`` on. A chain of m five-word strings that occurred before
    admits periods up to (m + 4) / 3; strings whose last occurrence is further back
    than that belong to no run and split the chain.
    """
    none = np.empty(0, np.int64)
    count = len(words) - GRAM + 1
    if count < 1:
        return none, none
    text = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    gram = mix(text[:count].astype(np.uint64) + np.uint64(1))
    for k in range(GRAM):
        gram = gram * _STEP + words[k : k + count]
    whole = text[:count] == text[GRAM - 1 :]
    place = np.flatnonzero(whole)
    order = place[np.argsort(gram[place], kind="stable")]
    same = gram[order[1:]] == gram[order[:-1]]
    gap = np.full(count, len(words), np.int64)
    gap[order[1:][same]] = (order[1:] - order[:-1])[same]
    alive = gap < len(words)
    while True:
        step = np.diff(np.concatenate([[0], alive.view(np.int8), [0]]))
        low, high = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        far = np.zeros(count, bool)
        far[ranges(low, high - low)] = gap[ranges(low, high - low)] > np.repeat((high - low + GRAM - 1) // 3, high - low)
        if not far.any():
            break
        alive &= ~far
    if not len(low):
        return none, none
    begin = np.maximum(low - (high - low + GRAM - 1) // 3, edges[text[low]])
    end = high + GRAM - 1
    # regions that overlap become one; they stay in their text
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], begin[1:] >= reach[:-1]])
    return begin[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


def planted_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """Word order of a tenth of the documents: from a place on, their words repeat with a period. None for the others."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Texts of words joined by one blank; text k has the words from ``edges[k]`` on."""
    size = end - start + 1
    filled = np.diff(edges) > 0
    size[edges[1:][filled] - 1] -= 1
    out = np.append(data, np.uint8(0))[ranges(start, size)]
    stops = np.cumsum(size)
    blank = np.ones(len(size), bool)
    blank[edges[1:][filled] - 1] = False
    out[stops[blank] - 1] = 32
    offsets = np.concatenate([[0], stops])[edges].astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(out))])


def _judge(batches: Iterable[pa.RecordBatch], order: Order | None) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        start, end, first = word_spans(part.data, part.offsets, NONSPACE)
        keys = part.column("doc_id").to_pylist()
        if order is not None and len(start):
            pieces = []
            for doc_id, a, b in zip(keys, first.tolist(), first[1:].tolist()):
                new = order(doc_id, b - a)
                pieces.append(np.arange(a, b) if new is None else a + new)
            at = np.concatenate(pieces)
            start, end = start[at], end[at]
        lows, highs = periodic_regions(span_hash(prefix_hash(part.data), start, end), first)
        owner = np.searchsorted(first, lows, "right") - 1
        raw = part.data.tobytes()
        kept = np.ones(len(start), bool)
        runs: list[list[dict]] = [[] for _ in keys]
        for k, low, high in zip(owner.tolist(), lows.tolist(), highs.tolist()):
            numbers: dict[bytes, int] = {}
            symbols = [
                numbers.setdefault(raw[a:b], len(numbers) + 1) for a, b in zip(start[low:high].tolist(), end[low:high].tolist())
            ]
            for begin, length, period in runs_of(symbols):
                kept[low + begin + period : low + begin + length] = False
                runs[k].append({"start": low + begin - int(first[k]), "length": length, "period": period})
        left = np.concatenate([[0], np.cumsum(kept)])[first]
        collapsed = _joined(part.data, start[kept], end[kept], left)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(runs, kind), collapsed.cast(pa.binary())], ["doc_id", "runs", "collapsed"]
        )


def find_runs(documents: DataFrame, order: Order | None = None) -> DataFrame:
    """(doc_id, runs, collapsed): the runs of each text, and its words but those of each run after its first period.

    ``order`` may give another word order of a text, from its id and number of words.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"
    return rows.mapInArrow(lambda batches: _judge(batches, order), schema)


def run_digests(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one, and digests of all runs and of the collapsed text."""
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rank = F.transform("runs", lambda r: F.struct((-r["length"]).alias("shortness"), r["start"].alias("start"), r["period"].alias("period")))
    rows = found.select("doc_id", "collapsed", F.size("runs").cast("long").alias("n_runs"), F.array_join(line, "").alias("lines"),
                        F.array_min(rank).alias("best"))
    return rows.select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), (-F.col("best.shortness")).alias("length"),
        F.col("best.period").alias("period"), F.expr("-best.shortness * 1000 div best.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
