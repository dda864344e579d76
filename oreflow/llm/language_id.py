"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of a letter trigram
binds (multiplies) its letters' vectors, rotated by two, one and no places; runs
of other characters count as one blank letter. A document's vector bundles (adds)
its trigrams' vectors, a language's prototype bundles its training documents, and
a document gets the language of the prototype with the largest cosine.

Scale: texts are never shuffled. Each task bundles its own training documents;
the partial prototypes (integers, so their sum does not depend on order) are added
by Spark, one row per language and dimension. Prototypes are sent back to the
tasks; their number is the number of languages, at most ``MAX_LANGUAGES``.

Defined results: null texts and texts without a letter get ``und`` and score 0,
as does every text where nothing was learnt; ties go to the language that sorts
first; a null doc_id is held out of training; rows of equal doc_id are predicted
each by its own text; a null lang is never learnt; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.shared import held_out
from oreflow.llm.textbytes import Slice, mix, slices

DIMENSIONS = 1024
MAX_LANGUAGES = 1000
UNKNOWN = "und"
_CELLS = 1 << 22
_SLICE = 1 << 20  # bytes of text counted at once
_VECTORS = 2048  # trigrams whose vectors are held at once


def letter_vectors(letters: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """+1 and -1 for each code point (0 stands for the blank), the same in every process."""
    words = -(-dimensions // 64)
    seeds = letters.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(words, dtype=np.uint64)[None, :]
    bits = np.unpackbits(mix(mix(seeds + np.uint64(1))).view(np.uint8).reshape(len(letters), -1), axis=1)
    return (bits[:, :dimensions].astype(np.int8) << 1) - 1


def trigram_vectors(trigrams: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Bound vectors of rows of three code points."""
    letters, place = np.unique(trigrams, return_inverse=True)
    place = place.reshape(trigrams.shape)
    base = letter_vectors(letters, dimensions)
    return np.roll(base, 2, axis=1)[place[:, 0]] * np.roll(base, 1, axis=1)[place[:, 1]] * base[place[:, 2]]


def _letters(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters (code points, 0: blank) of all texts with a blank around each, and the texts' borders."""
    codes = np.frombuffer(part.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    chars = np.zeros(len(part.data) + 1, np.int64)
    np.cumsum((part.data & 0xC0) != 0x80, out=chars[1:])
    borders = chars[part.offsets]
    used = np.flatnonzero(np.bincount(codes)) if len(codes) else np.empty(0, np.int64)
    fold = np.zeros(int(used.max()) + 1 if len(used) else 1, np.uint32)
    for code in used.tolist():
        low = chr(code).lower()
        fold[code] = (ord(low) if len(low) == 1 else code) if chr(code).isalpha() else 0
    n = len(part)
    out = np.zeros(len(codes) + 2 * n, np.uint32)
    out[np.arange(len(codes)) + np.repeat(2 * np.arange(n) + 1, np.diff(borders))] = fold[codes]
    borders = borders + 2 * np.arange(n + 1)
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 0) | (out[:-1] != 0)
    keep[borders[:-1]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return out[keep], kept[borders]


def _counted(part: Slice) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, trigrams as rows of three letters, counts of texts by trigrams)."""
    letters, borders = _letters(part)
    if len(letters) < 3:
        return
    alphabet = np.flatnonzero(np.bincount(letters))
    size = len(alphabet)
    symbol = np.zeros(int(alphabet[-1]) + 1, np.int64)
    symbol[alphabet] = np.arange(size)
    symbol = symbol[letters]
    keys = (symbol[:-2] * size + symbol[1:-1]) * size + symbol[2:]
    owner = np.repeat(np.arange(len(part)), np.diff(borders))
    inside = (owner[:-2] == owner[2:]) & ((letters[:-2] != 0) | (letters[1:-1] != 0) | (letters[2:] != 0))
    keys, owner = keys[inside], owner[:-2][inside]
    if size**3 <= _CELLS:
        present = np.flatnonzero(np.bincount(keys, minlength=1))
        place = np.zeros(size**3, np.int64)
        place[present] = np.arange(len(present))
        keys = place[keys]
    else:
        present, keys = np.unique(keys, return_inverse=True)
    if not len(present):
        return
    trigrams = alphabet[np.stack([present // (size * size), present // size % size, present % size], axis=1)]
    rows = max(1, _CELLS // len(present))
    for low in range(0, len(part), rows):
        high = min(low + rows, len(part))
        a, b = np.searchsorted(owner, [low, high])
        counts = np.bincount((owner[a:b] - low) * len(present) + keys[a:b], minlength=(high - low) * len(present))
        yield low, high, trigrams, counts.reshape(high - low, -1)


def _bundled(counts: np.ndarray, trigrams: np.ndarray, dimensions: int, kind: type) -> np.ndarray:
    """Sums of the trigrams' vectors, each times its count. They are integers, so the parts add up to the same in any order."""
    out = np.zeros((len(counts), dimensions), kind)
    for low in range(0, len(trigrams), _VECTORS):
        at = slice(low, low + _VECTORS)
        out += counts[:, at].astype(kind) @ trigram_vectors(trigrams[at], dimensions).astype(kind)
    return out


def _bundle(batches: Iterable[pa.RecordBatch], dimensions: int) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for part in slices(batches, limit=_SLICE):
        langs = np.array(part.column("lang").to_pylist(), object)
        for low, high, trigrams, counts in _counted(part):
            names = sorted(set(langs[low:high]))
            by_lang = np.stack([counts[langs[low:high] == name].sum(axis=0) for name in names])
            for name, vector in zip(names, _bundled(by_lang, trigrams, dimensions, np.float64)):
                sums[name] = sums.get(name, 0) + vector.astype(np.int64)
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums)), pa.array([x.tolist() for x in sums.values()], pa.list_(pa.int64()))], ["lang", "bundle"]
        )


def train_prototypes(documents: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Language to prototype, from all texts with a lang that are not held out."""
    rows = documents.filter(~held_out("doc_id") & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )
    partial = rows.mapInArrow(lambda batches: _bundle(batches, dimensions), "lang string, bundle array<long>")
    summed = partial.select("lang", F.posexplode("bundle").alias("place", "value")).groupBy("lang", "place").agg(
        F.sum("value").alias("value")
    )
    packed = summed.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("cells"))
    found = packed.select("lang", F.col("cells.value").alias("bundle")).limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: lang does not look like a language code")
    return {row["lang"]: np.array(row["bundle"], np.float64) for row in sorted(found, key=lambda r: r["lang"])}


def _predict(
    batches: Iterable[pa.RecordBatch], keys: tuple[str, ...], names: list[str], units: np.ndarray
) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, limit=_SLICE):
        n = len(part)
        best, score = np.full(n, -1), np.zeros(n)
        for low, high, trigrams, counts in _counted(part):
            vectors = _bundled(counts, trigrams, units.shape[1], np.float32)
            norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64))
            some = counts.sum(axis=1) > 0
            if len(names):
                cosines = (vectors.astype(np.float64) @ units.T) / np.maximum(norms, 1e-300)[:, None]
                best[low:high] = np.where(some, cosines.argmax(axis=1), -1)
                score[low:high] = np.where(some, np.clip(cosines.max(axis=1), 0, 1), 0)
        kept = [(name, part.column(name)) for name in keys]
        kept += [
            ("lang_pred", pa.array([names[i] if i >= 0 else UNKNOWN for i in best.tolist()], pa.string())),
            ("score", pa.array(score)),
        ]
        yield pa.RecordBatch.from_arrays([values for _, values in kept], [name for name, _ in kept])


def predict_language(documents: DataFrame, prototypes: dict[str, np.ndarray], keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` of every document with ``lang_pred`` and ``score``, the cosine from 0 to 1."""
    names = sorted(name for name, vector in prototypes.items() if np.any(vector))
    units = np.array([prototypes[n] / np.linalg.norm(prototypes[n]) for n in names]) if names else np.zeros((0, DIMENSIONS))
    shared = documents.sparkSession.sparkContext.broadcast((names, units))
    rows = documents.select(*[k for k in keys if k != "text"], F.col("text").cast("string").alias("text"))
    kinds = dict(rows.dtypes)
    schema = "".join(f"`{k}` {kinds[k]}, " for k in keys) + "lang_pred string, score double"
    return rows.mapInArrow(lambda batches: _predict(batches, keys, *shared.value), schema)


def identify_languages(documents: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """Learns from the documents that are not held out and predicts all."""
    found = predict_language(documents, train_prototypes(documents, dimensions))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
