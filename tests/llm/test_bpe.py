import ctypes
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from oreflow.llm import bpe
from oreflow.llm.bpe import TrieEncoder, byte_symbols, encode_documents

PATH = public_tokenizers.path("word_bpe_49k.json")

HARD = [
    "", "   ", None, "Hello, World!! don't we'll 'S 'stop I'm x'd", "ΣΑΣ ὈΔΥΣΣΕΎΣ Σ", "İstanbul ŞIK", "élève ñandú ½ ² ٣ 12345",
    "a<|endoftext|>b <|startoftext|> <|EndOfText|><|endoftext|><|endoftext|>", "tab\tnew\nline\x0bvt\x0cff\x1cfs\x1dgs\x85nel\xa0nb em　id",
    "日本語テキスト 한국어 😀😃 👨‍👩‍👧", "________ $$$ %%% ***", "zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz" * 9, "​﻿­", "ﬁ ﬂ Ⅷ ⅳ ª º", "q" * 3000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(4)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "ción", "ñ", "éau", "ü", "ß", "ing", "tion", "'s", "1", "-", "!!", "Q"]
    out = [" ".join("".join(rng.choices(syllables, k=rng.randint(1, 6))) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    pool = [chr(c) for c in [*range(1, 400), *range(0x370, 0x400), *range(0x2000, 0x2070), 0x3000, 0x4E2D, 0x1F600, 0x301, 0x327]]
    out += ["".join(rng.choices(pool, k=40)) for _ in range(400)]
    return out + HARD


def test_like_the_library(spark, library):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r["doc_id"]: (list(r["ids"]), r["decoded"]) for r in encode_documents(docs, PATH).collect()}
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i] == (ids, library.decode(ids, skip_special_tokens=False)), repr(text)


def test_words_share_prefixes(library):
    encoder = TrieEncoder(open(PATH, encoding="utf-8").read())
    words = ["the", "then", "thenou", "thenouing", "a", "an", "and"]
    for word, tokens in encoder.encode_words(words).items():
        encoded = library.encode(word, add_special_tokens=False)
        assert tokens == encoded.tokens and encoder.decode(encoded.ids) == " ".join(tokens)


def test_small_stores(spark, library, monkeypatch):
    monkeypatch.setattr("oreflow.llm.bpe.CACHED_CHUNKS", 3)
    monkeypatch.setattr("oreflow.llm.bpe.MAX_PAIRS", 5)
    encoder = TrieEncoder(open(PATH, encoding="utf-8").read())
    for text in texts()[:20]:
        _, decoded = encoder.encode_texts([text, text])
        assert decoded[0] == decoded[1] == library.decode(library.encode(text, add_special_tokens=False).ids, skip_special_tokens=False)


def test_empty_table_and_other_columns(spark):
    assert encode_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
    odd = spark.createDataFrame([(None, "a b", "x"), (None, "a b", "y")], "doc_id long, text string, ids string")
    assert [len(r["ids"]) for r in encode_documents(odd, PATH).collect()] == [2, 2]


def test_byte_symbols_differ():
    assert len(set(byte_symbols())) == 256


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        TrieEncoder(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())


def test_decoding_starts_from_the_ids():
    encoder, library = TrieEncoder(open(PATH, encoding="utf-8").read()), Tokenizer.from_file(PATH)
    groups = [[], [0, 1, 500], [3], [10**6, -1, 7], [10**6], list(range(0, 40_000, 997))]
    edges = np.cumsum([0, *map(len, groups)])
    decoded = encoder.decode_texts(np.array(sum(groups, []), np.int32), edges).to_pylist()
    assert decoded == [encoder.decode(ids) for ids in groups]
    assert decoded[1] == library.decode(groups[1], skip_special_tokens=False)


def test_a_task_leaves_nothing_behind():
    content = open(PATH, encoding="utf-8").read()
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words of a text", "others <|endoftext|> and some"]})
    (out,) = bpe._encode_batches([batch], content)
    encoder = bpe._encoder(content)
    assert out.num_rows == 2 and not encoder.known_words and not encoder.pairs and not encoder.store.number
    assert bpe._encoder(content) is encoder  # the vocabulary stays


def test_spans_of_one_hash_are_told_apart(monkeypatch):
    data = np.frombuffer(b"aa bb aa cc bb", np.uint8)
    start, end = np.array([0, 3, 6, 9, 12]), np.array([2, 5, 8, 11, 14])
    for same in (False, True):
        if same:
            monkeypatch.setattr(bpe, "span_hash", lambda prefix, a, b: np.zeros(len(a), np.uint64))
        kinds, which = bpe.different_spans(data, start, end)
        strings = [data[start[k] : end[k]].tobytes() for k in kinds]
        assert [strings[k] for k in which] == [b"aa", b"bb", b"aa", b"cc", b"bb"] and len(set(strings)) == len(strings) == 3


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="the C library cannot be asked for it")
def test_freed_memory_goes_back_to_the_system():
    """A worker outlives its task: what a task has freed must not stay in the process."""
    code = """
import numpy as np, pyarrow as pa, re
from oreflow.llm.textbytes import slices

def held():
    with open("/proc/self/smaps_rollup") as file:
        return int(re.search(r"Rss:\\s+(\\d+)", file.read())[1]) >> 10

batches = [pa.RecordBatch.from_pydict({"text": ["x"]})]
list(slices(batches))
before = held()
parts = [np.ones(10_000) for _ in range(3000)]
last = np.ones(10_000)
del parts
list(slices(batches))
assert held() - before < 60, (before, held())
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[2])
