"""The whole pipeline against a plain version over a small table, and the registered queries over the given tables."""

import hashlib
import re
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from oracle import compare, oracle_connection
from oreflow.llm import queries
from tests_of import contaminated, near_groups, removed

SF_DIR = "/root/testdata/sf0.001"


def rows():
    rng = np.random.default_rng(9)
    syllables = ["th", "er", "ción", "ñ", "ung", "éau", "ing", "os"]
    def words(n):
        return ["".join(rng.choice(syllables, int(rng.integers(1, 5)))) for _ in range(n)]
    items = [(i, " ".join(words(30))) for i in range(6)]
    docs = []
    passage = " ".join(words(20))
    for i in range(80):
        text = words(int(rng.integers(8, 90)))
        if i % 9 == 0:
            text[3:3] = items[i % 6][1].split()
        if i % 7 == 0:
            text[5:5] = passage.split()
        docs.append((i * 3 + 1, " ".join(text), ["en", "es"][i % 2], "src", 0))
    for k, (doc_id, text, *rest) in enumerate(docs[:20]):
        near = text.split()
        near[len(near) // 2] = f"changed{k}"
        docs.append((1000 - k, " ".join(near) if k % 2 else text, *rest))
    docs += [(5000, None, "en", "s", 0), (5001, "", "en", "s", 0), (5002, "12 34", "en", "s", 0), (None, "the words of nobody", None, None, None)]
    docs += [(5003, "z " * 400, "en", "s", 3), (5004, "z " * 100 + "q", "en", None, 3), (5005, "ñ" * 60, None, "s", 3), (5006, "xñ" + "ñ" * 59 + "y", None, "s", 3)]
    return [(a, b, c, d, len(b or "")) for a, b, c, d, _ in docs], items


def plain(docs, items):
    """Stage by stage, pair by pair and byte by byte."""
    kept = [d for d in docs if d[1] and any(c.isalpha() for c in d[1])]
    group = near_groups([(d[0], d[1]) for d in kept], 5, 80)
    kept = [d for d, low in zip(kept, group) if d[0] is None or d[0] == low]
    texts = removed([(d[0], d[1]) for d in kept])
    kept = [(d[0], t, *d[2:4], len(t) if t != d[1] else d[4]) for d, t in zip(kept, texts) if t]
    kept = [d for d in kept if not contaminated(d[1], items)]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for d in kept:
        ids = library.encode(d[1], add_special_tokens=False).ids
        out.append((d[0], d[2], d[3], d[4], len(ids), tuple(ids), library.decode(ids, skip_special_tokens=False)))
    return sorted(out, key=str)


def write_tables(folder, docs, items):
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])
    pq.write_table(pa.Table.from_pylist([dict(zip(schema.names, d)) for d in docs], schema), f"{folder}/documents.parquet")
    schema = pa.schema([("item_id", pa.int64()), ("text", pa.string())])
    pq.write_table(pa.Table.from_pylist([dict(zip(schema.names, i)) for i in items], schema), f"{folder}/benchmark.parquet")


def test_pipeline_like_the_plain_version(spark, tmp_path):
    docs, items = rows()
    write_tables(tmp_path, docs, items)
    found = corpus_pipeline.run(spark, str(tmp_path))
    got = sorted(((*r[:5], tuple(r["ids"]), r["decoded"]) for r in found.collect()), key=str)
    want = plain(docs, items)
    assert got == want and 0 < len(want) < len(docs)


def test_stages(spark, tmp_path):
    assert len(corpus_pipeline.STAGES) in (4, 5)
    write_tables(tmp_path, [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    docs, items = rows()
    write_tables(tmp_path, docs, items)
    odd = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name in ("kept", "n_words", "lang_pred", "component_id", "bucket"):
        odd = odd.selectExpr("*", f"1 AS {name}")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, str(tmp_path))
        assert out.columns == list(corpus_pipeline.COLUMNS) and out.count() > 0


def test_different_texts_of_one_id_stay(spark):
    long = " ".join(f"word{i}" for i in range(60))
    rows_ = [
        (1, "b c d e f g", "en", "s", 1), (1, "a c d e f g", "en", "s", 1), (1, None, "en", "s", None), (1, "", "en", "s", 0),
        (2, "x y", None, None, None), (2, "x y", None, None, None), (7, long, "en", "s", 1), (7, "of its own", "en", "s", 1),
        (8, long + " more", "en", "s", 1), (3, long, "de", "s", 1), (3, "unlike the others", "de", "s", 1), (None, "p q", "en", "s", 1),
        (None, "p q", "en", "s", 1),
    ]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted((tuple(r) for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()), key=str)
    gone = [rows_[5], rows_[6], rows_[8]]  # an equal row, and two that are linked with a smaller id
    want = list(rows_)
    for row in gone:
        want.remove(row)
    assert kept == sorted(want, key=str)


@pytest.mark.parametrize("lang", [None, "und"])
def test_texts_stay_where_no_language_is_learnt(spark, lang):
    rows_ = [(i, f"some words of text {i}", lang, "s", 1) for i in range(10)] + [(20, None, lang, "s", 0), (21, "12 34", lang, "s", 5)]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, lang string, source string, n_chars long")
    assert {tuple(r) for r in corpus_pipeline.known_language(spark, docs, "").collect()} == set(rows_[:10])


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")
class TestQueries:
    def test_one_per_operator(self):
        names = entry.queries()
        assert all(sum(bool(re.match(rf"op{n}_", q)) for q in names) == 1 for n in range(1, 14)) and "pipeline" in names
        assert set(queries.ORACLES) <= set(queries.QUERIES)

    @pytest.mark.parametrize("name", queries.ORACLES)
    def test_against_sql(self, spark, name):
        seen, faults = compare(spark, oracle_connection(SF_DIR), SF_DIR, queries.QUERIES[name], queries.ORACLES[name])
        assert not faults and seen > 0

    @pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLES])
    def test_returns_every_row(self, spark, name):
        rows_ = pq.read_metadata(f"{SF_DIR}/documents.parquet").num_rows  # op11 to op13 have SQL
        assert queries.QUERIES[name](spark, SF_DIR).count() == rows_

    def test_tokens_like_the_library(self, spark):
        library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
        docs = dict(zip(*pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"]).to_pydict().values()))
        for r in queries.op5_bpe(spark, SF_DIR).collect():
            ids = library.encode(docs[r["doc_id"]] or "", add_special_tokens=False).ids
            sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
            want = (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
            assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == want
