"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input.

Every stage takes (spark, docs, sf_dir) and judges all that its predecessor kept.
All but the last return the columns of documents. Columns of other names are
left out; missing texts are null texts.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.llm import bpe, decontamination, language_id, ngram_join, suffix_dedup
from oreflow.llm.ngram_join import Similarity
from oreflow.llm.shared import table, typed
from oreflow.session import work_dir

COLUMNS = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
#: Near duplicates: shingles of five words, Jaccard similarity of 0.8 or more.
NEAR = Similarity(words=5, numerator=80, denominator=100)
TOKENIZER = "word_bpe_49k.json"
#: Language profiles, byte-wise repeats and the tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*[typed(docs, name, kind) for name, kind in COLUMNS.items()])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told (``und``: a null text or one without a letter) go."""
    docs = _documents(docs)
    learnt = {name: x for name, x in language_id.train_prototypes(docs).items() if name != language_id.UNKNOWN and np.any(x)}
    # where no language is learnt, one for all tells texts with a letter from others
    found = language_id.predict_language(docs, learnt or {"any": np.ones(language_id.DIMENSIONS)}, keys=tuple(COLUMNS))
    return found.filter(F.col("lang_pred") != language_id.UNKNOWN).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near-equal word sequences the one with the smallest id stays.

    Rows that repeat an id are documents of their own here: each is linked under a key
    made of all its columns, and goes only if it is linked with one that stays. Of
    rows that are equal in every column one stays; rows without an id are in no
    group and all stay.
    """
    docs = _documents(docs)
    several = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id")
    path = work_dir(spark, "repeated-ids")
    several.write.parquet(path)
    several = spark.read.schema("doc_id bigint").parquet(path)
    if several.isEmpty():  # then ids are keys already
        rows, repeated = docs.withColumn("row_id", F.col("doc_id")), None
    else:
        single = docs.join(several, "doc_id", "left_anti").withColumn("row_id", F.col("doc_id"))
        # nulls are hashed as such: the hash passes over them
        own = F.xxhash64(*COLUMNS, *[F.col(c).isNull() for c in COLUMNS])
        once = docs.join(several, "doc_id", "left_semi").withColumn("row_id", own).dropDuplicates(["row_id"])
        path = work_dir(spark, "rows-with-keys")  # the join below reads the texts several times
        single.unionByName(once).write.parquet(path)
        rows = spark.read.schema(single.schema).parquet(path)
        repeated = rows.filter("row_id <> doc_id").select("row_id", "doc_id")
    linked = ngram_join.link_documents(rows.select(F.col("row_id").alias("doc_id"), "text"), NEAR).filter("doc_id IS NOT NULL")
    ids = linked.select(F.col("doc_id").alias("row_id"), "component_id")
    ids = ids.withColumn("doc_id", F.col("row_id")) if repeated is None else ids.join(repeated, "row_id", "left")
    named = ids.select("row_id", "component_id", F.struct(F.coalesce("doc_id", "row_id").alias("doc_id"), "row_id").alias("place"))
    first = named.groupBy("component_id").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    gone = named.join(first, "component_id").filter("row_id <> first.row_id").select("row_id")
    path = work_dir(spark, "linked-rows")  # of a written table Spark knows the size: below its threshold no text is shuffled
    gone.write.parquet(path)
    gone = spark.read.schema("row_id bigint").parquet(path)
    return rows.join(gone, "row_id", "left_anti").select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings that an earlier document has go; so does a document of which nothing is left.

    Bytes of a character that was cut in two go as well, and n_chars is counted anew where bytes went.
    """
    docs = _documents(docs)
    judged = suffix_dedup.remove_repeats(docs, keys=("doc_id", "lang", "source", "n_chars"), as_text=True)
    cut = F.size("removed_starts") > 0
    text = F.when(F.col("n_bytes") > 0, F.col("kept"))  # nothing told a null text from an empty one
    return judged.filter(~cut | (F.col("kept") != "")).select(
        "doc_id", text.alias("text"), "lang", "source",
        F.when(cut, F.length("kept").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go: hits of test items on a twentieth of the words or more. The others stay as they are."""
    docs = _documents(docs)
    hits = decontamination.benchmark_hits(docs, table(spark, sf_dir, "benchmark"), keys=tuple(COLUMNS))
    return decontamination.judged(hits).filter(~F.col("contaminated")).select(*COLUMNS)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, their number, and the text that these ids decode to."""
    docs = _documents(docs)
    encoded = bpe.encode_documents(docs, public_tokenizers.path(TOKENIZER), keys=("doc_id", "lang", "source", "n_chars"))
    return encoded.select("doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard_join", one_of_each_group),
    ("suffix_array_dedup", without_repeats),
    ("benchmark_decontamination", without_test_items),
    ("bpe_encoding", as_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
