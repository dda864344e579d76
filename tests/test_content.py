import hashlib

from pyspark.sql import functions as F

from oreflow.operators.content import content_latest, content_versions, envelope_records, envelope_status


def test_versions_are_distinct_contents(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, "")], "v INT, body STRING")
    got = rows(content_versions(df, "body", "v"), "content_hash", "first_version", "copies")
    digest = {t: hashlib.sha256(t.encode()).hexdigest()[:16] for t in ("a", "b", "")}
    assert got == sorted([(digest["a"], 1, 2), (digest["b"], 2, 1), (digest[""], 5, 1)])
    known = spark.createDataFrame([("a",)], "stored STRING")
    assert {r[1] for r in rows(content_versions(df, "body", "v", known, "stored"), "content_hash", "first_version")} == {2, 5}


def test_latest_follows_version_not_arrival(spark, rows):
    df = spark.createDataFrame([("f", 2, "new"), ("f", 1, "old"), ("g", 1, "only")], "f STRING, v INT, body STRING")
    assert rows(content_latest(df, "f", "v", "body"), "f", "v", "body") == [("f", 2, "new"), ("g", 1, "only")]


def test_envelope(spark):
    payloads = {
        '{"data": [{"Year": "2013", "Nation": "United States", "Population": 316128839}]}': ("ok", 1),
        '{"unexpected": []}': ("missing", None),
        '{"data": []}': ("empty", 0),
        '{"data": {"Year": "2013"}}': ("not an array", None),
        '{"data": "text"}': ("not an array", None),
        '{"data": null}': ("missing", None),
        "not json": ("missing", None),
        "[]": ("missing", None),
    }
    df = spark.createDataFrame([(p,) for p in payloads], "p STRING")
    got = {r[0]: (r[1], r[2]) for r in df.select("p", envelope_status(F.col("p")), envelope_records(F.col("p"))).collect()}
    assert got == payloads
