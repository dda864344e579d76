import pytest

from oreflow.plans.landing_run import land_folder, load_manifest
from oreflow.sources.digests import content_digest, file_digests

VERSIONS = {
    "plain": b"a\tb\n1\t2\n3\t4\n",
    "header": b"a\tc\n1\t2\n3\t4\n",
    "order": b"a\tb\n3\t4\n1\t2\n",
    "encoding": "a\tb\n1\t2\n3\t4\n".encode("utf-16"),
    "mark": b"\xef\xbb\xbfa\tb\n1\t2\n3\t4\n",
    "ends": b"a\tb\r\n1\t2\r\n3\t4\r\n",
    "open": b"a\tb\n1\t2\n3\t4",
    "blank": b"\n",
    "bytes": b"\xff\xfe\x00\n\x80",
}


@pytest.mark.parametrize("large", [1 << 20, 0])
def test_every_change_of_bytes_shows(spark, tmp_path, large):
    for name, data in VERSIONS.items():
        (tmp_path / name).write_bytes(data)
    (tmp_path / "copy").write_bytes(VERSIONS["plain"])
    got = {r.file_name: r.digest for r in file_digests(spark, str(tmp_path), large=large).collect()}
    assert got["copy"] == got["plain"] and len(set(got.values())) == len(VERSIONS)
    some = file_digests(spark, str(tmp_path), ["plain", "open"], large=large).collect()
    assert {r.file_name: r.digest for r in some} == {k: got[k] for k in ("plain", "open")}


def test_large_files_do_not_depend_on_splits(spark, tmp_path):
    lines = [f"{i}\t{i * i}" for i in range(30_000)]
    (tmp_path / "f").write_text("\n".join(lines))
    (tmp_path / "g").write_text("\n".join([*lines[:20_000], lines[20_001], lines[20_000], *lines[20_002:]]))
    found = []
    for size in ("1g", "20k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found.append({r.file_name: r.digest for r in file_digests(spark, str(tmp_path), large=0, block_lines=1000).collect()})
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1] and found[0]["f"] != found[0]["g"]


def test_folders_of_part_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a INT, b STRING").repartition(2)
    df.write.csv(str(tmp_path / "one"))
    df.withColumnRenamed("b", "c").write.option("header", "true").csv(str(tmp_path / "two"))
    assert content_digest(spark, str(tmp_path / "one")) != content_digest(spark, str(tmp_path / "two"))


def test_a_header_only_revision_is_landed(spark, tmp_path):
    raw, landing, manifest = tmp_path / "raw", str(tmp_path / "landing"), str(tmp_path / "manifest")
    raw.mkdir()
    for number, version in enumerate(("plain", "header", "order", "encoding", "mark"), 1):
        (raw / "t.tsv").write_bytes(VERSIONS[version])
        (raw / "other.tsv").write_text("k\n1\n")
        land_folder(spark, str(raw), landing, manifest)
        log = spark.read.parquet(f"{landing}/_landed").collect()
        assert max(r.version for r in log if r.file_name == "t.tsv") == number
        assert max(r.version for r in log if r.file_name == "other.tsv") == 1
    assert load_manifest(spark, manifest).count() == 2
