import json

import pytest
from pyspark.sql import functions as F

from oreflow.plans import landing_run
from oreflow.plans.landing_run import LandingFailed, land_folder, load_manifest
from oreflow.sources import header_drift, require_headers
from oreflow.sources.listing import list_files


@pytest.fixture
def places(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    return raw, str(tmp_path / "landing"), str(tmp_path / "manifest")


def known(spark, manifest):
    return {r.file_name: r.size_bytes for r in load_manifest(spark, manifest).collect()}


def landed(spark, landing, name):
    return [r[0] for r in spark.read.text(f"{landing}/{name}__*").collect()]


def test_bad_files_stay_out_and_the_others_go_on(spark, places):
    raw, landing, manifest = places
    (raw / "a.tsv").write_text("x\ty\n1\t2\n")
    (raw / "b.tsv").write_text("x\ty\n1\t2\t3\n")
    (raw / "c.json").write_text(json.dumps({"error": "quota"}))
    (raw / "d.json").write_text(json.dumps({"data": [{"v": 1}]}))
    (raw / "e.json").write_text(json.dumps({"data": []}))
    with pytest.raises(LandingFailed) as stopped:
        land_folder(spark, str(raw), landing, manifest)
    assert {name for name, _ in stopped.value.failed} == {"b.tsv", "c.json", "e.json"}
    assert stopped.value.summary["downloaded"] == 2 and stopped.value.summary["failed"] == 3
    assert set(known(spark, manifest)) == {"a.tsv", "d.json"} and landed(spark, landing, "a.tsv") == ["x\ty", "1\t2"]
    (raw / "b.tsv").write_text("x\ty\n1\t2\n")
    for name in ("c.json", "e.json"):
        (raw / name).write_text(json.dumps({"data": [{"v": 2}]}))
    assert land_folder(spark, str(raw), landing, manifest).first()["downloaded"] == 3
    assert land_folder(spark, str(raw), landing, manifest).first()["downloaded"] == 0


def test_a_revision_during_the_run_is_seen_by_the_next(spark, places, monkeypatch):
    raw, landing, manifest = places
    (raw / "a.tsv").write_text("x\n1\n")
    plain = landing_run.land_snapshot

    def revised(*args, **kinds):
        done = plain(*args, **kinds)
        (raw / "a.tsv").write_text("x\n1\n2\n")
        return done

    monkeypatch.setattr(landing_run, "land_snapshot", revised)
    land_folder(spark, str(raw), landing, manifest)
    assert known(spark, manifest) == {"a.tsv": 4}
    monkeypatch.setattr(landing_run, "land_snapshot", plain)
    assert land_folder(spark, str(raw), landing, manifest).first()["downloaded"] == 1
    assert known(spark, manifest) == {"a.tsv": 6} and sorted(landed(spark, landing, "a.tsv")) == ["1", "1", "2", "x", "x"]


def test_folders_below_are_not_listed(spark, places):
    raw, landing, manifest = places
    (raw / "a.tsv").write_text("x\n1\n")
    (raw / "sub").mkdir()
    (raw / "sub" / "a.tsv").write_text("x\n1\n2\n")
    assert [r.file_name for r in list_files(spark, str(raw)).collect()] == ["a.tsv"]
    assert land_folder(spark, str(raw), landing, manifest).first()["remote_file_count"] == 1


def test_headers_of_every_part_file(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.csv").write_text("code \ttext\n1\tone\n")
    assert require_headers(spark, str(tmp_path / "t")) == ["code", "text"]
    (tmp_path / "t" / "b.csv").write_text("text\tcode\none\t1\n")
    with pytest.raises(ValueError, match="differ"):
        require_headers(spark, str(tmp_path / "t"))
    drift = header_drift(spark, {"t": str(tmp_path / "t")}, ["code", "text"])
    status = {(r.part_file.rsplit("/", 1)[1], r.column_name): r.status for r in drift.filter(F.col("file") == "t").collect()}
    assert status == {("a.csv", "code"): "ok", ("a.csv", "text"): "ok", ("b.csv", "code"): "moved", ("b.csv", "text"): "moved"}
