import json

import pytest

from oreflow import layouts
from oreflow.sources import (
    explode_records, header_drift, list_files, read_delimited, read_envelopes, read_lines, read_lookups, row_widths, with_lineage,
)

SCHEMA = layouts.text_schema(layouts.OBSERVATION_COLUMNS)


@pytest.fixture
def raw(tmp_path):
    (tmp_path / "pr.data.0.Current").write_text(
        "series_id        \tyear\tperiod\t       value\tfootnote_codes\nPRS1   \t1995\tQ01\t   1.0\t\nPRS1   \t1996\tQ01\t  -\tx\n"
    )
    (tmp_path / "pr.measure").write_text("measure_code\tmeasure_text\n01\tLabor productivity\n1\tOther\n")
    (tmp_path / "pr.txt").write_text("first line\n\n  third\n")
    (tmp_path / "moved").write_text("year\tseries_id\tperiod\tvalue\textra\n1\t2\t3\t4\t5\n")
    return tmp_path


def test_rows_stay_as_they_are(spark, raw, rows):
    got = rows(read_delimited(spark, str(raw / "pr.data.0.Current"), SCHEMA))
    assert got == [("PRS1   ", "1995", "Q01", "   1.0", None), ("PRS1   ", "1996", "Q01", "  -", "x")]


def test_glob_and_lineage(spark, raw):
    got = with_lineage(read_delimited(spark, str(raw), SCHEMA, glob="pr.data.0.*"), source_file=True).collect()
    assert len(got) == 2 and all(r._source_file.endswith("/pr.data.0.Current") and r._ingested_at for r in got)


def test_lookup_codes_keep_their_zeros(spark, raw):
    tables = read_lookups(spark, str(raw), ["pr.measure"])
    assert list(tables) == ["bronze_bls_pr_measure"]
    assert sorted(r.measure_code for r in tables["bronze_bls_pr_measure"].collect()) == ["01", "1"]


def test_lines(spark, raw):
    assert [r.line for r in read_lines(spark, str(raw / "pr.txt")).collect()] == ["first line", "", "  third"]


def test_drift_report(spark, raw):
    files = {"good": str(raw / "pr.data.0.Current"), "bad": str(raw / "moved")}
    got = {(r.file, r.column_name): r.status for r in header_drift(spark, files, layouts.OBSERVATION_COLUMNS).collect()}
    assert {s for (f, _), s in got.items() if f == "good"} == {"ok"}
    assert got[("bad", "series_id")] == got[("bad", "year")] == "moved"
    assert got[("bad", "footnote_codes")] == "missing" and got[("bad", "extra")] == "extra"


def test_strict_read_stops_on_drift(spark, raw):
    schema = layouts.text_schema(layouts.OBSERVATION_COLUMNS)
    with pytest.raises(Exception, match="CSV header"):
        read_delimited(spark, str(raw / "moved"), schema, strict=True).collect()


def test_row_widths(spark, raw, rows):
    assert rows(row_widths(spark, str(raw / "moved"))) == [(5, 2)]
    assert rows(row_widths(spark, str(raw / "moved"), skip_header_of="year")) == [(5, 1)]


def test_envelope_types_are_pinned(spark, tmp_path, rows):
    path = tmp_path / "population_latest.json"
    path.write_text(json.dumps({"data": [{"Year": "2013", "Nation": "US", "Population": 5}, {"Year": 2014, "Population": 6}]}, indent=2))
    (tmp_path / "empty.json").write_text('{"data": []}')
    (tmp_path / "null.json").write_text('{"data": null}')
    pinned = explode_records(read_envelopes(spark, str(tmp_path), layouts.POPULATION_RECORD))
    assert pinned.dtypes == [("Year", "string"), ("Nation", "string"), ("Population", "string")]
    assert rows(pinned) == [("2013", "US", "5"), ("2014", None, "6")]
    inferred = explode_records(read_envelopes(spark, str(path)))
    assert set(inferred.columns) == {"Year", "Nation", "Population"}


def test_listing(spark, raw):
    got = {r.file_name: r.size_bytes for r in list_files(spark, str(raw)).collect()}
    assert got["pr.measure"] == (raw / "pr.measure").stat().st_size and len(got) == 4
    assert [r.file_name for r in list_files(spark, str(raw), "pr.t*").collect()] == ["pr.txt"]
