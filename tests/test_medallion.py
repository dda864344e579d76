"""The whole run, from a folder of raw files to verified gold tables."""

import json

import pytest

from oreflow import layouts
from oreflow.functions.text import trimmed
from oreflow.plans.batch_run import run_batch
from oreflow.plans.landing_run import land_folder, load_manifest
from oreflow.plans.medallion import Warehouse, require_unique, run_all, run_bronze, run_silver
from oreflow.operators import analytics
from oreflow.plans import medallion
from oreflow.sinks.publish import ExpectationFailed
from oreflow.sinks.tables import table_comments

OBS_HEADER = "series_id        \tyear\tperiod\t       value\tfootnote_codes"


def write_raw(folder, observations):
    folder.mkdir(exist_ok=True)
    lines = [OBS_HEADER] + ["\t".join([s.ljust(17), str(y), p, str(v).rjust(12), ""]) for s, y, p, v in observations]
    (folder / layouts.CURRENT_FILE).write_text("\n".join(lines) + "\n")
    (folder / layouts.ALL_DATA_FILE).write_text("\n".join(lines) + "\n")


def write_fixed(folder):
    series = ["\t".join(layouts.SERIES_COLUMNS)]
    for sid, sector in (("PRS30006032", "3100"), ("PRS2", "9999")):
        series.append("\t".join([sid.ljust(17), sector, "3", "01", "1", "S", "2017", "", "1995", "Q01", "2018", "Q04"]))
    (folder / layouts.SERIES_FILE).write_text("\n".join(series) + "\n")
    texts = {
        "sector": "sector_code\tsector_name\n3100\tManufacturing",
        "class": "class_code\tclass_text\n3\tall persons",
        "measure": "measure_code\tmeasure_text\n01\tLabor productivity",
        "duration": "duration_code\tduration_text\n1\t% change",
        "seasonal": "seasonal_code\tseasonal_text\nS\tadjusted",
        "footnote": "footnote_code\tfootnote_text\nr\trevised",
        "period": "period\tperiod_abbr\nQ01\tQTR1",
    }
    for kind, text in texts.items():
        (folder / f"pr.{kind}").write_text(text + "\n")
    (folder / layouts.NOTES_FILE).write_text("Survey notes\n\nSection 1\n")


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("world")
    raw, population = base / "raw", base / "population"
    observations = [("PRS30006032", y, f"Q0{q}", y - 2000 + q) for y in range(2012, 2015) for q in range(1, 5)]
    observations += [("PRS30006032", 2012, "Q05", 9999), ("PRS2", 2013, "Q01", "-"), ("PRS3", 2013, "Q01", 5), ("PRS3", 2013, "X01", 5)]
    write_raw(raw, observations)
    write_fixed(raw)
    population.mkdir()
    records = [{"Year": str(y), "Nation": "United States", "Population": 300 + y} for y in range(2013, 2019)]
    (population / layouts.POPULATION_FILE).write_text(json.dumps({"data": records}, indent=2))
    house = Warehouse(spark, str(base / "house"))

    def land():
        return [
            land_folder(spark, str(folder), str(base / "landing" / folder.name), str(base / "manifest" / folder.name)).first().asDict()
            for folder in (raw, population)
        ]

    return {
        "land": land, "house": house, "raw": raw, "population": population, "observations": observations,
        "landing": (str(base / "landing" / "raw"), str(base / "landing" / "population")), "manifest": str(base / "manifest" / "raw"),
    }


def gold(house, table, *columns):
    df = house.read("gold", table)
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_first_run(spark, world):
    house = world["house"]
    files, population = world["land"]()
    assert files == {"remote_file_count": 11, "already_current": 0, "downloaded": 11, "failed": 0, "removed": 0}
    run_all(house, *world["landing"])
    assert house.bronze("bronze_bls_data").count() == len(world["observations"])
    assert [r.line for r in house.bronze("bronze_bls_pr_txt").collect()] == ["Survey notes", "", "Section 1"]
    assert house.bronze("bronze_bls_pr_measure").first()["measure_code"] == "01"
    assert house.read("silver", "silver_bls_data").count() == len(world["observations"]) - 1
    assert gold(house, "gold_population_stats", "years_included", "mean_population") == [(6, 2315.5)]
    assert gold(house, "gold_bls_best_year_per_series") == [
        ("PRS2", "Unknown sector: Labor productivity, % change, all persons, Seasonally Adjusted", 2013, None),
        ("PRS3", "Unknown series: PRS3", 2013, 5.0),
        ("PRS30006032", "Manufacturing: Labor productivity, % change, all persons, Seasonally Adjusted", 2014, 66.0),
    ]
    assert gold(house, "gold_prs30006032_q01_population") == [(2012, 13.0, None), (2013, 14.0, 2313), (2014, 15.0, 2314)]
    assert [gold(house, f"gold_verification_q{n}") for n in (1, 2, 3)] == [[(0,)]] * 3


def test_rules_of_every_layer_are_counted(spark, world):
    house = world["house"]
    counts = {r.rule: (r.action, r.rows, r.violations) for r in house.bronze_counts("bronze_bls_data").collect()}
    n = len(world["observations"])
    assert counts == {
        "has_series_id": ("drop", n, 0), "has_year": ("drop", n, 0), "has_period": ("drop", n, 0), "has_value": ("warn", n, 0),
    }
    silver = {r.rule: (r.action, r.rows, r.violations) for r in house.history("silver", "silver_bls_data").collect()}
    assert silver["valid_period"] == ("drop", n, 1) and silver["has_value"] == ("warn", n - 1, 1)
    answers = {r.rule: r.violations for r in house.history("gold", "gold_bls_best_year_per_series").collect()}
    assert answers["one_row_per_series"] == 0 == answers["series_and_year_known"]


def test_tables_are_described_in_the_catalog(spark, world):
    house = world["house"]
    house.describe("gold", "gold_population_stats", "described_stats")
    house.describe("bronze", "bronze_bls_data", "described_bronze")
    said = {(r.table_name, r.column_name): r.comment for r in table_comments(spark, ["described_stats", "described_bronze"]).collect()}
    assert said[("described_stats", "mean_population")] == layouts.COLUMN_COMMENTS["mean_population"]
    assert said[("described_bronze", None)] == layouts.TABLE_COMMENTS["bronze_bls_data"]


def test_second_run_without_changes_adds_nothing(spark, world):
    house = world["house"]
    files, _ = world["land"]()
    assert files["already_current"] == 11 and files["downloaded"] == 0
    before = house.bronze("bronze_bls_data").count()
    run_bronze(house, *world["landing"])
    assert house.bronze("bronze_bls_data").count() == before
    assert load_manifest(spark, world["manifest"]).count() == 11


def test_rejected_rows_are_kept_on_request(spark, world):
    run_silver(world["house"], keep_rejected=True)
    rejected = world["house"].read("silver", "silver_bls_data_rejected").collect()
    assert [(r.series_id, r.period, r.failed_rules) for r in rejected] == [("PRS3", "X01", ["valid_period"])]


def test_batch_variant_gives_the_same_gold(spark, world, tmp_path):
    house = Warehouse(spark, str(tmp_path / "batch"))
    run_batch(house, str(world["raw"]), str(world["population"]))
    for table in ("gold_population_stats", "gold_bls_best_year_per_series", "gold_prs30006032_q01_population"):
        assert gold(house, table) == gold(world["house"], table)
    assert house.read("bronze_batch", "bronze_bls_pr_measure").first()["measure_code"] == "01"


def test_repeated_lookup_codes_stop_the_run(spark, world):
    doubled = spark.createDataFrame([("3100", "a"), ("3100 ", "b")], "sector_code STRING, sector_name STRING")
    with pytest.raises(ValueError, match="sector_code repeats the keys .*3100"):
        require_unique(doubled.select(trimmed("sector_code")), ["sector_code"], "the lookup of sector_code")


def test_revision_replaces_values_and_removes_keys(spark, world):
    house = world["house"]
    revised = [(s, y, p, 100 if (y, p) == (2012, "Q01") else v) for s, y, p, v in world["observations"] if s != "PRS3"]
    write_raw(world["raw"], revised)
    files, _ = world["land"]()
    assert files["downloaded"] == 2 and files["already_current"] == 9
    run_all(house, *world["landing"])
    assert house.bronze("bronze_bls_data").count() == len(world["observations"]) + len(revised)
    assert gold(house, "gold_prs30006032_q01_population")[0] == (2012, 100.0, None)
    assert gold(house, "gold_bls_best_year_per_series", "series_id", "best_year") == [("PRS2", 2013), ("PRS30006032", 2012)]


def test_missing_year_stops_the_run(spark, world):
    with pytest.raises(ExpectationFailed, match="has_all_years"):
        run_all(world["house"], *world["landing"], start=2013, end=2020)
    assert gold(world["house"], "gold_population_stats", "end_year") == [(2018,)]


def test_a_broken_cardinality_stops_the_run(spark, world, monkeypatch):
    doubled = lambda *args: analytics.best_period(*args).unionAll(analytics.best_period(*args))
    monkeypatch.setattr(medallion.questions_sql, "best_period_sql", doubled)
    with pytest.raises(ExpectationFailed, match="one_row_per_series"):
        run_all(world["house"], *world["landing"])
