import pytest
from pyspark.sql import functions as F

from oreflow.operators.dimension import case_label, label_series

SERIES = "series_id STRING, sector_code STRING, class_code STRING, measure_code STRING, duration_code STRING, seasonal STRING"


@pytest.fixture
def lookups(spark):
    def table(code, text, data):
        return spark.createDataFrame(data, f"{code} STRING, {text} STRING")

    return {
        "sector_code": table("sector_code", "sector_name", [("3100 ", "Manufacturing")]),
        "measure_code": table("measure_code", "measure_text", [("01", "Labor productivity"), ("02", "")]),
        "duration_code": table("duration_code", "duration_text", [("1", "% change")]),
        "class_code": table("class_code", "class_text", [("3", "all persons")]),
    }


def label(spark, lookups, *codes):
    df = spark.createDataFrame([("PRS1  ", *codes)], SERIES)
    return label_series(df, lookups).first()["series_label"]


@pytest.mark.parametrize(
    "codes, text",
    [
        (("3100", "3", "01", "1", "S"), "Manufacturing: Labor productivity, % change, all persons, Seasonally Adjusted"),
        ((" 3100", "3 ", "01 ", " 1", "U "), "Manufacturing: Labor productivity, % change, all persons, Not Seasonally Adjusted"),
        (("9", "9", "9", "9", "Z"), "Unknown sector: Unknown measure, Z"),
        (("3100", None, "01", None, None), "Manufacturing: Labor productivity"),
        # a code without its zero is another code; an empty text is a part, a missing one is not
        (("3100", "3", "1", "1", None), "Manufacturing: Unknown measure, % change, all persons"),
        (("3100", None, "02", None, "S"), "Manufacturing: , Seasonally Adjusted"),
    ],
)
def test_label(spark, lookups, codes, text):
    assert label(spark, lookups, *codes) == text


def test_columns_and_unmatched_texts(spark, lookups):
    out = label_series(spark.createDataFrame([("a", "9", "9", "9", "9", "S")], SERIES), lookups)
    assert out.columns == [
        "series_id", "sector_code", "sector_name", "measure_code", "measure_text",
        "duration_code", "duration_text", "class_code", "class_text", "seasonal", "series_label",
    ]
    assert out.first()["sector_name"] is None


def test_case_label_passes_other_codes_through(spark):
    df = spark.createDataFrame([("S",), ("U",), ("x",), (None,)], "c STRING")
    assert [r[0] for r in df.select(case_label(F.col("c"))).collect()] == ["Seasonally Adjusted", "Not Seasonally Adjusted", "x", None]
