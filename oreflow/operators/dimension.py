"""Series dimension: left joins to lookups and a readable label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.functions.text import trimmed
from oreflow.layouts import SEASONAL_TEXT, UNKNOWN_MEASURE, UNKNOWN_SECTOR

# --- fixed values: code column of each lookup and its text column ---
LOOKUP_TEXT = {
    "sector_code": "sector_name",
    "measure_code": "measure_text",
    "duration_code": "duration_text",
    "class_code": "class_text",
}


def case_label(code: Column, texts: dict[str, str] = SEASONAL_TEXT) -> Column:
    """Text of a code; a code without one is shown as it is."""
    (first_code, first_text), *others = texts.items()
    label = F.when(code == first_code, first_text)
    for other_code, text in others:
        label = label.when(code == other_code, text)
    return label.otherwise(code)


def series_label() -> Column:
    """``sector: measure, duration, class, season``; NULL parts are skipped, empty ones are not."""
    detail = F.concat_ws(
        ", ",
        F.coalesce("measure_text", F.lit(UNKNOWN_MEASURE)),
        "duration_text",
        "class_text",
        case_label(F.col("seasonal")),
    )
    return F.concat_ws(": ", F.coalesce("sector_name", F.lit(UNKNOWN_SECTOR)), detail)


def label_series(series: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
    """Series codes with their texts and a label.

    ``lookups`` maps a code column to the table that holds it and its text.
    No join is forced to broadcast: Spark does so below the session's size
    threshold, and beyond it shuffles and splits codes with very many rows.
    """
    labelled = series.select(*[trimmed(c) for c in ("series_id", *LOOKUP_TEXT, "seasonal")])
    for code, text in LOOKUP_TEXT.items():
        labelled = labelled.join(lookups[code].select(trimmed(code), text), code, "left")
    coded = [name for code, text in LOOKUP_TEXT.items() for name in (code, text)]
    return labelled.select("series_id", *coded, "seasonal", series_label().alias("series_label"))
