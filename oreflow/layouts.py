"""Raw file layouts, code lists and messages of the data model.

These must equal the published formats, so they are stated as plain text.
"""

# --- fixed values: raw columns, all text ---
OBSERVATION_COLUMNS = ["series_id", "year", "period", "value", "footnote_codes"]
SERIES_COLUMNS = [
    "series_id", "sector_code", "class_code", "measure_code", "duration_code", "seasonal",
    "base_year", "footnote_codes", "begin_year", "begin_period", "end_year", "end_period",
]

# --- fixed values: file names of the published folder ---
CURRENT_FILE = "pr.data.0.Current"
ALL_DATA_FILE = "pr.data.1.AllData"
SERIES_FILE = "pr.series"
NOTES_FILE = "pr.txt"
POPULATION_FILE = "population_latest.json"
LOOKUP_FILES = [
    "pr.sector", "pr.class", "pr.measure", "pr.duration", "pr.seasonal", "pr.footnote", "pr.period",
]

# --- fixed values: codes, ranges, patterns ---
QUARTERS = ["Q01", "Q02", "Q03", "Q04"]
PERIOD_PATTERN = "^Q0[1-5]$"
FIRST_YEAR, LAST_YEAR = 1900, 2100
SEASONAL_TEXT = {"S": "Seasonally Adjusted", "U": "Not Seasonally Adjusted"}

# --- fixed values: texts shown where a label is missing ---
UNKNOWN_SECTOR = "Unknown sector"
UNKNOWN_MEASURE = "Unknown measure"
UNKNOWN_SERIES = "Unknown series: "

# --- fixed values: characters a column name may not hold ---
FORBIDDEN_NAME_CHARACTERS = " ,;{}()\n\t=%-?"

# --- fixed values: envelope record fields that are pinned to text ---
POPULATION_RECORD = "Year STRING, Nation STRING, Population STRING"
# --- fixed values: the names under which a record may give them ---
POPULATION_FIELDS = {
    "Year": ("Year", "ID Year", "ID_Year"),
    "Nation": ("Nation", "ID Nation", "Nation ID", "ID_Nation", "Nation_ID"),
    "Population": ("Population",),
}

# --- fixed values: questions asked of the gold layer ---
STATS_START, STATS_END = 2013, 2018
CONTEXT_SERIES, CONTEXT_PERIOD = "PRS30006032", "Q01"

# --- texts that the catalog shows of tables and columns ---
TABLE_COMMENTS = {
    "bronze_bls_data": "observations of the current file as they came, every version",
    "bronze_bls_data_alldata": "observations of the full file as they came, kept for audits",
    "bronze_bls_series": "one line per series with its codes, as they came",
    "bronze_bls_pr_txt": "the notes, line by line",
    "bronze_population": "population records with the fields they came with",
    "silver_bls_data": "typed observations, one row per series, year and period",
    "silver_bls_series": "series with a label made of their codes' texts",
    "silver_population": "typed population, one row per year",
    "gold_population_stats": "mean and deviations of the yearly population over a range of years",
    "gold_bls_best_year_per_series": "the year with the largest sum of quarters, per series",
}
COLUMN_COMMENTS = {
    "series_id": "identifier of a time series",
    "series_label": "sector, measure, duration, class and season in words",
    "year": "calendar year",
    "period": "quarter Q01 to Q04, or Q05 for the average of the year",
    "value": "observed value, NULL where it is not known",
    "footnote_codes": "codes of the notes on a value",
    "population": "inhabitants",
    "nation": "country of the count",
    "best_year": "year with the largest sum",
    "best_year_summed_value": "the sum of that year",
    "mean_population": "mean over the years",
    "_source_file": "path of the file a row came from",
    "_ingested_at": "time at which a row was read",
}


def text_schema(columns: list[str]) -> str:
    """DDL with every column as STRING, so that codes such as 01 keep their zeros."""
    return ", ".join(f"`{name}` STRING" for name in columns)
