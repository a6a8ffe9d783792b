"""Column lists and constants of the weather data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: field names, in file order, of a headerless station bulletin ----
DIGEST_FIELDS = [
    "Comment", "Date", "MinTemp", "MaxTemp", "Rainfall", "Evaporation", "Sunshine",
    "WindGustDir", "WindGustSpeed", "Time of maximum wind gust", "Temp9am", "Humidity9am",
    "Cloud9am", "WindDir9am", "WindSpeed9am", "Pressure9am", "Temp3pm", "Humidity3pm",
    "Cloud3pm", "WindDir3pm", "WindSpeed3pm", "Pressure3pm",
]

# ---- fixed values: columns of the daily table, in output order ----
DAILY_COLUMNS = [
    "Date", "Location", "MinTemp", "MaxTemp", "Rainfall", "Evaporation", "Sunshine",
    "WindGustDir", "WindGustSpeed", "WindDir9am", "WindDir3pm", "WindSpeed9am", "WindSpeed3pm",
    "Humidity9am", "Humidity3pm", "Pressure9am", "Pressure3pm", "Cloud9am", "Cloud3pm",
    "Temp9am", "Temp3pm", "RainToday", "RainTomorrow",
]

# ---- fixed values: columns whose outliers are capped ----
CAPPED_COLUMNS = [
    "MinTemp", "MaxTemp", "Rainfall", "Evaporation", "WindGustSpeed", "WindSpeed9am",
    "WindSpeed3pm", "Humidity9am", "Pressure9am", "Pressure3pm", "Temp9am", "Temp3pm",
]

# ---- fixed values: text columns and model settings ----
WIND_DIRECTIONS = ["WindGustDir", "WindDir9am", "WindDir3pm"]
WIND_SPEEDS = ["WindSpeed9am", "WindSpeed3pm"]
RAIN_MM = 1.0
IQR_FACTOR = 1.5
OVERSAMPLE_SEED = 123
TEST_SHARE = 0.2
STRATIFIED_SEED = 42
FOREST = {"numTrees": 100, "maxDepth": 5, "seed": 42}
BASELINE_FOREST = {"numTrees": 40, "impurity": "entropy", "maxDepth": 30}
TREE_GRID = [1, 5, 9, 13, 15, 19, 22]
FOLDS = 5
MIN_GAIN = 0.01
MONTHS_BACK = 14
UNSCALED_DROP = ["MinTemp", "Temp9am"]
MODEL_NAME = "RandomForestClassifier"
VERSION_METRICS = ["accuracy", "precision", "recall", "f1_score", "mae", "mse", "rmse"]
BULLETIN_URL = "https://reg.bom.gov.au/climate/dwo/%2$s/text/%1$s.%2$s.csv"
ID_PAGE_START, ID_PAGE_END = "URL=/climate/dwo/", ".latest"

LABEL = "RainTomorrow"
STAMP = "ingestion_date"
CATEGORICAL = ["Location", *WIND_DIRECTIONS, *WIND_SPEEDS]
KEPT_FIELDS = [c for c in DAILY_COLUMNS if c in DIGEST_FIELDS]
MEASURES = [c for c in KEPT_FIELDS if c not in ("Date", *WIND_DIRECTIONS, *WIND_SPEEDS)]
CLEAN_COLUMNS = [c for c in DAILY_COLUMNS if c != "Date"] + ["Year", "Month", "Day"]
CLEAN_KEYS = ["Location", "Year", "Month", "Day"]


def text_schema(names: list[str]) -> T.StructType:
    """All-string schema: types are decided later, by explicit casts."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


DIGEST_SCHEMA = text_schema(DIGEST_FIELDS)
STATION_SCHEMA = text_schema(["Code", "Location", "Climat"])
DATA_ID_SCHEMA = text_schema(["station_id", "data_id"])
MAPPING_SCHEMA = T.StructType(
    [T.StructField("Location_Name", T.StringType()), T.StructField("Location_Code", T.IntegerType())]
)
DAILY_SCHEMA = T.StructType(
    [T.StructField("Date", T.DateType())]
    + [
        T.StructField(c, T.DoubleType() if c in MEASURES else T.StringType())
        for c in DAILY_COLUMNS[1:]
    ]
)
