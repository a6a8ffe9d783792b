"""Bulletins to labelled daily observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from petrichor.functions.dates import parse_day
from petrichor.functions.rain import rain_flag
from petrichor.functions.text import to_double
from petrichor.operators.joins import lookup_join
from petrichor.operators.windows import next_in_group
from petrichor.schemas import DAILY_COLUMNS, KEPT_FIELDS, MEASURES


def station_dim(stations: DataFrame, ids: DataFrame) -> DataFrame:
    """Stations with their data id: (station_id, Location, ..., data_id)."""
    return stations.withColumnRenamed("Code", "station_id").join(ids, "station_id", "left")


def typed(digest: DataFrame) -> DataFrame:
    """The kept fields with a date and doubles; wind speeds stay text, they may hold a word."""
    cast = {"Date": parse_day(F.col("Date"))} | {c: to_double(F.col(c)) for c in MEASURES}
    extra = [c for c in ("data_id", "period", "issue", "arrived") if c in digest.columns]
    return digest.select(*extra, *[cast.get(c, F.col(c)).alias(c) for c in KEPT_FIELDS])


def located(digest: DataFrame, dim: DataFrame, unknown: str = "error") -> DataFrame:
    """Attach Location by data id. An unknown id fails, or with ``unknown='drop'`` its rows go."""
    ids = dim.select("data_id", "Location").where(F.col("data_id").isNotNull())
    if unknown == "drop":
        return lookup_join(digest, ids, ["data_id"], "inner")
    if unknown != "error":
        raise ValueError(f"unknown treatment of unknown ids {unknown!r}")
    failure = F.raise_error(F.concat(F.lit("no station for data id "), F.col("data_id")))
    found = lookup_join(digest, ids, ["data_id"])
    return found.withColumn("Location", F.coalesce("Location", failure.cast("string")))


def label_rain(rows: DataFrame, label_scope: str = "file", file_keys: tuple[str, ...] = ("data_id", "period")) -> DataFrame:
    """RainToday from the rainfall, RainTomorrow from the next row.

    ``file``: the next row of the same bulletin, which ``file_keys`` tell apart, none on its last day. ``location``: the next
    calendar day of the location, across bulletins, null when that day is missing.
    """
    today = rows.withColumn("RainToday", rain_flag(F.col("Rainfall")))
    if label_scope == "file":
        # A bulletin covers one month, so these groups are at most 31 rows long.
        return next_in_group(today, list(file_keys), ["Date"], "RainToday", "RainTomorrow")
    if label_scope != "location":
        raise ValueError(f"unknown label scope {label_scope!r}")
    dated = today.withColumn("_day", F.struct("Date", "RainToday"))
    ahead = next_in_group(dated, ["Location"], ["Date"], "_day", "_next", F.trunc("Date", "year"))
    adjacent = F.col("_next")["Date"] == F.date_add("Date", 1)
    return ahead.withColumn("RainTomorrow", F.when(adjacent, F.col("_next")["RainToday"])).drop("_day", "_next")


def daily_observations(
    digest: DataFrame, dim: DataFrame, label_scope: str = "file", unknown: str = "error"
) -> DataFrame:
    """The daily table: one row per location and day, 23 columns."""
    rows = located(typed(digest), dim, unknown)
    return label_rain(rows, label_scope).select(*DAILY_COLUMNS)
