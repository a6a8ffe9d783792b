"""Rain flags, labels and model-comparison arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from petrichor.schemas import RAIN_MM


def rain_flag(rainfall: Column, threshold: float = RAIN_MM) -> Column:
    """'Yes' from the threshold up, else 'No'; a missing rainfall is 'No'."""
    return F.when(rainfall >= threshold, "Yes").otherwise("No")


def yes_no_code(c: Column) -> Column:
    """Yes to 1, No to 0, anything else to null."""
    return F.when(c == "Yes", 1).when(c == "No", 0)


def relative_gain(new: Column, old: Column) -> Column:
    """(new - old) / old, null when there is no old value or it is zero."""
    return (new - old) / F.nullif(old, F.lit(0.0))


def is_promoted(new: Column, old: Column, min_gain: float) -> Column:
    """True without an old score, else when the relative gain exceeds ``min_gain``."""
    return F.when(old.isNull(), True).otherwise(
        F.coalesce(relative_gain(new, old) > min_gain, new > 0)
    )


def will_rain(prediction: Column) -> Column:
    return prediction > 0.5


def cap(c: Column, low: Column, high: Column) -> Column:
    """Limit to [low, high]; null stays null."""
    return F.when(c < low, low).when(c > high, high).otherwise(c)


def min_max(c: Column, low: Column, high: Column) -> Column:
    """Scale to [0, 1]; a column without range scales to 0."""
    span = high - low
    return F.when(c.isNotNull(), F.when(span == 0, 0.0).otherwise((c - low) / F.nullif(span, F.lit(0.0))))
