"""Filling, rejecting and capping values."""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petrichor.functions.rain import cap
from petrichor.functions.text import starts_with_letter
from petrichor.operators.joins import lookup_join
from petrichor.operators.modes import modes
from petrichor.operators.order_stats import ACCURACY, medians, quantiles
from petrichor.schemas import IQR_FACTOR
from petrichor.session import materialize


def fitted(one_row: DataFrame) -> dict[str, Any]:
    """The values of a one-row frame of statistics.

    Like the fitted state of a model these few numbers go through the driver, so that later
    actions on the result do not compute them again.
    """
    return one_row.first().asDict()


def impute_mode(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fill nulls with the column's most frequent value."""
    mode = fitted(modes(df, cols))
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(mode[c])) for c in cols if mode[c] is not None})


def impute_group_median(
    df: DataFrame,
    group: list[str],
    cols: list[str],
    fallback: float = 0.0,
    accuracy: int = ACCURACY,
    exact: bool = True,
) -> DataFrame:
    """Fill nulls with the median of the row's group; a group without values takes ``fallback``.

    The medians are written out once: one small row per group, whose number then decides how
    they are joined.
    """
    found = medians(df, cols, group, accuracy, exact)
    renamed = found.select(*group, *[F.col(c).alias(f"_med_{c}") for c in cols])
    joined = lookup_join(df, materialize(renamed, "medians"), group)
    filled = {c: F.coalesce(F.col(c), F.col(f"_med_{c}"), F.lit(fallback)) for c in cols}
    return joined.withColumns(filled).select(*df.columns)


def has_word(cols: list[str]) -> Column:
    """True when any of the columns holds a text that starts with a letter."""
    return reduce(or_, [starts_with_letter(F.col(c).cast("string")) for c in cols])


def drop_word_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.where(~has_word(cols))


def word_row_count(df: DataFrame, cols: list[str]) -> DataFrame:
    """How many rows ``drop_word_rows`` takes out, and how many it leaves."""
    return df.agg(
        F.count_if(has_word(cols)).alias("removed"), F.count_if(~has_word(cols)).alias("kept")
    )


def iqr_limits(
    df: DataFrame,
    cols: list[str],
    k: float = IQR_FACTOR,
    accuracy: int = ACCURACY,
    exact: bool = True,
) -> DataFrame:
    """One row: per column a struct (low, high) at k inter-quartile ranges beyond the quartiles."""
    q = quantiles(df, cols, [0.25, 0.75], None, accuracy, exact)

    def limits(c: str) -> Column:
        q1, q3 = F.col(c)[0], F.col(c)[1]
        reach = (q3 - q1) * k
        return F.struct((q1 - reach).alias("low"), (q3 + reach).alias("high")).alias(c)

    return q.select(*[limits(c) for c in cols])


def cap_iqr(
    df: DataFrame,
    cols: list[str],
    k: float = IQR_FACTOR,
    accuracy: int = ACCURACY,
    exact: bool = True,
) -> DataFrame:
    """Limit each column to its IQR fences; nulls stay null."""
    limits = fitted(iqr_limits(df, cols, k, accuracy, exact))
    known = [c for c in cols if limits[c]["low"] is not None]
    return df.withColumns({c: cap(F.col(c), F.lit(limits[c]["low"]), F.lit(limits[c]["high"])) for c in known})


def kinds(df: DataFrame) -> tuple[list[str], list[str]]:
    """(text columns, other columns) by declared type."""
    text = [c for c, t in df.dtypes if t == "string"]
    return text, [c for c in df.columns if c not in text]
