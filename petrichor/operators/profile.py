"""Counts, shares, correlations and table profiles."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAIRS_PER_PASS = 300


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))


def _per_column(one_row: DataFrame, names: list[str], fields: dict[str, str]) -> DataFrame:
    """Turn a one-row frame of structs named c0, c1, ... into one row per column."""
    cells = F.array(
        *[F.struct(F.lit(n).alias("column"), *[F.col(f"c{i}")[f].alias(f) for f in fields]) for i, n in enumerate(names)]
    )
    return one_row.select(F.explode(cells).alias("x")).select("x.*")


def null_shares(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, null_count, null_share), largest share first; one pass over the data."""
    cols = cols or df.columns
    aggs = [
        F.struct(
            F.count_if(F.col(c).isNull()).alias("null_count"),
            (F.count_if(F.col(c).isNull()) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("null_share"),
        ).alias(f"c{i}")
        for i, c in enumerate(cols)
    ]
    out = _per_column(df.agg(*aggs), cols, {"null_count": "", "null_share": ""})
    return out.orderBy(F.desc("null_share"), "column")


def profile(df: DataFrame) -> DataFrame:
    """(column, type, non_null, rows) for every column; one pass over the data."""
    aggs = [
        F.struct(
            F.lit(t).alias("type"), F.count(F.col(c)).alias("non_null"), F.count(F.lit(1)).alias("rows")
        ).alias(f"c{i}")
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return _per_column(df.agg(*aggs), df.columns, {"type": "", "non_null": "", "rows": ""})


def head_and_tail(df: DataFrame, order: list[str], k: int = 10) -> DataFrame:
    """The first and last ``k`` rows in the given order, marked in ``part``."""
    head = df.orderBy(*order).limit(k).withColumn("part", F.lit("head"))
    tail = df.orderBy(*[F.desc(o) for o in order]).limit(k).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)


def correlation(a: str, b: str) -> Column:
    """Pearson correlation over the rows where both columns are known."""
    return F.corr(F.col(a).cast("double"), F.col(b).cast("double"))


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """(a, b, r) for every pair of columns, both ways round and with the diagonal.

    Every pair is a running aggregate of the same scan; only very wide tables take several scans.
    """
    pairs = list(combinations(cols, 2))
    parts = []
    for start in range(0, max(len(pairs), 1), PAIRS_PER_PASS):
        chunk = pairs[start : start + PAIRS_PER_PASS]
        aggs = [correlation(a, b).alias(f"r{i}") for i, (a, b) in enumerate(chunk)]
        if start == 0:
            own = [correlation(c, c).alias(f"d{i}") for i, c in enumerate(cols)]
            aggs += own
        cells = [(x, y, f"r{i}") for i, (a, b) in enumerate(chunk) for x, y in ((a, b), (b, a))]
        if start == 0:
            cells += [(c, c, f"d{i}") for i, c in enumerate(cols)]
        entry = F.array(
            *[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(r).alias("r")) for a, b, r in cells]
        )
        parts.append(df.agg(*aggs).select(F.explode(entry).alias("x")).select("x.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
