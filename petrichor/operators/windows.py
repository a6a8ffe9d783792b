"""Next row, first row and last row of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def next_in_group(
    df: DataFrame,
    group: list[str],
    order: list[str],
    value: str,
    name: str,
    chunk: Column | None = None,
) -> DataFrame:
    """Add the ``value`` of the following row of the same group; null on the last row.

    ``order`` is total within the group. With ``chunk``, a non-decreasing function of the order,
    a long group is cut into chunks that are sorted in separate tasks; each chunk's last row
    takes the first value of the next chunk that has rows.
    """
    if chunk is None:
        return df.withColumn(name, F.lead(value).over(Window.partitionBy(*group).orderBy(*order)))
    cut = df.withColumn("_chunk", chunk).withColumn("_stand_in", F.lit(False))
    heads = cut.groupBy(*group, "_chunk").agg(
        F.min(F.struct(*order, F.struct(F.col(value).alias("v")).alias("_v")))["_v"]["v"].alias(value)
    )
    # Each chunk's first row also stands in, value only, at the end of the chunk before it.
    before = F.lag("_chunk").over(Window.partitionBy(*group).orderBy("_chunk"))
    stand_ins = (
        heads.withColumn("_chunk", before)
        .where(F.col("_chunk").isNotNull())
        .withColumn("_stand_in", F.lit(True))
    )
    inside = Window.partitionBy(*group, "_chunk").orderBy("_stand_in", *order)
    return (
        cut.unionByName(stand_ins, allowMissingColumns=True)
        .withColumn(name, F.lead(value).over(inside))
        .where(~F.col("_stand_in"))
        .select(*df.columns, name)
    )


def first_per_group(df: DataFrame, group: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each group in the given total order.

    Catalyst turns the rank filter into a group limit before the shuffle, so a group sends at
    most one row per input partition, however long it is.
    """
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def top_rows(df: DataFrame, order: list[Column | str], k: int) -> DataFrame:
    """The first ``k`` rows; each partition keeps ``k`` before they meet."""
    return df.orderBy(*order).limit(k)
