"""Exact order statistics without sorting the data and without an unbounded value buffer.

Spark's ``percentile`` keeps every distinct value of a group in one buffer, so it only serves
groups whose counted size bounds that buffer. Larger groups take another way:

1. Each column of a group is sketched by KLL, whose partial sketches merge on the map side. A sketch
   holds some three times its size in values at most, and never more than the group has rows.
2. Two quantiles of the sketch, ``MARGIN`` times the usual error to either side, bracket each wanted rank.
   The brackets are written down, since a sketch made anew would differ. A rank that they miss
   after all raises an error in step 3; it never gives a wrong value.
3. Values outside the brackets are only counted, values inside are counted one by one; both
   combine on the map side. A running count over those counts finds the exact values.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from petrichor.operators.joins import BROADCAST_ROWS, lookup_join
from petrichor.session import materialize

ACCURACY = 2_000
#: Bounds of the size of a KLL sketch (fixed values of Spark).
LEAST_SKETCH, MOST_SKETCH = 8, 65_535
#: The error of a rank is about ``2.296 / size ** 0.9021`` of the rows at 99 % (2.58 standard errors); brackets reach four times as far.
ERROR, ERROR_POWER, MARGIN = 2.296, 0.9021, 4
BUFFERED_VALUES = 2_000_000
WINDOWED_ROWS = 1_000_000_000


@dataclass(frozen=True)
class Sizes:
    """Number of groups, rows of the largest one, and groups too large to buffer."""

    groups: int
    largest: int
    too_large: int


def _keyed(df: DataFrame, group: list[str]) -> DataFrame:
    return df.where(reduce(and_, [F.col(g).isNotNull() for g in group])) if group else df


def _counts(df: DataFrame, group: list[str]) -> DataFrame:
    return _keyed(df.select(*group), group).groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))


def group_sizes(df: DataFrame, group: list[str], columns: int = 1, buffered: int = BUFFERED_VALUES) -> Sizes:
    """Counted over the key columns only; rows without a key are in no group."""
    row = (
        _counts(df, group)
        .agg(
            F.count(F.lit(1)).alias("groups"),
            F.max("_rows").alias("largest"),
            F.count_if(F.col("_rows") * columns > buffered).alias("too_large"),
        )
        .first()
    )
    return Sizes(row["groups"], row["largest"] or 0, row["too_large"])


def _sketch_size(accuracy: int) -> int:
    return min(MOST_SKETCH, max(LEAST_SKETCH, 2 * accuracy))


def _brackets(rows: DataFrame, cols: list[str], probs: list[float], group: list[str], accuracy: int) -> DataFrame:
    """(group..., _b0, _b1, ...): per column an array low, high, low, high, ... one pair per share.

    A missing end is null and stands for no limit. NaN counts as larger than all numbers.
    """
    size = _sketch_size(accuracy)
    margin = MARGIN * ERROR / size**ERROR_POWER
    top = F.lit(float("inf"))
    sketches = [F.kll_sketch_agg_double(F.nanvl(F.col(c).cast("double"), top), size).alias(f"_s{i}") for i, c in enumerate(cols)]
    sizes = [F.count(c).alias(f"_n{i}") for i, c in enumerate(cols)]
    found = rows.groupBy(*group).agg(*sketches, *sizes)

    def ends(i: int) -> Column:
        # The share itself stands in where an end would lie outside, and is not read there.
        near = [(p - margin, p + margin) for p in probs]
        shares = [F.lit(x if 0 < x < 1 else p) for p, pair in zip(probs, near) for x in pair]
        at = F.kll_sketch_get_quantile_double(F.col(f"_s{i}"), F.array(*shares))
        each = []
        for k, (low, high) in enumerate(near):
            each.append(at[2 * k] if low > 0 else F.lit(None).cast("double"))
            each.append(F.nullif(at[2 * k + 1], top) if high < 1 else F.lit(None).cast("double"))
        none = F.array(*[F.lit(None).cast("double")] * len(each))
        return F.when(F.col(f"_n{i}") > 0, F.array(*each)).otherwise(none).alias(f"_b{i}")

    return materialize(found.select(*group, *[ends(i) for i in range(len(cols))]), "brackets")


def _runs(
    df: DataFrame, cols: list[str], probs: list[float], group: list[str], accuracy: int, sizes: Sizes
) -> DataFrame:
    """Sorted runs of values per (group, item): columns item, low, high, first, last, n.

    ``first`` and ``last`` are 0-based ranks. A run is one distinct value or, outside the
    brackets, everything between two brackets.
    """
    rows = _keyed(df.select(*group, *cols), group)
    brackets = _brackets(rows, cols, probs, group, accuracy)
    if group:
        rows = lookup_join(rows, brackets, group, "inner", sizes.groups <= BROADCAST_ROWS)
    else:
        ends = brackets.select(F.struct("*").alias("s")).scalar()
        names = [F.col("_s")[f"_b{i}"].alias(f"_b{i}") for i in range(len(cols))]
        rows = rows.withColumn("_s", ends).select(*cols, *names)

    cells = F.array(
        *[
            F.struct(F.lit(i).alias("item"), F.col(c).alias("v"), F.col(f"_b{i}").alias("b"))
            for i, c in enumerate(cols)
        ]
    )
    v, b = F.col("v"), F.col("b")
    sides = [
        (F.coalesce(v >= b[2 * k], F.lit(True)), F.coalesce(v > b[2 * k + 1], F.lit(False)))
        for k in range(len(probs))
    ]
    # The zone number grows with the value, so what lies between two brackets shares one zone.
    zone = reduce(add, [entered.cast("int") + left.cast("int") for entered, left in sides])
    inside = reduce(or_, [entered & ~left for entered, left in sides])
    counted = (
        rows.select(*group, F.explode(cells).alias("_x"))
        .select(*group, "_x.*")
        .where(v.isNotNull())
        .select(*group, "item", v, zone.alias("zone"), F.when(inside, v).alias("exact"))
        .groupBy(*group, "item", "zone", "exact")
        .agg(F.count(F.lit(1)).alias("cnt"), F.min("v").alias("low"), F.max("v").alias("high"))
    )
    keys = [*group, "item"]
    counted = _running(counted, keys) if sizes.largest <= WINDOWED_ROWS else _running_split(counted, keys)
    return counted.withColumn("first", F.col("last") - F.col("cnt") + 1)


def _running(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Add the running count: one sorted window per group, about one row in a hundred of it."""
    each = Window.partitionBy(*keys)
    up_to = each.orderBy("low").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counted.withColumn("n", F.sum("cnt").over(each)).withColumn("last", F.sum("cnt").over(up_to) - 1)


def _running_split(counted: DataFrame, keys: list[str]) -> DataFrame:
    """The same for huge groups: range partitions are summed side by side and then shifted."""
    ranged = counted.repartitionByRange(*keys, "low").withColumn("_part", F.spark_partition_id())
    split = materialize(ranged, "runs")
    sums = split.groupBy(*keys, "_part").agg(F.sum("cnt").alias("_sum"))
    each = Window.partitionBy(*keys)
    before = each.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select(
        *keys, "_part", F.sum("_sum").over(each).alias("n"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_shift")
    )
    local = Window.partitionBy(*keys, "_part").orderBy("low").rowsBetween(Window.unboundedPreceding, 0)
    return (
        split.join(shifts, [*keys, "_part"])
        .withColumn("last", F.sum("cnt").over(local) + F.col("_shift") - 1)
        .drop("_part", "_shift")
    )


def _value_at(rank: Column) -> Column:
    """The value at a 0-based rank, as an aggregate over the runs of one item."""
    value = (
        F.when((F.col("low") == F.col("high")) | (rank == F.col("first")), F.col("low"))
        .when(rank == F.col("last"), F.col("high"))
        .otherwise(F.raise_error(F.lit("rank outside its bracket")))
    )
    return F.max(F.when(rank.between(F.col("first"), F.col("last")), value))


def _buffered_quantiles(doubles: DataFrame, cols: list[str], probs: list[float], group: list[str]) -> DataFrame:
    shares = F.array(*[F.lit(p) for p in probs])
    aggs = [F.percentile(c, shares).alias(c) for c in cols]
    if not group:
        return doubles.agg(*aggs)
    return doubles.groupBy(*group).agg(*aggs).where(F.coalesce(*cols).isNotNull())


def _bracketed_quantiles(
    doubles: DataFrame, cols: list[str], probs: list[float], group: list[str], accuracy: int, sizes: Sizes
) -> DataFrame:
    runs = _runs(doubles, cols, probs, group, accuracy, sizes)
    ends = []
    for k, p in enumerate(probs):
        at = (F.col("n") - 1).cast("double") * p
        ends += [
            _value_at(F.floor(at)).alias(f"lo{k}"),
            _value_at(F.ceil(at)).alias(f"hi{k}"),
            F.max(at).alias(f"at{k}"),
        ]
    # Weighed as by ``percentile``, so that both ways agree to the last bit.
    each = F.array(
        *[
            F.expr(f"if(lo{k} = hi{k}, lo{k}, (ceil(at{k}) - at{k}) * lo{k} + (at{k} - floor(at{k})) * hi{k})")
            for k in range(len(probs))
        ]
    )
    long = runs.groupBy(*group, "item").agg(*ends).select(*group, "item", each.alias("q"))
    wide = [F.max(F.when(F.col("item") == i, F.col("q"))).alias(c) for i, c in enumerate(cols)]
    return long.groupBy(*group).agg(*wide) if group else long.agg(*wide)


def quantiles(
    df: DataFrame,
    cols: list[str],
    probs: list[float],
    group: list[str] | None = None,
    accuracy: int = ACCURACY,
    exact: bool = True,
    buffered: int = BUFFERED_VALUES,
) -> DataFrame:
    """Per group, one array per column with the linearly interpolated quantiles.

    All columns are handled together; a column without values gives null and a group without
    any value has no row. ``buffered`` is the most values that the columns of one group may put
    into aggregation buffers; groups beyond it are bracketed. With ``exact=False`` a sketch alone
    answers, in a single pass.
    """
    group = group or []
    doubles = _keyed(df.select(*group, *[F.col(c).cast("double").alias(c) for c in cols]), group)
    if not exact:
        aggs = [F.percentile_approx(c, probs, accuracy).alias(c) for c in cols]
        return doubles.groupBy(*group).agg(*aggs) if group else doubles.agg(*aggs)
    if not group:
        rows = df.count()
        if rows * len(cols) <= buffered:
            return _buffered_quantiles(doubles, cols, probs, group)
        return _bracketed_quantiles(doubles, cols, probs, group, accuracy, Sizes(1, rows, 1))
    sizes = group_sizes(df, group, len(cols), buffered)
    if sizes.too_large == 0:
        return _buffered_quantiles(doubles, cols, probs, group)
    if sizes.too_large == sizes.groups:
        return _bracketed_quantiles(doubles, cols, probs, group, accuracy, sizes)
    large = _counts(df, group).where(F.col("_rows") * len(cols) > buffered)
    few = sizes.too_large <= BROADCAST_ROWS
    marked = lookup_join(doubles, large, group, "left", few)
    is_large = F.col("_rows").isNotNull()
    return _buffered_quantiles(marked.where(~is_large), cols, probs, group).unionByName(
        _bracketed_quantiles(
            marked.where(is_large), cols, probs, group, accuracy, Sizes(sizes.too_large, sizes.largest, sizes.too_large)
        )
    )


def medians(
    df: DataFrame,
    cols: list[str],
    group: list[str],
    accuracy: int = ACCURACY,
    exact: bool = True,
    buffered: int = BUFFERED_VALUES,
) -> DataFrame:
    """One row per group with the median of each column."""
    q = quantiles(df, cols, [0.5], group, accuracy, exact, buffered)
    return q.select(*group, *[F.col(c)[0].alias(c) for c in cols])


def values_at_ranks(
    df: DataFrame,
    col: str,
    wanted: list[tuple[float, Callable[[Column], Column]]],
    group: list[str] | None = None,
    accuracy: int = ACCURACY,
    buffered: int = BUFFERED_VALUES,
) -> DataFrame:
    """Per group an array with the value of ``col`` at each wanted 0-based rank.

    Each entry of ``wanted`` is a share and a function of the group's row count giving a rank near
    that share. All ranks are found together: by numbering the rows while no group exceeds
    ``buffered`` rows, by brackets beyond that.
    """
    group = group or []
    values = _keyed(df.select(*group, col), group).where(F.col(col).isNotNull())
    sizes = group_sizes(values, group, 1, buffered) if group else Sizes(1, values.count(), 0)
    if sizes.largest <= buffered:
        each = Window.partitionBy(*group)
        place = F.row_number().over(each.orderBy(col)) - 1
        rows = values.withColumn("n", F.count(F.lit(1)).over(each)).withColumn("first", place)
        picked = [F.max(F.when(F.col("first") == rank(F.col("n")), F.col(col))) for _, rank in wanted]
    else:
        rows = _runs(values, [col], [p for p, _ in wanted], group, accuracy, sizes)
        picked = [_value_at(rank(F.col("n"))) for _, rank in wanted]
    answer = F.array(*picked).alias(col)
    return rows.groupBy(*group).agg(answer) if group else rows.agg(answer)


def value_at_rank(
    df: DataFrame,
    col: str,
    prob: float,
    rank: Callable[[Column], Column],
    accuracy: int = ACCURACY,
    buffered: int = BUFFERED_VALUES,
) -> DataFrame:
    """The value of ``col`` at the 0-based rank ``rank(n)``, which lies near share ``prob``."""
    found = values_at_ranks(df, col, [(prob, rank)], None, accuracy, buffered)
    return found.select(F.col(col)[0].alias(col))
