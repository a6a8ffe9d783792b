"""Lookups and existence tests that never trust a hint.

Sides are broadcast only after their rows and bytes were measured. Above the bound both sides are
shuffled in one join, whose skewed partitions adaptive execution splits.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from petrichor.session import materialize

BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20
#: What a row, and a column of it beside its text, is counted as.
_ROW, _COLUMN = 32, 16


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the frame holds at most ``max_rows`` rows and ``max_bytes`` bytes; stops counting beyond as many rows."""
    wide = []
    for field in df.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            wide.append(F.octet_length(F.col(f"`{field.name}`")))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            wide.append(F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`")))))
    # Longs, not integers, are added up, and a null has no bytes.
    sums = [F.coalesce(F.sum(w.cast("long")), F.lit(0)) for w in wide]
    rows, *held = df.limit(max_rows + 1).agg(F.count(F.lit(1)), *sums).first()
    return rows <= max_rows and rows * (_ROW + _COLUMN * len(df.columns)) + sum(held) <= max_bytes


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: list[str],
    how: str = "left",
    small: bool | None = None,
) -> DataFrame:
    """Attach the columns of ``dim``, unique on ``keys``, to every row of ``facts``.

    ``small`` says that the caller has already checked the size of ``dim``. ``facts`` is read once;
    rows without a key match nothing and stay in a left join.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"lookup_join does left and inner joins, not {how!r}")
    if small is None:
        small = is_small(dim)
    return facts.join(F.broadcast(dim) if small else dim, keys, how)


def unknown_keys(facts: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of ``facts`` that ``dim`` does not hold."""
    return facts.select(*keys).distinct().join(dim.select(*keys), keys, "left_anti")


def _held_keys(new: DataFrame, held: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys found on both sides, written out so that the table is scanned once.

    Usually a small delivery meets a large table: then the table is filtered in place by the
    broadcast keys and is not shuffled.
    """
    wanted = new.select(*keys).distinct()
    side = F.broadcast(wanted) if is_small(wanted) else wanted
    return materialize(held.select(*keys).join(side, keys, "left_semi").distinct(), "held")


def touched_partitions(held: DataFrame, new: DataFrame, cols: list[str], most: int = 1000) -> DataFrame:
    """``held`` in the partitions (by ``cols``) that ``new`` has rows in.

    The partition values of a delivery become literals of the scan, so other partitions are not even
    listed. A delivery of more than ``most`` partitions is bounded by the least and the greatest
    value of the first column instead.
    """
    values = new.select(*cols).distinct().limit(most + 1).collect()
    if len(values) > most:
        first = F.col(cols[0])
        low, high, gaps = new.agg(F.min(first), F.max(first), F.count_if(first.isNull())).first()
        wanted = first.between(low, high)
        return held.where(wanted | first.isNull() if gaps else wanted)
    groups: dict[tuple, list] = {}
    for row in values:
        groups.setdefault(tuple(row)[:-1], []).append(row[-1])
    tests = [F.lit(False)]
    for lead, last in groups.items():
        known = [v for v in last if v is not None]
        inside = F.col(cols[-1]).isin(known) if known else F.lit(False)
        if len(known) < len(last):
            inside |= F.col(cols[-1]).isNull()
        tests.append(reduce(and_, [*[F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(cols, lead)], inside]))
    return held.where(reduce(or_, tests))


def drop_existing(
    new: DataFrame, held: DataFrame, keys: list[str], match: str = "pair"
) -> DataFrame:
    """Rows of ``new`` that the table ``held`` does not have yet; rows without a key stay.

    ``pair`` compares the keys together. ``independent`` compares each key column on its own
    and drops a row when every part of its key occurs somewhere, even in different rows.
    Copies inside ``new`` are kept: only held rows are tested.
    """
    if match == "pair":
        groups = [keys]
    elif match == "independent":
        groups = [[k] for k in keys]
    else:
        raise ValueError(f"unknown match {match!r}")
    flags = [f"_held{i}" for i in range(len(groups))]
    out = new
    for group, flag in zip(groups, flags):
        out = lookup_join(out, _held_keys(new, held, group).withColumn(flag, F.lit(True)), group)
    all_held = reduce(and_, [F.coalesce(F.col(f), F.lit(False)) for f in flags])
    return out.where(~all_held).select(*new.columns)


def pending(plan: DataFrame, held: DataFrame, keys: list[str], refresh: str) -> DataFrame:
    """Planned items that are not held yet, plus those to be refreshed in any case."""
    return plan.where(F.col(refresh)).unionByName(
        drop_existing(plan.where(~F.col(refresh)), held, keys)
    )

