"""Which side of a join may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A side is broadcast up to so many bytes, measured before the join; beyond, Spark shuffles both sides.
BROADCAST_BYTES = 32 << 20
#: What a row, and an element of its arrays or a string beside its bytes, is counted as.
_ROW, _ELEMENT, _STRING = 48, 16, 32


def bounded(df: DataFrame, *arrays: str) -> DataFrame:
    """``df``, marked for broadcasting if it is measured to be small enough.

    It is read twice, so it should be a materialized table. ``arrays`` names its array columns.
    """
    strings = [c for c, kind in df.dtypes if kind in ("string", "binary")]
    elements = [F.coalesce(F.sum(F.size(a)), F.lit(0)) for a in arrays]
    letters = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in strings]
    rows, *rest = df.agg(F.count("*"), *elements, *letters).first()
    size = rows * (_ROW + _STRING * len(strings)) + sum(rest[: len(arrays)]) * _ELEMENT + sum(rest[len(arrays) :])
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or one like it that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in (name, *(f"{name}{k}" for k in range(len(taken) + 1))) if n.lower() not in taken)
