"""Stable per-row hashes used for sampling, splitting and folds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 16**15


def row_hash(keys: list[str], seed: int) -> Column:
    """A bigint in [0, 16^15) that depends only on the key values and the seed.

    md5 rather than a Spark-internal hash, so that any SQL engine gives the same number.
    """
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
