"""Class balancing by resampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petrichor.functions.hashing import row_hash
from petrichor.operators.order_stats import BUFFERED_VALUES, value_at_rank
from petrichor.operators.positions import hashed_positions, written_positions
from petrichor.schemas import OVERSAMPLE_SEED
from petrichor.session import materialize

BLOCK = 100_000


def class_sizes(df: DataFrame, label: str) -> dict:
    """Rows per class; one row per class reaches the driver."""
    rows = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r[label]: r["n"] for r in rows}


def _repeat(df: DataFrame, copies: Column, most: int, slot: str) -> DataFrame:
    """Repeat each row ``copies`` times, at least once, numbering the copies in ``slot``.

    One row may need more copies than one task should write, so long runs are cut into blocks
    that are spread over the tasks before they are written out.
    """
    counted = df.withColumn("_copies", copies)
    if most <= BLOCK:
        return counted.withColumn(slot, F.explode(F.expr("sequence(0L, _copies - 1)"))).drop("_copies")
    blocks = counted.withColumn("_block", F.explode(F.expr(f"sequence(0L, (_copies - 1) div {BLOCK})")))
    spread = blocks.repartition(F.xxhash64(*df.columns), "_block")
    numbers = F.expr(f"sequence(_block * {BLOCK}, least((_block + 1) * {BLOCK}, _copies) - 1)")
    return spread.withColumn(slot, F.explode(numbers)).drop("_copies", "_block")


def _cycled(
    minority: DataFrame, key: list[str], n_out: int, n_in: int, seed: int | None, slot: str, buffered: int
) -> DataFrame:
    """Every row ``n_out // n_in`` times, and once more for the first ``n_out % n_in`` rows.

    Only the key of the last such row is looked for; the rows themselves are never shuffled.
    """
    times, rest = divmod(n_out, n_in)
    if not rest:
        return _repeat(minority, F.lit(times).cast("long"), times, slot)
    order = F.col(key[0]) if seed is None else row_hash(key, seed)
    marked = _first_rows(minority.withColumn("_order", order), rest, rest / n_in, buffered)
    if not times:
        return marked.where("_more").drop("_more").withColumn(slot, F.lit(0).cast("long"))
    return _repeat(marked, F.col("_more").cast("long") + times, times + 1, slot).drop("_more")


def _first_rows(ordered: DataFrame, wanted: int, share: float, buffered: int) -> DataFrame:
    """Mark the first ``wanted`` rows by ``_order`` in ``_more``, and drop ``_order``.

    Copies that tie for the last place are numbered as written, so exactly ``wanted`` are marked.
    """
    found = value_at_rank(ordered, "_order", share, lambda n: F.lit(wanted - 1), buffered=buffered)
    limit = F.lit(found.first()["_order"])
    sooner, tied = F.col("_order") < limit, F.col("_order") == limit
    n = ordered.agg(F.count_if(sooner).alias("sooner"), F.count_if(tied).alias("tied")).first()
    if n["sooner"] + n["tied"] == wanted:
        return ordered.withColumn("_more", F.col("_order") <= limit).drop("_order")
    others = ordered.where(~tied).withColumn("_more", sooner)
    numbered = written_positions(ordered.where(tied), "_place")
    chosen = numbered.withColumn("_more", F.col("_place") < wanted - n["sooner"]).drop("_place")
    return others.unionByName(chosen).drop("_order")


def _drawn(minority: DataFrame, key: list[str], n_out: int, n_in: int, seed: int, slot: str) -> DataFrame:
    """``n_out`` independent draws with replacement, each an md5 of its number and the seed.

    Rows are drawn by their position in the order of a hash of the key, so that the sample does
    not depend on how the rows are partitioned.
    """
    draws = (
        minority.sparkSession.range(n_out)
        .select(F.pmod(row_hash(["id"], seed), F.lit(n_in)).alias("_pos"))
        .groupBy("_pos")
        .agg(F.count(F.lit(1)).alias("_times"))
    )
    # Written before the copies are made: later passes repeat rows without joining again.
    hashed = minority.withColumn("_order", row_hash(key, seed))
    numbered = hashed_positions(hashed, "_order", key, n_in, "_pos").drop("_order")
    placed = materialize(numbered.join(draws, "_pos"), "drawn")
    # Draws per row scatter around n_out / n_in; this only chooses how the copies are written.
    most = 4 * (n_out // n_in) + 100
    return _repeat(placed, F.col("_times"), most, slot).drop("_pos", "_times")


def oversample(
    df: DataFrame,
    label: str,
    key: list[str],
    method: str = "draw",
    seed: int = OVERSAMPLE_SEED,
    majority: int = 0,
    minority: int = 1,
    copy: str | None = None,
    slot: str | None = None,
    buffered: int = BUFFERED_VALUES,
) -> DataFrame:
    """The majority class whole, and the minority class resampled to the same number of rows.

    Rows of neither class go. ``draw`` samples with replacement; ``cycle`` goes round the rows in
    key order, ``shuffled_cycle`` in hash order of the key. The key is never null; rows that share
    one are copied in no particular order, but the sizes still match.
    ``copy`` and ``slot`` name optional columns that mark resampled rows and number the copies
    of a row.
    """
    sizes = class_sizes(df.where(F.col(label).isin(majority, minority)), label)
    n_out, n_in = sizes.get(majority, 0), sizes.get(minority, 0)
    if n_in == 0:
        raise ValueError(f"no rows with {label} = {minority} to resample")
    kept = df.where(F.col(label) == majority)
    pool = df.where(F.col(label) == minority)
    number = slot or "_slot"
    if method == "draw":
        copies = _drawn(pool, key, n_out, n_in, seed, number)
    elif method == "shuffled_cycle":
        copies = _cycled(pool, key, n_out, n_in, seed, number, buffered)
    elif method == "cycle":
        if len(key) != 1:
            raise ValueError("cycle needs a single ordered key column; take shuffled_cycle")
        copies = _cycled(pool, key, n_out, n_in, None, number, buffered)
    else:
        raise ValueError(f"unknown method {method!r}")
    kept = kept.withColumn(number, F.lit(0).cast("long"))
    if copy:
        kept, copies = kept.withColumn(copy, F.lit(False)), copies.withColumn(copy, F.lit(True))
    out = kept.unionByName(copies)
    return out if slot else out.drop(number)
