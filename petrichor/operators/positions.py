"""Row positions and category codes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from petrichor.functions.hashing import HASH_SPACE
from petrichor.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, lookup_join
from petrichor.session import materialize

#: About as many rows are numbered together by ``hashed_positions``.
RANGE_ROWS = 10_000


def ordered_positions(df: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """0-based position in a total order, for frames too long for one sorted partition.

    Range partitions are sorted side by side and shifted by the sizes of those before them. The
    split is written out first, so both uses of it see the same boundaries.
    """
    split = materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name)
    sizes = split.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    # One row per range partition: a bounded, small frame.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        split.join(F.broadcast(shift), "_part")
        .withColumn(name, local + F.col("_shift") - 1)
        .drop("_part", "_shift")
    )


def hashed_positions(df: DataFrame, hashed: str, ties: list[str], rows: int, name: str) -> DataFrame:
    """0-based position in the order of ``hashed``, a row hash, and ``ties``; ``rows`` is about their number.

    Hashes are spread evenly, so ranges of one width hold about as many rows each. They follow from the
    hash alone: no rows are sampled to find them, and the split need not be written out.
    """
    width = HASH_SPACE // (rows // RANGE_ROWS + 1) + 1
    split = df.withColumn("_part", F.expr(f"`{hashed}` div {width}"))
    sizes = split.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    # One row per range: a bounded, small frame.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(hashed, *ties))
    return (
        split.withColumn(name, local)
        .join(F.broadcast(shift), "_part")
        .withColumn(name, F.col(name) + F.col("_shift") - 1)
        .drop("_part", "_shift")
    )


def written_positions(df: DataFrame, name: str) -> DataFrame:
    """0-based dense positions in the order in which the rows happen to be written.

    Needs no key, no sort and no shuffle, so copies of a row do not pile up anywhere: rows are
    numbered inside each part that is written, and shifted by the sizes of the parts before it.
    """
    numbered = materialize(df.withColumn("_id", F.monotonically_increasing_id()), name)
    # The upper bits of the generated number are the part, the lower 33 count up inside it.
    placed = numbered.withColumns(
        {"_part": F.shiftright("_id", 33), "_place": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    return (
        lookup_join(placed, shift, ["_part"], "inner")
        .withColumn(name, F.col("_place") + F.col("_shift"))
        .drop("_id", "_part", "_place", "_shift")
    )


def _items(df: DataFrame, cols: list[str], carry: list[Column] | None = None) -> DataFrame:
    """One row (item, value) per non-null cell, with the carried columns beside it."""
    cells = F.array(
        *[F.struct(F.lit(i).alias("item"), F.col(c).cast("string").alias("value")) for i, c in enumerate(cols)]
    )
    carry = carry or []
    rows = df.select(*carry, F.explode(cells).alias("_x"))
    return rows.select(*rows.columns[:-1], "_x.*").where(F.col("value").isNotNull())


def first_seen(df: DataFrame, cols: list[str], order: list[str]) -> DataFrame:
    """(item, value, first): the smallest order key at which each value of each column occurs.

    All columns are handled in one pass. The leading order columns are grouped and only the last
    one is minimised, which keeps the heavy step a hash aggregation on the map side.
    """
    *lead, last = order
    grouped = (
        _items(df, cols, [F.col(o).alias(f"_o{i}") for i, o in enumerate(order)])
        .groupBy("item", "value", *[f"_o{i}" for i in range(len(lead))])
        .agg(F.min(f"_o{len(lead)}").alias(f"_o{len(lead)}"))
    )
    key = F.struct(*[f"_o{i}" for i in range(len(order))])
    return grouped.groupBy("item", "value").agg(F.min(key).alias("first"))


def _numbered(values: DataFrame, order: list[str], small: bool) -> DataFrame:
    if small:
        code = F.row_number().over(Window.orderBy(*order)) - 1
        return values.select("value", code.alias("code"))
    placed = ordered_positions(values, order, "code")
    return placed.select("value", F.col("code").cast("int").alias("code"))


@dataclass(frozen=True)
class Codes:
    """The (value, code) table of one column, and whether its size was found to be small."""

    table: DataFrame
    small: bool


def _code_tables(seen: DataFrame, cols: list[str], order: list[str]) -> dict[str, Codes]:
    """Split (item, value, ...) into one numbered table per column."""
    found = seen.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value").cast("long")).alias("bytes")).collect()
    sizes = {r["item"]: (r["n"], r["bytes"] or 0) for r in found}
    out = {}
    for i, c in enumerate(cols):
        n, held = sizes.get(i, (0, 0))
        small = n <= BROADCAST_ROWS and held <= BROADCAST_BYTES
        out[c] = Codes(_numbered(seen.where(F.col("item") == i), order, small), small)
    return out


def codes_by_first_seen(df: DataFrame, cols: list[str], order: list[str]) -> dict[str, Codes]:
    """Per column its codes, counting up in order of first appearance.

    ``order`` must be a total order up to equal values. Values are kept as text.
    """
    seen = materialize(first_seen(df, cols, order), "codes")
    return _code_tables(seen, cols, ["first", "value"])


def codes_alphabetical(df: DataFrame, cols: list[str]) -> dict[str, Codes]:
    """As ``codes_by_first_seen``, but counting up in text order."""
    values = _items(df, cols).distinct()
    return _code_tables(materialize(values, "codes"), cols, ["value"])


def encode(df: DataFrame, codes: dict[str, Codes]) -> DataFrame:
    """Replace each column by its code; null and values without a code become -1."""
    names = [f"_v_{c}" for c in codes]
    out = df.withColumns({n: F.col(c).cast("string") for n, c in zip(names, codes)})
    for n, (c, code) in zip(names, codes.items()):
        named = code.table.select(F.col("value").alias(n), F.col("code").alias(f"_c_{c}"))
        out = lookup_join(out, named, [n], small=code.small)
    coded = {c: F.coalesce(f"_c_{c}", F.lit(-1)) for c in codes}
    return out.select(*[coded[c].alias(c) if c in coded else F.col(c) for c in df.columns])


def factorize(
    df: DataFrame, cols: list[str], order: list[str], by: str = "first"
) -> tuple[DataFrame, dict[str, Codes]]:
    """The encoded frame and the codes of each column."""
    if by == "first":
        codes = codes_by_first_seen(df, cols, order)
    elif by == "alphabet":
        codes = codes_alphabetical(df, cols)
    else:
        raise ValueError(f"unknown code order {by!r}")
    return encode(df, codes), codes
