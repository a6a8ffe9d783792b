"""Category codes that stay valid from one load to the next.

A value keeps the code it once got; new values continue from the highest code, in the order of their
first appearance. The book is a table (column, value, code, load), extended before rows use it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from petrichor.operators.joins import is_small
from petrichor.operators.positions import Codes, encode, first_seen, ordered_positions
from petrichor.session import materialize
from petrichor.sources.ledger import LOAD, Ledger, write_load
from petrichor.sources.tables import table_exists

BOOK = f"column string, value string, code int, {LOAD} string"


def new_codes(held: DataFrame, df: DataFrame, cols: list[str], order: list[str], by: str = "first") -> DataFrame:
    """column, value, code of the values that ``held`` (column, value, code) does not have yet.

    ``by`` numbers them by ``first`` appearance in the total order ``order``, or by ``alphabet``.
    """
    if by not in ("first", "alphabet"):
        raise ValueError(f"unknown code order {by!r}")
    names = F.array(*[F.lit(c) for c in cols])
    seen = first_seen(df, cols, order).select(F.element_at(names, F.col("item") + 1).alias("column"), "value", "first")
    fresh = materialize(seen.join(held.select("column", "value"), ["column", "value"], "left_anti"), "values")
    start = held.groupBy("column").agg((F.max("code") + 1).alias("start"))
    rank = ["first", "value"] if by == "first" else ["value"]
    if is_small(fresh):
        numbered = fresh.withColumn("place", F.row_number().over(Window.partitionBy("column").orderBy(*rank)) - 1)
    else:
        placed = ordered_positions(fresh, ["column", *rank], "place")
        # As many rows as there are columns.
        least = placed.groupBy("column").agg(F.min("place").alias("least"))
        numbered = placed.join(F.broadcast(least), "column").withColumn("place", F.col("place") - F.col("least"))
    code = F.col("place") + F.coalesce("start", F.lit(0))
    return numbered.join(F.broadcast(start), "column", "left").select("column", "value", code.cast("int").alias("code"))


class CodeBook:
    """The codes of one table, of the loads that its ledger holds."""

    def __init__(self, spark: SparkSession, path: str, ledger: Ledger):
        self.spark, self.path, self.ledger = spark, path, ledger

    def table(self, load: str | None = None) -> DataFrame:
        """column, value, code; with the codes of an unfinished ``load`` on top if one is given."""
        if not table_exists(self.spark, self.path):
            return self.spark.createDataFrame([], BOOK).drop(LOAD)
        rows = self.spark.read.schema(BOOK).parquet(self.path)
        known = self.ledger.visible(rows)
        if load is not None:
            known = known.unionByName(rows.where(F.col(LOAD) == load))
        return known.select("column", "value", "code")

    def extend(self, df: DataFrame, cols: list[str], order: list[str], load: str, by: str = "first") -> dict[str, Codes]:
        """Give codes to new values, write them, and return the codes of each column."""
        fresh = new_codes(self.table(), df, cols, order, by)
        write_load(fresh, self.path, load)
        book = materialize(self.table(load), "book")
        return {c: Codes(own := book.where(F.col("column") == c).select("value", "code"), is_small(own)) for c in cols}

    def encode(self, df: DataFrame, cols: list[str], order: list[str], load: str, by: str = "first") -> tuple[DataFrame, dict[str, Codes]]:
        codes = self.extend(df, cols, order, load, by)
        return encode(df, codes), codes


def decoded(df: DataFrame, book: DataFrame, cols: list[str]) -> DataFrame:
    """Each coded column of ``df`` with its value instead; a code that the book lacks gives null."""
    out = df
    for c in cols:
        own = book.where(F.col("column") == c).select(F.col("code").alias(f"_k_{c}"), F.col("value").alias(f"_v_{c}"))
        side = F.broadcast(own) if is_small(own) else own
        out = out.join(side, F.col(c) == F.col(f"_k_{c}"), "left").drop(f"_k_{c}")
    return out.select(*[F.col(f"_v_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])
