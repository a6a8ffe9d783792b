"""Tables: dimensions, the daily warehouse, snapshots and schema reports."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from petrichor.operators.joins import drop_existing, touched_partitions
from petrichor.schemas import LABEL, STAMP
from petrichor.session import materialize


def read_dim(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A headed CSV table with a declared schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str, order: list[str] | None = None, mode: str = "overwrite") -> None:
    """A headed CSV table. With ``order`` the part files follow one another in that order."""
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    df.write.option("header", True).option("emptyValue", "").mode(mode).csv(path)


def is_path(source: str) -> bool:
    return "/" in source


def read_table(spark: SparkSession, source: str) -> DataFrame:
    """A whole table by catalog name or Parquet path; filters and columns are pushed into it."""
    return spark.read.parquet(source) if is_path(source) else spark.table(source)


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str, bounds: tuple, partitions: int, **options: str
) -> DataFrame:
    """A database table read in parallel slices of a numeric or date column."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=column, numPartitions=partitions)
        .options(lowerBound=bounds[0], upperBound=bounds[1], **options)
        .load()
    )


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", connections: int = 16, **options: str) -> None:
    """Append to or replace a database table over a bounded number of connections."""
    df.repartition(connections).write.format("jdbc").options(url=url, dbtable=table, **options).mode(mode).save()


def write_table(
    df: DataFrame, target: str, mode: str = "append", partition_by: list[str] | None = None
) -> None:
    """Append to or replace a table given by catalog name or Parquet path."""
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(target) if is_path(target) else writer.saveAsTable(target)


def _absent(error: AnalysisException) -> bool:
    """There is no such path, or nothing in it; any other failure is not taken for absence."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def path_absent(spark: SparkSession, path: str, kind: str) -> bool:
    """Whether there is nothing at ``path`` for the reader of this kind."""
    try:
        spark.read.format(kind).load(path)
    except AnalysisException as error:
        if _absent(error):
            return True
        raise
    return False


def table_exists(spark: SparkSession, source: str) -> bool:
    if not is_path(source):
        return spark.catalog.tableExists(source)
    return not path_absent(spark, source, "parquet")


def stamped(df: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Add the day of ingestion."""
    return df.withColumn(STAMP, F.lit(day) if day else F.current_date())


def append_new(
    df: DataFrame,
    target: str,
    keys: list[str],
    day: dt.date | None = None,
    match: str = "pair",
    partition_by: list[str] | None = None,
    prune_by: list[str] | None = None,
) -> bool:
    """Append the rows whose key the table does not hold; says whether there were any.

    ``prune_by`` names partition columns whose values follow from the key, as a month does from
    a date: then the table is only read in the partitions that the delivery touches. The delivery is
    evaluated once, and is written in files of even size, however many tasks have read its bulletins.
    """
    spark = df.sparkSession
    fresh = stamped(df, day)
    if table_exists(spark, target):
        delivery = materialize(fresh.hint("rebalance"), "delivery")
        held = read_table(spark, target)
        if prune_by:
            held = touched_partitions(held, delivery, prune_by)
        fresh = drop_existing(delivery, held, keys, match)
        if fresh.isEmpty():
            return False
    write_table(fresh.hint("rebalance", *map(F.col, partition_by or [])), target, "append", partition_by)
    return True


def run_sql(spark: SparkSession, query: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """SQL text to a frame, with named parameters; ``{name}`` stands for a frame."""
    return spark.sql(query, args=args, **frames)


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """Fix the rows a training run sees; returns the fixed copy."""
    df.write.mode("overwrite").parquet(path)
    return read_snapshot(df.sparkSession, path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_or_create(
    spark: SparkSession, path: str, schema: T.StructType, build: Callable[[], DataFrame]
) -> DataFrame:
    """The CSV table at ``path``; it is built and written first if it is not there."""
    try:
        return read_dim(spark, path, schema)
    except AnalysisException as error:
        if not _absent(error):
            raise
        write_csv(build(), path, mode="ignore")
        return read_dim(spark, path, schema)


def schema_report(df: DataFrame, target: str = LABEL) -> DataFrame:
    """One row (input_schema, output_schema), each a JSON object of column types."""
    inputs = {c: t for c, t in df.dtypes if c != target}
    outputs = {c: t for c, t in df.dtypes if c == target}
    return df.sparkSession.range(1).select(
        F.lit(json.dumps(inputs)).alias("input_schema"), F.lit(json.dumps(outputs)).alias("output_schema")
    )


def to_records(df: DataFrame) -> DataFrame:
    """Each row as a JSON object in column ``record``."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("record"))
