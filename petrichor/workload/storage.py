"""Sinks and tables: what is written to the shared folder is read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from petrichor.functions.text import text_between
from petrichor.schemas import STAMP, text_schema
from petrichor.session import scratch_path
from petrichor.sources.tables import (
    append_new,
    read_or_create,
    read_table,
    run_sql,
    schema_report,
    snapshot,
    write_csv,
    write_table,
    read_dim,
)
from petrichor.workload.base import Tables, query


@query("s4_s7_csv_round_trip", "SELECT * FROM customer")
def s7(spark, sf):
    rows, path = Tables(spark, sf).customer, scratch_path(spark, "csv")
    write_csv(rows, path)
    return read_dim(spark, path, rows.schema)


@query("s7_o1_sorted_csv", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def s7_sorted(spark, sf):
    rows, path = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_totalprice"), scratch_path(spark, "csv")
    write_csv(rows, path, ["o_custkey", "o_orderkey"])
    return read_dim(spark, path, rows.schema)


def in_file_order(rows: DataFrame, name: str) -> DataFrame:
    """0-based positions of rows read from files, by file name and place in the file."""
    block = [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    placed = rows.select("*", *block).withColumn("_id", F.monotonically_increasing_id())
    sizes = placed.groupBy("_file", "_block").agg(F.count("*").alias("_size"))
    # One row per block of a file; the sizes of the blocks before it shift its rows.
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_file", "_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    place = F.row_number().over(Window.partitionBy("_file", "_block").orderBy("_id")) - 1
    numbered = placed.withColumn("_place", place).join(shifts, ["_file", "_block"])
    return numbered.select(*rows.columns, (F.col("_place") + F.col("_shift")).alias(name))


@query(
    "o1_sorted_file_order",
    "SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS position FROM orders",
)
def o1(spark, sf):
    """Where each row stands in sorted files, taken in the order of their names."""
    rows, path = Tables(spark, sf).orders.select("o_orderkey", "o_custkey"), scratch_path(spark, "csv")
    write_csv(rows, path, ["o_custkey", "o_orderkey"])
    return in_file_order(read_dim(spark, path, rows.schema), "position")


_TYPES_SQL = """
    SELECT *, CASE data_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS kind
    FROM information_schema.columns WHERE table_name = 'lineitem'
"""


@query(
    "s14_schema_report",
    f"""
    WITH c AS ({_TYPES_SQL})
    SELECT '{{' || string_agg('"' || column_name || '": "' || kind || '"', ', ' ORDER BY ordinal_position)
             FILTER (column_name <> 'l_returnflag') || '}}' AS input_schema,
           '{{' || string_agg('"' || column_name || '": "' || kind || '"', ', ') FILTER (column_name = 'l_returnflag') || '}}' AS output_schema
    FROM c
    """,
)
def s14(spark, sf):
    return schema_report(Tables(spark, sf).lineitem, "l_returnflag")


@query(
    "s8_s10_append_new_rows",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, DATE '2025-09-06' AS ingestion_date FROM orders",
)
def s8(spark, sf):
    rows = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    path, day = scratch_path(spark, "warehouse"), dt.date(2025, 9, 6)
    append_new(rows.where(F.col("o_orderstatus") == "F"), path, ["o_orderkey"], day, partition_by=["o_orderstatus"])
    append_new(rows, path, ["o_orderkey"], day, partition_by=["o_orderstatus"])
    append_new(rows, path, ["o_orderkey"], day, partition_by=["o_orderstatus"])
    return read_table(spark, path).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", STAMP)


@query(
    "s8_j4_append_touched_months",
    """
    SELECT o_orderkey, o_orderdate, o_totalprice, year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month,
           CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN DATE '2025-09-06' ELSE DATE '2025-09-07' END AS ingestion_date
    FROM orders WHERE o_orderdate < TIMESTAMP '1997-02-01'
    """,
)
def s8_months(spark, sf):
    """Orders by month. The second delivery overlaps the first by three months, and only these are
    looked up in what is held."""
    orders = Tables(spark, sf).orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    orders = orders.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    path, months = scratch_path(spark, "warehouse"), ["year", "month"]
    before = lambda day: F.col("o_orderdate") < F.lit(day).cast("timestamp_ntz")
    for rows, day in ((orders.where(before("1997-01-01")), 6), (orders.where(~before("1996-10-01") & before("1997-02-01")), 7)):
        append_new(rows, path, ["o_orderkey", "o_orderdate"], dt.date(2025, 9, day), partition_by=months, prune_by=months)
    return read_table(spark, path).select(*orders.columns, STAMP)


@query("s9_replace_table", "SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal > 0")
def s9(spark, sf):
    rows, path = Tables(spark, sf).supplier.select("s_suppkey", "s_acctbal"), scratch_path(spark, "table")
    write_table(rows, path, "overwrite")
    write_table(rows.where(F.col("s_acctbal") > 0), path, "overwrite")
    return read_table(spark, path)


@query(
    "s11_sql_text",
    """
    SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem WHERE l_quantity >= 10 GROUP BY ALL
    """,
)
def s11(spark, sf):
    text = "SELECT l_returnflag, l_linestatus, count(*) AS n FROM {li} WHERE l_quantity >= :low GROUP BY 1, 2"
    return run_sql(spark, text, {"low": 10}, li=Tables(spark, sf).lineitem)


@query("s12_key_scan", "SELECT o_orderdate, o_custkey FROM orders")
def s12(spark, sf):
    return Tables(spark, sf).orders.select("o_orderdate", "o_custkey")


@query("s13_snapshot", "SELECT * FROM labels")
def s13(spark, sf):
    return snapshot(Tables(spark, sf).labels, scratch_path(spark, "snapshot"))


@query(
    "s15_read_or_create",
    """
    SELECT page_id::VARCHAR AS station_id,
           substr(html, strpos(html, 'lang="') + 6, strpos(html, '"><head>') - strpos(html, 'lang="') - 6) AS data_id
    FROM pages
    """,
)
def s15(spark, sf):
    path = scratch_path(spark, "ids")
    ids = Tables(spark, sf).pages.select(
        F.col("page_id").cast("string").alias("station_id"), text_between(F.col("html"), 'lang="', '"><head>').alias("data_id")
    )
    schema = text_schema(["station_id", "data_id"])
    read_or_create(spark, path, schema, lambda: ids)
    return read_or_create(spark, path, schema, lambda: ids)
