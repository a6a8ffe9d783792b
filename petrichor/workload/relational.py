"""Projections, filters, joins, windows, sorts and unions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from petrichor.operators.impute import drop_word_rows, kinds, word_row_count
from petrichor.operators.joins import drop_existing, lookup_join, pending, unknown_keys
from petrichor.operators.positions import factorize, ordered_positions, written_positions
from petrichor.operators.profile import head_and_tail
from petrichor.operators.windows import first_per_group, next_in_group, top_rows
from petrichor.plans.daily import station_dim
from petrichor.functions.rain import rain_flag
from petrichor.functions.text import to_double
from petrichor.sources.bulletins import collection_plan
from petrichor.workload.base import Tables, query


@query(
    "p1_reorder_columns",
    "SELECT o_orderdate, o_orderkey, o_totalprice FROM orders",
)
def p1(spark, sf):
    return Tables(spark, sf).orders.select("o_orderdate", "o_orderkey", "o_totalprice")


@query(
    "p2_p3_rename_and_stamp",
    "SELECT s_suppkey AS station_id, s_name, DATE '2025-09-06' AS ingestion_date FROM supplier",
)
def p2(spark, sf):
    from petrichor.sources.tables import stamped

    rows = Tables(spark, sf).supplier.withColumnRenamed("s_suppkey", "station_id")
    return stamped(rows.select("station_id", "s_name"), dt.date(2025, 9, 6))


@query("p4_drop_columns", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def p4(spark, sf):
    return Tables(spark, sf).customer.drop("c_acctbal", "c_mktsegment", "ingestion_date")


@query(
    "p5_rows_of_one_location",
    "SELECT event_id, ts, value FROM events WHERE user_id = 41",
)
def p5(spark, sf):
    return Tables(spark, sf).events.where(F.col("user_id") == 41).select("event_id", "ts", "value")


@query("p6_class_filter", "SELECT doc_id, quality FROM labels WHERE toxic = 1")
def p6(spark, sf):
    return Tables(spark, sf).labels.where(F.col("toxic") == 1).select("doc_id", "quality")


def _speeds(spark, sf):
    """Event values as text, where every seventh reading is the word Calm."""
    text = F.when(F.col("event_id") % 7 == 0, "Calm").otherwise(F.col("value").cast("string"))
    return Tables(spark, sf).events.select("event_id", text.alias("speed"))


@query(
    "p7_f5_f6_drop_word_rows",
    """
    WITH s AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'Calm' ELSE value::VARCHAR END AS speed FROM events)
    SELECT event_id, try_cast(speed AS DOUBLE) AS speed FROM s WHERE NOT regexp_matches(speed, '^[A-Za-z]')
    """,
)
def p7(spark, sf):
    return drop_word_rows(_speeds(spark, sf), ["speed"]).withColumn("speed", to_double(F.col("speed")))


@query(
    "a5_removed_row_count",
    "SELECT count(*) FILTER (event_id % 7 = 0) AS removed, count(*) FILTER (event_id % 7 <> 0) AS kept FROM events",
)
def a5(spark, sf):
    return word_row_count(_speeds(spark, sf), ["speed"])


@query(
    "p8_drop_incomplete_rows",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 5 <> 0 AND o_custkey % 3 <> 0",
)
def p8(spark, sf):
    rows = Tables(spark, sf).orders.select(
        "o_orderkey",
        "o_totalprice",
        F.nullif(F.col("o_orderkey") % 5, F.lit(0)).alias("_a"),
        F.nullif(F.col("o_custkey") % 3, F.lit(0)).alias("_b"),
    )
    return rows.dropna("any").drop("_a", "_b")


@query(
    "p10_membership",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    """,
)
def p10(spark, sf):
    t = Tables(spark, sf)
    wanted = t.customer.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.select("o_orderkey", "o_custkey").join(wanted, "o_custkey", "left_semi")


@query(
    "i4_text_and_number_columns",
    """
    SELECT count(o_orderstatus) + count(o_orderpriority) AS text_cells,
           count(o_orderkey) + count(o_custkey) + count(o_totalprice) + count(o_orderdate) AS other_cells
    FROM orders
    """,
)
def i4(spark, sf):
    rows = Tables(spark, sf).orders
    text, other = kinds(rows)
    cells = lambda cols: sum((F.count(c) for c in cols), F.lit(0).cast("long"))
    return rows.agg(cells(text).alias("text_cells"), cells(other).alias("other_cells"))


@query(
    "j1_station_dimension",
    """
    SELECT c.c_custkey AS station_id, c.c_name AS Location, n.n_name AS data_id
    FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON c.c_nationkey = n.n_nationkey
    """,
)
def j1(spark, sf):
    t = Tables(spark, sf)
    stations = t.customer.select(F.col("c_nationkey").alias("Code"), F.col("c_name").alias("Location"), "c_custkey")
    ids = t.nation.where(F.col("n_regionkey") != 2).select(
        F.col("n_nationkey").alias("station_id"), F.col("n_name").alias("data_id")
    )
    return station_dim(stations, ids).select(F.col("c_custkey").alias("station_id"), "Location", "data_id")


@query(
    "j2_attach_location",
    """
    SELECT l_orderkey, l_linenumber, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    """,
)
def j2(spark, sf):
    t = Tables(spark, sf)
    dim = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    facts = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    return lookup_join(facts, dim, ["l_suppkey"], "inner").drop("l_suppkey")


@query(
    "j2_attach_large_dimension",
    """
    SELECT l_orderkey, l_linenumber, o_custkey, o_orderpriority
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
    """,
)
def j2_large(spark, sf):
    t = Tables(spark, sf)
    dim = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
    return lookup_join(t.lineitem.select("l_orderkey", "l_linenumber"), dim, ["l_orderkey"], small=False)


@query(
    "j2_unknown_ids",
    """
    SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)
    """,
)
def j2_unknown(spark, sf):
    t = Tables(spark, sf)
    return unknown_keys(t.events, t.supplier.select(F.col("s_suppkey").alias("user_id")), ["user_id"])


def _delivery(spark, sf):
    """Orders split into a table that is held and a delivery that overlaps it."""
    orders = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    return orders, orders.where(F.col("o_orderstatus") == "F")


@query(
    "j3_drop_existing_independent",
    """
    SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM orders
    WHERE NOT (o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
           AND o_orderdate IN (SELECT o_orderdate FROM orders WHERE o_orderstatus = 'F'))
    """,
)
def j3(spark, sf):
    new, held = _delivery(spark, sf)
    return drop_existing(new, held, ["o_custkey", "o_orderdate"], match="independent")


@query(
    "j4_drop_existing_pair",
    """
    SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM orders o
    WHERE NOT EXISTS (SELECT 1 FROM orders h WHERE h.o_orderstatus = 'F'
                      AND h.o_custkey = o.o_custkey AND h.o_orderdate = o.o_orderdate)
    """,
)
def j4(spark, sf):
    new, held = _delivery(spark, sf)
    return drop_existing(new, held, ["o_custkey", "o_orderdate"])


@query(
    "j5_name_of_code",
    "SELECT c_custkey, c_nationkey AS location_id, n_name AS Location_Name FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def j5(spark, sf):
    t = Tables(spark, sf)
    mapping = t.nation.select(F.col("n_nationkey").alias("location_id"), F.col("n_name").alias("Location_Name"))
    facts = t.customer.select("c_custkey", F.col("c_nationkey").alias("location_id"))
    return lookup_join(facts, mapping, ["location_id"], "inner")


PLAN_SQL = """
    SELECT s_suppkey, s_name AS data_id, strftime(m, '%Y%m') AS period,
           m = date_trunc('month', as_of) AS refresh,
           s_name || '.' || strftime(m, '%Y%m') || '.csv' AS file_name,
           'https://reg.bom.gov.au/climate/dwo/' || strftime(m, '%Y%m') || '/text/' || s_name || '.'
               || strftime(m, '%Y%m') || '.csv' AS url
    FROM (SELECT *, (SELECT max(o_orderdate) FROM orders) AS as_of FROM supplier),
         LATERAL (SELECT unnest(generate_series(date_trunc('month', as_of) - INTERVAL 13 MONTH,
                                                date_trunc('month', as_of), INTERVAL 1 MONTH)) AS m)
"""


def _plan(spark, sf):
    t = Tables(spark, sf)
    stations = t.supplier.select("s_suppkey", F.col("s_name").alias("data_id"))
    as_of = t.orders.agg(F.max("o_orderdate").cast("date")).scalar()
    return collection_plan(stations, as_of)


@query("j7_f10_f11_collection_plan", PLAN_SQL)
def j7(spark, sf):
    return _plan(spark, sf)


@query(
    "j8_pending_bulletins",
    f"""
    WITH plan AS ({PLAN_SQL}),
    held AS (SELECT DISTINCT l_suppkey AS s_suppkey, strftime(l_shipdate, '%Y%m') AS period FROM lineitem)
    SELECT s_suppkey, period, refresh FROM plan p
    WHERE refresh OR NOT EXISTS (SELECT 1 FROM held h WHERE h.s_suppkey = p.s_suppkey AND h.period = p.period)
    """,
)
def j8(spark, sf):
    held = Tables(spark, sf).lineitem.select(
        F.col("l_suppkey").alias("s_suppkey"), F.date_format("l_shipdate", "yyyyMM").alias("period")
    )
    todo = pending(_plan(spark, sf), held, ["s_suppkey", "period"], "refresh")
    return todo.select("s_suppkey", "period", "refresh")


W1_SQL = """
    WITH f AS (SELECT event_id, user_id, ts::DATE AS day, ts,
                      CASE WHEN value >= 50 THEN 'Yes' ELSE 'No' END AS today FROM events)
    SELECT event_id, user_id, day, today,
           lead(today) OVER (PARTITION BY user_id, day ORDER BY ts, event_id) AS tomorrow
    FROM f
"""


def _flags(spark, sf):
    return Tables(spark, sf).events.select(
        "event_id", "user_id", F.to_date("ts").alias("day"), "ts", rain_flag(F.col("value"), 50).alias("today")
    )


@query("w1_f3_next_flag", W1_SQL)
def w1(spark, sf):
    return next_in_group(_flags(spark, sf), ["user_id", "day"], ["ts", "event_id"], "today", "tomorrow").drop("ts")


@query("w1_next_flag_in_chunks", W1_SQL)
def w1_chunks(spark, sf):
    hour = F.hour("ts")
    out = next_in_group(_flags(spark, sf), ["user_id", "day"], ["ts", "event_id"], "today", "tomorrow", hour)
    return out.drop("ts")


@query(
    "w1_rain_days_per_location",
    f"""
    WITH n AS ({W1_SQL})
    SELECT user_id, count(*) AS days, count(*) FILTER (today = 'Yes') AS rain_days,
           round(avg(CASE WHEN tomorrow = 'Yes' THEN 1.0 WHEN tomorrow = 'No' THEN 0.0 END), 6) AS rainy_tomorrow
    FROM n GROUP BY user_id
    """,
)
def rain_days(spark, sf):
    labelled = w1(spark, sf)
    wet = F.when(F.col("tomorrow") == "Yes", 1.0).when(F.col("tomorrow") == "No", 0.0)
    return labelled.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("days"),
        F.count_if(F.col("today") == "Yes").alias("rain_days"),
        F.round(F.avg(wet), 6).alias("rainy_tomorrow"),
    )


@query(
    "w2_first_row_per_group",
    """
    SELECT o_custkey, o_orderkey, o_orderdate FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
    WHERE rn = 1
    """,
)
def w2_first(spark, sf):
    rows = Tables(spark, sf).orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return first_per_group(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "w2_latest_row_per_group",
    """
    SELECT user_id, event_id, ts, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1
    """,
)
def w2(spark, sf):
    rows = Tables(spark, sf).events.select("user_id", "event_id", "ts", "value")
    return first_per_group(rows, ["user_id"], [F.desc("ts"), F.desc("event_id")])


@query(
    "w4_codes_by_first_appearance",
    """
    WITH f AS (SELECT c_mktsegment AS v, min(c_custkey) AS first FROM customer GROUP BY 1),
         c AS (SELECT v, row_number() OVER (ORDER BY first) - 1 AS code FROM f)
    SELECT c_custkey, c.code::INTEGER AS c_mktsegment FROM customer JOIN c ON c_mktsegment = c.v
    """,
)
def w4(spark, sf):
    rows = Tables(spark, sf).customer.select("c_custkey", "c_mktsegment")
    return factorize(rows, ["c_mktsegment"], ["c_custkey"])[0]


@query(
    "w4_codes_alphabetical",
    """
    SELECT c_custkey, (dense_rank() OVER (ORDER BY c_mktsegment) - 1)::INTEGER AS c_mktsegment FROM customer
    """,
)
def w4_alphabet(spark, sf):
    rows = Tables(spark, sf).customer.select("c_custkey", "c_mktsegment")
    return factorize(rows, ["c_mktsegment"], ["c_custkey"], by="alphabet")[0]


@query(
    "w4_i6_location_mapping",
    """
    SELECT Location_Name, (row_number() OVER (ORDER BY first) - 1)::INTEGER AS Location_Code FROM (
      SELECT p_brand AS Location_Name, min(p_partkey) AS first FROM part GROUP BY 1)
    """,
)
def i6(spark, sf):
    codes = factorize(Tables(spark, sf).part, ["p_brand", "p_type"], ["p_partkey"])[1]
    return codes["p_brand"].table.select(F.col("value").alias("Location_Name"), F.col("code").alias("Location_Code"))


@query(
    "w5_positions_in_order",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS pos FROM orders",
)
def w5(spark, sf):
    rows = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice")
    placed = ordered_positions(rows, ["o_totalprice", "o_orderkey"], "pos")
    return placed.select("o_orderkey", "pos")


@query("w5_positions_as_written", "SELECT unnest(range(count(*))) AS pos FROM events")
def w5_written(spark, sf):
    return written_positions(Tables(spark, sf).events.select("event_id"), "pos").select("pos")


@query(
    "o2_top_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000",
)
def o2(spark, sf):
    rows = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice")
    return top_rows(rows, [F.desc("o_totalprice"), "o_orderkey"], 1000)


@query(
    "o4_head_and_tail",
    """
    (SELECT o_orderkey, o_orderdate, 'head' AS part FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 10)
    UNION ALL
    (SELECT o_orderkey, o_orderdate, 'tail' AS part FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10)
    """,
)
def o4(spark, sf):
    return head_and_tail(Tables(spark, sf).orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"])


@query(
    "u1_union_of_sources",
    """
    SELECT c_custkey AS station_id, c_name AS Location, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier
    """,
)
def u1(spark, sf):
    t = Tables(spark, sf)
    named = lambda df, p, k: df.select(
        F.col(f"{p}_{k}").alias("station_id"), F.col(f"{p}_name").alias("Location"), F.col(f"{p}_acctbal").alias("balance")
    )
    return named(t.customer, "c", "custkey").unionByName(named(t.supplier, "s", "suppkey"))
