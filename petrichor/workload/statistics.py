"""Aggregates, imputation, capping, scaling, balancing, splits and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from petrichor.operators.balance import oversample
from petrichor.operators.impute import cap_iqr, impute_group_median, impute_mode, iqr_limits
from petrichor.operators.metrics import classification_metrics, classification_report, confusion, regression_metrics
from petrichor.operators.modes import modes
from petrichor.operators.order_stats import medians, quantiles
from petrichor.operators.positions import written_positions
from petrichor.operators.profile import class_counts, correlation, correlation_matrix, null_shares, profile
from petrichor.operators.split import ranges_of, scale, split, with_fold
from petrichor.workload.base import Tables, query


@query(
    "a1_modes",
    """
    SELECT (SELECT o_orderpriority FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS o_orderpriority,
           (SELECT o_orderstatus FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS o_orderstatus
    """,
)
def a1(spark, sf):
    return modes(Tables(spark, sf).orders, ["o_orderpriority", "o_orderstatus"])


@query(
    "i1_impute_mode",
    """
    WITH g AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS p FROM orders),
         m AS (SELECT p FROM g WHERE p IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, p LIMIT 1)
    SELECT o_orderkey, coalesce(p, (SELECT p FROM m)) AS o_orderpriority FROM g
    """,
)
def i1(spark, sf):
    gaps = Tables(spark, sf).orders.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("o_orderpriority")
    )
    return impute_mode(gaps, ["o_orderpriority"])


@query(
    "a2_median_by_group",
    """
    SELECT l_returnflag, median(l_quantity) AS l_quantity, round(median(l_extendedprice), 4) AS l_extendedprice
    FROM lineitem GROUP BY 1
    """,
)
def a2(spark, sf):
    out = medians(Tables(spark, sf).lineitem, ["l_quantity", "l_extendedprice"], ["l_returnflag"])
    return out.withColumn("l_extendedprice", F.round("l_extendedprice", 4))


@query(
    "a2_median_by_bracket",
    """
    SELECT l_returnflag, median(l_quantity) AS l_quantity, round(median(l_extendedprice), 4) AS l_extendedprice
    FROM lineitem GROUP BY 1
    """,
)
def a2_bracket(spark, sf):
    """The way taken when a group is too large to buffer."""
    out = medians(Tables(spark, sf).lineitem, ["l_quantity", "l_extendedprice"], ["l_returnflag"], buffered=0)
    return out.withColumn("l_extendedprice", F.round("l_extendedprice", 4))


@query("a2_median_by_many_groups", "SELECT l_partkey, median(l_quantity) AS l_quantity FROM lineitem GROUP BY 1")
def a2_many(spark, sf):
    return medians(Tables(spark, sf).lineitem, ["l_quantity"], ["l_partkey"])


@query(
    "i2_u3_impute_group_median",
    """
    WITH g AS (SELECT l_orderkey, l_linenumber, l_shipmode,
                      CASE WHEN l_orderkey % 6 = 0 THEN NULL ELSE l_quantity END AS q
               FROM (SELECT *, l_returnflag || l_linestatus AS l_shipmode FROM lineitem)),
         m AS (SELECT l_shipmode, median(q) AS med FROM g GROUP BY 1)
    SELECT l_orderkey, l_linenumber, l_shipmode AS flags, coalesce(q, med, 0) AS l_quantity
    FROM g JOIN m USING (l_shipmode)
    """,
)
def i2(spark, sf):
    gaps = Tables(spark, sf).lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.concat("l_returnflag", "l_linestatus").alias("flags"),
        F.when(F.col("l_orderkey") % 6 != 0, F.col("l_quantity")).alias("l_quantity"),
    )
    return impute_group_median(gaps, ["flags"], ["l_quantity"])


@query(
    "a3_quartiles",
    """
    SELECT round(quantile_cont(l_extendedprice, 0.25), 4) AS price_q1, round(quantile_cont(l_extendedprice, 0.75), 4) AS price_q3,
           round(quantile_cont(l_quantity, 0.25), 4) AS quantity_q1, round(quantile_cont(l_quantity, 0.75), 4) AS quantity_q3
    FROM lineitem
    """,
)
def a3(spark, sf):
    q = quantiles(Tables(spark, sf).lineitem, ["l_extendedprice", "l_quantity"], [0.25, 0.75])
    return q.select(
        *[
            F.round(F.col(c)[i], 4).alias(f"{n}_q{2 * i + 1}")
            for c, n in (("l_extendedprice", "price"), ("l_quantity", "quantity"))
            for i in (0, 1)
        ]
    )


@query(
    "a3_quartiles_by_bracket",
    """
    SELECT round(quantile_cont(l_extendedprice, 0.25), 4) AS price_q1, round(quantile_cont(l_extendedprice, 0.75), 4) AS price_q3,
           round(quantile_cont(l_quantity, 0.1), 4) AS quantity_d1
    FROM lineitem
    """,
)
def a3_bracket(spark, sf):
    """The way taken when the table is too large to buffer."""
    lines = Tables(spark, sf).lineitem
    price = quantiles(lines, ["l_extendedprice", "l_quantity"], [0.1, 0.25, 0.75], buffered=0)
    return price.select(
        F.round(F.col("l_extendedprice")[1], 4).alias("price_q1"),
        F.round(F.col("l_extendedprice")[2], 4).alias("price_q3"),
        F.round(F.col("l_quantity")[0], 4).alias("quantity_d1"),
    )


@query("a3_quartiles_by_sketch")
def a3_sketch(spark, sf):
    q = quantiles(Tables(spark, sf).lineitem, ["l_extendedprice", "l_quantity"], [0.25, 0.75], exact=False)
    return q.select(F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"))


CAP_SQL = """
    WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS a1, quantile_cont(o_totalprice, 0.75) AS a3 FROM orders)
    SELECT o_orderkey, round(CASE WHEN o_totalprice < a1 - (a3 - a1) * 0.2 THEN a1 - (a3 - a1) * 0.2
                                  WHEN o_totalprice > a3 + (a3 - a1) * 0.2 THEN a3 + (a3 - a1) * 0.2
                                  ELSE o_totalprice END, 4) AS o_totalprice
    FROM orders, q
"""


@query("i3_f7_cap_iqr", CAP_SQL)
def i3(spark, sf):
    rows = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice")
    return cap_iqr(rows, ["o_totalprice"], k=0.2).withColumn("o_totalprice", F.round("o_totalprice", 4))


@query(
    "i3_iqr_limits",
    """
    SELECT round(q1 - 1.5 * (q3 - q1), 4) AS low, round(q3 + 1.5 * (q3 - q1), 4) AS high FROM (
      SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
    """,
)
def i3_limits(spark, sf):
    limits = iqr_limits(Tables(spark, sf).events, ["value"])
    return limits.select(F.round("value.low", 4).alias("low"), F.round("value.high", 4).alias("high"))


@query("a4_class_counts", "SELECT toxic, count(*) AS rows FROM labels GROUP BY toxic")
def a4(spark, sf):
    return class_counts(Tables(spark, sf).labels, "toxic")


GAPS_SQL = """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value,
           CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS event_type FROM events
"""


def _gaps(spark, sf):
    return Tables(spark, sf).events.select(
        "event_id",
        F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("event_type"),
    )


@query(
    "a6_o5_null_shares",
    f"""
    WITH g AS ({GAPS_SQL})
    SELECT 'event_id' AS "column", count(*) FILTER (event_id IS NULL) AS null_count, round(count(*) FILTER (event_id IS NULL) / count(*)::DOUBLE, 6) AS null_share FROM g
    UNION ALL SELECT 'value', count(*) FILTER (value IS NULL), round(count(*) FILTER (value IS NULL) / count(*)::DOUBLE, 6) FROM g
    UNION ALL SELECT 'event_type', count(*) FILTER (event_type IS NULL), round(count(*) FILTER (event_type IS NULL) / count(*)::DOUBLE, 6) FROM g
    """,
)
def a6(spark, sf):
    return null_shares(_gaps(spark, sf)).withColumn("null_share", F.round("null_share", 6))


@query(
    "o5_null_share_order",
    f"""
    WITH g AS ({GAPS_SQL}), s AS (
      SELECT 'event_id' AS "column", count(*) FILTER (event_id IS NULL) AS n FROM g
      UNION ALL SELECT 'value', count(*) FILTER (value IS NULL) FROM g
      UNION ALL SELECT 'event_type', count(*) FILTER (event_type IS NULL) FROM g)
    SELECT "column", row_number() OVER (ORDER BY n DESC, "column") - 1 AS position FROM s
    """,
)
def o5(spark, sf):
    """Where each column stands in the listing as written."""
    return written_positions(null_shares(_gaps(spark, sf)).select("column"), "position")


@query("a7_distinct_values", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def a7(spark, sf):
    return Tables(spark, sf).lineitem.select("l_suppkey", "l_returnflag").distinct()


@query(
    "a8_correlation_of_pairs",
    """
    SELECT round(corr(l_quantity, l_extendedprice), 6) AS quantity_price,
           round(corr(l_quantity, l_tax), 6) AS quantity_tax, round(corr(l_discount, l_tax), 6) AS discount_tax
    FROM lineitem
    """,
)
def a8(spark, sf):
    return Tables(spark, sf).lineitem.agg(
        F.round(correlation("l_quantity", "l_extendedprice"), 6).alias("quantity_price"),
        F.round(correlation("l_quantity", "l_tax"), 6).alias("quantity_tax"),
        F.round(correlation("l_discount", "l_tax"), 6).alias("discount_tax"),
    )


MATRIX = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "a9_correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a in MATRIX for b in MATRIX
    ),
)
def a9(spark, sf):
    return correlation_matrix(Tables(spark, sf).lineitem, MATRIX).withColumn("r", F.round("r", 6))


@query("a10_ranges", "SELECT min(c_acctbal) AS low, max(c_acctbal) AS high FROM customer")
def a10(spark, sf):
    return ranges_of(Tables(spark, sf).customer, ["c_acctbal"]).select("c_acctbal.low", "c_acctbal.high")


@query(
    "f8_min_max_scale",
    """
    WITH r AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)
    SELECT c_custkey, round((c_acctbal - lo) / (hi - lo), 6) AS c_acctbal, 0.0::DOUBLE AS constant FROM customer, r
    """,
)
def f8(spark, sf):
    rows = Tables(spark, sf).customer.select("c_custkey", "c_acctbal", F.lit(7).alias("constant"))
    return scale(rows, ["c_acctbal", "constant"]).withColumn("c_acctbal", F.round("c_acctbal", 6))


SCORED_SQL = "SELECT toxic, CASE WHEN quality = 1 AND doc_id % 4 <> 0 THEN 0 ELSE 1 END AS guess FROM labels"

METRICS_SQL = f"""
    WITH s AS ({SCORED_SQL}),
    k AS (SELECT c, count(*) FILTER (toxic = c) AS support, count(*) FILTER (guess = c) AS predicted,
                 count(*) FILTER (toxic = c AND guess = c) AS tp
          FROM s, (VALUES (0), (1)) v(c) GROUP BY c),
    p AS (SELECT c, support, tp, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted::DOUBLE END AS precision,
                 CASE WHEN support = 0 THEN 0 ELSE tp / support::DOUBLE END AS recall FROM k),
    f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1_score FROM p)
"""


def _scored(spark, sf):
    guess = F.when((F.col("quality") == 1) & (F.col("doc_id") % 4 != 0), 0).otherwise(1)
    return Tables(spark, sf).labels.select("toxic", guess.alias("guess"))


@query(
    "a11_confusion_counts",
    f"SELECT toxic::DOUBLE AS label, guess::DOUBLE AS prediction, count(*) AS n FROM ({SCORED_SQL}) GROUP BY ALL",
)
def a11_counts(spark, sf):
    return confusion(_scored(spark, sf), "toxic", "guess")


@query(
    "a11_classification_metrics",
    f"""{METRICS_SQL}
    SELECT round(sum(tp) / sum(support)::DOUBLE, 6) AS accuracy, round(sum(precision * support) / sum(support), 6) AS precision,
           round(sum(recall * support) / sum(support), 6) AS recall, round(sum(f1_score * support) / sum(support), 6) AS f1_score
    FROM f
    """,
)
def a11(spark, sf):
    m = classification_metrics(_scored(spark, sf), "toxic", "guess")
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@query(
    "a12_classification_report",
    f"""{METRICS_SQL}
    SELECT c::DOUBLE::VARCHAR AS class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, support FROM f
    UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support)::DOUBLE, 6), round(sum(tp) / sum(support)::DOUBLE, 6), round(sum(tp) / sum(support)::DOUBLE, 6), sum(support)::BIGINT FROM f
    UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1_score), 6), sum(support)::BIGINT FROM f
    UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                     round(sum(f1_score * support) / sum(support), 6), sum(support)::BIGINT FROM f
    """,
)
def a12(spark, sf):
    r = classification_report(_scored(spark, sf), "toxic", "guess")
    return r.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1_score")], "support")


@query(
    "a13_regression_metrics",
    """
    WITH e AS (SELECT l_extendedprice AS y, l_extendedprice - l_quantity * 2000 AS d FROM lineitem)
    SELECT round(avg(d * d), 2) AS mse, round(sqrt(avg(d * d)), 4) AS rmse, round(1 - avg(d * d) / var_pop(y), 6) AS r2 FROM e
    """,
)
def a13(spark, sf):
    rows = Tables(spark, sf).lineitem.select("l_extendedprice", (F.col("l_quantity") * 2000).alias("guess"))
    m = regression_metrics(rows, "l_extendedprice", "guess")
    return m.select(F.round("mse", 2).alias("mse"), F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"))


@query(
    "a14_profile",
    f"""
    WITH g AS ({GAPS_SQL})
    SELECT 'event_id' AS "column", 'bigint' AS type, count(event_id) AS non_null, count(*) AS rows FROM g
    UNION ALL SELECT 'value', 'double', count(value), count(*) FROM g
    UNION ALL SELECT 'event_type', 'string', count(event_type), count(*) FROM g
    """,
)
def a14(spark, sf):
    return profile(_gaps(spark, sf))


ROW_HASH_SQL = "('0x' || substr(md5('{seed}|' || {key}), 1, 15))::BIGINT"


@query(
    "i5_u2_balance_by_cycle",
    """
    WITH n AS (SELECT count(*) FILTER (toxic = 0) AS n0, count(*) FILTER (toxic = 1) AS n1 FROM labels),
         p AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM labels WHERE toxic = 1)
    SELECT doc_id, quality, toxic FROM labels WHERE toxic = 0
    UNION ALL
    SELECT doc_id, quality, toxic FROM n, LATERAL (SELECT unnest(range(n0)) AS slot) s JOIN p ON pos = slot % n1
    """,
)
def i5(spark, sf):
    return oversample(Tables(spark, sf).labels, "toxic", ["doc_id"], "cycle").select("doc_id", "quality", "toxic")


@query(
    "i5_balance_by_shuffled_cycle",
    f"""
    WITH n AS (SELECT count(*) FILTER (toxic = 0) AS n0, count(*) FILTER (toxic = 1) AS n1 FROM labels),
         p AS (SELECT *, row_number() OVER (ORDER BY {ROW_HASH_SQL.format(seed=123, key="doc_id")}) - 1 AS pos
               FROM labels WHERE toxic = 1)
    SELECT doc_id, quality, toxic FROM labels WHERE toxic = 0
    UNION ALL
    SELECT doc_id, quality, toxic FROM n, LATERAL (SELECT unnest(range(n0)) AS slot) s JOIN p ON pos = slot % n1
    """,
)
def i5_shuffled(spark, sf):
    out = oversample(Tables(spark, sf).labels, "toxic", ["doc_id"], "shuffled_cycle")
    return out.select("doc_id", "quality", "toxic")


@query(
    "i5_balance_by_draw",
    """
    SELECT c AS toxic, (SELECT count(*) FROM labels WHERE toxic = 0) AS rows FROM (VALUES (0), (1)) v(c)
    """,
)
def i5_draw(spark, sf):
    return class_counts(oversample(Tables(spark, sf).labels, "toxic", ["doc_id"], "draw"), "toxic")


@query(
    "i5_draws_row_by_row",
    """
    WITH n AS (SELECT count(*) FILTER (toxic = 0) AS n0, count(*) FILTER (toxic = 1) AS n1 FROM labels),
         p AS (SELECT *, row_number() OVER (ORDER BY ('0x' || substr(md5('123|' || doc_id), 1, 15))::BIGINT, doc_id) - 1 AS pos
               FROM labels WHERE toxic = 1)
    SELECT doc_id, toxic, quality FROM labels WHERE toxic = 0
    UNION ALL
    SELECT doc_id, toxic, quality FROM n, LATERAL (SELECT unnest(range(n0)) AS slot) s
    JOIN p ON pos = ('0x' || substr(md5('123|' || slot), 1, 15))::BIGINT % n1
    """,
)
def i5_drawn_rows(spark, sf):
    """Every draw is an md5 of its number, so SQL draws the same rows."""
    return oversample(Tables(spark, sf).labels, "toxic", ["doc_id"], "draw").select("doc_id", "toxic", "quality")


@query(
    "i5_balance_many_classes_of_rows",
    """
    WITH r AS (SELECT l_orderkey * 8 + l_linenumber AS id, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem),
         n AS (SELECT count(*) FILTER (y = 0) AS n0, count(*) FILTER (y = 1) AS n1 FROM r),
         p AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS pos FROM r WHERE y = 1)
    SELECT id, y FROM r WHERE y = 0
    UNION ALL SELECT id, y FROM n, LATERAL (SELECT unnest(range(n0)) AS slot) s JOIN p ON pos = slot % n1
    """,
)
def i5_large(spark, sf):
    """The last row that gets one more copy is found by brackets."""
    rows = Tables(spark, sf).lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
    )
    return oversample(rows, "y", ["id"], "cycle", buffered=0)


@query(
    "m1_hash_split",
    f"""
    SELECT o_orderkey, CASE WHEN {ROW_HASH_SQL.format(seed=42, key="o_orderkey")} < 230584300921369395 THEN 'test' ELSE 'train' END AS side
    FROM orders
    """,
)
def m1(spark, sf):
    train, test = split(Tables(spark, sf).orders.select("o_orderkey"), ["o_orderkey"])
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@query(
    "m2_stratified_split",
    f"""
    SELECT doc_id, toxic, CASE WHEN rn <= ceil(round(n * 0.2, 6)) THEN 'test' ELSE 'train' END AS side FROM (
      SELECT doc_id, toxic, count(*) OVER (PARTITION BY toxic) AS n,
             row_number() OVER (PARTITION BY toxic ORDER BY {ROW_HASH_SQL.format(seed=42, key="doc_id")}) AS rn
      FROM labels)
    """,
)
def m2(spark, sf):
    train, test = split(Tables(spark, sf).labels.select("doc_id", "toxic"), ["doc_id"], stratify="toxic")
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@query(
    "m2_stratified_split_by_bracket",
    f"""
    SELECT o_orderkey, o_orderstatus, CASE WHEN rn <= ceil(round(n * 0.2, 6)) THEN 'test' ELSE 'train' END AS side FROM (
      SELECT o_orderkey, o_orderstatus, count(*) OVER (PARTITION BY o_orderstatus) AS n,
             row_number() OVER (PARTITION BY o_orderstatus ORDER BY {ROW_HASH_SQL.format(seed=42, key="o_orderkey")}) AS rn
      FROM orders)
    """,
)
def m2_bracket(spark, sf):
    """The way taken when a class is too large to number."""
    rows = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus")
    train, test = split(rows, ["o_orderkey"], stratify="o_orderstatus", buffered=0)
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@query(
    "m5_stratified_folds",
    f"""
    SELECT doc_id, toxic, ((rn > ceil(round(n * 0.2, 6)))::INTEGER + (rn > ceil(round(n * 0.4, 6)))::INTEGER
         + (rn > ceil(round(n * 0.6, 6)))::INTEGER + (rn > ceil(round(n * 0.8, 6)))::INTEGER)::INTEGER AS fold
    FROM (SELECT doc_id, toxic, count(*) OVER (PARTITION BY toxic) AS n,
                 row_number() OVER (PARTITION BY toxic ORDER BY {ROW_HASH_SQL.format(seed=42, key="doc_id")}) AS rn
          FROM labels)
    """,
)
def m5_folds(spark, sf):
    return with_fold(Tables(spark, sf).labels.select("doc_id", "toxic"), ["doc_id"], "toxic")
