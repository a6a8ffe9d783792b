"""Dates, text extraction, templates, display text and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from petrichor.functions import dates, rain, text
from petrichor.sources.bulletins import digest, digest_lines, name_parts
from petrichor.sources.tables import to_records
from petrichor.workload.base import Tables, query


@query(
    "f1_unpadded_dates",
    """
    SELECT o_orderkey, o_orderdate::DATE AS day, strftime(o_orderdate, '%Y-%m-%d') AS padded FROM orders
    """,
)
def f1(spark, sf):
    day = F.col("o_orderdate")
    raw = F.format_string("%d-%02d-%d", F.year(day), F.month(day), F.dayofmonth(day))
    rows = Tables(spark, sf).orders.select("o_orderkey", raw.alias("raw"))
    return rows.select(
        "o_orderkey", dates.parse_day(F.col("raw")).alias("day"), dates.pad_day(F.col("raw")).alias("padded")
    )


@query(
    "f2_date_parts",
    """
    SELECT l_orderkey, l_linenumber, year(l_shipdate)::INTEGER AS "Year", month(l_shipdate)::INTEGER AS "Month",
           day(l_shipdate)::INTEGER AS "Day" FROM lineitem
    """,
)
def f2(spark, sf):
    rows = Tables(spark, sf).lineitem
    return rows.select("l_orderkey", "l_linenumber", *dates.date_parts(F.col("l_shipdate")))


@query(
    "f4_label_codes",
    """
    SELECT event_id, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 0 END AS code FROM events
    """,
)
def f4(spark, sf):
    answer = F.when(F.col("event_type") == "click", "Yes").when(F.col("event_type") == "view", "No").otherwise("?")
    return Tables(spark, sf).events.select("event_id", rain.yes_no_code(answer).alias("code"))


@query(
    "f9_text_between",
    """
    SELECT page_id, CASE WHEN strpos(html, '<title>') > 0 AND strpos(html, '</title>') > 0
                         THEN substr(html, strpos(html, '<title>') + 7,
                                     greatest(strpos(html, '</title>') - strpos(html, '<title>') - 7, 0))
                         ELSE '' END AS title
    FROM pages
    """,
)
def f9(spark, sf):
    return Tables(spark, sf).pages.select(
        "page_id", text.text_between(F.col("html"), "<title>", "</title>").alias("title")
    )


@query(
    "f9_text_between_missing",
    """
    SELECT doc_id, CASE WHEN strpos(text, 'the ') > 0 AND strpos(text, '.') > 0
                        THEN substr(text, strpos(text, 'the ') + 4, greatest(strpos(text, '.') - strpos(text, 'the ') - 4, 0))
                        ELSE '' END AS part
    FROM documents
    """,
)
def f9_documents(spark, sf):
    return Tables(spark, sf).documents.select("doc_id", text.text_between(F.col("text"), "the ", ".").alias("part"))


@query(
    "f12_epoch_text",
    """
    SELECT event_id, strftime(ts, '%d-%m-%Y %H:%M:%S') AS created FROM events
    """,
)
def f12(spark, sf):
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    ms = F.timestamp_diff("MILLISECOND", epoch, F.col("ts"))
    return Tables(spark, sf).events.select("event_id", dates.epoch_ms_text(ms).alias("created"))


@query(
    "f13_relative_gain",
    """
    SELECT l_orderkey, l_linenumber, round((l_tax - l_discount) / nullif(l_discount, 0), 6) AS gain,
           coalesce((l_tax - l_discount) / nullif(l_discount, 0) > 0.01, l_tax > 0) AS promote
    FROM lineitem
    """,
)
def f13(spark, sf):
    new, old = F.col("l_tax"), F.col("l_discount")
    return Tables(spark, sf).lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.round(rain.relative_gain(new, old), 6).alias("gain"),
        rain.is_promoted(new, old, 0.01).alias("promote"),
    )


@query(
    "f14_f15_display_text",
    """
    SELECT event_id, value / 512 > 0.5 AS will_rain, printf('%.1f%%', value * 100 / 512) AS percent,
           CASE WHEN event_type = 'error' THEN '' ELSE printf('%.3f', value / 490.5) END AS metric
    FROM events
    """,
)
def f14(spark, sf):
    share = F.col("value") / 512
    metric = F.when(F.col("event_type") != "error", F.col("value") / 490.5)
    return Tables(spark, sf).events.select(
        "event_id",
        rain.will_rain(share).alias("will_rain"),
        text.percent_text(share).alias("percent"),
        text.metric_text(metric).alias("metric"),
    )


@query(
    "f16_optional_metric",
    """
    SELECT event_id, (props->>'$.k')::BIGINT AS k, NULL::BIGINT AS missing FROM events
    """,
)
def f16(spark, sf):
    props = F.from_json("props", "map<string,bigint>")
    rows = Tables(spark, sf).events.select("event_id", props.alias("m"))
    return rows.select(
        "event_id",
        F.try_element_at("m", F.lit("k")).alias("k"),
        F.try_element_at("m", F.lit("no such key")).alias("missing"),
    )


@query(
    "f17_json_records",
    """
    SELECT '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":'
           || CASE WHEN n_regionkey = 2 THEN 'null' ELSE n_regionkey::VARCHAR END || '}' AS record
    FROM nation
    """,
)
def f17(spark, sf):
    region = F.when(F.col("n_regionkey") != 2, F.col("n_regionkey")).alias("n_regionkey")
    return to_records(Tables(spark, sf).nation.select("n_nationkey", "n_name", region))


@query(
    "s1_cp1252_text",
    """
    SELECT doc_id, md5(regexp_replace(text, '[^\\x{00}-\\x{7f}\\x{a0}-\\x{ff}]', '?', 'g')) AS digest FROM documents
    """,
)
def s1(spark, sf):
    latin = F.regexp_replace("text", r"[^\x00-\x7f\xa0-\xff]", "?")
    raw = F.encode(latin, "ISO-8859-1")
    return Tables(spark, sf).documents.select("doc_id", F.md5(text.cp1252_text(raw)).alias("digest"))


BULLETIN_SQL = """
    SELECT doc_id, string_split(concat('"', source, '"', chr(10), chr(10), ',Head,er', chr(10),
                                replace(text, '. ', chr(10) || ',')), chr(10)) AS lines FROM documents
"""


def _bulletins(spark, sf):
    """Documents dressed as bulletins: preamble, blank line, header, then comma lines."""
    body = F.replace(F.col("text"), F.lit(". "), F.lit("\n,"))
    content = F.concat(F.lit('"'), "source", F.lit('"\n\n,Head,er\n'), body)
    return Tables(spark, sf).documents.select("doc_id", content.alias("content"))


DIGEST_SQL = f"""
    WITH b AS ({BULLETIN_SQL}),
         l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM b),
         k AS (SELECT * FROM l WHERE line <> '' AND NOT starts_with(line, '"')),
         h AS (SELECT doc_id, min(i) AS i FROM k WHERE starts_with(line, ',') GROUP BY 1)
    SELECT k.doc_id, count(*) AS lines, sum(length(line))::BIGINT AS chars, min(md5(line)) AS low, max(md5(line)) AS high
    FROM k JOIN h ON k.doc_id = h.doc_id AND k.i <> h.i GROUP BY k.doc_id
"""


def _digest_sums(lines):
    return lines.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.length("line")).alias("chars"),
        F.min(F.md5("line")).alias("low"),
        F.max(F.md5("line")).alias("high"),
    )


@query("s2_digest_of_bulletins", DIGEST_SQL)
def s2(spark, sf):
    return _digest_sums(digest(_bulletins(spark, sf)))


@query("s2_digest_of_lines", DIGEST_SQL)
def s2_lines(spark, sf):
    lines = _bulletins(spark, sf).select("doc_id", F.posexplode(F.split("content", "\n")).alias("line_no", "line"))
    return _digest_sums(digest_lines(lines, "doc_id", "line_no", "line"))


@query(
    "s6_file_name_parts",
    """
    SELECT c_custkey, replace(c_name, '#', '') AS data_id, '2024' || lpad((c_custkey % 12 + 1)::VARCHAR, 2, '0') AS period
    FROM customer
    """,
)
def s6(spark, sf):
    month = F.format_string("2024%02d", F.col("c_custkey") % 12 + 1)
    name = text.file_name(F.replace(F.col("c_name"), F.lit("#"), F.lit("")), month)
    return Tables(spark, sf).customer.select("c_custkey", name.alias("f")).select("c_custkey", *name_parts(F.col("f")))
