"""Bulletins derived from the events table, taken through the whole chain.

Each user stands for a station and each day with events for one line of its monthly bulletin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from petrichor.operators.dictionary import decoded
from petrichor.operators.profile import correlation_matrix
from petrichor.plans import jobs
from petrichor.plans.clean import clean
from petrichor.plans.daily import daily_observations
from petrichor.schemas import CAPPED_COLUMNS, CLEAN_COLUMNS, DAILY_COLUMNS, DIGEST_FIELDS, MEASURES, WIND_DIRECTIONS
from petrichor.session import scratch_path
from petrichor.sources.bulletins import digest, name_parts, parse_digest, read_digest, write_files
from petrichor.sources.bulletins import quarantine, read_digest_folders, write_digest
from petrichor.sources.tables import write_csv
from petrichor.functions.text import cp1252_text
from petrichor.streaming.observations import digest_folder_stream, digest_stream, labelled_observations, write_labelled, write_log
from petrichor.workload.base import Tables, query

COMPASS = ["N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE", "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW"]

# Each field as an SQL text over: mn, mx (lowest and highest value), e, x (lowest and highest
# event id) and u (user). The same text serves Spark and the oracle.
FIELDS = {
    "MinTemp": "CASE WHEN e % 19 <> 0 THEN mn END",
    "MaxTemp": "mx",
    "Rainfall": "CASE WHEN e % 7 <> 0 THEN (e % 30) / 10e0 END",
    "Evaporation": "CASE WHEN u % 3 <> 0 AND e % 5 <> 0 THEN (x % 50) / 10e0 END",
    "Sunshine": "CASE WHEN e % 2 <> 0 THEN (x % 12) / 1e0 END",
    "WindGustDir": "CASE WHEN e % 17 <> 0 THEN d1 END",
    "WindGustSpeed": "CASE WHEN x % 11 <> 0 THEN (x % 90) / 1e0 END",
    "Temp9am": "(e % 35) + 0.5e0",
    "Humidity9am": "(x % 100) / 1e0",
    "Cloud9am": "CASE WHEN x % 3 <> 0 THEN (x % 9) / 1e0 END",
    "WindDir9am": "CASE WHEN x % 13 = 0 THEN ' ' ELSE d2 END",
    "WindSpeed9am": "CASE WHEN x % 13 = 0 THEN 'Calm' WHEN e % 23 <> 0 THEN w1 END",
    "Pressure9am": "990 + (e % 400) / 10e0",
    "Temp3pm": "(x % 40) + 0.25e0",
    "Humidity3pm": "(e % 100) / 1e0",
    "Cloud3pm": "CASE WHEN e % 4 <> 0 THEN (e % 9) / 1e0 END",
    "WindDir3pm": "CASE WHEN x % 29 <> 0 THEN d3 END",
    "WindSpeed3pm": "CASE WHEN e % 31 = 0 THEN 'Calm' ELSE w2 END",
    "Pressure3pm": "CASE WHEN x % 6 <> 0 THEN 985 + (x % 400) / 10e0 END",
}


def station_days(spark: SparkSession, sf: str) -> DataFrame:
    """One row per user and day with the numbers the fields are made of."""
    days = (
        Tables(spark, sf)
        .events.groupBy(F.col("user_id").alias("u"), F.to_date("ts").alias("day"))
        .agg(
            F.min("value").alias("mn"),
            F.max("value").alias("mx"),
            F.min("event_id").alias("e"),
            F.max("event_id").alias("x"),
        )
    )
    compass = F.array(*[F.lit(c) for c in COMPASS])
    direction = lambda n: F.element_at(compass, (n % 16 + 1).cast("int"))
    return days.withColumns(
        {
            "d1": direction(F.col("e")),
            "d2": direction(F.col("x")),
            "d3": direction(F.col("e") + F.col("x")),
            "w1": (F.col("x") % 40).cast("string"),
            "w2": (F.col("e") % 50).cast("string"),
        }
    )


def bulletins(spark: SparkSession, sf: str) -> DataFrame:
    """(file_name, content): one Windows-1252 text per station and month, at most 31 lines each."""
    value = {n: F.expr(sql).cast("string") for n, sql in FIELDS.items()}
    day = F.format_string("%d-%02d-%d", F.year("day"), F.month("day"), F.dayofmonth("day"))
    cells = {"Date": day, "Time of maximum wind gust": F.lit("12:00")} | value
    line = F.concat_ws(",", *[F.coalesce(cells.get(n, F.lit("")), F.lit("")) for n in DIGEST_FIELDS])
    lines = station_days(spark, sf).select("u", "day", line.alias("line"))
    header = F.lit('"Daily Weather Observations, temperatures in °C"\r\n\r\n,"Date","MinTemp"\r\n')
    return (
        lines.groupBy("u", F.date_format("day", "yyyyMM").alias("period"))
        .agg(F.sort_array(F.collect_list(F.struct("day", "line"))).alias("l"))
        .select(
            F.format_string("ST%d.%s.csv", "u", "period").alias("file_name"),
            F.concat(header, F.array_join(F.col("l.line"), "\r\n"), F.lit("\r\n")).alias("content"),
        )
    )


def stations(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as stations: (data_id, Location)."""
    return Tables(spark, sf).customer.select(
        F.format_string("ST%d", "c_custkey").alias("data_id"), F.col("c_name").alias("Location")
    )


def digested(spark: SparkSession, sf: str) -> DataFrame:
    """Bulletins through bytes, decoding, digest and field parsing."""
    raw = bulletins(spark, sf).select("file_name", F.encode("content", "ISO-8859-1").alias("bytes"))
    texts = raw.select("file_name", cp1252_text(F.col("bytes")).alias("content"))
    fields = parse_digest(digest(texts))
    return fields.select("*", *name_parts(F.col("file_name")))


def weather(spark: SparkSession, sf: str, label_scope: str = "file") -> DataFrame:
    return daily_observations(digested(spark, sf), stations(spark, sf), label_scope, unknown="drop")


_COMPASS_SQL = "[" + ", ".join(f"'{c}'" for c in COMPASS) + "]"
_FIELD_SQL = ",\n".join(f'{sql} AS "{n}"' for n, sql in FIELDS.items())
_KEPT = ", ".join(f'"{c}"' for c in DAILY_COLUMNS[2:21])

DAYS_SQL = f"""
    g AS (SELECT user_id AS u, ts::DATE AS "Date", min(value) AS mn, max(value) AS mx, min(event_id) AS e, max(event_id) AS x
          FROM events GROUP BY ALL),
    n AS (SELECT *, ({_COMPASS_SQL})[e % 16 + 1] AS d1, ({_COMPASS_SQL})[x % 16 + 1] AS d2,
                 ({_COMPASS_SQL})[(e + x) % 16 + 1] AS d3, (x % 40)::VARCHAR AS w1, (e % 50)::VARCHAR AS w2 FROM g),
    obs AS (SELECT "Date", c_name AS "Location", u, {_FIELD_SQL} FROM n JOIN customer ON u = c_custkey),
    today AS (SELECT *, CASE WHEN "Rainfall" >= 1 THEN 'Yes' ELSE 'No' END AS "RainToday" FROM obs),
    daily AS (SELECT *, lead("RainToday") OVER (PARTITION BY u, strftime("Date", '%Y%m') ORDER BY "Date") AS "RainTomorrow"
              FROM today)
"""

DAILY_SQL = f"""WITH {DAYS_SQL} SELECT "Date", "Location", {_KEPT}, "RainToday", "RainTomorrow" FROM daily"""


@query("k1_daily_from_bulletins", DAILY_SQL)
def k1_daily(spark, sf):
    return weather(spark, sf)


@query(
    "k1_daily_across_bulletins",
    f"""
    WITH {DAYS_SQL}
    SELECT "Date", "Location", {_KEPT}, "RainToday",
           (SELECT t."RainToday" FROM today t WHERE t.u = d.u AND t."Date" = d."Date" + 1) AS "RainTomorrow"
    FROM daily d
    """,
)
def k1_across(spark, sf):
    return weather(spark, sf, "location")


@query("s1_s3_s5_daily_from_digest_files", DAILY_SQL)
def s3(spark, sf):
    path = scratch_path(spark, "digest")
    lines = digest(bulletins(spark, sf))
    write_digest(lines, path)
    return daily_observations(read_digest_folders(spark, path), stations(spark, sf), unknown="drop")


@query("x1_daily_from_stream", DAILY_SQL)
def x1(spark, sf):
    """Digest files arrive, are streamed into the log and read back labelled."""
    path = scratch_path(spark, "arrivals")
    write_digest(digest(bulletins(spark, sf)), f"{path}/in")
    log = f"{path}/log"
    write_log(digest_folder_stream(spark, f"{path}/in"), log, f"{path}/checkpoint").awaitTermination()
    known = stations(spark, sf)
    return labelled_observations(spark, log, known, unknown="drop")


def _odd(name: str = "file_name") -> Column:
    """Whether a bulletin is that of a station with an odd number."""
    return F.regexp_extract(name, r"^ST(\d+)", 1).cast("long") % 2 == 1


def _stale(content: Column, sep: str, head: int) -> Column:
    """A bulletin as issued earlier in its month: the first half of its lines."""
    lines = F.split(content, sep)
    days = F.size(lines) - head - 1
    return F.concat(F.array_join(F.slice(lines, F.lit(1), F.ceil(days / 2).cast("int") + head), sep), F.lit(sep))


def _refresh(files: DataFrame) -> DataFrame:
    return files.withColumn("file_name", F.replace("file_name", F.lit(".csv"), F.lit(".refresh1.csv")))


def _as_bytes(files: DataFrame) -> DataFrame:
    """Bulletins as they are delivered, in Windows-1252; their texts have no other letters than Latin-1."""
    return files.withColumn("content", F.encode("content", "ISO-8859-1"))


def delivered_whole(spark: SparkSession, sf: str) -> DataFrame:
    """All bulletins as files: (file_name, content as bytes)."""
    return _as_bytes(bulletins(spark, sf))


def _delivery(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """What arrives first, bulletins of odd stations still incomplete, and the refreshes that follow."""
    whole = bulletins(spark, sf)
    early = F.when(_odd(), _stale(F.col("content"), "\r\n", 3)).otherwise(F.col("content"))
    return whole.withColumn("content", early), _refresh(whole.where(_odd()))


def load_dims(spark: SparkSession, sf: str, path: str) -> dict[str, str]:
    """Stations and their data ids as the CSV tables that loads read."""
    known = stations(spark, sf).withColumn("id", F.substring("data_id", 3, 20))
    write_csv(known.select(F.col("id").alias("Code"), "Location", F.lit("").alias("Climat")), f"{path}/stations")
    write_csv(known.select(F.col("id").alias("station_id"), "data_id"), f"{path}/ids")
    return {"stations_path": f"{path}/stations", "ids_path": f"{path}/ids", "unknown": "drop"}


@query("k1_s1_s5_refreshed_bulletins", DAILY_SQL)
def k1_refreshed(spark, sf):
    """Bulletin files, loaded when odd stations have half their month, and again with the refreshes
    beside them; labels follow from the days held in the end."""
    path = scratch_path(spark, "load")
    dims, first, later = load_dims(spark, sf, path), *_delivery(spark, sf)
    options = dict(digest_path=f"{path}/raw", layout="raw", table=f"{path}/daily", **dims)
    for arrived in (first, later):
        write_files(_as_bytes(arrived), f"{path}/raw")
        jobs.ingest(spark, **options)
    return jobs.warehouse(spark, f"{path}/daily")


@query("s3_s5_daily_from_csv_files", DAILY_SQL)
def s3_files(spark, sf):
    """Digest files beside their refreshes, of which the newest counts."""
    path = scratch_path(spark, "digest")
    for arrived in _delivery(spark, sf):
        write_files(_digest_files(arrived), path)
    return daily_observations(read_digest(spark, path), stations(spark, sf), unknown="drop")


def _digest_files(files: DataFrame) -> DataFrame:
    """Bulletins (file_name, content) as digest files: the data lines alone, as UTF-8 bytes."""
    lines = digest(files).groupBy("file_name").agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("l"))
    return lines.select("file_name", F.encode(F.concat(F.array_join("l.line", "\n"), F.lit("\n")), "UTF-8").alias("content"))


@query("x1_labels_renewed_by_late_days", DAILY_SQL)
def x1_renewed(spark, sf):
    """A stream of digest files; the second delivery brings the rest of the month of odd stations."""
    path, known = scratch_path(spark, "arrivals"), stations(spark, sf)
    for arrived in _delivery(spark, sf):
        write_files(_digest_files(arrived), f"{path}/in")
        arriving = digest_stream(spark, f"{path}/in")
        write_labelled(arriving, f"{path}/log", f"{path}/daily", f"{path}/checkpoint", known, unknown="drop").awaitTermination()
    return spark.read.parquet(f"{path}/daily").select(*DAILY_COLUMNS)


def _load_modes(column: str) -> str:
    return f"""m_{column} AS (SELECT p, "{column}" AS v, row_number() OVER (PARTITION BY p ORDER BY count(*) DESC, "{column}") AS rn
        FROM lab WHERE "{column}" IS NOT NULL GROUP BY p, "{column}")"""


@query(
    "k1_i6_encoded_store_across_loads",
    f"""
    WITH {DAYS_SQL},
    lab AS (SELECT *, u % 2 AS p FROM daily WHERE "RainTomorrow" IS NOT NULL),
    {", ".join(_load_modes(c) for c in WIND_DIRECTIONS)}
    SELECT "Location", {", ".join(f'coalesce("{c}", m_{c}.v) AS "{c}"' for c in WIND_DIRECTIONS)},
        year("Date")::INTEGER AS "Year", month("Date")::INTEGER AS "Month", day("Date")::INTEGER AS "Day",
        CASE "RainToday" WHEN 'Yes' THEN 1 ELSE 0 END AS "RainToday", CASE "RainTomorrow" WHEN 'Yes' THEN 1 ELSE 0 END AS "RainTomorrow"
    FROM lab {" ".join(f"JOIN m_{c} ON lab.p = m_{c}.p AND m_{c}.rn = 1" for c in WIND_DIRECTIONS)}
    WHERE "WindSpeed9am" <> 'Calm' AND "WindSpeed3pm" <> 'Calm'
    """,
)
def k1_encoded(spark, sf):
    """Even stations are loaded first, odd ones later, with a stale issue of each beside its refresh;
    both loads are read back through one code table."""
    path = scratch_path(spark, "load")
    dims, first, later = load_dims(spark, sf, path), *_delivery(spark, sf)
    options = dict(digest_path=f"{path}/raw", layout="raw", table=f"{path}/encoded", store="encoded", balance=None, **dims)
    for arrived in (first.where(~_odd()), first.where(_odd()).unionByName(later)):
        write_files(_as_bytes(arrived), f"{path}/raw")
        jobs.ingest(spark, **options)
    held = jobs.EncodedStore(spark, f"{path}/encoded")
    named = ["Location", *WIND_DIRECTIONS]
    return decoded(held.rows(), held.codes(), named).select(*named, "Year", "Month", "Day", "RainToday", "RainTomorrow")


@query(
    "s2_malformed_lines_set_aside",
    """
    WITH l AS (SELECT l_orderkey AS k, CASE l_partkey % 10 WHEN 0 THEN 3 WHEN 1 THEN 24 ELSE 22 END AS n FROM lineitem)
    SELECT n AS fields, CASE n WHEN 22 THEN 'kept' ELSE 'rejected' END AS kind, count(*) AS rows, sum(k)::BIGINT AS keys,
        (SELECT count(*) FILTER ((x.n = 22) = (l.n = 22)) FROM l AS x) AS counted
    FROM l GROUP BY n
    """,
)
def s2_quarantine(spark, sf):
    """Every line item as a digest line of 22, or of too few or too many fields."""
    n = F.when(F.col("l_partkey") % 10 == 0, 3).when(F.col("l_partkey") % 10 == 1, 24).otherwise(22)
    line = F.concat(F.col("l_orderkey").cast("string"), F.repeat(F.lit(","), n - 1))
    found = quarantine(parse_digest(Tables(spark, sf).lineitem.select(line.alias("line")), bad="keep"))
    kept = found.kept.select(F.lit(22).alias("fields"), F.lit("kept").alias("kind"), F.col(DIGEST_FIELDS[0]).alias("k"), F.lit(found.n_kept).alias("counted"))
    cells = F.split("line", ",")
    rejects = found.rejects.select(F.size(cells).alias("fields"), F.lit("rejected").alias("kind"), cells[0].alias("k"), F.lit(found.rejected).alias("counted"))
    both = kept.unionByName(rejects).groupBy("fields", "kind")
    return both.agg(F.count("*").alias("rows"), F.sum(F.col("k").cast("long")).alias("keys"), F.max("counted").cast("long").alias("counted"))


CLEAN_HASH = """('0x' || substr(md5('123|' || "Location" || '|' || "Date"::VARCHAR), 1, 15))::BIGINT"""


def _sql_list(template: str, cols: list[str], sep: str = ",\n") -> str:
    return sep.join(template.format(c=c) for c in cols)


def clean_sql(balanced: bool, drawn: bool = False) -> str:
    """The whole clean job in SQL; ``drawn`` resamples with replacement and reads the word Calm as no wind."""
    calm = "" if drawn else """WHERE "WindSpeed9am" <> 'Calm' AND "WindSpeed3pm" <> 'Calm'"""
    speed = lambda c: f"""CASE "{c}" WHEN 'Calm' THEN '0' ELSE "{c}" END""" if drawn else f'"{c}"'
    if drawn:
        draw = "('0x' || substr(md5('123|' || slot), 1, 15))::BIGINT"
        source = f"""
        cnt AS (SELECT count(*) FILTER ("RainTomorrow" = 0) AS n0, count(*) FILTER ("RainTomorrow" = 1) AS n1 FROM lab),
        pool AS (SELECT *, row_number() OVER (ORDER BY {CLEAN_HASH}) - 1 AS pos FROM lab WHERE "RainTomorrow" = 1),
        bal AS (SELECT * , 0 AS copy FROM lab WHERE "RainTomorrow" = 0
                UNION ALL
                SELECT pool.* EXCLUDE (pos), 1 AS copy
                FROM cnt, LATERAL (SELECT unnest(range(n0)) AS slot) s JOIN pool ON pos = {draw} % n1)
        """
    elif balanced:
        source = f"""
        cnt AS (SELECT count(*) FILTER ("RainTomorrow" = 0) AS n0, count(*) FILTER ("RainTomorrow" = 1) AS n1 FROM lab),
        pool AS (SELECT *, row_number() OVER (ORDER BY {CLEAN_HASH}) - 1 AS pos FROM lab WHERE "RainTomorrow" = 1),
        bal AS (SELECT * , 0 AS copy FROM lab WHERE "RainTomorrow" = 0
                UNION ALL
                SELECT pool.* EXCLUDE (pos), 1 AS copy
                FROM cnt, LATERAL (SELECT unnest(range(n0)) AS slot) s JOIN pool ON pos = slot % n1)
        """
    else:
        source = "bal AS (SELECT *, 0 AS copy FROM lab)"
    modes = ",\n".join(
        f"""m_{c} AS (SELECT "{c}" AS v FROM bal WHERE "{c}" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"""
        for c in WIND_DIRECTIONS
    )
    measures = [c for c in DAILY_COLUMNS if c in MEASURES]
    uncapped = [c for c in measures if c not in CAPPED_COLUMNS]
    coded = ["Location", *WIND_DIRECTIONS, "WindSpeed9am", "WindSpeed3pm"]
    codes = ",\n".join(
        f"""c_{c} AS (SELECT v, (row_number() OVER (ORDER BY f) - 1)::INTEGER AS code FROM
            (SELECT "{c}" AS v, min(struct_pack(late := late, loc := loc, copy := copy, seen_on := seen_on)) AS f FROM capped GROUP BY 1))"""
        for c in coded
    )
    picked = {c: f'"{c}"' for c in CLEAN_COLUMNS}
    picked |= {c: f'c_{c}.code AS "{c}"' for c in coded}
    picked |= {c: f'round(capped."{c}", 4) AS "{c}"' for c in measures}
    joins = " ".join(f'JOIN c_{c} ON capped."{c}" = c_{c}.v' for c in coded)
    return f"""
    WITH {DAYS_SQL},
    lab AS (SELECT * REPLACE (CASE "RainToday" WHEN 'Yes' THEN 1 ELSE 0 END AS "RainToday",
                              CASE "RainTomorrow" WHEN 'Yes' THEN 1 ELSE 0 END AS "RainTomorrow"),
                   year("Date")::INTEGER AS "Year", month("Date")::INTEGER AS "Month", day("Date")::INTEGER AS "Day"
            FROM daily WHERE "RainTomorrow" IS NOT NULL),
    {source},
    homes AS (SELECT "Location", min(copy) AS late FROM bal GROUP BY 1),
    {modes},
    med AS (SELECT "Location", {_sql_list('median("{c}") AS "{c}"', measures)} FROM bal GROUP BY 1),
    filled AS (SELECT bal."Location", bal."Location" AS loc, late, copy, "Date" AS seen_on,
        {_sql_list('coalesce(bal."{c}", med."{c}", 0) AS "{c}"', measures)},
        {_sql_list('coalesce("{c}", (SELECT v FROM m_{c})) AS "{c}"', WIND_DIRECTIONS)},
        "WindSpeed9am", "WindSpeed3pm", "RainToday", "RainTomorrow", "Year", "Month", "Day"
        FROM bal JOIN med USING ("Location") JOIN homes USING ("Location")),
    whole AS (SELECT * REPLACE (try_cast({speed("WindSpeed9am")} AS DOUBLE) AS "WindSpeed9am", try_cast({speed("WindSpeed3pm")} AS DOUBLE) AS "WindSpeed3pm")
              FROM (SELECT * FROM filled {calm}) whole_rows
              WHERE "WindSpeed9am" IS NOT NULL AND "WindSpeed3pm" IS NOT NULL),
    q AS (SELECT {_sql_list('quantile_cont("{c}", 0.25) AS "{c}_1", quantile_cont("{c}", 0.75) AS "{c}_3"', CAPPED_COLUMNS)} FROM whole),
    capped AS (SELECT whole.* REPLACE (
        {_sql_list('''CASE WHEN "{c}" < "{c}_1" - ("{c}_3" - "{c}_1") * 1.5 THEN "{c}_1" - ("{c}_3" - "{c}_1") * 1.5
             WHEN "{c}" > "{c}_3" + ("{c}_3" - "{c}_1") * 1.5 THEN "{c}_3" + ("{c}_3" - "{c}_1") * 1.5
             ELSE "{c}" END AS "{c}"''', CAPPED_COLUMNS)}) FROM whole, q),
    {codes}
    SELECT {", ".join(picked[c] for c in CLEAN_COLUMNS)} FROM capped {joins}
    """


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in MEASURES})


@query("k1_clean_unbalanced", clean_sql(False))
def k1_clean(spark, sf):
    return _rounded(clean(weather(spark, sf), balance=None).table)


@query("k1_clean_balanced", clean_sql(True))
def k1_clean_balanced(spark, sf):
    return _rounded(clean(weather(spark, sf), method="shuffled_cycle").table)


@query("k1_i5_clean_drawn_row_by_row", clean_sql(True, drawn=True))
def k1_clean_drawn_rows(spark, sf):
    """The draws are hashes that SQL repeats, so the whole clean table is compared."""
    return _rounded(clean(weather(spark, sf), calm="zero").table)


@query("k1_clean_by_draw")
def k1_clean_drawn(spark, sf):
    return clean(weather(spark, sf), calm="zero").table


@query(
    "a9_weather_correlations",
    f"""
    WITH {DAYS_SQL}
    """
    + " UNION ALL ".join(
        f"""SELECT '{a}' AS a, '{b}' AS b, round(corr("{a}", "{b}"), 6) AS r FROM daily"""
        for a in ["MinTemp", "Sunshine", "Cloud3pm", "Pressure3pm"]
        for b in ["MinTemp", "Sunshine", "Cloud3pm", "Pressure3pm"]
    ),
)
def a9_weather(spark, sf):
    cols = ["MinTemp", "Sunshine", "Cloud3pm", "Pressure3pm"]
    return correlation_matrix(weather(spark, sf), cols).withColumn("r", F.round("r", 6))
