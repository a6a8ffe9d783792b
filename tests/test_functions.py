import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from petrichor.functions import dates, rain, text
from petrichor.functions.hashing import HASH_SPACE, row_hash


def column(spark, values, schema, expr):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {schema}")
    return [r["x"] for r in df.select("i", expr.alias("x")).orderBy("i").collect()]


def test_cp1252_bytes(spark):
    raw = bytes(range(0x20, 0x100))
    got = column(spark, [bytearray(raw)], "binary", text.cp1252_text(F.col("v")))[0]
    assert got == raw.decode("cp1252", errors="replace")


def test_fixed_text_rounds_like_python(spark):
    random.seed(3)
    values = [random.uniform(0, 100) for _ in range(500)] + [i / 16 for i in range(200)]
    values += [0.05, 0.15, 0.25, 0.35, 2.675, 1.005, 0.0, 1.0, 99.95, 0.0005, 0.0015, 0.0625]
    for digits in (1, 3):
        got = column(spark, values, "double", text.fixed_text(F.col("v"), digits))
        assert got == [f"{v:.{digits}f}" for v in values]


def test_display_text(spark):
    assert column(spark, [0.123, None, 1.0], "double", text.percent_text(F.col("v"))) == ["12.3%", None, "100.0%"]
    assert column(spark, [0.98765, None], "double", text.metric_text(F.col("v"))) == ["0.988", ""]


@pytest.mark.parametrize(
    "page, found",
    [
        ("<x URL=/climate/dwo/IDCJDW2124.latest y", "IDCJDW2124"),
        ("no delimiters", ""),
        ("", ""),
        ("URL=/climate/dwo/IDCJDW2124", ""),
        (".latest URL=/climate/dwo/IDCJDW2124", ""),
        ("a.latest URL=/climate/dwo/IDCJDW2124.latest", ""),
    ],
)
def test_text_between(spark, page, found):
    expr = text.text_between(F.col("v"), "URL=/climate/dwo/", ".latest")
    assert column(spark, [page], "string", expr) == [found]


def test_starts_with_letter(spark):
    got = column(spark, ["Calm", "é", "12", " a", "", None, "-3"], "string", text.starts_with_letter(F.col("v")))
    assert got == [True, True, False, False, False, False, False]


def test_to_double(spark):
    assert column(spark, ["1.5", "Calm", None, "NaN", "-2"], "string", text.to_double(F.col("v"))) == [
        1.5, None, None, None, -2.0,
    ]


def test_days(spark):
    day = dt.date(2024, 9, 1)
    assert column(spark, ["2024-09-1", "2024-09-01", "2024-9-1"], "string", dates.parse_day(F.col("v"))) == [day] * 3
    assert column(spark, ["2024-09-1", "2024-12-31"], "string", dates.pad_day(F.col("v"))) == ["2024-09-01", "2024-12-31"]
    assert column(spark, ["bad"], "string", dates.parse_day(F.col("v"), strict=False)) == [None]


def test_recent_months_cross_the_year(spark):
    got = column(spark, [dt.date(2025, 2, 17)], "date", dates.recent_months(F.col("v"), 14))[0]
    assert got[0] == dt.date(2024, 1, 1) and got[-1] == dt.date(2025, 2, 1) and len(got) == 14


def test_epoch_text_ignores_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Australia/Sydney")
        assert column(spark, [1700000000123], "long", dates.epoch_ms_text(F.col("v"))) == ["14-11-2023 22:13:20"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_rain_flags(spark):
    assert column(spark, [0.9, 1.0, None, 5.2], "double", rain.rain_flag(F.col("v"))) == ["No", "Yes", "No", "Yes"]
    assert column(spark, ["Yes", "No", "?", None], "string", rain.yes_no_code(F.col("v"))) == [1, 0, None, None]


def test_promotion_rule(spark):
    scores = [(0.909, 0.9), (0.9045, 0.9), (0.92, 0.9), (0.8, 0.9), (0.75, 0.75), (0.625, 0.5)]
    cases = [(new, old, (new - old) / old > 0.01) for new, old in scores]
    cases += [(0.5, None, True), (0.1, 0.0, True), (0.0, 0.0, False)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, new double, old double, want boolean")
    got = df.withColumn("got", rain.is_promoted(F.col("new"), F.col("old"), 0.01)).orderBy("i").collect()
    assert [r["got"] for r in got] == [c[2] for c in cases]


def test_cap_and_scale(spark):
    assert column(spark, [-1.0, 5.0, 11.0, None], "double", rain.cap(F.col("v"), F.lit(0.0), F.lit(10.0))) == [
        0.0, 5.0, 10.0, None,
    ]
    assert column(spark, [3.0, None], "double", rain.min_max(F.col("v"), F.lit(3.0), F.lit(3.0))) == [0.0, None]


def test_row_hash_is_even(spark):
    df = spark.range(4000).withColumn("h", row_hash(["id"], 7))
    assert df.where((F.col("h") < 0) | (F.col("h") >= HASH_SPACE)).count() == 0
    assert 700 < df.where(F.col("h") < HASH_SPACE // 5).count() < 900
