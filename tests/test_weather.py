"""Bulletins to labelled and clean tables."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

import weather_files as wf
from petrichor.plans.clean import clean
from petrichor.plans.daily import daily_observations, label_rain, station_dim
from petrichor.schemas import (
    CAPPED_COLUMNS, CLEAN_COLUMNS, DAILY_COLUMNS, DAILY_SCHEMA, DATA_ID_SCHEMA, STATION_SCHEMA, WIND_DIRECTIONS,
)
from petrichor.sources import bulletins as b
from petrichor.sources.tables import read_dim

NAMES = {"ID1": "Albury", "ID2": "Ballarat", "ID3": "Calmville"}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("weather")
    months = {(i, p): wf.month(p, s) for s, i in enumerate(NAMES) for p in ("202301", "202302")}
    # The third station never reports a morning wind speed.
    for p in ("202301", "202302"):
        months["ID3", p] = [wf.line(f"2023-{p[4:]}-{d}", "2.0", speed9="") for d in range(1, 29)]
    wf.write_digest_files(root / "digest", months)
    wf.write_bulletins(root / "raw", months)
    (root / "digest" / "notes.txt").write_text("not a bulletin")
    wf.write_dims(root / "dims", NAMES)
    return root


@pytest.fixture(scope="module")
def dim(spark, folder):
    stations = read_dim(spark, str(folder / "dims/stations.csv"), STATION_SCHEMA)
    return station_dim(stations, read_dim(spark, str(folder / "dims/ids.csv"), DATA_ID_SCHEMA)).cache()


@pytest.fixture(scope="module")
def daily(spark, folder, dim):
    return daily_observations(b.read_digest(spark, str(folder / "digest")), dim).cache()


def test_digest_keeps_only_data_lines(spark):
    text = '"Some header info"\n\n,Header1,Header2,Header3\nData1,Data2,Data3\n,x,"y"\n\n"late note"\r\n,z\r'
    df = spark.createDataFrame([("a", text), ("b", "Data1\n"), ("c", '"only"\n')], "file string, content string")
    want = [("a", ",x,\"y\""), ("a", ",z"), ("a", "Data1,Data2,Data3"), ("b", "Data1")]
    assert sorted(map(tuple, b.digest(df).select("file", "line").collect())) == want
    lines = df.select("file", F.posexplode(F.split("content", r"\r\n|\r|\n")).alias("n", "line"))
    got = b.digest_lines(lines, "file", "n", "line").select("file", "line").collect()
    assert sorted(map(tuple, got)) == want


def test_raw_bulletins_give_the_digest(spark, folder, tmp_path):
    raw = b.read_bulletins(spark, str(folder / "raw"))
    assert "°C" in raw.first()["content"]
    fields = b.parse_digest(b.digest(raw))
    again = fields.select("*", *b.name_parts(F.col("file_name"))).drop("file_name", "line_no")
    direct = b.read_digest(spark, str(folder / "digest"))
    assert sorted(map(tuple, again.select(*direct.columns).collect()), key=repr) == sorted(map(tuple, direct.collect()), key=repr)
    b.write_digest(b.digest(raw), str(tmp_path / "digest"))
    stored = b.read_digest_folders(spark, str(tmp_path / "digest")).select(*direct.columns)
    assert sorted(map(tuple, stored.collect()), key=repr) == sorted(map(tuple, direct.collect()), key=repr)


@pytest.mark.parametrize("n", [3, 22, 24])
def test_lines_of_the_wrong_size_fail(spark, tmp_path, n):
    line = ",".join(["", "2024-1-2", "5.0", *["1"] * 21][:n])
    (tmp_path / "A1.202401.csv").write_text(line + "\n")
    readers = [b.read_digest(spark, str(tmp_path)), b.parse_digest(spark.createDataFrame([(line,)], "line string"))]
    for rows in readers:
        if n == 22:
            assert rows.select("Date").first()[0] == "2024-1-2"
        else:
            with pytest.raises(Exception, match="(?i)malformed"):
                rows.select("Date").collect()


def test_station_codes_keep_their_zeros(dim):
    assert {r["station_id"] for r in dim.collect()} == {"000", "001", "002"}
    assert dim.columns == ["station_id", "Location", "Climat", "data_id"]


def test_station_without_data_id(spark):
    stations = spark.createDataFrame([("001", "L1", "V1"), ("002", "L2", "V2")], STATION_SCHEMA)
    ids = spark.createDataFrame([("001", "D1")], DATA_ID_SCHEMA)
    got = sorted(map(tuple, station_dim(stations, ids).collect()))
    assert got == [("001", "L1", "V1", "D1"), ("002", "L2", "V2", None)]


def test_daily_table(daily):
    assert daily.schema.simpleString() == DAILY_SCHEMA.simpleString()
    rows = daily.where("Location = 'Albury'").orderBy("Date").collect()
    assert len(rows) == 56 and rows[0]["Date"] == dt.date(2023, 1, 1)
    for today, after in zip(rows, rows[1:]):
        assert today["RainToday"] == ("Yes" if (today["Rainfall"] or 0) >= 1 else "No")
        same_file = today["Date"].month == after["Date"].month
        assert today["RainTomorrow"] == (after["RainToday"] if same_file else None)
    calm = [r for r in rows if r["WindSpeed9am"] == "Calm"]
    assert calm and {r["WindDir9am"] for r in calm} == {" "}


def test_labels_across_bulletins(spark, folder, dim):
    got = daily_observations(b.read_digest(spark, str(folder / "digest")), dim, label_scope="location")
    # January was written with 28 days only, so its last label needs a day that is missing.
    assert got.where("RainTomorrow is null").count() == 6
    rows = spark.createDataFrame(
        [("L", dt.date(2023, 12, 30), 0.0), ("L", dt.date(2023, 12, 31), 0.0), ("L", dt.date(2024, 1, 1), 3.0), ("L", dt.date(2024, 1, 3), 3.0)],
        "Location string, Date date, Rainfall double",
    )
    labelled = label_rain(rows, "location").orderBy("Date").collect()
    assert [r["RainTomorrow"] for r in labelled] == ["No", "Yes", None, None]


def test_unknown_station(spark, folder, dim):
    digest = b.read_digest(spark, str(folder / "digest"))
    some = dim.where("data_id <> 'ID2'")
    with pytest.raises(PySparkException, match="no station for data id ID2"):
        daily_observations(digest, some).collect()
    assert daily_observations(digest, some, unknown="drop").count() == 112


def test_clean_table(daily):
    for options in ({"balance": None}, {}, {"method": "shuffled_cycle", "exact": False}):
        out = clean(daily, **options)
        pdf = out.table.toPandas()
        assert list(pdf.columns) == CLEAN_COLUMNS and len(pdf) and not pdf.isna().any().any()
        assert set(pdf.RainTomorrow) == {0, 1}
        names = {r["Location_Name"]: r["Location_Code"] for r in out.mapping.collect()}
        # Without wind speeds nothing of the third station is left.
        assert names == {"Albury": 0, "Ballarat": 1}
        for c in CAPPED_COLUMNS:
            assert pdf[c].nunique() >= 1
        for c in [*WIND_DIRECTIONS, "WindSpeed9am", "WindSpeed3pm"]:
            assert sorted(pdf[c].unique()) == list(range(pdf[c].nunique()))


def test_clean_switches(daily):
    zero = clean(daily, balance=None, calm="zero").table.count()
    assert zero > clean(daily, balance=None).table.count()
    speeds = clean(daily, balance=None, encode_wind_speed=False).table
    assert dict(speeds.dtypes)["WindSpeed9am"] == "double"
    by_name = clean(daily, balance=None, code_order="alphabet")
    assert by_name.mapping.count() == 2
    for bad in ({"balance": "x"}, {"calm": "x"}, {"method": "x"}, {"code_order": "x"}):
        with pytest.raises(ValueError):
            clean(daily, **bad)


def test_clean_agrees_with_pandas(daily):
    """The same steps spelled out on a data frame, unbalanced."""
    pdf = daily.orderBy("Location", "Date").toPandas()
    pdf = pdf[pdf.RainTomorrow.notna()].copy()
    for c in WIND_DIRECTIONS:
        pdf[c] = pdf[c].fillna(pdf[c].mode()[0])
    measures = [c for c in DAILY_COLUMNS if pdf[c].dtype == float]
    pdf[measures] = pdf.groupby("Location")[measures].transform(lambda s: s.fillna(s.median())).fillna(0)
    pdf = pdf[pdf.WindSpeed9am.notna() & pdf.WindSpeed3pm.notna()]
    pdf = pdf[(pdf.WindSpeed9am != "Calm") & (pdf.WindSpeed3pm != "Calm")].copy()
    for c in CAPPED_COLUMNS:
        pdf[c] = pdf[c].astype(float)
        q1, q3 = pdf[c].quantile(0.25), pdf[c].quantile(0.75)
        pdf[c] = pdf[c].clip(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    for c in ["Location", *WIND_DIRECTIONS, "WindSpeed9am", "WindSpeed3pm"]:
        pdf[c] = pd.factorize(pdf[c])[0]
    dates = pd.to_datetime(pdf.Date)
    pdf["Year"], pdf["Month"], pdf["Day"] = dates.dt.year, dates.dt.month, dates.dt.day
    pdf["RainToday"], pdf["RainTomorrow"] = (pdf.RainToday == "Yes").astype(int), (pdf.RainTomorrow == "Yes").astype(int)
    want = pdf[CLEAN_COLUMNS].sort_values(["Location", "Month", "Day"]).reset_index(drop=True)
    got = clean(daily, balance=None).table.toPandas().sort_values(["Location", "Month", "Day"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_collection_plan(spark):
    ids = spark.createDataFrame([("001", "ID1"), ("002", "ID2")], DATA_ID_SCHEMA)
    plan = b.collection_plan(ids, dt.date(2025, 2, 10)).collect()
    assert len(plan) == 28 and {r["period"] for r in plan if r["refresh"]} == {"202502"}
    one = next(r for r in plan if r["data_id"] == "ID1" and r["period"] == "202401")
    assert one["file_name"] == "ID1.202401.csv" and one["url"].endswith("/202401/text/ID1.202401.csv")


def test_files_are_listed_and_read_in_tasks(spark, tmp_path, monkeypatch):
    """What Spark's own reader finds: no hidden, empty or nested files, but those of partitions; nothing listed on the driver."""
    folder = tmp_path / "a b"
    for place in ("x", ".hidden", "x/deep"):
        (folder / place).mkdir(parents=True)
    for name in ("A1.202401.csv", "A1.202401.refresh9.csv", "A1.202401.refresh10.csv", "B2.202401.csv", "C3.202402.csv", "_C3.202402.csv", ".D4.202402.csv", "note.txt", "x/E5.202402.csv", ".hidden/F6.202402.csv"):
        (folder / name).write_bytes(f"{name} °C".encode("cp1252"))
    (folder / "B2.202401.refresh1.csv").touch()
    known = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(str(folder))
    want = sorted((r["path"].rsplit("/", 1)[1], bytes(r["content"]).decode("cp1252"), r["modificationTime"]) for r in known.collect())
    assert len(want) == 5

    def refused(*_):
        raise AssertionError("the driver lists all files")

    for name in ("load", "format"):
        monkeypatch.setattr(type(spark.read), name, refused)
    assert sorted(tuple(r) for r in b._listed(spark, str(folder)).select("file_name", "modificationTime").collect()) == [(n, t) for n, _, t in want]
    monkeypatch.setattr(b, "FILES_READ", 2)
    monkeypatch.setattr(b, "BYTES_HELD", 1)
    raw = b.read_bulletins(spark, str(folder))
    assert sorted(map(tuple, raw.collect())) == [(n, c) for n, c, _ in want]
    assert raw.rdd.getNumPartitions() >= 3
    newest = ["A1.202401.refresh10.csv", "B2.202401.csv", "C3.202402.csv"]
    assert sorted(r["file_name"] for r in b.read_bulletins(spark, str(folder), newest=True).collect()) == newest
    assert sorted(r["file_name"] for r in b.newest_files(spark, f"{folder}*").collect()) == newest
    monkeypatch.undo()
    parts = tmp_path / "parts"
    for month in ("202401", "202402"):
        (parts / f"month={month}").mkdir(parents=True)
        (parts / f"month={month}" / f"A1.{month}.csv").write_text("x")
    assert sorted(r["file_name"] for r in b.read_bulletins(spark, str(parts)).collect()) == ["A1.202401.csv", "A1.202402.csv"]
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        b.read_bulletins(spark, str(tmp_path / "none"))
    (tmp_path / "empty").mkdir()
    assert b.read_bulletins(spark, str(tmp_path / "empty")).count() == 0
