"""Tables, registry, composite jobs and the stream."""

import datetime as dt
import pathlib
from concurrent.futures import ThreadPoolExecutor

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

import weather_files as wf
from petrichor.operators.dictionary import decoded, new_codes
from petrichor.plans import jobs, registry, training
from petrichor.plans.clean import clean
from petrichor.plans.daily import daily_observations, station_dim
from petrichor.operators import joins
from petrichor.schemas import CLEAN_KEYS, DAILY_COLUMNS, DATA_ID_SCHEMA, MAPPING_SCHEMA, STATION_SCHEMA
from petrichor.session import materialize, scratch_path, shared_dir
from petrichor.sources import ledger, tables
from petrichor.sources.bulletins import digest, read_bulletins, read_digest, read_digest_folders, write_digest
from petrichor.streaming import observations
from petrichor.streaming.observations import current_observations, digest_folder_stream, digest_stream, labelled_observations, write_labelled, write_log

NAMES = {"ID1": "Albury", "ID2": "Ballarat"}
PERIODS = ("202301", "202302", "202303")


@pytest.fixture()
def places(tmp_path):
    wf.write_digest_files(tmp_path / "digest", {(i, p): wf.month(p, s) for s, i in enumerate(NAMES) for p in PERIODS})
    stations, ids = wf.write_dims(tmp_path / "dims", NAMES)
    return {"digest_path": str(tmp_path / "digest"), "stations_path": stations, "ids_path": ids}


def test_shared_dir_is_the_named_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = materialize(spark.range(5))
    assert df.count() == 5 and scratch_path(spark, "a") != scratch_path(spark, "a")


def test_append_new_and_replace(spark, tmp_path):
    path, day = str(tmp_path / "t"), dt.date(2025, 9, 6)
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2)], "k string, v int")
    assert tables.append_new(rows, path, ["k"], day)
    assert not tables.append_new(rows, path, ["k"], day)
    assert tables.append_new(spark.createDataFrame([("a", 9), ("c", 3)], "k string, v int"), path, ["k"], day)
    got = sorted(map(tuple, tables.read_table(spark, path).collect()))
    assert got == [("a", 1, day), ("b", 2, day), ("b", 2, day), ("c", 3, day)]
    tables.write_table(rows, path, "overwrite")
    assert tables.read_table(spark, path).count() == 3


def test_catalog_tables(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    try:
        assert tables.append_new(rows, "held_rows", ["k"], dt.date(2025, 9, 6))
        assert not tables.append_new(rows, "held_rows", ["k"])
        assert tables.read_table(spark, "held_rows").count() == 2
        assert tables.run_sql(spark, "SELECT v FROM held_rows WHERE k = :k", {"k": 2}).first()["v"] == "b"
    finally:
        spark.sql("DROP TABLE IF EXISTS held_rows")


def test_csv_keeps_order_and_is_created_once(spark, tmp_path):
    path = str(tmp_path / "mapping")
    rows = spark.createDataFrame([("B", 1), ("A", 0)], MAPPING_SCHEMA)
    first = tables.read_or_create(spark, path, MAPPING_SCHEMA, lambda: rows)
    again = tables.read_or_create(spark, path, MAPPING_SCHEMA, lambda: pytest.fail("built twice"))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect())) == [("A", 0), ("B", 1)]
    assert sorted(r["record"] for r in tables.to_records(first).collect())[0] == '{"Location_Name":"A","Location_Code":0}'


def test_schema_report_and_sql(spark):
    df = spark.createDataFrame([(1, 2.0)], "RainTomorrow int, MinTemp double")
    row = tables.schema_report(df).first()
    assert row["input_schema"] == '{"MinTemp": "double"}' and row["output_schema"] == '{"RainTomorrow": "int"}'
    assert tables.run_sql(spark, "SELECT count(*) AS n FROM {t} WHERE MinTemp > :x", {"x": 1.5}, t=df).first()["n"] == 1


def test_version_tables(spark, tmp_path):
    reg = registry.Registry(spark, str(tmp_path / "registry"))
    runs = spark.createDataFrame(
        [("r2", "FINISHED", {}, {"f1_score": 0.8, "accuracy": 0.9}, 1), ("r10", "FINISHED", {}, {"f1_score": 0.9}, 2),
         ("r11", "FAILED", {}, {"accuracy": 0.1}, 3)],
        registry.RUNS,
    )
    name = reg.name
    made = [(name, v, ms, r, "p") for v, ms, r in (("10", 1700000000123, "r10"), ("2", 1600000000000, "r2"), ("11", 1800000000000, "gone"))]
    moved = [(name, "2", "Production", 1), (name, "2", "Archived", 2), (name, "10", "Production", 2)]
    now = registry.current_versions(
        spark.createDataFrame(made, registry.VERSIONS), spark.createDataFrame(moved, registry.STAGES)
    )
    listing = registry.version_listing(now, runs).collect()
    assert [(r["version"], r["status"]) for r in listing] == [("2", "Archived"), ("10", "Production"), ("11", "None")]
    assert listing[1]["creation_date"] == "14-11-2023 22:13:20"
    assert listing[0]["metrics"]["accuracy"] == 0.9 and listing[0]["metrics"]["rmse"] is None
    assert set(listing[2]["metrics"].asDict().values()) == {None}
    pick = lambda **k: [r["version"] for r in registry.pick_version(now, runs, **k).collect()]
    assert pick(by="production") == ["10"] and pick(by="latest") == ["11"] and pick(by="best") == ["10"]
    assert pick(by="version", version="2") == ["2"] and pick(by="version", version="3") == []
    assert [r["run_id"] for r in registry.ranked_runs(runs).collect()] == ["r10", "r2"]
    assert registry.run_listing(runs).count() == 4
    assert reg.load() is None and reg.listing().count() == 0


def test_ingest_train_predict(spark, places, tmp_path):
    table = str(tmp_path / "warehouse")
    reg = registry.Registry(spark, str(tmp_path / "registry"))
    assert jobs.ingest(spark, table=table, day=dt.date(2025, 9, 6), **places)
    assert not jobs.ingest(spark, table=table, **places)
    # All 168 days are held; the last of each bulletin has no label yet.
    assert tables.read_table(spark, table).count() == 168
    assert jobs.warehouse(spark, table).where("RainTomorrow IS NOT NULL").count() == 162
    longer = wf.month("202303", 0) + [wf.line("2023-03-29", "9.0")]
    wf.write_digest_files(places["digest_path"], {("ID1", "202303"): longer})
    assert jobs.ingest(spark, table=table, **places)
    late = jobs.warehouse(spark, table).where("Location = 'Albury' AND Date = '2023-03-28'").collect()
    assert [r["RainTomorrow"] for r in late] == ["Yes"]
    assert jobs.train(spark, table, reg, numTrees=3, maxDepth=2, seed=42)
    cleaned = jobs.training_table(spark, table, balance=None)
    features = materialize(cleaned.table)
    train, test = training.balanced_split(features, CLEAN_KEYS, 42, "train_only", "draw")
    counts = {r["RainTomorrow"]: r["rows"] for r in training_counts(train)}
    assert counts[0] == counts[1]
    # The same settings again do not gain one percent.
    first = reg.load("production")
    promoted = jobs.train(spark, table, reg, numTrees=3, maxDepth=2, seed=42)
    listing = reg.listing().collect()
    assert not promoted and [(r["version"], r["status"]) for r in listing] == [("1", "Production"), ("2", "None")]
    assert 0 < listing[0]["metrics"]["f1_score"] <= 1
    reg.promote("2")
    assert [r["status"] for r in reg.listing().collect()] == ["Archived", "Production"]
    logged = {r["metric"] for r in registry.run_listing(reg.runs()).collect()}
    assert {"accuracy", "precision", "recall", "f1_score", "previous_f1", "improvement"} <= logged
    model = reg.load("version", "1")
    out = jobs.predict_locations(features, model, cleaned.mapping, "1").collect()
    assert {r["Location_Name"] for r in out} == set(NAMES.values())
    assert {r["prediction"] for r in out} <= {0.0, 1.0} and {r["will_rain"] for r in out} <= {True, False}
    assert spark.read.json(f"{reg.root}/schemas/*").count() == 2
    with pytest.raises(ValueError):
        training.score(first, features.where("false"))
    with pytest.raises(ValueError):
        jobs.train_and_promote(features.where("false"), features, reg)
    assert reg.runs().where("status = 'FAILED'").count() == 1


def training_counts(df):
    from petrichor.operators.profile import class_counts

    return class_counts(df, "RainTomorrow").collect()


def test_encoded_store(spark, places, tmp_path):
    table, mapping = str(tmp_path / "encoded"), str(tmp_path / "mapping")
    assert jobs.ingest(spark, table=table, store="encoded", mapping_path=mapping, **places)
    rows = tables.read_table(spark, table)
    assert {r["RainTomorrow"] for r in rows.select("RainTomorrow").distinct().collect()} == {0, 1}
    assert tables.read_dim(spark, mapping, MAPPING_SCHEMA).count() == 2
    assert not jobs.ingest(spark, table=table, store="encoded", **places)


def test_encoded_store_takes_a_new_location_once(spark, tmp_path):
    digest, table = tmp_path / "digest", str(tmp_path / "encoded")
    stations, ids = wf.write_dims(tmp_path / "dims", NAMES)
    paths = dict(digest_path=str(digest), stations_path=stations, ids_path=ids, table=table, store="encoded", balance=None)
    wf.write_digest_files(digest, {("ID2", p): wf.month(p, 1) for p in PERIODS})
    assert jobs.ingest(spark, day=dt.date(2025, 9, 6), **paths)
    alone = tables.read_table(spark, table).count()
    wf.write_digest_files(digest, {("ID1", p): wf.month(p, 0) for p in PERIODS})
    assert jobs.ingest(spark, day=dt.date(2025, 9, 7), **paths)
    assert not jobs.ingest(spark, **paths)
    # The second location continues the codes of the first.
    held = jobs.EncodedStore(spark, table)
    assert sorted(map(tuple, held.mapping().collect())) == [("Albury", 1), ("Ballarat", 0)]
    named = decoded(held.rows(), held.codes(), ["Location"]).groupBy("Location").count()
    assert {r["Location"]: r["count"] for r in named.collect()} == {"Ballarat": alone, "Albury": held.rows().count() - alone}
    days = {r["ingestion_date"].day: r["n"] for r in tables.read_table(spark, table).groupBy("ingestion_date").agg(F.count("*").alias("n")).collect()}
    dim = station_dim(tables.read_dim(spark, stations, STATION_SCHEMA), tables.read_dim(spark, ids, DATA_ID_SCHEMA))
    whole = clean(daily_observations(read_digest(spark, str(digest)), dim), balance=None)
    assert days[6] == alone and days[6] + days[7] == whole.table.count()


def test_every_layout_fills_the_same_warehouse(spark, tmp_path):
    stations, ids = wf.write_dims(tmp_path / "dims", NAMES)
    months = {(i, p): wf.month(p, k) for k, i in enumerate(("ID1", "ID2")) for p in PERIODS}
    wf.write_digest_files(tmp_path / "digest", months)
    wf.write_bulletins(tmp_path / "raw", months)
    write_digest(digest(read_bulletins(spark, str(tmp_path / "raw"))), str(tmp_path / "folders"))
    stored = {}
    for layout in ("digest", "raw", "folders"):
        paths = dict(digest_path=str(tmp_path / layout), stations_path=stations, ids_path=ids, table=str(tmp_path / f"table_{layout}"))
        assert jobs.ingest(spark, layout=layout, day=dt.date(2025, 9, 6), **paths)
        assert not jobs.ingest(spark, layout=layout, **paths)
        rows = tables.read_table(spark, paths["table"])
        stored[layout] = sorted(map(tuple, rows.select(sorted(rows.columns)).collect()), key=repr)
    assert stored["digest"] and stored["raw"] == stored["digest"] and stored["folders"] == stored["digest"]


def encoded_paths(tmp_path, **more):
    stations, ids = wf.write_dims(tmp_path / "dims", NAMES)
    digest = tmp_path / "digest"
    paths = dict(digest_path=str(digest), stations_path=stations, ids_path=ids, table=str(tmp_path / "encoded"), store="encoded", balance=None)
    return digest, paths | more


@pytest.mark.parametrize("step", ["codes", "rows", "days", "commit"])
def test_a_load_that_fails_is_not_seen_and_runs_again(spark, tmp_path, monkeypatch, step):
    digest, paths = encoded_paths(tmp_path)
    wf.write_digest_files(digest, {("ID2", p): wf.month(p, 1) for p in PERIODS})
    assert jobs.ingest(spark, **paths)
    held = jobs.EncodedStore(spark, paths["table"])
    before = (held.rows().count(), held.codes().count())
    wf.write_digest_files(digest, {("ID1", p): wf.month(p, 0) for p in PERIODS})

    class Crash(Exception):
        pass

    def crash(*args, **kwargs):
        raise Crash

    with monkeypatch.context() as m:
        if step == "commit":
            m.setattr(jobs.Ledger, "commit", crash)
        elif step == "codes":
            m.setattr(jobs.CodeBook, "encode", crash)
        else:
            write = jobs.write_load
            m.setattr(jobs, "write_load", lambda df, table, load: crash() if table.endswith("_days") == (step == "days") else write(df, table, load))
        with pytest.raises(Crash):
            jobs.ingest(spark, **paths)
    assert (held.rows().count(), held.codes().count()) == before
    assert jobs.ingest(spark, **paths) and not jobs.ingest(spark, **paths)
    assert sorted(map(tuple, held.mapping().collect())) == [("Albury", 1), ("Ballarat", 0)]
    other, whole = encoded_paths(tmp_path, table=str(tmp_path / "whole"))
    assert jobs.ingest(spark, **whole)
    assert held.rows().count() == jobs.EncodedStore(spark, whole["table"]).rows().count()


def test_a_load_starts_over_when_another_was_faster(spark, tmp_path, monkeypatch):
    digest, paths = encoded_paths(tmp_path)
    wf.write_digest_files(digest, {("ID2", p): wf.month(p, 1) for p in PERIODS})
    commit, calls = jobs.Ledger.commit, []

    def late(self, seen, load):
        calls.append(load)
        if len(calls) == 1:  # the same days are loaded by someone else meanwhile
            assert jobs.ingest(spark, **paths)
        return commit(self, seen, load)

    monkeypatch.setattr(jobs.Ledger, "commit", late)
    assert not jobs.ingest(spark, **paths)
    held = jobs.EncodedStore(spark, paths["table"])
    assert held.ledger.loads().count() == 1 and len(calls) == 2
    assert held.rows().count() == held.rows().select(*CLEAN_KEYS).distinct().count()


@pytest.mark.parametrize("by, small", [("first", True), ("alphabet", True), ("first", False), ("alphabet", False)])
def test_new_codes_continue_from_the_highest(spark, monkeypatch, by, small):
    if not small:
        monkeypatch.setattr("petrichor.operators.dictionary.is_small", lambda df: False)
    held = spark.createDataFrame([("a", "x", 0), ("a", "y", 3), ("c", "z", 0)], "column string, value string, code int")
    rows = spark.createDataFrame([(1, "q", "n"), (2, "x", None), (3, "b", "m"), (4, "q", "n")], "t int, a string, b string")
    got = {(r["column"], r["value"]): r["code"] for r in new_codes(held, rows, ["a", "b"], ["t"], by).collect()}
    want = {"first": {("a", "q"): 4, ("a", "b"): 5, ("b", "n"): 0, ("b", "m"): 1}, "alphabet": {("a", "b"): 4, ("a", "q"): 5, ("b", "m"): 0, ("b", "n"): 1}}
    assert got == want[by]


def test_exclusive_numbers(spark, tmp_path):
    folder = f"file://{tmp_path}/numbers"
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: ledger.next_number(spark, folder, 0, "x"), range(40)))
    assert sorted(got) == list(range(1, 41))
    book = ledger.Ledger(spark, str(tmp_path / "loads"))
    assert book.begin()[0] == 0
    book.commit(0, "first")
    with pytest.raises(ledger.Conflict):
        book.commit(0, "second")
    ledger.create_exclusive(spark, str(tmp_path / "loads" / f"{2:012d}"), "")  # left by a crash
    assert [tuple(r) for r in book.loads().collect()] == [(1, "first")]


def test_versions_registered_side_by_side_get_different_numbers(spark, tmp_path):
    reg = registry.Registry(spark, str(tmp_path / "registry"))
    rows = spark.createDataFrame([(float(i % 5), i % 2) for i in range(40)], "a double, RainTomorrow int")
    model = training.train_forest(rows, numTrees=1, maxDepth=1)
    with ThreadPoolExecutor(3) as pool:
        got = list(pool.map(lambda k: reg.register(model, f"run{k}"), range(3)))
    assert sorted(got) == ["1", "2", "3"] and reg.versions().select("path").distinct().count() == 3
    assert reg.pick("version", "2")["version"] == "2" and reg.info("9") is None
    with pytest.raises(LookupError):
        jobs.predict_registered(rows, reg, rows)


def test_the_lower_error_is_promoted(spark):
    rows = spark.createDataFrame([("a", 1.0), ("b", 0.9895), ("c", 0.995), ("d", 1.2), ("z", 0.0)], "model string, rmse double")
    said = lambda new, old: training.compare(rows, new, old, measure="rmse").first()["promote"]
    assert said("b", "a") and not said("c", "a") and not said("d", "a") and said("a", "d") and said("d", "none")
    assert said("z", "a") and not said("a", "z") and not said("z", "z")


def test_refresh_beside_the_original_is_read_once(spark, places, tmp_path):
    folder = places["digest_path"]
    wf.write_digest_files(folder, {("ID1", f"202303.refresh{k}"): wf.month("202303", 0, days=k)[: k + 2] for k in (2, 9, 10)})
    rows = read_digest(spark, folder).where("data_id = 'ID1' and period = '202303'")
    assert rows.count() == 10
    table = str(tmp_path / "warehouse")
    assert jobs.ingest(spark, table=table, **places)
    assert jobs.warehouse(spark, table).where("Location = 'Albury' and Date >= '2023-03-01'").count() == 10


def test_malformed_lines_go_to_the_reject_table(spark, tmp_path):
    stations, ids = wf.write_dims(tmp_path / "dims", NAMES)
    good = wf.month("202301", 0)
    bad = ["a,b,c", good[0] + ",x,y"]
    for layout in ("digest", "raw", "folders"):
        months = {("ID1", "202301"): [*good[:5], bad[0], *good[5:], bad[1]]}
        if layout == "digest":
            wf.write_digest_files(tmp_path / layout, months)
        else:
            wf.write_bulletins(tmp_path / "raw", months)
        if layout == "folders":
            write_digest(digest(read_bulletins(spark, str(tmp_path / "raw"))), str(tmp_path / "folders"))
        paths = dict(digest_path=str(tmp_path / layout), stations_path=stations, ids_path=ids, table=str(tmp_path / f"t_{layout}"), layout=layout)
        with pytest.raises((PySparkException, Py4JJavaError), match="MALFORMED"):
            jobs.ingest(spark, **paths)
        rejects = str(tmp_path / f"rejects_{layout}")
        assert jobs.ingest(spark, rejects_path=rejects, **paths)
        assert jobs.warehouse(spark, paths["table"]).count() == 28
        assert sorted(tuple(r)[:3] for r in tables.read_table(spark, rejects).select("data_id", "period", "line").collect()) == [
            ("ID1", "202301", x) for x in sorted(bad)
        ]


def test_digest_files_do_not_grow_with_the_stations(spark, tmp_path):
    lines = spark.range(2000).select(
        F.format_string("S%d.20230%d.csv", F.col("id") % 500, 1 + F.col("id") % 2).alias("file_name"),
        F.col("id").cast("int").alias("line_no"), F.lit(",".join(["", "2023-01-01"] + ["1"] * 20)).alias("line"),
    )
    write_digest(lines, str(tmp_path / "d"), file_rows=300)
    files = [p for p in (tmp_path / "d").rglob("*.parquet")]
    assert len(files) <= 8 + 2 + 2000 // 300 and {p.parent.name for p in files} == {"period=202301", "period=202302"}
    assert spark.read.parquet(str(tmp_path / "d")).count() == 2000


def test_only_touched_months_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    day = lambda m, d: dt.date(2023, m, d)
    make = lambda days: spark.createDataFrame([("x", d) for d in days], "k string, Date date").withColumns(
        {"Year": F.year("Date"), "Month": F.month("Date")}
    )
    months = ["Year", "Month"]
    add = lambda days: tables.append_new(make(days), path, ["k", "Date"], dt.date(2025, 9, 6), partition_by=months, prune_by=months)
    assert add([day(m, d) for m in range(1, 13) for d in (1, 2)])
    assert add([day(3, 2), day(3, 3)]) and not add([day(3, 1), day(3, 3)])
    assert tables.read_table(spark, path).count() == 25
    held = joins.touched_partitions(tables.read_table(spark, path), make([day(3, 1), day(4, 1)]), months)
    plan = held._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :]
    assert "Month#" in filters.split("]")[0] and held.inputFiles() and held.count() == 5
    beyond = joins.touched_partitions(tables.read_table(spark, path), make([day(3, 1), day(4, 1)]), ["Month"], most=1)
    assert beyond.count() == 5


def test_loads_write_few_files(spark, tmp_path):
    dates = F.date_add(F.lit(dt.date(2023, 1, 1)), (F.col("id") % 50).cast("int"))
    make = lambda a, b: spark.range(a, b, 1, 40).select(F.col("id").alias("k"), dates.alias("Date")).withColumn("Month", F.month("Date"))
    for match, by in (("pair", ["Month"]), ("independent", None)):
        path, before = str(tmp_path / match), 0
        for a, b in ((0, 400), (200, 800)):
            assert tables.append_new(make(a, b), path, ["k"], dt.date(2025, 9, 6), match, by, by)
            files = len(list(pathlib.Path(path).rglob("*.parquet")))
            assert files - before <= 4
            before = files
        assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == list(range(800))


def test_touched_partitions_with_nulls(spark):
    held = spark.createDataFrame([(1, "a"), (None, "a"), (2, None), (2, "b")], "p int, q string")
    new = spark.createDataFrame([(None, "a"), (2, None)], "p int, q string")
    assert {tuple(r) for r in joins.touched_partitions(held, new, ["p", "q"]).collect()} == {(None, "a"), (2, None)}
    assert {tuple(r) for r in joins.touched_partitions(held, new, ["p"], most=1).collect()} == {(None, "a"), (2, None), (2, "b")}


def test_latest_and_first_rows(spark):
    rows = spark.createDataFrame(
        [(0, 2023, 1, 5, 1.0), (0, 2023, 2, 1, 2.0), (0, 2022, 12, 31, 3.0), (1, 2023, 1, 1, 4.0)],
        "Location int, Year int, Month int, Day int, v double",
    )
    assert sorted(r["v"] for r in jobs.latest_rows(rows).collect()) == [2.0, 4.0]
    assert sorted(r["v"] for r in jobs.latest_rows(rows, "first").collect()) == [3.0, 4.0]


def test_tuning(spark):
    rows = spark.range(600).select(
        F.col("id"), (F.col("id") % 13).cast("double").alias("a"), F.lit(1.0).alias("constant"),
        ((F.col("id") % 13) > 6).cast("int").alias("RainTomorrow"),
    )
    out = training.tune_forest(rows, ["id"], grid=[1, 3], folds=2, depth=4, drop=[])
    scores = {r["numTrees"]: r["accuracy"] for r in out["scores"].collect()}
    assert set(scores) == {1, 3} and scores[out["best"]] == max(scores.values()) and max(scores.values()) > 0.8
    assert out["report"].where("class = 'accuracy'").first()["f1_score"] > 0.8


def _rainy(spark):
    return spark.range(300).select(
        F.col("id"), (F.col("id") % 13).cast("double").alias("a"), ((F.col("id") % 13) > 6).cast("int").alias("RainTomorrow")
    )


def test_forests_score_after_observed_metrics(spark):
    counts = Observation()
    spark.range(3).observe(counts, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert counts.get["n"] == 3
    model = training.train_forest(_rainy(spark), features=["a"], numTrees=2, maxDepth=2, seed=1)
    assert not model.stages[-1].hasSummary
    scored = training.score(model, _rainy(spark))
    assert scored.where("prediction = RainTomorrow").count() == 300
    assert training.champion_metrics({"forest": model}, _rainy(spark)).first()["accuracy"] == 1


def test_rows_remember_their_nodes(spark, monkeypatch):
    assert training.train_regressor(_rainy(spark), features=["a"], numTrees=2, maxDepth=2).stages[-1].getCacheNodeIds()
    kept, fit = [], training._fit
    monkeypatch.setattr(training, "_fit", lambda *a: (kept.append(model := fit(*a)), model)[1])
    training.grid_scores(_rainy(spark), ["id"], "RainTomorrow", ["a"], [1, 2], 2, 1, 3)
    assert len(kept) == 4 and all(m.getCacheNodeIds() for m in kept)


def test_stream_survives_restart_and_refresh(spark, places, tmp_path):
    log, checkpoint, folder = str(tmp_path / "log"), str(tmp_path / "cp"), places["digest_path"]
    run = lambda: write_log(digest_stream(spark, folder), log, checkpoint).awaitTermination()
    dim = station_dim(
        tables.read_dim(spark, places["stations_path"], STATION_SCHEMA),
        tables.read_dim(spark, places["ids_path"], DATA_ID_SCHEMA),
    )
    run()
    run()
    batch = daily_observations(read_digest(spark, folder), dim)
    assert sorted(map(tuple, labelled_observations(spark, log, dim).collect()), key=repr) == sorted(map(tuple, batch.collect()), key=repr)
    # The current month is delivered again with one more day, which labels the day before it.
    longer = wf.month("202303", 0) + [wf.line("2023-03-29", "9.0")]
    wf.write_digest_files(folder, {("ID1", "202303.refresh1"): longer})
    run()
    rows = labelled_observations(spark, log, dim).where("Location = 'Albury'").orderBy(F.desc("Date")).collect()
    assert len(rows) == 85 and rows[0]["RainTomorrow"] is None and rows[1]["RainTomorrow"] == "Yes"


@pytest.mark.parametrize("scope", ["file", "location"])
def test_a_late_day_renews_its_month_only(spark, places, tmp_path, scope):
    log, table, checkpoint, folder = (str(tmp_path / x) for x in ("log", "table", "cp", "digest"))
    dim = station_dim(
        tables.read_dim(spark, places["stations_path"], STATION_SCHEMA),
        tables.read_dim(spark, places["ids_path"], DATA_ID_SCHEMA),
    )
    run = lambda: write_labelled(digest_stream(spark, folder), log, table, checkpoint, dim, scope, buckets=2).awaitTermination()
    files = lambda: {str(p.relative_to(table)): p.stat().st_mtime_ns for p in pathlib.Path(table).rglob("*.parquet")}
    rows = lambda: sorted(map(tuple, spark.read.parquet(table).select(*DAILY_COLUMNS).collect()), key=repr)
    want = lambda: sorted(map(tuple, daily_observations(read_digest(spark, folder), dim, scope).collect()), key=repr)
    run()
    assert rows() == want()
    first = files()
    run()
    assert files() == first
    longer = wf.month("202303", 0) + [wf.line("2023-03-29", "9.0")]
    wf.write_digest_files(folder, {("ID1", "202303.refresh1"): longer})
    run()
    assert rows() == want()
    albury = spark.read.parquet(table).where("Location = 'Albury' and Date = '2023-03-28'").first()
    assert albury["RainTomorrow"] == "Yes"
    changed = {f for f in set(first) ^ set(files())}
    renewed = {"period=202303"} if scope == "file" else {"period=202302", "period=202303"}
    assert changed and {f.split("/")[0] for f in changed} == renewed
    assert all(files()[f] == first[f] for f in first if f.startswith("period=202301"))


def test_a_batch_lists_and_logs_its_files_in_few_tasks(spark, places, tmp_path):
    log, folder, listing = str(tmp_path / "log"), places["digest_path"], "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    dim = station_dim(
        tables.read_dim(spark, places["stations_path"], STATION_SCHEMA),
        tables.read_dim(spark, places["ids_path"], DATA_ID_SCHEMA),
    )
    cost, listers = "spark.sql.files.openCostInBytes", spark.conf.get(listing)
    spark.conf.set(cost, spark.conf.get("spark.sql.files.maxPartitionBytes"))  # every file is a task
    spark.conf.set(listing, "10000")
    try:
        stream = digest_stream(spark, folder)
        assert int(spark.conf.get(listing)) <= 4 * spark.sparkContext.defaultParallelism
        write_labelled(stream, log, str(tmp_path / "table"), str(tmp_path / "cp"), dim, buckets=1).awaitTermination()
    finally:
        spark.conf.unset(cost)
        spark.conf.set(listing, listers)
    assert len(list(pathlib.Path(log).rglob("*.parquet"))) == len(PERIODS)


def test_folders_as_a_stream(spark, places, tmp_path):
    wf.write_bulletins(tmp_path / "raw", {(i, p): wf.month(p, s) for s, i in enumerate(NAMES) for p in PERIODS})
    folder, log = str(tmp_path / "folders"), str(tmp_path / "log")
    dim = station_dim(
        tables.read_dim(spark, places["stations_path"], STATION_SCHEMA),
        tables.read_dim(spark, places["ids_path"], DATA_ID_SCHEMA),
    )
    write_digest(digest(read_bulletins(spark, str(tmp_path / "raw"))), folder)
    for _ in range(2):
        write_log(digest_folder_stream(spark, folder), log, str(tmp_path / "cp")).awaitTermination()
    want = daily_observations(read_digest_folders(spark, folder), dim).collect()
    assert want and sorted(map(tuple, labelled_observations(spark, log, dim).collect()), key=repr) == sorted(map(tuple, want), key=repr)


def test_stream_takes_the_refresh_of_one_batch(spark, places, tmp_path):
    log, checkpoint, folder = str(tmp_path / "log"), str(tmp_path / "cp"), places["digest_path"]
    refreshed = [wf.line("2023-03-01", "8.0"), wf.line("2023-03-02", "9.0")]
    wf.write_digest_files(folder, {("ID1", "202303.refresh1"): refreshed})
    write_log(digest_stream(spark, folder), log, checkpoint).awaitTermination()
    rows = current_observations(spark, log).where("data_id = 'ID1' and Date in ('2023-03-01', '2023-03-02')")
    assert [r["Rainfall"] for r in rows.orderBy("Date").collect()] == [8.0, 9.0]


@pytest.mark.parametrize("name", ["m3_p9_forest_metrics", "m4_m5_a15_grid_scores", "m6_regression_forest", "m7_k4_w2_predictions", "k2_m12_train_and_promote"])
def test_model_queries_use_production_settings(spark, monkeypatch, name):
    from petrichor.workload import QUERIES, models

    fitted, balances, fit, clean = [], [], training._fit, models.clean

    def fit_small(estimator, train, label, features):
        found = {p: estimator.getOrDefault(p) for p in ("numTrees", "maxDepth", "seed", "impurity")}
        fitted.append(tuple(found.values()))
        return fit(estimator.copy().setNumTrees(1).setMaxDepth(1), train, label, features)

    def cleaned(daily, **options):
        balances.append(options.get("balance", "before"))
        return clean(daily, **options)

    monkeypatch.setattr(training, "_fit", fit_small)
    monkeypatch.setattr(models, "clean", cleaned)
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    forest = (100, 5, 42, "variance" if name.startswith("m6") else "gini")
    want = {forest}
    if name.startswith("m4"):
        grid = [1, 5, 9, 13, 15, 19, 22]
        want = {(40, 30, 42, "entropy")} | {(n, 30, 42, "gini") for n in grid}
        assert len(fitted) == 1 + 5 * len(grid) + 1
    assert set(fitted) == want and set(balances) == {"before"}


def test_many_batches_renew_a_part_once(spark, places, tmp_path, monkeypatch):
    log, table, checkpoint, folder = (str(tmp_path / x) for x in ("log", "table", "cp", "digest"))
    dim = station_dim(
        tables.read_dim(spark, places["stations_path"], STATION_SCHEMA),
        tables.read_dim(spark, places["ids_path"], DATA_ID_SCHEMA),
    )
    renewals, label = [], observations.label_rain

    def counted(*args):
        renewals.append(1)
        return label(*args)

    monkeypatch.setattr(observations, "label_rain", counted)
    run = lambda: write_labelled(digest_stream(spark, folder, 2), log, table, checkpoint, dim, buckets=2).awaitTermination()
    rows = lambda: sorted(map(tuple, spark.read.parquet(table).select(*DAILY_COLUMNS).collect()), key=repr)
    want = lambda: sorted(map(tuple, daily_observations(read_digest(spark, folder), dim).collect()), key=repr)
    run()
    assert spark.read.parquet(log).select("batch_id").distinct().count() > 2
    assert len(renewals) == 1 and rows() == want()
    # A run that ends between the log and the renewal: the next one makes up for it, though nothing new arrives.
    wf.write_digest_files(folder, {("ID1", "202303.refresh1"): wf.month("202303", 0) + [wf.line("2023-03-29", "9.0")]})
    monkeypatch.setattr(observations, "label_rain", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run()
    monkeypatch.setattr(observations, "label_rain", counted)
    assert rows() != want()
    run()
    assert rows() == want()
    run()
    assert len(renewals) == 2
