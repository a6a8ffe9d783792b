"""Operators against brute force on small data, hot keys included."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from petrichor.operators import balance, joins, order_stats, positions, split
from petrichor.operators.impute import cap_iqr, impute_group_median, impute_mode
from petrichor.operators.metrics import classification_metrics, classification_report
from petrichor.operators.modes import modes
from petrichor.operators.profile import correlation_matrix, head_and_tail
from petrichor.operators.windows import first_per_group, next_in_group


def pairs(df, *cols):
    return sorted([tuple(r[c] for c in cols) for r in df.select(*cols).collect()], key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, some have none, one key is unknown to the dimension."""
    rng = random.Random(5)
    rows = [(i, None if i % 50 == 0 else "hot" if i % 3 == 0 else rng.choice("abcdefgx")) for i in range(3000)]
    return spark.createDataFrame(rows, "id int, k string")


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([(k, ord(k[0])) for k in ["hot", *"abcdefgh"]], "k string, v int")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("small", [True, False])
def test_lookup_join(skewed, dim, how, small):
    want = skewed.join(dim, "k", how)
    got = joins.lookup_join(skewed, dim, ["k"], how, small)
    assert pairs(got, "id", "k", "v") == pairs(want, "id", "k", "v")


def test_small_counts_rows_and_bytes(spark):
    table = spark.range(100).select("id", F.lit("x" * 1000).alias("t"), F.array(F.lit("y" * 500)).alias("a"), F.lit(None).cast("binary").alias("b"))
    assert joins.is_small(table) and not joins.is_small(table, max_rows=99)
    assert joins.is_small(table, max_bytes=200_000) and not joins.is_small(table, max_bytes=150_000)
    assert joins.is_small(table.where("id < 0"), max_rows=0)


def test_lookup_join_reads_the_facts_once(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id % 7 AS k").write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    dim = spark.range(7).selectExpr("id AS k", "id * 2 AS v")
    for small in (True, False):
        plan = joins.lookup_join(facts, dim, ["k"], "left", small)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1


def test_lookup_join_splits_a_hot_key(spark):
    """A key of most rows, and rows without a key, give the rows of the plain join when partitions are split."""
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    held = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        facts = spark.range(0, 60_000, 1, 12).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 3 = 1 THEN NULL ELSE id END AS k")
        dim = spark.range(0, 60_000, 1, 4).selectExpr("id AS k", "id * 2 AS v").where("k % 5 != 0")
        got = joins.lookup_join(facts, dim, ["k"], "left", small=False)
        rows = got.collect()
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
        found = [r.v for r in rows if r.v is not None]
        known = [1 if i % 3 == 0 else i for i in range(60_000) if i % 3 != 1]
        known = [k for k in known if k % 5]
        assert (len(rows), len(found), sum(found)) == (60_000, len(known), 2 * sum(known))
    finally:
        for k, v in held.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_lookup_join_beyond_the_bound(skewed, dim, monkeypatch):
    monkeypatch.setattr(joins, "is_small", lambda df, max_rows=0: False)
    assert joins.lookup_join(skewed, dim, ["k"], "inner").count() == skewed.join(dim, "k").count()


def existing(spark):
    held = spark.createDataFrame([("d1", 1), ("d2", 2)], "date string, location_id int")
    new = spark.createDataFrame(
        [("d1", 1, 0.5), ("d1", 2, 1.5), ("d3", 1, 2.5), ("d3", 1, 2.5), (None, 1, 3.5)],
        "date string, location_id int, t double",
    )
    return new, held


def test_drop_existing_pair_keeps_new_pairs_and_copies(spark):
    new, held = existing(spark)
    got = joins.drop_existing(new, held, ["date", "location_id"])
    assert pairs(got, "t") == [(1.5,), (2.5,), (2.5,), (3.5,)]


def test_drop_existing_independent_drops_mixed_pairs(spark):
    new, held = existing(spark)
    got = joins.drop_existing(new, held, ["date", "location_id"], match="independent")
    assert pairs(got, "t") == [(2.5,), (2.5,), (3.5,)]


def test_drop_existing_from_nothing(spark):
    new, held = existing(spark)
    assert joins.drop_existing(new, held.where("false"), ["date", "location_id"]).count() == 5


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(11)
    rows = [
        ("hot" if i % 3 == 0 else rng.choice("abc"), rng.choice([None, rng.randint(0, 9) / 2, rng.gauss(0, 5)]), rng.random())
        for i in range(3000)
    ] + [("one", 1.0, None), ("none", None, None), (None, 5.0, 5.0)]
    return spark.createDataFrame(rows, "g string, v double, w double"), pd.DataFrame(rows, columns=["g", "v", "w"])


@pytest.mark.parametrize("windowed", [10**9, 0])
@pytest.mark.parametrize("accuracy, buffered", [(10_000, 0), (100, 0), (7, 0), (10_000, 10**6), (50, 1500)])
def test_quantiles_by_group(values, monkeypatch, accuracy, buffered, windowed):
    monkeypatch.setattr(order_stats, "WINDOWED_ROWS", windowed)
    df, pdf = values
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r["g"]: r for r in order_stats.quantiles(df, ["v", "w"], probs, ["g"], accuracy, buffered=buffered).collect()}
    want = pdf.dropna(subset=["g"]).groupby("g")[["v", "w"]].quantile(probs).unstack()
    assert set(got) == {"hot", "a", "b", "c", "one"}
    for g, row in got.items():
        for c in ("v", "w"):
            if pdf[pdf.g == g][c].notna().any():
                assert row[c] == pytest.approx(list(want.loc[g][c]), abs=1e-12)
            else:
                assert row[c] is None or set(row[c]) == {None}


def test_both_ways_give_the_same_bits(spark):
    # Numbers that are not exact in binary, in groups of many sizes.
    rows = spark.range(4000).selectExpr("cast(sqrt(id) as int) as g", "pmod(hash(id), 100000) / 700D as v")
    probs = [0.1, 0.25, 1 / 3, 0.5, 0.75, 0.9]
    ways = [order_stats.quantiles(rows, ["v"], probs, ["g"], buffered=most) for most in (0, 10**6)]
    one, other = [{r["g"]: [x.hex() for x in r["v"]] for r in way.collect()} for way in ways]
    assert one == other and len(one) == 64


@pytest.mark.parametrize("buffered", [0, 10**6])
def test_quantiles_overall(values, buffered):
    df, pdf = values
    got = order_stats.quantiles(df, ["v", "w"], [0.25, 0.75], accuracy=50, buffered=buffered).first()
    for c in ("v", "w"):
        assert got[c] == pytest.approx(list(pdf[c].quantile([0.25, 0.75])), abs=1e-12)


def test_brackets_narrow_large_groups(spark):
    df = spark.range(0, 200_000, 1, 16).select((F.col("id") * 48_271 % 200_003).cast("double").alias("v"))
    ends = order_stats._brackets(df, ["v"], [0.25, 0.5], [], 2000).first()["_b0"]
    ordered = sorted(r["v"] for r in df.collect())
    for share, low, high in ((0.25, ends[0], ends[1]), (0.5, ends[2], ends[3])):
        assert low <= ordered[int(share * 200_000)] <= high
        assert sum(low <= x <= high for x in ordered) < 4_000
    sorted_parts = df.orderBy("v")
    assert order_stats.quantiles(sorted_parts, ["v"], [0.5], buffered=0).first()["v"][0] == pytest.approx(
        (ordered[99_999] + ordered[100_000]) / 2
    )


def test_sketches_hold_no_more_than_the_rows(spark):
    df = spark.range(5000).selectExpr("if(id < 4000, 'large', cast(id as string)) as g", "id / 7D as v")
    plan = df.groupBy("g").agg(F.kll_sketch_agg_double("v", order_stats._sketch_size(order_stats.ACCURACY)).alias("s"), F.count("v").alias("n"))
    held = plan.selectExpr("n", "length(s) / 8 as doubles").collect()
    assert len(held) == 1001 and all(r["doubles"] <= r["n"] + 8 for r in held)
    brackets = order_stats._brackets(df, ["v"], [0.5], ["g"], order_stats.ACCURACY)
    assert brackets.count() == 1001 and "Window" not in brackets._jdf.queryExecution().toString()


@pytest.mark.parametrize("buffered", [0, 10**6])
def test_not_a_number_is_the_largest(spark, buffered):
    numbers = [float(i) for i in range(600)] + [float("nan")] * 300 + [float("inf")] * 100 + [None] * 50
    df = spark.createDataFrame([(x,) for x in numbers], "v double").repartition(5)
    got = order_stats.quantiles(df, ["v"], [0.0, 0.25, 0.65, 0.9, 1.0], accuracy=2000, buffered=buffered).first()["v"]
    assert got[0] == 0.0 and got[1] == pytest.approx(249.75) and got[2] == float("inf")
    assert got[3] != got[3] and got[4] != got[4]


@pytest.mark.parametrize("buffered", [0, 10**6])
def test_value_at_rank(values, buffered):
    df, pdf = values
    got = order_stats.value_at_rank(df, "w", 0.2, lambda n: F.lit(599), 40, buffered).first()["w"]
    assert got == sorted(pdf.w.dropna())[599]
    found = order_stats.values_at_ranks(df, "v", [(0.0, lambda n: F.lit(0)), (1.0, lambda n: n - 1)], ["g"], 40, buffered)
    ends = pdf.dropna(subset=["g", "v"]).groupby("g").v.agg(["min", "max"])
    assert {r["g"]: tuple(r["v"]) for r in found.collect()} == {g: tuple(r) for g, r in ends.iterrows()}


def test_sketch_is_near(values):
    df, pdf = values
    got = order_stats.quantiles(df, ["w"], [0.5], exact=False).first()["w"][0]
    assert abs(got - pdf.w.median()) < 0.01


def test_modes_take_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("a", "y"), ("b", "x"), (None, None)], "p string, q string")
    assert tuple(modes(df, ["p", "q"]).first()) == ("a", "x")
    with pytest.raises(ValueError):
        modes(df.withColumn("n", F.lit(1)), ["p", "n"])


def test_imputation(spark):
    df = spark.createDataFrame(
        [("a", "N", 1.0), ("a", None, 3.0), ("a", "N", None), ("b", "S", None)], "g string, d string, v double"
    )
    got = impute_group_median(impute_mode(df, ["d"]), ["g"], ["v"])
    assert pairs(got, "g", "d", "v") == [("a", "N", 1.0), ("a", "N", 2.0), ("a", "N", 3.0), ("b", "S", 0.0)]


def test_caps(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 9)] + [(100.0,), (None,)], "v double")
    s = pd.Series([*map(float, range(1, 9)), 100.0])
    high = float(s.quantile(0.75) + 1.5 * (s.quantile(0.75) - s.quantile(0.25)))
    assert pairs(cap_iqr(df, ["v"]), "v") == sorted([(x,) for x in [*map(float, range(1, 9)), high, None]], key=repr)


@pytest.mark.parametrize("chunk", [None, "t div 10"])
def test_next_in_group(spark, chunk):
    rng = random.Random(2)
    rows = [(g, t, rng.choice([None, "Yes", "No"])) for g in ("x", None, "y") for t in rng.sample(range(95), 40)]
    df = spark.createDataFrame(rows, "g string, t long, v string")
    got = next_in_group(df, ["g"], ["t"], "v", "n", F.expr(chunk) if chunk else None)
    pdf = pd.DataFrame(rows, columns=["g", "t", "v"]).sort_values("t")
    pdf["n"] = pdf.groupby("g", dropna=False).v.shift(-1)
    want = [(g, t, v, n if isinstance(n, str) else None) for g, t, v, n in pdf.itertuples(index=False)]
    want = [(g if isinstance(g, str) else None, t, v if isinstance(v, str) else None, n) for g, t, v, n in want]
    assert pairs(got, "g", "t", "v", "n") == sorted(want, key=repr)


def test_first_per_group_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    first = first_per_group(df, ["g"], [F.desc("id")])
    assert pairs(first, "g", "id") == [(0, 99), (1, 97), (2, 98)]
    assert "WindowGroupLimit" in first._jdf.queryExecution().toString()


def test_positions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), "id")
    got = positions.ordered_positions(df, ["k"], "pos")
    want = sorted(r["k"] for r in df.collect())
    assert [r["k"] for r in got.orderBy("pos").collect()] == want
    assert [r["pos"] for r in got.select("pos").orderBy("pos").collect()] == list(range(5000))
    copies = df.where("id % 7 <> 0").withColumn("k", F.lit("same"))
    placed = positions.written_positions(copies, "pos").collect()
    assert sorted(r["pos"] for r in placed) == list(range(len(placed))) and len({r["id"] for r in placed}) == len(placed)


@pytest.mark.parametrize("limit", [200_000, 1])
def test_factorize(spark, monkeypatch, limit):
    monkeypatch.setattr(positions, "BROADCAST_ROWS", limit)
    rows = [("b", "y", 1), ("a", "y", 2), ("b", None, 3), ("c", "x", 4), (None, "x", 5)]
    df = spark.createDataFrame(rows, "p string, q string, t int")
    pdf = pd.DataFrame(rows, columns=["p", "q", "t"])
    got, codes = positions.factorize(df, ["p", "q"], ["t"])
    want = list(zip(pd.factorize(pdf.p)[0].tolist(), pd.factorize(pdf.q)[0].tolist()))
    assert [(r["p"], r["q"]) for r in got.orderBy("t").collect()] == want
    assert pairs(codes["p"].table, "code", "value") == [(0, "b"), (1, "a"), (2, "c")]
    by_name = positions.factorize(df, ["p"], ["t"], by="alphabet")[0]
    assert [r["p"] for r in by_name.orderBy("t").collect()] == [1, 0, 1, 2, -1]


def classes(spark, zeros, ones):
    rows = [(i, 0) for i in range(zeros)] + [(1000 + i, 1) for i in range(ones)] + [(5000, None)]
    return spark.createDataFrame(rows, "id long, y int")


@pytest.mark.parametrize("method", ["draw", "cycle", "shuffled_cycle"])
@pytest.mark.parametrize("zeros, ones", [(100, 7), (100, 100), (5, 60), (100, 1)])
@pytest.mark.parametrize("block, buffered", [(100_000, 10**6), (3, 0)])
def test_oversample_sizes(spark, monkeypatch, method, zeros, ones, block, buffered):
    monkeypatch.setattr(balance, "BLOCK", block)
    rows = classes(spark, zeros, ones)
    out = balance.oversample(rows, "y", ["id"], method, copy="c", slot="s", buffered=buffered).collect()
    kept, copies = [r for r in out if not r["c"]], [r for r in out if r["c"]]
    assert sorted(r["id"] for r in kept) == list(range(zeros))
    assert len(copies) == zeros and {r["y"] for r in copies} == {1}
    assert len({(r["id"], r["s"]) for r in copies}) == zeros
    if method == "cycle":
        assert sorted(r["id"] for r in copies) == sorted(1000 + i % ones for i in range(zeros))


@pytest.mark.parametrize("method", ["draw", "cycle", "shuffled_cycle"])
@pytest.mark.parametrize("zeros", [100, 17, 25])
def test_oversample_with_copies_of_a_row(spark, method, zeros):
    rows = [(i, 0) for i in range(zeros)] + [(1000, 1)] * 12 + [(1000 + i, 1) for i in range(1, 18)]
    df = spark.createDataFrame(rows, "id long, y int")
    out = balance.oversample(df, "y", ["id"], method)
    assert pairs(out.groupBy("y").count(), "y", "count") == [(0, zeros), (1, zeros)]


def test_oversample_without_minority(spark):
    with pytest.raises(ValueError):
        balance.oversample(classes(spark, 5, 0), "y", ["id"])


@pytest.mark.parametrize("buffered", [0, 10**6])
def test_splits(spark, buffered):
    df = classes(spark, 101, 33).where("y is not null")
    train, test = split.split(df, ["id"], stratify="y", buffered=buffered)
    assert pairs(test.groupBy("y").count(), "y", "count") == [(0, 21), (1, 7)]
    assert train.count() + test.count() == 134 and not train.join(test, "id", "left_semi").count()
    train, test = split.split(df, ["id"])
    assert train.count() + test.count() == 134 and 10 < test.count() < 50
    folds = split.with_fold(df, ["id"], "y", buffered=buffered).groupBy("y", "fold").count().collect()
    assert {(r["y"], r["count"]) for r in folds} <= {(0, 20), (0, 21), (1, 6), (1, 7)} and len(folds) == 10


def test_scale_uses_the_given_range(spark):
    df = spark.createDataFrame([(0.0, 4), (5.0, 4), (10.0, 4)], "a double, b int")
    got = split.scale(df, ["a", "b"], fit_on=df.where("a < 6"))
    assert pairs(got, "a", "b") == [(0.0, 0.0), (1.0, 0.0), (2.0, 0.0)]


def test_metrics_of_one_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (0, 1)], "y int, p int")
    got = classification_metrics(df, "y", "p").first()
    assert got["accuracy"] == pytest.approx(2 / 3) and got["precision"] == 1.0 and got["f1_score"] == pytest.approx(0.8)
    report = {r["class"]: r for r in classification_report(df, "y", "p").collect()}
    assert report["1.0"]["support"] == 0 and report["1.0"]["recall"] == 0.0 and report["1.0"]["precision"] == 0.0
    assert report["macro avg"]["f1_score"] == pytest.approx(0.4)


def test_metrics_agree_with_spark_ml(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    df = spark.range(300).select(
        (F.col("id") % 2).cast("double").alias("y"), (F.col("id") * 7 % 5 > 1).cast("double").alias("p")
    )
    got = classification_metrics(df, "y", "p").first()
    names = {"accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1_score": "f1"}
    for ours, theirs in names.items():
        ev = MulticlassClassificationEvaluator(labelCol="y", predictionCol="p", metricName=theirs)
        assert got[ours] == pytest.approx(ev.evaluate(df))


def test_correlations_skip_unknown_pairs(spark):
    rows = [(1.0, 2.0, 5), (2.0, None, 4), (3.0, 1.0, 4), (None, 7.0, 1), (5.0, 0.5, 1)]
    got = {(r["a"], r["b"]): r["r"] for r in correlation_matrix(spark.createDataFrame(rows, "x double, y double, z int"), ["x", "y", "z"]).collect()}
    want = pd.DataFrame(rows, columns=["x", "y", "z"]).corr()
    assert all(got[a, b] == pytest.approx(want.loc[a, b]) for a, b in got) and len(got) == 9


def test_head_and_tail(spark):
    got = pairs(head_and_tail(spark.range(50).toDF("id"), ["id"], 2), "part", "id")
    assert got == [("head", 0), ("head", 1), ("tail", 48), ("tail", 49)]


def test_draw_does_not_depend_on_the_partitioning(spark):
    rows = classes(spark, 40, 15)
    drawn = [pairs(balance.oversample(rows.repartition(n), "y", ["id"], "draw"), "id", "y") for n in (1, 7)]
    assert drawn[0] == drawn[1]


@pytest.mark.parametrize("range_rows", [10_000, 4])
def test_draw_numbers_rows_without_sorting_ranges(spark, monkeypatch, range_rows):
    from pyspark.sql.classic.dataframe import DataFrame

    from petrichor.functions.hashing import row_hash

    def refuse(*_):
        raise AssertionError("rows are sampled and written to find ranges")

    monkeypatch.setattr(DataFrame, "repartitionByRange", refuse)
    monkeypatch.setattr(positions, "RANGE_ROWS", range_rows)
    rows = classes(spark, 300, 50)
    hashed = rows.where("y = 1").withColumn("h", row_hash(["id"], 7))
    numbered = positions.hashed_positions(hashed, "h", ["id"], 50, "pos").orderBy("h").collect()
    assert [r["pos"] for r in numbered] == list(range(50))
    got = balance.oversample(rows, "y", ["id"], "draw", 7).where("y = 1").groupBy("id").count()
    by_hash = [r["id"] for r in numbered]
    draws = spark.range(300).select((row_hash(["id"], 7) % 50).alias("pos")).groupBy("pos").count()
    assert pairs(got, "id", "count") == sorted([(by_hash[r["pos"]], r["count"]) for r in draws.collect()], key=repr)


def test_rows_without_a_class_are_not_split_silently(spark):
    with pytest.raises(ValueError):
        split.with_fold(classes(spark, 20, 10), ["id"], "y")
