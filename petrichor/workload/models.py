"""Forests, scoring, model comparison and the version tables.

Orders stand in for training runs and model versions: every order is one run and one version of
the model named by its priority, and every line item is one change of stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from petrichor.operators.metrics import classification_metrics, regression_metrics
from petrichor.operators.positions import written_positions
from petrichor.plans.clean import Cleaned, clean
from petrichor.plans.jobs import ingest_and_train, predict_locations, predict_registered, train_and_promote, warehouse
from petrichor.plans.registry import (
    Registry,
    current_versions,
    latest_per_stage,
    pick_version,
    ranked_runs,
    run_listing,
    version_listing,
)
from petrichor.plans.training import (
    champion_metrics,
    compare,
    score,
    train_forest,
    train_regressor,
    tune_forest,
)
from petrichor.operators.split import split
from petrichor.schemas import BASELINE_FOREST, CLEAN_KEYS, FOLDS, FOREST, LABEL, TREE_GRID
from petrichor.session import materialize, scratch_path
from petrichor.workload.base import Tables, query
from petrichor.sources.bulletins import write_files
from petrichor.workload.weather import DAYS_SQL, delivered_whole, load_dims, weather


def runs(spark: SparkSession, sf: str) -> DataFrame:
    f1 = F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice") / 1e6)
    known = F.create_map(F.lit("accuracy"), F.col("o_custkey") / 1e5)
    with_f1 = F.map_concat(known, F.create_map(F.lit("f1_score"), f1))
    return Tables(spark, sf).orders.select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderstatus").alias("status"),
        F.create_map(F.lit("numTrees"), F.lit("100")).alias("params"),
        F.when(f1.isNotNull(), with_f1).otherwise(known).alias("metrics"),
        F.lit(0).cast("long").alias("started_ms"),
    )


def versions(spark: SparkSession, sf: str) -> DataFrame:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return Tables(spark, sf).orders.select(
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderkey").cast("string").alias("version"),
        F.timestamp_diff("MILLISECOND", epoch, F.col("o_orderdate")).alias("creation_timestamp"),
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderkey").cast("string")).otherwise("lost").alias("run_id"),
        F.lit("").alias("path"),
    )


def stages(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    stage = F.when(F.col("l_returnflag") == "R", "Production").when(F.col("l_returnflag") == "A", "Archived")
    changes = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), stage.alias("stage"), F.col("l_linenumber").cast("long").alias("changed_ms")
    ).where("stage IS NOT NULL")
    named = changes.join(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderkey")
    return named.select(
        F.col("o_orderpriority").alias("name"), F.col("o_orderkey").cast("string").alias("version"), "stage", "changed_ms"
    )


RUNS_SQL = """
    runs AS (SELECT o_orderkey::VARCHAR AS run_id, o_orderstatus AS status, o_custkey / 1e5::DOUBLE AS accuracy,
                    CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice / 1e6::DOUBLE END AS f1_score FROM orders)
"""

VERSIONS_SQL = """
    versions AS (SELECT o_orderpriority AS name, o_orderkey::VARCHAR AS version, o_orderdate,
                        CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey::VARCHAR ELSE 'lost' END AS run_id FROM orders),
    changes AS (SELECT l_orderkey::VARCHAR AS version, CASE l_returnflag WHEN 'R' THEN 'Production' ELSE 'Archived' END AS stage,
                       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC,
                           CASE l_returnflag WHEN 'R' THEN 'Production' ELSE 'Archived' END) AS rn
                FROM lineitem WHERE l_returnflag IN ('R', 'A')),
    current AS (SELECT versions.*, coalesce(stage, 'None') AS status FROM versions
                LEFT JOIN changes ON changes.version = versions.version AND rn = 1)
"""


@query("m9_p11_current_versions", f"WITH {VERSIONS_SQL} SELECT name, version, status FROM current")
def m9(spark, sf):
    return current_versions(versions(spark, sf), stages(spark, sf)).select("name", "version", "status")


@query(
    "p11_production_versions", f"WITH {VERSIONS_SQL} SELECT name, version FROM current WHERE status = 'Production'"
)
def p11(spark, sf):
    found = current_versions(versions(spark, sf), stages(spark, sf))
    return found.where(F.col("status") == "Production").select("name", "version")


@query(
    "m11_j6_o3_version_listing",
    f"""
    WITH {RUNS_SQL}, {VERSIONS_SQL}
    SELECT name, version, c.status, strftime(o_orderdate, '%d-%m-%Y %H:%M:%S') AS creation_date, c.run_id,
           accuracy, f1_score, NULL::DOUBLE AS rmse
    FROM current c LEFT JOIN runs r ON c.run_id = r.run_id
    """,
)
def m11(spark, sf):
    listing = version_listing(current_versions(versions(spark, sf), stages(spark, sf)), runs(spark, sf))
    return listing.select(
        "name", "version", "status", "creation_date", "run_id", "metrics.accuracy", "metrics.f1_score", "metrics.rmse"
    )


@query(
    "o3_version_order",
    f"""
    WITH {VERSIONS_SQL}
    SELECT name, version, row_number() OVER (ORDER BY version::INTEGER, name) - 1 AS position FROM current
    """,
)
def o3(spark, sf):
    """Where each version stands in the listing as written: numbers, not texts, decide."""
    listing = version_listing(current_versions(versions(spark, sf), stages(spark, sf)), runs(spark, sf))
    return written_positions(listing.select("name", "version"), "position")


@query(
    "m13_run_listing",
    f"""
    WITH {RUNS_SQL}
    SELECT run_id, status, 'accuracy' AS metric, accuracy AS value FROM runs
    UNION ALL SELECT run_id, status, 'f1_score', f1_score FROM runs WHERE f1_score IS NOT NULL
    """,
)
def m13(spark, sf):
    return run_listing(runs(spark, sf))


@query(
    "o2_p12_ranked_runs",
    f"""
    WITH {RUNS_SQL} SELECT run_id, f1_score FROM runs WHERE f1_score IS NOT NULL ORDER BY f1_score DESC, run_id LIMIT 1000
    """,
)
def p12(spark, sf):
    return ranked_runs(runs(spark, sf)).select("run_id", "f1_score")


@query(
    "w3_latest_version_per_stage",
    f"""
    WITH {VERSIONS_SQL}
    SELECT name, status, max(version::INTEGER)::VARCHAR AS version FROM current GROUP BY ALL
    """,
)
def w3(spark, sf):
    found = current_versions(versions(spark, sf), stages(spark, sf))
    return latest_per_stage(found).select("name", "status", "version")


@query(
    "m10_pick_version",
    f"""
    WITH {RUNS_SQL}, {VERSIONS_SQL}, own AS (SELECT * FROM current WHERE name = '1-URGENT')
    SELECT 'production' AS choice, max(version::INTEGER)::VARCHAR AS version FROM own WHERE status = 'Production'
    UNION ALL SELECT 'latest', max(version::INTEGER)::VARCHAR FROM own
    UNION ALL (SELECT 'best', version FROM own JOIN (
                   SELECT * FROM runs WHERE f1_score IS NOT NULL) r USING (run_id)
               ORDER BY f1_score DESC, version::INTEGER DESC LIMIT 1)
    """,
)
def m10(spark, sf):
    found, logged = current_versions(versions(spark, sf), stages(spark, sf)), runs(spark, sf)
    picks = [
        pick_version(found, logged, by, name="1-URGENT").select(F.lit(by).alias("choice"), "version")
        for by in ("production", "latest", "best")
    ]
    return picks[0].unionByName(picks[1]).unionByName(picks[2])


@query(
    "m8_champion_and_challenger",
    """
    WITH s AS (SELECT toxic AS y, 'new' AS model, CASE WHEN quality = 0 THEN 1 ELSE 0 END AS p FROM labels
               UNION ALL SELECT toxic, 'old', (doc_id % 2)::INTEGER FROM labels),
    k AS (SELECT model, c, count(*) FILTER (y = c) AS support, count(*) FILTER (p = c) AS predicted,
                 count(*) FILTER (y = c AND p = c) AS tp FROM s, (VALUES (0), (1)) v(c) GROUP BY ALL),
    f AS (SELECT model, sum(support * CASE WHEN tp = 0 THEN 0 ELSE 2 * tp / (support + predicted)::DOUBLE END) / sum(support) AS f1
          FROM k GROUP BY model),
    o AS (SELECT max(f1) FILTER (model = 'new') AS n, max(f1) FILTER (model = 'old') AS p FROM f)
    SELECT round(n, 6) AS new_score, round(p, 6) AS previous_score, round((n - p) / p, 6) AS improvement,
           (n - p) / p > 0.01 AS promote FROM o
    """,
)
def m8(spark, sf):
    labels = Tables(spark, sf).labels
    new = F.when(F.col("quality") == 0, 1).otherwise(0)
    guesses = F.array(
        F.struct(F.lit("new").alias("model"), new.cast("double").alias("prediction")),
        F.struct(F.lit("old").alias("model"), (F.col("doc_id") % 2).cast("double").alias("prediction")),
    )
    scored = labels.select("toxic", F.explode(guesses).alias("g")).select("toxic", "g.*")
    out = compare(classification_metrics(scored, "toxic", "prediction", ["model"]), "new", "old")
    return out.select(
        *[F.round(c, 6).alias(c) for c in ("new_score", "previous_score", "improvement")], "promote"
    )


@query(
    "m6_rmse_contest",
    """
    WITH s AS (SELECT m.model, avg(power(toxic - CASE m.model WHEN 'new' THEN quality / 4e0 WHEN 'old' THEN quality / 2e0 ELSE doc_id % 2 END, 2)) AS mse
               FROM labels, (VALUES ('new'), ('old'), ('poor')) m(model) GROUP BY m.model),
    r AS (SELECT model, sqrt(mse) AS rmse FROM s),
    p AS (SELECT a.model AS challenger, b.model AS champion, a.rmse AS n, b.rmse AS o FROM r a JOIN r b ON a.model <> b.model)
    SELECT challenger, champion, round(n, 6) AS new_score, round(o, 6) AS previous_score, round((o - n) / o, 6) AS improvement,
           (o - n) / o > 0.01 AS promote FROM p
    """,
)
def m6_contest(spark, sf):
    """Every pair of three models: one is promoted over another if its error is lower by over one percent."""
    labels = Tables(spark, sf).labels
    guess = {"new": F.col("quality") / 4, "old": F.col("quality") / 2, "poor": (F.col("doc_id") % 2).cast("double")}
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), p.alias("prediction")) for m, p in guess.items()]))
    scored = labels.select("toxic", each.alias("g")).select("toxic", "g.*")
    measured = materialize(regression_metrics(scored, "toxic", "prediction", ["model"]), "errors")
    out = None
    for new in guess:
        for old in guess:
            if new != old:
                one = compare(measured, new, old, measure="rmse").select(F.lit(new).alias("challenger"), F.lit(old).alias("champion"), "*")
                out = one if out is None else out.unionByName(one)
    rounded = [F.round(c, 6).alias(c) for c in ("new_score", "previous_score", "improvement")]
    return out.select("challenger", "champion", *rounded, "promote")


_SCORED_LOCATIONS = f"""
    WITH {DAYS_SQL},
    places AS (SELECT DISTINCT "Location" FROM daily
               WHERE "RainTomorrow" IS NOT NULL AND "WindSpeed9am" <> 'Calm' AND "WindSpeed3pm" <> 'Calm')
"""


@query(
    "k4_predictions_with_their_model",
    f"""
    {_SCORED_LOCATIONS}
    SELECT "Location" AS "Location_Name", choice, version AS model_version, status, true AS known, true AS measured
    FROM places, (VALUES ('production', '1', 'Production'), ('version', '2', 'None'), ('latest', '2', 'None')) v(choice, version, status)
    """,
)
def k4_registered(spark, sf):
    """Each location by the production version, by a given one and by the latest, with their listing rows."""
    cleaned, registry = _features(spark, sf), Registry(spark, scratch_path(spark, "registry"))
    train, test = split(cleaned.table, CLEAN_KEYS)
    model = train_forest(train, **FOREST)
    own = champion_metrics({"forest": model}, test).drop("model").first().asDict()
    for _ in range(2):
        registry.register(model, registry.log_run(FOREST, own))
    registry.promote("1")
    out = None
    for by, version in (("production", None), ("version", "2"), ("latest", None)):
        one = predict_registered(cleaned.table, registry, cleaned.mapping, by, version).select(
            "Location_Name", F.lit(by).alias("choice"), "model_version", "model_info.status",
            (F.col("prediction").isin(0.0, 1.0) & (F.col("will_rain") == (F.col("prediction") == 1))).alias("known"),
            (F.col("model_info.metrics.f1_score").between(0, 1) & (F.col("model_info.version") == F.col("model_version"))).alias("measured"),
        )
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "k3_m12_ingest_and_train",
    f"""
    WITH {DAYS_SQL}
    SELECT '1' AS version, 'Production' AS status, 'FINISHED' AS run, (SELECT count(*) FROM daily) AS days,
           (SELECT count(*) FROM daily WHERE "RainTomorrow" IS NOT NULL) AS labelled
    """,
)
def k3(spark, sf):
    """Bulletin files to the warehouse and a first model in production, in one call."""
    path = scratch_path(spark, "job")
    write_files(delivered_whole(spark, sf), f"{path}/raw")
    registry, table = Registry(spark, f"{path}/registry"), f"{path}/daily"
    ingest_and_train(spark, registry, table, digest_path=f"{path}/raw", layout="raw", **load_dims(spark, sf, path))
    held = warehouse(spark, table).agg(F.count("*").alias("days"), F.count(LABEL).alias("labelled")).first()
    listing = registry.listing().join(registry.runs().select("run_id", F.col("status").alias("run")), "run_id")
    return listing.select("version", "status", "run", *[F.lit(held[c]).cast("long").alias(c) for c in ("days", "labelled")])


def _features(spark, sf) -> Cleaned:
    """The clean weather table, balanced as in training and written once for the models to read."""
    cleaned = clean(weather(spark, sf))
    return Cleaned(materialize(cleaned.table, "features"), cleaned.mapping)


@query("m3_p9_forest_metrics")
def m3(spark, sf):
    train, test = split(_features(spark, sf).table, CLEAN_KEYS)
    model = train_forest(train, **FOREST)
    return champion_metrics({"forest": model}, test)


@query("m6_regression_forest")
def m6(spark, sf):
    train, test = split(_features(spark, sf).table, CLEAN_KEYS)
    model = train_regressor(train, **FOREST)
    return regression_metrics(score(model, test), LABEL, "prediction")


@query("m4_m5_a15_grid_scores")
def m5(spark, sf):
    tuned = tune_forest(_features(spark, sf).table, grid=TREE_GRID, folds=FOLDS, depth=BASELINE_FOREST["maxDepth"])
    return tuned["scores"]


@query("m7_k4_w2_predictions")
def k4(spark, sf):
    cleaned = _features(spark, sf)
    return predict_locations(cleaned.table, train_forest(cleaned.table, **FOREST), cleaned.mapping, "1")


@query("k2_m12_train_and_promote")
def k2(spark, sf):
    registry = Registry(spark, scratch_path(spark, "registry"))
    train, test = split(_features(spark, sf).table, CLEAN_KEYS)
    train_and_promote(train, test, registry, **FOREST)
    train_and_promote(train, test, registry, **FOREST)
    return registry.listing()
