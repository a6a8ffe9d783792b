"""Training runs and model versions as append-only tables.

Parquet has no update in place, so nothing is updated: a run, a version and a change of stage
are each one appended row, and the current stage of a version is its latest change.
"""

from __future__ import annotations

import time
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from petrichor.functions.dates import epoch_ms_text
from petrichor.operators.joins import lookup_join
from petrichor.operators.windows import first_per_group
from petrichor.schemas import MODEL_NAME, VERSION_METRICS
from petrichor.sources.ledger import next_number
from petrichor.sources.tables import table_exists

RUNS = "run_id string, status string, params map<string,string>, metrics map<string,double>, started_ms long"
VERSIONS = "name string, version string, creation_timestamp long, run_id string, path string"
STAGES = "name string, version string, stage string, changed_ms long"


def current_versions(versions: DataFrame, stages: DataFrame) -> DataFrame:
    """Versions with their latest stage; 'None' for one that never changed."""
    latest = first_per_group(stages, ["name", "version"], [F.desc("changed_ms"), "stage"])
    joined = versions.join(latest.select("name", "version", "stage"), ["name", "version"], "left")
    return joined.withColumn("status", F.coalesce("stage", F.lit("None"))).drop("stage")


def version_listing(versions: DataFrame, runs: DataFrame) -> DataFrame:
    """Versions with creation date and seven metrics, in numeric version order.

    Many versions may name one run that is gone; such a run id meets no single task.
    """
    found = lookup_join(versions, runs.select("run_id", F.col("metrics").alias("_m")), ["run_id"], "left")
    metrics = F.struct(*[F.try_element_at("_m", F.lit(m)).alias(m) for m in VERSION_METRICS])
    return found.select(
        "name",
        "version",
        "status",
        epoch_ms_text(F.col("creation_timestamp")).alias("creation_date"),
        "run_id",
        metrics.alias("metrics"),
    ).orderBy(F.col("version").cast("int"), "name")


def run_listing(runs: DataFrame) -> DataFrame:
    """(run_id, status, metric, value): every metric of every run."""
    return runs.select("run_id", "status", F.explode_outer("metrics").alias("metric", "value"))


def scored_runs(runs: DataFrame) -> DataFrame:
    """Runs that have an F1 score, with it."""
    scored = runs.withColumn("f1_score", F.try_element_at("metrics", F.lit("f1_score")))
    return scored.where(F.col("f1_score").isNotNull())


def ranked_runs(runs: DataFrame, limit: int = 1000) -> DataFrame:
    """The ``limit`` runs with the highest F1 score, best first: a report."""
    return scored_runs(runs).orderBy(F.desc("f1_score"), "run_id").limit(limit)


def latest_per_stage(versions: DataFrame) -> DataFrame:
    """The newest version of each model in each stage."""
    return first_per_group(versions, ["name", "status"], [F.desc(F.col("version").cast("int"))])


def pick_version(
    versions: DataFrame, runs: DataFrame, by: str, version: str | None = None, name: str = MODEL_NAME
) -> DataFrame:
    """At most one version: ``production``, ``latest``, ``best`` (by F1) or a given ``version``."""
    own = versions.where(F.col("name") == name)
    number = F.col("version").cast("int")
    if by == "production":
        own = own.where(F.col("status") == "Production")
    elif by == "version":
        own = own.where(F.col("version") == version)
    elif by == "best":
        best = own.join(scored_runs(runs).select("run_id", "f1_score"), "run_id")
        return best.orderBy(F.desc("f1_score"), number.desc()).limit(1).select(*versions.columns)
    elif by != "latest":
        raise ValueError(f"unknown choice {by!r}")
    return own.orderBy(number.desc()).limit(1)


class Registry:
    """The tables and the saved models below one folder."""

    def __init__(self, spark: SparkSession, root: str, name: str = MODEL_NAME):
        self.spark, self.root, self.name = spark, root.rstrip("/"), name

    def _read(self, table: str, schema: str) -> DataFrame:
        path = f"{self.root}/{table}"
        if not table_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        names = [c.split()[0] for c in schema.split(", ")]
        return self.spark.read.schema(schema).parquet(path).select(*names)

    def _append(self, table: str, schema: str, rows: list[tuple]) -> None:
        """Each append has a folder of its own, so that writers do not share one job's temporary files."""
        path = f"{self.root}/{table}/append=A{uuid.uuid4().hex}"
        self.spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)

    def runs(self) -> DataFrame:
        return self._read("runs", RUNS)

    def versions(self) -> DataFrame:
        return current_versions(self._read("versions", VERSIONS), self._read("stages", STAGES))

    def listing(self) -> DataFrame:
        return version_listing(self.versions(), self.runs())

    def log_run(self, params: dict, metrics: dict, status: str = "FINISHED") -> str:
        """Record one run; metrics without a value are left out."""
        run_id = uuid.uuid4().hex
        known = {k: float(v) for k, v in metrics.items() if v is not None}
        text = {k: str(v) for k, v in params.items()}
        self._append("runs", RUNS, [(run_id, status, text, known, int(time.time() * 1000))])
        return run_id

    def log_schema(self, run_id: str, report: DataFrame) -> None:
        """Keep the one-row schema report of a run beside it, as JSON."""
        report.coalesce(1).write.mode("overwrite").json(f"{self.root}/schemas/{run_id}")

    def register(self, model: PipelineModel, run_id: str) -> str:
        """Save a model under the next version number, which no other writer gets.

        A number is taken before the model is saved; a run that fails in between leaves a gap.
        """
        number = F.max(F.col("version").cast("int"))
        last = self._read("versions", VERSIONS).where(F.col("name") == self.name).agg(number).first()[0]
        version = str(next_number(self.spark, f"{self.root}/numbers/{self.name}", last or 0, run_id))
        path = f"{self.root}/models/{self.name}/{version}-{run_id}"
        model.write().overwrite().save(path)
        self._append("versions", VERSIONS, [(self.name, version, int(time.time() * 1000), run_id, path)])
        return version

    def promote(self, version: str) -> None:
        """Make a version the production one and archive the one before it, in one append."""
        now = int(time.time() * 1000)
        live = self.versions().where((F.col("name") == self.name) & (F.col("status") == "Production"))
        old = [r["version"] for r in live.select("version").collect() if r["version"] != version]
        rows = [(self.name, v, "Archived", now) for v in old] + [(self.name, version, "Production", now)]
        self._append("stages", STAGES, rows)

    def pick(self, by: str = "production", version: str | None = None) -> Row | None:
        """name, version, path and status of the version asked for, if there is one."""
        return pick_version(self.versions(), self.runs(), by, version, self.name).first()

    def load(self, by: str = "production", version: str | None = None) -> PipelineModel | None:
        found = self.pick(by, version)
        return PipelineModel.load(found["path"]) if found else None

    def info(self, version: str) -> Row | None:
        """The row of the listing for one version."""
        return self.listing().where((F.col("name") == self.name) & (F.col("version") == version)).first()
