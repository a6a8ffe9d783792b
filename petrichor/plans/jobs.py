"""The composite jobs: ingest, train, both, and predict."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from petrichor.functions.rain import will_rain
from petrichor.functions.text import percent_text
from petrichor.operators.dictionary import CodeBook
from petrichor.operators.joins import drop_existing, lookup_join
from petrichor.operators.windows import first_per_group
from petrichor.plans.clean import Cleaned, clean
from petrichor.plans.daily import daily_observations, label_rain, station_dim
from petrichor.plans.registry import Registry
from petrichor.plans.training import balanced_split, champion_metrics, compare, features_of, score, train_forest
from petrichor.schemas import CLEAN_KEYS, DAILY_COLUMNS, DATA_ID_SCHEMA, FOREST, LABEL, MIN_GAIN, STATION_SCHEMA, STAMP
from petrichor.session import materialize
from petrichor.sources.bulletins import READERS, quarantine
from petrichor.sources.ledger import LOAD, Conflict, Ledger, write_load
from petrichor.sources.tables import (
    append_new,
    read_dim,
    read_table,
    schema_report,
    stamped,
    write_csv,
    write_table,
)


def ingest(
    spark: SparkSession,
    digest_path: str,
    stations_path: str,
    ids_path: str,
    table: str,
    store: str = "daily",
    day: dt.date | None = None,
    mapping_path: str | None = None,
    label_scope: str = "file",
    layout: str = "digest",
    rejects_path: str | None = None,
    unknown: str = "error",
    **clean_options,
) -> bool:
    """Bulletins to the warehouse table; says whether rows were added.

    ``layout`` names what ``digest_path`` holds: ``digest`` files, ``raw`` bulletins, or the
    ``folders`` that ``write_digest`` makes. Of a bulletin and its refreshes the newest counts.
    With ``rejects_path`` lines that have not 22 fields are appended there instead of failing the load.

    ``store='daily'`` keeps all plain daily rows, keyed by location and date, and leaves labels,
    balancing and codes to reading (``warehouse``). ``store='encoded'`` appends the balanced, encoded rows
    of the labelled days not loaded so far; see ``EncodedStore``.
    """
    dim = station_dim(read_dim(spark, stations_path, STATION_SCHEMA), read_dim(spark, ids_path, DATA_ID_SCHEMA))
    if rejects_path:
        read = quarantine(READERS[layout](spark, digest_path, bad="keep"))
        if read.rejected:
            write_table(stamped(read.rejects, day), rejects_path)
        fields = read.kept
    else:
        fields = READERS[layout](spark, digest_path)
    daily = daily_observations(fields, dim, label_scope, unknown)
    if store == "daily":
        rows = daily.drop(LABEL).withColumns({"Year": F.year("Date"), "Month": F.month("Date")})
        months = ["Year", "Month"]
        return append_new(rows, table, ["Location", "Date"], day, partition_by=months, prune_by=months)
    if store != "encoded":
        raise ValueError(f"unknown store {store!r}")
    held = EncodedStore(spark, table)
    added = held.load(daily.where(F.col(LABEL).isNotNull()), day, **clean_options)
    if added and mapping_path:
        write_csv(held.mapping(), mapping_path, ["Location_Code"])
    return added


class EncodedStore:
    """Encoded rows of many loads under codes that never change their meaning.

    Beside ``{table}`` lie ``_codes`` (the growing code table), ``_days`` (which days are loaded,
    by location name) and ``_loads`` (the ledger). A load writes new codes, its rows and its days,
    and enters the ledger last. A run that fails on the way has written nothing that anyone sees;
    its days are loaded again. If another writer was faster, the load starts over from what that
    one has left. Medians, fences and class sizes are those of one load.
    """

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.path = spark, table.rstrip("/")
        self.ledger = Ledger(spark, f"{self.path}_loads")
        self.book = CodeBook(spark, f"{self.path}_codes", self.ledger)

    def _read(self, path: str) -> DataFrame:
        return self.ledger.visible(read_table(self.spark, path)).drop(LOAD)

    def rows(self) -> DataFrame:
        """The encoded rows of all complete loads."""
        return self._read(self.path)

    def codes(self) -> DataFrame:
        """column, value, code."""
        return self.book.table()

    def mapping(self) -> DataFrame:
        own = self.codes().where(F.col("column") == "Location")
        return own.select(F.col("value").alias("Location_Name"), F.col("code").alias("Location_Code"))

    def load(self, daily: DataFrame, day: dt.date | None = None, attempts: int = 5, **clean_options) -> bool:
        """Add the days that are not loaded yet; says whether there were any."""
        daily = materialize(daily.hint("rebalance"), "delivery")
        for left in reversed(range(attempts)):
            try:
                return self._load(daily, day, clean_options)
            except Conflict:
                if not left:
                    raise
        return False

    def _load(self, daily: DataFrame, day: dt.date | None, clean_options: dict) -> bool:
        seen, load = self.ledger.begin()
        keys, days = ["Location", "Date"], f"{self.path}_days"
        fresh = daily
        if seen:
            fresh = materialize(drop_existing(daily, self._read(days), keys), "fresh")
        if fresh.isEmpty():
            return False
        encoder = lambda rows, cols, order, by: self.book.encode(rows, cols, order, load, by)
        cleaned = clean(fresh, stage_input=False, encoder=encoder, **clean_options)
        write_load(stamped(cleaned.table, day), self.path, load)
        write_load(fresh.select(*keys), days, load)
        self.ledger.commit(seen, load)
        return True


def warehouse(spark: SparkSession, table: str, label_scope: str = "file") -> DataFrame:
    """The daily table of all days held, labelled by the days that are held now."""
    held = read_table(spark, table).drop(STAMP, "RainToday", LABEL)
    return label_rain(held, label_scope, ("Location", "Year", "Month")).select(*DAILY_COLUMNS)


def training_table(spark: SparkSession, table: str, label_scope: str = "file", **clean_options) -> Cleaned:
    """The whole warehouse of daily rows, labelled, cleaned and encoded for one training run."""
    return clean(materialize(warehouse(spark, table, label_scope), "labelled"), stage_input=False, **clean_options)


def train_and_promote(
    train: DataFrame, test: DataFrame, registry: Registry, min_gain: float = MIN_GAIN, **params
) -> bool:
    """Fit, compare with the production model on the same test rows, log, register, promote.

    A failure is logged as a failed run before it is raised.
    """
    settings = params or FOREST
    try:
        features = features_of(train)
        new = train_forest(train, LABEL, features, **settings)
        models: dict[str, PipelineModel] = {"new": new}
        production = registry.load("production")
        if production is not None:
            models["old"] = production
        measured = materialize(champion_metrics(models, test), "metrics")
        result = compare(measured, "new", "old", min_gain).first()
        own = measured.where(F.col("model") == "new").drop("model").first().asDict()
    except Exception as error:
        registry.log_run(settings | {"error": str(error)}, {}, "FAILED")
        raise
    extra = {"previous_f1": result["previous_score"], "improvement": result["improvement"]}
    run_id = registry.log_run(settings, own | extra)
    registry.log_schema(run_id, schema_report(train, LABEL))
    version = registry.register(new, run_id)
    if result["promote"]:
        registry.promote(version)
    return bool(result["promote"])


def train(
    spark: SparkSession,
    table: str,
    registry: Registry,
    seed: int = 42,
    balance: str | None = "before",
    method: str = "draw",
    **params,
) -> bool:
    """Clean the warehouse, split it and run the promotion contest.

    ``balance='train_only'`` splits first, so that the measured quality is that on plain rows.
    """
    before = "before" if balance == "before" else None
    rows = materialize(training_table(spark, table, balance=before, method=method).table, "training")
    train_rows, test_rows = balanced_split(rows, CLEAN_KEYS, seed, balance, method)
    return train_and_promote(train_rows, test_rows, registry, **params)


def ingest_and_train(spark: SparkSession, registry: Registry, table: str, **paths) -> bool:
    ingest(spark, table=table, **paths)
    return train(spark, table, registry)


def latest_rows(clean_rows: DataFrame, pick: str = "latest") -> DataFrame:
    """One row per location: its latest (or first) day."""
    if pick not in ("latest", "first"):
        raise ValueError(f"unknown pick {pick!r}")
    by = [F.col(c).desc() if pick == "latest" else F.col(c).asc() for c in ("Year", "Month", "Day")]
    rest = [c for c in clean_rows.columns if c not in CLEAN_KEYS]
    return first_per_group(clean_rows, ["Location"], [*by, *rest])


def predict_locations(
    clean_rows: DataFrame,
    model: PipelineModel,
    mapping: DataFrame,
    version: str | None = None,
    pick: str = "latest",
) -> DataFrame:
    """Rain tomorrow for every location in one job."""
    scored = score(model, latest_rows(clean_rows, pick))
    named = mapping.select(F.col("Location_Code").alias("Location"), "Location_Name")
    return lookup_join(scored, named, ["Location"]).select(
        F.col("Location").alias("location_id"),
        "Location_Name",
        "prediction",
        will_rain(F.col("prediction")).alias("will_rain"),
        percent_text(F.col("prediction")).alias("prediction_text"),
        F.lit(version).alias("model_version"),
    )


def predict_registered(
    clean_rows: DataFrame,
    registry: Registry,
    mapping: DataFrame,
    by: str = "production",
    version: str | None = None,
    pick: str = "latest",
) -> DataFrame:
    """Rain tomorrow for every location by a registered version, with what is known of that version.

    ``by`` and ``version`` choose it as ``pick_version`` does; a choice that names no version fails.
    ``model_info`` is its row of the listing: name, version, status, creation date, run and metrics.
    """
    found = registry.pick(by, version)
    if found is None:
        raise LookupError(f"no version of {registry.name} for {by} {version or ''}".rstrip())
    info = registry.info(found["version"])
    metrics = F.struct(*[F.lit(v).cast("double").alias(k) for k, v in info["metrics"].asDict().items()])
    told = [F.lit(info[c]).cast("string").alias(c) for c in ("name", "version", "status", "creation_date", "run_id")]
    scored = predict_locations(clean_rows, PipelineModel.load(found["path"]), mapping, found["version"], pick)
    return scored.withColumn("model_info", F.struct(*told, metrics.alias("metrics")))
