"""Digest files as a stream into an observation log.

The log is append-only: each micro-batch owns one folder and rewrites it when it is replayed,
so a restart neither loses nor doubles rows. A refreshed bulletin arrives under a new file name
and its rows supersede the older ones on reading. A late day changes the label of the day before
it, so labels are computed on reading, or kept in a table whose touched months each run renews.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from petrichor.operators.joins import touched_partitions
from petrichor.operators.windows import first_per_group
from petrichor.plans.daily import label_rain, located, typed
from petrichor.schemas import DAILY_COLUMNS, DIGEST_SCHEMA
from petrichor.session import materialize
from petrichor.sources.bulletins import WHOLE_LINES, issue_of, name_parts, newest_first, parse_digest
from petrichor.sources.tables import path_absent


#: Tasks that list the files of a batch, for each core.
LISTERS = 4
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def _list_in_few_tasks(spark: SparkSession) -> None:
    """Each batch lists its files; by default every file is a task that reports to the driver."""
    few = LISTERS * spark.sparkContext.defaultParallelism
    if int(spark.conf.get(_LISTING)) > few:
        spark.conf.set(_LISTING, few)


def digest_stream(spark: SparkSession, path: str, files_per_batch: int = 10_000) -> DataFrame:
    """New digest files ``{data_id}.{period}[.stamp].csv`` as they arrive.

    A line that has not 22 fields fails the query until its file is mended.
    """
    _list_in_few_tasks(spark)
    files = (
        spark.readStream.schema(DIGEST_SCHEMA)
        .options(**WHOLE_LINES)
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(path)
    )
    name = F.col("_metadata.file_name")
    return files.select(
        "*",
        *name_parts(name),
        issue_of(name).alias("issue"),
        F.col("_metadata.file_modification_time").alias("arrived"),
    )


def digest_folder_stream(spark: SparkSession, path: str) -> DataFrame:
    """New files in the folders of ``write_digest`` as they arrive; many stations share a file."""
    _list_in_few_tasks(spark)
    return parse_digest(spark.readStream.schema("data_id string, line string, period string").parquet(path))


def write_log(stream: DataFrame, log: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived and stop; run it again for the next delivery."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = typed(batch).withColumn("batch_id", F.lit(batch_id))
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(log)
        )

    return (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def newest_rows(rows: DataFrame) -> DataFrame:
    """The newest row of each station and day.

    A refreshed bulletin carries a stamp in its name; the later stamp counts, then the later file,
    then the later batch. So a bulletin and its refresh may arrive together, and all days of a
    bulletin come from one file.
    """
    ages = [c for c in ("issue", "arrived", "batch_id") if c in rows.columns]
    measures = [c for c in rows.columns if c not in ("data_id", "period", "Date", *ages)]
    order = [o for c in ages for o in (newest_first(c) if c == "issue" else [F.desc(c)])]
    return first_per_group(rows, ["data_id", "period", "Date"], [*order, *measures]).drop(*ages)


def current_observations(spark: SparkSession, log: str) -> DataFrame:
    return newest_rows(spark.read.parquet(log))


def labelled_observations(
    spark: SparkSession, log: str, dim: DataFrame, label_scope: str = "file", unknown: str = "error"
) -> DataFrame:
    """The daily table as of now."""
    rows = located(current_observations(spark, log), dim, unknown)
    return label_rain(rows, label_scope).select(*DAILY_COLUMNS)


#: Groups of stations that a month of the labelled table is parted into.
BUCKETS = 16
_PARTS = ["period", "bucket"]


def _months_around(parts: DataFrame, *shifts: int) -> DataFrame:
    """The given (period, bucket) and those some months before or after."""
    month = F.add_months(F.to_date("period", "yyyyMM"), F.col("shift"))
    shifted = parts.withColumn("shift", F.explode(F.array(*map(F.lit, shifts))))
    return shifted.select(F.date_format(month, "yyyyMM").alias("period"), "bucket").distinct()


def write_labelled(
    stream: DataFrame,
    log: str,
    table: str,
    checkpoint: str,
    dim: DataFrame,
    label_scope: str = "file",
    unknown: str = "error",
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Bring a labelled daily table up to date with what has arrived; the query that is returned has ended.

    The log and the table are partitioned by month and group of stations. Each batch is logged. In the
    end the parts that batches since the last renewal have rows in are read back from the log, labelled anew and put in place of
    the old ones, once, however many batches have touched them, so a late day changes the label of the day before it, also if that came in an
    earlier batch. With ``label_scope='location'`` the month before is labelled anew too, and the
    month after is looked at. All other parts stay as they are. A batch that is replayed ends the same.
    If a batch fails, those before it are still renewed; a renewal that fails is made up for by the next run.
    """
    if label_scope not in ("file", "location"):
        raise ValueError(f"unknown label scope {label_scope!r}")
    shifts = {"file": ((0,), (0,)), "location": ((-1, 0), (-1, 0, 1))}[label_scope]

    spark, bucket = stream.sparkSession, F.pmod(F.xxhash64("data_id"), F.lit(buckets))

    def logged_as(batch: DataFrame, batch_id: int) -> DataFrame:
        return typed(batch).withColumns({"bucket": bucket, "batch_id": F.lit(batch_id)})

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # A part stands in few files, however many tasks have read its bulletins.
        dynamic = logged_as(batch, batch_id).repartition(*_PARTS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        dynamic.partitionBy(*_PARTS, "batch_id").parquet(log)

    def renew() -> None:
        if path_absent(spark, log, "parquet"):
            return
        logged = spark.read.schema(logged_as(stream, 0).schema).parquet(log)
        done = f"{checkpoint.rstrip('/')}/renewed"
        before = -1 if path_absent(spark, done, "parquet") else spark.read.parquet(done).agg(F.max("batch_id")).first()[0]
        # Partition columns alone: at most as many rows as there are batches, months and groups of stations.
        touched = materialize(logged.where(F.col("batch_id") > before).select(*_PARTS, "batch_id").distinct(), "touched")
        last = touched.agg(F.max("batch_id")).first()[0]
        if last is None:
            return
        parts = touched.select(*_PARTS).distinct()
        renewed, seen = (materialize(_months_around(parts, *s), "months") for s in shifts)
        held = newest_rows(touched_partitions(logged, seen, _PARTS))
        labelled = touched_partitions(label_rain(located(held, dim, unknown), label_scope), renewed, _PARTS)
        # A month stands in few files, however many tasks have labelled it.
        out = labelled.select(*DAILY_COLUMNS, *_PARTS).repartition(*_PARTS)
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*_PARTS).parquet(table)
        spark.createDataFrame([(last,)], "batch_id long").coalesce(1).write.mode("append").parquet(done)

    query = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    finally:
        renew()
    return query
