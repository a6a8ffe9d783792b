"""Numbers that only one writer gets, and loads that only count once they are complete.

A table that is written in several steps carries a load id in every row. The id enters the ledger
in one atomic step at the end, and readers see the rows of entered loads alone: what a failed run
has left behind stays invisible, and its days are loaded again.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from petrichor.operators.joins import is_small
from petrichor.sources.tables import path_absent

#: The column that names the load of a row.
LOAD = "load"


class Conflict(RuntimeError):
    """Another writer was faster; what was read before is out of date."""


def create_exclusive(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file that must not exist yet; False if it does, whoever made it."""
    place = urlparse(path)
    if place.scheme in ("", "file"):
        os.makedirs(os.path.dirname(place.path), exist_ok=True)
        try:
            made = os.open(place.path, os.O_CREAT | os.O_EXCL | os.O_WRONLY, 0o644)
        except FileExistsError:
            return False
        with os.fdopen(made, "w", encoding="utf-8") as file:
            file.write(text)
        return True
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    return True


def next_number(spark: SparkSession, folder: str, last: int, text: str = "") -> int:
    """The first number after ``last`` that nobody has; it is the caller's from now on."""
    while not create_exclusive(spark, f"{folder.rstrip('/')}/{last + 1:012d}", text):
        last += 1
    return last + 1


def write_load(rows: DataFrame, table: str, load: str) -> None:
    """The rows of one load as a partition of the table; no two writers share a folder."""
    rows.write.parquet(f"{table.rstrip('/')}/{LOAD}={load}")


class Ledger:
    """The loads that are complete, one small file each, below one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def loads(self) -> DataFrame:
        """number, load: one row per complete load. A file without an id was left by a crash."""
        if path_absent(self.spark, self.folder, "text"):
            return self.spark.createDataFrame([], f"number long, {LOAD} string")
        rows = self.spark.read.text(self.folder)
        number = F.element_at(F.split("_metadata.file_name", "[.]"), 1).cast("long")
        return rows.where(F.col("value") != "").select(number.alias("number"), F.col("value").alias(LOAD))

    def begin(self) -> tuple[int, str]:
        """The number of the last load seen, and an id for the next one."""
        last = self.loads().agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
        return last, f"L{uuid.uuid4().hex}"

    def commit(self, seen: int, load: str) -> int:
        """Make the load ``load`` visible, unless another one became visible since ``seen``."""
        number = seen + 1
        if not create_exclusive(self.spark, f"{self.folder}/{number:012d}", load):
            raise Conflict(f"load {number} was entered by another writer")
        return number

    def visible(self, rows: DataFrame) -> DataFrame:
        """The rows of complete loads; a table partitioned by load is read in these parts only."""
        loads = self.loads().select(LOAD)
        side = F.broadcast(loads) if is_small(loads) else loads
        return rows.join(side, LOAD, "left_semi")
