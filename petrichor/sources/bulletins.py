"""Station bulletins: raw text, digests and their file names."""

from __future__ import annotations

import datetime as dt
import fnmatch
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from petrichor.functions.dates import period, recent_months
from petrichor.functions.text import (
    cp1252_text,
    file_name,
    from_template,
    is_data_line,
    text_between,
    unix_text,
)
from petrichor.operators.joins import is_small, lookup_join
from petrichor.operators.windows import first_per_group
from petrichor.schemas import (
    BULLETIN_URL,
    DIGEST_FIELDS,
    DIGEST_SCHEMA,
    ID_PAGE_END,
    ID_PAGE_START,
    MONTHS_BACK,
    text_schema,
)
from petrichor.session import materialize, scratch_path

#: CSV options under which a line of the wrong number of fields is an error; a reader that prunes columns counts none.
WHOLE_LINES = {"mode": "FAILFAST", "columnPruning": "false"}
#: Where such a line is kept as it is, and the options for that.
CORRUPT = "_corrupt"
KEPT_LINES = {"mode": "PERMISSIVE", "columnPruning": "false", "columnNameOfCorruptRecord": CORRUPT}
#: Most rows of a file that ``write_digest`` writes.
FILE_ROWS = 5_000_000
#: Files that a task tells of at once, that a task opens, and the bytes that it reads and hands on at once.
LISTED, FILES_READ, BYTES_READ, BYTES_HELD = 10_000, 1000, 128 << 20, 8 << 20


def _line_options(bad: str) -> dict[str, str]:
    if bad not in ("error", "keep"):
        raise ValueError(f"unknown treatment of malformed lines {bad!r}")
    return WHOLE_LINES if bad == "error" else KEPT_LINES


def name_parts(name: Column) -> list[Column]:
    """data_id and period out of ``{data_id}.{period}.csv``."""
    return [F.split_part(name, F.lit("."), F.lit(i)).alias(n) for i, n in ((1, "data_id"), (2, "period"))]


def issue_of(name: Column) -> Column:
    """The stamp of a refresh, ``{data_id}.{period}.{stamp}.csv``; '' for a first issue."""
    third = F.split_part(name, F.lit("."), F.lit(3))
    return F.when(third == "csv", "").otherwise(third)


def newest_first(issue: str) -> list[Column]:
    """Order by stamp, the newest first; a longer stamp is newer, so refresh10 comes before refresh9."""
    return [F.desc(F.length(issue)), F.desc(issue)]


def _store(spark: SparkSession, path: str) -> tuple[str, list[str]] | None:
    """The store that ``path`` (which may hold wildcards) lies in, and its files and folders there.

    None if it is one that only Spark's readers can open, or if there is nothing, which they report.
    """
    from pyarrow import fs

    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    if not found:
        return None
    places = [x.getPath().toUri() for x in found]
    store = f"{places[0].getScheme()}://{places[0].getAuthority() or ''}/"
    try:
        root = fs.FileSystem.from_uri(store)[1].rstrip("/")
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None
    return store, [root + x.getPath() for x in places]


def _listed(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """file_name, place, modificationTime, length of the files of these names at ``path``, with data in them.

    A folder is listed by a task and not by the driver, which would hold all files for each scan;
    below it lie the folders of its partitions. Names that open with a dot or an underscore are
    left out, as Spark's readers do. ``place`` is where the file lies in its store.
    """
    from_store = _store(spark, path)
    if from_store is None:
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
        name = F.element_at(F.split("path", "/"), -1)
        return files.select(name.alias("file_name"), F.col("path").alias("place"), "modificationTime", "length")
    store, places = from_store

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files = fs.FileSystem.from_uri(store)[0]
        left = [x for batch in batches for x in batch.column(0).to_pylist()]
        while left:
            one = files.get_file_info(left.pop())
            held = files.get_file_info(fs.FileSelector(one.path)) if one.type == fs.FileType.Directory else [one]
            left += [x.path for x in held if x.type == fs.FileType.Directory and "=" in x.base_name and x.base_name[0] != "."]
            held = [x for x in held if x.type == fs.FileType.File and x.size and fnmatch.fnmatchcase(x.base_name, pattern)]
            held = [x for x in held if x.base_name[0] != "." and (x.base_name[0] != "_" or "=" in x.base_name)]
            for at in range(0, len(held), LISTED):
                part = held[at : at + LISTED]
                times = pa.array([(x.mtime_ns or 0) // 1_000_000 * 1000 for x in part], pa.int64()).cast(pa.timestamp("us", "UTC"))
                columns = [[x.base_name for x in part], [x.path for x in part], times, [x.size for x in part]]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["file_name", "place", "modificationTime", "length"])

    roots = spark.createDataFrame([(x,) for x in places], "place string").repartition(min(len(places), 1000))
    return materialize(roots.mapInArrow(found, "file_name string, place string, modificationTime timestamp, length long"), "listed")


def _newest(listed: DataFrame) -> DataFrame:
    files = listed.select("file_name", "modificationTime", *name_parts(F.col("file_name")), issue_of(F.col("file_name")).alias("issue"))
    order = [*newest_first("issue"), F.desc("modificationTime"), "file_name"]
    return first_per_group(files, ["data_id", "period"], order).select("file_name")


def newest_files(spark: SparkSession, path: str) -> DataFrame:
    """file_name: of each station and month the newest file below ``path``. Files are listed, not read."""
    return _newest(_listed(spark, path))


def _of_newest(rows: DataFrame, newest: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(newest) if is_small(newest) else newest, "file_name", "left_semi")


def _contents(spark: SparkSession, path: str, listed: DataFrame) -> DataFrame:
    """(file_name, content) of listed files; each task opens a bounded number of them."""
    store = _store(spark, path)
    if store is None:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
        return files.select("path", "content").join(listed.select("file_name", F.col("place").alias("path")), "path").drop("path")
    n, size = listed.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    tasks = max(min(n, spark.sparkContext.defaultParallelism), -(-n // FILES_READ), -(-size // BYTES_READ), 1)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files = fs.FileSystem.from_uri(store[0])[0]
        names, contents, held = [], [], 0
        for batch in batches:
            for name, place in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with files.open_input_stream(place) as source:
                    contents.append(source.read())
                names.append(name)
                held += len(contents[-1])
                if held >= BYTES_HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contents, pa.binary())], ["file_name", "content"])
                    names, contents, held = [], [], 0
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contents, pa.binary())], ["file_name", "content"])

    return listed.select("file_name", "place").repartition(tasks, "place").mapInArrow(read, "file_name string, content binary")


def read_bulletins(spark: SparkSession, path: str, newest: bool = False) -> DataFrame:
    """Raw Windows-1252 bulletins as (file_name, content); content is decoded text.

    Bulletins are a few kilobytes each, one per station and month, so a file is one row. With
    ``newest`` only the newest issue of each station and month is opened.
    """
    listed = _listed(spark, path)
    if newest:
        listed = _of_newest(listed, _newest(listed))
    return _contents(spark, path, listed).select("file_name", cp1252_text(F.col("content")).alias("content"))


def write_files(files: DataFrame, path: str) -> int:
    """Each row (file_name, content as bytes) as one file below ``path``; returns how many.

    The tasks write side by side, and a repeated task writes the same file again.
    """

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path)
        store.create_dir(root, recursive=True)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_output_stream(f"{root}/{name}") as out:
                    out.write(content)
            yield batch.select([0])

    return files.select("file_name", "content").mapInArrow(write, "file_name string").count()


def digest(bulletins: DataFrame, content: str = "content") -> DataFrame:
    """Data lines of each bulletin as (..., line_no, line); the text column is replaced.

    Empty lines and lines opening with a quote go; so does the first line opening with a comma,
    the header. Later comma lines are data. ``line_no`` grows with the place in the file.
    """
    rest = [c for c in bulletins.columns if c != content]
    # The header is cut out of the text before it is split; plain string search, no shuffle.
    text = bulletins.select(*rest, F.concat(F.lit("\n"), unix_text(F.col(content))).alias("_text"))
    found = text.withColumn("_start", F.instr("_text", "\n,"))
    ends = found.withColumn("_end", F.expr("locate('\\n', _text, _start + 1)"))
    before = F.expr("substring(_text, 1, _start - 1)")
    after = F.when(F.col("_end") > 0, F.expr("substring(_text, _end)")).otherwise("")
    body = F.when(F.col("_start") == 0, F.col("_text")).otherwise(F.concat(before, after))
    lines = ends.select(*rest, F.posexplode(F.split(body, "\n")).alias("line_no", "line"))
    return lines.where(is_data_line(F.col("line")))


def digest_lines(lines: DataFrame, file: str, line_no: str, line: str) -> DataFrame:
    """The same filter for bulletins that were read line by line.

    The header is the lowest-numbered comma line of its file: one aggregated row per file.
    """
    kept = lines.where(is_data_line(F.col(line)))
    headers = (
        kept.where(F.col(line).startswith(",")).groupBy(file).agg(F.min(line_no).alias("_header"))
    )
    flagged = lookup_join(kept, headers, [file])
    return flagged.where(F.col("_header").isNull() | (F.col(line_no) != F.col("_header"))).drop("_header")


def parse_digest(lines: DataFrame, line: str = "line", bad: str = "error") -> DataFrame:
    """Split digest lines into the 22 text fields; a single blank stays a value.

    A line with fewer or more fields fails the job, or with ``bad='keep'`` is kept whole in
    column ``_corrupt``, which is null for all others.
    """
    options = {k: v for k, v in _line_options(bad).items() if k != "columnPruning"}
    names = DIGEST_FIELDS if bad == "error" else [*DIGEST_FIELDS, CORRUPT]
    rest = [c for c in lines.columns if c != line]
    fields = F.from_csv(F.col(line), ", ".join(f"`{n}` string" for n in names), options)
    return lines.withColumn("_f", fields).select(*rest, "_f.*")


@dataclass(frozen=True)
class Quarantined:
    """Whole lines and rejected ones (data_id, period, line), and how many of each there are."""

    kept: DataFrame
    rejects: DataFrame
    n_kept: int
    rejected: int


def quarantine(fields: DataFrame) -> Quarantined:
    """Part rows that were read with ``bad='keep'``, and count both sides, in one pass over the source."""
    spark, path, counts = fields.sparkSession, scratch_path(fields.sparkSession, "quarantine"), Observation()
    marked = fields.withColumn("rejected", F.col(CORRUPT).isNotNull())
    told = marked.observe(counts, F.count_if(~F.col("rejected")).alias("kept"), F.count_if("rejected").alias("rejected"))
    told.write.partitionBy("rejected").parquet(path)
    found = spark.read.schema(marked.schema).parquet(path)
    names = [c for c in ("file_name", "data_id", "period") if c in fields.columns]
    return Quarantined(
        found.where(~F.col("rejected")).drop(CORRUPT, "rejected"),
        found.where("rejected").select(*names, F.col(CORRUPT).alias("line")),
        counts.get["kept"],
        counts.get["rejected"],
    )


def write_digest(lines: DataFrame, path: str, mode: str = "overwrite", file_rows: int = FILE_ROWS) -> None:
    """Digest lines as Parquet by month, clustered by station, so that files grow with the rows and
    not with the number of stations. ``line_no`` keeps the order of a station's lines."""
    named = lines.select(*name_parts(F.col("file_name")), "line_no", "line")
    ordered = named.repartitionByRange("period", "data_id").sortWithinPartitions("period", "data_id", "line_no")
    ordered.write.partitionBy("period").option("maxRecordsPerFile", file_rows).mode(mode).parquet(path)


def read_digest(spark: SparkSession, path: str, bad: str = "error") -> DataFrame:
    """All digest files below ``path`` as (22 text fields, data_id, period).

    Station and period come from the file name; of several issues of a month the newest is read.
    A line that has not 22 fields fails the job, or is kept in ``_corrupt``.
    """
    schema = DIGEST_SCHEMA if bad == "error" else text_schema([*DIGEST_FIELDS, CORRUPT])
    files = spark.read.schema(schema).options(**_line_options(bad)).option("pathGlobFilter", "*.csv").csv(path)
    named = files.select("*", F.col("_metadata.file_name").alias("file_name"))
    return _of_newest(named, newest_files(spark, path)).select(*schema.names, *name_parts(F.col("file_name")))


def read_digest_folders(spark: SparkSession, path: str, bad: str = "error") -> DataFrame:
    """The layout of ``write_digest``: the period is a partition column."""
    lines = spark.read.schema("data_id string, line string, period string").parquet(path)
    return parse_digest(lines, bad=bad)


def read_raw(spark: SparkSession, path: str, bad: str = "error") -> DataFrame:
    """Raw bulletins below ``path`` as the rows of ``read_digest``, with nothing written between."""
    fields = parse_digest(digest(read_bulletins(spark, path, newest=True)), bad=bad)
    kept = [c for c in fields.columns if c in (*DIGEST_FIELDS, CORRUPT)]
    return fields.select(*kept, *name_parts(F.col("file_name")))


#: What a folder of bulletins may hold: raw files, digest files, or the folders of ``write_digest``.
READERS = {"raw": read_raw, "digest": read_digest, "folders": read_digest_folders}


def data_id_of_page(page: Column) -> Column:
    """The data id named in a station's redirect page, '' if there is none."""
    return text_between(page, ID_PAGE_START, ID_PAGE_END)


def collection_plan(
    stations: DataFrame, as_of: dt.date | Column, months: int = MONTHS_BACK
) -> DataFrame:
    """Every station (data_id) with each of the last months: what there is to collect.

    The months are a constant array exploded beside each station, so nothing is joined.
    """
    month = F.explode(recent_months(as_of, months)).alias("month")
    day = as_of if isinstance(as_of, Column) else F.lit(as_of)
    rows = stations.select("*", month)
    return rows.select(
        *stations.columns,
        period(F.col("month")).alias("period"),
        (F.col("month") == F.trunc(day, "month")).alias("refresh"),
    ).select(
        "*",
        file_name(F.col("data_id"), F.col("period")).alias("file_name"),
        from_template(BULLETIN_URL, F.col("data_id"), F.col("period")).alias("url"),
    )
