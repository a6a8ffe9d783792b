"""Exact copies by a 128-bit content hash, confirmed byte by byte; native."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petrichor.llm.sides import bounded, free_name
from petrichor.session import materialize

#: Rows of a group from which its bytes are compared in several tasks first.
SALTED_ROWS = 5000


def normalised(text: Column) -> Column:
    """The text with each run of the ASCII blanks 0x20 and 0x09 to 0x0D as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _content_hash(sha256: Column, bits: int) -> Column:
    """The first ``bits`` of the digest. Fewer than 128 are for tests, which need collisions."""
    return F.unhex(F.substring(sha256, 1, bits // 4))


def _bodies(docs: DataFrame, id: str, text: str, bits: int) -> DataFrame:
    rows = docs.select(docs[id].cast("long").alias("doc_id"), normalised(docs[text]).alias("body"))
    rows = rows.withColumn("sha", F.sha2(F.col("body").cast("binary"), 256))
    return rows.withColumn("hash", _content_hash(F.col("sha"), bits))


def _collisions(bodies: DataFrame, shared: DataFrame) -> DataFrame:
    """hash: those of ``shared`` (hash, held) under which texts differ.

    Equal bytes collapse where they are read, before any shuffle. What a group of very many rows
    leaves in each task is compared in several tasks first, so that no reducer gets a text from all of them.
    """
    salts = F.ceil(F.col("held") / SALTED_ROWS).cast("long")
    found = bodies.join(bounded(shared), "hash").select("hash", F.pmod(F.spark_partition_id().cast("long"), salts).alias("salt"), "body")
    texts = found.distinct().select("hash", "body").distinct()
    return texts.groupBy("hash").count().where("count > 1").select("hash")


def _earliest() -> Column:
    """The least id, then the least row; a null id comes last."""
    return F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", bits: int = 128) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.

    Texts are equal if they are the same bytes after ``normalised``; of equal ones the row with
    the smallest id stays, and ``keep_id`` names it. One scan hashes every text; ids are grouped by
    hash, aggregated before the shuffle, so a group of a third of all rows is a row for each task. A
    second scan compares the bytes of the groups of two and more. A hash under which texts
    differ is split by the texts themselves.

    Null texts are empty, and empty texts are equal. A row listed twice is two rows, of which one
    stays. Rows without an id come after all others; ``keep_id`` is null if no row of a group has an id.
    An empty table gives no rows. Other columns are not read.
    """
    bodies = _bodies(docs, id, text, bits)
    keys = materialize(bodies.select(F.monotonically_increasing_id().alias("row"), "doc_id", "hash", "sha"), "hashes")
    groups = keys.groupBy("hash").agg(F.count("*").alias("held"), _earliest().alias("first"))
    shared = materialize(groups.where("held > 1"), "shared")
    collided = materialize(_collisions(bodies, shared.select("hash", "held")), "collided")
    out = keys.join(bounded(shared), "hash", "left")
    if collided.isEmpty():
        return _verdicts(out)
    plain = _verdicts(out.join(bounded(collided), "hash", "left_anti"))
    # Numbered anew: a row's number of the first scan need not be that of the next.
    odd = bodies.join(bounded(collided), "hash", "left_semi").withColumn("row", F.monotonically_increasing_id())
    odd = materialize(odd, "odd")
    firsts = odd.groupBy("body").agg(F.count("*").alias("held"), _earliest().alias("first"))
    return plain.unionByName(_verdicts(odd.join(firsts, "body")))


def _verdicts(rows: DataFrame) -> DataFrame:
    alone = F.col("first").isNull()
    return rows.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("held", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("first.row") == F.col("row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", bits: int = 128) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    If ids are missing or occur twice, the rows are numbered and the smallest number stays.
    """
    ids = docs.groupBy(id).count()
    if not ids.where((F.col("count") > 1) | F.col(id).isNull()).isEmpty():
        row = free_name(docs, "_row")
        return drop_copies(materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row, text, bits).drop(row)
    gone = exact_groups(docs, id, text, bits).where("not kept").select(F.col("doc_id").alias(id))
    return docs.join(bounded(materialize(gone, "gone")), id, "left_anti").select(*docs.columns)
