"""Benchmark items inside documents: size-partitioned MinHash containment search, verified exactly."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petrichor.llm.sides import bounded
from petrichor.session import materialize

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case; no words for null or blank texts."""
    trimmed = F.btrim(F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _BLANKS))


def _each(found: str, size: int, made: Callable[[list[Column]], Column], kind: str) -> Column:
    """What ``made`` makes of every run of ``size`` words of the column ``found``. A shorter text is
    one run as a whole, its missing words null; no words give none. The column must be computed
    beforehand: an expression would be evaluated anew for each run."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(found) - size, F.lit(0)))
    runs = F.transform(starts, lambda i: made([F.get(F.col(found), i + k) for k in range(size)]))
    return F.when(F.size(found) > 0, runs).otherwise(F.array().cast(f"array<{kind}>"))


def shingles(found: str, size: int) -> Column:
    return _each(found, size, lambda run: F.concat_ws(" ", *run), "string")


def _hashes(found: str, size: int) -> Column:
    return _each(found, size, lambda run: F.xxhash64(*run), "bigint")


def _runs(made: Callable[[str, int], Column], size: int, shorter: list[int]) -> Column:
    """The runs of ``size`` words and the distinct ones of each shorter length."""
    return F.concat(made("words", size), *[F.array_distinct(made("words", n)) for n in shorter]) if shorter else made("words", size)


def containments(
    docs: DataFrame,
    items: DataFrame,
    size: int = 5,
    threshold: float = 0.8,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """doc_id, item_id, n_item_shingles, n_shared, containment of each pair from ``threshold`` on.

    Items are partitioned by the power of two below their number of distinct shingles. An item's
    sketch is its k smallest shingle hashes (a bottom-k MinHash), where k exceeds the number of
    shingles that any item of its partition may miss at the threshold. A document that holds
    enough of an item therefore holds a shingle of its sketch: the search loses nothing, for short
    items and long documents alike. Documents with fewer shingles than the item needs are left
    out. Candidates are verified on their shingles themselves.

    Both sides are compared on distinct shingles of ``size`` words, A-Z in lower case. An item of
    fewer words is one shingle, looked up among the runs of its own length, each distinct run of a
    document once; no work is done for lengths that no item has. Items without words are in no document. Null ids pair like any
    other id; repeated rows give one pair if any of them holds the item; other columns are not
    read. Empty tables give no pairs.
    """
    missed = round((1 - threshold) * 1_000_000)
    wanted = items.select(F.xxhash64(items[item_id], items[item_text]).alias("item"), items[item_id].alias("item_id"), words(items[item_text]).alias("words"))
    wanted = materialize(wanted, "item_words").where(F.size("words") > 0)
    lengths = wanted.select(F.size("words").alias("length"))
    wanted = wanted.select("item", "item_id", F.array_distinct(shingles("words", size)).alias("shingles"), _hashes("words", size).alias("hashes"))
    wanted = wanted.withColumn("n", F.size("shingles"))
    widest = F.pow(F.lit(2), F.length(F.bin("n"))) - 1
    k = F.floor(widest * missed / 1_000_000).cast("int") + 1
    hashes = F.array_sort(F.array_distinct("hashes"))
    least = F.ceil(F.col("n") * (1_000_000 - missed) / 1_000_000)
    wanted = materialize(wanted.select("item", "item_id", "shingles", "n", least.alias("least"), F.slice(hashes, F.lit(1), k).alias("sketch")), "items")
    keys = bounded(wanted.select("item", "least", F.explode("sketch").alias("key")))
    shorter = [r["length"] for r in lengths.where(F.col("length") < size).distinct().collect()]  # at most size - 1 numbers

    texts = docs.select(docs[doc_id].alias("doc_id"), docs[doc_text].alias("text"))
    held = texts.select(F.xxhash64("doc_id", "text").alias("row"), words(F.col("text")).alias("words"))
    # Repeated shingles of a document may count twice here: this bound only leaves out documents that are too short.
    # The size is taken from the words: from the array of keys it would keep that array beside each of its
    # elements. The outer explode keeps Spark from testing the array first, which would compute it once more.
    n_keys = F.greatest(F.size("words") - size + 1, F.lit(1)).alias("n_keys")
    held = held.select("row", n_keys, _runs(_hashes, size, shorter).alias("keys")).select("row", "n_keys", F.explode_outer("keys").alias("key"))
    pairs = held.join(keys, "key").where(F.col("n_keys") >= F.col("least")).select("row", "item").distinct()
    pairs = materialize(pairs, "candidates")

    rows = bounded(materialize(pairs.select("row").distinct(), "candidate_rows"))
    texts = texts.withColumn("row", F.xxhash64("doc_id", "text")).join(rows, "row", "left_semi").dropDuplicates(["row"])
    owned = texts.select("row", "doc_id", words(F.col("text")).alias("words")).select("row", "doc_id", _runs(shingles, size, shorter).alias("found"))
    shared = F.size(F.array_intersect("shingles", "found"))
    judged = pairs.join(owned, "row").join(wanted.select("item", "item_id", "shingles", "n", "least"), "item").withColumn("n_shared", shared)
    judged = judged.where(F.col("n_shared") >= F.col("least"))
    best = F.max(F.struct((F.col("n_shared") / F.col("n")).alias("containment"), F.col("n").alias("n"), F.col("n_shared").alias("n_shared"))).alias("best")
    return judged.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", F.col("best.n").cast("long").alias("n_item_shingles"), F.col("best.n_shared").cast("long").alias("n_shared"),
        "best.containment",
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` whose id is in no pair, with all their columns."""
    found = containments(docs, items, doc_id=id, **settings).select(F.col("doc_id").alias("_leaky")).distinct()
    found = materialize(found, "leaky")
    return docs.join(bounded(found), docs[id].eqNullSafe(found["_leaky"]), "left_anti")
