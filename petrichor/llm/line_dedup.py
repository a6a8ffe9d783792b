"""Near-duplicate lines by deletion neighbourhoods; the earliest line stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from petrichor.llm.sides import bounded, free_name
from petrichor.session import materialize

BLANKS, _BLANKS = " \t\n\x0b\x0c\r", r"[\x20\x09-\x0D]+"
#: One word of so many is a similarity of 0.8, the least at which lines count as near copies.
LEAST_WORDS = 5
#: Stands for a null id: smaller than all ids.
_NO_ID = -(1 << 63)


def line_words(line: Column) -> Column:
    """The words of a line; one empty word if it has none."""
    return F.split(F.btrim(line, F.lit(BLANKS)), _BLANKS)


def _identified(docs: DataFrame, id: str, text: str) -> DataFrame:
    """doc, part, text: rows of one id with different texts are told apart by part, in the order of a hash of the text."""
    rows = docs.select(
        F.coalesce(docs[id].cast("long"), F.lit(_NO_ID)).alias("doc"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text")
    )
    return rows.withColumn("part", F.xxhash64("text"))


def _lines(rows: DataFrame) -> DataFrame:
    """Every line: doc, part, no, line_text."""
    return rows.select("doc", "part", F.posexplode_outer(F.split("text", "\n", -1)).alias("no", "line_text"))


def removed_lines(docs: DataFrame, least_words: int = LEAST_WORDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, part, no and reason (``copy`` or ``near``) of each line that goes.

    A line goes when an earlier line (smaller id, then earlier in the text) has the same words, or
    differs by one word put in, taken out or exchanged, both of at least ``least_words`` words.
    Lines are judged on the input, so an earlier line counts even if it goes itself.

    Equal lines are collapsed first. Among the distinct lines only those are taken further that
    share one half with another one, as two lines within one edit do. Each then emits a key for
    every word left out. Lines with an equal key at the same place differ by an exchanged word;
    a line whose key equals another whole line has one word more. Each key keeps its earliest line
    only, so a key shared by very many lines makes no pairs among them; whoever differs from its
    key's earliest line is verified against it, word by word.
    """
    lines = _lines(_identified(docs, id, text))
    keyed = lines.where(F.btrim("line_text", F.lit(BLANKS)) != "").select("doc", "part", "no", line_words(F.col("line_text")).alias("words"))
    whole, n = F.array_join("words", " "), F.size("words")
    keyed = keyed.select(
        "doc", "part", "no", F.xxhash64(whole).alias("k1"), F.xxhash64(whole, F.lit(7)).alias("k2"),
        F.when(n >= least_words, F.array(*_halves(F.col("words"), n))).alias("halves"),
    )
    keyed = materialize(keyed, "lines")
    place = F.struct("doc", "part", "no")
    distinct = keyed.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.first("halves").alias("halves"), F.count("*").alias("held"))
    distinct = materialize(distinct.withColumn("line", F.monotonically_increasing_id()), "distinct_lines")
    halves = distinct.where("halves is not null").select("line", F.explode_outer("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("held")).where("held > 1").select("half")
    near = halves.join(bounded(materialize(shared, "halves")), "half", "left_semi").select("line").distinct()
    near = distinct.select("line", "first.*").join(near, "line", "left_semi")

    found = lines.join(bounded(materialize(near, "near")), ["doc", "part", "no"]).dropDuplicates(["line"])
    # Numbered in the order of their first places, so that a smaller number is an earlier line.
    found = found.repartitionByRange("doc", "part", "no").sortWithinPartitions("doc", "part", "no")
    texts = materialize(
        found.select(F.monotonically_increasing_id().alias("row"), F.col("line").alias("of"), line_words(F.col("line_text")).alias("words")), "neighbours"
    )
    losers = texts.select("row", F.col("of").alias("line")).join(_near_losers(texts), "row").select("line", F.lit(True).alias("near"))
    verdict = distinct.select("line", "k1", "k2", "first", "held").join(losers, "line", "left").where("held > 1 or near")
    verdict = bounded(materialize(verdict.select("k1", "k2", "first", "near"), "verdicts"))
    judged = keyed.select("doc", "part", "no", "k1", "k2").join(verdict, ["k1", "k2"])
    reason = F.when(place != F.col("first"), "copy").when(F.col("near"), "near")
    return judged.select("doc", "part", "no", reason.alias("reason")).where("reason is not null")


def _halves(words: Column, n: Column) -> list[Column]:
    """Two lines of m, or of m and m + 1 words, within one edit share the first half of m words or the rest."""
    out = []
    for level in (n, n - 1):
        half = F.floor(level / 2).cast("int")
        out.append(F.xxhash64(F.lit("p"), level, F.slice(words, F.lit(1), half)))
        out.append(F.xxhash64(F.lit("s"), level, F.slice(words, n - (level - half) + 1, level - half)))
    return out


def _near_losers(texts: DataFrame) -> DataFrame:
    """The rows of lines that an earlier line is one edit away from."""
    word = texts.select("row", F.size("words").alias("n"), F.posexplode("words").alias("i", "word"))
    word = word.select("row", "n", "i", F.xxhash64("word", F.col("i")).alias("here"), F.xxhash64("word", F.col("i") - 1).alias("left"))
    line = Window.partitionBy("row")
    upto = line.orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    before, before_left = (F.coalesce(F.bit_xor(c).over(upto), F.lit(0)) for c in ("here", "left"))
    word = word.withColumns({
        "all_here": F.bit_xor("here").over(line), "all_left": F.bit_xor("left").over(line), "before": before, "before_left": before_left,
    })
    exchanged = F.xxhash64(F.lit("x"), "n", "i", F.col("all_here").bitwiseXOR(F.col("here")))
    rest = F.col("all_left").bitwiseXOR(F.col("before_left")).bitwiseXOR(F.col("left"))
    dropped = F.xxhash64(F.lit("d"), F.col("n") - 1, F.col("before").bitwiseXOR(rest))
    itself = F.when(F.col("i") == 0, F.xxhash64(F.lit("d"), F.col("n"), F.col("all_here")))
    keys = [F.struct(k.alias("key"), F.lit(whole).alias("whole")) for k, whole in ((exchanged, False), (dropped, False), (itself, True))]
    variants = word.select("row", F.explode(F.array(*keys)).alias("v")).select("row", "v.key", "v.whole")
    variants = materialize(variants.where("key is not null"), "variants")
    # Lines that lost a word are compared with the one line that is what they have left, and that line
    # with the earliest of them; exchanged words are compared with the earliest line of their key.
    best = variants.groupBy("key").agg(
        F.min("row").alias("earliest"), F.min(F.when(F.col("whole"), F.col("row"))).alias("rest"), F.max("row").alias("latest")
    )
    best = materialize(best.where("earliest < latest").select("key", F.array("earliest", "rest").alias("others")), "keys")
    pairs = variants.join(bounded(best, "others"), "key").select("row", F.explode("others").alias("other"))
    pairs = pairs.where("other < row").distinct()
    mine = texts.select("row", F.col("words").alias("a"))
    theirs = texts.select(F.col("row").alias("other"), F.col("words").alias("b"))
    checked = pairs.join(mine, "row").join(theirs, "other")
    return checked.where(one_edit(F.col("a"), F.col("b"))).select("row").distinct()


def one_edit(a: Column, b: Column) -> Column:
    """True if two arrays of words are equal up to one word put in, taken out or exchanged."""
    n, m = F.size(a), F.size(b)
    common = F.least(n, m)
    differ = F.zip_with(F.slice(a, F.lit(1), common), F.slice(b, F.lit(1), common), lambda x, y: x != y)
    found = F.array_position(differ, True).cast("int")
    at = F.when(found == 0, common + 1).otherwise(found)

    def tail(words: Column, size: Column, start: Column) -> Column:
        return F.slice(words, start, F.greatest(size - start + 1, F.lit(0)))

    return (
        F.when(n == m, tail(a, n, at + 1) == tail(b, m, at + 1))
        .when(n == m + 1, tail(a, n, at + 1) == tail(b, m, at))
        .when(m == n + 1, tail(a, n, at) == tail(b, m, at + 1))
        .otherwise(F.lit(False))
    )


def dedup_lines(
    docs: DataFrame,
    least_words: int = LEAST_WORDS,
    id: str = "doc_id",
    text: str = "text",
    counts: tuple[str, str] = ("n_lines_with_words", "n_lines_removed"),
) -> DataFrame:
    """All rows and columns of ``docs``, its text without the lines that go, and two counts more.

    The first of ``counts`` names the number of lines of the input that have a word, the second that of
    those that went; neither may be a column of ``docs``. Lines
    without a word stay as they are. A null text stays null. Rows of one id with different texts
    are ordered by a hash of their texts; a row listed twice is one document. A null id counts as
    smaller than all others. An empty table gives no rows.
    """
    gone = removed_lines(docs, least_words, id, text).select("doc", "part", "no").distinct()
    doc, part, lost = (free_name(docs, n) for n in ("_doc", "_part", "_gone"))
    gone = gone.groupBy("doc", "part").agg(F.collect_set("no").alias("gone"))
    gone = materialize(gone.select(F.col("doc").alias(doc), F.col("part").alias(part), F.col("gone").alias(lost)), "gone")
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    match = (F.coalesce(docs[id].cast("long"), F.lit(_NO_ID)) == F.col(doc)) & (F.xxhash64(body) == F.col(part))
    joined = docs.join(bounded(gone, lost), match, "left")
    lines = F.split(body, "\n", -1)
    kept = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains(lost, i)), "\n")
    full = F.size(F.filter(lines, lambda line: F.btrim(line, F.lit(BLANKS)) != "")).cast("long")
    columns = [F.when(F.col(lost).isNull(), docs[text]).otherwise(kept).alias(text) if c == text else docs[c] for c in docs.columns]
    removed = F.when(F.col(lost).isNull(), F.lit(0)).otherwise(F.size(lost)).cast("long")
    return joined.select(*columns, full.alias(counts[0]), removed.alias(counts[1]))
