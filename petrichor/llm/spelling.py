"""Spelling variants: words one edit apart, found over a reduced alphabet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petrichor.llm.sides import bounded
from petrichor.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What words are made of once A-Z are in lower case: a-z and U+00C0 to U+00FF.
LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))
#: Letters are told apart by so many symbols; one of ``TYPO_EVERY`` runs of a document loses a letter.
SYMBOLS, TYPO_EVERY = 8, 199


def runs(text: Column, least: int) -> Column:
    """The maximal runs of letters of at least ``least``, with A-Z in lower case."""
    found = F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(f"[A-Za-zÀ-ÿ]{{{least},}}"), F.lit(0))
    # ASCII runs, nearly all, take the short way; lower() would also change capitals beyond A-Z.
    return F.transform(found, lambda w: F.when(F.octet_length(w) == F.length(w), F.lower(w)).otherwise(F.translate(w, UPPER, LOWER)))


def with_typos(id: Column, run: Column) -> Column:
    """The run, or if the checksum of id and run asks for it, the run without one letter."""
    check = F.crc32(F.concat(F.coalesce(id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(check, F.length(run)).cast("int")
    short = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(check % TYPO_EVERY == 0, short).otherwise(run)


def vocabulary(docs: DataFrame, id: str = "doc_id", text: str = "text", least_letters: int = 6, least_count: int = 5) -> DataFrame:
    """word, n: the words of enough letters that occur often enough in all texts. Counted where they are read."""
    # A run only becomes shorter, so shorter runs give no word.
    found = docs.select(docs[id].alias("id"), F.explode(runs(docs[text], least_letters)).alias("run"))
    words = found.select(with_typos(F.col("id"), F.col("run")).alias("word")).where(F.length("word") >= least_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def reduced(word: Column, symbols: int) -> Column:
    """The word with each letter as one of a few symbols, by a hash of the letter."""
    spread = "".join(LETTERS[(ord(c) * 0x9E3779B1 >> 7) % symbols] for c in LETTERS)
    return F.translate(word, LETTERS, spread)


def neighbourhood(word: Column, symbols: int) -> Column:
    """All words over the reduced alphabet within one edit of ``word``, itself included."""
    n = F.length(word)
    letters = F.array(*[F.lit(c) for c in LETTERS[:symbols]])

    def head(i: Column) -> Column:
        return F.substring(word, F.lit(1), i)

    def tail(i: Column) -> Column:
        return F.substring(word, i + 1, n)

    taken = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(head(i), tail(i + 1)))
    changed = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.transform(letters, lambda c: F.concat(head(i), c, tail(i + 1))))
    added = F.transform(F.sequence(F.lit(0), n), lambda i: F.transform(letters, lambda c: F.concat(head(i), c, tail(i))))
    return F.array_distinct(F.concat(F.array(word), taken, F.flatten(changed), F.flatten(added)))


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """a, b: each ordered pair of different words exactly one inserted, deleted or replaced letter apart.

    An edit of a word is at most one edit of its reduced word, so every reduced word of the
    vocabulary emits its whole neighbourhood, and those of it that are reduced words of the
    vocabulary too lead to candidates, which the original words then confirm or not. A pair of
    reduced words is followed from its smaller one only.
    """
    # A reduced word travels as its hash; two of one hash only make candidates that are not confirmed.
    named = words.select("word", reduced(F.col("word"), symbols).alias("reduced"))
    named = materialize(named.withColumn("r", F.xxhash64("reduced")), "reduced")
    kinds = materialize(named.select("r", "reduced").distinct(), "kinds")
    words = named.select("word", "r")
    around = F.transform(neighbourhood(F.col("reduced"), symbols), lambda k: F.xxhash64(k))
    around = kinds.select("r", F.explode(around).alias("s")).where("r <= s")
    pairs = materialize(around.join(bounded(kinds.select(F.col("r").alias("s")).distinct()), "s", "left_semi").distinct(), "kind_pairs")
    mine, theirs = words.select("r", F.col("word").alias("a")), words.select(F.col("r").alias("s"), F.col("word").alias("b"))
    both = pairs.join(bounded(mine), "r").join(bounded(theirs), "s")
    # Of one reduced word, each pair is met twice.
    both = both.where("r != s or a < b").where(F.levenshtein("a", "b", 1) == 1)
    return both.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p")).select("p.*")


def _roots(links: DataFrame) -> DataFrame:
    """word, root: the last of each word's forms. A form occurs several times as often as its word,
    so chains are short and end; each round doubles the length that is followed."""
    found = materialize(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if found.join(bounded(further), "root", "left_semi").isEmpty():
            return found
        found = found.join(bounded(further), "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        found = materialize(found, "roots")


def spelling_forms(
    docs: DataFrame, id: str = "doc_id", text: str = "text", least_letters: int = 6, least_count: int = 5, factor: int = 5, symbols: int = SYMBOLS
) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary.

    ``form`` is the near word that occurs most often (ties: the smaller one), if it occurs at least
    ``factor`` times as often as the word; ``root`` is the end of the chain of forms, the word
    itself if it has none. ``n_near`` counts its near words.

    Null and empty texts have no words, a null id counts as an empty one, a row listed twice counts
    twice, and an empty table gives no rows. Other columns are not read. A word of m letters has at most about 180 m
    near words, so no group below is longer than that.
    """
    words = materialize(vocabulary(docs, id, text, least_letters, least_count), "vocabulary")
    near = near_words(words, symbols)
    counted = near.join(bounded(words.withColumnRenamed("word", "b")), "b")
    best = counted.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("m"), "b")).alias("top"))
    best = best.select("word", "n_near", F.col("top.b").alias("form"), (-F.col("top.m")).alias("form_n"))
    found = words.join(best, "word", "left")
    enough = F.col("form_n") >= factor * F.col("n")
    found = found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"),
    )
    found = materialize(found, "forms")
    roots = _roots(found.where("form is not null"))
    out = found.join(bounded(roots), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
