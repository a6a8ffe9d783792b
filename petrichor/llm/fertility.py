"""Quality rules on the fertility of a public tokeniser, with bands per language and script."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from petrichor.llm.arrow import gather, gram_hashes, mixed, owners, slices, split_words, sums
from petrichor.llm.sides import bounded
from petrichor.session import materialize

#: Characters that count as symbols, and the window of words that may not repeat (fixed values).
SYMBOLS, REPEAT_WINDOW = "[#*$%&|<>]", 8
#: The scripts that are told apart, as RE2 classes; the rest is "other".
SCRIPTS = {
    "latin": r"\p{Latin}", "cyrillic": r"\p{Cyrillic}", "greek": r"\p{Greek}", "arabic": r"\p{Arabic}",
    "hebrew": r"\p{Hebrew}", "devanagari": r"\p{Devanagari}", "han": r"\p{Han}", "kana": r"[\p{Hiragana}\p{Katakana}]",
    "hangul": r"\p{Hangul}", "thai": r"\p{Thai}",
}
#: The least distance of a band's ends from the middle half of its group, by measure.
SLACK = {"chars_per_token": 0.05, "byte_share": 0.02, "token_evenness": 0.02}
MEASURES = tuple(SLACK)
CACHED_WORDS = 300_000
#: What a rank vocabulary cuts words into before it merges bytes.
PIECES = r"\p{L}+|\p{N}+|[^\p{L}\p{N}]+"
_SCHEMA = (
    "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_tokens long, n_byte_tokens long, token_entropy double, script string"
)


class Encoder:
    """Token ids of words; a bounded number of words is remembered."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self._model.get_piece_size()
        self.is_byte = np.array([self._model.is_byte(i) for i in range(self.size)])
        self._held: dict[str, np.ndarray] = {}

    def __call__(self, words: list[str]) -> list[np.ndarray]:
        new = [w for w in words if w not in self._held]
        if len(self._held) + len(new) > CACHED_WORDS:
            self._held.clear()
            new = words
        for low in range(0, len(new), 10_000):
            part = new[low : low + 10_000]
            for word, ids in zip(part, self._model.encode(part, num_threads=1)):
                self._held[word] = np.array(ids, np.int32)
        return [self._held[w] for w in words]


class Ranks:
    """Tokens of words by a vocabulary of byte ranks."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._model = tiktoken.Encoding("ranks", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self._held: dict[str, int] = {}

    def __call__(self, words: list[str]) -> np.ndarray:
        if len(self._held) > CACHED_WORDS:
            self._held.clear()
        for word in words:
            if word not in self._held:
                self._held[word] = len(self._model.encode_ordinary(" " + word))
        return np.array([self._held[w] for w in words], np.int64)


def repeated_words(codes: np.ndarray, offsets: np.ndarray, window: int = REPEAT_WINDOW) -> np.ndarray:
    """Words of each text that lie in a window of words found twice or more in the text."""
    n, doc = len(codes), owners(offsets)
    if n < window:
        return np.zeros(len(offsets) - 1, np.int64)
    grams = mixed(gram_hashes(mixed(codes), window) ^ mixed(doc[: n - window + 1] + 1))
    starts = np.flatnonzero(doc[: n - window + 1] == doc[window - 1 :])
    order = np.argsort(grams[starts], kind="stable")
    found = grams[starts][order]
    same = np.zeros(len(found), bool)
    same[1:] = found[1:] == found[:-1]
    same[:-1] |= same[1:]
    hits = starts[order[same]]
    steps = np.bincount(hits, minlength=n + 1) - np.bincount(hits + window, minlength=n + 1)[: n + 1]
    return sums(np.cumsum(steps)[:n] > 0, offsets)


def repeated_lines(texts: pa.Array) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    lists = pc.split_pattern(texts, "\n")
    flat = lists.flatten()
    bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    full = pc.binary_length(pc.ascii_trim_whitespace(flat)).to_numpy(zero_copy_only=False) > 0
    codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    doc = owners(bounds)
    pairs = np.unique((doc * (len(flat) + 1) + codes)[full])
    return sums(full, bounds) - np.bincount(pairs // (len(flat) + 1), minlength=len(texts))


def token_measures(ids: list[np.ndarray], codes: np.ndarray, offsets: np.ndarray, encoder: Encoder) -> tuple[np.ndarray, ...]:
    """Tokens, byte tokens and the entropy (bits) of the tokens of each text."""
    sizes = np.array([len(x) for x in ids], np.int64)
    joined = np.concatenate(ids) if ids else np.empty(0, np.int32)
    loose = np.array([int(encoder.is_byte[x].sum()) for x in ids], np.int64)
    starts = np.cumsum(sizes) - sizes
    lengths = sizes[codes]
    n_tokens = sums(lengths, offsets)
    docs = np.repeat(owners(offsets), lengths)
    keys, counts = np.unique(docs * encoder.size + joined[gather(starts[codes], lengths)], return_counts=True)
    parts = np.bincount(keys // encoder.size, weights=counts * np.log2(counts), minlength=len(offsets) - 1)
    whole = np.maximum(n_tokens, 1)
    return n_tokens, sums(loose[codes], offsets), np.maximum(np.log2(whole) - parts / whole, 0.0)


def main_script(codes: np.ndarray, offsets: np.ndarray, words: pa.Array) -> list[str]:
    """The script with the most words; the first of the list among equals."""
    found = np.stack([
        sums(pc.match_substring_regex(words, pattern).to_numpy(zero_copy_only=False)[codes], offsets)
        for pattern in SCRIPTS.values()
    ])
    names = [*SCRIPTS]
    return [names[i] if n else "other" for i, n in zip(found.argmax(0), found.max(0))]


def fertility_measures(
    docs: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text", lang: str = "lang", others: Sequence[str] = ()
) -> DataFrame:
    """The counts of the base rules and the tokenisers' measures of every row, in one pass without a shuffle.

    ``others`` are vocabularies of byte ranks; ``n_tokens_2`` and so on count their tokens.
    """
    schema = _SCHEMA + "".join(f", n_tokens_{k} long" for k, _ in enumerate(others, 2))

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, counters = Encoder(vocabulary), [Ranks(path) for path in others]
        for part in slices(batches):
            texts = part.column(2)
            codes, offsets, words = split_words(texts)
            chars = pc.utf8_length(words).to_numpy(zero_copy_only=False)
            symbols = pc.count_substring_regex(words, SYMBOLS).to_numpy(zero_copy_only=False)
            listed = words.to_pylist()
            n_tokens, n_bytes, entropy = token_measures(encoder(listed), codes, offsets, encoder)
            columns = [
                np.diff(offsets), sums(chars[codes], offsets), sums(symbols[codes], offsets), repeated_lines(texts),
                repeated_words(codes, offsets), n_tokens, n_bytes,
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(1), *(pa.array(x, pa.int64()) for x in columns),
                    pa.array(entropy, pa.float64()), pa.array(main_script(codes, offsets, words), pa.string()),
                    *(pa.array(sums(count(listed)[codes], offsets), pa.int64()) for count in counters),
                ],
                [x.split()[0] for x in schema.split(", ")],
            )

    code = docs[lang].cast("string") if lang in docs.columns else F.lit(None).cast("string")
    kept = docs.select(docs[id].cast("long").alias("doc_id"), code.alias("lang"), docs[text].cast("string").alias("text"))
    return kept.mapInArrow(measure, schema)


def _bands(measured: DataFrame, keys: list[str], measures: Sequence[str], width: float) -> DataFrame:
    """Ends of each measure's band in each group: the quartiles, moved outwards by ``width`` quartile ranges."""
    quartiles = [F.percentile_approx(m, [0.25, 0.75], 10_000).alias(m) for m in measures]
    found = measured.where("n_words >= 20").groupBy(*keys).agg(F.count("*").alias("group_size"), *quartiles)
    ends = []
    for m in measures:
        reach = F.greatest(F.lit(width) * (F.col(m)[1] - F.col(m)[0]), F.lit(SLACK.get(m, SLACK["chars_per_token"])))
        ends.append(F.struct((F.col(m)[0] - reach).alias("low"), (F.col(m)[1] + reach).alias("high")).alias(m))
    return found.select(*keys, "group_size", F.struct(*ends).alias("band"))


def fertility_rules(
    docs: DataFrame,
    vocabulary: str,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    width: float = 1.5,
    blend: float = 200.0,
    others: Sequence[str] = (),
) -> DataFrame:
    """Base rules and the fertility verdict of every row.

    Measures: characters per token, by ``vocabulary`` and by each of ``others``; the share of
    byte-fallback tokens; and the entropy of the tokens as a share of its greatest value for so many
    tokens (``token_evenness``). A row is kept when it passes the base rules and each measure lies
    in its band. Bands come from all rows of at least 20 words: the quartiles, widened on both
    sides by ``width`` quartile ranges. As evenness falls with length, rows are compared with rows
    of their language, script and length class (the power of two of their tokens). The ends are a
    mean of that group's band, weighing its number of rows, and the band of the script and
    class over all languages, weighing ``blend`` rows, so that no verdict turns at a group size.

    Null and empty texts have no words and fail the base rules. A null language is a group of its
    own. Repeated rows and null ids are judged row by row; other columns are not read.
    """
    rows = fertility_measures(docs, vocabulary, id, text, lang, others)
    tokens = F.greatest(F.col("n_tokens"), F.lit(1))
    more = {f"chars_per_token_{k}": F.col("word_chars") / F.greatest(F.col(f"n_tokens_{k}"), F.lit(1)) for k, _ in enumerate(others, 2)}
    measures = (*MEASURES, *more)
    rows = rows.withColumns({
        "chars_per_token": F.col("word_chars") / tokens,
        "byte_share": F.col("n_byte_tokens") / tokens,
        "token_evenness": F.col("token_entropy") / F.log2(F.greatest(F.col("n_tokens"), F.lit(2))),
        "lang": F.coalesce("lang", F.lit("")),
        "length_class": F.length(F.bin("n_tokens")),
        "base_failed": (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30),
        **more,
    })
    rows = materialize(rows, "fertility")
    fine = _bands(rows, ["lang", "script", "length_class"], measures, width)
    coarse = _bands(rows, ["script", "length_class"], measures, width).select("script", "length_class", F.col("band").alias("wide"))
    weight = F.col("group_size") / (F.col("group_size") + F.lit(blend))
    ends = [
        (weight * F.col(f"band.{m}.{end}") + (1 - weight) * F.col(f"wide.{m}.{end}")).alias(f"{m}_{end}") for m in measures for end in ("low", "high")
    ]
    keys = ["lang", "script", "length_class"]
    bands = bounded(materialize(fine.join(coarse, ["script", "length_class"]).select(*keys, *ends), "bands"))
    passed = reduce(and_, [F.col(m).between(F.col(f"{m}_low"), F.col(f"{m}_high")) for m in measures])
    judged = rows.join(bands, keys, "left")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(passed, F.lit(False))).alias("kept"), "script", "n_tokens", *measures,
    )
