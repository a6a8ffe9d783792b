"""Packing of token sequences by a grouping genetic algorithm on islands."""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from petrichor.llm.arrow import bound_batches, gather, slices, split_words
from petrichor.session import materialize

#: Stems and other words of which the ids are remembered, and text whose ids are looked up at once.
CACHED_WORDS, ENCODED_BYTES = 800_000, 4 << 20
#: Latin letters whose lower case and normal form are single letters, and marks that follow a word.
_PLAIN = "^(?P<stem>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[.,!?;:]*)$"
#: A text that tells whether a vocabulary treats words as ``WordIds`` does: each by itself, in lower case.
_PROBE = "Ab cd, AB Ünï don't 42 x.y §4 \u00c5ngstr\u00f6m! e.g."
_PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACED = "block long, island int, row long, piece int, length long, bin int, bins int"


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable bytes stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordIds:
    """Token ids of blank-free words, for vocabularies of which no token crosses a blank.

    A plain Latin word is a stem in lower case and the marks behind it, which go straight to the
    merges of the model; any other word takes the whole way of the tokeniser. The ids of a bounded number of stems
    and words lie one after the other in one buffer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._letters = _byte_letters()
        self._forget()
        own = self._tokenizer.encode(_PROBE, add_special_tokens=False).ids
        starts, lengths = self(pa.array(_PROBE.split()))
        if self.ids[gather(starts.ravel().astype(np.int64), lengths.ravel().astype(np.int64))].tolist() != own:
            raise ValueError(f"{path} does not read words one by one in lower case, so they cannot be looked up one by one")

    def _forget(self) -> None:
        self._unit: dict[str, int] = {"": 0}
        self._flat, self._ends = array("I"), array("q", [0, 0])

    def _keep(self, text: str, ids: Iterable[int]) -> None:
        self._unit[text] = len(self._unit)
        self._flat.extend(ids)
        self._ends.append(len(self._flat))

    def _learn(self, texts: list[str], plain: bool) -> list[int]:
        """The unit of each text; unknown ones are encoded."""
        unit = self._unit
        new = [t for t in texts if t not in unit]
        if plain:
            tokenize, letters = self._tokenizer.model.tokenize, self._letters
            for text in new:
                spelled = text if text.isascii() else "".join([letters[b] for b in text.encode()])
                self._keep(text, [t.id for t in tokenize(spelled)])
        else:
            for low in range(0, len(new), 10_000):
                part = new[low : low + 10_000]
                for text, found in zip(part, self._tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                    self._keep(text, found.ids)
        return [unit[t] for t in texts]

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where the two parts of each word begin in ``ids``, and their lengths; a part may be empty."""
        if len(self._unit) + len(words) > CACHED_WORDS:
            self._forget()
        split = pc.extract_regex(words, _PLAIN)
        plain = pc.is_valid(split).to_numpy(zero_copy_only=False)
        units = np.zeros((len(words), 2), np.int64)
        for column, texts in enumerate((pc.utf8_lower(pc.struct_field(split, "stem")), pc.struct_field(split, "marks"))):
            coded = texts.filter(pa.array(plain)).dictionary_encode()
            own = np.array(self._learn(coded.dictionary.to_pylist(), True), np.int64)
            units[plain, column] = own[coded.indices.to_numpy(zero_copy_only=False)]
        units[~plain, 0] = self._learn(words.filter(pa.array(~plain)).to_pylist(), False)
        ends = np.array(self._ends, np.int64)
        return ends[units], ends[units + 1] - ends[units]

    @property
    def ids(self) -> np.ndarray:
        return np.array(self._flat, np.uint32)


def token_pieces(docs: DataFrame, vocabulary: str, most: int, end_id: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece of at most ``most`` tokens, without a shuffle. ``row`` numbers the rows of ``docs``."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordIds(vocabulary)
        for part in slices(batches, most=ENCODED_BYTES):
            codes, offsets, words = split_words(part.column(2))
            starts, lengths = encode(words)
            ids = np.append(encode.ids, np.uint32(end_id))
            # Each text ends with one word more, which is the end token.
            starts = np.concatenate((starts, [[len(ids) - 1, 0]]))
            lengths = np.concatenate((lengths, [[1, 0]]))
            codes = np.insert(codes, offsets[1:], len(starts) - 1)
            lengths = lengths[codes]
            bounds = np.concatenate(([0], np.cumsum(lengths.sum(axis=1))))[offsets + np.arange(len(offsets))]
            tokens = ids[gather(starts[codes].ravel(), lengths.ravel())].astype("<u4", copy=False)
            rows, keys = part.column(0).to_pylist(), part.column(1).to_pylist()
            out: list[tuple] = []
            for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                for k, low in enumerate(range(a, b, most)):
                    high = min(low + most, b)
                    out.append((rows[i], keys[i], k, low - a, high - low, zlib.crc32(tokens[low:high])))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)], [x.split()[0] for x in _PIECES.split(", ")]
            )

    bound_batches(docs.sparkSession)
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), docs[id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text")
    )
    return numbered.mapInArrow(cut, _PIECES)


Bins = list[list[int]]


def best_fit(items: Iterable[int], lengths: list[int], most: int, bins: Bins) -> Bins:
    """Puts each item into the bin with the least room that suffices, or into a new one."""
    room = sorted((most - sum(lengths[i] for i in held), k) for k, held in enumerate(bins))
    for i in items:
        at = bisect_left(room, (lengths[i], -1))
        if at < len(room):
            left, k = room.pop(at)
            bins[k].append(i)
            left -= lengths[i]
        else:
            left, k = most - lengths[i], len(bins)
            bins.append([i])
        if left:
            insort(room, (left, k))
    return bins


def fitness(bins: Bins, lengths: list[int], most: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones: a smaller value is better."""
    return len(bins), -sum((sum(lengths[i] for i in held) / most) ** 2 for held in bins)


def crossed(giver: Bins, taker: Bins, lengths: list[int], most: int, rng: np.random.Generator) -> Bins:
    """Whole well-filled bins of one parent go into the other; its bins that lose a document are
    dissolved, and the displaced documents are placed by best fit."""
    fill = [sum(lengths[i] for i in held) for held in giver]
    order = sorted(range(len(giver)), key=lambda k: -fill[k])[: max(1, len(giver) // 2)]
    chosen = [giver[k] for k in order if rng.random() < 0.7]
    given = {i for held in chosen for i in held}
    child = [list(held) for held in chosen]
    displaced = []
    for held in taker:
        if given.isdisjoint(held):
            child.append(list(held))
        else:
            displaced += [i for i in held if i not in given]
    return best_fit(sorted(displaced, key=lambda i: -lengths[i]), lengths, most, child)


def shaken(bins: Bins, lengths: list[int], most: int, rng: np.random.Generator) -> Bins:
    """The emptiest bin and some others are dissolved and placed anew."""
    emptiest = min(range(len(bins)), key=lambda k: sum(lengths[i] for i in bins[k]))
    gone = {emptiest, *rng.integers(0, len(bins), max(1, len(bins) // 10)).tolist()}
    loose = [i for k in gone for i in bins[k]]
    order = sorted(loose, key=lambda i: -lengths[i] * rng.uniform(0.8, 1.2))
    return best_fit(order, lengths, most, [list(held) for k, held in enumerate(bins) if k not in gone])


def evolved(lengths: list[int], most: int, elites: list[Bins], generations: int, size: int, seed: int) -> Bins:
    """The best packing of one island after some generations; it stops at the bound by volume."""
    rng = np.random.default_rng(seed)
    bound = -(-sum(lengths) // most)
    pool = elites or [best_fit(sorted(range(len(lengths)), key=lambda i: -lengths[i]), lengths, most, [])]
    score = lambda bins: fitness(bins, lengths, most)
    best = min(pool, key=score)
    if len(best) <= bound:
        return best
    while len(pool) < size:
        order = sorted(range(len(lengths)), key=lambda i: -lengths[i] * rng.uniform(0.7, 1.3))
        pool = [*pool, best_fit(order, lengths, most, [])]
    for _ in range(generations):
        a, b = rng.choice(len(pool), 2, replace=False)
        child = shaken(crossed(pool[a], pool[b], lengths, most, rng), lengths, most, rng)
        worst = max(range(len(pool)), key=lambda k: score(pool[k]))
        if score(child) < score(pool[worst]):
            pool[worst] = child
        best = min(pool, key=score)
        if len(best) <= bound:
            break
    return best


def _island(most: int, generations: int, size: int):
    """One island's run over one block: rows of ``origin`` -1 are unplaced, others belong to the elite of that island."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["origin", "row", "piece"], kind="stable")
        first = rows[rows.origin == rows.origin.iloc[0]].reset_index(drop=True)
        lengths = first.length.tolist()
        elites = []
        for origin, part in rows.groupby("origin"):
            if origin >= 0:
                elites.append([g.index.tolist() for _, g in part.reset_index(drop=True).groupby("bin")])
        bins = evolved(lengths, most, elites, generations, size, seed=int(key[0]) * 31 + int(key[1]))
        at = np.empty(len(first), np.int32)
        for k, held in enumerate(bins):
            at[held] = k
        return pd.DataFrame({
            "block": key[0], "island": key[1], "row": first.row, "piece": first.piece, "length": first.length,
            "bin": at, "bins": len(bins),
        })

    return run


def _pack_blocks(items: DataFrame, blocks: int, most: int, islands: int, rounds: int, generations: int, size: int) -> DataFrame:
    """The best island's bins for each block, after ``rounds`` runs between which elites move on to the next island."""
    dealt = items.select(F.pmod(F.xxhash64("row", "piece"), F.lit(blocks)).alias("block"), "row", "piece", "length")
    state = dealt.select(
        "*", F.explode(F.array(*[F.lit(i) for i in range(islands)])).alias("island"), F.lit(-1).alias("origin"), F.lit(0).alias("bin")
    )
    for turn in range(rounds):
        placed = materialize(state.groupBy("block", "island").applyInPandas(_island(most, generations, size), _PLACED), "islands")
        if turn + 1 < rounds:
            own, next_island = F.col("island"), F.pmod(F.col("island") + 1, F.lit(islands))
            state = placed.select(
                "block", "row", "piece", "length", F.explode(F.array_distinct(F.array(own, next_island))).alias("to"), F.col("island").alias("origin"), "bin"
            ).withColumnRenamed("to", "island")
    best = placed.groupBy("block").agg(F.min_by("island", F.struct("bins", "island")).alias("island"))
    return placed.join(best, ["block", "island"], "left_semi")


def pack(
    docs: DataFrame,
    vocabulary: str,
    most: int = 4096,
    end_id: int = 1,
    id: str = "doc_id",
    text: str = "text",
    block_items: int = 2000,
    islands: int = 3,
    rounds: int = 2,
    generations: int = 12,
    size: int = 4,
    full_share: float = 0.995,
) -> DataFrame:
    """One row per piece of a document with its sequence and its place there.

    Tokens are counted in one pass; only lengths are shuffled. Shorter pieces are dealt by hash to
    blocks of about ``block_items``, and each block is packed by ``islands`` populations in tasks
    of their own. Between rounds an island's best packing joins the next island. What lies in bins
    filled below ``full_share`` is packed again in fewer blocks, until one block holds it all, so
    that blocks cost no half-empty sequences. Groups are bounded by ``block_items`` however the
    lengths repeat. A piece of full length is a sequence of its own.

    Null and empty texts are one token, the end token. Repeated rows are packed each for itself;
    null ids stay null; other columns are not read. An empty table gives no rows.
    """
    pieces = materialize(token_pieces(docs, vocabulary, most, end_id, id, text), "pieces")
    items = pieces.where(F.col("length") < most).select("row", "piece", "length")
    settled, level, last = [], 0, None
    while True:
        n = items.count()
        if n == 0:
            break
        blocks = -(-n // block_items)
        placed = _pack_blocks(items, blocks, most, islands, rounds, generations, size)
        filled = placed.groupBy("block", "bin").agg(F.sum("length").alias("filled"))
        placed = placed.join(filled, ["block", "bin"])
        done = blocks == 1 or n == last
        closed = F.lit(True) if done else F.col("filled") >= most * full_share
        number = F.lit(level << 57) + F.col("block") * (1 << 24) + F.col("bin")
        placed = materialize(placed.select("row", "piece", "length", number.alias("sequence_id"), closed.alias("closed")), "packed")
        settled.append(placed.where("closed").select("row", "piece", "sequence_id"))
        if done:
            break
        items, last, level = placed.where("not closed").select("row", "piece", "length"), n, level + 1
    whole = pieces.where(F.col("length") >= most).withColumn("sequence_id", -F.monotonically_increasing_id() - 1)
    out = whole.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", F.lit(0).cast("long").alias("offset"))
    if settled:
        from functools import reduce

        from pyspark.sql import Window

        packed = pieces.where(F.col("length") < most).join(reduce(DataFrame.unionAll, settled), ["row", "piece"])
        before = Window.partitionBy("sequence_id").orderBy("row", "piece").rowsBetween(Window.unboundedPreceding, -1)
        offset = F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")
        out = packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", offset).unionAll(out)
    return out
