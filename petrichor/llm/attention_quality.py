"""A quality classifier that learns from document labels which passages matter."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petrichor.llm.arrow import slices, split_words

#: Words of a passage, buckets of hashed words, widths of the encoder and of the attention.
PASSAGE, BUCKETS, HIDDEN, GATE = 100, 48, 24, 12
#: Text that is measured at once: its arrays take some twenty times as much, and a worker keeps what it took.
MEASURED_BYTES = 2 << 20
#: What is counted in each word, as RE2 patterns.
COUNTED = (r"\p{Lu}", r"\p{L}", r"\p{N}", "[.,;:]", "[!?]", "[#*$%&|<>]", r"[^\x00-\x7F]", r"[/@_=\\{}()\[\]]")
WIDTH = len(COUNTED) + 6 + BUCKETS


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Measures of each passage, and the number of its text. A text without words has one empty passage."""
    codes, offsets, words = split_words(texts)
    sizes = np.diff(offsets)
    per_text = np.maximum(1, -(-sizes // PASSAGE))
    ends = np.cumsum(per_text)
    text_of = np.repeat(np.arange(len(sizes)), per_text)
    within = np.arange(len(codes)) - np.repeat(offsets[:-1], sizes)
    at = np.repeat(ends - per_text, sizes) + within // PASSAGE
    n = int(ends[-1]) if len(ends) else 0
    size = np.bincount(at, minlength=n).astype(np.float64)
    some = np.maximum(size, 1)
    chars = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    all_chars = np.maximum(np.bincount(at, weights=chars[codes], minlength=n), 1)
    columns = [
        np.bincount(at, weights=pc.count_substring_regex(words, p).to_numpy(zero_copy_only=False)[codes], minlength=n) / all_chars
        for p in COUNTED
    ]
    columns.append(all_chars / some / 10)
    columns.append(np.log1p(size) / 5)
    again = np.zeros(len(codes), bool)
    again[1:] = (codes[1:] == codes[:-1]) & (at[1:] == at[:-1])
    columns.append(np.bincount(at, weights=again, minlength=n) / some)
    distinct = np.unique(at * (len(words) + 1) + codes) // (len(words) + 1)
    columns.append(np.bincount(distinct, minlength=n) / some)
    short = (chars <= 3)[codes]
    columns.append(np.bincount(at, weights=short, minlength=n) / some)
    stops = pc.match_substring_regex(words, "[.!?,;:]$").to_numpy(zero_copy_only=False)[codes]
    columns.append(np.bincount(at, weights=stops, minlength=n) / some)
    spread = _buckets(words)[codes]
    counted = np.bincount(at * BUCKETS + spread, minlength=n * BUCKETS).reshape(n, BUCKETS)
    return np.column_stack([*columns, np.sqrt(counted / some[:, None])]).astype(np.float32), text_of


def _buckets(words: pa.Array) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.encode()) % BUCKETS for w in words.to_pylist()), np.int64, len(words))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class GatedAttention:
    """Passages are encoded, weighted by gated attention, summed, and the sum is scored.

    h = tanh(x A + a); weight = softmax over the document of (tanh(h V) * sigmoid(h U)) w;
    score = sigmoid(sum(weight * h) c + c0).
    """

    def __init__(self, mean: np.ndarray, std: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.std = mean, std
        self.p = {
            "A": rng.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, HIDDEN)), "a": np.zeros(HIDDEN),
            "V": rng.normal(0, 0.3, (HIDDEN, GATE)), "U": rng.normal(0, 0.3, (HIDDEN, GATE)), "w": rng.normal(0, 0.3, GATE),
            "c": rng.normal(0, 0.3, HIDDEN), "c0": np.zeros(1),
        }

    def _forward(self, x: np.ndarray, starts: np.ndarray, doc: np.ndarray) -> tuple:
        p = self.p
        x = (x - self.mean) / self.std
        h = np.tanh(x @ p["A"] + p["a"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * s) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[doc])
        weight = e / np.add.reduceat(e, starts)[doc]
        z = np.add.reduceat(weight[:, None] * h, starts, axis=0)
        return x, h, t, s, weight, z, _sigmoid(z @ p["c"] + p["c0"][0])

    def scores(self, x: np.ndarray, starts: np.ndarray, doc: np.ndarray) -> np.ndarray:
        return self._forward(x, starts, doc)[-1]

    def gradients(self, x: np.ndarray, starts: np.ndarray, doc: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy."""
        p = self.p
        x, h, t, s, weight, z, score = self._forward(x, starts, doc)
        d = (score - y) / len(y)
        dz = d[:, None] * p["c"]
        dh = weight[:, None] * dz[doc]
        dweight = (h * dz[doc]).sum(1)
        de = weight * (dweight - np.add.reduceat(weight * dweight, starts)[doc])
        gate = de[:, None] * p["w"]
        dt, ds = gate * s * (1 - t**2), gate * t * s * (1 - s)
        dh += dt @ p["V"].T + ds @ p["U"].T
        du = dh * (1 - h**2)
        return {
            "A": x.T @ du, "a": du.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de, "c": z.T @ d,
            "c0": np.array([d.sum()]),
        }


def fit(x: np.ndarray, doc: np.ndarray, y: np.ndarray, steps: int, seed: int, batch: int = 64, rate: float = 0.005) -> GatedAttention:
    """Adam over shuffled documents, in whole passes of ``steps`` batches at least; ``doc`` numbers
    the documents from 0, in order."""
    model = GatedAttention(x.mean(0), x.std(0) + 1e-3, seed)
    rng = np.random.default_rng(seed)
    bounds = np.concatenate((np.flatnonzero(np.diff(doc, prepend=-1)), [len(doc)]))
    first, second = ({k: np.zeros_like(v) for k, v in model.p.items()} for _ in range(2))
    step = 0
    while step < steps:
        order = rng.permutation(len(y))
        for low in range(0, len(order), batch):
            chosen = order[low : low + batch]
            sizes = bounds[chosen + 1] - bounds[chosen]
            rows = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in chosen])
            starts = np.cumsum(sizes) - sizes
            g = model.gradients(x[rows], starts, np.repeat(np.arange(len(chosen)), sizes), y[chosen])
            step += 1
            for k in model.p:
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
                model.p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def held_out(id: str) -> Column:
    """True for the quarter of the ids that no model may learn from."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = 6000,
    steps: int = 1500, seed: int = 7,
) -> GatedAttention:
    """A model learnt in one task from at most ``sample`` labelled rows that are not held out.

    The rows are those with the smallest hashes of their ids; with several labels an id takes the
    smallest. Null ids and null labels teach nothing. Only the fitted weights reach the driver.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull() & ~held_out(id))
    known = known.groupBy(F.col(id).cast("long").alias("doc_id")).agg((F.min(label) > 0).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(docs[id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, most=MEASURED_BYTES):
            x, doc = passages(part.column(1))
            cuts = np.searchsorted(doc, np.arange(len(part) + 1))
            blobs = [x[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(blobs, pa.binary())], ["doc_id", "label", "x"])

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "x"], kind="stable")
        bags = [np.frombuffer(b, np.float32).reshape(-1, WIDTH) for b in rows.x]
        doc = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
        model = fit(np.concatenate(bags), doc, rows.label.to_numpy(float), steps, seed)
        return pd.DataFrame({"model": [pickle.dumps((model.mean, model.std, model.p))]})

    bags = texts.join(F.broadcast(known), "doc_id").select("doc_id", "text", "label").mapInArrow(encode, "doc_id long, label int, x binary")
    found = bags.withColumn("all", F.lit(True)).groupBy("all").applyInPandas(learn, "model binary").collect()
    model = GatedAttention(np.zeros(WIDTH), np.ones(WIDTH), seed)
    if found:
        model.mean, model.std, model.p = pickle.loads(found[0].model)
    else:
        model.p["c"][:] = 0
    return model


def score(docs: DataFrame, model: GatedAttention, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score of every row, in one pass without a shuffle.

    The score looks at the text alone. Null and empty texts are one passage without words.
    """

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, most=MEASURED_BYTES):
            x, doc = passages(part.column(1))
            found = model.scores(x, np.searchsorted(doc, np.arange(len(part))), doc)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    kept = docs.select(docs[id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return kept.mapInArrow(judge, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``threshold`` on) of every row of ``docs``.

    Repeated rows get equal scores; a null id is never held out and teaches nothing; other columns
    are not read. Without any label every score is a half. An empty table gives no rows.
    """
    scored = score(docs, train(docs, labels, id, text, **settings), id, text)
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns, in one pass without a shuffle."""
    model = train(docs, labels, id, text, **settings)
    schema = docs.schema

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            thin = pa.RecordBatch.from_arrays([pa.array(range(len(batch))), batch.column(at)], ["at", "text"])
            good: list[int] = []
            for part in slices([thin], most=MEASURED_BYTES):
                x, doc = passages(part.column(1))
                found = model.scores(x, np.searchsorted(doc, np.arange(len(part))), doc)
                good += part.column(0).filter(pa.array(found >= threshold)).to_pylist()
            yield batch.take(pa.array(good, pa.int64()))

    return docs.mapInArrow(judge, schema)

