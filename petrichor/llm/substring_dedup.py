"""Removal of word windows that an earlier document has, by windows of doubled length."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from petrichor.llm.arrow import gather, gram_hashes, mixed, slices, split_words
from petrichor.llm.runs import identified, merged_spans, own_id, repeated_runs
from petrichor.llm.sides import bounded
from petrichor.session import materialize


def word_symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and each text's offsets."""
    codes, offsets, words = split_words(texts)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))
    return hashes[codes], offsets


def _levels(window: int) -> list[int]:
    """Lengths that double up to the window: 50 gives 12, 25, 50."""
    out = [window]
    while out[-1] >= 24:
        out.append(out[-1] // 2)
    return out[::-1]


def _windows(rows: DataFrame, firsts: DataFrame, lengths: list[int], window: int) -> DataFrame:
    """Every window of the given runs, with the hashes of its first and last ``length`` words at each level."""
    lists = firsts.groupBy("doc", "part").agg(F.collect_list(F.struct("start", "windows")).alias("runs"))
    lists = bounded(materialize(lists, "run_lists"), "runs")
    columns = [f"{side}{k}" for k in lengths[:-1] for side in ("head", "tail")] + ["whole"]
    schema = "doc long, part long, start long, " + ", ".join(f"{c} long" for c in columns)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            symbols, offsets = word_symbols(part.column(2))
            runs = part.column(3)
            values = runs.flatten()
            start, count = (values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            text = np.repeat(np.arange(len(part)), np.diff(runs.offsets.to_numpy()))
            own = gather(start, count.astype(np.int64))
            text = np.repeat(text, count)
            at = own + offsets[text]
            out = [part.column(0).take(pa.array(text)), part.column(1).take(pa.array(text)), pa.array(own)]
            for k in lengths[:-1]:
                hashes = mixed(gram_hashes(symbols, k)).view(np.int64)
                out += [pa.array(hashes[at]), pa.array(hashes[at + window - k])]
            out.append(pa.array(mixed(gram_hashes(symbols, window)).view(np.int64)[at]))
            for low in range(0, len(at), 100_000):
                yield pa.RecordBatch.from_arrays([x.slice(low, 100_000) for x in out], ["doc", "part", "start", *columns])

    return rows.join(lists, ["doc", "part"]).select("doc", "part", "text", "runs").mapInArrow(cut, schema)


def repeated_windows(rows: DataFrame, window: int) -> DataFrame:
    """doc, part, start, end (in words) of what windows of a smaller id cover."""
    lengths = _levels(window)
    runs = materialize(repeated_runs(rows, word_symbols, window, lengths[0], within_document=False), "runs")
    copies = runs.where("kind = 'copy'").select("doc", "part", "start", (F.col("start") + F.col("windows") + window - 1).alias("end"))
    found = materialize(_windows(rows, runs.where("kind = 'first'"), lengths[1:], window), "windows")
    for k in lengths[1:-1]:
        halves = found.select("doc", F.explode(F.array(f"head{k}", f"tail{k}")).alias("half"))
        shared = halves.groupBy("half").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a < b").select("half")
        for side in (f"head{k}", f"tail{k}"):
            found = found.join(shared.withColumnRenamed("half", side), side, "left_semi")
        found = materialize(found, f"windows{2 * k}")
    earliest = found.groupBy("whole").agg(F.min("doc").alias("earliest"), F.max("doc").alias("latest")).where("earliest < latest")
    hits = found.join(earliest, "whole").where("doc > earliest").select("doc", "part", "start", (F.col("start") + window).alias("end"))
    return copies.unionAll(hits)


def _cut_words(words: list[bytes], starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    out, at = [], 0
    for a, b in zip(starts, ends):
        out += words[at:a]
        at = b
    return out + words[at:]


def substring_dedup(docs: DataFrame, window: int = 50, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (the words that stay, joined by blanks) of every row.

    A word goes if a window of ``window`` words over it also starts in a document with a smaller
    id; windows are judged on the input. Level by level, windows that are alone at one length are
    dropped and the others looked at with twice that length: first the anchors (grams of a quarter
    window, one for each run of windows), then both halves of each window, then whole windows.
    Runs that are equal throughout are settled at the first level, so copies are not cut into
    windows. Every group is aggregated before it is shuffled; no pairs are made. Words are
    compared as 64-bit hashes, runs as two of them.

    Null and blank texts have no words. A null id counts as smaller than all others. Rows of one
    id never remove each other's words; a row listed twice gets its result twice. Other columns
    are not read. An empty table gives no rows.
    """
    rows, distinct = identified(docs, id, text)
    spans = materialize(merged_spans(repeated_windows(distinct, window)), "spans")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text="text"):
            keep, total, gone = [], [], []
            for body, starts, ends in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), part.column(3).to_pylist()):
                words = body.encode().split()
                kept = _cut_words(words, starts or [], ends or [])
                keep.append(b" ".join(kept).decode())
                total.append(len(words))
                gone.append(len(words) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(keep, pa.string())],
                ["doc", "n_words", "n_removed", "kept_text"],
            )

    joined = rows.join(bounded(spans, "starts", "ends"), ["doc", "part"], "left").select("doc", "text", "starts", "ends")
    out = joined.mapInArrow(cut, "doc long, n_words long, n_removed long, kept_text string")
    return out.select(own_id(F.col("doc")).alias("doc_id"), "n_words", "n_removed", "kept_text")

