"""Runs of windows that may recur elsewhere, found in one shuffle, and the removal of spans.

A window is a fixed number of consecutive symbols (bytes or words) of one document. Of the hashes
of all grams in a window the smallest is its anchor, so equal windows have equal anchors wherever
they stand. Consecutive windows with one anchor are a run; text makes a few runs per hundred
symbols, and runs are what is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from petrichor.llm.arrow import gather, gram_hashes, mixed, slices

#: Stands for a null id: smaller than all ids.
NO_ID = -(1 << 63)
_BASE = 0xD6E8FEB86659FD93
_RUNS = "anchor long, content long, doc long, part long, start long, windows int, copy boolean, loops boolean"

#: Turns texts into 64-bit symbols and the offsets at which each text's symbols begin and end.
Symbols = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def identified(docs: DataFrame, id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """doc, part, text of every row, and of every document.

    Both are the same if no id occurs twice; part is then 0. Otherwise it tells the texts of one id
    apart, in the order of a hash, and a row that is listed twice is one document.
    """
    rows = docs.select(
        F.coalesce(docs[id].cast("long"), F.lit(NO_ID)).alias("doc"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text")
    )
    if rows.groupBy("doc").count().where("count > 1").isEmpty():
        rows = rows.select("doc", F.lit(0).cast("long").alias("part"), "text")
        return rows, rows
    rows = rows.select("doc", F.xxhash64("text").alias("part"), "text")
    return rows, rows.dropDuplicates(["doc", "part"])


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """The least or greatest of each ``width`` values in a row, by runs of doubled length."""
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        values = pick(values[:-step], values[step:])
        reach += step
    return values


def window_runs(symbols: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Text number, start within the text, windows, anchor and content hash of each run, in order, and
    whether the run's anchor occurs in it more than once, as it must if two windows of it are equal."""
    n, width = len(symbols), window - gram + 1
    if n < window:
        return tuple(np.empty(0, k) for k in (np.int64, np.int64, np.int64, np.uint64, np.uint64, bool))
    grams = mixed(gram_hashes(symbols, gram))
    least = _sliding(grams, width, np.minimum)
    text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    valid = text_of[: n - window + 1] == text_of[window - 1 :]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | ~valid[:-1]
    new &= valid
    starts = np.flatnonzero(new)
    # A run ends where the next begins or where the text has no more windows.
    last = offsets[text_of[starts] + 1] - window + 1
    counts = np.minimum(np.append(starts[1:], len(least)), last) - starts
    parts = -(-counts // width)
    within = gather(np.zeros(len(parts), np.int64), parts)
    starts = np.repeat(starts, parts) + within * width
    counts = np.minimum(width, np.repeat(counts, parts) - within * width)
    # A gram is an anchor if it is the least of some window around it.
    edge = np.zeros(width - 1, np.uint64)
    places = np.flatnonzero(_sliding(np.concatenate((edge, np.where(valid, least, np.uint64(0)), edge)), width, np.maximum) == grams)
    twice = places[1:][(grams[places[1:]] == grams[places[:-1]]) & (np.diff(places) < width)]
    seen = np.concatenate(([0], np.cumsum(np.bincount(twice, minlength=n))))
    loops = seen[np.minimum(starts + counts + width - 1, n)] > seen[np.minimum(starts + 1, n)]
    powers = np.full(n, _BASE, np.uint64)
    powers[0] = 1
    np.cumprod(powers, out=powers)
    upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(symbols * powers, dtype=np.uint64)))
    back = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    back[0] = 1
    np.cumprod(back, out=back)
    content = mixed((upto[starts + counts + window - 1] - upto[starts]) * back[starts] + counts.astype(np.uint64))
    return text_of[starts], starts - offsets[text_of[starts]], counts, least[starts], content, loops


def repeated_runs(rows: DataFrame, symbols: Symbols, window: int, gram: int, within_document: bool) -> DataFrame:
    """doc, part, start, windows, anchor and kind of the runs that matter.

    Kind ``copy``: an equal run stands earlier, so all its windows are repeats. Kind ``first``: the
    earliest of its equals, whose anchor also has other runs, so that some of its windows may be
    repeats. A run whose anchor or whose content is alone has none and is left out. Earlier means
    a smaller (doc, part), and within one document an earlier start if ``within_document`` is set;
    otherwise runs of one document are not copies of each other. With it, a run is also kept as
    ``first`` if its own windows may repeat, as in periodic text.

    Equal runs of one slice of text are collapsed where they are found: of thousands of copies
    few reach the shuffle by their anchor, the others pass through it spread by their place.
    """

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, most=2 << 20):
            order = np.lexsort([part.column(i).to_numpy(zero_copy_only=False) for i in (1, 0)])
            part = part.take(pa.array(order))
            doc, sub = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            text, start, count, anchor, content, loops = window_runs(*symbols(part.column(2)), window, gram)
            doc, sub = doc[text], sub[text]
            _, first, which = np.unique(mixed(anchor) ^ content, return_index=True, return_inverse=True)
            first = first[which]
            copy = (doc[first] != doc) | (sub[first] != sub)
            if within_document:
                copy |= start != start[first]
            anchor = np.where(copy, mixed(content ^ mixed(start + doc)), anchor)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), pa.array(doc), pa.array(sub),
                    pa.array(start), pa.array(count.astype(np.int32)), pa.array(copy), pa.array(loops & within_document),
                ],
                [x.split()[0] for x in _RUNS.split(", ")],
            )

    runs = rows.select("doc", "part", "text").mapInArrow(find, _RUNS)
    ordered = Window.partitionBy("anchor", "copy").orderBy("content", "doc", "part", "start")
    all_rows = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = runs.repartition("anchor").withColumns({
        "equal": F.coalesce(F.lag("content").over(ordered) == F.col("content"), F.lit(False)),
        "several": F.first("content").over(all_rows) != F.last("content").over(all_rows),
    })
    if within_document:
        repeat = F.col("copy") | F.col("equal")
    else:
        runs = runs.withColumn("earliest", F.min(F.struct("doc", "part")).over(Window.partitionBy("anchor", "copy", "content")))
        repeat = F.col("copy") | (F.struct("doc", "part") != F.col("earliest"))
    found = runs.select(
        "doc", "part", "start", "windows", "anchor", F.when(repeat, "copy").when(F.col("several") | F.col("loops"), "first").alias("kind"),
    )
    return found.where("kind is not null")


def merged_spans(spans: DataFrame) -> DataFrame:
    """doc, part, starts, ends: the maximal spans that the given ones (doc, part, start, end) cover."""
    lists = spans.groupBy("doc", "part").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(2)
            values = spans.flatten()
            start, end = (values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            bounds = spans.offsets.to_numpy() - spans.offsets[0].as_py()
            owner = np.repeat(np.arange(len(batch)), np.diff(bounds))
            order = np.lexsort((start, owner))
            owner, start, end = owner[order], start[order], end[order]
            # Shifting each document beyond the one before lets one running maximum serve them all.
            shift = np.concatenate(([0], np.cumsum(np.maximum.reduceat(end, bounds[:-1]) + 1)))[:-1] if len(end) else np.empty(0, np.int64)
            start, end = start + shift[owner], end + shift[owner]
            far = np.maximum.accumulate(end)
            new = np.ones(len(start), bool)
            new[1:] = (start[1:] > far[:-1]) | (owner[1:] != owner[:-1])
            firsts = np.flatnonzero(new)
            lasts = np.append(firsts[1:], len(start)) - 1
            owner = owner[firsts]
            sizes = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(batch))))).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(pa.array(sizes), pa.array((x - shift[owner]).astype(np.int64))) for x in (start[firsts], far[lasts])
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], ["doc", "part", "starts", "ends"])

    return lists.mapInArrow(merge, "doc long, part long, starts array<long>, ends array<long>")


def own_id(doc: Column) -> Column:
    return F.when(doc != NO_ID, doc)
