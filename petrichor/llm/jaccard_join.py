"""Exact n-gram Jaccard join in metric space: pivots, Voronoi regions and replicated boundaries."""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from petrichor.llm.arrow import gram_hashes, mixed, slices, split_words
from petrichor.llm.components import components
from petrichor.llm.sides import bounded, free_name
from petrichor.session import materialize

#: Shingles that one task joins at most, and pivots that tell the sets of a larger region apart.
REGION_SHINGLES, PIVOTS = 8_000_000, 16
#: Times that the sets of large families are first tied to one set of each of their signatures.
TIES = 2
#: Members that meet their pivots in one part, and the distance up to which a set belongs to its nearest pivot.
MEMBERS, NEAR = 4096, 0.5
#: Sets of which a task remembers that it has told their signatures.
REMEMBERED = 1_000_000
_SETS = "doc_id long, n long, k1 long, k2 long, chosen array<long>"
_PART, _CLASS = np.uint64(0xD1B54A32D192ED03), 0x8CB92BA72F3D8DD7


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes.

    Words are taken with A-Z in lower case; a text of fewer words is one shingle.
    """
    codes, offsets, words = split_words(texts)
    plain = pc.ascii_lower(words).cast(pa.binary()).to_pylist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, plain), np.uint64, len(plain))[codes]
    grams = mixed(gram_hashes(hashes, size))
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= size:
            own = np.sort(grams[a : b - size + 1])
            fresh = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=fresh[1:])
            out.append(own[fresh])
        elif b > a:
            out.append(mixed(gram_hashes(hashes[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _names(sets: list[np.ndarray]) -> list[pa.Array]:
    """Two halves of a 128-bit hash of each set."""
    names = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x) for x in sets), ">i8").astype(np.int64).reshape(-1, 2)
    return [pa.array(names[:, 1]), pa.array(names[:, 0])]


def _prefix(n: int, percent: int) -> int:
    """Elements of which two sets that are similar enough share one, in any common order."""
    return n - -(-percent * n // 100) + 1


def _classes(percent: int, most: int) -> list[tuple[int, int, int]]:
    """(least size, differences, parts) of each class of sizes up to ``most``; a set's partners lie in its own or an adjacent class.

    A set of the class and a partner as large or larger differ in at most ``differences`` elements,
    those of both sides added up. Into one more part than that its elements are dealt, and into some
    more for parts that stay empty.
    """
    largest = lambda n: 100 * n // percent
    out, low = [], 1
    while low <= most:
        high = max(largest(largest(low)), 5 * low // 4) + 1
        differences = (high - 1) * (100 - percent) // percent
        parts, empty = differences + 1, 0.0
        while parts < 2 * low:
            empty = parts * math.exp(-low / parts)
            if parts - empty - 2 * math.sqrt(empty) >= differences + 1:
                break
            parts += max(1, parts // 20)
        out.append((low, differences, parts))
        low = high
    return out


def _signatures(found: np.ndarray, percent: int, classes: list[tuple[int, int, int]]) -> np.ndarray:
    """Hashes of which two sets that are similar enough, but not equal, share one.

    The hash of an element says in which of the parts of a class it lies. Two partners differ in
    fewer parts than there are, so one part that is not empty is the same on both sides; its
    elements, added up, are a signature. If too many parts of a set are empty to be sure of that,
    the elements of its prefix are signatures too: partners of which this holds share one of them.
    """
    n, tag = len(found), lambda x: np.uint64(x * _CLASS % (1 << 64))
    at = bisect.bisect_right(classes, (n, math.inf, math.inf)) - 1
    out = []
    for k in (at, at - 1):
        if k < 0 or not classes[k][1] or k < at and -(-percent * n // 100) >= classes[at][0]:
            continue
        low, differences, parts = classes[k]
        part = (found >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
        starts = np.concatenate(([0], np.flatnonzero(part[1:] != part[:-1]) + 1))
        out.append(mixed(np.add.reduceat(found, starts)) + part[starts] * _PART + tag(2 * low))
        if len(starts) <= differences:
            out.append(mixed(found[: _prefix(n, percent)]) + tag(2 * low + 1))
    return mixed(np.concatenate(out)) if out else np.empty(0, np.uint64)


def _described(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """One row per document: its set's size and name, and the signatures by which partners are sought.

    They are told once per task for equal sets, as far as these are remembered.
    """

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, told = [], set()
        for part in slices(batches):
            sets = shingle_sets(part.column(1), size)
            widest = max(map(len, sets), default=0)
            if not classes or widest >= classes[-1][0]:
                classes = _classes(percent, 2 * widest)
            k1, k2 = _names(sets)
            chosen = []
            for found, *name in zip(sets, k1.to_pylist(), k2.to_pylist()):
                if len(found) and (*name,) not in told:
                    chosen.append(_signatures(found, percent, classes))
                    told.add((*name,))
                else:
                    chosen.append(np.empty(0, np.uint64))
            if len(told) > REMEMBERED:
                told.clear()
            ends = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in chosen]))).astype(np.int32))
            flat = np.concatenate(chosen) if chosen else np.empty(0, np.uint64)
            columns = [part.column(0), pa.array([len(x) for x in sets], pa.int64()), k1, k2]
            columns += [pa.ListArray.from_arrays(ends, pa.array(flat.view(np.int64)))]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _SETS.split(", ")])

    return docs.mapInArrow(describe, _SETS)


def _families(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """name, family: sets that may have a partner, and what they may be linked with; signature, name: by which signatures.

    Two similar sets share a signature, which stands for several shingles at once, so that sets of
    unlike texts hardly ever share one by chance, however many there are. Sets go by the first half
    of their names: if two of them had it in common, their families would be one. Sets of one
    signature are tied to its smallest, so that no pairs arise.
    """
    rows = sets.select(F.col("k1").alias("name"), F.explode("chosen").alias("signature"))
    held = Window.partitionBy("signature")
    shared = rows.withColumns({"least": F.min("name").over(held), "most": F.max("name").over(held)}).where("least != most")
    shared = materialize(shared.select("signature", "name", "least").distinct(), "signatures")
    edges = shared.where("name != least").select(F.col("name").alias("a"), F.col("least").alias("b")).distinct()
    return components(edges).select(F.col("node").alias("name"), F.col("root").alias("family")), shared.select("signature", "name")


class Region:
    """The sets of one region, with an inverted index for distances from one set to all."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        flat, at = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(at, kind="stable")
        self._holders = owner[order]
        self._starts = np.searchsorted(at[order], np.arange(len(flat) + 1))
        self._bounds = np.concatenate(([0], np.cumsum(self.sizes)))
        self._at = at

    def overlaps(self, i: int) -> np.ndarray:
        """How many shingles set ``i`` shares with each."""
        own = self._at[self._bounds[i] : self._bounds[i + 1]]
        parts = [self._holders[self._starts[s] : self._starts[s + 1]] for s in own]
        return np.bincount(np.concatenate(parts), minlength=len(self.sizes))

    def roots(self, percent: int, known: np.ndarray | None = None, side: np.ndarray | None = None) -> np.ndarray:
        """For each set the smallest set that links reach.

        Sets that are equal in ``known`` are connected already. If ``side`` is given, only sets of
        different sides are compared.

        Sets become pivots one after the other. A pivot is compared with those that are not yet
        known to be connected with it and that no earlier pivot rules out: by the triangle
        inequality two sets within the radius differ in their distance to any third by no more
        than the radius. Once all are connected nothing is left to compare.
        """
        n, sizes = len(self.sizes), self.sizes
        root = np.arange(n)
        if known is not None:
            _, first, at = np.unique(known, return_index=True, return_inverse=True)
            root = first[at]
        radius = 1 - percent / 100 + 1e-9
        seen: list[np.ndarray] = []
        for i in range(n):
            other = root != root[i]
            other &= (100 * sizes >= percent * sizes[i]) & (100 * sizes[i] >= percent * sizes)
            if side is not None:
                other &= side != side[i]
            for distance in seen:
                if not other.any():
                    break
                other &= np.abs(distance - distance[i]) <= radius
            if not other[i + 1 :].any():
                continue
            shared = self.overlaps(i)
            union = sizes + sizes[i] - shared
            linked = (100 * shared >= percent * union) & (root != root[i])
            for old in np.unique(root[linked]):
                low, high = sorted((int(old), int(root[i])))
                root[root == high] = low
            if len(seen) < PIVOTS:
                seen.append(1 - shared / union)
        return root


def _joined(percent: int):
    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("set", kind="stable").reset_index(drop=True)
        region = Region([np.frombuffer(b, np.uint64) for b in rows.shingles])
        known = rows.known.to_numpy() if "known" in rows else None
        side = rows.side.to_numpy() if "side" in rows and rows.side.nunique() > 1 else None
        return pd.DataFrame({"a": rows.set, "b": rows.set.to_numpy()[region.roots(percent, known, side)]})

    return join


def _distances(members: DataFrame, pivots: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """region, set, linked, distance: the pivots of its region that a set is linked with, and how far each is.

    Pivots go to the members of their region in parts of a bounded number, so that a large region
    is not one task.
    """
    counts = members.groupBy("region").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("parts"))
    counts = bounded(materialize(counts, "parts"))
    pivots = pivots.join(held, "set").groupBy("region").agg(F.sort_array(F.collect_list(F.struct("nr", "set", "shingles"))).alias("pivots"))
    pivots = pivots.join(counts, "region").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    members = members.join(counts, "region").withColumn("salt", F.pmod(F.xxhash64("set"), "parts").cast("int"))
    members = members.select("region", "set", "salt").join(held, "set")
    both = members.join(pivots.select("region", "salt", "pivots"), ["region", "salt"]).select("region", "set", "shingles", "pivots")

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, distances = [], []
            for at in range(len(batch)):
                own = np.frombuffer(batch.column(2)[at].as_py(), np.uint64)
                linked.append([])
                distances.append([])
                for pivot in batch.column(3)[at].as_py():
                    other = np.frombuffer(pivot["shingles"], np.uint64)
                    shared = len(np.intersect1d(own, other, assume_unique=True))
                    union = len(own) + len(other) - shared
                    distances[-1].append(1 - shared / union)
                    if 100 * shared >= percent * union:
                        linked[-1].append(pivot["set"])
            columns = [batch.column(0), batch.column(1), pa.array(linked, pa.list_(pa.int64())), pa.array(distances, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["region", "set", "linked", "distance"])

    return both.mapInArrow(measure, "region long, set long, linked array<long>, distance array<double>")


def _linked(found: DataFrame) -> DataFrame:
    return found.select(F.col("set").alias("a"), F.explode("linked").alias("b")).where("a != b")


def _open(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """``rows`` with the root of each set, without regions whose sets are all connected."""
    roots = components(edges)
    rows = rows.drop("known").join(roots, F.col("set") == F.col("node"), "left")
    rows = rows.select("region", "set", "weight", F.coalesce("root", "set").alias("known"))
    some = rows.groupBy("region").agg(F.min("known").alias("x"), F.max("known").alias("y")).where("x != y").select("region")
    return materialize(rows.join(some, "region", "left_semi"), "open")


def _block_pairs(rows: DataFrame, found: DataFrame, percent: int, most: int) -> DataFrame:
    """task, side, set, known: pairs of blocks of a region, each pair of at most ``most`` shingles.

    A block holds sets that are nearest to the same pivot, or near none. It is paired with itself
    and with each other block of its region, unless all sets of both are connected, their sizes
    rule all links out, or the triangle inequality does: linked sets differ in their distance to
    any pivot by no more than the radius. Only a set of over a quarter of ``most`` may exceed it.
    """
    nearest = F.array_min("distance")
    placed = rows.join(found.select("region", "set", "distance"), ["region", "set"])
    placed = placed.withColumn("cell", F.when(nearest <= NEAR, F.array_position("distance", nearest)).otherwise(F.lit(0)).cast("long"))
    placed = materialize(placed, "placed")
    cells = placed.groupBy("region", "cell").agg(F.ceil(F.sum("weight") / most).alias("buckets"), F.max("weight").alias("widest"))
    placed = placed.join(bounded(materialize(cells, "cells")), ["region", "cell"])
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("set"), "buckets"))
    before = Window.partitionBy("region", "cell", "bucket").orderBy("weight", "set").rowsBetween(Window.unboundedPreceding, -1)
    step = F.greatest(F.lit(most / 2) - F.col("widest"), F.lit(most / 4))
    part = F.floor(F.coalesce(F.sum("weight").over(before), F.lit(0)) / step)
    placed = placed.withColumn("block", F.struct("cell", "bucket", part.alias("part")))
    placed = materialize(placed.select("region", "block", "set", "weight", "known", "distance"), "blocks")

    ranges = {"n": F.col("weight"), "root": F.col("known")} | {f"d{k}": F.get("distance", F.lit(k)) for k in range(PIVOTS)}
    blocks = placed.groupBy("region", "block").agg(*[f(c).alias(f"{k}_{end}") for k, c in ranges.items() for f, end in ((F.min, "low"), (F.max, "high"))])
    blocks = materialize(blocks, "ranges")
    x, y, radius = blocks.alias("x"), blocks.alias("y"), 1 - percent / 100 + 1e-9
    near = (F.col("x.region") == F.col("y.region")) & (F.col("x.block") <= F.col("y.block"))
    near &= F.least("x.root_low", "y.root_low") != F.greatest("x.root_high", "y.root_high")
    near &= (100 * F.col("x.n_high") >= percent * F.col("y.n_low")) & (100 * F.col("y.n_high") >= percent * F.col("x.n_low"))
    for k in range(PIVOTS):  # a region of fewer pivots has no distance to the others
        apart = F.greatest(F.col(f"x.d{k}_low") - F.col(f"y.d{k}_high"), F.col(f"y.d{k}_low") - F.col(f"x.d{k}_high"))
        near &= F.coalesce(apart <= radius, F.lit(True))
    pairs = x.join(y, near).select(F.col("x.region").alias("region"), F.col("x.block").alias("x"), F.col("y.block").alias("y"))
    pairs = materialize(pairs.withColumn("task", F.monotonically_increasing_id()), "pairs")
    sides = pairs.select("region", F.col("x").alias("block"), "task", F.lit(0).alias("side"))
    sides = sides.unionAll(pairs.where("x != y").select("region", F.col("y").alias("block"), "task", F.lit(1).alias("side")))
    return placed.join(sides, ["region", "block"]).select("task", "side", "set", "known")


def _large_links(held: DataFrame, rows: DataFrame, percent: int, most: int) -> list[DataFrame]:
    """Tables of a, b: edges that connect the same sets as all links of the sets in ``held``.

    Two linked sets share a signature (``rows``), so each signature is a region; signatures of the
    same sets are one. First every set is compared with one set of each of its
    regions, the same one for many regions of a dense family, and regions whose sets are then
    all connected are settled. What is left is joined in one task per region, or per pair of
    blocks of a region that is too large for that.
    """
    held = materialize(held, "held")
    hashes = (F.xxhash64("set"), F.xxhash64("set", F.lit(1)))
    named = rows.join(held.select("set"), "set", "left_semi").groupBy("signature").agg(
        F.count("*").alias("n"), *[F.bit_xor(h).alias(f"h{k}") for k, h in enumerate(hashes)]
    )
    named = named.where("n > 1").groupBy("n", "h0", "h1").agg(F.min("signature").alias("signature")).select("signature")
    rows = rows.join(named, "signature", "left_semi").join(held.select("set", (F.length("shingles") / 8).cast("long").alias("weight")), "set")
    rows = materialize(rows.select(F.col("signature").alias("region"), "set", "weight", F.col("set").alias("known")), "members")
    edges = held.sparkSession.createDataFrame([], "a long, b long")
    for turn in range(TIES):
        first = F.min(F.struct(F.xxhash64("set", F.lit(turn)), "set", "known")).alias("p")
        pivots = rows.groupBy("region").agg(first).select("region", F.col("p.set").alias("pivot"), F.col("p.known").alias("own"))
        pairs = rows.join(pivots, "region").where("known != own").select(F.col("pivot").alias("region"), "set").distinct()
        pairs = materialize(pairs, "pairs")
        pivots = pairs.select("region").distinct().select("region", F.lit(1).alias("nr"), F.col("region").alias("set"))
        edges = materialize(edges.unionAll(_linked(_distances(pairs, pivots, held, percent))), "ties")
        rows = _open(rows, edges)
        if rows.isEmpty():
            return [edges]
    large = rows.groupBy("region").agg(F.sum("weight").alias("held")).where(F.col("held") > most).select("region")
    large = bounded(materialize(large, "large"))
    out = [edges, _tasks(rows.join(large, "region", "left_anti").select(F.col("region").alias("task"), "set", "known").join(held, "set"), percent)]
    rows = materialize(rows.join(large, "region", "left_semi"), "rest")
    if not rows.isEmpty():
        order = Window.partitionBy("region").orderBy(F.xxhash64("set", F.lit(TIES)), "set")
        pivots = rows.withColumn("nr", F.row_number().over(order)).where(F.col("nr") <= PIVOTS).select("region", "nr", "set")
        found = materialize(_distances(rows.select("region", "set"), pivots, held, percent), "distances")
        more = materialize(edges.unionAll(_linked(found)), "ties")
        rows = _open(rows, more)
        out += [_linked(found), _tasks(_block_pairs(rows, found, percent, most).join(held, "set"), percent)]
    return out


def _tasks(rows: DataFrame, percent: int) -> DataFrame:
    return rows.groupBy("task").applyInPandas(lambda rows: _joined(percent)(rows), "a long, b long")


def _links(regions: DataFrame, signatures: DataFrame, percent: int, most: int) -> DataFrame:
    """a, b: edges that connect the same sets as all links of all families."""
    sizes = regions.groupBy("region").agg(F.sum(F.length("shingles") / 8).alias("weight"))
    large = materialize(sizes.where(F.col("weight") > most).select("region"), "large")
    tasks = regions.select(F.col("region").alias("task"), "set", "shingles")
    if large.isEmpty():
        edges = [_tasks(tasks, percent)]
    else:
        large = large.withColumnRenamed("region", "task")
        edges = [_tasks(tasks.join(large, "task", "left_anti"), percent)]
        edges += _large_links(tasks.join(large, "task", "left_semi").select("set", "shingles"), signatures, percent, most)
    out = edges[0]
    for more in edges[1:]:
        out = out.unionAll(more)
    return materialize(out.where("a != b").distinct(), "links")


def jaccard_components(
    docs: DataFrame, size: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text", region_shingles: int = REGION_SHINGLES
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    Two documents are linked when ``100 * intersection >= percent * union`` of their distinct
    shingles of ``size`` words (A-Z in lower case; a shorter text is one shingle);
    ``component_id`` is the smallest id that links reach.

    Equal sets are one set. In sparse text the Jaccard distance from nearly every document to any
    other is one, so documents as pivots would tell nothing apart; the first regions therefore
    hang on signatures: the shingles of a set are dealt into more parts than two partners can
    differ in, so no partner can miss all of them. Sets that signatures chain are a family. Families of up to
    ``region_shingles`` are joined in one task each, exactly, pivot by pivot. In a larger family
    every set goes to the regions of its own signatures instead, and a region that is still larger
    is joined by pairs of bounded blocks, which the distances to pivots spare by the triangle
    inequality. No task holds more. Links are not listed as pairs: each set is tied to the root of
    its task's sets, and components are taken over these ties.

    Texts without words (or null) have no shingles, no links and their own id. A null id names no
    component unless all its members' ids are null. Repeated rows get equal results. Shingles are
    compared as 64-bit hashes, whole sets as 128-bit ones. Other columns are not read.
    """
    texts = docs.select(docs[id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    sets = materialize(_described(texts, size, percent), "sets")
    classes = sets.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("first_id"))
    classes = materialize(classes.withColumn("set", F.monotonically_increasing_id()), "classes")
    families, signatures = _families(sets)
    families = materialize(families, "families")
    wanted = classes.join(families, F.col("k1") == F.col("name")).select(
        "set", "family", "k1", "k2", F.coalesce("first_id", F.lit(-(1 << 63))).alias("first_id")
    )
    wanted = materialize(wanted, "wanted")
    signatures = signatures.join(wanted.select(F.col("k1").alias("name"), "set"), "name").select("signature", "set")

    def collect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = shingle_sets(part.column(1), size)
            blobs = pa.array([x.tobytes() for x in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([*_names(sets), blobs], ["k1", "k2", "shingles"])

    owners = bounded(materialize(wanted.select("first_id").distinct(), "owners"))
    held = texts.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("first_id"), "text").join(owners, "first_id", "left_semi")
    held = held.select("first_id", "text").mapInArrow(collect, "k1 long, k2 long, shingles binary")
    regions = held.join(wanted.select("k1", "k2", "set", F.col("family").alias("region")), ["k1", "k2"]).dropDuplicates(["set"])
    regions = materialize(regions.select("region", "set", "shingles"), "regions")
    roots = components(_links(regions, signatures, percent, region_shingles))

    tied = classes.select("k1", "k2", "set", "first_id").join(roots, F.col("set") == F.col("node"), "left")
    tied = tied.select("k1", "k2", "first_id", F.coalesce("root", "set").alias("root"))
    smallest = tied.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = tied.join(smallest, "root").select("k1", "k2", "component_id")
    out = sets.select("doc_id", "n", "k1", "k2").join(named, ["k1", "k2"], "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def keep_first(docs: DataFrame, id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One row of each component of ``docs``, with all its columns: that of the smallest id.

    If ids are missing or occur twice, the rows are numbered and the smallest number stays. Rows
    without words are linked with nothing and all stay.
    """
    ids = docs.groupBy(id).count()
    if not ids.where((F.col("count") > 1) | F.col(id).isNull()).isEmpty():
        row = free_name(docs, "_row")
        docs = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
        return keep_first(docs, row, text, **settings).drop(row)
    found = materialize(jaccard_components(docs, id=id, text=text, **settings), "components")
    name = free_name(docs, "_gone")
    gone = materialize(found.where("doc_id != component_id").select(F.col("doc_id").alias(name)), "gone")
    return docs.join(bounded(gone), docs[id] == F.col(name), "left_anti")
