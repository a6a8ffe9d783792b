"""Words and lines of Arrow batches as numpy arrays; the helpers that run inside tasks."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Text that is worked on at once. A longer document is worked on alone.
SLICE_BYTES = 8 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


#: Text that Spark hands to a Python worker at once; a single longer text still comes whole.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Have Spark bound Arrow batches by bytes too, not by rows alone: ten thousand long texts are far more than short ones."""
    held = spark.conf.get(_BATCH).removesuffix("b")
    # A value in other units was chosen by someone, and stays.
    if held.lstrip("-").isdecimal() and not 0 < int(held) <= BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def give_back() -> None:
    """Return memory that is not in use to the system; workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the usual C library has it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in parts of a bounded size, a null text as an empty one."""
    for batch in batches:
        at = batch.schema.get_field_index(text)
        texts = pc.fill_null(batch.column(at), "")
        batch = batch.set_column(at, text, texts)
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        low = 0
        while low < len(ends):
            done = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, done + most, "right")))
            yield batch.slice(low, high - low)
            low = high
    give_back()


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Codes of all words in order, where each text's words end and begin, and the distinct words.

    Words are runs of anything but the ASCII blanks 0x20 and 0x09 to 0x0D.
    """
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    offsets = np.concatenate(([0], np.cumsum(full, dtype=np.int64)))[bounds]
    words = flat.filter(pa.array(full)).dictionary_encode()
    return words.indices.to_numpy(zero_copy_only=False), offsets, words.dictionary


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of each text's values."""
    return np.diff(np.concatenate(([0], np.cumsum(values, dtype=np.int64)))[offsets])


def owners(offsets: np.ndarray) -> np.ndarray:
    """For each word the number of its text."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def mixed(values: np.ndarray) -> np.ndarray:
    """Well spread 64-bit numbers, equal for equal values."""
    x = values.astype(np.uint64, copy=True)
    x += _ODD
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def gram_hashes(symbols: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` symbols, by joining runs of doubled length."""
    if len(symbols) < length:
        return np.empty(0, np.uint64)
    out, have, rest, size = None, 0, symbols, 1
    while True:
        if length & size:
            if out is None:
                out, have = rest, size
            else:
                n = len(symbols) - (have + size) + 1
                out = rest[:n] * _power(have) + out[size : size + n]
                have += size
        size *= 2
        if size > length:
            return out[: len(symbols) - length + 1]
        rest = rest[: len(rest) - size // 2] * _power(size // 2) + rest[size // 2 :]


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_ODD), n, 1 << 64))


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of each run, one run after the other."""
    total = int(lengths.sum())
    firsts = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - firsts, lengths)
