"""Helpers shared by the corpus operators: Arrow mapping in bounded pieces, numpy word hashes, shuffle clean-up."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import time
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from riskloom.session import ship_package

#: Bytes of text a Python worker vectorises at once; its arrays take a multiple of this.
PIECE_BYTES = 2 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def arrow_map(df: DataFrame, func: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow``; the Python worker gives back what a task has freed before it waits for the next one."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from func(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory of this process to the system; allocators otherwise keep it for later."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only some C libraries have it
        ctypes.CDLL(None).malloc_trim(0)


def pieces(batches: Iterable[pa.RecordBatch], text: int, most: int = PIECE_BYTES) -> Iterator[list[list]]:
    """Columns of the rows as lists, cut so that column ``text`` holds about ``most`` characters; null texts become ''."""
    for batch in batches:
        sizes = pc.fill_null(pc.utf8_length(batch.column(text)), 0).to_pylist()
        start = size = 0
        for i, more in enumerate(sizes):
            size += more
            if size >= most or i == len(sizes) - 1:
                part = batch.slice(start, i + 1 - start)
                yield [[x or "" for x in c.to_pylist()] if k == text else c.to_pylist() for k, c in enumerate(part.columns)]
                start, size = i + 1, 0


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames nobody refers to any more.

    Spark's cleaner works beside the driver, and some references go only after others are gone, hence the repetition.
    """
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values over all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    found = _POWERS.get(base)
    if found is None or len(found) < n:
        found = np.full(max(n, 1 << 16), base & (2**64 - 1), np.uint64)
        found[0] = 1
        with np.errstate(over="ignore"):
            found = np.multiply.accumulate(found)
        _POWERS[base] = found
    return found[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums modulo 2**64 of bytes; see :func:`span_hashes`."""
    with np.errstate(over="ignore"):
        sums = (data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data))
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(sums, dtype=np.uint64)])


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end); equal bytes give equal hashes wherever they stand."""
    with np.errstate(over="ignore"):
        return mix64((prefix[end] - prefix[start]) * _powers(pow(_BASE, -1, 1 << 64), len(prefix))[start])


def window_hashes(prefix: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of the ``width`` bytes at every position, without the spreading of low bits; high bits are good."""
    if len(prefix) <= width:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = prefix[width:] - prefix[:-width]
        out *= _powers(pow(_BASE, -1, 1 << 64), len(prefix))[: len(out)]
        out *= np.uint64(0xD6E8FEB86659FD93)
    return out


def column_hashes(rows: np.ndarray) -> np.ndarray:
    """Prefix sums of equally long rows of bytes, one line per column; see :func:`column_window`."""
    n, width = rows.shape
    powers = _powers(_BASE, width)
    out = np.zeros((width + 1, n), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            np.add(out[k], (rows[:, k].astype(np.uint64) + np.uint64(1)) * powers[k], out=out[k + 1])
    return out


def column_window(sums: np.ndarray, start: int, end: int, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
    """Hashes of the bytes [start, end) of rows; comparable for all starts."""
    with np.errstate(over="ignore"):
        return mix64((sums[end, rows] - sums[start, rows]) * _powers(pow(_BASE, -1, 1 << 64), start + 1)[start])


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Word characters for content comparison: ASCII letters and digits and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
for _lo, _hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
    ALNUM[_lo:_hi] = True


def words_of(texts: list[bytes], is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts at once: (joined bytes, start, end, index of the text, 64-bit hash); words never cross texts."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    inside = np.concatenate([[False], is_word[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    return data, start, end, np.searchsorted(ends, start, side="right"), span_hashes(prefix_hashes(data), start, end)


def shingles_of(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word shingles that start at each word but the last n-1."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(len(words) - n + 1, np.uint64)
        for k in range(n):
            out = out * np.uint64(0x100000001B3) + words[k : len(words) - n + 1 + k]
    return mix64(out)


def groups(batches: Iterable[pa.RecordBatch], key: int) -> Iterator[tuple[object, pa.Table]]:
    """Consecutive rows with the same value in column ``key`` of sorted input, across batch borders."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if held and keys[a] != held_key:
                yield held_key, pa.Table.from_batches(held)
                held = []
            held_key = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield held_key, pa.Table.from_batches(held)
