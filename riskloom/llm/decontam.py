"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

Words are runs of letters and digits in lower case. An item of n words is compared with every window of n words of a
document (the whole document if it is shorter) that holds at least one of its five-word shingles; all other windows
have similarity 0. A window has a fingerprint of 128 bits over its shingles. Fingerprints within ``RADIUS`` bits differ
in at most RADIUS // 8 bits in one of eight 16-bit blocks, so the index lists each item under all block values within
that many bits, and a lookup of the eight blocks returns every item within the radius. Survivors are verified by the
weighted Jaccard similarity of the shingle multisets, 0.8 or more.

The benchmark is read in shards of at most ``SHARD_ITEMS`` items and ``SHARD_BYTES`` of text, one broadcast index and one
pass over the documents each, so the index never outgrows its bound.

Null and empty texts match nothing; items of fewer than five words have one shingle, the whole item; items without
words match nothing; repeated rows give repeated results; ties go to the first window; empty tables give an empty result.
Columns other than doc_id, item_id and text are only carried by ``drop_leaks``.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ALNUM, arrow_map, mix64, pieces, shingles_of, words_of

SHINGLE = 5
SIMILARITY = 0.8
#: Expected distance at the similarity is 19.4 of 128 bits with a deviation of 4.
RADIUS = 39
BLOCKS = 8
SHARD_ITEMS = 5_000
SHARD_BYTES = 16 << 20
#: Windows whose fingerprints are made at once.
SPAN = 8192


def bits_of(shingles: np.ndarray) -> np.ndarray:
    """Rows of 128 votes, +1 or -1."""
    with np.errstate(over="ignore"):
        two = np.stack([shingles, mix64(shingles + np.uint64(0x9E3779B97F4A7C15))], axis=1)
    return np.unpackbits(two.view(np.uint8).reshape(len(shingles), 16), axis=1).astype(np.int8) * 2 - 1


def window_prints(shingles: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints (eight 16-bit blocks) of all windows of n consecutive shingles."""
    sums = np.concatenate([np.zeros((1, 128), np.int32), np.cumsum(bits_of(shingles), axis=0, dtype=np.int32)])
    return np.packbits(sums[n:] > sums[:-n], axis=1).view(np.uint16)


def weighted_similarity(a: Counter, b: Counter) -> float:
    shared = sum(min(n, b[k]) for k, n in a.items() if k in b)
    return shared / (sum(a.values()) + sum(b.values()) - shared)


class Items:
    """Index of one shard of items."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.ids: list[int] = []
        self.words: list[int] = []
        self.bags: list[Counter] = []
        prints = []
        self.by_shingle: dict[int, dict[int, list[int]]] = {}
        for item_id, text in items:
            _, _, _, _, words = words_of([(text or "").lower().encode()], ALNUM)
            if not len(words):
                continue
            k = min(SHINGLE, len(words))
            shingles = shingles_of(words, k)
            prints.append(window_prints(shingles, len(shingles))[0])
            where = self.by_shingle.setdefault(k, defaultdict(list))
            for s in set(shingles.tolist()):
                where[s].append(len(self.ids))
            self.ids.append(item_id)
            self.words.append(len(words))
            self.bags.append(Counter(shingles.tolist()))
        self.prints = np.array(prints, np.uint16).reshape(-1, BLOCKS)
        self.maps = {}
        for k, where in self.by_shingle.items():
            bitmap = np.zeros(1 << 20, bool)
            bitmap[np.array(list(where), np.uint64) & np.uint64((1 << 20) - 1)] = True
            self.maps[k] = bitmap
        near = [0]
        for r in range(1, RADIUS // BLOCKS + 1):
            near += [sum(1 << b for b in bits) for bits in combinations(range(16), r)]
        self.near = np.array(near, np.uint16)
        self.lists: dict[tuple[int, int], tuple] = {}

    def _blocks(self, n_words: int, k: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per block, sorted values within reach of an item of that many words, with the items."""
        if (n_words, k) not in self.lists:
            items = np.array([i for i, n in enumerate(self.words) if n == n_words], np.int64)
            made = []
            for b in range(BLOCKS):
                values = (self.prints[items, b][:, None] ^ self.near[None, :]).ravel()
                owner = np.repeat(items, len(self.near))
                order = np.argsort(values, kind="stable")
                starts = np.searchsorted(values[order], np.arange((1 << 16) + 1))
                made.append((starts, owner[order]))
            self.lists[n_words, k] = made
        return self.lists[n_words, k]

    def lookup(self, prints: np.ndarray, n_words: int, k: int) -> set[tuple[int, int]]:
        """(row of ``prints``, item of that many words) within the radius."""
        found = set()
        for b, (starts, owner) in enumerate(self._blocks(n_words, k)):
            low, high = starts[prints[:, b]], starts[prints[:, b].astype(np.int64) + 1]
            count = high - low
            rows = np.repeat(np.arange(len(prints)), count)
            places = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
            items = owner[places]
            distance = np.bitwise_count(prints[rows] ^ self.prints[items]).sum(axis=1)
            close = distance <= RADIUS
            found.update(zip(rows[close].tolist(), items[close].tolist()))
        return found

    def matches(self, texts: list[str]) -> list[dict[int, tuple[float, int, int]]]:
        """Per text: item -> (best similarity, first word, words) of windows at SIMILARITY or more."""
        out: list[dict[int, tuple[float, int, int]]] = [{} for _ in texts]
        _, _, _, which, words = words_of([t.lower().encode() for t in texts], ALNUM)
        first = np.searchsorted(which, np.arange(len(texts) + 1))
        for k, where in self.by_shingle.items():
            shingles = shingles_of(words, k)
            if not len(shingles):
                continue
            valid = which[: len(shingles)] == which[k - 1 :]
            hit = np.flatnonzero(self.maps[k][shingles & np.uint64((1 << 20) - 1)] & valid)
            spots: dict[tuple[int, int], list[int]] = defaultdict(list)  # (text, words of the item) -> anchors
            for p, s in zip(hit.tolist(), shingles[hit].tolist()):
                for n in {self.words[i] for i in where.get(s, ())}:
                    spots[int(which[p]), n].append(p)
            for (t, n), anchors in spots.items():
                self._compare(out[t], shingles, k, n, anchors, int(first[t]), int(first[t + 1]))
        return out

    def _compare(self, best: dict, shingles: np.ndarray, k: int, n: int, anchors: list[int], begin: int, end: int) -> None:
        size = min(n, end - begin)
        starts = np.unique(np.concatenate([np.arange(max(begin, a + k - size), min(a, end - size) + 1) for a in anchors]))
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
            for at in range(int(run[0]), int(run[-1]) + 1, SPAN):
                to = min(at + SPAN, int(run[-1]) + 1)
                m = size - k + 1
                prints = window_prints(shingles[at : to + m - 1], m)
                for row, item in sorted(self.lookup(prints, n, k)):
                    bag = Counter(shingles[at + row : at + row + m].tolist())
                    similarity = weighted_similarity(bag, self.bags[item])
                    if similarity >= SIMILARITY and similarity > best.get(item, (0.0,))[0]:
                        best[item] = (similarity, at + row - begin, size)


def shards(benchmark: DataFrame) -> Iterator[Broadcast]:
    """Broadcast lists of (item_id, text), each within the bounds."""
    rows = benchmark.select(F.col("item_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    items, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n = max(-(-items // SHARD_ITEMS), -(-size // SHARD_BYTES))
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield rows.sparkSession.sparkContext.broadcast([tuple(r) for r in part.collect()])


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity, start_word, n_words): best window of every document for every item it holds."""
    schema = "doc_id long, item_id long, similarity double, start_word long, n_words long"

    def finder(shard: Broadcast):  # noqa: ANN202
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Items(shard.value)
            for ids, texts in pieces(batches, 1):
                rows = [
                    (doc_id, index.ids[i], *m) for doc_id, found in zip(ids, index.matches(texts)) for i, m in found.items()
                ]
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                    yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])

        return run

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = None
    for shard in shards(benchmark):
        found = arrow_map(rows, finder(shard), schema)
        out = found if out is None else out.unionAll(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark passage."""
    place = docs.columns.index("text")

    def keeper(shard: Broadcast):  # noqa: ANN202
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Items(shard.value)
            for batch in batches:
                clean: list[bool] = []
                for (texts,) in pieces([batch.select([place])], 0):
                    clean += [not found for found in index.matches(texts)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return run

    out = docs
    for shard in shards(benchmark):
        out = arrow_map(out, keeper(shard), docs.schema)  # type: ignore[arg-type]
    return out
