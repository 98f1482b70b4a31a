"""Near duplicates by SimHash: BK-trees over shards of fingerprints, then connected components.

Fingerprints are compared once per different value. Two values within radius r agree in at least one of r+1 blocks of
bits, so a shard is (block, value of the block) and every link lies in some shard. A shard with too many values is cut
again by r+1 blocks of its remaining bits, which keeps every link. Each shard builds one BK-tree, whose children are
keyed by the integer Hamming distance to their parent, in the task that also asks it; a query follows only the edges
within the radius. A shard returns one link per value to its local component, never all pairs, and the links are joined
to components by repeated large-star and small-star steps over stored tables.

Nulls count as empty text and share fingerprint zero; repeated rows share a fingerprint; an empty table gives an empty
result; a component without any doc_id gets null. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import arrow_map, free_shuffles, groups, pieces
from riskloom.session import stored

#: Different fingerprints a shard may hold before it is cut again.
SHARD_LIMIT = 20_000
#: How often shards are cut.
SHARD_LEVELS = 3


def fingerprint_of(text: str, shingle: int) -> np.ndarray:
    """64-bit hashes of all word shingles of one text."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e], 42) for s, e in zip(starts[:n].tolist(), last.tolist())), np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4, row: str | None = None) -> DataFrame:
    """(doc_id, fp long) of every row, and its key if ``row`` names the column."""
    names = ["doc_id", "fp", "row"] if row else ["doc_id", "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, *keys in pieces(batches, 1):
            fps = np.array([majority(fingerprint_of(t, shingle)) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(fps), *[pa.array(k, pa.int64()) for k in keys]], names)

    columns = [F.col("doc_id").cast("long"), F.col("text").cast("string"), *([F.col(row)] if row else [])]
    return arrow_map(docs.select(*columns), run, ", ".join(f"{n} long" for n in names))


class BkTree:
    """Integers by Hamming distance; ``near`` follows only edges that can lead to values within the radius."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.edges: list[dict[int, int]] = []

    def near(self, value: int, radius: int) -> list[int]:
        found, open_nodes = [], [0] if self.values else []
        values, edges = self.values, self.edges
        while open_nodes:
            node = open_nodes.pop()
            d = (values[node] ^ value).bit_count()
            if d <= radius:
                found.append(node)
            low, high = d - radius, d + radius
            open_nodes += [child for k, child in edges[node].items() if low <= k <= high]
        return found

    def add(self, value: int) -> None:
        """Insert a value that is not in the tree."""
        new = len(self.values)
        self.values.append(value)
        self.edges.append({})
        node = 0
        while node != new:
            node = self.edges[node].setdefault((self.values[node] ^ value).bit_count(), new)


def _block_masks(radius: int) -> list[list[int]]:
    """Masks per level; path p of one level leads to paths p*(radius+1)+j of the next."""
    parts = radius + 1
    levels = [[0]]
    for _ in range(SHARD_LEVELS):
        level = []
        for mask in levels[-1]:
            rest = [b for b in range(64) if not mask >> b & 1]
            for j in range(parts):
                mine = rest[j * len(rest) // parts : (j + 1) * len(rest) // parts]
                level.append(mask | sum(1 << b for b in mine))
        levels.append(level)
    return levels[1:]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _shards(fps: DataFrame, radius: int) -> DataFrame:
    """(shard, fp): every pair of values within the radius shares a shard."""
    parts = radius + 1
    done = []
    rows = fps.select("fp", F.lit(0).alias("path"))
    levels = _block_masks(radius)
    for level, masks in enumerate(levels):
        lookup = F.array(*[F.lit(_signed(m)) for m in masks])
        path = F.explode(F.array(*[F.col("path") * parts + j for j in range(parts)]))
        keyed = rows.select("fp", path.alias("path")).select(
            "fp", "path", F.xxhash64("path", F.col("fp").bitwiseAND(F.get(lookup, F.col("path")))).alias("shard")
        )
        if level == len(levels) - 1:
            done.append(keyed.select("shard", "fp"))
            break
        large = stored(keyed.groupBy("shard").count().where(F.col("count") > SHARD_LIMIT).select("shard"), "large-shards")
        if large.isEmpty():
            done.append(keyed.select("shard", "fp"))
            break
        done.append(keyed.join(large, "shard", "left_anti").select("shard", "fp"))
        rows = keyed.join(large, "shard", "left_semi").select("fp", "path")
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    return out


def links(fps: DataFrame, radius: int) -> DataFrame:
    """(a, b) between different values of ``fps``: enough links to connect all values within the radius."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_a: list[int] = []
        out_b: list[int] = []
        for _, rows in groups(batches, 0):
            if rows.num_rows < 2:
                continue
            tree, top = BkTree(), []

            def root(i: int, top: list[int] = top) -> int:
                while top[i] != i:
                    top[i] = top[top[i]]
                    i = top[i]
                return i

            for new, value in enumerate(rows.column(1).to_numpy().view(np.uint64).tolist()):
                top.append(new)
                for other in tree.near(value, radius):
                    a, b = root(other), root(new)
                    top[max(a, b)] = min(a, b)
                tree.add(value)
            for i, value in enumerate(tree.values):
                if (r := root(i)) != i:
                    out_a.append(value)
                    out_b.append(tree.values[r])
            if len(out_a) > 50_000:
                yield _pairs(out_a, out_b)
                out_a, out_b = [], []
        yield _pairs(out_a, out_b)

    sharded = _shards(fps, radius).repartition("shard").sortWithinPartitions("shard")
    return arrow_map(sharded, run, "a long, b long").distinct()


def _pairs(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)], ["a", "b"])


def component_roots(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; the root is the smallest node of its component."""
    ordered = edges.where("a != b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("low")).distinct()
    state = stored(ordered, "links")
    mark = None
    while True:
        both = state.unionAll(state.select(F.col("low").alias("node"), F.col("node").alias("low")))
        least = both.groupBy("node").agg(F.min("low").alias("m")).select("node", F.least("node", "m").alias("m"))
        large = both.join(least, "node").where("low > node").select(F.col("low").alias("node"), F.col("m").alias("low")).distinct()
        least = large.groupBy("node").agg(F.min("low").alias("m"))
        small = large.join(least, "node").select(F.explode(F.array(
            F.struct(F.col("low").alias("node"), F.col("m").alias("low")), F.struct("node", F.col("m").alias("low"))
        )).alias("x")).select("x.*").where("node != low").distinct()
        state = stored(small, "links")
        now = state.agg(F.count("*"), F.sum(F.xxhash64("node", "low").cast("decimal(38,0)"))).first()
        if now == mark:
            return state.select("node", F.col("low").alias("root"))
        mark = now


def simhash_components(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp long, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    printed = stored(fingerprints(docs, shingle), "fingerprints")
    free_shuffles(docs.sparkSession)
    values = stored(printed.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "values")
    roots = component_roots(links(values.select("fp"), radius))
    rooted = values.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = stored(rooted.join(least, "root").select("fp", "component_id"), "labels")
    return printed.join(labels, "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, the one with the smallest doc_id.

    Rows are told apart by a key of their own, so a repeated doc_id neither joins nor splits a group; among rows with the
    same smallest doc_id the first stays. Rows without doc_id are compared only with each other: one of each group stays.
    """
    row = "_row"
    while row in {c.lower() for c in docs.columns}:
        row += "_"
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    printed = stored(fingerprints(rows, shingle, row), "fingerprints")
    free_shuffles(docs.sparkSession)
    first = F.min(F.struct("doc_id", "row")).alias("first")
    values = stored(printed.groupBy("fp", F.col("doc_id").isNull().alias("no_id")).agg(first), "values")
    roots = component_roots(links(values.select("fp").distinct(), radius))
    rooted = values.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(F.coalesce("root", "fp").alias("root"), "no_id", "first")
    kept = rooted.groupBy("root", "no_id").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    # the kept rows grow with the documents: one plan at every size, never a broadcast
    return rows.join(stored(kept, "kept").hint("merge"), row, "left_semi").select(*docs.columns)
