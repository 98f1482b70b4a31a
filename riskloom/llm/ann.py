"""Nearest neighbours by cosine from randomly rotated one-bit codes.

Every vector is normalised, rotated by a random orthogonal matrix (seeded) and kept as the signs of its coordinates,
packed eight to a byte, with one correction scalar c, the inner product of the rotated vector with its code. For a
rotated query q the inner product is estimated as <code, q> / c, and the error stays within
``SIGMAS`` * sqrt((1 - c²) / c² / (d - 1)) but for a tiny share. In a block of vectors, a query reranks by exact cosine
every vector whose upper bound reaches the k-th greatest lower bound, so a block returns its k nearest.

The query set meets all rows in blocks: rows are dealt to blocks by a hash of their id, every block of queries is
copied to every block of rows, one task holds one of each. Blocks have a bounded number of rows, whatever the input.

Vectors that are null, empty or zero, or hold null or non-finite components, and rows without vec_id take no part; vectors
of different length are never compared; a repeated query id is searched once; a candidate with the query's own id is left
out; repeated candidates are ranked each; ties go to the smaller vec_id; an empty table gives an empty result. Columns
other than vec_id and embedding are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import arrow_map
from riskloom.session import ship_package, stored

SIGMAS = 3.0
SEED = 20250101
BLOCK_ROWS = 4096
CODED = "vec_id long, dim int, vector binary, code binary, factor double, rotated binary"


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED + dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, correction scalars, rotated unit vectors) of rows."""
    dim = vectors.shape[1]
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    rotated = unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True)) @ rotation(dim)
    return np.packbits(rotated > 0, axis=1), np.abs(rotated).sum(axis=1) / np.sqrt(dim), rotated


def estimates(codes: np.ndarray, factors: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(queries x rows) estimated inner products and their error bounds per row."""
    dim = queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    guess = (queries.astype(np.float32) @ signs.T) / (np.sqrt(dim) * factors).astype(np.float32)
    bound = SIGMAS * np.sqrt(np.maximum(1 - factors**2, 0) / factors**2 / max(dim - 1, 1)) + 1e-5
    return guess, bound


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of matching rows, in double precision; equal rows give equal values."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def search_block(
    ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray, factors: np.ndarray,
    query_ids: np.ndarray, query_vectors: np.ndarray, rotated: np.ndarray, k: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query: (query id, ids, scores) of its k nearest in the block."""
    for at in range(0, len(query_ids), 256):
        guess, bound = estimates(codes, factors, rotated[at : at + 256])
        for i, row in enumerate(guess):
            own = ids == query_ids[at + i]
            low = np.where(own, -np.inf, row - bound)
            least = np.partition(low, -k)[-k] if len(low) > k else -np.inf
            chosen = np.flatnonzero((row + bound >= least) & ~own)
            query = np.broadcast_to(query_vectors[at + i], (len(chosen), query_vectors.shape[1]))
            score = cosine(vectors[chosen], query)
            best = np.lexsort((ids[chosen], -score))[:k]
            yield int(query_ids[at + i]), ids[chosen][best], score[best]


def coded(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Code every usable vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, sizes = batch.column(1), batch.column(1).value_lengths().to_numpy()
            ids = batch.column(0).to_numpy()
            flat = values.flatten().to_numpy()
            starts = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes):
                mine = np.flatnonzero(sizes == dim)
                vectors = flat[starts[mine][:, None] + np.arange(dim)]
                codes, factors, rotated = encode(vectors)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[mine]), pa.array(np.full(len(mine), dim, np.int32)), _blobs(vectors), _blobs(codes),
                    pa.array(factors), _blobs(rotated),
                ], [c.split()[0] for c in CODED.split(", ")])

    vector: Column = F.col(vector_column).cast("array<double>")
    usable = rows.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("v")).where(
        "vec_id is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('inf'))"
        " and exists(v, x -> x != 0)"
    )
    return arrow_map(usable, run, CODED)


def _blobs(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())


def _matrix(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.array([np.frombuffer(x, kind) for x in column.to_pylist()])


def nearest(rows: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows of every row for which ``is_query`` holds."""
    spark = rows.sparkSession
    ship_package(spark)
    table = stored(coded(rows), "codes")
    asked = table.where(is_query).dropDuplicates(["vec_id"])
    n_rows, n_asked = table.count(), asked.count()
    row_blocks, query_blocks = max(1, -(-n_rows // BLOCK_ROWS)), max(1, -(-n_asked // BLOCK_ROWS))

    def copied(df: DataFrame, mine: int, others: int, first: bool) -> DataFrame:
        own = F.pmod(F.xxhash64("vec_id"), F.lit(mine)).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return df.withColumn("a", own if first else other).withColumn("b", other if first else own)

    left = copied(table.drop("rotated"), row_blocks, query_blocks, True)
    right = copied(asked.drop("code", "factor"), query_blocks, row_blocks, False)

    def run(block: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if block.num_rows and queries.num_rows:
            args = (block.column("vec_id").to_numpy(), _matrix(block.column("vector"), np.float64),
                    _matrix(block.column("code"), np.uint8), block.column("factor").to_numpy(),
                    queries.column("vec_id").to_numpy(), _matrix(queries.column("vector"), np.float64),
                    _matrix(queries.column("rotated"), np.float64), k)
            for query, ids, scores in search_block(*args):
                found += [(query, i, s) for i, s in zip(ids.tolist(), scores.tolist())]
        columns = list(zip(*found)) or [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "vec_id", "score"), columns, kinds)})

    keys = ("a", "b", "dim")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
