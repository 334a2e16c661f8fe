"""Approximate nearest neighbours by multi-index hashing of learned rotated binary codes.

Codes: vectors, centred, are turned by rotations learned on a bounded sample
(alternating between signs and the rotation that fits them best), and the signs
are the bits.  Each block of vectors indexes its codes by substrings.  Two codes
within Hamming radius r agree within r // m bits in one of m substrings at
least, so probing all substring values that near retrieves every code within r;
the codes are compared whole, and the vectors that remain are ranked by their
cosine in double precision.  r is what the sample's nearest neighbours need.

Queries and vectors meet in cells of one block each, so a task holds at most
about ``block_rows`` vectors and ``query_rows`` queries, and a query's best from
all blocks, ``k`` from each, meet at the end.

Defined results: vectors that are null, zero or hold a null or a non-finite
component, and those of another length than the sample's most common one, take
no part, nor do rows without an id.  Rows that share an id count once, with the
smallest of their vectors.  A block with fewer than ``k`` codes within r gives
those of least Hamming distance beyond it, so a query lacks results only where
the table has fewer candidates.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_ONES = np.array([bin(x).count("1") for x in range(1 << 16)], np.uint8)


class Codes:
    """Rotations learned on a sample, and the radius that its nearest neighbours need."""

    def __init__(self, sample: np.ndarray, turns: int, rounds: int = 20, seed: int = 7, k: int = 5, share: float = 0.97, probes: int = 256):
        rng = np.random.default_rng(seed)
        self.mean = sample.mean(axis=0)
        centred = sample - self.mean
        dim = sample.shape[1]
        _, _, axes = np.linalg.svd(centred, full_matrices=False)
        axes = axes if axes.shape[0] == dim else np.eye(dim)
        self.rotations = []
        for _ in range(turns):
            turn, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
            reduced = centred @ axes.T
            for _ in range(rounds):
                u, _, v = np.linalg.svd(np.where(reduced @ turn >= 0, 1.0, -1.0).T @ reduced)
                turn = (u @ v).T
            self.rotations.append(axes.T @ turn)
        self.bits = -(-turns * dim // 16) * 16
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        codes = self.of(sample)
        need = []
        for q in range(min(probes, len(sample))):
            near = np.argsort(-(unit @ unit[q]))[: k + 1]
            need += _ONES[codes[near] ^ codes[q]].sum(axis=1).tolist()
        self.radius = int(np.quantile(need, share)) + 1

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """Codes as 16-bit substrings, one row for each vector."""
        bits = np.concatenate([(vectors - self.mean) @ r >= 0 for r in self.rotations], axis=1)
        packed = np.packbits(bits, axis=1)
        if packed.shape[1] % 2:
            packed = np.pad(packed, ((0, 0), (0, 1)))
        return np.ascontiguousarray(packed).view(np.uint16)


class Block:
    """The codes of a block, indexed by each substring."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.index = []
        for j in range(codes.shape[1]):
            order = np.argsort(codes[:, j], kind="stable")
            values, first = np.unique(codes[order, j], return_index=True)
            self.index.append((order, values, np.append(first, len(order))))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows of all codes within ``radius`` of ``code``."""
        near, hit = radius // len(self.index), np.zeros(len(self.codes), bool)
        for x, (order, values, first) in zip(code, self.index, strict=True):
            probed = np.flatnonzero(_ONES[values ^ x] <= near)
            size = first[probed + 1] - first[probed]
            hit[order[np.repeat(first[probed] - (np.cumsum(size) - size), size) + np.arange(size.sum())]] = True
        rows = np.flatnonzero(hit)
        return rows[_ONES[self.codes[rows] ^ code].sum(axis=1, dtype=np.int64) <= radius]

    def nearest_codes(self, code: np.ndarray, n: int) -> np.ndarray:
        return np.argsort(_ONES[self.codes ^ code].sum(axis=1, dtype=np.int64), kind="stable")[:n]


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().astype(np.float64).reshape(-1, dim)


def sound_vectors(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and vector (doubles) of the rows that take part, one for each id."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = embeddings.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector")).where(F.col("id").isNotNull() & F.col("vector").isNotNull())
    return rows.where(finite & F.exists("vector", lambda x: x != 0)).groupBy("id").agg(F.min("vector").alias("vector"))


def nearest(
    embeddings: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, turns: int = 4, sample_rows: int = 4096, block_rows: int = 4096, query_rows: int = 2048
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found to each row where ``is_query`` (on ``id``) holds.

    ``turns``: rotations, each of as many bits as a vector has components.  ``sample_rows``: rows the rotations and the
    radius are learned on, those of least hashed id; every row is indexed.
    """
    vectors = sound_vectors(embeddings, id_col, vector_col)
    sample = vectors.select("vector").orderBy(F.xxhash64("id"), "id").limit(sample_rows).toArrow().column("vector").to_pylist()
    schema = "query_id long, vec_id long, score double"
    if not sample:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sizes = np.array([len(v) for v in sample])
    dim = int(np.bincount(sizes).argmax())
    codes = Codes(np.array([v for v in sample if len(v) == dim], np.float64), turns, k=k)
    vectors = vectors.where(F.size("vector") == dim)
    queries = vectors.where(is_query)
    n, n_queries = vectors.count(), queries.count()
    blocks, query_blocks = max(1, -(-n // block_rows)), max(1, -(-n_queries // query_rows))
    each = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = vectors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("query_block", each(query_blocks))
    right = queries.withColumn("query_block", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int")).withColumn("block", each(blocks))

    def search(own: pa.Table, asked: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(own) and len(asked):
            ids, data = own.column("id").to_numpy(), _matrix(own.column("vector"), dim)
            norms = np.sqrt((data * data).sum(axis=1))
            block = Block(codes.of(data))
            wanted = _matrix(asked.column("vector"), dim)
            for query_id, vector, code in zip(asked.column("id").to_numpy(), wanted, codes.of(wanted), strict=True):
                rows = block.within(code, codes.radius)
                if (ids[rows] != query_id).sum() < k:
                    rows = block.nearest_codes(code, k + 1)
                rows = rows[ids[rows] != query_id]
                score = (data[rows] * vector).sum(axis=1) / (norms[rows] * np.sqrt((vector * vector).sum()))
                best = np.lexsort((ids[rows], -score))[:k]
                found.append((np.full(len(best), query_id), ids[rows[best]], score[best]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [[], [], []]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    keys = ["block", "query_block"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
