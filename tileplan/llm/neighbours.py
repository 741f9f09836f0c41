"""Approximate nearest neighbours by multi-index hashing.

A rotation learned on a bounded sample (iterative quantisation) turns each vector into a binary code, which is cut into
substrings of 16 bits. If two codes differ in at most R bits, then one of their m substrings differs in at most R / m:
so probing each substring's index for all keys that near finds every code within R. The codes found are ranked again
by the cosine of the vectors themselves.

The index is cut into shards of vectors by a hash of the id, so equal vectors and crowded keys lie in many shards; each
shard answers the queries of one block at a time, and a last step merges the answers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

POPCOUNT = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)  # bits set in 0 to 65535, by rule


@dataclass(frozen=True)
class Settings:
    bits: int = 128  # rounded up to whole rotations of the vectors' dimension
    sample: int = 20_000  # vectors that rotation and radius are learned from
    probes: int = 400  # sample vectors whose neighbours set the radius
    covered: float = 0.98  # share of the probes' true neighbours within the radius
    shard_rows: int = 8192
    block_rows: int = 4096
    seed: int = 7


@dataclass(frozen=True)
class Codes:
    """Rotations (dimension x bits) around a mean, and the radius."""

    mean: np.ndarray
    rotation: np.ndarray
    radius: int

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """The 16-bit substrings of the codes, one column each."""
        units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        bits = (units - self.mean) @ self.rotation > 0
        packed = np.packbits(bits, axis=1)
        if packed.shape[1] % 2:
            packed = np.pad(packed, ((0, 0), (0, 1)))
        return np.ascontiguousarray(packed).view(np.uint16)


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v) of the vectors that take part: not null, all components finite, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(vector).isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))


def learn(vectors: DataFrame, k: int, settings: Settings = Settings()) -> Codes | None:
    """Learn from the ``sample`` vectors with the smallest hash of their id, of the sample's most common dimension."""
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(settings.sample).select("v").collect()
    if not rows:
        return None
    sizes, counts = np.unique([len(r.v) for r in rows], return_counts=True)
    size = int(sizes[counts.argmax()])
    x = np.array([r.v for r in rows if len(r.v) == size])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    mean, rng = x.mean(0), np.random.default_rng(settings.seed)
    parts = []
    for _ in range(-(-settings.bits // size)):
        turn = np.linalg.qr(rng.normal(size=(size, size)))[0]
        for _ in range(20):  # alternate between codes and the rotation that fits them best
            u, _, v = np.linalg.svd(np.where((x - mean) @ turn > 0, 1.0, -1.0).T @ (x - mean))
            turn = (u @ v).T
        parts.append(turn)
    codes = Codes(mean, np.concatenate(parts, 1), 0)
    probes = x[: settings.probes]
    near = probes @ x.T
    near[np.arange(len(probes)), np.arange(len(probes))] = -2
    best = np.argsort(-near, axis=1)[:, :min(k, len(x) - 1)]
    keys = codes.keys(x)
    bits = np.array([hamming(keys[i:i + 1], keys[best[i]])[0] for i in range(len(probes))])
    radius = int(np.quantile(bits, settings.covered)) if bits.size else codes.rotation.shape[1]
    return Codes(mean, codes.rotation, radius)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which each row of a differs from each row of b."""
    return sum(POPCOUNT[a[:, None, j] ^ b[None, :, j]].astype(np.uint16) for j in range(a.shape[1]))


def within(queries: np.ndarray, index: np.ndarray, radius: int, least: int) -> np.ndarray:
    """Which codes of the index each query finds by probing every substring. A query that finds fewer than ``least``
    takes a larger radius, up to its ``least`` nearest codes."""
    bands = index.shape[1]
    found = np.zeros((len(queries), len(index)), bool)
    for j in range(bands):
        keys, place = np.unique(index[:, j], return_inverse=True)
        found |= (POPCOUNT[queries[:, None, j] ^ keys[None, :]] <= radius // bands)[:, place]
    bits = hamming(queries, index)
    found &= bits <= radius
    short = np.flatnonzero(found.sum(1) < min(least, len(index)))
    if len(short):
        reach = np.partition(bits[short], min(least, len(index)) - 1, axis=1)[:, min(least, len(index)) - 1]
        found[short] |= bits[short] <= reach[:, None]
    return found


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, settings: Settings = Settings()) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (cosine): the ``k`` nearest found for each row of ``queries``.

    Both frames are (id, v) as ``usable`` gives them. Rows with the query's own id are no candidates; equal scores go
    to the smaller id; a query whose dimension is not the index's finds nothing; empty tables give no rows.
    """
    spark = vectors.sparkSession
    codes = learn(vectors, k, settings)
    if codes is None:
        return spark.createDataFrame([], "query_id LONG, rank INT, vec_id LONG, score DOUBLE")
    size = len(codes.mean)
    vectors, queries = (f.where(F.size("v") == size) for f in (vectors, queries))
    shards = max(1, -(-vectors.count() // settings.shard_rows))
    blocks = max(1, -(-queries.count() // settings.block_rows))
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def matrix(table: pa.Table) -> np.ndarray:
        return pc.list_flatten(table.column("v").combine_chunks()).to_numpy(zero_copy_only=False).reshape(-1, size)

    def answer(key: tuple, base: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if base.num_rows and asked.num_rows:
            x, x_ids = matrix(base), base.column("id").to_numpy()
            q, q_ids = matrix(asked), asked.column("id").to_numpy()
            x_keys, q_keys = codes.keys(x), codes.keys(q)
            x_norm, q_norm = np.linalg.norm(x, axis=1), np.linalg.norm(q, axis=1)
            for begin in range(0, len(q), 256):
                part = slice(begin, begin + 256)
                row, col = np.nonzero(within(q_keys[part], x_keys, codes.radius, k + 1))
                row += begin
                other = q_ids[row] != x_ids[col]
                row, col = row[other], col[other]
                score = np.concatenate([np.einsum("ij,ij->i", q[row[i:i + 65536]], x[col[i:i + 65536]])
                                        for i in range(0, max(len(row), 1), 65536)]) / (q_norm[row] * x_norm[col])
                order = np.lexsort((x_ids[col], -score, row))
                row, col, score = row[order], col[order], score[order]
                top = np.arange(len(row)) - np.searchsorted(row, row) < k
                out.append(pa.table([q_ids[row[top]], x_ids[col[top]], score[top]], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    spread = vectors.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = queries.withColumn("block", block).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    found = spread.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(
        answer, "query_id LONG, vec_id LONG, score DOUBLE")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
