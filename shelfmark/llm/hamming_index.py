"""Nearest neighbours by multi-index hashing of rotated binary codes.

Rotations are learnt so that the signs of rotated vectors lose little (PCA, then alternating
between codes and rotation). Codes are cut into substrings of eight bits, each with a table
of its own. If two codes differ in at most r bits, some substring differs in at most r / m of
them; probing all values that near therefore finds every code within the radius. Those that
are within it are ranked by inner products of the original vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm import folders

SAMPLE = 20_000         # vectors that a fit uses at most; every vector is indexed
BITS = 128
STEPS = 25
COVER = 0.985           # share of the sample's neighbours that the radius has to cover
INDEX_BLOCK, QUERY_BLOCK = 8192, 1024

_ONES = np.array([bin(v).count("1") for v in range(256)], np.uint8)


@dataclass(frozen=True)
class Codes:
    rotation: np.ndarray        # dimensions x bits
    radius: int

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """Codes as rows of bytes, a substring each."""
        return np.packbits(vectors @ self.rotation > 0, axis=1)


def learn(vectors: np.ndarray, k: int, bits: int = BITS, seed: int = 3) -> Codes:
    """Rotations and the radius, from a sample of vectors."""
    random = np.random.default_rng(seed)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    size = unit.shape[1]
    _, axes = np.linalg.eigh(unit.T @ unit)
    found, have = [], 0
    while have < bits:
        width = min(size, bits - have)
        base = axes[:, ::-1][:, :width]
        turn = np.linalg.qr(random.normal(size=(width, width)))[0]
        flat = unit @ base
        for _ in range(STEPS):
            left, _, right = np.linalg.svd(np.sign(flat @ turn).T @ flat)
            turn = (left @ right).T
        found.append(base @ turn)
        have += width
    codes = Codes(np.concatenate(found, axis=1), bits)
    own = codes.of(unit)
    queries = np.arange(0, len(unit), max(1, len(unit) // 200))
    score = vectors[queries] @ vectors.T
    score[np.arange(len(queries)), queries] = -np.inf
    near = np.argsort(-score, axis=1)[:, :min(k, len(unit) - 1)]
    apart = _ONES[own[queries][:, None, :] ^ own[near]].sum(axis=2, dtype=np.int64)
    return Codes(codes.rotation, int(np.quantile(apart, COVER)) if apart.size else bits)


class Tables:
    """For every substring the rows of a block in the order of its value."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(c, kind="stable") for c in codes.T]
        self.begin = [np.searchsorted(c[o], np.arange(257)) for c, o in
                      zip(codes.T, self.order, strict=True)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code differs in at most ``radius`` bits."""
        count = self.codes.shape[1]
        near, more = divmod(radius, count)
        met = np.zeros(len(self.codes), bool)
        for i in range(count):
            # If the first substrings all differ in more, the others share what is left.
            reach = near if i <= more else near - 1
            if reach >= 0:
                values = _MASKS[min(reach, 8)] ^ code[i]
                low, size = self.begin[i][values], np.diff(self.begin[i])[values]
                at = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
                met[self.order[i][at]] = True
        rows = np.flatnonzero(met)
        return rows[_ONES[self.codes[rows] ^ code].sum(axis=1, dtype=np.int64) <= radius]


_MASKS = [np.flatnonzero(_ONES <= r).astype(np.uint8) for r in range(9)]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    at = np.arange(len(score))
    if len(score) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return at[np.lexsort((ids[at], -score[at]))[:k]]


def _search_cell(codes: Codes, k: int):
    def run(table: pa.Table) -> pa.Table:
        asks = np.array(table.column("asks").to_pylist(), bool)
        ids = table.column("vec_id").to_numpy()
        vectors = _matrix(table.column("embedding"))
        mine, index = np.flatnonzero(asks), np.flatnonzero(~asks)
        held, held_ids = vectors[index], ids[index]
        packed = codes.of(vectors)
        tables = Tables(packed[index])
        out = []
        for q in mine if len(index) else ():
            rows = tables.within(packed[q], codes.radius)
            rows = rows[held_ids[rows] != ids[q]]
            if len(rows) < k:       # too few are so near: rank the whole block
                rows = np.flatnonzero(held_ids != ids[q])
            score = (held[rows] * vectors[q]).sum(axis=1)
            top = best(score, held_ids[rows], k)
            out.append((np.full(len(top), ids[q]), held_ids[rows[top]], score[top]))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [
            np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))
    return run


def usable(vectors: DataFrame) -> DataFrame:
    """Ids and vectors in double precision, without those that take no part: null, zero,
    with a null or non-finite component, or of another length than most."""
    fine = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                 & (F.abs(x) < F.lit(float("inf")))) & F.exists("embedding", lambda x: x != 0))
    lengths = fine.groupBy(F.size("embedding").alias("size")).count().orderBy(
        F.desc("count"), "size").first()
    return fine.where(F.size("embedding") == (lengths["size"] if lengths else 0))


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, bits: int = BITS,
            sample: int = SAMPLE) -> DataFrame:
    """For every vector whose id is divisible by ``every`` the k of largest inner product.

    Queries meet the index in cells of a bounded number of rows each, so that one very
    common vector fills no bucket. Rows with the query's id are not its neighbours.
    """
    vectors = usable(vectors)
    counts = vectors.agg(F.count("*").alias("n"), F.sum(
        (F.col("vec_id") % every == 0).cast("int")).alias("q")).first()
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    fitted = np.array([r.embedding for r in rows]) if rows else np.ones((1, 1))
    codes = learn(fitted, k, bits)
    blocks = folders.parts_for(counts.n, INDEX_BLOCK)
    groups = folders.parts_for(counts.q or 0, QUERY_BLOCK)
    at = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = vectors.select(at(blocks).alias("block"), all_of(groups).alias("grp"),
                           F.lit(False).alias("asks"), "vec_id", "embedding")
    asked = vectors.where(F.col("vec_id") % every == 0).select(
        all_of(blocks).alias("block"), at(groups).alias("grp"), F.lit(True).alias("asks"),
        "vec_id", "embedding")
    found = index.unionByName(asked).groupBy("block", "grp").applyInArrow(
        _search_cell(codes, k), "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def multi_index_hashing(vectors: DataFrame) -> DataFrame:
    return nearest(vectors.select("vec_id", "embedding"))
