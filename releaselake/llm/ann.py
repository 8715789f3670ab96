"""Approximate nearest neighbours by additive quantisation.

Codebooks of full-dimensional vectors are fitted stage by stage on the residuals of a bounded sample; a vector is the sum of
one entry of each, found by beam search, and its code is stored with the ratio of its norm to its approximation's norm. A
query makes a table of its products with all entries; looking the codes up there, times the stored norm ratio, scores all
rows of a block. The best ``SHORTLIST`` of each block are ranked again by exact inner products in double precision.

Rows are dealt by the hash of their id into blocks of about ``BLOCK`` rows, so that many equal vectors fill many blocks. A query goes
to every block at every size, so that each row is scored for each query and the work grows with their product. Blocks are held
one at a time, queries stream past them.

Vectors that are null, empty, of another length than most, all zero, or that hold a null or non-finite component take no part; neither do rows with a
null vec_id. Of repeated query ids one is taken. With fewer candidates than asked for all are returned; ties go to the smaller vec_id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_fraction, map_rows, materialize

TOP = 20
SHARE = 20  # rows whose id is divisible by this are queries
BOOKS, ENTRIES, BEAM = 16, 256, 4
SAMPLE = 12_000
SHORTLIST = 512
BLOCK = 8_192


class Model:
    def __init__(self, sample: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        residual, self.books = sample.astype(np.float32), []
        for _ in range(BOOKS):
            book = _means(residual, min(ENTRIES, len(residual)), rng)
            residual = residual - book[_nearest(residual, book)]
            self.books.append(book)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (rows x BOOKS) by beam search, and the norm ratios."""
        codes, ratios = np.empty((len(x), BOOKS), np.uint8), np.empty(len(x), np.float32)
        for lo in range(0, len(x), 1024):
            part = x[lo : lo + 1024].astype(np.float32)
            n = len(part)
            beams, paths = part[:, None, :], np.zeros((n, 1, 0), np.uint8)
            for book in self.books:
                cost = (beams**2).sum(2)[:, :, None] - 2 * beams @ book.T + (book**2).sum(1)
                flat = cost.reshape(n, -1)
                width = min(BEAM, flat.shape[1])
                best = np.argpartition(flat, width - 1, axis=1)[:, :width]
                row = np.arange(n)[:, None]
                parent, entry = best // len(book), best % len(book)
                beams = beams[row, parent] - book[entry]
                paths = np.concatenate([paths[row, parent], entry[:, :, None].astype(np.uint8)], axis=2)
            pick = (beams**2).sum(2).argmin(1)
            rows = np.arange(n)
            codes[lo : lo + n] = paths[rows, pick]
            near = np.linalg.norm(part - beams[rows, pick], axis=1)
            ratios[lo : lo + n] = np.linalg.norm(part, axis=1) / np.maximum(near, 1e-12)
        return codes, ratios

    def tables(self, q: np.ndarray) -> np.ndarray:
        """queries x BOOKS x ENTRIES: inner products with every entry."""
        return np.stack([q.astype(np.float32) @ b.T for b in self.books], axis=1)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (((centres**2).sum(1) - 2 * x @ centres.T)).argmin(1)


def _means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, centres)
        count = np.bincount(near, minlength=k)
        sums = np.zeros((k, x.shape[1]), np.float64)
        np.add.at(sums, near, x)
        full = count > 0
        centres[full] = (sums[full] / count[full, None]).astype(x.dtype)
        if (~full).any():
            centres[~full] = x[rng.choice(len(x), int((~full).sum()))]
    return centres


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part."""
    x = F.col("embedding")
    fine = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("embedding")).where("vec_id is not null and size(embedding) > 0")
    fine = fine.where(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0))
    return fine


def search(vectors: DataFrame, top: int = TOP, share: int = SHARE) -> DataFrame:
    """query_id, rank, vec_id, score: the result that the registered query returns."""
    every = usable(vectors)
    empty = every.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sizes = every.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").limit(1).collect()
    if not sizes:
        return empty
    size, n = sizes[0]
    every = every.where(F.size("embedding") == size)
    drawn = every.where(hash_fraction(F.col("vec_id"), 6) < min(1.0, SAMPLE / n)).orderBy("vec_id").limit(2 * SAMPLE).collect()
    if not drawn:
        drawn = every.orderBy("vec_id").limit(1).collect()
    model = Model(np.array([r.embedding for r in drawn]))
    blocks = -(-n // BLOCK)

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, ratios = model.encode(_matrix(batch.column("embedding"), size))
        return pa.record_batch([batch.column("vec_id"), batch.column("embedding"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(ratios)], ["vec_id", "embedding", "code", "ratio"])

    index = materialize(map_rows(every, "vec_id long, embedding array<double>, code binary, ratio float", lambda: encode), "ann-index")
    queries = index.where(F.col("vec_id") % share == 0).select("vec_id", "embedding").dropDuplicates(["vec_id"])
    asked = queries.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("key"), F.lit(1).alias("side"), "vec_id", "embedding", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("float").alias("ratio"))
    held = index.select(F.pmod(F.xxhash64("vec_id"), F.lit(blocks).cast("long")).alias("key"), F.lit(0).alias("side"), "vec_id", "embedding", "code", "ratio")
    dealt = held.union(asked).repartition("key").sortWithinPartitions("key", "side", "vec_id")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block, waiting = None, None, []
        for batch in batches:
            keys, side = batch.column("key").to_numpy(), batch.column("side").to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(keys) != 0) | (np.diff(side) != 0)) + 1).tolist(), len(keys)]
            found = []
            for lo, hi in zip(cuts, cuts[1:]):
                part = batch.slice(lo, hi - lo)
                if keys[lo] != key:
                    key, block, waiting = keys[lo], None, []
                if side[lo] == 0:
                    waiting.append(part)
                    continue
                if block is None and not waiting:
                    continue  # all ids went to other blocks
                if block is None:
                    t = pa.Table.from_batches(waiting).combine_chunks()
                    codes = np.frombuffer(b"".join(t.column("code").to_pylist()), np.uint8).reshape(-1, BOOKS)
                    block = (t.column("vec_id").to_numpy(), _matrix(pa.Table.from_batches(waiting).column("embedding").combine_chunks(), size), codes, t.column("ratio").to_numpy())
                found += _best(model, block, part.column("vec_id").to_numpy(), _matrix(part.column("embedding"), size), top)
            if found:
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*found)], ["query_id", "vec_id", "score"])

    near = dealt.mapInArrow(scan, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def _best(model: Model, block: tuple, ids: np.ndarray, queries: np.ndarray, top: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each query the best rows of a block, sorted by id: scored by table, the shortlist exactly."""
    names, vectors, codes, ratios = block
    out = []
    for lo in range(0, len(ids), 128):
        tables = model.tables(queries[lo : lo + 128])
        rough = np.zeros((len(tables), len(names)), np.float32)
        for m in range(BOOKS):
            rough += tables[:, m, :][:, codes[:, m]]
        rough *= ratios
        rough[names[None, :] == ids[lo : lo + 128, None]] = -np.inf
        keep = min(SHORTLIST, len(names))
        least = np.partition(rough, len(names) - keep, axis=1)[:, len(names) - keep]
        for i, q in enumerate(queries[lo : lo + 128]):
            row = rough[i]
            above = np.flatnonzero(row > least[i])
            at = np.sort(np.concatenate([above, np.flatnonzero(row == least[i])[: keep - len(above)]]))
            at = at[names[at] != ids[lo + i]]
            exact = (vectors[at] * q).sum(axis=1)
            best = np.argsort(-exact, kind="stable")[:top]
            out.append((np.full(len(best), ids[lo + i]), names[at[best]], exact[best]))
    return out
