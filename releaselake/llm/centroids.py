"""Centroid clustering in exact integers, with bounds that follow each cluster's sphere.

Every vector keeps a lower bound on its distance to all centroids but its own. A cluster lies in a sphere around its old centroid. When another
centroid moves from c to c', the distance of a point x to it falls by |x - c| - |x - c'|, at most the drift p = |c - c'|. Where that is s, x lies
within the cone around the direction of the move whose tip is the middle of c and c' and whose half angle has the cosine s / p, since a hyperbola's branch
lies within its asymptotes. The smallest angle that any point of the sphere has, seen in the plane of the sphere's centre and the move, is the
centre's angle less the angle that the radius takes up, so that the bound need be loosened by p times its cosine only, and not at all from a right angle on.

A vector whose exact distance to its own moved centroid is below its bound, or below half the distance from that centroid to the next one, stays;
all others are scanned, in exact arithmetic. So the result is that of scanning all vectors in every round.

Vectors and their state are a table in the shared folder that each round writes anew, from one scan and without a shuffle; sums change by
the vectors that moved alone. The driver holds the centroids and sums over clusters, never vectors. Large components, up to the largest double, are
taken as whole numbers of any size; a distance or sum that no long holds is null.

Vectors that are null, of another length, or with a null or non-finite component are left out. Repeated rows are each clustered. Rows with a null
vec_id are clustered but start no centroid. With fewer than ``CLUSTERS`` such vectors there are as many centroids; with none at all, or an empty table, no
rows. Equal centroids stay apart: ties go to the smaller number, so that the later one stays empty and where it is. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, map_rows, materialize

SIZE, CLUSTERS, ROUNDS, SEED, SCALE = 64, 8, 10, 3, 1024
SMALL, LARGE = 1 << 22, 1 << 27  # below these, distances are exact in doubles, and in 64-bit whole numbers
SLACK = 1e-9  # more than all rounding of a bound
TURN = 1e-7  # and of an angle
LIMB = 32
MOST = (1 << 63) - 1
STATE = "vec_id long, x binary, cluster int, was int, near double, far double, scans int"


def scaled(x: float) -> int:
    """floor(SCALE * x) of any double."""
    return math.floor(x * SCALE) if abs(x) < 2.0**53 else int(x) * SCALE


def packed(vector: np.ndarray) -> bytes:
    """A vector's whole numbers: 32-bit ones, or the doubles that they come from where one is large."""
    top = vector * SCALE if np.abs(vector).max() < LARGE / SCALE else None
    return vector.astype("<f8").tobytes() if top is None else np.floor(top).astype("<i4").tobytes()


def unpacked(x: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The vectors as whole numbers, zeros for large ones, and which are large."""
    large = np.array([len(b) != 4 * SIZE for b in x], bool)
    zero = bytes(4 * SIZE)
    return np.frombuffer(b"".join(zero if big else b for b, big in zip(x, large)), "<i4").reshape(-1, SIZE).astype(np.int64), large


def whole(x: bytes) -> list[int]:
    return [scaled(v) for v in np.frombuffer(x, "<f8").tolist()] if len(x) == 8 * SIZE else np.frombuffer(x, "<i4").tolist()


def _square(a: list[int], b: list[int]) -> int:
    return sum((p - q) ** 2 for p, q in zip(a, b))


def root(n: int) -> float:
    """The square root of a whole number; infinite beyond doubles."""
    return math.sqrt(n) if n < 1 << 1000 else math.inf if n >= 1 << 2046 else math.ldexp(math.sqrt(n >> 1000), 500)


def loosening(old: list[list[int]], new: list[list[int]], radii: list[float]) -> list[float]:
    """For each cluster, by how much the distance of any of its vectors to another centroid can have fallen."""
    out = []
    for i, centre in enumerate(old):
        worst = 0.0
        for j, (a, b) in enumerate(zip(old, new)):
            if i == j or a == b:
                continue
            drift = root(_square(a, b))
            # twice the way from the middle of the move to the sphere's centre, so that it stays whole
            way = [2 * m - p - q for m, p, q in zip(centre, a, b)]
            length = root(sum(w * w for w in way)) / 2
            cosine = 1.0
            along = sum(w * (q - p) for w, p, q in zip(way, a, b))
            if abs(along) < 1 << 1000 and length < math.inf and length > radii[i] * (1 + SLACK):
                angle = math.acos(max(-1.0, min(1.0, along / 2 / length / drift)))
                cosine = math.cos(max(0.0, angle - math.asin(min(1.0, radii[i] / length)) - TURN))
            worst = max(worst, drift * max(0.0, cosine + SLACK))
        out.append(worst * (1 + SLACK))
    return out


class Scanner:
    """Exact distances to the centroids, and bounds on them."""

    def __init__(self, centroids: list[list[int]], fall: list[float] | None):
        self.exact, self.fall = centroids, fall
        most = max((abs(v) for c in centroids for v in c), default=0)
        self.far = most >= LARGE  # some distance may need more than 64 bits
        self.plain = None if self.far else np.array(centroids, np.int64)
        self.small = most < SMALL
        between = [[_square(a, b) for j, b in enumerate(centroids) if j != i] for i, a in enumerate(centroids)]
        self.half = np.array([root(min(b)) / 2 if b else math.inf for b in between])

    def squares(self, v: np.ndarray, which: np.ndarray | None = None) -> np.ndarray:
        """Squared distances of vectors (rows of v) to all centroids, or to one each."""
        small = self.small and (not len(v) or np.abs(v).max() < SMALL)
        v, c = (v.astype(np.float64), self.plain.astype(np.float64)) if small else (v, self.plain)
        if which is not None:
            d = v - c[which]
            return np.einsum("ij,ij->i", d, d).astype(np.int64)
        if small:
            return ((v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)).astype(np.int64)
        return np.stack([((v - x) ** 2).sum(1) for x in c], axis=1)

    def assign(self, x: list[bytes], cluster: np.ndarray, far: np.ndarray, scans: np.ndarray) -> tuple[np.ndarray, list[int], np.ndarray, np.ndarray, np.ndarray]:
        """cluster, exact squared distance, near (its root), far (bound for all other centroids), scans of each vector, given those of the round before."""
        v, large = unpacked(x)
        n = len(x)
        squares: list[int] = [0] * n
        cluster, far, scans = cluster.copy(), far.copy(), scans.copy()
        by_hand = np.flatnonzero(large | self.far)
        quick = np.flatnonzero(~(large | self.far))
        if len(quick):
            todo = quick
            if self.fall is not None:
                own = self.squares(v[quick], cluster[quick])
                bound = np.maximum(far[quick] - np.array(self.fall)[cluster[quick]], 0.0)
                far[quick] = bound
                stays = np.sqrt(own.astype(np.float64)) * (1 + SLACK) + SLACK < np.maximum(bound, self.half[cluster[quick]]) * (1 - SLACK)
                for i, d in zip(quick[stays].tolist(), own[stays].tolist()):
                    squares[i] = d
                todo = quick[~stays]
            if len(todo):
                every = self.squares(v[todo])
                best = every.argmin(1)  # the first of equal ones
                cluster[todo], rows = best, np.arange(len(todo))
                for i, d in zip(todo.tolist(), every[rows, best].tolist()):
                    squares[i] = d
                every = every.astype(np.float64)
                every[rows, best] = np.inf
                far[todo] = np.sqrt(every.min(1)) * (1 - SLACK)
                scans[todo] += 1
        for i in by_hand.tolist():
            vector = whole(x[i])
            ds = [_square(vector, c) for c in self.exact]
            cluster[i] = best = ds.index(min(ds))
            squares[i], scans[i] = ds[best], scans[i] + 1
            far[i] = root(min((d for j, d in enumerate(ds) if j != best), default=0)) * (1 - SLACK)
        near = np.array([root(d) for d in squares]) * (1 + SLACK)
        return cluster, squares, near, np.where(np.isfinite(far), far, 0.0), scans


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that are clustered."""
    x = F.col("embedding")
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("embedding")).where(F.size(x) == SIZE)
    return kept.where(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))


def starts(kept: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """The vectors with the smallest hashes of seed and id."""
    hashed = kept.where("vec_id is not null").withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    return [[scaled(v) for v in r.embedding] for r in hashed.orderBy("h", "embedding").limit(clusters).collect()]


def _limbs(n: int) -> Iterator[tuple[int, int]]:
    """A whole number as digits that add up without loss."""
    sign, n, k = (-1 if n < 0 else 1), abs(n), 0
    while n:
        yield k, sign * (n & (1 << LIMB) - 1)
        n, k = n >> LIMB, k + 1


def changes(state: DataFrame) -> dict[tuple[int, int], int]:
    """By (cluster, place): what the vectors that moved add to the sums of components; at place SIZE, to the count. Tasks add up their own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = {}

        def add(cluster: int, values: list[int], count: int, sign: int) -> None:
            for place, value in enumerate([*values, count]):
                if value:
                    total[cluster, place] = total.get((cluster, place), 0) + sign * value

        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").to_pylist()
            v, large = unpacked(x)
            for name, sign in (("cluster", 1), ("was", -1)):
                of = batch.column(name).to_numpy()
                for c in np.unique(of[of >= 0]).tolist():
                    mine = (of == c) & ~large
                    add(c, v[mine].sum(0).tolist(), int(mine.sum()), sign)
                    for i in np.flatnonzero((of == c) & large).tolist():
                        add(c, whole(x[i]), 1, sign)
        rows = [(c, place, k, digit) for (c, place), n in total.items() for k, digit in _limbs(n)]
        if rows:
            yield pa.record_batch([pa.array(col, t) for col, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.int64()))], ["cluster", "place", "limb", "digit"])

    moved = state.where("cluster <> was").select("x", "cluster", "was").mapInArrow(run, "cluster int, place int, limb int, digit long")
    out: dict[tuple[int, int], int] = {}
    for r in moved.groupBy("cluster", "place", "limb").agg(F.sum("digit").alias("digit")).collect():  # clusters x components x limbs
        out[r.cluster, r.place] = out.get((r.cluster, r.place), 0) + (r.digit << LIMB * r.limb)
    return out


def _fits(n: int) -> int | None:
    return n if n <= MOST else None


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, scans: the result that the registered query returns; scans tells in how many of
    the rounds and the last assignment a vector was compared with all centroids."""
    spark = vectors.sparkSession
    kept = usable(vectors)
    centroids = starts(kept, clusters, seed)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, scans int"
    if not centroids:
        return spark.createDataFrame([], schema)
    sums = [[0] * SIZE for _ in centroids]
    counts = [0] * len(centroids)

    def first(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        v = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, SIZE)
        zero, none = np.zeros(n, np.int32), np.zeros(n)
        return pa.record_batch([batch.column("vec_id"), pa.array([packed(r) for r in v], pa.binary()), pa.array(zero - 1), pa.array(zero - 1), pa.array(none), pa.array(none), pa.array(zero)], [c.split()[0] for c in STATE.split(", ")])

    def scan(scanner: Scanner, last: bool):
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            x, was = batch.column("x").to_pylist(), batch.column("cluster").to_numpy()
            now, squares, near, far, scans = scanner.assign(x, was, batch.column("far").to_numpy(), batch.column("scans").to_numpy())
            if last:
                digits = [(d if d <= MOST else None, d & (1 << LIMB) - 1, d >> LIMB if d <= MOST else None) for d in squares]
                distance, low, high = (pa.array(c, pa.int64()) for c in zip(*digits))
                return pa.record_batch([batch.column("vec_id"), pa.array(now, pa.int32()), distance, low, high, pa.array(scans, pa.int32())], ["vec_id", "cluster", "distance", "low", "high", "scans"])
            return pa.record_batch([batch.column("vec_id"), batch.column("x"), pa.array(now, pa.int32()), pa.array(was, pa.int32()), pa.array(near), pa.array(far), pa.array(scans, pa.int32())], [c.split()[0] for c in STATE.split(", ")])

        return lambda: step

    state, fall, written = map_rows(kept, STATE, lambda: first), None, None
    for _ in range(rounds):
        new = materialize(map_rows(state, STATE, scan(Scanner(centroids, fall), False)), "clusters")
        if written is not None:
            discard(written)
        state = written = new
        radii = {r.cluster: r.radius for r in state.groupBy("cluster").agg(F.max("near").alias("radius")).collect()}
        for (c, place), n in changes(state).items():
            if place == SIZE:
                counts[c] += n
            else:
                sums[c][place] += n
        moved = [[s // n for s in total] if n else c for total, n, c in zip(sums, counts, centroids)]
        fall = loosening(centroids, moved, [radii.get(i, 0.0) for i in range(len(centroids))])
        centroids = moved
    found = map_rows(state, "vec_id long, cluster int, distance long, low long, high long, scans int", scan(Scanner(centroids, fall), True))
    found = materialize(found, "clustered")
    if written is not None:
        discard(written)
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    inertia = {r.cluster: None if r.lost else int(r.low) + (int(r.high) << LIMB) for r in found.groupBy("cluster").agg(total("low"), total("high"), F.count_if(F.col("distance").isNull()).alias("lost")).collect()}
    every = None if None in inertia.values() else sum(inertia.values())
    rows = [(i, n if n is None else _fits(n), every if every is None else _fits(every), hashlib.sha256(",".join(map(str, centroids[i])).encode()).hexdigest()) for i, n in inertia.items()]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # a row for each cluster
    return found.join(F.broadcast(known), "cluster").select(*(c.split()[0] for c in schema.split(", ")))


def oracle_sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """The same rows in SQL, every vector scanned in every round, for components whose sums a HUGEINT holds."""
    parts = [
        f"v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS HUGEINT)) AS x FROM embeddings"
        f" WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {SIZE})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS k, x FROM (SELECT sha256(concat('{seed}:', vec_id)) AS h, x FROM v WHERE vec_id IS NOT NULL ORDER BY h, x LIMIT {clusters}))",
    ]
    nearest = lambda i: (
        f"a{i} AS MATERIALIZED (SELECT r, min(d) AS d, min_by(k, (d, k)) AS k FROM (SELECT v.r, c.k, list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM v, c{i} c) GROUP BY r)"
    )
    for i in range(rounds):
        parts += [
            nearest(i),
            f"s{i} AS (SELECT k, p, sum(y) AS s, count(*) AS n FROM (SELECT a.k, unnest(v.x) AS y, generate_subscripts(v.x, 1) AS p FROM v JOIN a{i} a ON a.r = v.r) GROUP BY k, p)",
            f"m{i} AS (SELECT k, list(CASE WHEN s >= 0 THEN s // n ELSE -((-s + n - 1) // n) END ORDER BY p) AS x FROM s{i} GROUP BY k)",
            f"c{i + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON m.k = c.k)",
        ]
    parts.append(nearest(rounds))
    return f"""
WITH {", ".join(parts)}
SELECT v.vec_id, CAST(a.k AS INT) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM v JOIN a{rounds} a ON a.r = v.r JOIN c{rounds} c ON c.k = a.k
"""
