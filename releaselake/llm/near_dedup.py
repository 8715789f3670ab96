"""MinHash near-duplicates with min-max hashing, confirmed on full shingle sets.

Words are runs of characters other than ASCII white space, with A-Z lower-cased; a document's set holds its distinct
five-word shingles, or its whole word sequence where it has fewer words. Each of ``PERMUTATIONS`` permutations of the
shingle hashes keeps both its minimum and its maximum, so that one evaluation gives two signature values; a band joins two
minima and two maxima of four different permutations. Two bandings of the same signature take each value once, in other company,
so that a link at exactly the least similarity is missed with a probability of about 8e-9, and less above it.

1. Documents with equal sets form a class, for which its smallest doc_id stands; only classes go on.
2. Classes that share a band value form a bucket. Each member is paired with the bucket's smallest id (as many pairs as
   members) and confirmed on full sets; confirmed links give components.
3. Buckets that still hold several components are read again. There a component of more than ``BLOCK`` members has blocks
   of its own and smaller ones share a pool of blocks of about that size; blocks meet in pairs, all against all by an
   incidence product over full sets, but for blocks of one component, which has nothing to gain. So one large component
   with few outsiders costs its size once for each block of outsiders. What a pair of blocks emits is a forest of its
   links, so no pair list grows with the square of a group.
4. Components are joined and each document gets the smallest doc_id that it can reach.

A band, a leader, a class or a component may hold any share of the rows: joins on them salt such keys (``join_hot``).

Null and empty texts, and texts of white space, have an empty set and link with nothing. Every row is linked by its own text: rows with a
null id, and rows that share an id but not the text, are told apart inside, and a component has the smallest id of its rows (null if none has
one). Texts are read whole. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, doc_texts, free_names, join_hot, map_rows, materialize, raw

WORDS = 5
SHARE = 75  # percent of the union that the intersection must reach
PERMUTATIONS = 64
BANDS = 64  # of two minima and two maxima each
BLOCK = 256
POOL = "pool"  # the blocks that small components of a bucket share

_U = np.uint64
_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_PLACE = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) * _U(2) + _U(1)
_MUL = _rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * _U(2) + _U(1)
_ADD = _rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64)
_BASE = _U(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as they are needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(16, (n - 1).bit_length())
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.concatenate([[_U(1)], np.full(size - 1, _BASE)]), dtype=np.uint64)
                self.down = np.cumprod(np.concatenate([[_U(1)], np.full(size - 1, _U(pow(int(_BASE), -1, 1 << 64)))]), dtype=np.uint64)
        return self.up, self.down


_powers = _Powers()


def shingles(data: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    if not data:
        return np.zeros(0, np.uint64)
    x = _LOWER[np.frombuffer(data, np.uint8)]
    word = ~_SPACE[x]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]])))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        up, down = _powers.upto(len(x) + 1)
        total = np.concatenate([[_U(0)], np.cumsum(_BYTE[x] * up[: len(x)], dtype=np.uint64)])
        words = _mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
        if len(words) < WORDS:
            return _mix((words * _PLACE[: len(words)]).sum(dtype=np.uint64, keepdims=True) + _U(len(words)))
        n = len(words) - WORDS + 1
        out = np.zeros(n, np.uint64)
        for k in range(WORDS):
            out += words[k : k + n] * _PLACE[k]
        return np.unique(_mix(out))


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """documents x BANDS, from minima and maxima of every permutation; no set may be empty."""
    at = np.cumsum([0] + [len(s) for s in sets[:-1]])
    flat = np.concatenate(sets)
    low, high = np.empty((PERMUTATIONS, len(sets)), np.uint64), np.empty((PERMUTATIONS, len(sets)), np.uint64)
    with np.errstate(over="ignore"):
        for p in range(PERMUTATIONS):
            h = flat * _MUL[p] + _ADD[p]
            h ^= h >> _U(32)
            h *= _MUL[-1 - p]
            low[p], high[p] = np.minimum.reduceat(h, at), np.maximum.reduceat(h, at)
        out = np.empty((len(sets), BANDS), np.uint64)
        for b in range(BANDS):
            steps = (0, 1, PERMUTATIONS // 2, PERMUTATIONS // 2 + 1) if 2 * b < PERMUTATIONS else (0, 7, 20, 41)
            at_b = [(2 * b + k) % PERMUTATIONS for k in steps]
            key = np.full(len(sets), _U(b + 1))
            for v in (low[at_b[0]], low[at_b[1]], high[at_b[2]], high[at_b[3]]):
                key = _mix(key * _BASE + v)
            out[:, b] = key
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n (set size), h1 and h2 (of the whole set), keys (band values; null for an empty set)."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t) for t in raw(batch, "text")]
        full = [i for i, s in enumerate(sets) if len(s)]
        keys: list[np.ndarray | None] = [None] * len(sets)
        for at in range(0, len(full), 64):
            part = full[at : at + 64]
            for i, k in zip(part, band_keys([sets[i] for i in part])):
                keys[i] = k.view(np.int64)
        with np.errstate(over="ignore"):
            h1 = [int(_mix(s).sum(dtype=np.uint64).view(np.int64)) for s in sets]
            h2 = [int(np.bitwise_xor.reduce(_mix(s * _BASE)).view(np.int64)) if len(s) else 0 for s in sets]
        cols = [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
        return pa.record_batch(cols, ["doc_id", "n", "h1", "h2", "keys"])

    return map_rows(doc_texts(docs), "doc_id long, n long, h1 long, h2 long, keys array<long>", lambda: step)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """doc_id and its sorted set of shingle hashes."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column("doc_id"), pa.array([shingles(t).view(np.int64) for t in raw(batch, "text")], pa.list_(pa.int64()))], ["doc_id", "shingles"])

    return map_rows(doc_texts(docs), "doc_id long, shingles array<long>", lambda: step)


def components(edges: DataFrame) -> DataFrame:
    """v and c, the smallest vertex that v reaches, for every vertex of edges (a, b); rounds of neighbour minima with pointer jumps."""
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "links")
    degrees = materialize(both.groupBy(F.col("b").alias("v")).agg(F.count("*").alias("n"), F.min("a").alias("m")), "labels")
    label = degrees.select("v", F.least("v", "m").alias("c"))
    ends = both.select(F.col("b").alias("v"), "a")
    held = degrees
    while True:
        # the smallest label among neighbours, for a vertex and for the vertex that its label names
        seen = join_hot(ends, label, ["v"], counts=degrees).groupBy("a").agg(F.min("c").alias("m"))
        step = label.join(seen, F.col("v") == F.col("a"), "left").select("v", F.col("c").alias("old"), F.least("c", "m").alias("m"))
        told = materialize(step.select(F.col("old").alias("v"), "m").union(step.select("v", "m")).groupBy("v").agg(F.min("m").alias("c")), "told")
        jump = join_hot(told, told.select(F.col("v").alias("c"), F.col("c").alias("cc")), ["c"], "left")
        new = materialize(jump.select("v", F.least("c", "cc").alias("c")), "labels")
        moved = new.join(label.withColumnRenamed("c", "was"), "v").where("c <> was").limit(1).count()
        if held is not degrees:
            discard(held)
        discard(told)
        label = held = new
        if not moved:
            return label


def _linked(sets: list[np.ndarray], kinds: list[int]) -> Iterator[tuple[int, int]]:
    """A forest of the links between sets of different components, by one incidence product over hashes that several sets hold."""
    n, sizes = len(sets), np.array([len(s) for s in sets])
    values, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    column = np.cumsum(shared) - 1
    row = np.repeat(np.arange(n), sizes)
    keep = shared[place]
    row, place = row[keep], column[place[keep]]
    inter = np.zeros((n, n), np.float32)
    wide = 16_384
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    for lo in range(0, int(shared.sum()), wide):
        a, b = np.searchsorted(place, [lo, lo + wide])
        part = np.zeros((n, min(wide, int(shared.sum()) - lo)), np.float32)
        part[row[a:b], place[a:b] - lo] = 1
        inter += part @ part.T
    linked = 100 * inter >= SHARE * (sizes[:, None] + sizes[None, :] - inter)
    root = {k: k for k in kinds}

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for i, j in zip(*np.nonzero(np.triu(linked, 1))):
        p, q = find(kinds[i]), find(kinds[j])
        if p != q:
            root[max(p, q)] = min(p, q)
            yield p, q


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, c, shingles) sorted by key; a key's rows are at most two blocks. Emits links between components."""

    def links(rows: list[tuple[int, np.ndarray]]) -> list[tuple[int, int]]:
        return list(_linked([s for _, s in rows], [c for c, _ in rows])) if len({c for c, _ in rows}) > 1 else []

    key, rows = None, []
    for batch in batches:
        found = []
        lists = batch.column("shingles")
        flat, offsets = lists.flatten().to_numpy(zero_copy_only=False), np.asarray(lists.offsets)
        offsets = offsets - offsets[0]
        for i, (k, c) in enumerate(zip(batch.column("key").to_pylist(), batch.column("c").to_pylist())):
            if k != key:
                found += links(rows)
                key, rows = k, []
            rows.append((c, flat[offsets[i] : offsets[i + 1]].copy()))
        if found:
            yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*found)], ["a", "b"])
    if found := links(rows):
        yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*found)], ["a", "b"])


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: the result that the registered query returns, one row for each row of docs."""
    named, row, made = _named(docs.select("doc_id", "text"))
    out = _classes(named.select(F.col(row).alias("doc_id"), "text"))
    if made:  # some rows go by another name than their id
        ids = named.select(F.col(row).alias("doc_id"), F.col("doc_id").cast("long").alias("_id")).distinct()
        out = materialize(out.drop("kept").join(ids, "doc_id"), "named")
        least = out.groupBy("component_id").agg(F.min("_id").alias("_least"), F.count("*").alias("n"))
        out = join_hot(out, least.drop("n"), ["component_id"], counts=least.drop("_least")).select(F.col("_id").alias("doc_id"), "n_shingles", F.col("_least").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _classes(docs: DataFrame) -> DataFrame:
    """The same for rows whose doc_id is not null and names one text."""
    rows = materialize(signatures(docs), "signatures")
    full = rows.where("n > 0")
    same = materialize(full.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "classes")
    reps = full.join(same.select(F.col("rep").alias("doc_id"), "h1", "h2"), ["doc_id", "h1", "h2"], "left_semi").dropDuplicates(["doc_id"])
    banded = materialize(reps.select(F.col("doc_id").alias("rep"), F.explode("keys").alias("key")), "bands")
    buckets = materialize(banded.groupBy("key").agg(F.count("*").alias("n"), F.min("rep").alias("lead")).where("n > 1"), "buckets")
    members = materialize(join_hot(banded, buckets, ["key"], counts=buckets), "members")

    pairs = materialize(members.where("rep <> lead").select("rep", "lead").distinct(), "pairs")
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    sets = materialize(shingle_sets(docs.join(wanted, "doc_id", "left_semi")).dropDuplicates(["doc_id"]), "sets")
    left = sets.select(F.col("doc_id").alias("rep"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc_id").alias("lead"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    confirmed = join_hot(pairs, right, ["lead"]).join(left, "rep").where(100 * both >= SHARE * (F.size("x") + F.size("y") - both))
    stars = materialize(confirmed.select(F.col("rep").alias("a"), F.col("lead").alias("b")), "stars")
    first = components(stars)

    marked = members.where("n > 2").join(first, F.col("rep") == F.col("v"), "left").select("key", "rep", F.coalesce("c", "rep").alias("c"))
    open_ = marked.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("n")).where("lo <> hi").select("key", "n")
    marked, open_ = materialize(marked, "marked"), materialize(open_, "open-keys")
    left_open = materialize(join_hot(marked, open_.select("key"), ["key"], counts=open_), "open")
    sizes = materialize(left_open.groupBy("key", "c").agg(F.count("*").alias("n")), "sizes")
    own = F.when(F.col("n") > BLOCK, F.concat(F.lit("c"), F.col("c"))).otherwise(POOL)
    lots = materialize(sizes.groupBy("key", own.alias("lot")).agg(F.ceil(F.sum("n") / F.lit(BLOCK)).cast("int").alias("parts")), "lots")
    near, far = (lots.select("key", F.col("lot").alias(f"{x}_lot"), F.col("parts").alias(f"{x}_parts")) for x in "ab")
    met = near.join(far, "key").where((F.col("a_lot") < F.col("b_lot")) | ((F.col("a_lot") == POOL) & (F.col("b_lot") == POOL)))
    numbers = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    met = met.withColumn("a_part", numbers("a_parts")).withColumn("b_part", numbers("b_parts")).where("a_lot <> b_lot or a_part <= b_part")
    met = met.withColumn("task", F.xxhash64("key", "a_lot", "a_part", "b_lot", "b_part"))
    sides = met.select("key", F.col("a_lot").alias("lot"), F.col("a_part").alias("part"), "task")
    sides = sides.union(met.where("a_lot <> b_lot or a_part <> b_part").select("key", "b_lot", "b_part", "task"))
    parts = sizes.withColumn("lot", own).join(lots, ["key", "lot"]).select("key", "c", "lot", "parts")
    placed = join_hot(left_open, parts, ["key", "c"], counts=sizes).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    dealt = placed.join(sides, ["key", "lot", "part"]).select(F.col("task").alias("key"), "rep", "c")
    tasks = dealt.join(sets.withColumnRenamed("doc_id", "rep"), "rep").select("key", "c", "shingles")
    late = materialize(tasks.repartition("key").sortWithinPartitions("key").mapInArrow(_blocks, "a long, b long"), "late")

    last = components(late)
    joined = join_hot(first, last.select(F.col("v").alias("c"), F.col("c").alias("d")), ["c"], "left").select("v", F.coalesce("d", "c").alias("component"))
    alone = last.join(first.select("v"), "v", "left_anti").select("v", F.col("c").alias("component"))
    component = joined.union(alone)
    of_class = same.join(component, F.col("rep") == F.col("v"), "left").select("h1", "h2", F.coalesce("component", "rep").alias("of_class"))
    empty = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    plain = full.select("doc_id", F.col("n").alias("n_shingles"), "h1", "h2")
    out = join_hot(plain, of_class, ["h1", "h2"], counts=same.select("h1", "h2", "n")).select("doc_id", "n_shingles", F.col("of_class").alias("component_id")).union(empty)
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that stand for their component; all columns stay, whatever they are called. Rows go only as copies of the same or a near text, whatever their ids are."""
    named, row, _ = _named(docs)
    (kept,) = free_names(named, "kept_row")
    found = _classes(named.select(F.col(row).alias("doc_id"), "text")).where("kept").select(F.col("doc_id").alias(kept)).distinct()
    return named.join(found, F.col(row) == F.col(kept), "left_semi").dropDuplicates([row]).select(*docs.columns)


def _named(docs: DataFrame) -> tuple[DataFrame, str, bool]:
    """The documents with a column that names a row, that column, and whether some rows have a made name: a row's name is its doc_id, or a hash of id and text above usual
    ids where the id is null or belongs to another text too."""
    row, one, first = free_names(docs, "row_name", "shared_id", "first_text")
    of = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    key = F.col("doc_id").cast("long")
    shared = docs.select(key.alias(one), of.alias("h")).groupBy(one).agg(F.min("h").alias(first), F.max("h").alias("last")).where(F.col(one).isNull() | (F.col(first) != F.col("last"))).drop("last")
    made = F.xxhash64(F.coalesce(key.cast("string"), F.lit("")), of).bitwiseAND((1 << 62) - 1).bitwiseOR(1 << 62)
    if shared.isEmpty():  # the usual case needs no join
        return docs.withColumn(row, key), row, False
    marked = docs.join(shared.where(F.col(one).isNotNull()), key == F.col(one), "left")
    other = key.isNull() | F.coalesce(of != F.col(first), F.lit(False))
    return marked.withColumn(row, F.when(other, made).otherwise(key)).drop(one, first), row, True
