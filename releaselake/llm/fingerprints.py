"""Document fingerprints: a quartile bucket digest over hashed byte triplets.

Every window of four bytes gives three triplets with the newest byte; each is hashed into one of 256 buckets. The digest
holds, for each bucket, the quartile its count falls into, besides a logarithmic length and the ratios of the quartiles.
Two digests differ by a score of at most ``MOST``; their likeness is 1 less the score's share of that.

``fingerprints`` gives each document its own digest; ``neighbours`` also that of its text with the end replaced by the
start of the next document, in descending doc_id. For that the ids alone are cut into ranges, whose count and first ids
reach the driver; texts are shuffled once by range, the first document of a range also going to the range before.

Null text counts as empty, whose digest has no counts. A single document is its own next one. Rows with equal ids are taken
in the order of their texts' hashes; null ids come last, each range is read as a stream, and texts are digested whole. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_texts, map_rows, raw

BUCKETS = 256
SALTS = ((1, 2, 0x9E3779B1), (1, 3, 0x85EBCA77), (2, 3, 0xC2B2AE3D))
MOST = 420  # about what two digests of independent uniform codes differ by
RANGE_ROWS = 1000
MOST_RANGES = 20_000
TASK_ROWS = 4_000  # that a task streams, in some ranges: smaller tasks cost a sort buffer and files each
LAST = -(1 << 63)


def counts(data: bytes) -> np.ndarray:
    out = np.zeros(BUCKETS, np.int64)
    x = np.frombuffer(data, np.uint8).astype(np.uint32)
    for i, j, salt in SALTS:
        if len(x) > j:
            h = (x[j:] | (x[j - i : len(x) - i] << np.uint32(8)) | (x[: len(x) - j] << np.uint32(16))) * np.uint32(salt)
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            out += np.bincount(h >> np.uint32(24), minlength=BUCKETS)
    return out


def digest(data: bytes) -> bytes:
    """3 header bytes, then 2 bits for each bucket."""
    c = counts(data)
    s = np.sort(c)
    q1, q2, q3 = s[BUCKETS // 4 - 1], s[BUCKETS // 2 - 1], s[3 * BUCKETS // 4 - 1]
    codes = (c > q1).astype(np.uint8) + (c > q2) + (c > q3)
    packed = codes.reshape(-1, 4) @ np.array([64, 16, 4, 1], np.uint8)
    size = min(255, round(8 * math.log2(1 + len(data))))
    ratio = lambda q: int(15 * q // q3) if q3 else 0
    return bytes([size, ratio(q1), ratio(q2)]) + packed.astype(np.uint8).tobytes()


_CODES = np.array([[b >> 6, b >> 4 & 3, b >> 2 & 3, b & 3] for b in range(256)], np.int8)
_STEP = np.array([0, 1, 2, 6], np.int64)


def difference(a: bytes, b: bytes) -> int:
    """0 for equal digests, ``MOST`` at most: quartile steps, a step of three counting six, and header steps."""
    if a == b:
        return 0
    x, y = np.frombuffer(a[3:], np.uint8), np.frombuffer(b[3:], np.uint8)
    body = int(_STEP[np.abs(_CODES[x] - _CODES[y])].sum())
    head = max(0, abs(a[0] - b[0]) - 1) + abs(a[1] - b[1]) + abs(a[2] - b[2])
    return min(MOST, max(1, body + head))


def likeness(a: bytes, b: bytes) -> float:
    return 1.0 - difference(a, b) / MOST


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and the fingerprint of its whole text in hexadecimal; no shuffle."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column("doc_id"), pa.array([digest(t).hex() for t in raw(batch, "text")], pa.string())], ["doc_id", "fingerprint"])

    return map_rows(doc_texts(docs), "doc_id long, fingerprint string", lambda: step)


def neighbours(docs: DataFrame) -> DataFrame:
    """The result that the registered query returns, one row for each document."""
    rows = doc_texts(docs)
    ids = rows.select(F.coalesce("doc_id", F.lit(LAST)).alias("id"))
    n = ids.count()
    parts = max(1, min(MOST_RANGES, math.ceil(n / RANGE_ROWS)))
    cuts = sorted(set(map(int, ids.approxQuantile("id", [i / parts for i in range(1, parts)], 1 / (4 * parts))))) if parts > 1 else []
    bounds = np.array(cuts, np.int64)  # range r holds ids in [bounds[r-1], bounds[r])

    def ranges(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = np.searchsorted(bounds, batch.column("id").to_numpy(zero_copy_only=False), side="right")
        return pa.record_batch([pa.array(at.astype(np.int32)), batch.column("id")], ["r", "id"])

    tops = {x.r: x.top for x in map_rows(ids, "r int, id long", lambda: ranges).groupBy("r").agg(F.max("id").alias("top")).collect()}
    full = sorted(tops)
    before = {r: full[(k + 1) % len(full)] for k, r in enumerate(full)}  # whose last document the first of r follows

    @F.arrow_udf("array<int>")
    def to(key: pa.Array) -> pa.Array:
        """A row's range; for the first of a range also the range before."""
        k = key.to_numpy(zero_copy_only=False)
        r = np.searchsorted(bounds, k, side="right").tolist()
        return pa.array([[x, before[x]] if tops[x] == y else [x] for x, y in zip(r, k.tolist())], pa.list_(pa.int32()))

    # the ids alone go to Python and back, the texts stay where they are until they are shuffled
    keyed = rows.withColumn("id", F.coalesce("doc_id", F.lit(LAST)))
    dealt = keyed.select(F.posexplode(to("id")).alias("copy", "r"), "id", "doc_id", "text")
    dealt = dealt.repartition(max(1, len(full)), "r").coalesce(max(1, math.ceil(n / TASK_ROWS))).sortWithinPartitions("r", "copy", F.desc("id"), F.xxhash64("text"))

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # range, id, text, digest of the row before
        done = None  # the range whose last row has met its next
        for batch in batches:
            out = []
            for r, copy, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("r", "copy", "doc_id", "text"))):
                if copy and r == done:
                    continue
                own = digest(text.encode())
                if held and held[0] == r:
                    out.append(_pair(*held[1:], text, own))
                held = None if copy else (r, doc_id, text, own)
                done = r if copy else done
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return dealt.mapInArrow(stream, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def edited(text: str, following: str) -> str:
    """The last floor(n/2) code points replaced by as many of the next text's first, or all of them."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _pair(doc_id: int | None, text: str, own: bytes, following: str, other: bytes) -> tuple:
    data = edited(text, following).encode()
    changed = digest(data)
    return doc_id, len(text), hashlib.sha256(data).hexdigest(), own.hex(), changed.hex(), likeness(own, changed), likeness(own, other)
