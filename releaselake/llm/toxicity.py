"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over words and word beginnings is trained from confirmed toxic documents and unlabelled text: its risk is
prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)) with the sigmoid loss, so that the negative part is
corrected for the toxic share that hides in the unlabelled text and cannot fall below zero. Training takes at most about
``MOST_POSITIVE`` positives and ``MOST_UNLABELLED`` unlabelled documents, chosen by the hash of their ids among the rows
whose crc32(doc_id as text) mod 3 is not 1; the class prior is the toxic share of the labelled rows there. Features are
the ``VOCABULARY`` strings that are most significantly commoner among the positives. Every document is then scored whole.

Null and empty texts get the score of no features at all. Without any positive the score is 0 everywhere. Repeated rows get equal
scores; repeated labels count once, toxic if any is; null labels are left out. Other columns never enter a score. An empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_texts, hash_fraction, map_rows, materialize

MOST_POSITIVE = 4_000
MOST_UNLABELLED = 8_000
VOCABULARY = 2_048
LEAST_Z = 4.0
THRESHOLD = 0.7
PREFIXES = (3, 4, 5, 6)
CACHED = 300_000
_WORD = re.compile(r"\w+")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3, F.lit(0))


def strings(chunk: str) -> list[str]:
    """The features of a lower-case chunk without white space: its words, and their beginnings."""
    out = []
    for w in _WORD.findall(chunk):
        out.append(w)
        out += [w[:n] + "*" for n in PREFIXES if len(w) >= n]
    return out


class Known(dict):
    """Feature numbers of a chunk, for chunks in the order they come up."""

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary = vocabulary

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        if len(self) >= CACHED:
            self.clear()
        self[chunk] = found = tuple(i for s in strings(chunk) if (i := self.vocabulary.get(s)) is not None)
        return found

    def of(self, text: str) -> list[int]:
        found: set[int] = set()
        for chunk in set(text.lower().split()):
            if ids := self[chunk]:
                found.update(ids)
        return sorted(found)


def fit(rows: list[list[int]], positive: np.ndarray, prior: float, size: int, steps: int = 400, rate: float = 0.1, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk; ``positive`` marks the confirmed rows, all others are unlabelled."""
    lengths = np.array([len(r) for r in rows])
    columns = np.array([i for r in rows for i in r], np.int64)
    owner = np.repeat(np.arange(len(rows)), lengths)
    p, u = positive, ~positive
    weights, bias = np.zeros(size + 1), -1.0
    first, second = np.zeros(size + 2), np.zeros(size + 2)
    for t in range(1, steps + 1):
        score = np.bincount(owner, weights[columns], len(rows)) + bias
        s = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        slope = s * (1 - s)
        negative = s[u].mean() - prior * s[p].mean()  # the loss of calling a row toxic is s, of calling it clean 1 - s
        pull = np.zeros(len(rows))
        if negative >= 0:
            pull[p] -= 2 * prior * slope[p] / p.sum()
            pull[u] += slope[u] / u.sum()
        else:  # the negative part has been overfitted: step back from it
            pull[p] += prior * slope[p] / p.sum()
            pull[u] -= slope[u] / u.sum()
        grad = np.append(np.bincount(columns, pull[owner], size + 1) + penalty * weights, pull.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        move = rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        weights -= move[:-1]
        bias -= move[-1]
    return weights, float(bias)


def train(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, int], np.ndarray, float] | None:
    """Vocabulary, weights and bias; None without any confirmed toxic document."""
    seen = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic is not null and doc_id is not null")
    seen = seen.where(fold(F.col("doc_id")) != 1).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n_labelled, n_toxic = seen.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n_toxic:
        return None
    prior = min(0.9, n_toxic / n_labelled)
    key = F.col("doc_id")
    chosen = seen.where((F.col("toxic") == 1) & (hash_fraction(key, 8) < min(1.0, MOST_POSITIVE / n_toxic))).select("doc_id", F.lit(True).alias("confirmed"))
    open_ = doc_texts(docs).where(fold(key) != 1)
    n = open_.select("doc_id").count()
    drawn = hash_fraction(key, 9) < min(1.0, MOST_UNLABELLED / max(n, 1))
    marked = open_.join(F.broadcast(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * MOST_POSITIVE)), "doc_id", "left").withColumn("drawn", drawn)
    sample = materialize(marked.where("confirmed or drawn").select("doc_id", "text", F.coalesce("confirmed", F.lit(False)).alias("confirmed"), "drawn"), "toxicity-sample")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: dict[str, list[int]] = {}
        for text, confirmed, drawn in zip(*(batch.column(c).to_pylist() for c in ("text", "confirmed", "drawn"))):
            for s in {s for chunk in set(text.lower().split()) for s in strings(chunk)}:
                both = found.setdefault(s, [0, 0])
                both[0] += confirmed
                both[1] += drawn
        values = list(found.values())
        return pa.record_batch([pa.array(list(found), pa.string()), *(pa.array([v[i] for v in values], pa.int64()) for i in (0, 1))], ["s", "p", "u"])

    n_p, n_u = sample.agg(F.sum(F.col("confirmed").cast("long")), F.sum(F.col("drawn").cast("long"))).first()
    if not n_p or not n_u:
        return None
    sums = map_rows(sample, "s string, p long, u long", lambda: count).groupBy("s").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    share, usual = F.col("p") / F.lit(float(n_p)), (F.col("u") + 1) / F.lit(float(n_u + 2))
    ranked = sums.where("p >= 3").withColumn("z", (share - usual) / F.sqrt(usual * (1 - usual) / F.lit(float(n_p)))).where((F.col("z") >= LEAST_Z) & (share > 2 * usual))
    vocabulary = {r.s: i for i, r in enumerate(ranked.orderBy(F.desc("z"), "s").limit(VOCABULARY).select("s").collect())}

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = Known(vocabulary)
        return pa.record_batch([*(batch.column(c) for c in ("doc_id", "confirmed", "drawn")), pa.array([known.of(t) for t in batch.column("text").to_pylist()], pa.list_(pa.int32()))], ["doc_id", "confirmed", "drawn", "f"])

    got = sorted(map_rows(sample, "doc_id long, confirmed boolean, drawn boolean, f array<int>", lambda: rows).collect(), key=lambda r: (r.doc_id is None, r.doc_id, r.f))
    every = [(r.f, True) for r in got if r.confirmed] + [(r.f, False) for r in got if r.drawn]
    weights, bias = fit([f for f, _ in every], np.array([p for _, p in every]), prior, len(vocabulary))
    return vocabulary, weights, bias


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: the result that the registered query returns."""
    model = train(docs, labels)

    def state():
        known = Known(model[0] if model else {})

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [0.0] * batch.num_rows
            if model:
                _, weights, bias = model
                found = [float(1 / (1 + np.exp(-np.clip(weights[known.of(t)].sum() + bias, -30, 30)))) for t in batch.column("text").to_pylist()]
            return pa.record_batch([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

        return step

    scored = map_rows(doc_texts(docs), "doc_id long, score double", state)
    return scored.select("doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is below the threshold; rows and columns stay as they are."""
    model = train(docs, labels)
    if not model:
        return docs
    vocabulary, weights, bias = model
    kinds = docs.schema

    def state():
        known = Known(vocabulary)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            low = [weights[known.of(t or "")].sum() + bias for t in batch.column("text").to_pylist()]
            return batch.filter(pa.array([1 / (1 + np.exp(-np.clip(x, -30, 30))) < THRESHOLD for x in low]))

        return step

    return map_rows(docs, kinds, state)
