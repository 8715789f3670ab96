"""Best-fit packing of tokenised documents into fixed-length sequences, after a dominance reduction.

A document's token ids end with a separator id; a document longer than a sequence is cut into full pieces and one shorter
rest. How pieces share sequences depends on their lengths alone, so the plan is made from the count of each length, at
most ``capacity`` numbers whatever the input holds:

* Dominance reduction (Martello and Toth): going down the lengths, a set of at most three pieces is fixed for good where
  every other feasible set with the same longest piece can be exchanged into it: a piece that nothing fits beside, an
  exact pair, the largest partner where no two fit, and a partner with or without a third where no three fit.
* What is left is packed best fit, longest first, in whole runs of equal lengths.

The plan is a short list of runs (length, ranks, first sequence, pieces a sequence, offset). Each piece finds its run by
its rank among equal lengths. For that pieces are dealt by a salt and sorted there by length; how many of each length a
salt has reaches the driver, and tells where its ranks begin, so that a length that holds a third of all rows is ranked by
many tasks.

Null and empty texts have the separator alone. Repeated rows are packed each. An empty table gives no sequences. Texts are
tokenised whole; the tokenizer is read, never trained. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_texts, map_rows, materialize

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
SEPARATOR = 0
CACHED = 400_000  # words whose ids a task keeps
SALT_ROWS = 250_000  # pieces, of six numbers each, that are ranked together

# The tokenizer's own word pattern over the letters and digits below U+0250, which compose and change case without context.
_L, _N = "a-zA-Z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
WORDS = re.compile(f"[{_L}]+|'s|'t|'re|'ve|'m|'ll|'d|[{_N}]|[^{_L}{_N}]+")
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa1-\u012f\u0131-\u024f]|<\\|")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself where printable, else the next free one from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds(dict):
    """Ids of a string without white space, as little-endian 32-bit bytes; those not seen yet are cut and go to the model."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.letters = Tokenizer.from_file(path), _byte_letters()
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, word: str) -> bytes:
        spelt = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        out = []
        for w in WORDS.findall(chunk):
            ids = self.words.get(w)
            if ids is None:
                if len(self.words) >= CACHED:
                    self.words.clear()
                ids = self.words[w] = self.word(w)
            out.append(ids)
        if len(self) >= CACHED:
            self.clear()
        self[chunk] = found = b"".join(out)
        return found


def id_bytes(path: str | None = None):
    """A function that gives a text's ids as little-endian 32-bit bytes: by cached words, or whole where a text has unusual characters."""
    import public_tokenizers

    ids = WordIds(path or public_tokenizers.path(TOKENIZER))

    def encode(text: str) -> bytes:
        if UNUSUAL.search(text):
            return ids.whole(text)
        return b"".join(map(ids.__getitem__, text.lower().split()))

    return encode


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the pieces of every document, without the ids themselves."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def state():
        encode = id_bytes(path)
        end = np.array([SEPARATOR], "<u4").tobytes()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                data = encode(text) + end
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            return pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)], names)

        return step

    return map_rows(doc_texts(docs), "doc_id long, piece long, start long, length long, ids_crc32 long", state)


class Plan:
    """Runs of equal pieces and where they go."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left = capacity, {w: n for w, n in counts.items() if n}
        self.sequences, self.fixed = 0, 0
        self.rank: dict[int, int] = defaultdict(int)
        self.runs: list[tuple[int, int, int, int, int, int]] = []  # length, first rank, end rank, first sequence, pieces a sequence, offset

    def put(self, w: int, n: int, sequence: int, per: int, offset: int) -> None:
        self.runs.append((w, self.rank[w], self.rank[w] + n, sequence, per, offset))
        self.rank[w] += n
        self.left[w] -= n
        if not self.left[w]:
            del self.left[w]

    def fix(self, lengths: list[int], n: int) -> None:
        at = 0
        for w in lengths:
            self.put(w, n, self.sequences, 1, at)
            at += w
        self.sequences += n
        self.fixed += n * len(lengths)

    def reduce(self) -> None:
        for w in sorted(self.left, reverse=True):
            while w in self.left:
                found = self.dominating(w)
                if not found:
                    break
                n = min(self.left[x] // found.count(x) for x in found)
                self.fix(found, n)

    def dominating(self, w: int) -> list[int]:
        """The longest piece with a set that dominates every other feasible set with it, or nothing."""
        room, left = self.capacity - w, dict(self.left)
        left[w] -= 1
        sizes = sorted(x for x, n in left.items() if n and x <= room)
        if not sizes:
            return [w]
        k = sizes[-1]
        if k == room:
            return [w, k]
        low = [x for x in sizes[:3] for _ in range(min(3, left[x]))][:3]
        if len(low) < 2 or low[0] + low[1] > room:
            return [w, k]
        if len(low) == 3 and sum(low) <= room:
            return []  # three may fit: no proof by sets of three
        best = max((a + b for i, a in enumerate(sizes) for b in sizes[: i + 1] if a + b <= room and (a != b or left[a] > 1)), default=0)
        if best <= k:
            return [w, k]
        second = max((x for x in sizes if x <= room - k and (x != k or left[x] > 1)), default=0)
        middle = max((x for x in sizes if 2 * x <= room), default=0)
        return [w, k, second] if second and second >= middle else []

    def best_fit(self) -> None:
        open_: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left: (first sequence, how many)
        for w in sorted(self.left, reverse=True):
            while self.left.get(w):
                n = self.left[w]
                room = min((r for r in open_ if r >= w), default=0)
                if room:
                    first, bins = open_[room].pop()
                    if not open_[room]:
                        del open_[room]
                else:
                    room, first, bins = self.capacity, self.sequences, -(-n // (self.capacity // w))
                    self.sequences += bins
                per = room // w
                full = min(bins, n // per)
                if full:
                    self.put(w, full * per, first, per, self.capacity - room)
                    if room - per * w:
                        open_[room - per * w].append((first, full))
                rest = min(n - full * per, per - 1) if full < bins else 0
                if rest:
                    self.put(w, rest, first + full, per, self.capacity - room)
                    open_[room - rest * w].append((first + full, 1))
                if full + bool(rest) < bins:
                    open_[room].append((first + full + bool(rest), bins - full - bool(rest)))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    out = Plan(counts, capacity)
    out.reduce()
    out.best_fit()
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """The result that the registered query returns: every piece with its sequence and its offset there."""
    cut = materialize(pieces(docs, capacity, path), "pieces")
    salts = max(4 * docs.sparkSession.sparkContext.defaultParallelism, -(-cut.count() // SALT_ROWS))
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "length", "ids_crc32"), F.lit(salts)).cast("int"))
    each = np.zeros((salts, capacity + 1), np.int64)
    for r in salted.groupBy("salt", "length").agg(F.count("*").alias("n")).collect():  # at most ``capacity`` rows for each salt
        each[r.salt, r.length] = r.n
    made = plan(dict(enumerate(each.sum(axis=0).tolist())), capacity)
    first = (np.cumsum(each, axis=0) - each).ravel()  # by salt and length: its pieces' first rank
    runs = sorted(made.runs)
    keys = np.array([w << 44 | lo for w, lo, *_ in runs], np.int64)
    table = np.array(runs, np.int64).reshape(-1, 6)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def state():
        before = [-1, 0]  # the group of the last row of the batch before, and how many of its rows came

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            w, salt = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "salt"))
            group = salt * (capacity + 1) + w
            fresh = np.append(0, np.flatnonzero(group[1:] != group[:-1]) + 1)
            at = np.arange(len(group)) - np.repeat(fresh, np.diff(np.append(fresh, len(group))))
            if group[0] == before[0]:
                at[: fresh[1] if len(fresh) > 1 else None] += before[1]
            before[:] = group[-1], at[-1] + 1
            rank = first[group] + at
            run = table[np.searchsorted(keys, w << np.int64(44) | rank, side="right") - 1]
            k = rank - run[:, 1]
            sequence, offset = run[:, 3] + k // run[:, 4], run[:, 5] + k % run[:, 4] * w
            return pa.record_batch([*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"])

        return step

    dealt = salted.repartition(salts, "salt").coalesce(-(-salts // 2)).sortWithinPartitions("salt", "length", "doc_id", "piece", "ids_crc32")
    placed = map_rows(dealt, "doc_id long, piece long, start long, length long, ids_crc32 long, sequence_id long, offset long", state)
    return placed.withColumn("piece", F.col("piece").cast("int"))
