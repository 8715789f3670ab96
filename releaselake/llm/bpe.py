"""Byte-level BPE encoding and decoding, with a queue of merges made for very long pre-tokens.

A text is cut into pre-tokens by the vocabulary's pattern. Each pre-token that is no token itself starts as its bytes, a linked list of places. Merges
wait in buckets, one for each rank, that hold places of the list; which buckets hold any is told by a bitmap of three levels, so that
three find-first-set steps give the lowest rank. Within a bucket the leftmost place comes first. A merge changes the ranks of two pairs, whose
old entries stay and are skipped when they come up, since the rank that a place has now differs from theirs. So a pre-token of n bytes takes time in
the order of n log n, whatever it looks like.

Short pre-tokens are merged many at a time: their bytes lie in one list, with no pair across their ends, and a bucket's places are merged together,
as merges in different pre-tokens do not meet. Within one, all places of a rank go at once if no pair with the new token can have a lower rank, else one after another.

Words repeat, so that a task encodes each chunk (white space and the word after it) once and then works with their numbers; it forgets them
beyond ``CACHED``. A chunk never shares a pre-token with its neighbours. Long texts are taken in walks of about ``WALK`` characters, cut between
chunks; a chunk that does not end is held whole, since its ids depend on all of it.

Null and empty texts have no ids and decode to nothing. Rows with a null or repeated doc_id are each encoded. An empty table gives an empty
result. Other columns are ignored. Special tokens are not known: their strings are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_texts, map_rows

RANKS = "byte_bpe_multi_50k.tiktoken"
CACHED = 400_000  # chunks after which a task forgets them
WALK = 500_000  # characters of a text that are encoded together
LOT = 16_000_000  # characters whose new chunks are merged together; bounds a task's memory
LONG = 1_024  # bytes from which a pre-token is merged alone
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # what the pattern's \s stands for
CHUNK = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
CHUNK_END = re.compile(f"[^{_SPACE}](?=[{_SPACE}])")
BITS, MASK = 6, 63


def read_ranks(path: str | None = None) -> dict[bytes, int]:
    import public_tokenizers

    with open(path or public_tokenizers.path(RANKS), "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RankBits:
    """A set of ranks below ``size``, at most 2 ** 18, as a bitmap of three levels: a bit above stands for a word below that is not zero."""

    def __init__(self, size: int):
        if size > 1 << 3 * BITS:
            raise ValueError(f"{size} ranks need a fourth level")
        self.low, self.mid, self.top = [0] * ((size >> BITS) + 1), [0] * ((size >> 2 * BITS) + 1), 0

    def add(self, rank: int) -> None:
        word = rank >> BITS
        self.low[word] |= 1 << (rank & MASK)
        self.mid[word >> BITS] |= 1 << (word & MASK)
        self.top |= 1 << (word >> BITS)

    def first(self) -> int:
        """The lowest rank, or -1."""
        top = self.top
        if not top:
            return -1
        high = (top & -top).bit_length() - 1
        mid = self.mid[high]
        word = high << BITS | (mid & -mid).bit_length() - 1
        low = self.low[word]
        return word << BITS | (low & -low).bit_length() - 1

    def drop(self, rank: int) -> None:
        word, high = rank >> BITS, rank >> 2 * BITS
        self.low[word] &= ~(1 << (rank & MASK))
        if not self.low[word]:
            self.mid[high] &= ~(1 << (word & MASK))
            if not self.mid[high]:
                self.top &= ~(1 << high)


class Merger:
    """Ids of pre-tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.size = ranks, 1 + max(ranks.values())
        self.longest = max(map(len, ranks))
        self.single = [ranks[bytes([b])] for b in range(256)]
        found = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        a, b, r = (np.array(x, np.int64) for x in zip(*found))
        order = np.argsort(a * self.size + b)
        self.keys, self.values = (a * self.size + b)[order], r[order]
        self.lower = np.zeros(self.size, bool)  # tokens that may meet another in a pair of a lower rank than their own
        self.lower[a[a > r]] = True
        self.lower[b[b > r]] = True

    def one(self, piece: bytes) -> list[int]:
        """Ids of a pre-token by itself."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, ranks, longest = len(piece), self.ranks, self.longest
        bits, buckets = RankBits(self.size), {}
        token = [self.single[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [-1] * n  # the rank of a place's token with the next one; -1 if they do not merge

        def push(i: int, end: int) -> None:
            r = ranks.get(piece[i:end]) if end - i <= longest else None
            pair[i] = -1 if r is None else r
            if r is None:
                return
            if r in buckets:
                heappush(buckets[r], i)
            else:
                buckets[r] = [i]
                bits.add(r)

        for i in range(n - 1):
            push(i, i + 2)
        while (r := bits.first()) >= 0:
            i = heappop(buckets[r])
            if not buckets[r]:
                del buckets[r]
                bits.drop(r)
            if pair[i] != r:
                continue  # stale
            gone = after[i]
            end = after[gone]
            token[i], after[i], pair[gone], pair[i] = r, end, -1, -1
            if end < n:
                before[end] = i
                push(i, after[end])
            if i:
                push(before[i], end)
        out, i = [], 0
        while i < n:
            out.append(token[i])
            i = after[i]
        return out

    def many(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens that are no tokens, one after another, and how many each has."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        starts = np.cumsum(lengths) - lengths
        n = int(lengths.sum())
        end_of_all, none = n, self.size  # the place beyond every end, and its token, which no pair has
        token = np.append(np.array(self.single, np.int64)[np.frombuffer(b"".join(pieces), np.uint8)], none)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[starts + lengths - 1], after[n], before[starts] = end_of_all, end_of_all, end_of_all
        pair = np.full(n + 1, -1, np.int64)
        alive = np.ones(n + 1, bool)
        alive[n] = False
        bits, buckets = RankBits(self.size), {}

        def push(places: np.ndarray) -> None:
            key = token[places] * self.size + token[after[places]]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            fits = (self.keys[at] == key) & (token[after[places]] != none)
            ranks = np.where(fits, self.values[at], -1)
            pair[places] = ranks
            places, ranks = places[fits], ranks[fits]
            if not len(places):
                return
            if len(places) > 1:
                order = np.argsort(ranks, kind="stable")
                places, ranks = places[order], ranks[order]
                cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
                groups = zip(ranks[np.append(0, cuts)].tolist(), [0, *cuts.tolist()], [*cuts.tolist(), len(ranks)])
            else:
                groups = ((int(ranks[0]), 0, 1),)
            for r, lo, hi in groups:
                if r in buckets:
                    buckets[r].append(places[lo:hi])
                else:
                    buckets[r] = [places[lo:hi]]
                    bits.add(r)

        push(np.arange(n))
        while (r := bits.first()) >= 0:
            held = buckets.pop(r)
            bits.drop(r)
            places = held[0] if len(held) == 1 else np.sort(np.concatenate(held))
            places = places[pair[places] == r]  # the others are stale
            if not len(places):
                continue
            if len(places) > 1:
                if self.lower[r]:
                    piece = np.searchsorted(starts, places, side="right")
                    first = np.append(True, piece[1:] != piece[:-1])
                    if not first.all():
                        buckets[r] = [places[~first]]
                        bits.add(r)
                        places = places[first]
                else:
                    touch = after[places[:-1]] == places[1:]
                    if touch.any():  # every second one of a run, from its left
                        begins = np.append(True, ~touch)
                        at = np.arange(len(places))
                        places = places[(at - np.maximum.accumulate(np.where(begins, at, 0))) % 2 == 0]
            gone = after[places]
            end = after[gone]
            token[places], after[places], before[end] = r, end, places
            pair[gone], alive[gone] = -1, False
            left = before[places]
            left = left[left != end_of_all]
            if len(left):
                places = np.sort(np.concatenate([places, left]))
                places = places[np.append(True, places[1:] != places[:-1])]
            push(places)
        return token[alive], np.add.reduceat(alive[:n].astype(np.int64), starts)

    def all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of any pre-tokens, one after another, and how many each has."""
        whole = list(map(self.ranks.get, pieces))
        tokens = [i for i, r in enumerate(whole) if r is not None]
        rest = [i for i, r in enumerate(whole) if r is None]
        short, long = [i for i in rest if len(pieces[i]) < LONG], [i for i in rest if len(pieces[i]) >= LONG]
        flat, counts = self.many([pieces[i] for i in short]) if short else (np.empty(0, np.int64), np.empty(0, np.int64))
        alone = [np.array(self.one(pieces[i]), np.int64) for i in long]
        flat = np.concatenate([np.array([whole[i] for i in tokens], np.int64), flat, *alone])
        lengths = np.concatenate([np.ones(len(tokens), np.int64), counts, np.array([len(x) for x in alone], np.int64)])
        place = np.empty(len(pieces), np.int64)
        place[np.array([*tokens, *short, *long], np.int64)] = np.arange(len(pieces))
        return gathered(flat, lengths, place), lengths[place]


class Numbered(dict):
    """Numbers from 0 for keys as they come up."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


def gathered(flat: np.ndarray, lengths: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The chosen ones of values of given lengths that lie one after another."""
    length = lengths[chosen]
    ends = np.cumsum(length)
    if not len(ends):
        return flat[:0]
    starts = (np.cumsum(lengths) - lengths)[chosen]
    return flat[np.repeat(starts - (ends - length), length) + np.arange(ends[-1])]


class Chunks:
    """Numbers of chunks, and the ids of chunks by number once those that came up are merged."""

    def __init__(self, ranks: dict[bytes, int]):
        import public_tokenizers
        import regex

        self.merger, self.cut = Merger(ranks), regex.compile(public_tokenizers.PATTERN).findall
        self.forget()

    def forget(self) -> None:
        self.chunks, self.done = Numbered(), 0
        self.flat, self.lengths, self.starts = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def numbers(self, text: str) -> np.ndarray:
        found = CHUNK.findall(text)
        return np.fromiter(map(self.chunks.__getitem__, found), np.int64, len(found))

    def merge(self) -> None:
        pieces = Numbered()
        cuts = list(map(self.cut, islice(self.chunks, self.done, None)))
        counts, of_chunk = list(map(len, cuts)), [pieces[p] for cut in cuts for p in cut]
        flat, lengths = self.merger.all([p.encode() for p in pieces])
        of_chunk, counts = np.array(of_chunk, np.int64), np.array(counts, np.int64)
        self.flat = np.concatenate([self.flat, gathered(flat, lengths, of_chunk)])
        ends = np.append(0, np.cumsum(lengths[of_chunk]))[np.append(0, np.cumsum(counts))]
        self.lengths = np.concatenate([self.lengths, np.diff(ends)])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.done = len(self.chunks)

    def ids(self, numbers: np.ndarray) -> bytes:
        """The ids of chunks one after another, as little-endian 32-bit bytes."""
        length = self.lengths[numbers]
        ends = np.cumsum(length)
        if not len(ends):
            return b""
        return self.flat[np.repeat(self.starts[numbers] - (ends - length), length) + np.arange(ends[-1])].astype("<u4").tobytes()


class Decoder:
    """Bytes of ids: every id's bytes are gathered from one table."""

    def __init__(self, ranks: dict[bytes, int]):
        by_id = [b""] * (1 + max(ranks.values()))
        for token, rank in ranks.items():
            by_id[rank] = token
        self.length = np.array([len(t) for t in by_id], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.table = np.frombuffer(b"".join(by_id), np.uint8)

    def __call__(self, ids: bytes) -> bytes:
        i = np.frombuffer(ids, "<u4")
        length = self.length[i]
        ends = np.cumsum(length)
        if not len(i):
            return b""
        return self.table[np.repeat(self.start[i] - (ends - length), length) + np.arange(ends[-1])].tobytes()


def walks(text: str) -> Iterator[str]:
    """The text in parts of about ``WALK`` characters that end between chunks."""
    at = 0
    while len(text) - at > WALK and (m := CHUNK_END.search(text, at + WALK)):
        yield text[at : m.end()]
        at = m.end()
    yield text[at:] if at else text


class Encoder:
    """The ids of texts, walk by walk."""

    def __init__(self, path: str | None = None):
        self.table = Chunks(read_ranks(path))

    def __call__(self, texts: Iterator[str]) -> Iterator[tuple[int, bytes]]:
        """(place of the text, ids of its next walk), in order."""
        waiting, held = [], 0
        for at, text in enumerate(texts):
            for part in walks(text):
                waiting.append((at, self.table.numbers(part)))
                held += len(part)
                if held > LOT:
                    yield from self.flush(waiting)
                    waiting, held = [], 0
        yield from self.flush(waiting)

    def flush(self, waiting: list[tuple[int, np.ndarray]]) -> Iterator[tuple[int, bytes]]:
        self.table.merge()
        for at, numbers in waiting:
            yield at, self.table.ids(numbers)
        if len(self.table.chunks) > CACHED:
            self.table.forget()


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids: the ids of every text as an array."""

    def state():
        encoder = Encoder(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids: list[list[bytes]] = [[] for _ in range(batch.num_rows)]
            for at, part in encoder(t.as_py() for t in batch.column("text")):
                ids[at].append(part)
            rows = [np.frombuffer(b"".join(x), "<u4").astype(np.int32) for x in ids]
            return pa.record_batch([batch.column("doc_id"), pa.array(rows, pa.list_(pa.int32()))], ["doc_id", "ids"])

        return step

    return map_rows(doc_texts(docs), "doc_id long, ids array<int>", state)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, content: the bytes that the ids of each row (doc_id, ids) stand for, which are a text's UTF-8 if the ids are those of a text."""

    def state():
        decoded = Decoder(read_ranks(path))

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [decoded(np.array(x or [], "<u4").tobytes()) for x in batch.column("ids").to_pylist()]
            return pa.record_batch([batch.column("doc_id"), pa.array(rows, pa.binary())], ["doc_id", "content"])

        return step

    return map_rows(encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids"), "doc_id long, content binary", state)


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: the result that the registered query returns. Ids are decoded walk by walk, so that no document's ids are held whole."""
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def state():
        encoder, decoded = Encoder(path), Decoder(read_ranks(path))

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = [0] * batch.num_rows
            of_ids, of_bytes = ([hashlib.sha256() for _ in counts] for _ in range(2))
            for at, ids in encoder(t.as_py() for t in batch.column("text")):
                counts[at] += len(ids) // 4
                of_ids[at].update(ids)
                of_bytes[at].update(decoded(ids))
            return pa.record_batch([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array([h.hexdigest() for h in of_ids]), pa.array([h.hexdigest() for h in of_bytes])], names)

        return step

    return map_rows(doc_texts(docs), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", state)
