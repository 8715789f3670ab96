"""SentencePiece encoding with sampled segmentations, and lossless decoding.

A text's lattice has a node between any two characters and an edge for every piece of the vocabulary that fits there, besides
a chain of byte pieces for each character. An edge weighs 1 / (1 + rank of its piece), to the power ``theta``. Forward filtering sums
the weights of all paths to each node; backward sampling walks from the end, drawing each edge by its share. Draws come from a hash of
the row key, the place of the word and the step, so that a row gets the same segmentation in every layout and run.

A piece never crosses the end of a word, so that the lattice falls into one for each word with the spaces before it; forward tables
are filled for the distinct words of a walk of about ``WALK`` characters at once, which draws for all their occurrences. Longer texts take several walks,
cut at the ends of words; where no word ends within ``LONGEST`` characters the word is cut there, which no piece then crosses. A space is the piece letter U+2581; that letter itself, line
ends and whatever the vocabulary lacks go by byte pieces, and neither spaces nor case are changed, so that decoding gives back the
text exactly.

Null and empty texts have no pieces. Texts are encoded whole. Rows with equal keys and texts get equal segmentations. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import doc_texts, map_rows

MODEL = "piece_bpe_32k.model"
THETA = 0.2
SEED = 1
WALK = 500_000  # characters whose words are drawn together; bounds a task's memory
LONGEST = 65_536
CHUNK = re.compile(r" *[^ \n]+| +|\n")
WORD_END = re.compile(r"\n|[^ \n](?=[ \n])")
_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_SIEVE = (1 << 18) - 1


class Vocabulary:
    def __init__(self, path: str | None = None):
        import public_tokenizers
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(MODEL))
        self.bytes_: list[bytes] = []
        self.byte_ids = [0] * 256
        self.weights: dict[str, tuple[int, float]] = {}
        ranks = 0
        for i in range(len(model)):
            piece = model.id_to_piece(i)
            spelt = piece.replace("▁", " ")
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_.append(b"")
            else:
                self.weights[spelt] = (i, max(0.0, -model.get_score(i)))
                self.bytes_.append(spelt.encode())
                ranks = max(ranks, -model.get_score(i))
        self.byte_rank = ranks + 1.0
        self.longest = max(map(len, self.weights))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_.__getitem__, ids)).decode()


class Sampler:
    def __init__(self, vocabulary: Vocabulary, theta: float = THETA, seed: int = SEED):
        self.vocabulary, self.seed = vocabulary, seed
        by_length: dict[int, list[tuple[int, int, float]]] = {}
        for spelt, (i, rank) in vocabulary.weights.items():
            by_length.setdefault(len(spelt), []).append((self._starts(_points(spelt))[-1], i, -theta * math.log1p(rank)))
        self.tables = {n: tuple(np.array(c, t) for c, t in zip(zip(*sorted(rows)), (np.uint64, np.int64, np.float64))) for n, rows in by_length.items()}
        self.slots = {n: _slots(keys) for n, (keys, _, _) in self.tables.items()}
        self.kinds = [np.zeros(_SIEVE + 1, np.uint8) for _ in range(vocabulary.longest + 1)]  # by size and low bits of the hash: 1 a piece, 2 the start of longer ones
        for spelt in vocabulary.weights:
            for n, h in enumerate(self._starts(_points(spelt)), 1):
                self.kinds[n][h & _SIEVE] |= 1 if n == len(spelt) else 2
        self.byte_log = -theta * math.log1p(vocabulary.byte_rank)

    @staticmethod
    def _starts(points: np.ndarray) -> list[int]:
        """The hash of each start of the points, the whole of them last."""
        out, h = [], 0
        for c in _mix(points.astype(np.uint64)).tolist():
            h = (h * int(_ODD) + c) & (1 << 64) - 1
            out.append(h)
        return out

    def lattice(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Forward filtering of all words at once: running share in its group, piece and previous node of each edge; first edge of each node; last node of each word.

        A node is a place between characters; the edges into it form its group, groups are in order of their place in the word.
        A character that no piece spells alone has an edge numbered beyond the vocabulary, for its bytes."""
        points = _points("".join(words))
        sizes = np.array(list(map(len, words)), np.int64)
        first = np.cumsum(sizes) - sizes
        n = len(points)
        word = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(n) - np.repeat(first, sizes)
        room = np.repeat(sizes, sizes) - place
        node = np.arange(n) + word  # before each character
        starts, pieces, weights, lengths = [], [], [], []
        with np.errstate(over="ignore"):
            letter = _mix(points.astype(np.uint64))
            live, running = np.arange(n), letter
            for size in range(1, self.vocabulary.longest + 1):
                low = running.view(np.int64) & _SIEVE
                kind = self.kinds[size].take(low)
                if size in self.tables:
                    _, ids, logs = self.tables[size]
                    likely = np.flatnonzero(kind & 1)
                    at, fits = self._find(size, running[likely], low[likely])
                    hit, at = likely[fits], at[fits]
                    starts.append(live[hit])
                    pieces.append(ids[at])
                    weights.append(logs[at])
                    lengths.append(np.full(len(hit), size))
                    if size == 1:
                        alone = np.ones(len(live), bool)
                        alone[hit] = False
                        bare = live[alone]
                        starts.append(bare)
                        pieces.append(len(self.vocabulary.bytes_) + points[bare].astype(np.int64))
                        weights.append(self.byte_log * (1.0 + (points[bare] > 0x7F) + (points[bare] > 0x7FF) + (points[bare] > 0xFFFF)))
                        lengths.append(np.ones(len(bare), np.int64))
                on = np.flatnonzero((kind > 1) & (room > size))
                if not len(on):
                    break
                live, room = live[on], room[on]
                running = running[on] * _ODD + letter[live + size]
        begin, piece, weight, length = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, pieces, weights, lengths))
        level, end = place[begin] + length, node[begin] + length
        cuts = np.cumsum(np.bincount(level)) if len(level) else np.zeros(1, np.int64)
        order = _order(level * (n + len(words) + 1) + end)
        prev, piece, weight, end = node[begin[order]], piece[order], weight[order], end[order]
        fresh = np.ones(len(end), bool)
        fresh[1:] = end[1:] != end[:-1]
        heads = np.flatnonzero(fresh)
        ends = end[heads]
        first_of = np.full(n + len(words), -1, np.int64)
        first_of[ends] = heads
        width = np.diff(np.append(heads, len(end)))
        mass = np.zeros(n + len(words))
        groups = np.searchsorted(heads, cuts)
        share = np.empty(len(end))
        for lo, hi, g, h in zip(cuts[:-1].tolist(), cuts[1:].tolist(), groups[:-1].tolist(), groups[1:].tolist()):
            x = mass[prev[lo:hi]]
            x += weight[lo:hi]
            at, counts = heads[g:h] - lo, width[g:h]
            top = np.maximum.reduceat(x, at)
            x -= np.repeat(top, counts)
            e = np.exp(x, out=x)
            total = np.add.reduceat(e, at)
            mass[ends[g:h]] = top + np.log(total)
            run = np.cumsum(e)
            run -= np.repeat(run[at] - e[at], counts)
            np.divide(run, np.repeat(total, counts), out=share[lo:hi])
        if len(end):
            share[np.append(heads[1:], len(end)) - 1] = 1.0  # the last of a group is drawn if no other is
        return share, piece, prev, first_of, first + np.arange(len(words)) + sizes

    def _find(self, size: int, wanted: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash is among the pieces of that size, and whether it is there."""
        keys, (slot, more) = self.tables[size][0], self.slots[size]
        at = slot.take(low)
        fits = keys.take(at) == wanted
        if len(more):  # those whose slot another piece has
            rest = np.flatnonzero(~fits)
            other = more[np.minimum(np.searchsorted(keys[more], wanted[rest]), len(more) - 1)]
            found = keys[other] == wanted[rest]
            at[rest[found]], fits[rest[found]] = other[found], True
        return at, fits

    def encode(self, keys: list[int | None], texts: list[str]) -> Iterator[np.ndarray]:
        """The sampled ids of each text, in order."""
        for rows in _walks(texts):
            if len(rows) > 1 or len(texts[rows[0]]) <= WALK:
                yield from self._walk([keys[i] for i in rows], [texts[i] for i in rows])[0]
            else:
                found, words = [], 0
                for part in _parts(texts[rows[0]]):
                    (ids,), n = self._walk([keys[rows[0]]], [part], words)
                    found.append(ids)
                    words += n
                yield np.concatenate(found)

    def _walk(self, keys: list[int | None], texts: list[str], before: int = 0) -> tuple[list[np.ndarray], int]:
        """The ids of each text, and the number of words; ``before`` words of a single text came earlier."""
        found = [CHUNK.findall(text) for text in texts]
        counts = list(map(len, found))
        every = list(itertools.chain.from_iterable(found))
        if not every:
            return [np.zeros(0, np.int32) for _ in texts], 0
        known = dict.fromkeys(every)
        known = dict(zip(known, range(len(known))))
        share, piece, prev, first_of, last = self.lattice(list(known))
        kind, counts_ = np.array(list(map(known.__getitem__, every)), np.int64), np.array(counts, np.int64)
        first = np.concatenate([[0], np.cumsum(counts_)])
        with np.errstate(over="ignore"):
            place = np.arange(before, before + len(kind), dtype=np.int64) - np.repeat(first[:-1], counts_)
            key = np.array([(k if k is not None else -1) & (1 << 64) - 1 for k in keys], np.uint64)
            noise = _mix(np.repeat(_mix(key + _U(self.seed)), counts_) + place.astype(np.uint64) * _ODD)
            live = _order(kind)  # neighbours in the tables are read one after the other
            at = first_of[last[kind[live]]]
            drawn, length, step = [], np.zeros(len(kind), np.int64), 0
            while len(live):
                u = (_mix(noise[live] + _U(step * 2 + 1)) >> _U(11)).astype(np.float64) * ((1 - 1e-9) / float(1 << 53))
                on = np.flatnonzero(share[at] <= u)
                while len(on):
                    at[on] += 1
                    on = on[share[at[on]] <= u[on]]
                drawn.append((live, piece[at]))
                length[live] += 1
                at = first_of[prev[at]]
                on = np.flatnonzero(at >= 0)
                live, at, step = live[on], at[on], step + 1
        stop = np.cumsum(length)
        ids = np.zeros(int(stop[-1]), np.int64)
        for k, (who, what) in enumerate(drawn):
            ids[stop[who] - 1 - k] = what
        cuts = np.concatenate([[0], stop])[first].tolist()
        return [self._spelt(ids[a:b]) for a, b in zip(cuts, cuts[1:])], len(kind)

    def _spelt(self, ids: np.ndarray) -> np.ndarray:
        """Numbers beyond the vocabulary become the byte pieces of their character."""
        size, chain = len(self.vocabulary.bytes_), self.vocabulary.byte_ids
        bare = np.flatnonzero(ids >= size)
        if not len(bare):
            return ids.astype(np.int32)
        out, at = [], 0
        for i in bare.tolist():
            out += [ids[at:i], np.array([chain[b] for b in chr(int(ids[i]) - size).encode()], np.int64)]
            at = i + 1
        return np.concatenate([*out, ids[at:]]).astype(np.int32)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _slots(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By the low bits of a hash a key that has them, and the other keys that share theirs, in order."""
    low = (keys & _U(_SIEVE)).astype(np.int64)
    slot = np.zeros(_SIEVE + 1, np.int32)
    slot[low[::-1]] = np.arange(len(keys))[::-1]
    return slot, np.flatnonzero(slot[low] != np.arange(len(keys)))


def _order(keys: np.ndarray) -> np.ndarray:
    """A stable order of numbers from 0 on, by sixteen bits at a time, for which the sort counts."""
    order, shift, most = None, 0, int(keys.max()) if len(keys) else 0
    while order is None or most >> shift:
        digit = (keys >> shift).astype(np.uint16)
        order = np.argsort(digit, kind="stable") if order is None else order[np.argsort(digit[order], kind="stable")]
        shift += 16
    return order


def _walks(texts: list[str]) -> Iterator[list[int]]:
    """Rows whose texts go in one walk; a longer text is alone."""
    rows, size = [], 0
    for i, t in enumerate(texts):
        if rows and size + len(t) > WALK:
            yield rows
            rows, size = [], 0
        rows.append(i)
        size += len(t)
    if rows:
        yield rows


def _parts(text: str) -> Iterator[str]:
    """A long text in pieces of about ``WALK`` characters that end with a word."""
    at = 0
    while len(text) - at > WALK + LONGEST:
        m = WORD_END.search(text, at + WALK - 1, at + WALK + LONGEST)
        cut = m.end() if m else at + WALK + LONGEST
        yield text[at:cut]
        at = cut
    yield text[at:]


def encode(docs: DataFrame, path: str | None = None, theta: float = THETA, seed: int = SEED) -> DataFrame:
    """doc_id and the sampled ids of its whole text; no shuffle."""

    def state():
        sampler = Sampler(Vocabulary(path), theta, seed)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            return pa.record_batch([batch.column("doc_id"), pa.array(list(sampler.encode(keys, texts)), pa.list_(pa.int32()))], ["doc_id", "ids"])

        return step

    return map_rows(doc_texts(docs), "doc_id long, ids array<int>", state)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the text that the ids spell."""

    def state():
        vocabulary = Vocabulary(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.record_batch([batch.column("doc_id"), pa.array([vocabulary.decode(x or []) for x in batch.column("ids").to_pylist()], pa.string())], ["doc_id", "text"])

        return step

    return map_rows(encoded.select("doc_id", "ids"), "doc_id long, text string", state)


def digest(docs: DataFrame, path: str | None = None, theta: float = THETA, seed: int = SEED) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (little-endian 32-bit ids), decoded_sha256, lossless: the result that the registered query returns."""

    def state():
        vocabulary = Vocabulary(path)
        sampler = Sampler(vocabulary, theta, seed)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            rows = []
            for text, ids in zip(texts, sampler.encode(keys, texts)):
                back = vocabulary.decode(ids.tolist())
                rows.append((len(ids), zlib.crc32(ids.astype("<u4").tobytes()), hashlib.sha256(back.encode()).hexdigest(), back == text))
            cols = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.bool_()))]
            return pa.record_batch([batch.column("doc_id"), *cols], ["doc_id", "n_ids", "ids_crc32", "decoded_sha256", "lossless"])

        return step

    return map_rows(doc_texts(docs), "doc_id long, n_ids long, ids_crc32 long, decoded_sha256 string, lossless boolean", state)
