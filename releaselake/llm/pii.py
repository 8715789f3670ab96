"""Personal data by a semi-Markov conditional random field over candidate windows.

Base spans come from four patterns and always stay. A semi-Markov CRF scores whole candidate segments (digit groups,
separators, octet ranges, check digit, address grammar, neighbours): at most ``MAX_TOKENS`` tokens of one line with an anchor among
them, which is a digit, ``@`` or bracketed "at". A bounded-length dynamic program chooses boundaries and types together. Segments
that it finds and that touch no base span are added. It runs over windows that reach ``MAX_TOKENS`` whole tokens beyond every anchor,
or to the line's end. No candidate leaves its window, so that this equals decoding the whole text.

The weights are fitted by gradient ascent on the segment likelihood, over at most ``TRAIN_WINDOWS`` windows of the given
documents, whose base spans serve as labels, and over windows made from a fixed set of formats with a fixed seed.

Null text counts as empty; an empty text has no spans; texts of any length are decoded whole, in memory that grows with the tokens of
a window but not with its candidates; repeated rows give repeated
results; an empty table trains on the made windows alone. Other columns are ignored, except by ``mask``, which keeps them.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Offsets, doc_texts, hash_fraction, map_rows, raw

KINDS = ("email", "ip", "card", "phone")
RANK = {k: i for i, k in enumerate(KINDS)}
TRAIN_DOCS = 20_000  # documents whose windows may be looked at for training
TRAIN_WINDOWS = 300  # windows that are taken of them
TRAIN_BYTES = 300  # the longest window that training looks at
MAX_TOKENS = 20  # of a segment
CHUNK = 4_000  # candidates that are scored at once

LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(rb"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
ANCHOR = re.compile(rb"[0-9]+|@|[(\[{][aA][tT][)\]}]")
TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|.", re.S)
_BYTE_TOKEN = rb"[A-Za-z]++|[0-9]++|[\x00-\x09\x0b-\x7f]|[\xc0-\xff][\x80-\xbf]*+"
BYTE_TOKEN = re.compile(_BYTE_TOKEN)
AHEAD = re.compile(rb"(?:%s){0,%d}+" % (_BYTE_TOKEN, MAX_TOKENS))


def luhn(digits: bytes | str) -> bool:
    d = [int(c) for c in (digits.decode() if isinstance(digits, bytes) else digits)][::-1]
    return sum(d[::2] + [x * 2 - 9 * (x > 4) for x in d[1::2]]) % 10 == 0


def base_spans(data: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in bytes, by kind and start."""
    out, last, at = [], 0, data.find(b"@")
    while at >= 0:
        start = at
        while start > last and data[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(data, at + 1)):
            out.append(("email", start, m.end()))
            last = m.end()
        at = data.find(b"@", max(at + 1, last))
    for m in IP.finditer(data):
        if all(len(x := p.lstrip(b"0")) <= 3 and int(x or b"0") <= 255 for p in m[0].split(b".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(data):
        if m.end() - m.start() >= 16 and 16 <= len(d := m[0].translate(None, b" -")) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(data):
        if 8 <= sum(48 <= c <= 57 for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def windows(data: bytes) -> list[tuple[int, int]]:
    """Byte ranges of MAX_TOKENS tokens around anchors, within their line; joined where they meet."""
    out: list[list[int]] = []
    for m in ANCHOR.finditer(data):
        e = AHEAD.match(data, m.end()).end()
        if out and m.start() <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
            continue
        s = _behind(data, m.start(), out[-1][1] if out else 0)
        if out and s <= out[-1][1]:
            out[-1][1] = e
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _behind(data: bytes, at: int, floor: int) -> int:
    """The start of the MAX_TOKENS tokens before an anchor, not before its line or ``floor``."""
    floor = max(floor, data.rfind(b"\n", floor, at) + 1)
    reach = 8 * MAX_TOKENS
    while True:
        s = max(floor, at - reach)
        while s > floor and (data[s] & 0xC0 == 0x80 or _kind(data[s]) and _kind(data[s]) == _kind(data[s - 1])):
            s -= 1
        sizes = [len(t) for t in BYTE_TOKEN.findall(data, s, at)]
        if s == floor or len(sizes) >= MAX_TOKENS:
            return max(floor, at - sum(sizes[-MAX_TOKENS:]))
        reach *= 4


def _kind(c: int) -> int:
    return 1 if 48 <= c <= 57 else 2 if 65 <= c <= 90 or 97 <= c <= 122 else 0


# Whole-span features -------------------------------------------------------------------------------------------------
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_SPELT = re.compile(r"[A-Za-z0-9._%+-]+ ?[(\[{]at[)\]}] ?[A-Za-z0-9-]+( ?(\.|[(\[{]dot[)\]}]) ?[A-Za-z0-9-]+)+", re.I)
_QUAD = re.compile(r"[0-9]{1,3}(\.[0-9]{1,3}){3}")
_DIAL = re.compile(r"(\+[0-9]{1,3}[ .-]?)?(\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{2,4}([ .-][0-9]{2,4})*")
_GROUPED = re.compile(r"[0-9]{4}([ -]?[0-9]{4}){3}([ -]?[0-9]{1,3})?")
_DATE = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{2,4}")
FEATURES = (
    "bias address spelt quad octets dial plus bracket grouped luhn date letters at_sign one_group digits<7 digits7-9 digits10-11 digits12-15"
    " digits16-19 digits>19 tokens>12 left_word right_word left_link right_link dots3 dots_other dashes spaces local_size short"
).split()
AT = {f: i for i, f in enumerate(FEATURES)}


def features(s: str, left: str, right: str) -> list[int]:
    digits = "".join(c for c in s if c.isascii() and c.isdigit())
    n, on = len(digits), ["bias"]
    on.append("digits<7" if n < 7 else "digits7-9" if n < 10 else "digits10-11" if n < 12 else "digits12-15" if n < 16 else "digits16-19" if n < 20 else "digits>19")
    dots = s.count(".")
    for name, holds in (
        ("address", _ADDRESS.fullmatch(s)), ("spelt", _SPELT.fullmatch(s)), ("quad", _QUAD.fullmatch(s)),
        ("octets", _QUAD.fullmatch(s) and all(int(x) < 256 for x in s.split("."))), ("dial", _DIAL.fullmatch(s)), ("plus", s[0] == "+"),
        ("bracket", "(" in s), ("grouped", _GROUPED.fullmatch(s)), ("luhn", 16 <= n <= 19 and luhn(digits)), ("date", _DATE.fullmatch(s)),
        ("letters", any(c.isalpha() for c in s)), ("at_sign", "@" in s), ("one_group", s.isdigit()), ("left_word", left.isalnum()),
        ("right_word", right.isalnum()), ("left_link", left in "./-+@:#=" and left), ("right_link", right in "/-+@:%" and right),
        ("dots3", dots == 3), ("dots_other", dots and dots != 3), ("dashes", "-" in s), ("spaces", " " in s), ("short", len(s) < 8),
    ):
        if holds:
            on.append(name)
    return [AT[x] for x in on]


def tokens_of(text: str) -> tuple[list[str], list[int], list[int]]:
    """The tokens, where each starts (with the end), and how many anchors came before each."""
    tokens = TOKEN.findall(text)
    starts = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(int).tolist()
    anchor = [t[0] in "0123456789@" or t.lower() == "at" and 0 < i < len(tokens) - 1 and tokens[i - 1] in "([{" and tokens[i + 1] in ")]}" for i, t in enumerate(tokens)]
    return tokens, starts, np.concatenate([[0], np.cumsum(anchor)]).astype(int).tolist()


def candidates(text: str, tokens: list[str], starts: list[int], seen: list[int]) -> Iterator[tuple[int, int, list[int]]]:
    """First token, end token and features of every candidate segment, ordered by their end, then their start."""
    opens = [bool(t[0].isascii() and t[0].isalnum() or t in "+(") and not (starts[a] and text[starts[a] - 1].isalnum()) for a, t in enumerate(tokens)]
    line = 0  # no segment starts before the line of its last token
    for b in range(1, len(tokens) + 1):
        last = tokens[b - 1]
        if last == "\n":
            line = b
            continue
        right = text[starts[b]] if b < len(tokens) else ""
        if not (last[0].isascii() and last[0].isalnum()) or right.isalnum():
            continue
        for a in range(max(line, b - MAX_TOKENS), b):
            if opens[a] and seen[b] > seen[a] and starts[b] - starts[a] >= 7:
                yield a, b, features(text[starts[a] : starts[b]], text[starts[a] - 1] if starts[a] else "", right)


def lattice(text: str) -> tuple[list[int], list[tuple[int, int]], list[list[int]]]:
    """Token starts (with the end), candidate segments as token ranges ordered by their end, and the features of each."""
    tokens, starts, seen = tokens_of(text)
    found = list(candidates(text, tokens, starts, seen))
    return starts, [(a, b) for a, b, _ in found], [f for _, _, f in found]


def _scores(weights: np.ndarray, feats: list[list[int]]) -> np.ndarray:
    """segments x kinds; a token outside segments scores 0."""
    flat = np.zeros((len(feats), len(FEATURES)))
    for i, f in enumerate(feats):
        flat[i, f] = 1
    return flat @ weights.T


def viterbi(weights: np.ndarray, text: str) -> list[tuple[str, int, int]]:
    """The best joint choice of boundaries and kinds, as code point spans. Candidates are scored in chunks; only the best one is kept for each end."""
    tokens, starts, seen = tokens_of(text)
    n, done = len(tokens), 0
    best, back = [0.0] * (n + 1), [(-1, 0)] * (n + 1)
    found = candidates(text, tokens, starts, seen)
    while part := list(islice(found, CHUNK)):
        scores = _scores(weights, [f for _, _, f in part])
        for (a, b, _), kind, value in zip(part, scores.argmax(1).tolist(), scores.max(1).tolist()):
            while done < b:
                done += 1
                best[done] = best[done - 1]
            if (x := best[a] + value) > best[b]:
                best[b], back[b] = x, (a, kind)
    out, j = [], done
    while j:
        a, kind = back[j]
        if a < 0:
            j -= 1
        else:
            out.append((KINDS[kind], starts[a], starts[j]))
            j = a
    return out[::-1]


def _made(rng: random.Random) -> tuple[str, list[tuple[str, int, int]]]:
    """A window with one entity or look-alike in words: formats with known labels."""
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 8)))

    def card(ok: bool) -> str:
        d = "4" + digits(14)
        fits = next(c for c in "0123456789" if luhn(d + c))
        d += fits if ok else str((int(fits) + rng.randint(1, 9)) % 10)
        sep = rng.choice(["", " ", "-"])
        return sep.join(d[i : i + 4] for i in range(0, 16, 4))

    octets = lambda top: ".".join(str(rng.randint(0, top)) for _ in range(4))
    kind, s = rng.choice(
        [
            ("email", f"{word()}.{digits(2)}@{word()}.{word()}"), ("email", f"{word()} (at) {word()} (dot) com"), ("email", f"{word()}[at]{word()}.org"),
            ("ip", octets(255)), ("card", card(True)), ("phone", f"+{rng.randint(1, 99)} ({digits(3)}) {digits(3)}-{digits(4)}"),
            ("phone", f"({digits(3)}) {digits(3)}-{digits(4)}"), ("phone", f"+{digits(2)} {digits(3)} {digits(3)} {digits(3)}"), ("phone", f"+{digits(11)}"),
            (None, card(False)), (None, f"{rng.randint(1900, 2099)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}"), (None, f"{rng.randint(1, 20)}.{rng.randint(0, 30)}.{rng.randint(0, 9)}"),
            (None, ".".join(str(rng.randint(256, 999)) for _ in range(4))), (None, digits(rng.randint(1, 15))), (None, f"{rng.randint(10, 23)}:{rng.randint(10, 59)}:{digits(2)}"),
            (None, f"{digits(3)} {word()} {digits(4)}"), (None, f"{word()}@{word()}"), (None, f"{digits(2)} {digits(2)} {digits(4)} {digits(3)}"), (None, digits(rng.randint(20, 40))),
            (None, f"{digits(4)}-{digits(4)}"), (None, f"{digits(3)}-{digits(2)}"), (None, f"{digits(2)} {digits(3)} {digits(3)}"),
        ]
    )
    before, after = f"{word()} {word()}{rng.choice([' ', ', ', ': '])}", f"{rng.choice([' ', ', ', '. '])}{word()} {word()}"
    return before + s + after, [(kind, len(before), len(before) + len(s))] if kind else []


def fit(given: list[str], epochs: int = 60, rate: float = 0.5, penalty: float = 2e-3, made: int = 400, seed: int = 7) -> np.ndarray:
    """Weights, kinds x features, that maximise the likelihood of the labelled segmentations less a quadratic penalty."""
    rng = random.Random(seed)
    examples = [_made(rng) for _ in range(made)]
    for text in given:
        data = text.encode()
        at = Offsets(data)
        examples.append((text, sorted(((k, at(s), at(e)) for k, s, e in base_spans(data)), key=lambda x: x[1])))
    ready = []
    for text, gold in examples:
        starts, segments, feats = lattice(text)
        place = {(starts[a], starts[b]): i for i, (a, b) in enumerate(segments)}
        want, last = [], -1
        for k, s, e in gold:
            if (i := place.get((s, e))) is not None and segments[i][0] >= last:
                want.append((i, RANK[k]))
                last = segments[i][1]
        if segments:
            hot = np.zeros((len(feats), len(FEATURES)))
            for i, f in enumerate(feats):
                hot[i, f] = 1
            ready.append((len(starts) - 1, segments, hot, want))
    weights = np.zeros((len(KINDS), len(FEATURES)))
    weights[:, 0] = -2.0
    moment = np.zeros_like(weights)
    for _ in range(epochs):
        grad = -penalty * weights * len(ready)
        for n, segments, hot, want in ready:
            scores = hot @ weights.T
            top = scores.max(1)
            total = (top + np.log(np.exp(scores - top[:, None]).sum(1))).tolist()
            forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
            i = 0
            for j in range(1, n + 1):
                x = forward[j - 1]
                while i < len(segments) and segments[i][1] == j:
                    x = np.logaddexp(x, forward[segments[i][0]] + total[i])
                    i += 1
                forward[j] = float(x)
            pull: dict[int, float] = {}
            i = len(segments) - 1
            for j in range(n, -1, -1):
                x = backward[j + 1] if j < n else 0.0
                backward[j] = float(np.logaddexp(x, pull[j])) if j in pull else x
                while i >= 0 and segments[i][1] == j:
                    a, v = segments[i][0], backward[j] + total[i]
                    pull[a] = float(np.logaddexp(pull[a], v)) if a in pull else v
                    i -= 1
            whole = forward[n]
            mass = np.exp([forward[a] + backward[b] - whole for a, b in segments])
            expected = (np.exp(scores) * mass[:, None]).T @ hot
            grad -= expected
            for i, k in want:
                grad[k] += hot[i]
        grad /= max(1, len(ready))
        moment = 0.9 * moment + grad
        weights += rate * moment
    return weights


def sample_windows(docs: DataFrame) -> list[str]:
    """At most TRAIN_WINDOWS windows of at most TRAIN_BYTES, chosen by their hashes in documents chosen by theirs."""
    n = docs.count()
    part = doc_texts(docs).where(hash_fraction(F.col("doc_id"), 2) < min(1.0, TRAIN_DOCS / max(n, 1)))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [data[s:e].decode() for data in raw(batch, "text") for s, e in windows(data) if e - s <= TRAIN_BYTES]
        return pa.record_batch([pa.array(found, pa.string())], ["w"])

    found = map_rows(part, "w string", lambda: step).distinct().orderBy(F.xxhash64("w"), "w").limit(TRAIN_WINDOWS)
    return [r.w for r in found.collect()]


def find(data: bytes, weights: np.ndarray) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans and added spans in code points, each by kind and start."""
    if not ANCHOR.search(data):
        return [], []
    base = base_spans(data)
    taken: list[list[int]] = []  # joined where they overlap, so that a search finds what a span touches
    for s, e in sorted((s, e) for _, s, e in base):
        if taken and s < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], e)
        else:
            taken.append([s, e])
    begins = [s for s, _ in taken]
    at = Offsets(data)
    added = []
    for s, e in windows(data):
        text, done, y = data[s:e].decode(), 0, s
        for kind, a, b in viterbi(weights, text):
            x = y + len(text[done:a].encode())
            done, y = b, x + len(text[a:b].encode())
            last = bisect_left(begins, y) - 1
            if last < 0 or taken[last][1] <= x:
                added.append((kind, at(x), at(y)))
    return [(k, at(s), at(e)) for k, s, e in base], sorted(added, key=lambda x: (RANK[x[0]], x[1]))


def join(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def digest(docs: DataFrame) -> DataFrame:
    """The result that the registered query returns: counts and digest of the base spans, and all spans as a string."""
    weights = fit(sample_windows(docs))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for data in raw(batch, "text"):
            base, added = find(data, weights)
            counts = [sum(x[0] == k for x in base) for k in KINDS]
            every = sorted(base + added, key=lambda x: (RANK[x[0]], x[1]))
            rows.append((*counts, hashlib.sha256(join(base).encode()).hexdigest(), join(every)))
        cols = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 4 + [pa.string()] * 2)]
        return pa.record_batch([batch.column("doc_id"), *cols], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return map_rows(doc_texts(docs), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string", lambda: step)


def mask(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets and n_chars counted anew; other columns, order and nulls stay."""
    weights = fit(sample_windows(docs))

    def masked(data: bytes) -> str:
        text = data.decode()
        base, added = find(data, weights)
        out, last = [], 0
        for k, s, e in sorted(base + added, key=lambda x: (x[1], -x[2])):
            if s >= last:
                out += [text[last:s], f"[{k.upper()}]"]
            last = max(last, e)
        return "".join(out) + text[last:]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [None if t is None else masked(t) if ANCHOR.search(t) else t.decode() for t in raw(batch, "text")]
        cols = dict(zip(batch.schema.names, batch.columns)) | {"text": pa.array(texts, pa.string())}
        if "n_chars" in cols:
            cols["n_chars"] = pa.array([n if t is None else len(t) for t, n in zip(texts, cols["n_chars"].to_pylist())], pa.int64())
        return pa.record_batch(list(cols.values()), list(cols))

    plain = docs.withColumn("n_chars", F.col("n_chars").cast("long")) if "n_chars" in docs.columns else docs
    return map_rows(plain, plain.schema, lambda: step)
