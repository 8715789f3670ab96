"""Secret scans with structural confirmation.

Three base kinds come from patterns (assign, access, hex). Four more kinds are reported only when a candidate proves its
structure: base64 or hex is decoded, DER elements are walked until every nested length closes exactly, an OpenSSH body is
read by its length-prefixed fields, and a signed token must have a JSON header that names its algorithm. Candidates begin
where no letter of theirs stands before, and every pattern reads a text in time proportional to its length.

Null text counts as empty; an empty text has no spans; texts of any length are scanned whole. Repeated rows give
repeated results. Other columns of the input are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Offsets, doc_texts, map_rows, raw

BASE_KINDS = ("assign", "access", "hex")
CONFIRMED_KINDS = ("jwt", "pem", "der", "openssh")
RANK = {k: i for i, k in enumerate(BASE_KINDS + CONFIRMED_KINDS)}

ASSIGN = re.compile(rb"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_WORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
HEX = re.compile(rb"[0-9a-f]{24,}")
JWT = re.compile(rb"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]*+")
PEM = re.compile(rb"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----([A-Za-z0-9+/=\s\\]+)-----END \1-----")
DER64 = re.compile(rb"M[A-Za-z0-9+/_-]{39,}={0,2}")
DERHEX = re.compile(rb"30[0-9a-fA-F]{62,}")
SSH64 = re.compile(rb"b3BlbnNzaC1rZXktdjE[A-Za-z0-9+/]{40,}={0,2}")
WORD = re.compile(rb"[A-Za-z0-9+/_-]")


def _unbase64(data: bytes) -> bytes | None:
    data = data.rstrip(b"=").replace(b"-", b"+").replace(b"_", b"/")
    if len(data) % 4 == 1:
        return None
    try:
        return base64.b64decode(data + b"=" * (-len(data) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _elements(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, body start, body end) of the DER elements that fill data[start:end] exactly, else None."""
    out = []
    while start < end:
        if start + 2 > end:
            return None
        tag, size, body = data[start], data[start + 1], start + 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or body + n > end:
                return None
            size, body = int.from_bytes(data[body : body + n], "big"), body + n
        if body + size > end:
            return None
        out.append((tag, body, body + size))
        start = body + size
    return out


def is_der_key(data: bytes) -> bool:
    """A private or public key in DER: RSA, EC, wrapped private key, or subject public key."""
    top = _elements(data, 0, len(data))
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return False
    inner = _elements(data, top[0][1], top[0][2])
    if not inner:
        return False
    tags = [t for t, _, _ in inner]
    version = data[inner[0][1] : inner[0][2]]
    if tags == [0x02] * 9 and version in (b"\0", b"\1"):
        return True
    if tags[:2] == [0x02, 0x04] and version == b"\1":
        return True
    at = 1 if tags[:3] == [0x02, 0x30, 0x04] and version in (b"\0", b"\1") else 0 if tags == [0x30, 0x03] else None
    if at is None:
        return False
    algorithm = _elements(data, inner[at][1], inner[at][2])
    return bool(algorithm) and algorithm[0][0] == 0x06


def is_openssh_key(data: bytes) -> bool:
    magic, fields = b"openssh-key-v1\0", []
    if not data.startswith(magic):
        return False
    at = len(magic)
    for _ in range(3):  # cipher, kdf, kdf options
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return False
        fields.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    if not fields[0].isascii() or not 1 <= int.from_bytes(data[at : at + 4], "big") <= 16:
        return False
    at += 4
    size = int.from_bytes(data[at : at + 4], "big")
    return 0 < size <= len(data) - at - 4


def is_signed_token(token: bytes) -> bool:
    head, body, signature = token.split(b".", 2)
    try:
        header, claims = json.loads(_unbase64(head) or b""), json.loads(_unbase64(body) or b"")
    except (ValueError, UnicodeDecodeError, RecursionError):
        return False
    if not isinstance(header, dict) or not isinstance(claims, dict) or not isinstance(header.get("alg"), str):
        return False
    return header["alg"].lower() == "none" or bool(signature and _unbase64(signature))


def base_spans(data: bytes) -> list[tuple[str, int, int]]:
    out = []
    low = data.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(data) if len(m[1]) >= 6]
    if b"AKIA" in data:
        out += [("access", *m.span()) for m in ACCESS.finditer(data)]
    out += [("hex", *m.span()) for m in HEX.finditer(data)]
    return out


def confirmed_spans(data: bytes) -> list[tuple[str, int, int]]:
    out = []
    if b"eyJ" in data:
        out += [("jwt", *m.span()) for m in JWT.finditer(data) if is_signed_token(m[0])]
    armoured: list[tuple[int, int]] = []
    if b"-----BEGIN " in data:
        for m in PEM.finditer(data):
            body = _unbase64(re.sub(rb"\\[nr]|\s", b"", m[2]))
            if body and (is_der_key(body) or is_openssh_key(body)):
                armoured.append(m.span())
    out += [("pem", s, e) for s, e in armoured]
    begins = [s for s, _ in armoured]
    for kind, pattern, decode, proves in (
        ("der", DER64, _unbase64, is_der_key),
        ("der", DERHEX, lambda x: bytes.fromhex(x.decode()) if len(x) % 2 == 0 else None, is_der_key),
        ("openssh", SSH64, _unbase64, is_openssh_key),
    ):
        for m in pattern.finditer(data):
            if m.start() and WORD.match(data, m.start() - 1):
                continue  # inside a longer run
            k = bisect_right(begins, m.start()) - 1
            if k >= 0 and m.start() < armoured[k][1]:
                continue  # reported as the whole block
            body = decode(m[0])
            if body and proves(body):
                out.append((kind, *m.span()))
    return out


def find(data: bytes) -> tuple[list[tuple[str, int, int]], int]:
    """All spans in code points, base ones first in each place, and how many are base."""
    base = base_spans(data)
    spans = sorted(base + confirmed_spans(data), key=lambda x: (x[1], RANK[x[0]]))
    at = Offsets(data)
    return [(k, at(s), at(e)) for k, s, e in spans], len(base)


def join(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, and the spans of each kind: ``spans array<struct<kind,start,end>>``, code points, end exclusive."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [[{"kind": k, "start": s, "end": e} for k, s, e in find(t)[0]] for t in raw(batch, "text")]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        return pa.record_batch([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "spans"])

    return map_rows(doc_texts(docs), "doc_id long, spans array<struct<kind:string,start:long,end:long>>", lambda: step)


def digest(docs: DataFrame) -> DataFrame:
    """The result that the registered query returns: counts and digests of the base spans, and all spans as a string."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in raw(batch, "text"):
            spans, _ = find(text)
            base = [x for x in spans if x[0] in BASE_KINDS]
            counts = [sum(x[0] == k for x in base) for k in BASE_KINDS]
            rows.append((*counts, hashlib.sha256(join(base).encode()).hexdigest(), join(spans)))
        names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
        kinds = [pa.int64()] * 3 + [pa.string()] * 2
        cols = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
        return pa.record_batch([batch.column("doc_id"), *cols], ["doc_id", *names])

    return map_rows(doc_texts(docs), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string", lambda: step)
