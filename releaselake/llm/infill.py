"""Fill-in-the-middle transformation over texts kept as seekable compressed frames.

A text is stored as zstandard frames of about ``FRAME`` bytes, each compressed by itself, with the counts of units and code points before it. A
unit is white space with the word after it, or the white space at a text's end; it counts for the frame that it ends in, so that a frame may end within one. A
cut after so many units is found by the counts, and only the frame that holds it is decompressed. The transformed text is written as
frames too: whole ones are taken over as they are, cut ones are compressed anew, and markers get frames of their own. Digests stream the frames in
order, one decompressed at a time. The text comes back from the transformed one alone: its markers are looked for frame by frame, with the
ends of the frame before, and what lies between them is streamed in the text's order.

The seed and doc_id decide the cuts and the form. A null doc_id counts as an empty one; null and empty texts, and those that hold a marker,
stay plain, so that a marker in the output is never the text's own. Repeated rows get equal results. An empty table gives an empty result. Other columns are ignored.
Frames are held compressed, so that a task's memory follows the batch that it is given.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_texts, map_rows

SEED = 42
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
SHARE, SPM = 50, 80  # of a hundred texts that may be cut, and of those that are, the ones with the suffix first
FRAME = 1 << 16
LEVEL = 1
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SPACE = b" \t\n\x0b\x0c\r"
FRAMES = "array<struct<units:bigint,chars:bigint,data:binary>>"
STORED = pa.list_(pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("data", pa.binary())]))


class Frame(NamedTuple):
    """A frame with the units that end in it and its code points."""

    units: int
    chars: int
    data: bytes


def chars(data: bytes) -> int:
    return len(data.decode())


class Codec:
    """One compressor and one decompressor for a task."""

    def __init__(self):
        self.pack = zstandard.ZstdCompressor(level=LEVEL).compress
        self.open = zstandard.ZstdDecompressor().decompress

    def store(self, text: bytes) -> list[Frame]:
        out, at = [], 0
        while at < len(text):
            end = min(len(text), at + FRAME)
            while end < len(text) and text[end] & 0xC0 == 0x80:  # never within a code point
                end -= 1
            part = text[at:end]
            out.append(Frame(units(part, text[end : end + 1]), chars(part), self.pack(part)))
            at = end
        return out

    def split(self, frames: list[Frame], cuts: list[int]) -> list[list[Frame]]:
        """The frames between cuts, which are counts of units in ascending order; only frames that hold a cut are opened."""
        out: list[list[Frame]] = [[]]
        before, k = 0, 0
        for f in frames:
            while k < len(cuts) and cuts[k] == 0:
                out.append([])
                k += 1
            if k == len(cuts) or cuts[k] > before + f.units or not f.units:
                out[-1].append(f)
                before += f.units
                continue
            part, at, done = self.open(f.data), 0, 0
            ends = unit_ends(part, f.units)
            while k < len(cuts) and cuts[k] <= before + f.units:
                here = ends[cuts[k] - before - 1]
                if here > at:
                    piece = part[at:here]
                    out[-1].append(Frame(cuts[k] - before - done, chars(piece), self.pack(piece)))
                out.append([])
                at, done, k = here, cuts[k] - before, k + 1
            if at < len(part):
                piece = part[at:]
                out[-1].append(Frame(f.units - done, chars(piece), self.pack(piece)))
            before += f.units
        return out + [[] for _ in range(len(cuts) - k)]

    def stream(self, frames: Iterable[bytes]) -> str:
        """The SHA-256 of what the frames hold, one after another."""
        digest = hashlib.sha256()
        for data in frames:
            digest.update(self.open(data))
        return digest.hexdigest()

    def parted(self, output: list[bytes], form: str) -> dict[bytes, list[bytes]]:
        """The parts of a transformed text by the marker before them, as frames."""
        parts: dict[bytes, list[bytes]] = {}
        marks, held, tail = list(ORDER[form]), None, b""
        for data in output:
            part = tail + self.open(data)
            at, whole = 0, not tail
            while marks and (found := part.find(marks[0], at)) >= 0:
                if held is not None and found > at:
                    held.append(self.pack(part[at:found]))
                at, whole = found + len(marks[0]), False
                held = parts.setdefault(marks.pop(0), [])
            keep = open_end(part[at:], marks[0]) if marks else 0  # what may be the start of the next marker waits
            rest = part[at : len(part) - keep]
            if rest and held is not None:
                held.append(data if whole and not keep else self.pack(rest))
            tail = part[len(part) - keep :]
        if tail and held is not None:
            held.append(self.pack(tail))
        return parts

    def restored(self, output: list[bytes], form: str) -> Iterator[bytes]:
        """The frames of the text that a transformed one was made from."""
        if form == "plain":
            yield from output
            return
        parts = self.parted(output, form)
        for mark in (PREFIX, MIDDLE, SUFFIX):
            yield from parts.get(mark, ())


def open_end(data: bytes, mark: bytes) -> int:
    """How many of the last bytes may begin a marker."""
    return next((k for k in range(len(mark) - 1, 0, -1) if data.endswith(mark[:k])), 0)


def unit_ends(part: bytes, count: int) -> list[int]:
    """Where the units of a frame end; ``count`` tells whether the last word or white space goes on in the next frame."""
    ends = [m.end() for m in WORD.finditer(part)]
    if len(ends) < count:
        ends.append(len(part))
    return ends[:count]


def units(part: bytes, following: bytes) -> int:
    """The units that end in a part of a text, given the byte that follows it, or nothing at the end."""
    n = sum(1 for _ in WORD.finditer(part))
    if part[-1] in SPACE:
        return n + (not following)
    return n - (bool(following) and following not in SPACE)


def frames(docs: DataFrame) -> DataFrame:
    """doc_id, marked (the text holds a marker), frames: every text as its frames in order, each with its units and code points."""
    text = F.col("text")
    marked = F.lit(False)
    for m in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(text, F.lit(m.decode()))

    def state():
        codec = Codec()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            stored = pa.array([[f._asdict() for f in codec.store(t.as_py())] for t in batch.column("text").cast(pa.binary())], STORED)
            return pa.record_batch([batch.column("doc_id"), batch.column("marked"), stored], ["doc_id", "marked", "frames"])

        return step

    return map_rows(doc_texts(docs).withColumn("marked", marked), f"doc_id long, marked boolean, frames {FRAMES}", state)


def chosen(stored: DataFrame, seed: int = SEED) -> DataFrame:
    """Stored texts with n, form, first and second: how many units they have, what becomes of them, and after how many units they are cut."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = lambda i: F.conv(F.substring(key, 8 * i + 1, 8), 16, 10).cast("long")
    n = F.aggregate("frames", F.lit(0).cast("long"), lambda a, f: a + f["units"])
    plain = (F.size("frames") == 0) | F.col("marked") | (h(2) % 100 >= SHARE)
    form = F.when(plain, "plain").when(h(3) % 100 < SPM, "spm").otherwise("psm")
    cut = lambda i: h(i) % (F.col("n") + 1)
    return stored.withColumn("n", n).select("doc_id", "frames", "n", form.alias("form"), F.least(cut(0), cut(1)).alias("first"), F.greatest(cut(0), cut(1)).alias("second"))


def transformed(stored: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output: the transformed texts as compressed frames in order."""
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def state():
        codec = Codec()
        marker = {m: codec.pack(m) for m in (PREFIX, SUFFIX, MIDDLE)}

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            before, within, outputs = [], [], []
            for held, form, a, b in zip(batch.column("frames"), batch.column("form").to_pylist(), batch.column("first").to_pylist(), batch.column("second").to_pylist()):
                text = [Frame(**f) for f in held.as_py()]
                if form == "plain":
                    before.append(None)
                    within.append(None)
                    outputs.append([f.data for f in text])
                    continue
                prefix, middle, suffix = codec.split(text, [a, b])
                part = {PREFIX: prefix, MIDDLE: middle, SUFFIX: suffix}
                before.append(sum(f.chars for f in prefix))
                within.append(sum(f.chars for f in middle))
                outputs.append([data for m in ORDER[form] for data in (marker[m], *(f.data for f in part[m]))])
            columns = [*(batch.column(c) for c in names[:3]), pa.array(before, pa.int64()), pa.array(within, pa.int64()), pa.array(outputs, pa.list_(pa.binary()))]
            return pa.record_batch(columns, names)

        return step

    return map_rows(chosen(stored, seed), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output array<binary>", state)


def digest(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256: the result that the registered query returns, digests of what the frames hold."""
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]

    def state():
        codec = Codec()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            of_output, of_text = [], []
            for held, form in zip(batch.column("output"), batch.column("form").to_pylist()):
                output = held.as_py()
                of_output.append(codec.stream(output))
                of_text.append(codec.stream(codec.restored(output, form)))
            return pa.record_batch([*(batch.column(c) for c in names), pa.array(of_output), pa.array(of_text)], [*names, "output_sha256", "restored_sha256"])

        return step

    return map_rows(transformed(frames(docs), seed), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string", state)


def texts(made: DataFrame) -> DataFrame:
    """doc_id, text: the texts that transformed rows (doc_id, form, output) were made from."""

    def state():
        codec = Codec()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [b"".join(map(codec.open, codec.restored(held.as_py(), form))).decode() for held, form in zip(batch.column("output"), batch.column("form").to_pylist())]
            return pa.record_batch([batch.column("doc_id"), pa.array(rows, pa.string())], ["doc_id", "text"])

        return step

    return map_rows(made.select("doc_id", "form", "output"), "doc_id long, text string", state)


def oracle_sql(seed: int = SEED) -> str:
    """The same rows in SQL; a text comes back as it is."""
    h = [f"CAST(concat('0x', substr(k, {8 * i + 1}, 8)) AS BIGINT)" for i in range(4)]
    part = lambda a, b: f"array_to_string(list_slice(u, {a}, {b}), '')"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256(concat('{seed}:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS k FROM documents),
c AS (SELECT *, regexp_extract_all(text, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS u FROM t),
f AS (SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR {h[2]} % 100 >= {SHARE} THEN 'plain' WHEN {h[3]} % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form,
             least({h[0]} % (len(u) + 1), {h[1]} % (len(u) + 1)) AS a, greatest({h[0]} % (len(u) + 1), {h[1]} % (len(u) + 1)) AS b FROM c),
p AS (SELECT *, {part(1, 'a')} AS prefix, {part('a + 1', 'b')} AS middle, {part('b + 1', 'len(u)')} AS suffix FROM f)
SELECT doc_id, len(u) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle) ELSE concat('<S>', suffix, '<P>', prefix, '<M>', middle) END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""
