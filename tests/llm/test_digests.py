"""Centroid clustering, fill-in-the-middle and byte-level BPE, each against a plainer version."""

import hashlib
import math
import random
import re
import struct

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from releaselake.llm import bpe, centroids, infill
from releaselake.llm.queries import ORACLE_SQL

SPACE = "\x20\x09-\x0d"
TOKEN = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Centroid clustering -------------------------------------------------------------------------------------------------
VECTORS = "vec_id long, embedding array<double>"


def points(n, seed=1, spread=0.3):
    rng = np.random.default_rng(seed)
    at = rng.normal(size=(12, 64))
    return [(int(i), (at[rng.integers(12)] + spread * rng.normal(size=64)).tolist()) for i in range(n)]


def plain_clusters(rows, clusters=8, rounds=10):
    """Every vector compared with every centroid, in Python's whole numbers."""
    kept = [(i, [math.floor(v * 1024) if abs(v) < 2**53 else int(v) * 1024 for v in x]) for i, x in rows if x is not None and len(x) == 64 and all(v is not None and math.isfinite(v) for v in x)]
    order = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)
    c = [x for _, x in order[:clusters]]
    square = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    nearest = lambda x: min((square(x, y), k) for k, y in enumerate(c))
    for _ in range(rounds):
        of = [nearest(x)[1] for _, x in kept]
        for k in range(len(c)):
            mine = [x for (_, x), o in zip(kept, of) if o == k]
            c[k] = [sum(col) // len(mine) for col in zip(*mine)] if mine else c[k]
    found = [nearest(x) for _, x in kept]
    total = {k: sum(d for d, o in found if o == k) for k in range(len(c))}
    fits = lambda n: n if n < 1 << 63 else None
    lost = {k: any(d >= 1 << 63 for d, o in found if o == k) for k in total}
    every = None if any(lost.values()) else fits(sum(total.values()))
    return sorted(((i, k, fits(d), None if lost[k] else fits(total[k]), every, hashlib.sha256(",".join(map(str, c[k])).encode()).hexdigest()) for (i, _), (d, k) in zip(kept, found)), key=repr)


@pytest.mark.parametrize("n, spread", [(400, 0.1), (300, 1.0), (5, 0.3)])
def test_clusters_equal_plain_scans_and_skip_some(spark, n, spread):
    rows = points(n, n, spread)
    got = centroids.cluster(spark.createDataFrame(rows, VECTORS).repartition(3))
    assert rows_of(got.drop("scans")) == plain_clusters(rows)
    if n == 400:
        assert got.agg(F.avg("scans")).first()[0] < 8  # of eleven


def test_clusters_of_odd_vectors(spark):
    good = points(40, 7)
    tie = good[:6] * 2 + [(100 + i, good[0][1]) for i in range(10)]
    odd = [(None, good[3][1]), (200, None), (201, [1.0]), (202, [float("nan")] * 64), (203, [float("inf")] + [0.0] * 63), (204, [None] + [0.0] * 63), (205, [0.0] * 64), (206, [-0.0] * 64), (207, [5e-324, -5e-324] * 32)]
    rows = good + tie + odd
    df = spark.createDataFrame(rows, VECTORS)
    clash = {c: F.lit("x") for c in ("x", "cluster", "near", "far", "was", "h", "embedding2", "distance")}
    assert rows_of(centroids.cluster(df.withColumns(clash)).drop("scans")) == plain_clusters(rows)
    assert centroids.cluster(df.where("false")).count() == 0
    large = good[:20] + [(300, [1e6] * 64), (301, [-3e8, 2e9] * 32), (302, [1e300] + [0.0] * 63), (303, [1.7e308] * 64), (304, [131071.9999] * 64)]
    assert rows_of(centroids.cluster(spark.createDataFrame(large, VECTORS)).drop("scans")) == plain_clusters(large)
    some = good[:20] + [(400, [3e9] * 64), (401, [-2e9] * 64)]  # distances beyond longs
    assert rows_of(centroids.cluster(spark.createDataFrame(some, VECTORS)).drop("scans")) == plain_clusters(some)


def test_loosening_holds_for_points_of_the_sphere():
    rng = np.random.default_rng(3)
    less = 0
    for _ in range(300):
        old, new = ([[int(v) for v in row] for row in rng.integers(-900, 900, size=(3, 6)) // rng.integers(1, 30)] for _ in range(2))
        new[1] = [a + int(b) for a, b in zip(old[1], rng.integers(-200, 200, size=6))]
        radius = float(rng.uniform(0, 800))
        fall = centroids.loosening(old, new, [radius] * 3)
        steps = rng.normal(size=(200, 6))
        inside = np.array(old[0]) + radius * steps / np.linalg.norm(steps, axis=1)[:, None] * rng.uniform(0, 1, size=(200, 1)) ** 0.1
        for j in (1, 2):
            fell = np.linalg.norm(inside - old[j], axis=1) - np.linalg.norm(inside - new[j], axis=1)
            assert fell.max() <= fall[0] + 1e-6
        less += fall[0] < 0.99 * max(math.dist(old[j], new[j]) for j in (1, 2))
    assert less > 50


def test_clusters_equal_sql(spark, tmp_path):
    rows = points(200, 5)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    db = duckdb.connect()
    df.toPandas().to_parquet(tmp_path / "e.parquet")
    db.execute(f"CREATE VIEW embeddings AS SELECT vec_id, embedding::FLOAT[] AS embedding FROM '{tmp_path}/e.parquet'")
    assert sorted(db.execute(ORACLE_SQL["op11_centroids"]).fetchall(), key=repr) == rows_of(centroids.cluster(df).drop("scans"))


# Fill in the middle --------------------------------------------------------------------------------------------------
def plain_infill(doc_id, text, seed=42):
    text = text or ""
    u = TOKEN.findall(text)
    assert "".join(u) == text
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    form = "plain" if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50 else "spm" if h4 % 100 < 80 else "psm"
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(u), form, None if form == "plain" else len(p), None if form == "plain" else len(m), sha(out), sha(text))


def odd_texts():
    rng = random.Random(2)
    alphabet = ["<", "P>", "S>", "M>", "<S", "<<", " ", "  ", "\t", "\n", "\x0b", "\x1c", "\x85", "\xa0", "a", "bc", "é", "中", "🎉", "x" * 30, " word"]
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(400)]


@pytest.mark.parametrize("frame", [5, 64, 1 << 16])
def test_frames_cut_and_come_back(monkeypatch, frame):
    monkeypatch.setattr(infill, "FRAME", frame)
    codec, rng = infill.Codec(), random.Random(frame)
    for text in odd_texts() + ["x" * 300, " " * 300, "é" * 200 + " " + "中" * 200]:
        data, u = text.encode(), TOKEN.findall(text)
        frames = codec.store(data)
        assert b"".join(codec.open(f.data) for f in frames) == data and sum(f.units for f in frames) == len(u) and sum(f.chars for f in frames) == len(text)
        cuts = sorted(rng.randint(0, len(u)) for _ in range(2))
        parts = codec.split(frames, cuts)
        read = [b"".join(codec.open(f.data) for f in p).decode() for p in parts]
        assert read == ["".join(u[a:b]) for a, b in zip([0, *cuts], [*cuts, len(u)])]
        assert [sum(f.units for f in p) for p in parts] == [b - a for a, b in zip([0, *cuts], [*cuts, len(u)])] and [sum(f.chars for f in p) for p in parts] == [len(t) for t in read]
        if not any(m in text for m in ("<P>", "<S>", "<M>")):
            for form, order in infill.ORDER.items():
                part = dict(zip((infill.PREFIX, infill.MIDDLE, infill.SUFFIX), parts))
                output = [d for m in order for d in (codec.pack(m), *(f.data for f in part[m]))]
                assert b"".join(codec.open(d) for d in codec.restored(output, form)) == data


def test_infill_equals_plain_and_sql(spark, edge, tmp_path):
    texts = [(i, t) for i, t in enumerate(odd_texts())] + [(900, None), (901, ""), (902, "ab " * 100_000), (903, "z" * 200_000), (None, "no id here"), (905, "é " * 70_000 + " \n")]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("frames", F.lit("x")).withColumn("n", F.lit(1)).withColumn("form", F.lit("y"))
    got = infill.digest(df)
    want = sorted((plain_infill(*r) for r in texts), key=repr)
    assert rows_of(got) == want and {r[2] for r in want} == {"plain", "psm", "spm"}
    assert rows_of(infill.digest(edge)) == sorted((plain_infill(r.doc_id, r.text) for r in edge.collect()), key=repr)
    made = infill.transformed(infill.frames(df))
    assert rows_of(infill.texts(made)) == sorted(((i, t or "") for i, t in texts), key=repr)
    db = duckdb.connect()
    df.select("doc_id", "text").toPandas().to_parquet(tmp_path / "d.parquet")
    db.execute(f"CREATE VIEW documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, text FROM '{tmp_path}/d.parquet'")
    assert sorted(db.execute(ORACLE_SQL["op12_infill"]).fetchall(), key=repr) == want


def test_infill_without_documents(none):
    assert infill.digest(none).count() == 0


# Byte-level BPE ------------------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    ranks = bpe.read_ranks()
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def strings(n, seed, k=50):
    rng = random.Random(seed)
    alphabet = [chr(c) for c in (*range(128), *range(0xA0, 0x250), 0x85, 0x1680, 0x2028, 0x3000, 0x4E2D, 0x6587, 0x1F389, 0x301, 0x660, 0xB2, 0x200B, 0xFEFF)] + [" "] * 60 + list("etaoin") * 20 + ["'s", "'ll", "\n"] * 8
    return ["".join(rng.choices(alphabet, k=rng.randint(0, k))) for _ in range(n)]


def ids_of(encoder, texts):
    out = [b""] * len(texts)
    for at, ids in encoder(iter(texts)):
        out[at] += ids
    return [list(struct.unpack(f"<{len(x) // 4}I", x)) for x in out]


@pytest.mark.parametrize("walk, long", [(bpe.WALK, bpe.LONG), (7, 5), (40, 2)])
def test_ids_equal_the_library(monkeypatch, library, walk, long):
    monkeypatch.setattr(bpe, "WALK", walk)
    monkeypatch.setattr(bpe, "LONG", long)
    monkeypatch.setattr(bpe, "LOT", 2_000)
    monkeypatch.setattr(bpe, "CACHED", 500)
    texts = strings(3_000, walk)
    assert ids_of(bpe.Encoder(), texts) == [library[1].encode_ordinary(t) for t in texts]


def test_very_long_pre_tokens(library):
    rng = random.Random(4)
    texts = ["a" * 50_000, "ab" * 30_000 + "b", "中文" * 20_000, "".join(rng.choices("abcdefghijklmnop", k=60_000)), "=-" * 30_000, "é" * 30_000]
    assert ids_of(bpe.Encoder(), texts) == [library[1].encode_ordinary(t) for t in texts]


def test_many_equal_one_by_one(library):
    merger, rng = bpe.Merger(library[0]), random.Random(5)
    assert merger.lower.any()
    pieces = list({"".join(rng.choices("abcdefghinoprst", k=rng.randint(2, 60))).encode() for _ in range(3_000)} - set(library[0])) + [b"a" * k for k in range(40, 90)] + [b"ab" * k + b"b" for k in range(20, 60)]
    flat, counts = merger.many(pieces)
    alone = [merger.one(p) for p in pieces]
    assert flat.tolist() == [i for ids in alone for i in ids] and counts.tolist() == [len(ids) for ids in alone]


def test_rank_bits_find_the_first_of_a_set():
    bits, held, rng = bpe.RankBits(50_000), set(), random.Random(6)
    for _ in range(5_000):
        r = rng.choice([rng.randrange(50_000), rng.randrange(70), 49_999])
        if r in held:
            held.remove(r)
            bits.drop(r)
        else:
            held.add(r)
            bits.add(r)
        assert bits.first() == min(held, default=-1)
    with pytest.raises(ValueError):
        bpe.RankBits(1 << 19)


def test_bpe_digest_and_round_trip(spark, edge, library):
    docs = edge.union(edge.where("doc_id = 7"))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for r in docs.collect():
        ids = library[1].encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha((r.text or "").encode())))
    assert rows_of(bpe.digest(docs)) == sorted(want, key=repr)
    back = bpe.decode(bpe.encode(docs))
    assert sorted(((r.doc_id, bytes(r.content).decode()) for r in back.collect()), key=repr) == sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=repr)
    assert bpe.digest(docs.where("false")).count() == bpe.encode(docs.where("false")).count() == 0
