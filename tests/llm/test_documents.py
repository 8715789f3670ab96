import base64
import hashlib
import json
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from releaselake.llm import common, fingerprints, near_dedup, packing, pii, secrets, segment, toxicity

from .conftest import TEXTS


def test_next_documents_and_edits(spark, edge, none):
    assert fingerprints.neighbours(none).count() == 0
    got = fingerprints.neighbours(edge).collect()
    assert len(got) == len(TEXTS)
    rng = random.Random(3)
    docs = [(i * 7 - 300, " ".join(rng.choice("abc de fgh ij".split()) for _ in range(rng.randint(0, 40)))) for i in range(3500)]
    rows = {r.doc_id: r for r in fingerprints.neighbours(spark.createDataFrame(docs, "doc_id long, text string").repartition(7)).collect()}
    order = sorted(docs, reverse=True)
    for k, (i, text) in enumerate(order):
        other = order[(k + 1) % len(order)][1]
        r = rows[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(fingerprints.edited(text, other).encode()).hexdigest()
        own = fingerprints.digest(text.encode())
        assert r.fingerprint == own.hex() and r.near_next == fingerprints.likeness(own, fingerprints.digest(other.encode()))
    one = fingerprints.neighbours(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_few_tasks_place_the_pieces(spark):
    docs = spark.range(400).selectExpr("if(id < 300, null, id) as doc_id", "repeat('word ', int(id % 60)) as text")
    held = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    had = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = packing.pack(docs)
        tasks, rows = got.rdd.getNumPartitions(), got.collect()
        plan = got._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for k, v in had.items():
            spark.conf.set(k, v)
    assert tasks <= 2 * spark.sparkContext.defaultParallelism < 97 and "Join" not in plan and "Window" not in plan
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(rows) == 400 and sorted(by) == list(range(-(-sum(r.length for r in rows) // 2048)))
    for x in by.values():
        assert [a for a, _ in sorted(x)] == [0, *np.cumsum([n for _, n in sorted(x)])[:-1]] and sum(n for _, n in x) <= 2048


def test_few_tasks_stream_and_write_the_ranges(spark):
    docs = spark.range(9_000).selectExpr("id as doc_id", "concat('text ', id % 97) as text")
    got = fingerprints.neighbours(docs)
    assert got.rdd.getNumPartitions() == 3 < 9_000 // fingerprints.RANGE_ROWS
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1  # texts go through Python once
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == 9_000
    for i in (0, 1, 999, 1000, 4500, 8999):
        text, other = f"text {i % 97}", f"text {(i - 1) % 9_000 % 97}"
        assert rows[i].edited_sha256 == hashlib.sha256(fingerprints.edited(text, other).encode()).hexdigest()


def test_digest_difference_is_bounded():
    a, b = fingerprints.digest(b"some text that is long enough " * 9), fingerprints.digest(b"1234567890 xyz" * 50)
    assert 0 <= fingerprints.likeness(a, b) < 1 == fingerprints.likeness(a, a) and fingerprints.difference(a, b) == fingerprints.difference(b, a)


def slow_base(text):
    """The patterns as they are stated, on strings."""
    out = []
    for kind, p, ok in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(d := re.sub("[ -]", "", s)) <= 19 and pii.luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= sum(c.isdigit() for c in s) <= 15),
    ):
        out += [(kind, m.start(), m.end()) for m in re.finditer(p, text, re.A) if ok(m[0])]
    return out


def test_base_spans_equal_the_stated_patterns():
    rng = random.Random(5)
    parts = ["a@b.co", "@", "x.y@", "@c.d", "1.2.3.4", "999.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (988) 555-2485", "+1", "é", " ", "  ", "-", "12", ".", "ab", "@b-c.d.e"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 9)))
        data = text.encode()
        base, added = pii.find(data, np.zeros((4, len(pii.FEATURES))) - 5)
        assert base == slow_base(text), text


def test_added_spans_touch_no_base_span():
    w, rng = pii.fit([], epochs=8, made=80), random.Random(9)
    parts = ["a@b.co", "joe (at) host (dot) com", "(415) 555-2671", "+1 (988) 555-2485", "4111 1111 1111 1111", "1.2.3.4", " ", ", ", "\n", "é ", "word "]
    for _ in range(150):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))
        base, added = pii.find(text.encode(), w)
        data = text.encode()
        every = []
        for s, e in pii.windows(data):
            first = len(data[:s].decode())
            every += [(k, first + a, first + b) for k, a, b in pii.viterbi(w, data[s:e].decode())]
        free = [x for x in every if not any(p < x[2] and x[1] < q for _, p, q in base)]
        assert added == sorted(free, key=lambda x: (pii.RANK[x[0]], x[1])), text


def test_windows_decode_like_the_whole_text():
    w, rng = pii.fit([], epochs=8, made=80), random.Random(2)
    parts = ["a@b.co", "joe (at) host (dot) com", "(415) 555-2671", "+1 (988) 555-2485", "4111 1111 1111 1111", "1.2.3.4", " ", ", ", "\n", "é ", "word ", "w" * 30, "中", "at", "[at]", "- - - - ", "x.y.z."]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 40)))
        data, got = text.encode(), []
        for s, e in pii.windows(data):
            first = len(data[:s].decode())
            got += [(k, first + a, first + b) for k, a, b in pii.viterbi(w, data[s:e].decode())]
        assert got == pii.viterbi(w, text), text
    long = "long" * 14 + " (at) host (dot) com"
    assert pii.find(long.encode(), pii.fit([]))[1] == [("email", 0, len(long))]


def test_semi_markov_adds_spans_and_leaves_numbers(spark, edge, none):
    w = pii.fit([])
    found = pii.find("mail joe (at) host (dot) com or call (415) 555-2671; 2021-03-04, 1.2.3, 300.1.2.3".encode(), w)
    assert found[0] == [] and [k for k, _, _ in found[1]] == ["email", "phone"]
    brute = max(_segmentations("call (415) 555-2671", w), key=lambda x: x[0])[1]
    assert brute == pii.viterbi(w, "call (415) 555-2671")
    assert pii.digest(none).count() == 0 and pii.digest(edge).count() == len(TEXTS)
    masked = {r.doc_id: r for r in pii.mask(spark.createDataFrame([(1, "to a.b@c.de now", 15, "k"), (2, None, None, "k"), (3, "", 0, "k")], "doc_id long, text string, n_chars long, kind string")).collect()}
    assert masked[1].text == "to [EMAIL] now" and masked[1].n_chars == 14 and masked[2].text is None and masked[3].text == "" and masked[1].kind == "k"


def _segmentations(text, w):
    """All choices of non-overlapping candidates with their scores."""
    starts, segments, feats = pii.lattice(text)
    scores = pii._scores(w, feats) if segments else []

    def go(i, at, total, chosen):
        if i == len(order):
            yield total, chosen
            return
        yield from go(i + 1, at, total, chosen)
        a, b = segments[order[i]]
        if a >= at:
            k = int(scores[order[i]].argmax())
            yield from go(i + 1, b, total + float(scores[order[i]].max()), [*chosen, (pii.KINDS[k], starts[a], starts[b])])

    order = sorted(range(len(segments)), key=lambda i: segments[i])[:14]
    return list(go(0, 0, 0.0, []))


def test_secrets_confirm_structure(edge, none):
    enc = lambda o: base64.urlsafe_b64encode(json.dumps(o).encode()).rstrip(b"=").decode()
    jwt = f"{enc({'alg': 'HS256'})}.{enc({'sub': 1})}.{'A' * 43}"
    fake = f"{enc({'typ': 'x'})}.{enc({'sub': 1})}.{'A' * 43}"
    body = b"\x02\x01\x00" + b"\x30\x0d\x06\x09\x2a\x86\x48\x86\xf7\x0d\x01\x01\x01\x05\x00" + b"\x04\x20" + bytes(range(32))
    der = b"\x30" + bytes([len(body)]) + body
    text = f"é {jwt} {fake} {base64.b64encode(der).decode()} {base64.b64encode(der[:-1]).decode()} {der.hex()} Password: 'abcdef' token=abc AKIA{'A' * 16}"
    spans, n_base = secrets.find(text.encode())
    kinds = [k for k, _, _ in spans]
    assert kinds.count("jwt") == 1 and kinds.count("der") == 2 and kinds.count("assign") == 1 and kinds.count("access") == 1 and kinds.count("hex") == 1 and n_base == 3
    assert [text[s:e] for k, s, e in spans if k == "jwt"] == [jwt]
    assert secrets.digest(none).count() == 0 and secrets.digest(edge).count() == len(TEXTS) and secrets.scan(edge).count() == len(TEXTS)


def slow_secrets(text):
    """The base patterns as they are stated, on strings, with the order of the digest."""
    out = []
    for rank, (kind, p, ok) in enumerate((
        ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    )):
        for m in re.finditer(f"(?i:{p[: p.index(')') + 1]}){p[p.index(')') + 1 :]}" if kind == "assign" else p, text, re.A):
            if ok(m):
                out.append((m.start(), rank, kind, m.end()))
    return [(k, s, e) for s, _, k, e in sorted(out)]


def test_secrets_base_spans_equal_the_stated_patterns():
    rng = random.Random(15)
    parts = ["password", "PassWd", "token", "api_key", "ApiKey", "secret", '"', "'", " ", "=", ":", "abc123", "x", "AKIA", "ABCDEFGH12345678", "deadbeef00", "0123456789abcdef", "é", "\n", "-", "中"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))
        assert [x for x in secrets.find(text.encode())[0] if x[0] in secrets.BASE_KINDS] == slow_secrets(text), text


@pytest.mark.parametrize("unit", ["eyJ", "eyJab.eyJ", "-----BEGIN PRIVATE KEY-----MAAA", "token    ", "MAAAAA ", "é token=abcdefabcdefabcdefabcdef01 "])
def test_secret_scans_take_linear_time(unit):
    start = time.process_time()
    secrets.find(unit.encode() * (400_000 // len(unit)))
    assert time.process_time() - start < 5


def test_packing_plan_is_valid_and_reduction_is_optimal():
    rng = random.Random(1)
    for _ in range(150):
        cap = rng.choice([10, 20, 30])
        counts = {w: rng.randint(0, 3) for w in rng.sample(range(1, cap + 1), min(cap, rng.randint(1, 6)))}
        p = packing.plan(counts, cap)
        bins: dict[int, list] = {}
        for w, lo, hi, s, per, off in p.runs:
            for k in range(hi - lo):
                bins.setdefault(s + k // per, []).append((off + k % per * w, w))
        assert sorted(bins) == list(range(p.sequences))
        for v in bins.values():
            at = 0
            for o, w in sorted(v):
                assert o == at
                at += w
            assert at <= cap
        assert sum(len(v) for v in bins.values()) == sum(counts.values())
        items = [w for w, n in counts.items() for _ in range(n)]
        if len(items) <= 9:
            left = packing.Plan(counts, cap)
            left.reduce()
            rest = [w for w, n in left.left.items() for _ in range(n)]
            assert left.sequences + _fewest(rest, cap) == _fewest(items, cap)


def _fewest(items, cap):
    best = [len(items)]
    items = sorted(items, reverse=True)

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for r in {r for r in rooms if r >= items[i]}:
            rest = list(rooms)
            rest.remove(r)
            go(i + 1, [*rest, r - items[i]])
        go(i + 1, [*rooms, cap - items[i]])

    go(0, [])
    return best[0]


def test_pieces_equal_the_tokenizer(spark, edge, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    assert packing.pack(none).count() == 0
    got = packing.pack(edge).collect()
    want = []
    for doc_id, text in TEXTS:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(doc_id, k, k * 2048, len(p), zlib.crc32(p.tobytes())) for k in range(-(-len(ids) // 2048)) for p in [ids[k * 2048 : (k + 1) * 2048]]]
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    for s in {r.sequence_id for r in got}:
        at = 0
        for r in sorted((r for r in got if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    encode = packing.id_bytes()
    for x in ["It's İ Ǆ don't 'REally ''s ('s 123abc ½ ²", "a\x85b\xa0c\x1cd ΣΑΣ Ünï <|endoftext|>", "'''s 's'S I'LL œuvre é̀", "ﬁ ﷺ ᾳ"]:
        assert encode(x) == np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes()


def test_segmentation_is_lossless_reproducible_and_follows_the_weights(spark, edge, none):
    assert segment.digest(none).count() == 0
    first = sorted(segment.digest(edge).collect(), key=str)
    assert all(r.lossless for r in first) and first == sorted(segment.digest(edge.repartition(5)).collect(), key=str)
    back = segment.decode(segment.encode(edge))
    assert sorted(str(r.text) for r in back.collect()) == sorted(t or "" for _, t in TEXTS)
    v = segment.Vocabulary()
    s = segment.Sampler(v)
    n, seen = 20_000, {}
    for ids in s.encode(list(range(n)), ["then"] * n):
        seen[tuple(ids.tolist())] = seen.get(tuple(ids.tolist()), 0) + 1

    def ways(text):
        if not text:
            yield (), 1.0
        for k in range(1, len(text) + 1):
            hit = v.weights.get(text[:k])
            if hit:
                for rest, w in ways(text[k:]):
                    yield (hit[0], *rest), w * (1 + hit[1]) ** -segment.THETA

    exact = dict(ways("then"))
    total = sum(exact.values())
    assert set(seen) <= set(exact)
    assert max(abs(seen.get(k, 0) / n - w / total) for k, w in exact.items()) < 0.015


def test_a_lattice_has_all_pieces_and_looks_few_others_up(monkeypatch):
    v = segment.Vocabulary()
    s, rng, asked = segment.Sampler(v), random.Random(8), []
    find = s._find
    monkeypatch.setattr(s, "_find", lambda size, wanted, low: asked.append(len(wanted)) or find(size, wanted, low))
    pieces = [p for p in v.weights if "\n" not in p]
    words = [" " * rng.randint(0, 2) + "".join(rng.choice(pieces).strip() or "x" for _ in range(rng.randint(1, 5))) for _ in range(2000)] + ["中é🎉q", "z" * 300, "\n"]
    share, piece, prev, first_of, last = s.lattice(words)
    node, edges = 0, 0
    for w, stop in zip(words, last.tolist()):
        assert stop == node + len(w)
        for end in range(1, len(w) + 1):
            exact = [(v.weights[w[k:end]][0], node + k) for k in range(end - 1, max(-1, end - 1 - v.longest), -1) if w[k:end] in v.weights]
            if w[end - 1] not in v.weights:
                exact.insert(0, (len(v.bytes_) + ord(w[end - 1]), node + end - 1))
            at = int(first_of[node + end]) if exact else 0
            assert [(int(piece[e]), int(prev[e])) for e in range(at, at + len(exact))] == exact
            assert not exact or share[at + len(exact) - 1] == 1.0 and (np.diff(share[at : at + len(exact)]) > 0).all()
            edges += len(exact)
        node += len(w) + 1
    assert edges == len(piece) and sum(asked) < 1.05 * edges
    assert any(len(more) for _, more in s.slots.values())  # some pieces share a slot
    keys = np.array([5, 1 << 40, 0, 70_000, 5, 1 << 17, 3], np.int64)
    assert segment._order(keys).tolist() == np.argsort(keys, kind="stable").tolist() and segment._order(keys[:0]).tolist() == []


def test_walks_are_bounded_and_change_no_draw(monkeypatch):
    rng = random.Random(6)
    texts = ["", "one two", " ".join(rng.choice(["alpha", "beta", "é中", "\n", "  "]) for _ in range(900)), "x" * 700, "tail \n end"]
    keys = [3, None, 5, -6, 7]
    s = segment.Sampler(segment.Vocabulary())
    whole = [ids.tolist() for ids in s.encode(keys, texts)]
    monkeypatch.setattr(segment, "WALK", 50)
    assert [ids.tolist() for ids in s.encode(keys, texts)] == whole
    monkeypatch.setattr(segment, "LONGEST", 60)
    cut = [ids.tolist() for ids in s.encode(keys, texts)]
    assert cut[:3] + cut[4:] == whole[:3] + whole[4:] and s.vocabulary.decode(cut[3]) == texts[3]
    assert all("".join(segment._parts(t)) == t and max(map(len, segment._parts(t))) <= 110 for t in texts)


WORD = re.compile("[^ \t-\r]+")


def slow_sets(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(low))
        out[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    return out


def slow_components(sets):
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            n = len(sets[i] & sets[j])
            if n and 100 * n >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def test_near_duplicates_equal_brute_force(spark, edge, none):
    assert near_dedup.classes(none).count() == 0
    got = {r.doc_id: r for r in near_dedup.classes(edge).collect()}
    assert got[2].component_id == 1 and not got[2].kept and got[3].n_shingles == got[4].n_shingles == got[5].n_shingles == 0 and got[3].kept and got[10].kept and got[7].n_shingles == 1
    rng = random.Random(4)
    base = [[rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(rng.randint(0, 60)) for _ in range(rng.choice([3, 6, 9, 40, 120]))] for _ in range(12)]
    rows = []
    for i in range(500):
        w = list(base[rng.randrange(12)] if i % 3 else base[3])
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = f"w{rng.randint(0, 10_000)}"
        rows.append((i * 3, " ".join(w)))
    sets = slow_sets(rows)
    got = {r.doc_id: r for r in near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    want = slow_components(sets)
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r.component_id for i, r in got.items()} == want
    left = near_dedup.keep_one(edge)
    assert left.columns == edge.columns and {r.doc_id for r in left.collect()} == {None, 1, 3, 4, 5, 6, 7, 8, 10} and left.count() == 9


def test_blocks_find_links_that_leaders_miss(spark, monkeypatch):
    """A chain of near copies, whose ends share buckets but no link with the leader."""
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    words = [f"w{i}" for i in range(60)]
    rows = [(100 - k, " ".join(words[:60 - 0] if k == 0 else [f"x{j}" if j < 2 * k else w for j, w in enumerate(words)])) for k in range(12)]
    got = {r.doc_id: r.component_id for r in near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == slow_components(slow_sets(rows))


def test_large_components_of_a_bucket_meet(spark, monkeypatch):
    """Exact leaders with many copies each, near copies between them, and outsiders in the same buckets."""
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    rng = random.Random(8)
    words, rows = [f"w{i}" for i in range(120)], []
    for shift in range(4):
        base = [f"x{shift}-{j}" if 9 * shift <= j < 9 * shift + 14 else w for j, w in enumerate(words)]
        for _ in range(14):
            w = list(base)
            w[rng.randrange(60, 120)] = f"y{rng.randint(0, 40)}"
            rows.append((len(rows) * 5 % 281, " ".join(w)))
    got = {r.doc_id: r.component_id for r in near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == slow_components(slow_sets(rows))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101)], "a long, b long")
    got = {r.v: r.c for r in near_dedup.components(edges).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[101] == got[100] == 100


def test_toxicity_learns_from_positives_and_unlabelled(spark, edge, none):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(1500):
        bad = i % 8 == 0
        t = [rng.choice(words) for _ in range(40)]
        if bad:
            for _ in range(3):
                t[rng.randrange(40)] = rng.choice(["scumbag", "Idiot!", "moron"])
        rows.append((i, " ".join(t)))
        if i % 2 == 0:
            labels.append((i, 1 if bad else 0))
    docs, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, lab).collect()}
    held = [i for i in got if got[i].held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in got)
    assert np.mean([got[i].predicted == (i % 8 == 0) for i in held]) > 0.98
    assert toxicity.score(edge, lab.where("false")).agg({"score": "max"}).first()[0] == 0.0
    assert toxicity.score(none, lab).count() == 0 and toxicity.score(edge, lab).count() == len(TEXTS)
    vocabulary, weights, bias = toxicity.train(docs, lab)
    texts, toxic = dict(rows), {i for i, t in labels if t and zlib.crc32(str(i).encode()) % 3 != 1}
    strings = {i: {s for w in re.findall(r"\w+", t.lower()) for s in [w, *(w[:n] + "*" for n in (3, 4, 5, 6) if len(w) >= n)]} for i, t in texts.items()}
    open_ = [i for i in texts if zlib.crc32(str(i).encode()) % 3 != 1]
    n_p, n_u, want = len(toxic), len(open_), set()
    for s in set().union(*strings.values()):
        p, u = sum(s in strings[i] for i in toxic), sum(s in strings[i] for i in open_)
        share, usual = p / n_p, (u + 1) / (n_u + 2)
        if p >= 3 and share > 2 * usual and (share - usual) / np.sqrt(usual * (1 - usual) / n_p) >= toxicity.LEAST_Z:
            want.add(s)
    assert set(vocabulary) == want
    for i in (0, 1, 8, 9):
        x = sum(weights[vocabulary[s]] for s in strings[i] & want) + bias
        assert abs(got[i].score - 1 / (1 + np.exp(-x))) < 1e-9
    kept = toxicity.clean(docs, lab)
    assert {r.doc_id for r in kept.collect()} == {i for i in got if not got[i].predicted}


def test_training_lowers_the_stated_risk():
    rng = np.random.default_rng(4)
    rows = [sorted(set(rng.integers(0, 12 if k < 40 else 30, 4).tolist())) for k in range(300)]
    positive, prior = np.arange(300) < 40, 0.2

    def risk(weights, bias):
        s = np.array([1 / (1 + np.exp(-(weights[r].sum() + bias))) for r in rows])
        return prior * (1 - s[positive]).mean() + max(0.0, s[~positive].mean() - prior * s[positive].mean())

    weights, bias = toxicity.fit(rows, positive, prior, 30)
    assert risk(weights, bias) < 0.8 * risk(np.zeros(31), -1.0) and risk(weights, bias) <= min(risk(weights + rng.normal(0, 1, 31), bias + rng.normal()) for _ in range(20)) + 0.02


def test_risk_never_goes_below_zero_part():
    rows = [[0]] * 30 + [[1]] * 30 + [[0]] * 10 + [[1]] * 90
    weights, bias = toxicity.fit(rows, np.array([True] * 30 + [False] * 130), 0.1, 2)
    assert weights[0] > 0 > weights[1] + bias


@pytest.mark.parametrize("text", ["", "<>", "a\\b", "[[<<||\\\\"])
def test_nothing_breaks_on_odd_texts(text):
    assert secrets.find(text.encode()) == ([], 0) and len(near_dedup.shingles(text.encode())) <= 1


def test_rows_of_one_id_are_linked_by_their_own_texts(spark):
    say = lambda c: " ".join(f"{c}{i}" for i in range(40))
    rows = [(None, say("a")), (None, say("b")), (9, say("b")), (5, say("c")), (5, say("d")), (7, say("d")), (5, say("e")), (8, say("c"))]
    got = near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=str) == sorted([(None, None, True), (None, 9, False), (9, 9, True), (5, 5, True), (5, 5, True), (7, 5, False), (5, 5, True), (8, 5, False)], key=str)


def test_hot_keys_are_salted(spark, monkeypatch):
    """A join whose hot keys are dealt over lots gives the rows of a plain one, and so do the classes."""
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    big = spark.createDataFrame([(i % 7 if i % 3 else 1, i) for i in range(300)] + [(None, 1)], "k long, x long")
    small = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (2, "d"), (None, "e")], "k long, y string")
    for how in ("inner", "left"):
        assert sorted(common.join_hot(big, small, ["k"], how).collect(), key=str) == sorted(big.join(small, ["k"], how).collect(), key=str)
    rng = random.Random(12)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(i % 5):
            w[rng.randrange(60)] = f"y{rng.randint(0, 90)}"
        rows.append((i * 7 % 157, " ".join(w)))
    got = {r.doc_id: r.component_id for r in near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == slow_components(slow_sets(rows))


def test_keep_one_drops_only_copies(spark):
    say = lambda c: " ".join(f"{c}{i}" for i in range(40))
    rows = [(None, say("a")), (None, say("b")), (None, say("b")), (None, say("c")), (1, say("c")), (2, say("d")), (2, say("e")), (2, say("e")), (3, say("f")), (4, say("f"))]
    got = near_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en")).repartition(3))
    assert got.columns == ["doc_id", "text", "lang"]
    assert sorted((r.doc_id or 0, r.text[0]) for r in got.collect()) == [(0, "a"), (0, "b"), (1, "c"), (2, "d"), (2, "e"), (3, "f")]


@pytest.mark.parametrize("shared", [False, True])
def test_stages_keep_columns_of_any_name(spark, shared):
    """Helper columns take names that the documents do not have, whether or not rows share ids."""
    import corpus_pipeline

    rows = [(1, "one two three four five six"), (2, "one two three four five six"), (3, "write to someone@example.org about it"), (4, None), *([(None, "no id"), (3, "another text")] if shared else [])]
    names = ["_row", "_made", "_id", "_first", "_kept", "row_name", "shared_id", "first_text", "kept_row", "Row_Name_", "h", "last", "n", "component_id", "key", "spans", "score", "n_chars"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("text"), F.lit("-"))) for c in names[:-1]}).withColumn("n_chars", F.length("text").cast("long"))
    was = {r.text: r.asDict() for r in docs.collect()}
    got = near_dedup.keep_one(docs)
    assert got.columns == docs.columns and {r.text for r in got.collect()} == set(was)
    assert all({k: v for k, v in r.asDict().items() if k != "doc_id"} == {k: v for k, v in was[r.text].items() if k != "doc_id"} for r in got.collect())
    labels = spark.createDataFrame([(1, 0, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    for _, stage in (("toxicity", lambda d: toxicity.clean(d, labels)), corpus_pipeline.STAGES[2]):
        out = stage(docs) if _ == "toxicity" else stage(spark, docs, "")
        assert out.columns == docs.columns and {tuple(r[c] for c in names[:-1]) for r in out.collect()} == {tuple(r[c] for c in names[:-1]) for r in docs.collect()}
