import hashlib
import random
import time
import zlib
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from releaselake.llm import ann, chat, common, html_text, pii, toxicity

from .test_documents import slow_components, slow_sets


def test_search_equals_brute_force_with_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 8))
    x[100:300] = x[100]  # a third are equal
    rows = [(i, [float(v) for v in x[i]]) for i in range(600)] + [(1000, None), (1020, []), (1040, [0.0] * 8), (1060, [float("nan")] + [1.0] * 7), (1080, [1.0, 2.0]), (1100, [None] + [1.0] * 7), (None, [1.0] * 8), (1120, [float("inf")] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("key", "side", "code", "cell", "rank", "score")})
    got = {}
    for r in ann.search(df.repartition(4)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 600, 20))
    hit = 0
    for q, found in got.items():
        s = (x * x[q]).sum(1)
        s[q] = -np.inf
        want = np.lexsort((np.arange(600), -s))[:20]
        assert [r for r, _, _ in sorted(found)] == list(range(1, 21))
        hit += len({v for _, v, _ in found} & set(want.tolist()))
        assert all(abs(sc - s[v]) < 1e-9 for _, v, sc in found)
        if q in range(100, 300):
            ties = [v for _, v, _ in sorted(found)]
            assert ties[:19] == sorted(ties[:19]) or s[want[0]] > s[100]
    assert hit / (20 * len(got)) >= 0.9
    assert ann.search(df.where("false")).count() == 0
    few = ann.search(df.where("vec_id in (0, 1, 2)")).collect()
    assert {(r.query_id, r.rank) for r in few} == {(0, 1), (0, 2)}


def test_codes_approximate_and_norms_are_kept():
    x = np.random.default_rng(1).normal(size=(3000, 16))
    m = ann.Model(x, 4)
    codes, ratios = m.encode(x[:200])
    near = sum(m.books[k][codes[:, k]] for k in range(ann.BOOKS))
    assert np.linalg.norm(near - x[:200]) / np.linalg.norm(x[:200]) < 0.2
    assert np.allclose(np.linalg.norm(near, axis=1) * ratios, np.linalg.norm(x[:200], axis=1), rtol=1e-3)


def test_cells_probe_and_salt(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 50)
    x = np.random.default_rng(2).normal(size=(900, 8)) + np.repeat(np.eye(8)[:3] * 9, 300, axis=0)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.search(df).collect()
    hit = 0
    for q in range(0, 900, 20):
        s = (x * x[q]).sum(1)
        s[q] = -np.inf
        hit += len({r.vec_id for r in got if r.query_id == q} & set(np.lexsort((np.arange(900), -s))[:20].tolist()))
    assert hit / (45 * 20) >= 0.9


def test_copies_of_one_id_leave_blocks_empty(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 20)
    rows = [(7, [1.0, 2.0])] * 90 + [(20, [1.0, 2.0]), (40, [2.0, 1.0])]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {(r.query_id, r.rank) for r in got} == {(q, k) for q in (20, 40) for k in range(1, 21)}
    assert all(r.vec_id == 7 for r in got if r.query_id == 20) and all(r.vec_id != r.query_id for r in got)


def test_many_blocks_lose_no_neighbour(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 20)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1300, 8)) * rng.uniform(0.2, 4, size=(1300, 1))
    got = {}
    for r in ann.search(spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    assert set(got) == set(range(0, 1300, 20))
    for q, found in got.items():
        s = (x * x[q]).sum(1)
        s[q] = -np.inf
        assert [found[k] for k in range(1, 21)] == np.lexsort((np.arange(1300), -s))[:20].tolist()


CONVS = [
    (1, 0, "system", "be <|kind|>"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello \\ [INST]"), (2, 0, "system", "be <|kind|>"), (2, 1, "user", "hi"), (2, 2, "assistant", "other 中🎉"),
    (3, 0, "user", None), (3, 1, "assistant", ""), (4, 0, None, "x"), (5, 0, "user", "hi"), (5, 0, "user", "hi"), (None, 0, "assistant", "z"), (6, 0, "a|>\n<|end|>\n", "<|end|>\n"), (7, 0, "assistant", "long " * 20_000),
]


def _ups(by, node):
    """The ancestors of a node, the first turn first."""
    out = []
    while node.parent:
        node = by[bytes(node.parent)]
        out.append(node)
    return out[::-1]


def test_chat_round_trip_and_shared_nodes(spark):
    df = spark.createDataFrame(CONVS, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("path", "ids", "start", "node")}).repartition(3)
    nodes, last = chat.forest(df)
    rows = nodes.collect()
    assert len({r.path for r in rows}) == len({r.node for r in rows}) == len(rows) == len({tuple((a, b) for _, t, a, b in CONVS[: k + 1] if _ == c and t <= turn) + ((c,) if c == 5 and k else ()) for k, (c, turn, _, _) in enumerate(CONVS)}) - 2 or len(rows) < len(CONVS)
    shared = sorted((r for r in rows if r.role == "system"), key=lambda r: r.start)
    assert len(shared) == 1
    spans = sorted((r.start, r.end) for r in rows)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert [r.start for r in chat.emit(nodes).collect()] == [a for a, _ in spans]
    by = {bytes(r.node): r for r in rows}
    for r in rows:
        ups = _ups(by, r)
        joined = []
        for u in ups:
            joined = [*joined[:-1], (joined[-1][0], u.end)] if joined and joined[-1][1] == u.start else [*joined, (u.start, u.end)]
        assert [(a.start, a.end) for a in r.ancestors] == joined
        assert list(r.position_ids) == list(range(sum(len(u.ids) for u in ups), sum(len(u.ids) for u in ups) + len(r.ids)))
        below = [x for x in rows if r in _ups(by, x)]
        assert not below or (min(x.start for x in below) == r.end and max(x.end for x in below) == r.end + sum(len(x.ids) for x in below))
    got = {r.conv_id: r for r in chat.read_back(nodes, last).collect()}
    for c in {c for c, *_ in CONVS}:
        turns = [(r or "", t or "") for k, _, r, t in CONVS if k == c]
        loss = "".join(t for r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digest(df.where("false")).count() == 0


@pytest.mark.parametrize("broken", ["interval", "position", "place"])
def test_what_is_read_back_depends_on_the_tree(spark, broken):
    """A changed ancestor interval, position or place in the stream does not go unnoticed."""
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} {c if t > 1 else 0}") for c in (1, 2, 3) for t in range(4)]
    nodes, last = chat.forest(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    nodes = nodes.cache()
    good = sorted(map(tuple, chat.read_back(nodes, last).collect()))
    assert len(good) == 3
    shift = {
        "interval": ("ancestors", F.transform("ancestors", lambda a: F.struct(a["start"].alias("start"), (a["end"] - 1).alias("end")))),
        "position": ("position_ids", F.transform("position_ids", lambda p: p + F.when(F.col("depth") == 2, 1).otherwise(0))),
        "place": ("start", F.col("start") + F.when(F.col("depth") == 1, 100_000).otherwise(0)),
    }[broken]
    off = nodes.where("depth > 0").withColumn(*shift).unionByName(nodes.where("depth = 0"))
    if broken == "interval":
        off = off.withColumn("ancestors", F.when(F.col("depth") == 3, F.slice("ancestors", 2, 9)).otherwise(F.col("ancestors")))
    try:
        assert sorted(map(tuple, chat.read_back(off, last).collect())) != good
    except Exception as e:  # noqa: BLE001
        assert "is due" in str(e)


def test_hot_turns_and_ancestors_across_ranges(spark, monkeypatch):
    """Conversations that branch at every depth, over many ranges, with a first turn that all share."""
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    rng = random.Random(3)
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", "hello" if t == 0 else f"{rng.randint(0, 1)}") for c in range(60) for t in range(rng.randint(1, 9))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    nodes, last = chat.forest(df)
    by = {bytes(r.node): r for r in nodes.collect()}
    spans = sorted((r.start, r.end) for r in by.values())
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and sum(not r.parent for r in by.values()) == 1
    for r in by.values():
        ups = _ups(by, r)
        covered = [i for a in r.ancestors for i in range(a.start, a.end)]
        assert covered == [i for u in ups for i in range(u.start, u.end)] and len(r.ancestors) <= len(ups)
    got = {r.conv_id: r for r in chat.read_back(nodes, last).collect()}
    for c in range(60):
        said = "".join(f"{r}\n{t}\n" for k, _, r, t in rows if k == c)
        assert got[c].turns_sha256 == hashlib.sha256(said.encode()).hexdigest() and got[c].n_turns == sum(k == c for k, *_ in rows)


def test_long_conversations_keep_short_paths(spark):
    """All rows with a null id are one conversation; two others leave it after its second and its hundredth turn."""
    said = [("user" if t % 2 == 0 else "assistant", f"turn {t}") for t in range(3000)]
    rows = [(None, t, *x) for t, x in enumerate(said)] + [(1, t, *x) for t, x in enumerate([*said[:2], ("user", "other")])] + [(2, t, *x) for t, x in enumerate([*said[:100], ("user", "more"), ("assistant", "end")])]
    nodes, turns = chat.forest(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = nodes.collect()
    by = {bytes(r.node): r for r in found}
    assert len(found) == 3003 and max(len(r.path) for r in found) <= 3 * (chat.NODE + chat.DEPTH)
    spans = sorted((r.start, r.end) for r in found)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    for r in found[::50] + [x for x in found if x.depth in (2, 3, 100, 101)]:
        assert [i for a in r.ancestors for i in range(a.start, a.end)] == [i for u in _ups(by, r) for i in range(u.start, u.end)]
        assert len(r.ancestors) <= 3 and r.position_ids[0] == sum(len(u.ids) for u in _ups(by, r))
    got = {r.conv_id: r for r in chat.read_back(nodes, turns).collect()}
    for c in (None, 1, 2):
        text = "".join(f"{r}\n{t}\n" for k, _, r, t in rows if k == c)
        assert got[c].n_turns == sum(k == c for k, *_ in rows) and got[c].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("text", ["</s>[INST] ok [/INST]", "<|end|>\n", "\\<\\", "[\\|<|\\>", ""])
def test_escaping_is_reversible_and_leaves_no_marker(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not any(m in chat.escape(text) for m in ("<|", "</s>", "[INST]", "[/INST]"))


ARTICLE = "<h1>A &amp; B</h1><p>First  <b>bold</b>\n text</p><ul><li>one</li><li>two&nbsp;x</li></ul><p>Last words of the piece.</p>"
PLAIN = "A & B\nFirst bold text\none\ntwo x\nLast words of the piece."


def test_main_text(spark):
    rng = random.Random(1)
    say = lambda n: " ".join(rng.choice("lorem ipsum dolor sit amet".split()) for _ in range(n))
    pages = [f'<html><head><title>{say(4)}</title><script>x("<p>")</script></head><body><nav><ul><li><a href="/">{say(1)}</a></li></ul></nav><div class="ad">{say(9)}</div><article><h1>{say(5)}</h1>{"".join(f"<p>{say(40)}</p>" for _ in range(4))}</article><footer>&copy; {say(5)}</footer>' for _ in range(60)]
    trees = html_text.fit(pages)
    full = f'<body><header><h1>Site</h1></header><nav><a href="/">Home</a></nav><main>{ARTICLE}</main><aside><p>See also this</p></aside><div id="comments"><div class="comment"><p>I liked it</p></div></div><form><input name="q"></form><div class="cookie-notice">We use cookies</div><footer>c</footer></body>'
    assert html_text.texts([full], trees) == [PLAIN]
    assert html_text.texts([full.replace("<main>", '<div class="post">').replace("</main>", "</div>")], trees) == [PLAIN]
    assert html_text.texts(["", "plain &lt;text&gt;", "<!-- x -->", "<script>1</script>"], trees) == ["", "plain <text>", "", ""]
    rows = [(i, "u", p) for i, p in enumerate(pages)] + [(100, "u", None), (101, None, ""), (102, "u", "<article>" + "<p>x y</p>" * 5000 + "</article>"), (1, "u", pages[1])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("x"), "n_chars": F.lit(1)})
    got = html_text.extract(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert next(r for r in got if r.page_id == 102).text.count("\n") == 4999 and next(r for r in got if r.page_id == 100).text == ""
    assert html_text.extract(df.where("false")).count() == 0


@pytest.mark.parametrize(
    "source, want",
    [
        ("<html><head><title>T</title><meta charset=x><body><p>one<p>two", ["one", "two"]), ("<head><title>T</title><p>one</p>", ["one"]), ("<head><title>T</title></head><body><p>one</p>", ["one"]),
        ("<p>a <svg width='1'/> b</p><p>c</p>", ["a b", "c"]), ("<p>a <math/> b</p><p>c</p>", ["a b", "c"]), ("<p>a <iframe src=x /> b</p><p>c</p>", ["a b", "c"]), ("<p>a <svg><text>s</text></svg>b</p>", ["a b"]),
        ("<div><button>Like<p>one</p><p>two</p></div><p>three</p>", ["one", "two", "three"]), ("<p>a <button>Like</p><p>b <button>x</button> c</p>", ["a", "b c"]), ("<select><option>x<option>y<p>one</p>", ["one"]), ("<iframe src=x><p>one</p>", ["one"]),
        ("<p>a <math><mi>x</mi></math> b <object>o</object> <canvas>c</canvas></p>", ["a x b o c"]), ("<p>a <noscript><p>n</p><div>m</div></noscript>b</p>", ["a b"]), ("<svg-icon></svg-icon><p>one</p>", ["one"]),
        ("<p>a<a href=x>l<button>k<div>d</div></button>m</a></p>", ["alm"]), ("<template><svg></svg><p>t</p></template><p>one</p><script>x<p>y", ["one"]), ("<p>a</p><textarea>t<p>b", ["a"]),
    ],
)
def test_missing_end_tags_lose_no_text(source, want):
    page = html_text.Page(source)
    assert [s for _, s, _ in page.blocks] == want
    assert len({len(c) for c in (page.parent, page.tag, page.groups, page.label, page.depth, page.inline)}) == 1 and all(node < len(page.parent) for node, _, _ in page.blocks)


@pytest.mark.parametrize(
    "source, want",
    [
        ("<p title=it's>one</p><p>two's</p>", ["one", "two's"]), ('<p title="a>b">one</p>', ["one"]), ('<p title="a>one</p><p>two</p>', ["one", "two"]), ("<p>1 < 2 and 3 > 2</p>", ["1 < 2 and 3 > 2"]), ("<p>a <b", ["a <b"]),
        ("<!--><p>one</p>", ["one"]), ("<p>a<!-- x --!>b</p><p>c</p>", ["ab", "c"]), ("<!--!><p>no</p>--><p>one</p>", ["one"]), ("<!---!><p>no</p>--!><p>one</p>", ["one"]), ("<!----!><p>one</p>", ["one"]), ("<!--a--!-->x<p>one</p>", ["x", "one"]),
        ("<!-- - -- -- > --><p>one</p>", ["one"]), ("<!-- x --><p>one</p><!-- y", ["one"]), ("<script>a</script x><p>one</p>", ["one"]), ('<div class="a" "><p>one</p></div>', ["one"]), ("<p>a <datalist><option>x<option>y</datalist> b</p>", ["a b"]),
        ("<li><p>one<li>two", ["one", "two"]), ("<p><i>a<div>b</i>c</div>", ["a", "bc"]),
    ],
)
def test_broken_tags_end_where_they_should(source, want):
    assert [s for _, s, _ in html_text.Page(source).blocks] == want


@pytest.mark.parametrize("unit", ["<a ", '<a "', '<a b="', "<a b='\"> ", '<a b="<c d=\'', "<b>", "<svg><iframe>", "<i><b></i>", "<td><b></i>", "<div><li>", "<script "])
def test_broken_pages_take_linear_time(unit):
    start = time.process_time()
    for tail in ("", ">", "'>", '">'):
        html_text.Page(unit * (120_000 // len(unit)) + tail + "<p>end</p>")
    assert time.process_time() - start < 8


class Slow(HTMLParser):
    """Blocks of well-formed pages by the standard parser."""

    def __init__(self, source):
        super().__init__(convert_charrefs=True)
        self.blocks, self.text = [], []
        self.feed(source)
        self.close()
        self.cut()

    def cut(self):
        if s := " ".join("".join(self.text).split()):
            self.blocks.append(s)
        self.text = []

    def handle_starttag(self, tag, attrs):
        if tag in html_text.TAG:
            self.cut()
        elif tag == "br":
            self.text.append(" ")

    def handle_endtag(self, tag):
        if tag in html_text.TAG:
            self.cut()

    def handle_data(self, data):
        self.text.append(data)


def test_blocks_equal_the_standard_parser():
    rng = random.Random(11)

    def made(depth):
        out = []
        for _ in range(rng.randint(1, 4)):
            kind = rng.choice(["text", "text", "ref", "inline", "block", "br", "comment"])
            if kind == "text" or depth == 0:
                out.append(rng.choice(["one ", " two", "a  b\n", "x<1 ", "é中 "]))
            elif kind == "ref":
                out.append(rng.choice(["&amp;", "&lt;p&gt;", "&#233;", "&nbsp;", "&copy; "]))
            elif kind == "comment":
                out.append("<!-- <p>no</p> -->")
            elif kind == "br":
                out.append("<br/>")
            else:
                tag = rng.choice(["b", "a", "span", "em"] if kind == "inline" else ["div", "section", "ul", "blockquote", "article", "h2"])
                out.append(f'<{tag} class="x > y" title=\'q\'>{made(depth - 1 if kind == "block" else 0)}</{tag}>')
        return "".join(out)

    for _ in range(400):
        source = made(4)
        assert [s for _, s, _ in html_text.Page(source).blocks] == Slow(source).blocks, source


def test_deep_pages_stay_quick():
    deep = html_text.Page("<div>" * 20_000 + "x" + "</div>" * 20_000)
    x = html_text.matrix([deep, html_text.Page("<p>a</p>")])
    assert x.shape[0] == 20_003 and x[:20_001, 0].tolist() == list(range(20_001)) and x[20_001:, 0].tolist() == [0, 1]


def test_decoding_is_the_best_consistent_choice():
    rng = np.random.default_rng(0)
    for _ in range(60):
        n = int(rng.integers(1, 7))
        parent = [-1] + [int(rng.integers(0, i)) for i in range(1, n)]
        score = np.log(rng.dirichlet(np.ones(3), size=n))
        got = html_text.decode(parent, score)

        def fine(s):
            return all(not (s[parent[i]] == html_text.OUT and s[i] != html_text.OUT) and not (s[parent[i]] == html_text.IN and s[i] == html_text.WRAP) for i in range(1, n))

        every = [s for s in np.ndindex(*[3] * n) if fine(s)]
        assert fine(got) and abs(sum(score[i, s] for i, s in enumerate(got)) - max(sum(score[i, k] for i, k in enumerate(s)) for s in every)) < 1e-9


def test_pipeline_equals_brute_force(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    rng = random.Random(21)
    say = lambda: [rng.choice("alpha beta gamma delta eps zeta".split()) + str(rng.randint(0, 60)) for _ in range(rng.choice([3, 30, 60]))]
    base = [say() for _ in range(25)]
    rows = []
    for i in range(240):
        w = list(rng.choice(base))
        if rng.random() < 0.4:
            w[rng.randrange(len(w))] = f"y{rng.randint(0, 99)}"
        if i % 7 == 0:
            w += rng.choice(["you vile scum", "utter scum vile"]).split() * 2
        if i % 5 == 0:
            w.insert(rng.randrange(len(w)), rng.choice(["a.b@c.de", "10.0.0.1", "4111 1111 1111 1111", "+1 (988) 555-2485"]))
        rows.append((i * 3, " ".join(w)))
    rows += [(1001, None), (1002, ""), (1003, " \n ")]
    spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "key": F.lit("k"), "n_chars": F.length("text").cast("long"), "rep": F.lit(1)}).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 21 == 0)) for i, _ in rows if i < 720], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, labels = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "labels"))
    rejected = {r.doc_id for r in toxicity.score(docs, labels).collect() if r.predicted}
    assert rejected and all(i % 21 == 0 for i in rejected)
    left = {i: t for i, t in rows if i not in rejected}
    component = slow_components(slow_sets(left.items()))
    kept = {i: t for i, t in left.items() if component[i] == i}
    assert len(kept) < len(left)
    kept_rows = spark.createDataFrame(list(kept.items()), "doc_id long, text string")
    weights = pii.fit(pii.sample_windows(kept_rows))
    model, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), set()
    for i, t in kept.items():
        out, last, t = "", 0, t or ""
        base_spans, added = pii.find(t.encode(), weights)
        for k, s, e in sorted(base_spans + added, key=lambda x: (x[1], -x[2])):
            out, last = (out + t[last:s] + f"[{k.upper()}]" if s >= last else out), max(last, e)
        ids = np.array([*model.encode(out + t[last:], add_special_tokens=False).ids, 0], "<u4")
        want |= {(i, k, k * 2048, len(p), zlib.crc32(p.tobytes())) for k in range(-(-len(ids) // 2048)) for p in [ids[k * 2048 : (k + 1) * 2048]]}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(got) == len(want) and {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want


def test_pipeline_of_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (None, None), (1, "a b"), (1, "c d")], "doc_id long, text string")
    for name, part in (("none", docs.where("false")), ("few", docs)):
        part.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    assert sorted(str(r.doc_id) for r in corpus_pipeline.run(spark, f"{tmp_path}/few").collect()) == ["1", "1", "None"]


def test_pipeline_stages(spark, edge, tmp_path):
    rng = random.Random(7)
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()] + [(100 + i, " ".join(rng.choice("a b c d e f g h".split()) + str(rng.randint(0, 99)) for _ in range(30)) + (" you vile scum" if i % 5 == 0 else " mail a.b@c.de")) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(100 + i, 1, int(i % 5 == 0)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        then, now = now, spark.read.parquet(f"{tmp_path}/{k}")
        if name != "packing":
            assert now.columns == then.columns
        if name == "toxicity":
            assert not {r.doc_id for r in now.collect() if r.doc_id} & {100 + i for i in range(0, 200, 5)} and now.count() == len(rows) - 40
        if name == "personal_data":
            assert now.where("text like '%a.b@c.de%'").count() == 0 and now.where("text like '%[EMAIL]%'").count() == 160
    assert corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "piece", "start", "length", "ids_crc32").exceptAll(now.select("doc_id", "piece", "start", "length", "ids_crc32")).count() == 0
