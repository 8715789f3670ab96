"""Main text of web pages by gradient-boosted trees over DOM nodes.

A page becomes a tree of block elements with their own inline text. Each node has features: its tag, its parent's, words in class, id and role,
depth, text and markup of its subtree, link share, place among its siblings and what those hold, and whether
an ancestor looks like content or like page furniture. Boosted trees score three states: outside, wrapper (holds main text
but is not itself main) and inside. Decoding takes the likeliest states of the whole tree under which an outside node has only outside descendants
and an inside node has no wrapper below, so that no choice contradicts an ancestor's.

The trees are fitted on at most ``TRAIN_PAGES`` pages of less than ``TRAIN_CHARS`` characters, by the hash of their ids. Their labels come from semantic elements and from what is done to
the pages: known furniture is put in, and content elements are renamed, so that the trees learn to do without the elements.

Character references are decoded, white space in a block becomes one space, blocks are joined by a line feed. Null and empty pages give an
empty text, as do pages without content. What stands between the tags of a hidden element (``HIDDEN``) is left out; where its end tag is missing, only
its own text is, up to the end of the element around it, and blocks below it count; a head ends at the body or the first block. Plain text without markup counts as content. Pages are read whole; repeated rows give repeated
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_fraction, map_rows

TRAIN_PAGES = 240
TRAIN_CHARS = 20_000  # of the longest page that is trained on
FILLER_PAGES, FILLER_WORDS, FILLER = 40, 200, 3_000  # where the words of made furniture come from: pages, words of each, and in all
ROUNDS, DEPTH, RATE, BINS = 16, 4, 0.35, 32
OUT, WRAP, IN = 0, 1, 2

BLOCK = (
    "body article main section div nav header footer aside form p li ul ol dl dt dd h1 h2 h3 h4 h5 h6 table thead tbody tfoot tr td th caption figure"
    " figcaption blockquote pre address details summary dialog fieldset legend center hgroup menu hr html"
).split()
TAG = {t: i for i, t in enumerate(BLOCK)}
RAW = "script style textarea".split()  # without an end tag these run to the end of the page
HIDDEN = frozenset("noscript template svg iframe head title select datalist option button".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr")}
GROUPS = (
    "nav|menu|breadcrumbs?|pagination|pager|toolbar|topbar|navbar|navigation|toc", "ads?|advert\\w*|sponsor\\w*|promo\\w*|banner|adsense|dfp|outbrain|taboola",
    "comments?|repl(?:y|ies)|disqus|discussion|responses?", "sidebar|side|aside|widget|related|recommend\\w*|trending|popular|rail|complementary",
    "footer|foot|bottom|copyright|colophon|contentinfo", "header|masthead|head|brand|logo|site", "cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscri\\w*|signup|login|paywall",
    "share|sharing|social|follow", "article|post|entry|story|content|main|body|text|page|prose|blog", "form|search|field|input|contact",
)
GROUP = re.compile("|".join(f"(?P<g{i}>(?:{g})(?![a-z]))" for i, g in enumerate(GROUPS)))
WORDY = re.compile(r"[a-z]+")
OPEN = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
COMMENT_END = re.compile(r"--(!)?>")
QUICK_END = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])))*+>""")
STOP = re.compile(r"""[<>]|=\s*["']""")
QUICK = 4_096  # characters in which a tag's end is looked for first
RAW_END = {name: re.compile(rf"</{name}[\s/>]", re.I) for name in RAW}
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|data-y)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


class Tags:
    """The tags of a page in order, in time proportional to its length: (start, end, slash, name, attributes), the name empty for comments and the like.

    Quotes count after an equals sign alone. One that never closes is an ordinary character, and a tag that never ends outside quotes ends at its
    first ``>``; where no ``>`` follows, what is left is text."""

    def __init__(self, source: str):
        self.source = source
        self.last = {q: source.rfind(q) for q in "\"'"}
        self.hopeless: set[int] = set()  # places outside quotes from which no end was found

    def __iter__(self) -> Iterator[tuple[int, int, str, str, str]]:
        source, at = self.source, 0
        while m := OPEN.search(source, at):
            start = m.start()
            if m[1]:
                stop = COMMENT_END.search(source, start + 2)
                while stop and stop[1] and stop.start() < start + 4:  # its dashes open the comment
                    stop = COMMENT_END.search(source, stop.start() + 1)
                at = stop.end() if stop else len(source)
                yield start, at, "", "", ""
                continue
            end = source.find(">", m.end()) if m[2] else self.end(m)
            if end < 0:
                return
            at = end + 1
            if m[2]:
                yield start, at, "", "", ""
                continue
            name = m[4].lower()
            if name in RAW_END and not m[3]:
                close = RAW_END[name].search(source, at)
                at = source.find(">", close.start()) + 1 if close else 0
                at = at or len(source)
                yield start, at, "", "", ""
                continue
            yield start, at, m[3], name, source[m.end() : end]

    def end(self, m: re.Match) -> int:
        """Where the ``>`` of a tag is, or -1."""
        source, at = self.source, m.end()
        if quick := QUICK_END.match(source, at, at + QUICK):
            return quick.end() - 1
        passed = [m.start()]
        while m.start() not in self.hopeless and (stop := STOP.search(source, at)):
            c, at = stop[0][-1], stop.end()
            if c == ">":
                return at - 1
            if c == "<":
                if at - 1 in self.hopeless:
                    break
                passed.append(at - 1)
            elif at <= self.last[c]:
                at = source.index(c, at) + 1
        self.hopeless.update(passed)
        return source.find(">", m.end())


class Page:
    """Nodes in page order: parent, tag, attribute groups, label; pieces of inline text with their node and whether they are in a link."""

    def __init__(self, source: str):
        self.parent, self.tag, self.groups, self.label = [-1], [TAG["body"]], [0], [None]
        self.depth, self.inline = [0], [0]
        self.blocks: list[tuple[int, str, int]] = []  # node, text, characters in links
        stack: list[tuple[str, int]] = [("body", 0)]  # open elements; inline ones keep their block's node
        seats: dict[str, list[int]] = defaultdict(list, body=[0])  # where in the stack each name is open
        tops = [0]  # where blocks are
        text: list[str] = []
        holds: list[list] = []  # open hidden elements: name, seat in the stack, nodes, blocks, inline tags, and the text before them once it was flushed
        held: Counter[str] = Counter()
        linked, at = 0, 0

        def flush() -> None:
            nonlocal linked
            before = None
            for hold in reversed(holds):
                if hold[5] is not None:
                    break
                before = before or (text.copy(), linked)
                hold[5] = before
            if text:
                s = " ".join(html.unescape("".join(text)).split())
                if s:
                    self.blocks.append((stack[-1][1], s, min(linked, len(s))))
                text.clear()
            linked = 0

        def push(name: str, node: int) -> None:
            seats[name].append(len(stack))
            if name in TAG:
                tops.append(len(stack))
            stack.append((name, node))

        def pop_to(k: int) -> None:
            flush()
            cut(k)

        def cut(k: int) -> None:
            for name, _ in stack[k:]:
                seats[name].pop()
            while tops[-1] >= k:
                tops.pop()
            del stack[k:]
            while holds and holds[-1][1] >= k:
                held[holds.pop()[0]] -= 1

        def leave_out(hold: list) -> None:
            """The end tag is there: all since the start tag goes."""
            nonlocal linked
            _, k, nodes, blocks, inline, before = hold
            cut(k)
            for column in (self.parent, self.tag, self.groups, self.label, self.depth, self.inline):
                del column[nodes:]
            del self.blocks[blocks:]
            self.inline[stack[-1][1]] = inline
            if before is not None:
                text[:], linked = before

        def say(s: str) -> None:
            nonlocal linked
            if holds and stack[-1][1] == stack[holds[-1][1]][1]:
                return
            text.append(s)
            if seats["a"]:
                linked += len(s)

        def innermost(names: tuple[str, ...]) -> int:
            return max((seats[t][-1] for t in names if seats[t]), default=0)

        for start, end, slash, name, attributes in Tags(source):
            if start > at:
                say(source[at:start])
            at = end
            if not name:
                continue
            if name in ("html", "body"):
                if not slash and name == "body":
                    if holds and holds[0][0] == "head":
                        pop_to(holds[0][1])
                    self.groups[0] |= _groups(attributes)[0]
                continue
            if name in HIDDEN:
                same = next(i for i in range(len(holds) - 1, -1, -1) if holds[i][0] == name) if held[name] else None
                if slash and same is not None:
                    leave_out(holds[same])
                elif not slash and not attributes.endswith("/"):
                    if same is not None and name not in ("svg", "template"):
                        del holds[same]  # these don't nest, so that the end tag of the one before is missing
                        held[name] -= 1
                    node = stack[-1][1]
                    holds.append([name, len(stack), len(self.parent), len(self.blocks), self.inline[node], None])
                    held[name] += 1
                    push(name, node)
                continue
            if slash:
                k = innermost((name,))
                if k and name in TAG:
                    pop_to(k)
                elif k > tops[-1]:
                    cut(k)
                continue
            if name == "br":
                say(" ")
            if name in TAG:
                if holds and holds[-1][0] == "head":
                    pop_to(holds[-1][1])
                if name == "hr":
                    flush()
                    continue
                k = innermost(("p", *CLOSES.get(name, ())))  # what the new block closes by itself
                wall = innermost(SCOPE[name]) if name in CLOSES else tops[-1]
                if k >= max(wall, 1) and not (holds and k <= holds[-1][1]):
                    pop_to(k)
                flush()
                groups, label = _groups(attributes) if attributes else (0, None)
                self.parent.append(stack[-1][1])
                self.tag.append(TAG[name])
                self.groups.append(groups)
                self.label.append(label)
                self.depth.append(self.depth[stack[-1][1]] + 1)
                self.inline.append(0)
                push(name, len(self.parent) - 1)
            elif name not in VOID and not attributes.endswith("/"):
                self.inline[stack[-1][1]] += 1
                push(name, stack[-1][1])
        if at < len(source):
            say(source[at:])
        flush()


def _groups(attributes: str) -> tuple[int, str | None]:
    found, label = 0, None
    for m in ATTRIBUTE.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "data-y":
            label = value
            continue
        for word in WORDY.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()):
            if g := GROUP.fullmatch(word):
                found |= 1 << int(g.lastgroup[1:])
    return found, label


def matrix(pages: list[Page]) -> np.ndarray:
    """A row of features for each node of the pages, one after the other."""
    sizes = [len(p.parent) for p in pages]
    first = np.cumsum([0] + sizes[:-1])
    n = sum(sizes)
    root = np.repeat(first, sizes)
    parent = np.concatenate([np.array(p.parent) for p in pages]) + root
    depth = np.concatenate([p.depth for p in pages]).astype(np.int64)
    parent[depth == 0] = np.flatnonzero(depth == 0)
    tag = np.concatenate([p.tag for p in pages])
    groups = np.concatenate([p.groups for p in pages]).astype(np.int64)
    own = np.zeros((n, 6))  # characters, linked characters, pieces, inline tags, paragraphs, nodes
    own[:, 3] = np.concatenate([p.inline for p in pages])
    own[:, 4], own[:, 5] = tag == TAG["p"], 1
    for f, p in zip(first, pages):
        for node, s, linked in p.blocks:
            own[f + node, :3] += (len(s), linked, 1)
    under = own.copy()
    levels = np.split(np.argsort(depth, kind="stable"), np.cumsum(np.bincount(depth))[:-1])
    for level in levels[:0:-1]:
        np.add.at(under, parent[level], under[level])
    content, furniture = (1 << 8), sum(1 << i for i in range(len(GROUPS)) if i != 8)
    good = (np.isin(tag, [TAG["article"], TAG["main"]]) | ((groups & content) > 0)).astype(float)
    bad = (np.isin(tag, [TAG[t] for t in ("nav", "footer", "aside", "form", "header")]) | ((groups & furniture) > 0)).astype(float)
    above_good, above_bad = np.zeros(n), np.zeros(n)
    for level in levels[1:]:
        up = parent[level]
        above_good[level] = np.maximum(above_good[up], good[up])
        above_bad[level] = np.maximum(above_bad[up], bad[up])
    inner = depth > 0
    children = np.bincount(parent[inner], minlength=n).astype(float)
    chars_below = np.bincount(parent[inner], weights=under[inner, 0], minlength=n)
    code = parent * len(TAG) + tag
    _, which, same = np.unique(code, return_inverse=True, return_counts=True)
    order = np.argsort(parent[inner], kind="stable")
    seat = np.zeros(n)
    index = np.flatnonzero(inner)[order]
    if len(index):
        starts = np.concatenate([[True], np.diff(parent[index]) != 0])
        seat[index] = np.arange(len(index)) - np.maximum.accumulate(np.where(starts, np.arange(len(index)), 0))
    holds_good = np.zeros(n)
    for level in levels[:0:-1]:
        np.maximum.at(holds_good, parent[level], np.maximum(good[level], holds_good[level]))
    up = parent
    numbers = [
        depth, np.log1p(under[:, 0]), np.log1p(own[:, 0]), under[:, 0] / (under[:, 5] + under[:, 3]), under[:, 1] / np.maximum(under[:, 0], 1), np.log1p(under[:, 4]), np.log1p(under[:, 5]),
        under[:, 0] / np.maximum(under[root, 0], 1), children, children[up], seat, seat / np.maximum(children[up], 1), same[which], np.log1p(np.maximum(chars_below[up] - under[:, 0], 0)),
        under[:, 0] / np.maximum(chars_below[up], 1), above_good, above_bad, good, bad, holds_good, good[up], bad[up],
    ]
    tags = [(tag == i).astype(float) for i in range(30)] + [np.isin(tag[up], [TAG[t] for t in ts.split()]).astype(float) for ts in ("body", "div section", "ul ol", "article main")]
    words = [((groups >> i) & 1).astype(float) for i in range(len(GROUPS))] + [((groups[up] >> i) & 1).astype(float) for i in range(len(GROUPS))]
    return np.stack([*numbers, *tags, *words], axis=1).astype(np.float32)


class Trees:
    """Gradient-boosted trees with a softmax over the three states, split on histograms."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(self.cuts)], axis=1)
        self.start = np.log(np.bincount(y, minlength=3) / len(y) + 1e-3)
        score, hot = np.tile(self.start, (len(y), 1)), np.eye(3)[y]
        self.trees = []
        for _ in range(ROUNDS):
            p = np.exp(score - score.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            for k in range(3):
                tree = self.grow(binned, hot[:, k] - p[:, k], p[:, k] * (1 - p[:, k]))
                self.trees.append((k, *tree))
                score[:, k] += self.follow(binned, *tree)

    @staticmethod
    def grow(binned: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inner = 2**DEPTH - 1
        feature, cut, value = np.zeros(inner, np.int64), np.full(inner, BINS), np.zeros(2**DEPTH)
        at = np.zeros(len(g), np.int64)
        for level in range(DEPTH):
            base, width = 2**level - 1, 2**level
            best = np.full(width, 1e-6)
            local = at - base
            for f in range(binned.shape[1]):
                code = local * (BINS + 1) + binned[:, f]
                gs = np.bincount(code, g, width * (BINS + 1)).reshape(width, -1).cumsum(1)
                hs = np.bincount(code, h, width * (BINS + 1)).reshape(width, -1).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                gain[(hs < 1e-2) | (ht - hs < 1e-2)] = 0
                top = gain.argmax(1)
                most = gain[np.arange(width), top]
                better = most > best
                best[better] = most[better]
                feature[base : base + width][better], cut[base : base + width][better] = f, top[better]
            at = 2 * at + 1 + (binned[np.arange(len(g)), feature[at]] > cut[at])
        leaf = at - inner
        value = RATE * np.bincount(leaf, g, 2**DEPTH) / (np.bincount(leaf, h, 2**DEPTH) + 1)
        return feature, cut, value

    @staticmethod
    def follow(binned: np.ndarray, feature: np.ndarray, cut: np.ndarray, value: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(binned), np.int64), np.arange(len(binned))
        for _ in range(DEPTH):
            at = 2 * at + 1 + (binned[rows, feature[at]] > cut[at])
        return value[at - (2**DEPTH - 1)]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(self.cuts)], axis=1).astype(np.int16)
        score = np.tile(self.start, (len(x), 1))
        for k, *tree in self.trees:
            score[:, k] += self.follow(binned, *tree)
        score -= score.max(1, keepdims=True)
        return score - np.log(np.exp(score).sum(1, keepdims=True))


def decode(parent: list[int], score: np.ndarray) -> list[int]:
    """The likeliest states of a tree (parents come first): outside has only outside below, inside has no wrapper below."""
    best = score.tolist()
    for i in range(len(parent) - 1, 0, -1):
        o, w, n = best[i]
        up = best[parent[i]]
        up[OUT] += o
        up[WRAP] += max(o, w, n)
        up[IN] += max(o, n)
    state = [max((OUT, WRAP, IN), key=lambda s: best[0][s])]
    for i in range(1, len(parent)):
        o, w, n = best[i]
        above = state[parent[i]]
        if above == OUT:
            state.append(OUT)
        elif above == IN:
            state.append(IN if n >= o else OUT)
        else:
            state.append(IN if n >= o and n >= w else WRAP if w >= o else OUT)
    return state


# Training pages ------------------------------------------------------------------------------------------------------
_FURNITURE = (
    '<aside class="{c}"><h3>{a}</h3><ul><li><a href="#">{b}</a></li><li><a href="#">{a}</a></li></ul></aside>', '<div class="cookie-notice"><p>{a} {b}</p><button>OK</button></div>', '<div id="comments"><h3>{a}</h3><div class="comment"><p>{b}</p></div><div class="comment"><p>{l}</p></div></div>',
    '<section class="comments"><ol><li>{l}</li><li>{b}</li></ol></section>', '<form class="search"><label>{a}</label><input name="q"></form>', '<form action="/subscribe"><p>{b}</p><input type="email"></form>', '<div class="sidebar"><p>{a}</p><p><a href="#">{b}</a></p></div>', '<div class="ad">{l}</div>', '<div class="advert"><p>{b}</p></div>',
    '<div class="related-posts"><a href="#">{a}</a> <a href="#">{b}</a></div>', '<header class="site-header"><p>{a}</p><nav><a href="#">{b}</a></nav></header>', '<header><h2>{a}</h2></header>', '<nav><ul><li><a href="#">{a}</a></li><li><a href="#">{b}</a></li></ul></nav>', '<footer><p>&copy; {a}</p><p>{b}</p></footer>', '<div class="footer">{a} | {b}</div>',
    '<div class="share"><a href="#">{a}</a><a href="#">{b}</a></div>', '<div class="newsletter"><p>{l}</p></div>', '<div role="navigation"><a href="#">{a}</a></div>', '<div id="sidebar"><div><p>{l}</p></div></div>', '<div class="notice">{l}</div>', '<aside><p>{l}</p></aside>', '<div class="menu"><ul><li><a href="#">{a}</a></li></ul></div>', '<div class="sponsored"><p>{l}</p></div>',
)
_CONTENT = ("article", "main", 'div class="content"', 'div class="post"', 'div id="main"', 'div class="entry-content"', 'section class="story"', 'div class="article-body"', "div", "section", 'div role="main"')


def _labelled(source: str, rng: random.Random, words: list[str]) -> str:
    """The page with its content element marked (and perhaps renamed), and furniture with marks put in around and inside."""
    say = lambda lo, hi: html.escape(" ".join(rng.choice(words) for _ in range(rng.randint(lo, hi))))
    extra = lambda: re.sub(r"^<(\w+)", r'<\1 data-y="out"', rng.choice(_FURNITURE).format(a=say(1, 4), b=say(3, 12), l=say(12, 50), c=rng.choice(["sidebar", "widget", "related", "x1"])))
    m = re.search(r"<(article|main)\b[^>]*>(.*?)</\1>", source, re.S | re.I)
    inner = m[2] if m else "".join(f"<p>{say(5, 60)}</p>" for _ in range(rng.randint(1, 12)))
    if rng.random() < 0.4:
        inner = "".join(f"<{t}>{say(3, 70)}</{t}>" for t in rng.choices(["p", "p", "p", "p", "h2", "li", "blockquote"], k=rng.randint(1, 14)))
    if rng.random() < 0.3:
        cut = inner.rfind("<p>", 0, rng.randint(1, len(inner) + 1))
        inner = inner[: max(cut, 0)] + extra() + inner[max(cut, 0) :]
    if rng.random() < 0.3:
        inner += extra()
    if rng.random() < 0.08:
        return f'<body data-y="in">{inner}</body>'
    kind = rng.choice(_CONTENT) if rng.random() < 0.6 else "article"
    content = f'<{kind} data-y="in">{inner}</{kind.split()[0]}>'
    before, after = (source[: m.start()], source[m.end() :]) if m else ("", "")
    before += "".join(extra() for _ in range(rng.randint(0, 3)))
    after = "".join(extra() for _ in range(rng.randint(0, 3))) + after
    if rng.random() < 0.4:
        content = f"<div class=\"{rng.choice(['wrapper', 'container', 'row', 'layout', 'page'])}\">{content}{extra() if rng.random() < 0.6 else ''}</div>"
    return before + content + after


def _states(page: Page) -> list[int]:
    """Marks go down the tree; without one a node is a wrapper above content, else outside."""
    if not any(x == "in" for x in page.label[1:]):
        page.label[0] = "in"
    out: list[int] = []
    for i, (up, label) in enumerate(zip(page.parent, page.label)):
        out.append(IN if label == "in" else OUT if label == "out" or i == 0 else out[up])
    for i in range(len(out) - 1, 0, -1):
        up = page.parent[i]
        if out[i] != OUT and out[up] == OUT:
            out[up] = WRAP
    return out


def fit(sources: list[str], seed: int = 5, made: int = 300) -> Trees:
    rng = random.Random(seed)
    words = sorted({w for s in sources[:FILLER_PAGES] for w in re.sub(r"<[^>]*>", " ", s).split()[:FILLER_WORDS]})[:FILLER] or "alpha beta gamma delta epsilon zeta eta theta".split()
    pool = sources or [""]
    pages = [Page(_labelled(pool[i % len(pool)], rng, words)) for i in range(max(made, len(sources)))]
    return Trees(matrix(pages), np.array([s for p in pages for s in _states(p)]))


def sample(pages: DataFrame) -> list[str]:
    """At most TRAIN_PAGES pages, by the hash of their ids."""
    n = pages.count()
    key = F.col("page_id").cast("long")
    part = pages.select(key.alias("page_id"), F.col("html").cast("string").alias("html")).where((hash_fraction(key, 3) < min(1.0, 2 * TRAIN_PAGES / max(n, 1))) & (F.length("html") < TRAIN_CHARS))
    return [r.html for r in part.orderBy(F.xxhash64("page_id"), "page_id", "html").limit(TRAIN_PAGES).collect()]


def texts(sources: list[str], trees: Trees) -> list[str]:
    out = []
    for lo in range(0, len(sources), 400):
        pages = [Page(s) for s in sources[lo : lo + 400]]
        score = trees.log_odds(matrix(pages))
        at = 0
        for p in pages:
            n = len(p.parent)
            state = decode(p.parent, score[at : at + n]) if n > 1 else [IN]
            at += n
            out.append("\n".join(s for node, s, _ in p.blocks if state[node] == IN))
    return out


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: the result that the registered query returns."""
    trees = fit(sample(pages))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = texts(batch.column("html").to_pylist(), trees)
        return pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return map_rows(rows, "page_id long, url string, text string, n_chars long", lambda: step)
