"""Main-text extraction: a linear-chain conditional random field over the leaf blocks of a page's tree.

A page is read once into leaf blocks, the stretches of text between block-level tags, each with its open ancestors. A
block's features come from the ancestors' tags and class words and from its text. The field has two labels (main text,
other), is trained by gradient ascent on labelled pages, and the best label sequence is found by Viterbi. Labelled pages
come from a generator of page layouts with known labels, as the tables have none; it draws layouts, tag and class names
and truncation, so the field can't rely on any one of them.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose content is never text of the page.
HIDDEN = frozenset("script style noscript template head title svg math iframe object audio video canvas select textarea button datalist map".split())
#: Raw elements, whose content has no tags.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
#: Elements that have no end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that may stand in a head; any other start tag, and text, closes one that is open.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: Elements below which a slash before the bracket closes a tag.
FOREIGN = ("svg", "math")
#: Elements inside a line of text; all others end a block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Start tags that close an open p.
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
#: Start tags that close an open element of their own name or a p.
ITEMS = frozenset("li dt dd tr td th option".split())
#: Tags whose presence among the ancestors is a feature.
TAGS = tuple("article main section nav header footer aside form ul ol li table td div p h1 h2 h3 h4 blockquote pre figure figcaption dl details dialog body a".split())
#: Words in class and id names, by kind.
KINDS = {
    "advert": "ad ads adv advert adverts advertisement advertising banner sponsor sponsored sponsors promo promoted promotion adsense adslot dfp outbrain taboola",
    "menu": "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toc tabs links sitemap skip",
    "notice": "cookie cookies notice notices consent gdpr alert alerts newsletter subscribe subscription signup popup modal overlay paywall warning message",
    "side": "sidebar side aside rail related recommended recommendations widget widgets trending popular share sharing social tags archive archives",
    "foot": "footer foot bottom copyright legal colophon credits",
    "head": "header head masthead top topbar logo branding site",
    "comment": "comment comments commentlist reply replies respond response responses disqus discussion reader readers feedback",
    "form": "form search login input field contact",
    "main": "article content post entry story main body text page prose",
}
KIND_OF = {w: k for k, words in KINDS.items() for w in words.split()}
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(?=[a-zA-Z/])[^>]*(?:>|\Z)",
    re.S,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: The white space of HTML and no-break space are turned into one space.
SPACE = re.compile(r"\s+")
BIAS = "bias"


@lru_cache(20_000)
def _kinds(rest: str) -> frozenset[str]:
    found: set[str] = set()
    for m in NAMES.finditer(rest):
        for word in WORD.findall(CAMEL.sub(" ", m[1] or m[2] or m[3] or "").lower()):
            if word in KIND_OF:
                found.add(KIND_OF[word])
    return frozenset(found)


def kinds(rest: str) -> frozenset[str]:
    """The kinds of the class, id and role words in a tag's attributes."""
    if not rest or "=" not in rest:
        return frozenset()
    return _kinds(rest) if len(rest) <= 200 else _kinds.__wrapped__(rest)


class Block:
    __slots__ = ("tags", "kinds", "text", "linked")

    def __init__(self, tags: frozenset[str], found: frozenset[str], text: str, linked: int):
        self.tags, self.kinds, self.text, self.linked = tags, found, text, linked


class Open:
    """The open elements, with what a block and an end tag ask of them kept up to date, so that each tag costs the same at
    any depth."""

    def __init__(self) -> None:
        self.tags: list[str] = []
        self.found: list[frozenset[str]] = []
        #: Places of the open elements by tag, of those that aren't inline, and of those of them that aren't a p.
        self.places: dict[str, list[int]] = {}
        self.solid: list[int] = []
        self.walls: list[int] = []
        self.kinds: dict[str, int] = {}
        self.hidden = 0

    def last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else -1

    def push(self, tag: str, found: frozenset[str]) -> None:
        at = len(self.tags)
        self.tags.append(tag)
        self.found.append(found)
        self.places.setdefault(tag, []).append(at)
        if tag not in INLINE:
            self.solid.append(at)
            if tag != "p":
                self.walls.append(at)
        for k in found:
            self.kinds[k] = self.kinds.get(k, 0) + 1
        self.hidden += tag in HIDDEN

    def close(self, at: int) -> None:
        """Close the element at this place and all inside of it."""
        while len(self.tags) > at:
            tag, here = self.tags.pop(), len(self.tags)
            places = self.places[tag]
            places.pop()
            if not places:
                del self.places[tag]
            for held in (self.solid, self.walls):
                if held and held[-1] == here:
                    held.pop()
            for k in self.found.pop():
                self.kinds[k] -= 1
            self.hidden -= tag in HIDDEN

    def end(self, tag: str) -> None:
        """An end tag closes the last element of its name; that of an inline one doesn't close a block."""
        at = self.last(tag)
        if at >= 0 and not (tag in INLINE and self.solid and self.solid[-1] > at):
            self.close(at)

    def imply(self, same: tuple[str, ...]) -> None:
        """A start tag closes the last open element of these names, unless another block but a p is inside of it."""
        at = max(map(self.last, same))
        if at >= 0 and not (self.walls and self.walls[-1] > at):
            self.close(at)

    def in_head(self) -> bool:
        return bool(self.tags) and self.tags[-1] == "head"

    def foreign(self, tag: str) -> bool:
        return tag in FOREIGN or any(t in self.places for t in FOREIGN)

    def block(self, text: str, linked: int) -> Block:
        return Block(frozenset(t for t in TAGS if t in self.places), frozenset(k for k, n in self.kinds.items() if n), text, min(linked, len(text)))


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order, with character references decoded and white space made single."""
    out: list[Block] = []
    stack, parts, linked = Open(), [], 0
    at, n = 0, len(page)

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                out.append(stack.block(text, linked))
        parts, linked = [], 0

    while (m := MARKUP.search(page, at)) is not None:
        start = m.start()
        if stack.in_head() and page[at:start].strip():
            stack.close(stack.last("head"))
        if start > at and not stack.hidden:
            parts.append(page[at:start])
            linked += (start - at) * ("a" in stack.places)
        at = m.end()
        if not (tag := m["tag"]):
            continue
        tag = tag.lower()
        if tag not in INLINE:
            flush()
        if m["end"]:
            stack.end(tag)
            continue
        if "head" in stack.places and tag not in IN_HEAD:
            stack.close(stack.last("head"))
        if tag in VOID or (m["rest"].endswith("/") and stack.foreign(tag)):
            continue
        if tag in CLOSES_P:
            stack.imply(("p",))
        elif tag in ITEMS:
            stack.imply((tag, "p"))
        if tag in RAW:
            at = _end_of(tag).search(page, at).end()
            continue
        stack.push(tag, kinds(m["rest"]))
    if stack.in_head() and page[at:].strip():
        stack.close(stack.last("head"))
    if at < n and not stack.hidden:
        parts.append(page[at:])
    flush()
    return out


@lru_cache(len(RAW))
def _end_of(tag: str) -> re.Pattern[str]:
    return re.compile(rf"</{tag}\b[^>]*(?:>|\Z)|\Z", re.I)


def features(page: list[Block]) -> list[list[str]]:
    """Names of the features of each block of a page, all of weight one: its text, its ancestors, whether it lies outside of
    what the page marks as its main part (or the page marks nothing), and its neighbours' share of links."""
    marked = [bool(b.tags & _MAIN) or "main" in b.kinds for b in page]
    outside = "outside" if any(marked) else "unmarked"
    sizes = [min(8, len(b.text).bit_length()) for b in page]
    shares = [min(4, 4 * b.linked // len(b.text)) for b in page]
    out = []
    for k, block in enumerate(page):
        text = block.text
        own = [BIAS, f"len{sizes[k]}", f"link{shares[k]}", "stop" if text[-1] in ".!?" else "nostop", f"dots{min(4, sum(text.count(c) for c in '.!?,'))}"]
        own += [f"tag:{t}" for t in block.tags if t in _TAGS]
        own += [f"kind:{x}" for x in block.kinds]
        if "©" in text[:80] or "copyright" in text[:80].lower():
            own.append("rights")
        if not marked[k]:
            own.append(outside)
        for side, i in (("before", k - 1), ("after", k + 1)):
            own.append(f"{side}:link{shares[i]}" if 0 <= i < len(page) else f"{side}:none")
        out.append(own)
    return out


_TAGS, _MAIN = frozenset(TAGS), frozenset(("article", "main"))


class Field:
    """Two-label linear chain: emission weights by feature, transition weights, and their training."""

    def __init__(self, names: list[str], emission: np.ndarray, transition: np.ndarray):
        self.at = {name: i for i, name in enumerate(names)}
        self.emission, self.transition = emission, transition
        self.step = [[float(x) for x in row] for row in transition]
        self.weight = {name: (float(emission[i, 0]), float(emission[i, 1])) for name, i in self.at.items()}

    def scores(self, page: list[Block]) -> list[tuple[float, float]]:
        out = []
        for names in features(page):
            a = b = 0.0
            for name in names:
                if name in self.weight:
                    x, y = self.weight[name]
                    a += x
                    b += y
            out.append((a, b))
        return out

    def decode(self, page: list[Block]) -> list[int]:
        """The most likely labels (1: main text), by Viterbi; of equal ones the other label."""
        if not page:
            return []
        (s00, s01), (s10, s11) = self.step
        emitted = self.scores(page)
        a, b = emitted[0]
        back = []
        for x, y in emitted[1:]:
            a0, a1, b0, b1 = a + s00, b + s10, a + s01, b + s11
            back.append((int(a1 > a0), int(b1 > b0)))
            a, b = max(a0, a1) + x, max(b0, b1) + y
        labels = [int(b > a)]
        for pair in reversed(back):
            labels.append(pair[labels[-1]])
        return labels[::-1]


def train(pages: list[tuple[list[Block], list[int]]], steps: int = 200, rate: float = 0.5, decay: float = 1e-3) -> Field:
    """Gradient ascent (with AdaGrad steps) on the mean log-likelihood, by forward-backward over all pages at once."""
    pages = [(found, labels) for found, labels in pages if found]
    named = [names for found, _ in pages for names in features(found)]
    names = sorted({f for fs in named for f in fs})
    at = {name: i for i, name in enumerate(names)}
    flat = np.array([at[f] for fs in named for f in fs])
    starts = np.cumsum([0, *(len(fs) for fs in named)])[:-1]
    owner = np.repeat(np.arange(len(named)), [len(fs) for fs in named])
    sizes = np.array([len(found) for found, _ in pages])
    page, step = np.repeat(np.arange(len(pages)), sizes), np.concatenate([np.arange(n) for n in sizes])
    labels = np.concatenate([np.array(x) for _, x in pages])
    n, longest = len(pages), int(sizes.max())
    inside = np.arange(longest)[None, :] < sizes[:, None]
    follows = step > 0
    seen_pairs = np.zeros((2, 2))
    np.add.at(seen_pairs, (labels[np.nonzero(follows)[0] - 1], labels[follows]), 1)
    weights, moves = np.zeros((len(names), 2)), np.zeros((2, 2))
    seen_w, seen_m = np.full_like(weights, 1e-6), np.full_like(moves, 1e-6)
    for _ in range(steps):
        emitted = np.zeros((n, longest, 2))
        emitted[page, step] = np.add.reduceat(weights[flat], starts)
        forward, backward = emitted.copy(), np.zeros_like(emitted)
        for t in range(1, longest):
            before = forward[:, t - 1]
            moved = np.logaddexp(before[:, :1] + moves[0], before[:, 1:] + moves[1]) + emitted[:, t]
            forward[:, t] = np.where(inside[:, t, None], moved, before)
        for t in range(longest - 2, -1, -1):
            ahead = emitted[:, t + 1] + backward[:, t + 1]
            moved = np.logaddexp(ahead[:, :1] + moves[:, 0], ahead[:, 1:] + moves[:, 1])
            backward[:, t] = np.where(inside[:, t + 1, None], moved, 0)
        total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        delta = -np.exp(forward + backward - total[:, None, None])[page, step]
        delta[np.arange(len(labels)), labels] += 1
        grad_w = -decay * weights
        for k in (0, 1):
            grad_w[:, k] += np.bincount(flat, delta[owner, k], len(names)) / n
        pairs = forward[:, :-1, :, None] + moves + (emitted + backward)[:, 1:, None, :] - total[:, None, None, None]
        grad_m = (seen_pairs - np.exp(pairs[inside[:, 1:]]).sum(0)) / n - decay * moves
        seen_w += grad_w**2
        seen_m += grad_m**2
        weights += rate * grad_w / np.sqrt(seen_w)
        moves += rate * grad_m / np.sqrt(seen_m)
    return Field(names, weights, moves)


def labelled_page(draw: random.Random) -> tuple[str, list[str]]:
    """A page of a random layout and its main blocks' texts, which no other block has."""
    serial = iter(range(1, 10_000))

    def sentence(lo: int, hi: int, stop: bool = True) -> str:
        words = [draw.choice("lorem ipsum dolor sit amet elit sed do magna aliqua enim minim veniam quis".split()) for _ in range(draw.randint(lo, hi))]
        if len(words) > 6:
            words[len(words) // 2] += ","
        return " ".join([f"w{next(serial)}", *words]).capitalize() + ("." if stop else "")

    def named(kind: str) -> str:
        names = KINDS[kind].split()
        form = draw.choice(["class", "class", "id"])
        extra = draw.choice(["", "", "-box", "-list", " wrap", "_inner"])
        return f' {form}="{draw.choice(names)}{extra}"'

    def links() -> str:
        longest = draw.choice([2, 2, 8])
        return "<ul>" + "".join(f'<li><a href="/{i}">{sentence(0, longest, False)}</a></li>' for i in range(draw.randint(1, 7))) + "</ul>"

    def other(kind: str) -> str:
        if kind == "menu":
            tag = draw.choice(["nav", "nav", "div", "ul"])
            return f"<{tag}{named('menu') if tag != 'nav' or draw.random() < 0.5 else ''}>{links()}</{tag}>"
        if kind == "head":
            tag = draw.choice(["header", "header", "div"])
            return f"<{tag}{named('head') if tag == 'div' or draw.random() < 0.5 else ''}><h2>{sentence(1, 4, False)}</h2><p>{sentence(2, 9)}</p></{tag}>"
        if kind == "foot":
            tag = draw.choice(["footer", "footer", "div"])
            return f"<{tag}{named('foot') if tag == 'div' or draw.random() < 0.4 else ''}>{draw.choice(['&copy; ', '', 'Copyright '])}{sentence(2, 30)}{draw.choice(['', '<p>' + sentence(3, 20) + '</p>'])}</{tag}>"
        if kind == "side":
            tag = draw.choice(["aside", "aside", "div", "section"])
            body = draw.choice([links(), f"<p>{sentence(5, 25)}</p>", f"<h3>{sentence(1, 3, False)}</h3>{links()}"])
            return f"<{tag}{named('side') if tag != 'aside' or draw.random() < 0.5 else ''}>{body}</{tag}>"
        if kind == "form":
            return f"<form action='/s'{draw.choice(['', named('form')])}><label>{sentence(1, 4, False)}</label><input name=q><p>{sentence(3, 12)}</p><button>{sentence(0, 1, False)}</button></form>"
        if kind == "comment":
            tag = draw.choice(["section", "div", "ol"])
            return f"<{tag}{named('comment')}>" + "".join(f"<{draw.choice(['div', 'article'])}{named('comment')}><p>{sentence(4, 40)}</p></div>" for _ in range(draw.randint(1, 4))) + f"</{tag}>"
        tag = draw.choice(["div", "div", "section", "p"])
        return f"<{tag}{named(kind)}>{sentence(3, 30)}{draw.choice(['', '<br>' + sentence(3, 20)])}</{tag}>"

    main: list[str] = []

    def own(lo: int, hi: int, stop: bool = True) -> str:
        text = sentence(lo, hi, stop)
        main.append(text + " © year" if draw.random() < 0.06 else text)
        return main[-1]

    inner = [f"<h1>{own(2, 10, draw.random() < 0.4)}</h1>"] if draw.random() < 0.7 else []
    for _ in range(draw.choice([1, draw.randint(1, 9)]) if inner or draw.random() < 0.5 else 0):
        kind = draw.random()
        if kind < 0.72:
            inner.append(draw.choice(["<p>{}</p>", "<p>{}", "<p><b>{}<br></p>", "<div>{}</div>"]).format(own(*draw.choice([(0, 2), (1, 80), (1, 80), (1, 80)]), draw.random() < 0.8)))
        elif kind < 0.8:
            inner.append(f"<h{draw.randint(2, 4)}>{own(1, 6, False)}</h2>")
        elif kind < 0.86:
            inner.append("<ul>" + "".join(f"<li>{own(1, 12, draw.random() < 0.5)}</li>" for _ in range(draw.randint(1, 4))) + "</ul>")
        elif kind < 0.9:
            inner.append(f"<blockquote>{own(4, 30)}</blockquote>")
        elif kind < 0.93:
            inner.append(f"<table><tr><td>{own(1, 4, False)}</td><td>{own(1, 4, False)}</td></tr></table>")
        else:
            inner.append(other(draw.choice(["advert", "notice", "side", "form"])))
    if not main:  # one paragraph and nothing else
        inner.append(draw.choice(["<p>{}</p>", "<p>{}", "{}"]).format(own(5, 120)))
    if draw.random() < 0.4:
        inner.append(other(draw.choice(["comment", "comment", "side", "side", "notice", "advert"])))
    strange = f' {draw.choice(["class", "id"])}="{"".join(draw.choice("bcdfgkmpvz") for _ in range(6))}"'
    marked = [("article", ""), ("article", named("main")), ("article", strange), ("main", ""), ("div", named("main")), ("section", named("main"))]
    tag, name = draw.choice([*marked, ("div", ""), ("div", strange), ("section", "")])
    wraps = draw.choice([0, 0, 1, 3]) * draw.choice(["<div>", f"<div{strange}>"])
    inner.insert(0, wraps)
    inner.append("</div>" * wraps.count("<div"))
    stray = (tag, name) in marked
    before = [other(k) for k in ("notice", "head", "menu", "advert", "side", "form") if draw.random() < 0.5]
    after = [other(k) for k in ("comment", "side", "advert", "form", "menu", "notice", "foot") if draw.random() < 0.5]
    if stray and draw.random() < 0.3:  # beside a marked part, text without a mark isn't of it
        draw.choice([before, after]).append(draw.choice(["<div>{}</div>", "<p>{}</p>", f"<div{strange[:-1]}x\"><p>{{}}</p></div>"]).format(sentence(2, 30, draw.random() < 0.7)))
    draw.shuffle(before)
    head = f"<title>{sentence(1, 4)}</title><style>p{{}}</style>"
    top = draw.choice([f"<html><head>{head}</head><body>", f"<html><head>{head}</head><body>", f"<head>{head}<body>", f"<head>{head}", head])
    page = f"{top}{''.join(before)}<{tag}{name}>{''.join(inner)}</{tag}>{''.join(after)}"
    return page + draw.choice(["</body></html>", ""]), main


def training_pages(count: int, seed: int) -> list[tuple[list[Block], list[int]]]:
    """Blocks and labels of ``count`` generated pages."""
    draw, out = random.Random(seed), []
    for _ in range(count):
        page, main = labelled_page(draw)
        found, texts = blocks(page), set(main)
        out.append((found, [int(b.text in texts) for b in found]))
    return out


#: Pages that the field is trained on, and their seed.
PAGES, SEED = 1200, 11


@cache
def trained(count: int = PAGES, seed: int = SEED) -> Field:
    """The field trained on generated pages, once in a driver."""
    return train(training_pages(count, seed))


def extract(page: str | None, field: Field) -> str:
    found = blocks(page) if page else []
    return " ".join(b.text for b, label in zip(found, field.decode(found), strict=True) if label)


def html_text(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every row: the main text of its whole page.

    A null or empty page and one without main text give the empty text. A page's time grows with its length at any depth. Markup that is cut off at the page's end counts
    as markup; text after it as text. Repeated rows are read one by one; other columns are ignored.
    """
    model = field or trained()

    @F.pandas_udf("string")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for found in batches:
            yield pd.Series([extract(x, model) for x in found], dtype=object)

    out = pages.select("page_id", "url", read(F.col("html").cast("string")).alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
