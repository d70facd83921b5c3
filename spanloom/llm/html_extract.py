"""The main text of web pages: gradient-boosted trees judge every block of a page by what it holds, where it stands and what
its attributes say, and the best choice of blocks in which no kept block stands inside a dropped one is its text."""

from __future__ import annotations

import html as html_entities
import math
import pickle
import random
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting

# Training pages are put together from the paragraphs and short texts of at most so many pages of the table, those with the smallest
# hashes of page_id, each of at most so many characters.
SAMPLE_PAGES = 300
SAMPLE_CHARS = 100_000
TRAINING_PAGES = 900
PAGES_AT_ONCE = 64

# Fixed values of HTML: elements that begin a block, that never have content, and whose content is not page text.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section select summary table "
    "tbody td textarea tfoot th thead tr ul".split()
)
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = "script style template noscript title svg iframe canvas".split()
# Those of them that run to the end of the page where they are not closed; of others only the tag goes then.
_TO_THE_END = ("script", "style")
_RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in _RAW}
# What an opening element closes if it is still open, and where that search ends.
_CLOSES = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table"))}

# Words in class, id and role that tell what a block is for.
KINDS = {
    "main": "article main content post entry story body text prose page",
    "nav": "nav navigation navbar menu menubar breadcrumb breadcrumbs pager pagination toc tabs skip",
    "head": "header head masthead banner logo brand topbar hero",
    "foot": "footer foot copyright legal colophon contentinfo",
    "side": "sidebar side aside complementary rail widget widgets related recommended trending popular more tags archive",
    "note": "cookie cookies consent notice notices alert gdpr popup modal dialog overlay toast message warning announcement",
    "ad": "ad ads adv advert adverts advertisement sponsor sponsored promo promotion commercial dfp adsense teaser",
    "form": "form search login signin signup register subscribe newsletter input button poll survey contact",
    "talk": "comment comments reply replies respond response responses discussion disqus thread reader feedback reviews",
    "share": "share sharing social follow like tweet facebook twitter print author byline meta",
}
_KIND = {word: k for k, words in enumerate(KINDS.values()) for word in words.split()}
_TAG_KIND = {"article": "main", "main": "main", "nav": "nav", "menu": "nav", "header": "head", "footer": "foot", "aside": "side", "dialog": "note", "form": "form", "fieldset": "form", "button": "form", "select": "form", "textarea": "form", "search": "form"}
_TAG_KIND = {t: list(KINDS).index(k) for t, k in _TAG_KIND.items()}
_GROUPS = {t: i for i, ts in enumerate(("html body", "div section center", "p", "h1", "h2 h3 h4 h5 h6", "li dd dt", "ul ol dl", "table tbody thead tr td th", "blockquote pre figure figcaption", "#text")) for t in ts.split()}

_TAG = re.compile(r"<(?:[!?]|(/?)([a-zA-Z][^\s/>]*+))")
_MARK = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|aria-label|hidden|style|data-kept)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_STOPS = re.compile(r"[.!?,;:]")


class Node:
    """A block: its place in the tree, the words of its attributes, and its own text if it holds no other block."""

    __slots__ = ("tag", "parent", "depth", "kinds", "hidden", "kept", "children", "text", "chars", "links", "stops", "inside", "paragraphs", "order")

    def __init__(self, tag: str, parent: int, depth: int, attributes: tuple):
        self.tag, self.parent, self.depth = tag, parent, depth
        self.kinds, self.hidden, self.kept = attributes
        self.children: list[int] = []
        self.text: list[str] | str = []
        self.chars = self.links = self.stops = self.inside = self.paragraphs = self.order = 0


_PLAIN = (0, False, False)
_attributes_seen: dict[tuple[str, str], tuple] = {}


def _attributes(tag: str, text: str) -> tuple:
    """Kinds as bits, whether the block is hidden, and the training mark."""
    key = tag, text
    if (known := _attributes_seen.get(key)) is not None:
        return known
    kinds, hidden, kept = 0, False, False
    if tag in _TAG_KIND:
        kinds |= 1 << _TAG_KIND[tag]
    for m in _ATTRIBUTE.finditer(text):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden":
            hidden = True
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        elif name == "data-kept":
            kept = True
        else:
            for word in _WORDS.findall(value):
                if (k := _KIND.get(word.lower())) is not None:
                    kinds |= 1 << k
    if len(_attributes_seen) > 20_000:
        _attributes_seen.clear()
    _attributes_seen[key] = kinds, hidden, kept
    return kinds, hidden, kept


def _tag_ends(page: str) -> tuple[list[int], list[int]]:
    """Places of all `>` and quotes, and for each the end of a tag that goes on there: the next `>` outside quotes, or -1.
    Read from the end, so that no tag, however broken, is looked through twice."""
    marks = [m.start() for m in _MARK.finditer(page)]
    ends, same = [-1] * (len(marks) + 1), {}
    for k in range(len(marks) - 1, -1, -1):
        mark = page[marks[k]]
        if mark == ">":
            ends[k] = marks[k]
        else:
            ends[k] = ends[same[mark] + 1] if mark in same else -1
            same[mark] = k
    return marks, ends


class _Open:
    """The open blocks, root first, and where in this list those of each tag stand."""

    def __init__(self):
        self.nodes: list[int] = [0]
        self._tags: list[str] = ["html"]
        self._at: dict[str, list[int]] = {}

    def push(self, node: int, tag: str) -> None:
        self._at.setdefault(tag, []).append(len(self.nodes))
        self.nodes.append(node)
        self._tags.append(tag)

    def last(self, tags: tuple[str, ...]) -> int:
        """The place of the innermost block with one of these tags; 0 if none is open."""
        return max((self._at[t][-1] for t in tags if self._at.get(t)), default=0)

    def close(self, place: int) -> None:
        while len(self.nodes) > place:
            self.nodes.pop()
            self._at[self._tags.pop()].pop()


def parse(page: str) -> list[Node]:
    """The blocks of a page in page order, the root first. Text beside blocks is a block of its own (#text).

    A tag whose quotes do not close ends at its first `>`; without one, it is text. Time follows the length of the page,
    broken or not."""
    nodes = [Node("html", -1, 0, _PLAIN)]
    stack, link, run = _Open(), False, -1

    def opened(tag: str, attributes: tuple) -> int:
        parent = stack.nodes[-1]
        node = Node(tag, parent, len(stack.nodes), attributes)
        nodes[parent].children.append(len(nodes))
        nodes.append(node)
        return len(nodes) - 1

    marks, tag_ends = _tag_ends(page)
    at, last, unclosed = 0, page.rfind(">"), set()
    while at < len(page):
        if page.startswith("<!--", at):
            if (close := page.find("-->", at + 4)) < 0:
                break
            at = close + 3
            continue
        m = _TAG.match(page, at) if at < last else None
        if m is None:
            end = page.find("<", at + 1)
            at, text = (end, page[at:end]) if end >= 0 else (len(page), page[at:])
            if run < 0:
                if not text.strip():
                    continue
                run = opened("#text", _PLAIN)
            text = html_entities.unescape(text) if "&" in text else text
            nodes[run].text.append(text)
            if link:
                nodes[run].links += len(text)
            continue
        ends, tag = m[1], m[2]
        if tag is None:
            at = page.find(">", m.end()) + 1
            continue
        tag, attrs = tag.lower(), ""
        if (end := tag_ends[bisect_left(marks, m.end())]) >= 0:
            attrs = page[m.end() : end]
        else:
            end = page.find(">", m.end())
        at = end + 1
        if tag in _RAW_ENDS and not ends:
            if tag not in unclosed and (tag in _TO_THE_END or page[end - 1] != "/"):
                close = _RAW_ENDS[tag].search(page, at)
                end = page.find(">", close.end()) if close else -1
                if end >= 0:
                    at = end + 1
                elif tag in _TO_THE_END:
                    break
                else:
                    unclosed.add(tag)
        elif tag == "a":
            link = not ends
        elif tag == "br" and run >= 0:
            nodes[run].text.append(" ")
        elif tag in BLOCKS:
            run, link = -1, False
            if ends:
                if place := stack.last((tag,)):
                    stack.close(place)
                continue
            if tag in ("html", "body") and len(stack.nodes) == 1:
                continue
            if nodes[stack.nodes[-1]].tag == "p":
                stack.close(len(stack.nodes) - 1)
            if tag in _CLOSES:
                same, until = _CLOSES[tag]
                if (place := stack.last(same)) > stack.last(until):
                    stack.close(place)
            node = opened(tag, _attributes(tag, attrs) if attrs or tag in _TAG_KIND else _PLAIN)
            if tag not in EMPTY:
                stack.push(node, tag)
    for node in nodes:
        if node.tag == "#text":
            node.text = " ".join("".join(node.text).split())
            node.chars, node.stops = len(node.text), len(_STOPS.findall(node.text))
            node.links = min(node.links, node.chars)
    return nodes


def features(nodes: list[Node]) -> list[list[float]]:
    """One row a block: depth, density of text, links, marks and blocks below it, its share of the page, siblings, element and
    attribute words, its own and its ancestors'."""
    for i in range(len(nodes) - 1, 0, -1):
        node, parent = nodes[i], nodes[nodes[i].parent]
        parent.chars += node.chars
        parent.links += node.links
        parent.stops += node.stops
        parent.inside += node.inside + 1
        parent.paragraphs += node.paragraphs + (node.tag == "p")
    total = max(nodes[0].chars, 1)
    above = [0] * len(nodes)
    nearest = [0] * len(nodes)
    rows, before = [], 0
    for i, node in enumerate(nodes):
        up = nodes[node.parent] if i else node
        above[i] = (above[node.parent] if i else 0) | node.kinds
        nearest[i] = node.kinds or (nearest[node.parent] if i else 0)
        siblings = up.children if i else [0]
        count = len(siblings)
        chars = node.chars
        rows.append(
            [
                node.depth, math.log1p(chars), node.links / max(chars, 1), node.stops / max(chars, 1), chars / total, before / total,
                math.log1p(node.inside), chars / (node.inside + 1), node.paragraphs, len(node.children),
                node.order / max(count - 1, 1), count, chars / max(up.chars, 1), up.links / max(up.chars, 1), up.stops / max(up.chars, 1), up.paragraphs,
                _GROUPS.get(node.tag, 10), _GROUPS.get(up.tag, 10), node.hidden or (up.hidden and i > 0),
                *[node.kinds >> k & 1 for k in range(len(KINDS))],
                *[nearest[i] >> k & 1 for k in range(len(KINDS))],
                *[above[i] >> k & 1 for k in range(len(KINDS))],
            ]
        )
        if node.tag == "#text":
            before += chars
        for place, child in enumerate(node.children):
            nodes[child].order = place
            nodes[child].hidden |= node.hidden
    return rows


def chosen(nodes: list[Node], odds: np.ndarray) -> str:
    """The text of the blocks whose log-odds add up to most, no block being kept without all blocks around it."""
    best = [float(o) for o in odds]
    for i in range(len(nodes) - 1, 0, -1):
        if best[i] > 0 and nodes[i].tag not in ("form", "select", "textarea"):
            best[nodes[i].parent] += best[i]
        else:
            best[i] = -1.0
    kept, out = [True] * len(nodes), []
    for i in range(1, len(nodes)):
        kept[i] = kept[nodes[i].parent] and best[i] > 0
        if kept[i] and nodes[i].tag == "#text" and nodes[i].text:
            out.append(nodes[i].text)
    return " ".join(out)


# --- training pages --------------------------------------------------------------------------------------------------


def _mark(r: random.Random, kind: str, sure: bool = False) -> str:
    """A class or id with one of the kind's words, in one of the usual spellings; or nothing, or a name that tells nothing."""
    plain = r.choice(["", "", ' class="row"', ' class="c-12 w"', ' id="x7"', ' class="inner wrap"'])
    if not sure and r.random() < 0.35:
        return plain
    word = r.choice(KINDS[kind].split())
    name = r.choice([word, f"{word}-wrap", f"site-{word}", f"{word}Box", f"c-{word}__inner", f"{word}_{r.randint(1, 9)}", f"block {word}"])
    return f' {r.choice(["class", "class", "id"])}="{name}"'


def _training_page(r: random.Random, paragraphs: list[str], snippets: list[str]) -> str:
    def e(text: str) -> str:
        return html_entities.escape(text, quote=False)

    def short() -> str:
        return " ".join(r.choice(snippets).split()[: r.randint(1, 7)])

    def prose(n: int, kept: bool) -> str:
        mark = " data-kept" if kept else ""
        out = []
        for _ in range(n):
            text = e(r.choice(paragraphs))
            if r.random() < 0.1:
                text = f"<b>{text[:30]}</b>{text[30:]}" if "&" not in text[:40] else text
            if r.random() < 0.1:
                text += f' <a href="/x">{e(short())}</a>'
            out.append(r.choice([f"<p{mark}>{text}</p>"] * 8 + [f"<p{mark}>{text}<br>"] + [f"<div{mark}>{text}</div>", f"<blockquote{mark}>{text}</blockquote>", f"<ul{mark}><li{mark}>{text}</li><li{mark}>{e(short())}</li></ul>"]))
            if kept and r.random() < 0.08:
                out.append(f"<h{r.randint(2, 4)}{mark}>{e(short())}</h3>".replace("</h3>", "</h2>"))
        return "".join(out)

    def links(n: int) -> str:
        items = [f'<a href="/{i}">{e(short())}</a>' for i in range(n)]
        return r.choice(["<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>", " | ".join(items), " ".join(items)])

    def block(kind: str) -> str:
        tag = r.choice({"nav": ["nav", "nav", "div", "ul"], "head": ["header", "header", "div"], "foot": ["footer", "footer", "div"], "side": ["aside", "aside", "div"], "talk": ["section", "div"], "form": ["form", "form", "div"]}.get(kind, ["div", "div", "section"]))
        telling = tag not in ("div", "section", "ul")
        mark = _mark(r, kind, sure=not telling and kind != "nav")
        body = {
            "nav": lambda: links(r.randint(3, 9)),
            "head": lambda: f"<{'h1' if r.random() < 0.3 else 'div'}>{e(short())}</{'h1' if r.random() < 0.3 else 'div'}>" + (f"<p>{e(short())}</p>" if r.random() < 0.5 else "") + (links(3) if r.random() < 0.4 else ""),
            "foot": lambda: f"&copy; {e(short())} {r.randint(1999, 2030)} " + (links(r.randint(2, 6)) if r.random() < 0.5 else "") + (f"<p>{e(r.choice(snippets))}</p>" if r.random() < 0.5 else ""),
            "side": lambda: f"<h3>{e(short())}</h3>" + r.choice([links(r.randint(2, 8)), f"<p>{e(r.choice(snippets))}</p>", f"<p>{e(r.choice(paragraphs))}</p>"]),
            "note": lambda: f"<p>{e(r.choice(snippets + paragraphs))}</p>" + ("<button>OK</button>" if r.random() < 0.6 else ""),
            "ad": lambda: r.choice([e(r.choice(snippets)), f"<p>{e(r.choice(snippets + paragraphs))}</p>", f'<a href="/ad">{e(short())}</a>']),
            "form": lambda: f"<label>{e(short())}</label><input><p>{e(r.choice(snippets))}</p><button>{e(short())}</button>",
            "talk": lambda: (f"<h3>{e(short())}</h3>" if r.random() < 0.6 else "") + "".join(f"<div{_mark(r, 'talk') if r.random() < 0.5 else ''}>" + (f"<span>{e(short())}</span>" if r.random() < 0.5 else "") + f"<p>{e(r.choice(paragraphs))}</p></div>" for _ in range(r.randint(1, 6))),
            "share": lambda: links(r.randint(2, 5)) if r.random() < 0.6 else e(short()),
        }[kind]()
        return f"<{tag}{mark}>{body}</{tag}>"

    title = e(short())
    heading = r.choice([f"<h1 data-kept>{title}</h1>", f"<header><h1 data-kept>{title}</h1></header>", f"<h2 data-kept>{title}</h2>", ""])
    inner = heading
    for _ in range(r.randint(1, 4)):
        inner += prose(r.randint(1, 5), True)
        if r.random() < 0.35:
            inner += block(r.choice(["ad", "ad", "share", "form", "side", "note"]))
    if r.random() < 0.15:
        inner += block("talk")
    tag = r.choice(["article", "article", "article", "main", "div", "section"])
    article = f"<{tag}{_mark(r, 'main', sure=tag in ('div', 'section') and r.random() < 0.7)}>{inner}</{tag}>"
    if r.random() < 0.3:
        article = f"<{r.choice(['main', 'div', 'section'])}{_mark(r, 'main')}>{article}</div>"
    above = [block(k) for k in r.sample(["nav", "head", "ad", "note", "form", "side", "nav"], r.randint(1, 5))]
    below = [block(k) for k in r.sample(["foot", "side", "ad", "talk", "share", "form", "nav", "note"], r.randint(1, 6))]
    return "<html><head><title>x</title></head><body>" + "".join(above) + article + "".join(below) + "</body></html>"


def train(pages: list[str], training_pages: int = TRAINING_PAGES) -> boosting.Trees:
    """Trees fitted to pages that are put together from the texts of `pages`, whose right answer is known."""
    r = random.Random(1)
    paragraphs, snippets = [], []
    for page in pages:
        for node in parse(page):
            if node.tag == "#text" and node.text:
                (paragraphs if node.stops and node.chars > 40 and node.links == 0 else snippets).append(node.text)
    snippets = snippets or ["Home about more"]
    paragraphs = paragraphs or ["One sentence, and another one that is somewhat longer. Then a third."]
    rows, labels = [], []
    for _ in range(training_pages):
        nodes = parse(_training_page(r, paragraphs, snippets))
        kept = [n.kept or (n.tag == "#text" and nodes[n.parent].kept) for n in nodes]
        for i in range(len(nodes) - 1, 0, -1):
            kept[nodes[i].parent] |= kept[i]
        rows += features(nodes)
        labels += kept
    return boosting.fit(np.asarray(rows, float), np.asarray(labels, float))


# --- over a table ----------------------------------------------------------------------------------------------------


def _model(pages: DataFrame) -> bytes:
    """The trained trees, from one task over the bounded sample."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [t for b in batches for t in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(texts))], pa.binary())], names=["model"])

    sample = pages.where(f"length(html) BETWEEN 1 AND {SAMPLE_CHARS}").select("page_id", "html", F.xxhash64("page_id").alias("h"))
    sample = sample.orderBy("h", "page_id", "html").limit(SAMPLE_PAGES).select("html")
    row = sample.coalesce(1).mapInArrow(learn, "model binary").first()
    return bytes(row.model) if row else pickle.dumps(train([], training_pages=20))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_blocks) of `pages` (page_id, url, html), one row a page.

    The whole html is read. Text under one block is one stretch; its character references are decoded and its white space
    becomes single spaces; kept blocks follow each other with a space. Null, empty and textless pages have the empty
    text; null page_id and url and repeated rows are kept as they are; other columns are ignored; an empty table gives
    no rows. Of elements whose content is not page text only script, style and comments run on to the end where they are
    not closed; the text of formulas and of objects is kept. Broken html gives what can be read of it. Training sees a
    bounded sample (SAMPLE_PAGES); the trees are broadcast, some ten kilobytes.
    """
    rows = pages.select("page_id", "url", "html")
    trained = pages.sparkSession.sparkContext.broadcast(_model(rows))
    schema = f"page_id {rows.schema['page_id'].dataType.simpleString()}, url {rows.schema['url'].dataType.simpleString()}, text string, n_blocks int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: boosting.Trees = pickle.loads(trained.value)
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(at, PAGES_AT_ONCE)
                parsed = [parse(page or "") for page in part.column(2).to_pylist()]
                table = [row for nodes in parsed for row in features(nodes)]
                odds = np.split(trees.log_odds(np.asarray(table, float)), np.cumsum([len(n) for n in parsed])[:-1])
                texts = [chosen(nodes, o) for nodes, o in zip(parsed, odds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(n) for n in parsed], pa.int32())],
                    names=["page_id", "url", "text", "n_blocks"],
                )

    return rows.mapInArrow(run, schema)


def page_texts(pages: DataFrame) -> DataFrame:
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
