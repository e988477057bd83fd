"""Main text of web pages by a linear-chain conditional random field over leaf blocks of the page.

A page is cut into leaf blocks: stretches of text between block tags. Features of a block are the tags,
classes and ids of its ancestors, and the look of its text. The field labels every block as main text or
not and is decoded by Viterbi, so a block is judged with its neighbours.

It is trained on labelled pages. The tables hold none, so ``labelled_pages`` lays out texts of a bounded
sample of the given pages in many page layouts, in which each block's role is known: menus, headers,
sidebars, notices, adverts, forms, comments and footers around and inside articles of various make.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.crf import Chain, fit_chain, viterbi
from fleetlens.llm.linear import SparseRows
from fleetlens.llm.tables import bounded_batches, read
from fleetlens.llm.words import pieces

#: Bounds: pages whose texts are used for training, the characters of such a page, and labelled pages made of them.
SAMPLE_PAGES, SAMPLE_CHARS, LABELLED_PAGES = 60, 50_000, 500
WIDTH, PENALTY = 1 << 13, 0.3

# Element names of HTML by their effect on text.
INLINE = frozenset((
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "input", "ins",
    "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
    "var", "wbr",
    # of formulas
    "math", "maction", "menclose", "merror", "mfenced", "mfrac", "mi", "mmultiscripts", "mn", "mo", "mover", "mpadded", "mphantom",
    "mprescripts", "mroot", "mrow", "ms", "mspace", "msqrt", "mstyle", "msub", "msubsup", "msup", "mtable", "mtd", "mtext", "mtr", "munder",
    "munderover", "none", "semantics"))
VOID = frozenset((
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
RAW_TEXT = frozenset(("script", "style", "title", "textarea", "iframe", "noembed", "noframes", "noscript", "xmp"))
NO_TEXT = frozenset(("annotation", "annotation-xml", "audio", "button", "canvas", "datalist", "object", "select", "svg", "template", "video"))
#: Start tags that end an <svg> which is still open.
BREAKS_OUT = frozenset((
    "b", "big", "blockquote", "body", "br", "center", "code", "dd", "div", "dl", "dt", "em", "embed", "h1", "h2", "h3", "h4", "h5", "h6",
    "head", "hr", "i", "img", "li", "listing", "menu", "meta", "nobr", "ol", "p", "pre", "ruby", "s", "small", "span", "strong", "strike",
    "sub", "sup", "table", "tt", "u", "ul", "var"))
HTML_INSIDE = frozenset(("foreignobject", "desc", "title"))
ENDS_ITSELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

#: Attributes up to the end of a tag. A quote opens a value right after "=" and where it is closed later; elsewhere it is a character.
_TAG_END = re.compile(
    r"""(?:[ \t\n\f\r/]+|(?:=[^ \t\n\f\r/>=]*|[^ \t\n\f\r/>=]+)(?:[ \t\n\f\r]*=[ \t\n\f\r]*(?:"[^"]*"|'[^']*'|[^ \t\n\f\r>]*))?)*+>""")
_TAG_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_NAMES = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
#: The end of a comment after "<!--"; "<!-->" and "<!--->" are whole comments.
_COMMENT_END = re.compile(r"--!?>")
#: An unquoted value at the end of attributes, to which a slash before ">" belongs.
_UNQUOTED = re.compile(r"""=[ \t\n\f\r]*[^ \t\n\f\r"'>][^ \t\n\f\r>]*\Z""")
_WORD = re.compile(r"[a-z]+")


@lru_cache(maxsize=50_000)
def _ancestor(tag: str, attributes: str) -> tuple[str, ...]:
    """Feature names of an element: its tag and the words of its class, id and role."""
    words = {w for m in _NAMES.finditer(attributes) for w in _WORD.findall((m[2] or m[3] or m[4] or "").lower())}
    return (f"tag {tag}", *sorted(f"name {w}" for w in words))


def blocks(page: str) -> list[tuple[str, int, tuple[tuple[str, ...], ...]]]:
    """(text, characters in links, ancestors) of each leaf block with text, in page order.

    White space is one blank, character references are decoded. Comments, scripts, styles and other
    elements without readable text are skipped. Broken markup is read as browsers do: an unfinished tag,
    comment or script reaches to the end of the page, an open <svg> to the next tag that can't be in it.
    """
    out: list[tuple[str, int, tuple[tuple[str, ...], ...]]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, in_link, silent = 0, 0, 0

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((text, linked, tuple(a for _, a in stack)))
            parts.clear()
        linked = 0

    def pop_to(depth: int) -> None:
        nonlocal silent
        close()
        while len(stack) > depth:
            silent -= stack.pop()[0] in NO_TEXT

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not silent:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if in_link:
                linked += len(text)

    at, size = 0, len(page)
    while at < size:
        tag = page.find("<", at)
        if tag < 0:
            add(page[at:])
            break
        add(page[at:tag])
        if page.startswith("<!--", tag):
            if page.startswith((">", "->"), tag + 4):
                at = page.index(">", tag + 4) + 1
                continue
            end = _COMMENT_END.search(page, tag + 4)
            if not end:
                break
            at = end.end()
            continue
        named = _TAG_NAME.match(page, tag)
        if not named:
            if page[tag + 1 : tag + 2] in ("!", "?", "/"):
                end = page.find(">", tag)
                if end < 0:
                    break
                at = end + 1
            else:
                add("<")
                at = tag + 1
            continue
        found = _TAG_END.match(page, named.end())
        if not found:
            break
        at, name, ends = found.end(), named[1].lower(), page[tag + 1] == "/"
        if not ends and name in BREAKS_OUT and silent:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in HTML_INSIDE:
                    break
                if stack[depth][0] == "svg":
                    pop_to(depth)
                    break
        if name in RAW_TEXT and not ends:
            end = re.compile(f"</{name}(?=[\\s/>])", re.I).search(page, at)
            if not end:
                break
            over = page.find(">", end.end())
            at = size if over < 0 else over + 1
            if name not in ("title", "iframe"):
                parts.append(" ")
            continue
        if name == "br":
            parts.append(" ")
        elif name == "a":
            in_link = 0 if ends else 1
        if name in INLINE:
            continue
        if ends:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    pop_to(depth)
                    break
            else:
                close()
            continue
        close()
        closers = ENDS_ITSELF.get(name, ())
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] == "p" or stack[depth][0] in closers:
                pop_to(depth)
            else:
                break
        attributes = page[named.end() : found.end() - 1]
        if name == "svg" and attributes.endswith("/") and not _UNQUOTED.search(attributes):
            continue
        if name not in VOID:
            stack.append((name, _ancestor(name, attributes)))
            silent += name in NO_TEXT
            in_link = 0
    close()
    return out


@lru_cache(maxsize=200_000)
def _number(name: str) -> int:
    return zlib.crc32(name.encode()) % WIDTH


@lru_cache(maxsize=100_000)
def _of_ancestors(ancestors: tuple[tuple[str, ...], ...]) -> tuple[int, ...]:
    names = {f"in {n}" for a in ancestors for n in a}
    names |= {f"parent {n}" for n in (ancestors[-1] if ancestors else ())}
    return tuple(sorted({_number(n) for n in names}))


def block_features(page_blocks: Sequence[tuple[str, int, tuple[tuple[str, ...], ...]]]) -> list[tuple[int, ...]]:
    out = []
    for text, linked, ancestors in page_blocks:
        size = len(text)
        look = (
            f"length {min(size.bit_length(), 12)}", f"links {min(4 * linked // max(size, 1), 4)}",
            f"stop {text[-1] in '.!?…' or text[-2:-1] in ('.', '!', '?')}", f"capital {text[:1].isupper()}", f"copyright {'©' in text[:40]}",
            f"commas {min(text.count(','), 3)}", f"words {min(text.count(' ') + 1, 6)}")
        out.append((*_of_ancestors(ancestors), *(_number(n) for n in look)))
    return out


def sparse(features: Sequence[tuple[int, ...]]) -> SparseRows:
    sizes = np.array([len(f) for f in features], np.int64)
    column = np.fromiter((x for f in features for x in f), np.int64, int(sizes.sum()))
    return SparseRows(np.repeat(np.arange(len(features)), sizes), column, len(features), WIDTH)


# Class and id names that pages commonly use for each role.
ROLE_NAMES = {
    "main": ("content", "post", "entry", "article", "story", "body", "text", "page", "main", "prose"),
    "menu": ("nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "tabs", "links", "topbar", "toc", "pagination", "pager", "skip"),
    "header": ("header", "masthead", "site", "logo", "brand", "top", "branding", "tagline"),
    "sidebar": ("sidebar", "side", "related", "widget", "recommended", "popular", "more", "trending", "rail", "secondary", "tags", "share", "social"),
    "notice": ("cookie", "cookies", "notice", "consent", "gdpr", "alert", "newsletter", "popup", "modal", "subscribe", "paywall", "message", "overlay", "warning", "signup", "privacy"),
    "advert": ("ad", "ads", "advert", "advertisement", "banner", "sponsor", "sponsored", "promo", "promoted", "promotion", "adsense"),
    "form": ("form", "search", "login", "signin", "contact", "feedback", "register"),
    "comments": ("comments", "comment", "discussion", "replies", "reply", "responses", "commentlist", "disqus", "thread", "respond"),
    "footer": ("footer", "copyright", "legal", "foot", "bottom", "colophon", "imprint", "credits"),
}
ROLE_TAGS = {"main": "article main section div", "menu": "nav ul div", "header": "header div", "sidebar": "aside div section", "notice": "div section aside dialog",
             "advert": "div aside section", "form": "form", "comments": "section div ol", "footer": "footer div"}


class _Layout:
    """Writes a page with blocks of known role; ``labels`` has 1 for each block of main text, in order."""

    def __init__(self, rng: random.Random, texts: Sequence[str]):
        self.rng, self.texts, self.labels = rng, texts, []

    def words(self, low: int, high: int) -> str:
        text = self.rng.choice(self.texts).split()
        at = self.rng.randrange(max(len(text) - high, 1))
        return html.escape(" ".join(text[at : at + self.rng.randint(low, high)]) or "a", quote=False)

    def block(self, tag: str, text: str, main: int) -> str:
        self.labels.append(main)
        return f"<{tag}>{text}</{tag}>"

    def opened(self, role: str, strong: bool = False) -> tuple[str, str]:
        """Start and end tag of a container that its tag or its names tell apart."""
        tags = ROLE_TAGS[role].split()
        tag = self.rng.choice(tags)
        plain = tag in ("div", "section", "ul", "ol", "aside")
        names = self.rng.sample(ROLE_NAMES[role], self.rng.choice([1, 1, 2])) if plain or strong or self.rng.random() < 0.4 else []
        sign = self.rng.choice(["class", "class", "id"])
        return f"<{tag}" + (f' {sign}="{self.rng.choice(["-", " ", "_"]).join(names)}"' if names else "") + ">", f"</{tag}>"

    def menu(self) -> str:
        start, end = self.opened("menu")
        item = "li" if start.startswith("<ul") else self.rng.choice(["li", "div"])
        items = "".join(self.block(item, f'<a href="/x">{self.words(1, 3)}</a>', 0) for _ in range(self.rng.randint(2, 7)))
        return f"{start}{'<ul>' + items + '</ul>' if item == 'li' and not start.startswith('<ul') else items}{end}"

    def other(self, role: str) -> str:
        if role == "menu":
            return self.menu()
        start, end = self.opened(role)
        rng, inner = self.rng, ""
        for _ in range(rng.randint(1, 3)):
            kind = rng.randrange(5)
            if role == "comments":
                inner += f'<{"li" if start.startswith("<ol") else "div"} class="{rng.choice(ROLE_NAMES["comments"])}">'
                inner += "".join(self.block(rng.choice(["p", "p", "div", "h4"]), self.words(1, 60), 0) for _ in range(rng.randint(1, 3)))
                inner += "</li>" if start.startswith("<ol") else "</div>"
            elif role == "form":
                inner += self.block("p", f"<label>{self.words(1, 8)}</label><input name=q>", 0) + "<button>Go</button>"
            elif role == "footer":
                inner += self.block(rng.choice(["p", "div", "span" if kind == 9 else "p"]), f"&copy; {self.words(1, 12)}", 0)
            elif kind == 0 and role in ("sidebar", "header", "advert"):
                inner += self.block("div", f'<a href="/y">{self.words(2, 12)}</a>', 0)
            else:
                inner += self.block(rng.choice(["p", "div", "h3", "p"]), self.words(2, 40), 0)
        if role in ("footer", "advert", "notice") and rng.random() < 0.4:  # text right in the container
            self.labels.append(0)
            inner = f"{'&copy; ' if role == 'footer' else ''}{self.words(3, 25)}{inner}"
        return f"{start}{inner}{end}"

    def article(self) -> str:
        rng = self.rng
        start, end = self.opened("main")
        if rng.random() < 0.3:
            inside, out = self.opened("main", strong=True)
            start, end = start + inside, out + end
        body = self.block(rng.choice(["h1", "h1", "h2"]), self.words(2, 14), 1) if rng.random() < 0.8 else ""
        for _ in range(rng.randint(2, 12)):
            kind = rng.random()
            if kind < 0.7:
                body += self.block("p", self.words(1, 120), 1)
            elif kind < 0.78:
                body += self.block(rng.choice(["h2", "h3"]), self.words(1, 8), 1)
            elif kind < 0.84:
                body += "<ul>" + "".join(self.block("li", self.words(1, 20), 1) for _ in range(rng.randint(1, 4))) + "</ul>"
            elif kind < 0.88:
                body += "<blockquote>" + self.block("p", self.words(5, 40), 1) + "</blockquote>"
            elif kind < 0.91:
                body += "<table><tr>" + "".join(self.block("td", self.words(1, 6), 1) for _ in range(3)) + "</tr></table>"
            elif kind < 0.94:
                body += self.block(rng.choice(["pre", "figcaption", "dd", "div"]), self.words(1, 30), 1)
            else:
                body += self.other(rng.choice(["advert", "sidebar", "form", "menu", "notice"]))
        if rng.random() < 0.2:
            body += self.other("comments")
        return start + body + end

    def page(self) -> str:
        rng = self.rng
        parts = [self.other(r) for r in ("notice", "header", "menu", "advert") if rng.random() < 0.55]
        parts.append(self.article())
        parts += [self.other(r) for r in ("comments", "sidebar", "form", "notice", "advert", "menu", "footer") if rng.random() < 0.45]
        inner = "".join(parts)
        if rng.random() < 0.5:
            wrap = rng.choice(['<div class="wrapper">', '<div id="page">', "<div>", '<div class="container">'])
            inner = f"{wrap}{inner}</div>"
        return f"<html><head><title>{self.words(1, 5)}</title></head><body>{inner}</body></html>"


def labelled_pages(texts: Sequence[str], count: int, seed: int = 9) -> list[tuple[str, list[int]]]:
    """Pages in random layouts with the label of each of their blocks."""
    rng, out = random.Random(seed), []
    for _ in range(count):
        layout = _Layout(rng, texts)
        page = layout.page()
        out.append((page, layout.labels))
    return out


def fit_extractor(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, count: int = LABELLED_PAGES, text: str = "html") -> Chain:
    """A field trained on labelled pages made of texts of ``sample_pages`` of the given pages.

    They are those with the smallest hashes among pages of at most ``SAMPLE_CHARS`` characters, whatever
    the order or partitions of ``pages``.
    """
    total = pages.count()
    share = min(1.0, 2 * sample_pages / max(total, 1))
    rows = pages.select(F.col(text).alias("html")).filter(F.length("html") <= SAMPLE_CHARS).withColumn("h", F.xxhash64("html"))
    few = rows.filter(F.pmod("h", F.lit(1 << 40)) < share * (1 << 40)).distinct().orderBy("h", "html").limit(sample_pages)
    sample = [(r.h, r.html) for r in few.collect()]
    texts = [t for _, page in sample for t, _, _ in blocks(page) if len(t) > 40] or ["some plain words to fill a page with, and a few more."]
    features, label, sizes = [], [], []
    for page, labels in labelled_pages(texts, count):
        found = blocks(page)
        if len(found) == len(labels) and found:
            features += block_features(found)
            label += labels
            sizes.append(len(labels))
    return fit_chain(sparse(features), np.concatenate([[0], np.cumsum(sizes)]), np.array(label), penalty=PENALTY, steps=50)


def main_texts(pages: Sequence[str], chain: Chain) -> list[list[str]]:
    """Blocks of main text of each page."""
    found = [blocks(p) for p in pages]
    features = [f for b in found for f in block_features(b)]
    bounds = np.concatenate([[0], np.cumsum([len(b) for b in found])]).astype(np.int64)
    if not features:
        return [[] for _ in pages]
    label = viterbi(chain.emissions(sparse(features)), bounds, chain.moves)
    return [[t for (t, _, _), k in zip(b, label[lo:hi]) if k] for b, lo, hi in zip(found, bounds[:-1], bounds[1:])]


def extract_rows(chain: Chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, _ in pieces(batch, "html"):
                texts = ["\n\n".join(t) for t in main_texts([h or "" for h in part.column("html").to_pylist()], chain)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return run


def extract_text(pages: DataFrame, chain: Chain, page_id: str = "page_id", url: str = "url", text: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points).

    Blocks of main text in page order, joined by two line feeds; a null or empty page, or one without
    main text, gives an empty text. Broken markup is read as ``blocks`` says. A very long page is read whole,
    by one task. Ids and urls, null or repeated, are passed on. An empty table gives no rows. Extra columns
    are ignored.
    """
    bounded_batches(pages.sparkSession)
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(text).alias("html"))
    return rows.mapInArrow(extract_rows(chain), "page_id long, url string, text string, n_chars long")


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return extract_text(pages, fit_extractor(pages))
