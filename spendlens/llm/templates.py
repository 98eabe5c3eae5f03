"""Main text of web pages by equivalence-class template deduction.

Pages of one host are made from a template.  A page is read as a row of tokens:
tags, told apart by their path from the root (names, classes and ids), and whole
text nodes, told apart by path and words.  Tokens that occur equally often on
every page of a host (the same *occurrence vector*) form an equivalence class.  A
class is valid if its tokens come in one order, over and over, on every page,
and if its occurrences nest: all in the same slot of another valid class, none
across it.  The valid classes, nested, are the host's template; what stands in
its slots and is no token of it is the page's own data, and is extracted.

An occurrence vector is not collected: a token's vector is the sum, over the
pages that hold it, of a 64-bit hash of (page, count), kept as two sums of
halves, so that the vectors of a host with a third of all pages add up in
partial sums like those of any other.

Of the slots' data, what stands in menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles or reader comments is left out, by element or by
class, id or role, and where a page has an ``article`` (or else a ``main``) what
is outside it.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import materialise

#: Hosts with fewer pages share one template.
PAGES = 3
#: Share of a host's pages on which a class stands, at least; for text nodes, and the
#: fewest pages on which the same words can be seen to be the template's.
SUPPORT, TEXT_SUPPORT, TEXT_PAGES = 0.5, 0.9, 5

# Elements of HTML by what they hold.
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn",
           "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s",
           "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
_OUT = {"head", "script", "style", "title", "noscript", "template", "iframe", "svg", "object",
        "canvas", "audio", "video", "nav", "menu", "header", "footer", "aside", "form", "button",
        "select", "textarea", "dialog", "xmp", "noframes"}
#: These do not hide an article that stands in them (a form round a page, an open menu).
_ROUND = {"head", "title", "nav", "header", "form"}
_HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: A start tag of these ends an open element of the given ones.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
         "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_CLOSES_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer",
             "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p",
             "pre", "section", "table", "ul"}
#: Words of classes, ids and roles of what is no part of an article.
_OUT_WORDS = {"ad", "adbox", "ads", "advert", "advertisement", "adverts", "aside", "banner",
              "breadcrumb", "breadcrumbs", "comment", "comments", "complementary", "consent",
              "contentinfo", "cookie", "cookies", "disqus", "footer", "form", "header", "login",
              "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
              "notification", "pagination", "pager", "popup", "promo", "related", "search", "share",
              "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe",
              "toolbar", "topbar", "widget"}

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(?:[!?]|/(?![a-zA-Z]))[^>]*+(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<more>(?:\"[^\"]*+\"|'[^']*+'|[^\"'>]++|[\"'])*?)(?:>|\Z)",
    re.S)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    """An open element: its name, the digest of its path, and what holds in it."""
    __slots__ = ("name", "path", "out", "article", "main", "heading")

    def __init__(self, name: str, path: int, out: str, article: bool, main: bool, heading: bool):
        self.name, self.path, self.out = name, path, out
        self.article, self.main, self.heading = article, main, heading


def _digest(path: int, what: str) -> int:
    return xxhash.xxh64_intdigest(f"{path:x}{what}".encode("utf-8", "surrogatepass"))


def read(page: str) -> tuple[list[int], list[tuple]]:
    """A page's tokens, and its text nodes: (token, text, block number, whether it stands in
    nothing that is left out, in an article, in a main element).  Linear in the page; the
    tokens' digests follow their paths, so deep nesting costs no more."""
    tokens: list[int] = []
    texts: list[tuple] = []
    stack = [Node("", 0, "", False, False, False)]
    block, at, open_names = count(1), 0, Counter()
    now = 0

    def text(raw: str) -> None:
        words = " ".join(entities.unescape(raw).split())
        top = stack[-1]
        if words:
            token = _digest(top.path, "#" + words)
            tokens.append(token)
            kept = not top.out or top.out == "header" and top.article and top.heading
            texts.append((token, entities.unescape(raw), now, kept, top.article, top.main))
        elif raw and texts:  # white space between inline elements
            texts.append((0, " ", now, not top.out, top.article, top.main))

    def pop(names: set) -> None:
        while len(stack) > 1:
            gone = stack.pop()
            open_names[gone.name] -= 1
            if gone.name in names:
                break

    end = len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at:m.start()])
        at = max(m.end(), m.start() + 1)
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name not in _INLINE:
            now = next(block)
        if m["close"]:
            if open_names[name] > 0:
                tokens.append(_digest(stack[-1].path if stack[-1].name == name else 0, "/" + name))
                pop({name})
            continue
        if name in _CLOSES_P and open_names["p"] > 0 and any(
                s.name == "p" for s in stack[-8:]):
            while stack[-1].name != "p" and stack[-1].name in _INLINE:
                open_names[stack.pop().name] -= 1
            if stack[-1].name == "p":
                open_names[stack.pop().name] -= 1
        elif name in _ENDS and stack[-1].name in _ENDS[name]:
            open_names[stack.pop().name] -= 1
            if name == "tr" and stack[-1].name == "tr":
                open_names[stack.pop().name] -= 1
        marks = " ".join(sorted(f"{k.lower()}={a or b or c}" for k, a, b, c in
                                _ATTRIBUTE.findall(m["more"]))) if "=" in m["more"] else ""
        parent = stack[-1]
        path = _digest(parent.path, f"<{name} {marks}")
        tokens.append(path)
        if name in _VOID:
            continue
        if name in _RAW:
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])|\Z", re.I).search(page, at).start()
            at = stop
        out = parent.out
        if name in ("article", "main") and out in _ROUND:
            out = ""
        if not out and name not in ("html", "body", "article", "main"):
            found = {w.lower() for w in _WORDS.findall(marks.partition("=")[2])} if marks else set()
            out = name if name in _OUT else "marked" if found & _OUT_WORDS else ""
        stack.append(Node(name, path, out, parent.article or name == "article" and not out,
                          parent.main or name == "main" and not out,
                          parent.heading or name in _HEADING))
        open_names[name] += 1
    return tokens, texts


def text_of(texts: list[tuple], template: set) -> str:
    """The main text: of the text nodes outside the template, those in articles, else those
    in ``main``, else all; each block's white space made one space, blocks joined by one."""
    main = [t for t in texts if t[3]]
    for place in (4, 5):
        inside = [t for t in main if t[place]]
        if any(t[0] for t in inside):
            main = inside
            break
    own = [t for t in main if t[0] not in template]
    size = sum(len(t[1]) for t in main)
    # where most of the text is the template's, the pages are copies of one another
    if sum(len(t[1]) for t in own) * 2 >= size:
        main = own
    blocks: dict[int, list[str]] = {}
    for t in main:
        blocks.setdefault(t[2], []).append(t[1])
    lines = (" ".join("".join(b).split()) for b in blocks.values())
    return " ".join(x for x in lines if x)


def host_of(url: Column) -> Column:
    """Lower-cased host of a url, '' without one."""
    return F.lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def skeletons(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``(host, page, tokens)`` per row: a digest of the page and its tokens in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page, tokens = [], []
            for name, html in zip(batch.column("name").to_pylist(), batch.column("html").to_pylist()):
                html = html or ""
                page.append(xxhash.xxh64_intdigest((name + html).encode("utf-8", "surrogatepass"))
                            - (1 << 63))
                tokens.append(np.array(read(html)[0], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), pa.array(page, pa.int64()), pa.array(tokens, pa.list_(pa.int64()))],
                names=["host", "page", "tokens"])

    name = F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                       F.coalesce(F.col(url_col), F.lit("")))
    return (pages.select(host_of(F.col(url_col)).alias("host"), name.alias("name"),
                         F.col(html_col).alias("html"))
            .mapInArrow(run, "host string, page bigint, tokens array<bigint>"))


def occurrence_vectors(skeleton: DataFrame) -> DataFrame:
    """``(site, token, pages, low, high)``: on how many pages of the site a token stands, and
    its occurrence vector as two sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sites, tokens = [], []
            low, high = [], []
            for site, page, own in zip(batch.column("site").to_pylist(), batch.column("page").to_pylist(),
                                       batch.column("tokens").to_pylist()):
                for token, n in Counter(own).items():
                    h = xxhash.xxh64_intdigest(f"{page} {n}")
                    sites.append(site)
                    tokens.append(token)
                    low.append(h & 0xFFFFFFFF)
                    high.append(h >> 32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sites, pa.string()), *(pa.array(x, pa.int64()) for x in (tokens, low, high))],
                names=["site", "token", "low", "high"])

    return (skeleton.mapInArrow(run, "site string, token bigint, low bigint, high bigint")
            .groupBy("site", "token").agg(F.count("*").alias("pages"), F.sum("low").alias("low"),
                                          F.sum("high").alias("high")))


def _nested(order: list[tuple[int, int]], sizes: dict[int, int]) -> dict[int, tuple] | None:
    """Where the classes stand on a page whose tokens are (class, place in its period): the
    (class, slot) in which all occurrences of a class lie, or None if classes cross or a
    class lies in several."""
    stack: list[list[int]] = []
    home: dict[int, tuple] = {}
    for c, place in order:
        if place == 0:
            at = tuple(stack[-1]) if stack else (-1, 0)
            if home.setdefault(c, at) != at:
                return None
            stack.append([c, 0])
        elif not stack or stack[-1] != [c, place - 1]:
            return None
        else:
            stack[-1][1] = place
        if place == sizes[c] - 1:
            stack.pop()
    return home


def judge_classes(tokens: list[int], class_of: dict[int, int], rank: dict[int, int]) -> dict[int, tuple]:
    """For each class on a page: (digest of its tokens' order, 0 if they do not repeat in one
    order; digest of its place among the classes before it in ``rank``, 0 if it crosses them)."""
    own: dict[int, list[int]] = {}
    for i, t in enumerate(tokens):
        if t in class_of:
            own.setdefault(class_of[t], []).append(i)
    out, sizes, marked = {}, {}, []
    for c in sorted(own, key=rank.__getitem__):
        seen = [tokens[i] for i in own[c]]
        size = len(set(seen))
        if seen != seen[:size] * (len(seen) // size):
            out[c] = (0, 0)
            continue
        order = xxhash.xxh64_intdigest(repr(seen[:size])) >> 1
        sizes[c] = size
        tried = sorted(marked + [(i, c, j % size) for j, i in enumerate(own[c])])
        home = _nested([x[1:] for x in tried], sizes)
        if home is None:
            out[c] = (order, 0)
            continue
        marked = tried
        out[c] = (order, 1)
    return out


def deduce_templates(skeleton: DataFrame, sites: DataFrame) -> DataFrame:
    """``(site, class, tokens, pages)``: the valid equivalence classes of each site.

    ``skeleton``: (site, page, tokens); ``sites``: (site, n) its pages.  A class is kept
    for a site if it is in order and nested on every page that holds it."""
    large = (occurrence_vectors(skeleton).join(sites, "site")
             .where((F.col("pages") >= 2) & (F.col("pages") >= F.col("n") * SUPPORT)))
    # a site's frequent tokens are at most 1 / SUPPORT times those of a page in the mean
    classes = materialise(
        large.withColumn("class", F.xxhash64("pages", "low", "high"))
        .groupBy("site", "n", "class").agg(F.collect_list("token").alias("tokens"),
                                           F.first("pages").alias("pages")), "template-classes")
    sets = classes.groupBy("site").agg(F.collect_list(F.struct("class", "pages", "tokens")).alias("classes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            out: Counter = Counter()
            sites_, given = batch.column("site").to_pylist(), batch.column("classes")
            for i, (site, tokens) in enumerate(zip(sites_, batch.column("tokens").to_pylist())):
                if site not in known:
                    known.clear()  # pages of a site come together, as a rule
                    rows = given[i].as_py()
                    first = sorted(rows, key=lambda r: (-r["pages"], -len(r["tokens"]), r["class"]))
                    known[site] = ({t: r["class"] for r in rows for t in r["tokens"]},
                                   {r["class"]: k for k, r in enumerate(first)})
                for c, (order, nested) in judge_classes(tokens, *known[site]).items():
                    out[site, c, order, nested] += 1
            keys = list(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[j] for k in keys], kind) for j, kind in
                 enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                names=["site", "class", "order", "nested"])

    verdicts = (skeleton.join(sets, "site").select("site", "tokens", "classes")
                .mapInArrow(run, "site string, class bigint, order bigint, nested bigint")
                .groupBy("site", "class").agg(F.min("order").alias("a"), F.max("order").alias("b"),
                                              F.min("nested").alias("nested")))
    valid = verdicts.where("a = b and a != 0 and nested = 1").select("site", "class")
    return classes.join(valid, ["site", "class"]).select("site", "class", "tokens", "pages", "n")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` per input row: the main text ('' if none) and its
    code points.

    A null or empty html has the text ''; a null url, or one without a host, makes a page
    one of the host ''.  Hosts of fewer than ``PAGES`` pages share a template.  Repeated
    rows and null ids stay, other columns are not looked at, an empty table stays empty;
    pages are read whole.
    """
    skeleton = materialise(skeletons(pages, id_col, url_col, html_col), "template-skeleton")
    sizes = skeleton.groupBy("host").agg(F.count("*").alias("n"))
    hosts = materialise(sizes.select("host", "n", F.when(F.col("n") >= PAGES, F.col("host"))
                                     .otherwise("").alias("site")), "template-hosts")
    sites = hosts.groupBy("site").agg(F.sum("n").alias("n"))
    placed = skeleton.join(hosts.select("host", "site"), "host").select("site", "page", "tokens")
    # text nodes can only be the template's where most pages of a larger site hold them
    firm = deduce_templates(placed, sites).where(
        (F.col("pages") >= TEXT_PAGES) & (F.col("pages") >= F.col("n") * TEXT_SUPPORT))
    templates = firm.groupBy("site").agg(F.flatten(F.collect_list("tokens")).alias("template"))
    by_host = materialise(hosts.join(templates, "site").select("host", "template"), "template-hosts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            out = []
            given = batch.column("template")
            for i, (host, html) in enumerate(zip(batch.column("host").to_pylist(),
                                                 batch.column("html").to_pylist())):
                if host not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[host] = set(np.array(given[i].as_py() or [], np.int64).view(np.uint64).tolist())
                out.append(text_of(read(html or "")[1], known[host]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()),
                 pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"),
                        host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    return (rows.join(by_host, "host", "left").select("page_id", "url", "host", "html", "template")
            .mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint"))
