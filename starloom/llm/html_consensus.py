"""Main text of web pages by consensus of each host's pages.

Pass 1 scores every page's containers by the text they hold outside of
links and of boilerplate (menus, page headers, footers, sidebars, notices,
adverts, forms, scripts, reader comments). A container is named by its
generalised path: the tags from the root with their classes, digits
generalised. Each page gives its host one vote, shared out over its paths by
their scores; Spark adds up each path's votes and the pages that have it. Pass 2
reads every page again and takes the text of the containers on that path, among
those the page has, with the most votes for each page that has it. Pages of
one host with the same set of paths are a template; each template is offered the
votes for its own paths, all of them.

Character references are decoded once, white space inside a block becomes one
space, blocks are joined in page order by one space, tags inside a line join
without one. Headings of the article belong to it.

Null or empty html gives an empty text; a url that is null or has no host
belongs to the host of no name. Pages without any tag are text throughout.
Repeated rows count each; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, stored

#: A page's vote is dealt out in so many parts.
PARTS = 1000

_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_REST = re.compile(r"""(?:[^>"']++|"[^"]*"|'[^']*')*+>""")
_SPECIAL = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NUMBER = re.compile(r"\d+")
_WORD = re.compile(r"[a-z]+")

# Element names and the words of classes, ids and roles.
_RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
           "img", "ins", "kbd", "mark", "q", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
           "time", "tt", "u", "var", "wbr"}
_BOILERPLATE = {"nav", "footer", "aside", "form", "head", "noscript", "template", "svg", "canvas", "object", "button",
                "select", "datalist", "dialog", "menu", "fieldset", "audio", "video", "map"}
_BAD_WORD = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsbygoogle", "sponsor", "sponsored",
             "promo", "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices",
             "notification", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "sidebar",
             "sidenav", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "pagination", "pager",
             "footer", "masthead", "share", "sharing", "social", "related", "recommended", "recommendations",
             "comment", "comments", "commentlist", "disqus", "respond", "reply", "replies", "login", "signup",
             "copyright", "complementary", "contentinfo", "search", "alert", "toolbar"}
_GOOD_WORD = {"article", "articlebody", "content", "post", "entry", "story", "main", "text", "blogpost"}
#: Words that a boilerplate name may have besides ("page-footer", but not "has-sidebar").
_PLACE_WORD = {"site", "page", "top", "bottom", "left", "right", "primary", "secondary", "widget", "area", "container",
               "wrapper", "wrap", "inner", "list", "link", "links", "section", "box", "block", "bar", "button", "buttons",
               "item", "items", "icon", "icons", "global", "main", "header", "post", "posts", "form", "thread"}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
_LIST_EDGE = {"ul", "ol", "dl", "table", "select"}
_LEAF = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "pre", "tr", "td", "th", "hr", "br", "caption"}


class Tags:
    """The tags of a page, each found by going forward only: what was looked for in
    vain (a `>` that ends a tag, outside of quotes) is not looked for again."""

    def __init__(self, html: str):
        self.html, self.last, self.at, self.ends = html, html.rfind(">"), None, None

    def _end(self, p: int) -> int:
        """The end of a tag whose attributes begin at p: the first `>` outside of
        quotes, or the first one at all if there is none such."""
        if self.at is None:
            m = _REST.match(self.html, p)
            if m:
                return m.end()
            self._table()
        end = self.ends[bisect_left(self.at, p)]
        return end if end else self.html.find(">", p) + 1

    def _table(self) -> None:
        """For each `>` and quote, from the last to the first: where a tag ends that
        is outside of quotes there (0: nowhere)."""
        self.at = [m.start() for m in _SPECIAL.finditer(self.html)]
        plain, double, single = 0, 0, 0
        self.ends = [0] * (len(self.at) + 1)
        for k in range(len(self.at) - 1, -1, -1):
            c = self.html[self.at[k]]
            if c == ">":
                plain = self.at[k] + 1
            elif c == '"':
                plain, double = double, plain
            else:
                plain, single = single, plain
            self.ends[k] = plain

    def find(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, "/" of an end tag, name, attributes) of the next tag; a comment
        or declaration has no name."""
        html = self.html
        at = html.find("<", at)
        while at >= 0:
            c = html[at + 1:at + 2]
            if c == "!" or c == "?":
                for opens, closes in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<", ">")):
                    if html.startswith(opens, at):
                        end = html.find(closes, at + max(len(opens), 2))
                        return at, end + len(closes) if end >= 0 else len(html), "", "", ""
            if at < self.last and (m := _NAME.match(html, at)):
                end = self._end(m.end())
                return at, end, m[1], m[2], html[m.end():end - 1]
            at = html.find("<", at + 1)
        return None


class _Open:
    __slots__ = ("tag", "bad", "hard", "link", "path", "above", "edge", "first", "mass", "weight", "named")

    def __init__(self, tag, bad, hard, link, path, above, edge, first, mass, weight, named):
        self.tag, self.bad, self.hard, self.link, self.path, self.above, self.edge = tag, bad, hard, link, path, above, edge
        self.first, self.mass, self.weight, self.named = first, mass, weight, named


class Path:
    """A container's generalised path: its key is a hash of all labels from the root,
    so deep nesting costs no more than its labels."""

    __slots__ = ("key", "label", "above", "depth")

    def __init__(self, label: str, above: Path | None):
        self.label, self.above, self.depth = label, above, above.depth + 1 if above else 0
        self.key = blake2b(f"{above.key if above else ''}/{label}".encode("utf-8", "replace"), digest_size=16).hexdigest()

    def __str__(self) -> str:
        labels, at = [], self
        while at:
            labels.append(at.label)
            at = at.above
        return "/".join(reversed(labels))


def _named(value: str, block: bool, in_article: int) -> tuple[bool, bool]:
    """Whether the names of a class, id or role say boilerplate, and whether they say main text, which goes first."""
    bad = good = False
    for token in value.split():
        words = set(_WORD.findall(token))
        if words & _BAD_WORD:
            bad = bad or words <= _BAD_WORD | _PLACE_WORD
        elif words & _GOOD_WORD:
            good = True
        elif "header" in words and block and not in_article:
            bad = bad or words <= _PLACE_WORD
    return bad and not good, good


def read_page(html: str, spared: frozenset[int] = frozenset()) -> tuple[list[str], list[tuple[Path, float, int, int]]]:
    """The pieces of a page's text outside of boilerplate, and its containers:
    (generalised path, score, first piece, piece after the last). An element
    that is boilerplate by its name alone is none if it holds the page's only
    main or article, or most of its text: the page is read again with these
    (by the place of their tags) `spared`."""
    pieces: list[str] = []
    found: list[tuple[Path, float, int, int]] = []
    mass = lost = 0
    root = Path("", None)
    stack = [_Open("", False, False, False, root, root, 0, 0, 0, 0.5, None)]
    places: dict[str, list[int]] = {}  # by tag the places of open elements on the stack
    tags = Tags(html)
    in_article = articles = lost_articles = 0
    named: list[tuple[int, int, int]] = []

    def close(to: int) -> None:
        nonlocal in_article
        while len(stack) > to:
            e = stack.pop()
            places[e.tag].pop()
            if e.tag in ("article", "main"):
                in_article -= 1
            if e.named:
                at_tag, text, held = e.named
                named.append((at_tag, lost - text, lost_articles - held))
            if e.path is not None and not e.bad and mass > e.mass:
                found.append((e.path, (mass - e.mass) * e.weight, e.first, len(pieces)))

    at, size = 0, len(html)
    while at < size:
        m = tags.find(at)
        stop = m[0] if m else size
        top = stack[-1]
        if stop > at and not top.bad:
            text = html[at:stop]
            if "&" in text:
                text = unescape(text)
            pieces.append(text)
            if not top.link:
                mass += len(text) - text.count(" ")
        elif stop > at and not top.hard and not top.link:
            text = unescape(html[at:stop])
            lost += len(text) - text.count(" ")
        if not m:
            break
        at_tag, at, ends_one, name, attributes = m
        if not name:
            continue
        tag = name.lower()
        block = tag not in _INLINE
        if block and not top.bad:
            pieces.append(" ")
        if ends_one:
            if places.get(tag):
                close(places[tag][-1])
            if block:
                pieces.append(" ")
            continue
        if tag in _VOID:
            continue
        if block:  # end tags that may be left out
            open_ones = [places[t][-1] for t in _CLOSES.get(tag, ("p",)) if places.get(t)]
            if open_ones and max(open_ones) >= max(top.edge, 1):
                close(max(open_ones))
            top = stack[-1]
        hard, by_name, weight, label = top.hard or tag in _BOILERPLATE, False, 1.0, tag
        if tag == "header" and not in_article:
            hard = True
        if tag in ("article", "main"):
            weight, in_article = 1.5, in_article + 1
            if not hard and top.bad:
                lost_articles += 1
            elif not hard:
                articles += 1
        elif tag in ("html", "body"):
            weight = 0.5
        if attributes and not attributes.isspace() and tag not in ("html", "body"):
            for key, value in _ATTRIBUTE.findall(attributes):
                key = key.lower()
                if key == "hidden":
                    hard = True
                if key not in ("class", "id", "role", "itemprop"):
                    continue
                value = value.strip("\"'").lower()
                says_bad, says_good = _named(value, block, in_article)
                if block and says_bad and tag not in ("article", "main"):
                    by_name = True
                elif block and says_good:
                    weight = 1.5
                if key == "class" and value:
                    label += "." + ".".join(sorted(set(_NUMBER.sub("#", value).split())))
        by_name = by_name and not hard and at_tag not in spared
        bad = top.bad or hard or by_name
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(html, at)
            at = end.start() if end else size
            bad = hard = True
        if attributes.endswith("/") and tag in ("svg", "path", "use"):
            continue
        container = block and tag not in _LEAF
        path = Path(label, top.above) if container else None
        places.setdefault(tag, []).append(len(stack))
        edge = len(stack) if tag in _LIST_EDGE or container else top.edge
        stack.append(_Open(tag, bad, hard, top.link or tag == "a", path, path or top.above, edge,
                           len(pieces), mass, weight, (at_tag, lost, lost_articles) if by_name else None))
    places[""] = [0]
    close(0)
    if not spared:
        again = frozenset(tag for tag, text, held in named if held and not articles or 2 * text > mass + lost)
        if again:
            return read_page(html, again)
    return pieces, found


def _shares(found: list[tuple[Path, float, int, int]]) -> dict[str, float]:
    """Each path's score: the sum over its containers (of which none lies in
    another, as paths grow with depth)."""
    total: dict[str, float] = {}
    for path, score, _, _ in found:
        total[path.key] = total.get(path.key, 0) + score
    return total


def text_of(pieces: list[str], found: list[tuple[Path, float, int, int]], key: str) -> str:
    """The pieces of all containers of the path of this key, in page order."""
    spans = sorted((a, b) for p, _, a, b in found if p.key == key)
    return " ".join(" ".join("".join(pieces[a:b]) for a, b in spans).split())


def _template(keys) -> bytes:
    return blake2b("\n".join(sorted(keys)).encode(), digest_size=16).digest()


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total: dict[tuple[str, bytes, str], list[int]] = {}
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            shares = _shares(read_page(html or "")[1])
            whole, template = sum(shares.values()), _template(shares)
            for path, score in shares.items():
                sums = total.setdefault((host, template, path), [0, 0])
                sums[0] += round(PARTS * score / whole)
                sums[1] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.binary()),
             pa.array([k[2] for k in total], pa.string()), pa.array([v[0] for v in total.values()], pa.int64()),
             pa.array([v[1] for v in total.values()], pa.int64())], ["host", "template", "path", "votes", "pages"])


def _templates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages (html last) with their templates."""
    for batch in batches:
        keys = [_template(_shares(read_page(html or "")[1])) for html in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, "_template"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        html, paths, votes = (batch.column(k).to_pylist() for k in range(batch.num_columns - 3, batch.num_columns))
        texts, used = [], []
        for page, names, counts in zip(html, paths, votes):
            pieces, found = read_page(page or "")
            own = _shares(found)
            here = dict(zip(names or (), counts or ()))
            paths = {p.key: p for p, _, _, _ in found}
            # Of equal ones the innermost.
            key = max(here, key=lambda p: (here[p], own[p], paths[p].depth, p)) if here else None
            used.append(str(paths[key]) if key else None)
            texts.append(text_of(pieces, found, key) if key else "")
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-3], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
             pa.array(used, pa.string())], [*batch.schema.names[:-3], "text", "n_chars", "path"])


def extract(pages: DataFrame, keep: list[str]) -> DataFrame:
    """Columns `keep` of `pages` (url, html) with text, n_chars, and the path
    that the text was taken from (null where the page has no text)."""
    host = F.coalesce(F.regexp_extract(F.lower(F.col("url").cast("string")),
                                       r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/?#:]+)", 1), F.lit(""))
    pages = pages.select(*keep, host.alias("_host"), F.col("html").cast("string").alias("_html"))
    votes = stored(in_arrow(pages.select("_host", "_html"), _votes,
                            "host string, template binary, path string, votes long, pages long")
                   .groupBy("host", "template", "path").agg(F.sum("votes").alias("votes"), F.sum("pages").alias("pages")),
                   "html-votes")
    mean = votes.groupBy("host", "path").agg((F.sum("votes") / F.sum("pages")).alias("mean"))
    # A template has the paths of one page.
    offered = stored(votes.select("host", "template", "path").join(mean, ["host", "path"]).groupBy("host", "template")
                     .agg(F.collect_list(F.struct("path", "mean")).alias("p"))
                     .select(F.col("host").alias("_host"), F.col("template").alias("_template"),
                             F.col("p.path").alias("_paths"), F.col("p.mean").alias("_votes")), "html-paths")
    told = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema)
    rows = (in_arrow(pages, _templates, f"{told}, _template binary").join(offered, ["_host", "_template"], "left")
            .select(*keep, "_html", "_paths", "_votes"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-3])
    return in_arrow(rows, _extract, f"{kept}, text string, n_chars long, path string")
