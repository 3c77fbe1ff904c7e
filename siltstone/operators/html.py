"""HTML pages to records: search cards, page metadata, media, child links, validity.

Pages are parsed in Arrow batches by the standard library's tokenizer into a small tree whose elements
are numbered in document order and listed by tag, class, id and attribute, so that a selector looks at
the elements that can fit and no others. One struct for each page is made, so that a page is parsed once
whatever is selected from it; where only links are asked for, no tree is made.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from itertools import takewhile
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from siltstone.functions.urls import split_resolved
from siltstone.sources import files

# Elements without content; the site's class names; titles of refusals and of listing sections.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = ("script", "style", "template")
TEASER, MEDIA_TYPES = "node--view-mode-teaser", ("audio/mp3", "audio/mpeg")
CARDS = ".node--view-mode-teaser.node--type-page-media, .node--view-mode-teaser.node--type-collection, .node--view-mode-teaser.node--type-dossier"
UNREAD = CARDS + ", .wrapper-content h3 a, iframe, [data-drupal-views-infinite-scroll-content-wrapper]"
SECTIONS, SECTION_TITLES = "#videos, #collections, #dossiers", ("vidéos", "videos", "collections", "dossiers", "podcasts")
NEXT_LINKS = '.pager__item--next a[href], a[rel~="next"]'
#: Pages whose records are made together.
GROUP = 64
CHALLENGE_IMAGE = "/sites/default/files/bot_challenge.png"
REFUSAL = re.compile(r"403 forbidden|access denied|service unavailable|challenge\.*|just a moment\.*", re.IGNORECASE)
FIELDS = {
    "desc": ".field--name-field-description",
    "lieu": ".field--name-field-lieu .field__item",
    "cdt": ".field-condition-utilisation .field__item",
    "citation": ".field-citation-ressource .field__item",
    "doi": ".id-doi-datacite .field__items",
}


class Node:
    """An element. ``no`` is its place in document order, ``end`` that of its last descendant; ``index`` lists a tree's elements by key."""

    __slots__ = ("attrs", "children", "classes", "end", "index", "name", "no", "parent")

    def __init__(self, name: str, attrs: dict, parent: Node | None, no: int = 0, index: dict | None = None):
        self.name, self.attrs, self.parent, self.children, self.no, self.end, self.index = name, attrs, parent, [], no, no, index
        self.classes = attrs.get("class", "").split()

    def text(self) -> str:
        """Each text stripped, blank ones left out, joined by one space."""
        out, stack = [], [self]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                if x.strip():
                    out.append(x.strip())
            elif x.name not in HIDDEN or x is self:
                stack += reversed(x.children)
        return " ".join(out)

    def above(self):
        node = self.parent
        while node is not None:
            yield node
            node = node.parent

    def select(self, selector: str) -> list[Node]:
        """Elements below that fit, in document order."""
        found = {n.no: n for key, group in compiled(selector) for n in self.index.get(key, ()) if self.no < n.no <= self.end and _matches(n, group)}
        return [found[no] for no in sorted(found)]

    def first(self, selector: str) -> Node | None:
        firsts = (next((n for n in self.index.get(key, ()) if self.no < n.no <= self.end and _matches(n, group)), None) for key, group in compiled(selector))
        return min((n for n in firsts if n), key=lambda n: n.no, default=None)


_STEP = re.compile(r'([\w-]+)?((?:\.[\w-]+|#[\w-]+|\[[^\]]+\])*)$')
_WORD = re.compile(r'(?:\[[^\]]*\]|[^\s\[])+')
_PART = re.compile(r'\.([\w-]+)|#([\w-]+)|\[([\w-]+)(?:([*~]?=)"?([^"\]]*)"?)?\]')
_compiled: dict[str, list] = {}


def compiled(selector: str) -> list:
    """Groups of steps (tag, tests), from the outermost ancestor to the element; before each, a key that the element has in the index."""
    if selector not in _compiled:
        groups = []
        for group in selector.split(","):
            steps = []
            for word in _WORD.findall(group):
                tag, rest = _STEP.match(word).groups()
                steps.append((tag, _PART.findall(rest)))
            tag, tests = steps[-1]
            keys = [f"#{ident}" if ident else f".{cls}" if cls else f"[{attr}" for cls, ident, attr, _, _ in tests]
            groups.append((min([*keys, *([tag] if tag else [])], key=lambda k: "#.[".find(k[0]) % 4), steps))
        _compiled[selector] = groups
    return _compiled[selector]


def _fits(node: Node, step: tuple) -> bool:
    tag, tests = step
    if tag and node.name != tag:
        return False
    for cls, ident, attr, op, value in tests:
        if cls and cls not in node.classes or ident and node.attrs.get("id") != ident:
            return False
        if attr:
            have = node.attrs.get(attr)
            if have is None or op == "=" and have != value or op == "*=" and value not in have or op == "~=" and value not in have.split():
                return False
    return True


def _matches(node: Node, steps: list) -> bool:
    if not _fits(node, steps[-1]):
        return False
    left = len(steps) - 2
    for up in node.above():
        if left < 0:
            break
        if _fits(up, steps[left]):
            left -= 1
    return left < 0


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.index: dict[str, list[Node]] = {}
        self.root = self.at = Node("", {}, None, 0, self.index)
        self.all = [self.root]

    def handle_starttag(self, tag, attrs):
        seen: dict[str, str] = {}
        for k, v in attrs:
            seen[k] = v or ""
        node = Node(tag, seen, self.at, len(self.all), self.index)
        self.all.append(node)
        keys = {tag, *(f".{c}" for c in node.classes), *(f"[{k}" for k in seen)} | ({f"#{seen['id']}"} if "id" in seen else set())
        for key in keys:
            self.index.setdefault(key, []).append(node)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None:
            if node.name == tag:
                self.at = node.parent
                return
            node = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    for node in reversed(builder.all[1:]):
        node.parent.end = max(node.parent.end, node.end)
    return builder.root


def drop(root: Node) -> None:
    """Unties a tree that is done with: its elements name each other, so that else it would stay until garbage is collected."""
    for nodes in list(root.index.values()):
        for node in nodes:
            node.parent = node.index = None
            node.children = []
    root.index.clear()
    root.children = []


def _in_card(node: Node) -> bool:
    return any(TEASER in up.classes for up in node.above())


def _own(root: Node, selector: str):
    return (n for n in root.select(selector) if not _in_card(n))


def search_items(html: str | None, url: str | None) -> list[dict]:
    """Cards of a search page; of a repeated url the first place and the last label count."""
    tree, url = parse(html), url or ""
    root = tree.first(".search-results") or tree.first("main") or tree
    items: dict[str, str] = {}
    for box in root.select(".wrapper-content"):
        link = box.first("h3 a[href]")
        if link is None or not link.attrs["href"].strip():
            continue
        card = next((up for up in box.above() if up.name == "article"), None)
        label = card and (card.first(".wrapper-bundle") or card.first(".field--name-field-type-production"))
        found = split_resolved(url, link.attrs["href"])
        if found:
            items[found[0]] = label.text().lower() if label else ""
    drop(tree)
    return [{"pos": i, "url": u, "type_": t} for i, (u, t) in enumerate(items.items())]


def _problem(tree: Node, html: str) -> tuple[str | None, Node | None]:
    """Why a page is no whole document, or its content's root."""
    heads = [n for n in (tree.first("h1"), tree.first("title")) if n]
    if tree.first('img[src*="bot_challenge.png"]') or any(REFUSAL.fullmatch(n.text()) for n in heads):
        return "refused", None
    if tree.first("h1") is None:
        return "no title", None
    root = tree.first(".node--view-mode-full") or tree.first(".taxonomy-term") or tree.first('main, [role="main"]')
    if root is None:
        return "no content", None
    if tree.first("html") and not re.search(r"</html\s*>", html, re.IGNORECASE):
        return "truncated", None
    return None, root


def _regions(tree: Node, root: Node) -> list[Node]:
    """Parts that list other pages: sections of known ids, and what stands between a heading of a known title and the next heading."""
    regions = tree.select(SECTIONS)
    for heading in root.select("h2"):
        if heading.text().lower() in SECTION_TITLES:
            after = (n for n in heading.parent.children if isinstance(n, Node) and n.no > heading.no)
            regions += takewhile(lambda n: n.name != "h2", after)
    return regions


def link_table(tree: Node, root: Node, url: str) -> tuple[list[tuple[str, str, str]], int]:
    """(kind, url, label) of the links to other pages of the site, those of cards and then those to a next page of this one; and the number of cards."""
    own, rows = split_resolved(url, ""), []

    def target(link: Node | None) -> tuple | None:
        to = split_resolved(url, link.attrs["href"]) if link else None
        return to if to and own and to[2] in ("http", "https") and to[3] == own[3] and to[1] not in ("", url) else None

    regions = _regions(tree, root)
    whole = root.name == "main" or root.attrs.get("role") == "main"
    cards = [] if whole else root.select(CARDS)
    for region in regions:
        cards += region.select(".wrapper-content") + [region] * ("wrapper-content" in region.classes)
    for card in cards:
        link = card.first("h3 a[href], h2 a[href]")
        to = target(link) if link and link.attrs["href"].strip() else None
        if to:
            around = next((up for up in card.above() if TEASER in up.classes), card)
            label = around.first(".field--name-field-type-production, .wrapper-bundle")
            rows.append(("card", to[1], label.text() if label else ""))
    nexts = [target(link) for part in (root, *regions) for link in part.select(NEXT_LINKS)]
    return rows + [("next", to[1], "pagination") for to in nexts if to and to[4] == own[4]], len(cards)


def child_pages(rows: list[tuple[str, str, str]]) -> list[dict]:
    """Each linked page once, at its first place: with the label of its first card, but that of a next page if it is one."""
    labels: dict[str, str] = {}
    for kind, to, label in rows:
        if kind == "next" or to not in labels:
            labels[to] = label
    return [{"pos": i, "url": to, "type_": label} for i, (to, label) in enumerate(labels.items())]


def is_challenge(tree: Node, html: str, url: str, image: str = CHALLENGE_IMAGE) -> bool:
    """Whether a page asks, without a script, to load an image of its own https site and to come again within a minute."""
    own = split_resolved(url, "")
    again = next((n for n in tree.select("meta[http-equiv]") if n.attrs["http-equiv"].lower() == "refresh"), None)
    if "bot_challenge.png?" not in html or own is None or own[2] != "https" or again is None or tree.first("script"):
        return False
    wait = again.attrs.get("content", "").strip()
    if not re.fullmatch(r"\d+(?:\.\d+)?", wait) or float(wait) > 60:
        return False
    shown = (urlsplit(urljoin(url, n.attrs["src"])) for n in tree.select("img[src]"))
    return any((x.scheme, x.netloc, x.path) == ("https", own[3], image) and x.query for x in shown)


PAGE = (
    "struct<titre:string,desc:string,audios:array<string>,lieu:string,langues:array<string>,cdt:string,citation:string,doi:string,"
    "pages:array<struct<pos:int,url:string,type_:string>>,status:string,error_kind:string,error:string,"
    "old_selector:boolean,links:array<string>,h1:string,last_page:string,counter:string,text:string,challenge:boolean>"
)


def page_record(html: str | None, url: str | None) -> dict:
    """Everything that is read from one page; fields of an invalid page are empty and error_kind says why."""
    html, url = html or "", url or ""
    tree = parse(html)
    try:
        return _record(tree, html, url)
    finally:
        drop(tree)


def _record(tree: Node, html: str, url: str) -> dict:
    text = lambda n: n.text() if n else None
    last = tree.first(".pager__item--last a[href]")
    out = dict.fromkeys(("titre", "lieu", "cdt", "citation", "doi", "desc"), "") | {
        "audios": [], "langues": [], "pages": [], "status": None, "error_kind": None, "error": None,
        "old_selector": tree.first("article.node--view-mode-full") is not None,
        "links": [n.attrs["href"] for n in tree.select("a[href]")], "h1": text(tree.first("h1")),
        "last_page": last.attrs["href"] if last else None, "counter": text(tree.first("#global-search-results-counter")), "text": tree.text()[:1500],
        "challenge": is_challenge(tree, html, url),
    }
    why, root = _problem(tree, html)
    if why:
        return out | {"error_kind": "incomplete", "error": why}
    out |= {k: next((n.text() for n in _own(root, s)), "") for k, s in FIELDS.items()}
    out["titre"] = out["h1"]
    out["langues"] = list(dict.fromkeys(t for n in _own(root, ".wrapper-langues .wrapper-langue") if (t := n.text())))
    sources = [n for n in _own(root, "source[src][type]") if n.attrs["type"].partition(";")[0].strip().lower() in MEDIA_TYPES and n.attrs["src"].strip()]
    found = [split_resolved(url, n.attrs["src"]) for n in sources]
    out["audios"] = list(dict.fromkeys(x[0] for x in found if x))
    rows, cards = link_table(tree, root, url)
    out["pages"] = child_pages(rows)
    if out["audios"] or rows:
        out["status"] = "exploitable"
    elif cards or root.first(UNREAD):
        out |= {"error_kind": "unrecognized", "error": "cards or a player, but nothing to read"}
    else:
        out["status"] = "sans_contenu"
    return out


def parse_pages(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The pages with a struct ``page`` in place of the html."""
    return _read(pages, html_col, "page", PAGE, page_record, url_col)


def _read(pages: DataFrame, html_col: str, to: str, kind: str, read, url_col: str | None = None) -> DataFrame:
    """The pages with a column of what read makes of html and url in place of the html.

    Each page is read once, whatever is selected from it later: Spark repeats a function's call for a filter on its result, but not a
    pass over the rows. A worker holds one bounded batch of pages, and the records of a few of them, so that its memory does not grow with the table.
    """
    spark = pages.sparkSession
    files.bound_batches(spark)
    keep = [c for c in pages.columns if c != html_col]
    schema = T.StructType([*[pages.schema[c] for c in keep], T.StructField(to, T.DataType.fromDDL(kind))])
    arrow = to_arrow_type(schema[to].dataType)
    kept = [pages.columns.index(c) for c in keep]
    at, url_at = pages.columns.index(html_col), pages.columns.index(url_col) if url_col else None

    def run(batches):
        for b in batches:
            for first in range(0, b.num_rows, GROUP):
                some = b.slice(first, GROUP)
                args = [some.column(i).to_pylist() for i in (at, url_at) if i is not None]
                made = pa.array([read(*x) for x in zip(*args, strict=True)], arrow)
                yield pa.RecordBatch.from_arrays([*[some.column(i) for i in kept], made], names=[*keep, to])

    return pages.mapInArrow(run, schema)


class _Anchors(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hrefs: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            href = dict(attrs).get("href", None) if any(k == "href" for k, _ in attrs) else False
            if href is not False:
                self.hrefs.append(href or "")


def anchors(html: str | None) -> list[str]:
    """The references of a page's anchors, in order, as they are written."""
    found = _Anchors()
    found.feed(html or "")
    found.close()
    return found.hrefs


def page_links(html: str | None, url: str | None) -> dict:
    """The page's own resolved url, and every anchor's reference with the url that it resolves to (null parts if it is none)."""
    names, none = ("url", "plain", "scheme", "netloc", "path"), (None,) * 5
    parts = lambda href: dict(zip(names, (split_resolved(url, href) if url is not None else None) or none, strict=True))
    return {"base": parts(""), "links": [{"href": h} | parts(h) for h in anchors(html)]}


def parse_anchors(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The pages with hrefs, the references of their anchors, in place of the html. What they resolve to is left to ``urls.resolve``."""

    return _read(pages, html_col, "hrefs", "array<string>", anchors)


def parse_searches(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """source, pos, url, type_: the cards of search pages."""

    cards = _read(pages.select(F.col(url_col).alias("source"), F.col(html_col).alias("html")), "html", "cards", "array<struct<pos:int,url:string,type_:string>>", search_items, "source")
    return cards.select("source", F.inline("cards"))


def parse_page(parsed: DataFrame) -> DataFrame:
    """The media-only view: whether a page has audio, and its fields."""
    return parsed.select("*", (F.size("page.audios") > 0).alias("has_audio"))


def media_rows(parsed: DataFrame) -> DataFrame:
    """A row for each page and media url, with the page's metadata."""
    p = F.col("page")
    return parsed.select(
        "url", F.posexplode(p["audios"]).alias("pos", "audio_url"), F.lit("").alias("file_name"), p["titre"].alias("title"), p["desc"].alias("desc_"),
        F.array_join(p["langues"], "; ").alias("lang"), p["citation"].alias("cite"), p["cdt"].alias("license"), p["lieu"].alias("lieu"), p["doi"].alias("doi"),
    )


def outcome_rows(parsed: DataFrame, now) -> DataFrame:
    """url, status, detail, checked_at of the pages that could be read."""
    p = F.col("page")
    detail = F.concat(F.size(p["audios"]), F.lit(" audio(s), "), F.size(p["pages"]), F.lit(" lien(s)"))
    return parsed.where(p["error_kind"].isNull()).select("url", p["status"].alias("status"), detail.alias("detail"), F.lit(now).cast("double").alias("checked_at"))
