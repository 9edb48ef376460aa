"""HTML extraction: site template removal.

A page is parsed to a tree of elements.  What its site repeats is found by
counting: the hash of every element subtree (tag, class, role and text of all
below) is counted per host, and a subtree that recurs on at least
``min_pages`` pages and on ``min_share`` of the host's pages is template and
deleted.  Inside the page's own article (``article`` or ``main``) the same holds,
but there different articles are counted, not pages, so copies of an article
prove nothing; only whole blocks are counted (no headings, list items, table
cells or words inside a line, which recur without being template), and an
article that would be left empty stays whole.

Besides, elements whose tag, role or class name says that they are no text of
the article are dropped (navigation, headers and footers of the page, asides,
forms, scripts, adverts, notices, reader comments).  If the page marks its
article, only that is taken, unless more text is left outside it than inside: then
the mark is on a teaser and the whole page is taken.

Text: character references are decoded, white space inside a block becomes
one space, blocks are trimmed and joined by an empty line.

Scale: subtree hashes are distinct per page and counted with map-side
combine (those inside articles once per article, dealt by host, hash and article), so a host that holds a third of all pages is no hot group; a host's
list holds at most (subtrees of a page / ``min_share``) hashes.  The lists are
staged, so Spark knows their size and broadcasts them only if they are small;
else pages join them by host, and AQE splits a hot host's pages.

Defined cases: NULL or empty HTML has the empty text; a page without a host
(NULL or odd url) belongs to the host ''; unclosed, stray and wrongly nested
tags are closed as browsers do for the common cases; repeated rows are
extracted each, and count as pages each; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_to_struct, ship_code, staged, text_bytes

# HTML's element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
BLOCK = frozenset(
    "address article aside blockquote body center caption dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main "
    "menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
# An opening tag of the value closes an open element of the key.
CLOSED_BY = {
    "p": BLOCK - {"body", "head", "html", "td", "th", "tr", "caption", "tbody", "thead", "tfoot",
                  "title"},
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "tfoot"}), "td": frozenset({"td", "th", "tr", "tbody"}),
    "th": frozenset({"td", "th", "tr", "tbody"}), "option": frozenset({"option", "optgroup"}),
    "head": frozenset({"body"}), "thead": frozenset({"tbody", "tfoot"}),
    "tbody": frozenset({"tbody", "tfoot"}),
}
# Elements that an implied close does not look beyond.
SCOPE = {"p": BLOCK - {"p"}, "li": frozenset({"ul", "ol", "menu"}), "dt": frozenset({"dl"}),
         "dd": frozenset({"dl"}), "tr": frozenset({"table"}), "td": frozenset({"table"}),
         "th": frozenset({"table"})}
DROP_TAGS = frozenset(
    "head script style noscript template nav aside form button select option textarea input "
    "footer iframe object embed svg canvas audio video map dialog menu title xmp noembed "
    "noframes".split())
DROP_ROLES = frozenset(
    "navigation banner contentinfo complementary search menu menubar toolbar dialog alertdialog "
    "alert form".split())
# Words of class and id names (split at everything but letters).
DROP_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs "
    "comment comments commentlist cookie cookies consent disqus footer gdpr masthead menu "
    "modal nav navbar navigation newsletter notice notices pagination popup promo promoted "
    "promotion related replies share sharing sidebar signup skyscraper social sponsor sponsored "
    "subscribe subscription toolbar widget".split())
# Such names outside the article only (inside it they may hold its title).
OUTER_NAMES = frozenset({"header", "topbar", "site"})
ARTICLE = frozenset({"article", "main"})
# Blocks that may be template inside an article.
INNER = BLOCK - ARTICLE - frozenset(
    "body caption dd dt figcaption h1 h2 h3 h4 h5 h6 head hr html li summary tbody td tfoot th "
    "thead title tr".split())
_INSIDE = 0x5851F42D4C957F2D     # tells hashes inside articles from those outside

# A comment; a tag; a declaration; what starts as a tag but is none.  Possessive
# repeats and no "<" inside a tag (but in quotes) keep matching linear.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/][^>]*+>?"
    r"|<[a-zA-Z][^<>]*+>?", re.S)
_DEEPEST = 256       # elements nested deeper become siblings, as in browsers
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


@dataclass(frozen=True)
class Params:
    min_pages: int = 5
    min_share: float = 0.2


@dataclass
class Node:
    tag: str
    attrs: str = ""
    children: list = field(default_factory=list)     # nodes and strings
    digest: int = 0                                  # 0: is or holds an article
    content: int = 0


def parse(page: str) -> Node:
    """Tree of a page; text is kept raw (references not decoded)."""
    root = Node("")
    open_: list[Node] = [root]
    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            open_[-1].children.append(page[at:])
            break
        if m.start() > at:
            open_[-1].children.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:                       # comment, doctype, odd markup
            continue
        tag = m[2].lower()
        if m[1]:
            _close(open_, tag)
            continue
        for name in [n.tag for n in reversed(open_)]:
            # implied ends: the nearest open element that this tag closes
            if tag in CLOSED_BY.get(name, ()):
                _close(open_, name)
            elif name in BLOCK and name not in ("p", "li", "dt", "dd", "tr", "td", "th"):
                break
        node = Node(tag, m[3])
        open_[-1].children.append(node)
        if tag in VOID or m[3].endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            node.children.append(page[at:stop.start() if stop else end])
            at = stop.end() if stop else end
            continue
        if len(open_) < _DEEPEST:
            open_.append(node)
    return root


def _close(open_: list[Node], tag: str) -> None:
    limit = SCOPE.get(tag, ())
    for i in range(len(open_) - 1, 0, -1):
        if open_[i].tag == tag:
            del open_[i:]
            return
        if open_[i].tag in limit:
            return


def _attrs(node: Node) -> dict[str, str]:
    return {k.lower(): html.unescape(a or b or c)
            for k, a, b, c in _ATTR.findall(node.attrs)} if node.attrs else {}


def dropped(node: Node, inside: bool) -> bool:
    """Whether an element is no text of an article by its tag or names."""
    if node.tag in DROP_TAGS or not inside and node.tag == "header":
        return True
    if not node.attrs or node.tag in ("html", "body"):
        return False
    attrs = _attrs(node)
    if "hidden" in attrs or attrs.get("role", "").lower() in DROP_ROLES:
        return True
    names = _NAME.findall((attrs.get("class", "") + " " + attrs.get("id", "")).lower())
    if not names or node.tag in ARTICLE:
        return False
    return not (DROP_NAMES.isdisjoint(names) and (inside or OUTER_NAMES.isdisjoint(names)))


def digest(node: Node) -> int:
    """Hash of a subtree: tag, class and role, words of the text, children.
    An article, and what contains one, is no template: its hash is 0."""
    h = xxhash.xxh64(node.tag)
    if node.attrs:
        a = _attrs(node)
        h.update(f"|{a.get('class', '')}|{a.get('role', '')}")
    article = node.tag in ARTICLE
    for c in node.children:
        if isinstance(c, str):
            if c := _SPACE.sub(" ", c).strip():
                h.update("t" + c)
        else:
            below = digest(c)
            article |= below == 0
            h.update((below or c.content).to_bytes(8, "little"))
    node.content = h.intdigest()
    node.digest = 0 if article else node.content
    return node.digest


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def outer_subtrees(root: Node) -> set[int]:
    """Hashes of all element subtrees outside the page's article."""
    found: set[int] = set()

    def walk(node: Node) -> None:
        for c in node.children:
            if isinstance(c, Node) and c.tag not in ARTICLE and c.tag not in VOID:
                if c.digest:
                    found.add(_signed(c.digest))
                walk(c)

    digest(root)
    walk(root)
    return found


def inner_subtrees(root: Node) -> tuple[int | None, set[int]]:
    """Hash of the page's articles (None without one), and hashes of the blocks
    in them.  Follows :func:`outer_subtrees`, which hashes the tree."""
    found: set[int] = set()

    def walk(node: Node) -> None:
        for c in node.children:
            if isinstance(c, Node) and c.tag not in VOID:
                if c.digest and c.tag in INNER:
                    found.add(_signed(c.digest ^ _INSIDE))
                walk(c)

    articles = _inner(root)
    for a in articles:
        walk(a)
    content = xxhash.xxh64(b"".join(a.content.to_bytes(8, "little") for a in articles))
    return (_signed(content.intdigest()) if articles else None), found


def _inner(root: Node) -> list[Node]:
    """The page's outermost articles that are not dropped: ``article``
    elements, or ``main`` where it holds none."""

    def within(node: Node) -> list[Node]:
        found = []
        for c in node.children:
            if isinstance(c, Node) and not dropped(c, False):
                found += [c] if c.tag == "article" else \
                    within(c) or ([c] if c.tag == "main" else [])
        return found

    return within(root)


def _text(nodes: list[Node], inside: bool, template: frozenset[int],
          shared: bool = True) -> tuple[str, list[int]]:
    """Text of what stands in the nodes, and how much of it (in characters, without
    white space) is outside and inside articles.  ``shared``: whether templates inside articles go."""
    blocks: list[str] = []
    line: list[str] = []
    size = [0, 0]

    def close() -> None:
        text = " ".join(html.unescape("".join(line)).split())
        line.clear()
        if text:
            blocks.append(text)

    def recurs(c: Node, inside: bool) -> bool:
        if inside:
            return shared and c.tag in INNER and _signed(c.digest ^ _INSIDE) in template
        return _signed(c.digest) in template

    def walk(node: Node, inside: bool) -> None:
        for c in node.children:
            if isinstance(c, str):
                line.append(c)
                size[inside] += len("".join(c.split()))
                continue
            if c.tag in VOID:
                if c.tag in ("br", "hr"):
                    line.append(" ")
                if c.tag == "hr":
                    close()
                continue
            if dropped(c, inside) or template and c.digest and recurs(c, inside):
                # a dropped block parts the text around it
                if c.tag in BLOCK:
                    close()
                continue
            if c.tag in BLOCK:
                close()
                walk(c, inside or c.tag in ARTICLE)
                close()
            else:
                walk(c, inside)

    for n in nodes:
        walk(n, inside)
        close()
    return "\n\n".join(blocks), size


def extract(root: Node, template: frozenset[int] = frozenset()) -> str:
    """Main text of a parsed page."""
    if template:
        digest(root)
    articles = _inner(root)
    if not articles:
        return _text([root], False, template)[0]
    found = [_text([a], True, template)[0] or _text([a], True, template, False)[0]
             for a in articles]
    text = "\n\n".join(t for t in found if t)
    page, (outside, inside) = _text([root], False, template)
    return page if outside > max(inside, len("".join(text.split()))) else text


# ---- Spark ------------------------------------------------------------------

def _page(data: bytes | None) -> Node:
    return parse((data or b"").decode())


_SEEN = pa.struct([("outer", pa.list_(pa.int64())), ("content", pa.int64()),
                   ("inner", pa.list_(pa.int64()))])


def _hashes_udf():
    @F.arrow_udf("struct<outer:array<long>,content:long,inner:array<long>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for v in batch:
                root = _page(v.as_py())
                outer = sorted(outer_subtrees(root))
                content, inner = inner_subtrees(root)
                rows.append((outer, content, sorted(inner)))
            yield rows_to_struct(rows, _SEEN)

    return run.asNondeterministic()


def _text_udf():
    @F.arrow_udf("string")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for pages, lists in batches:
            out = []
            for page, template in zip(pages, lists, strict=True):
                out.append(extract(_page(page.as_py()), frozenset(template.as_py() or ())))
            yield pa.array(out, pa.string())

    return run.asNondeterministic()


def templates(pages: DataFrame, p: Params = Params()) -> DataFrame:
    """host, template (hashes of the subtrees that recur on it)."""
    host = F.lower(F.coalesce(F.regexp_extract("url", _HOST, 1), F.lit("")))
    seen = pages.select(host.alias("host"), _hashes_udf()(text_bytes("html")).alias("s"))
    # a NULL hash stands for the page or the article itself, so that one count serves all;
    # inside articles (content not NULL) each different article counts once
    one = F.array(F.lit(None).cast("long"))
    entry = lambda content: lambda x: F.struct(
        x.alias("subtree"), content.cast("long").alias("content"))
    outer = F.transform(F.concat(one, F.col("s.outer")), entry(F.lit(None)))
    inner = F.transform(F.concat(one, F.col("s.inner")), entry(F.col("s.content")))
    each = seen.select("host", F.explode(F.when(F.col("s.content").isNull(), outer).otherwise(
        F.concat(outer, inner))).alias("e")).select("host", "e.*")
    inside = F.col("content").isNotNull()
    per = each.groupBy("host", "subtree", "content").agg(F.count("*").alias("n")).select(
        "host", "subtree", inside.alias("inside"), F.when(inside, 1).otherwise(F.col("n"))
        .alias("n"))
    counted = staged(per.groupBy("host", "subtree", "inside").agg(F.sum("n").alias("n")).where(
        f"subtree IS NULL OR n >= {p.min_pages}"), "html-counts")
    pages_of = counted.where("subtree IS NULL").select("host", "inside", F.col("n").alias("pages"))
    often = counted.where("subtree IS NOT NULL").join(pages_of, ["host", "inside"]).where(
        F.col("n") >= F.col("pages") * p.min_share)
    return staged(often.groupBy("host").agg(
        F.sort_array(F.collect_list("subtree")).alias("template")), "html-templates")


def main_text(pages: DataFrame, p: Params = Params()) -> DataFrame:
    """page_id, url, text, n_chars: a row per row of ``pages``."""
    ship_code(pages.sparkSession)
    found = templates(pages, p).withColumnRenamed("host", "of")
    host = F.lower(F.coalesce(F.regexp_extract("url", _HOST, 1), F.lit("")))
    rows = pages.select("page_id", "url", text_bytes("html").alias("html"), host.alias("host"))
    out = rows.join(found, F.col("host") == F.col("of"), "left").select(
        "page_id", "url", _text_udf()(F.col("html"), F.col("template")).alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
