"""Main text of web pages, with the templates of their site removed.

1. Every page is parsed into elements. Each block element is hashed with all
   it holds; link lists also by shape alone (tags and classes), since a site
   fills the same menu with other words, and other lists without paragraphs
   also with their numbers left out.
2. Spark counts the hashes by host, once per distinct page: copies of a page
   count as one. A subtree found on many pages of its host is template.
3. Pages that hold template are joined with their hashes and parsed again.
   Template goes first, over the whole page, articles included. The text is
   chosen from what is left: the articles that still hold text, else the main
   elements, else the body, without elements whose tag, role or class says
   what they are (menus, headers, footers, sidebars, notices, adverts, forms,
   comments). If nothing is left, an article that recurs is the text.

Inside an article, only containers go as template: a paragraph, heading or
list item that many articles share is still part of each. Shapes and lists
without numbers count only outside of articles and only if text is left; a
list without links must also hold no more text than is left.

Defined results: null or empty html gives an empty text; pages of a null or
odd url share one host; equal pages are told apart by nothing and need not be;
unclosed and stray tags are closed and skipped as browsers do; other columns
of the pages are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import Store, likely_rows, small_batches


@dataclass(frozen=True)
class Template:
    """A subtree is template on ``pages`` or more distinct pages of a host, if
    these are ``share`` of the host's distinct pages or more, or ``many``."""

    pages: int = 5
    share: float = 0.1
    many: int = 50


# Fixed values of HTML: elements without end tag, with raw text, and blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset("""address article aside blockquote body button center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre
    section select summary table tbody td tfoot th thead tr ul caption template head""".split())
ENDS_P = BLOCK - frozenset("button td th tr tbody thead tfoot caption option optgroup".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
         "option": {"select"}}

# What is never main text: elements, roles, and words of class or id.
NOT_TEXT = frozenset("""head script style noscript template nav aside form button select option textarea input iframe
    object svg canvas dialog menu title""".split())
EDGE = frozenset(["header", "footer"])
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
WORDS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar
    comment comments disqus replies cookie cookies consent gdpr notice notices newsletter subscribe signup share
    sharing social related recommended breadcrumb breadcrumbs menu nav navbar navigation popup modal widget
    pagination footer masthead""".split())
# Words that say where or what a block is, not what it holds: a compound name is
# furniture if some of its parts are among WORDS and the rest among these.
AROUND = frozenset("""site page main global top bottom left right upper lower side header box bar block list lists item items
    container wrapper wrap section area inner outer panel group link links button buttons form forms text content slot unit
    row col column zone tools articles posts stories more""".split())
KEPT_TAGS = frozenset("html body article main".split())
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote dt dd td th tr figcaption".split())
LISTS = frozenset("ul ol menu dir dl".split())
LINKED = 0.8  # a link list has this share of its text in links, or more
NUMBER = re.compile(r"[0-9]+")
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote article main".split())

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
    |<(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*)(?:>|\Z)""", re.S | re.X)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")


@dataclass
class Element:
    tag: str
    names: str = ""  # class, id and role
    children: list = field(default_factory=list)  # elements and strings

    def furniture(self, in_article: bool) -> bool:
        """Whether tag, role or class say that this is not main text."""
        if self.tag in NOT_TEXT or (self.tag in EDGE and (self.tag == "footer" or not in_article)):
            return True
        if self.tag in KEPT_TAGS or not self.names:
            return False
        for name in self.names.lower().split():
            role, _, value = name.rpartition("role=")
            if not role and value != name and value in ROLES:
                return True
            parts = {x for x in re.split(r"[^a-z]+", name) if x}
            said = parts & WORDS or (not in_article and "header" in parts)
            if said and parts <= WORDS | AROUND:
                return True
        return False


def parse(page: str) -> Element:
    """The page's elements; open ones are ended as their successors imply."""
    root = Element("html")
    stack, at = [root], 0

    def close(tags: set[str], scope: set[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                del stack[k:]
                return
            if stack[k].tag in scope:
                return

    while (m := TAG.search(page, at)) is not None:
        if m.start() > at:
            stack[-1].children.append(entities.unescape(page[at:m.start()]))
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                stack[-1].children.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        if m[1]:
            if tag not in ("html", "body"):
                close({tag}, {"body"} if tag in BLOCK else BLOCK)
            continue
        if tag in ("html", "body", "head") and any(e.tag == tag for e in stack):
            continue
        if tag in ENDS_P:
            close({"p"}, {"button", "table", "td", "th", "div", "section", "article", "li", "body"})
        if tag in SAME:
            close(SAME[tag], SCOPE[tag])
        if tag == "body":
            close({"head"}, set())
        names = ""
        if m[3] and "=" in m[3]:
            got = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(m[3])}
            names = " ".join([got.get("class", ""), got.get("id", ""),
                              f"role={got['role']}" if got.get("role") else ""]).strip()
        element = Element(tag, names)
        stack[-1].children.append(element)
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)", re.I).search(page, at)
            stop = end.start() if end else len(page)
            at = stop
        elif tag not in VOID and not m[3].rstrip().endswith("/") or tag in BLOCK - VOID:
            stack.append(element)
    if at < len(page):
        stack[-1].children.append(entities.unescape(page[at:]))
    return root


def _h(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(),
                          "big", signed=True)


@dataclass(slots=True)
class _Made:
    """An element's hashes and counts; those below ``content`` only if it
    holds no paragraph."""

    dense: bool  # holds paragraphs
    content: str = ""
    shape: str = ""
    plain: str = ""  # content without numbers
    numbers: bool = False
    chars: int = 0
    linked: int = 0  # of these, in links


def hashes(root: Element) -> dict[int, tuple[int, int | None, int | None]]:
    """id of each block element -> (hash of all it holds, of its shape if it
    is a link list, of all but its numbers if it is another list); no
    recursion, so any depth will do."""
    out: dict[int, tuple[int, int | None, int | None]] = {}
    made: dict[int, _Made] = {}
    todo = [(root, False)]
    while todo:
        e, ready = todo.pop()
        kids = [c for c in e.children if isinstance(c, Element)]
        if not ready:
            todo.append((e, True))
            todo += [(c, False) for c in kids]
            continue
        below = [made[id(c)] for c in kids]
        strings = {k: " ".join(c.split()) for k, c in enumerate(e.children) if isinstance(c, str)}
        text = "\x1e".join(x for x in (strings[k] if k in strings else made[id(c)].content
                                       for k, c in enumerate(e.children)) if x)
        m = _Made(dense=e.tag in PARAGRAPHS or any(b.dense for b in below))
        content = _h("text", e.tag, e.names, text)
        m.content = f"{content:x}" if text or kids else ""
        links = plain = None
        if not m.dense:
            m.chars = sum(map(len, strings.values())) + sum(b.chars for b in below)
            m.linked = m.chars if e.tag == "a" else sum(b.linked for b in below)
            m.numbers = any(b.numbers for b in below) or any(map(NUMBER.search, strings.values()))
            shape = _h("shape", e.tag, e.names, "".join(dict.fromkeys(b.shape for b in below)))
            m.shape, m.plain = f"{shape:x}", m.content
            if m.numbers:
                bare = _h("plain", e.tag, e.names, "\x1e".join(x for x in (
                    NUMBER.sub("0", strings[k]) if k in strings else made[id(c)].plain
                    for k, c in enumerate(e.children)) if x))
                m.plain = f"{bare:x}"
            if m.chars and m.linked >= LINKED * m.chars and e.tag not in TEXTUAL:
                links = shape
            elif m.numbers and e.tag in LISTS:
                plain = bare
        made[id(e)] = m
        if e.tag in BLOCK and text and e.tag not in ("html", "body", "head"):
            out[id(e)] = (content, links, plain)
    return out


def subtrees(page: str) -> list[int]:
    """Distinct hashes of the page's subtrees."""
    found = hashes(parse(page)).values()
    return sorted({h for own in found for h in own if h is not None})


def main_text(page: str, template: frozenset[int] = frozenset()) -> str:
    """The page's blocks of main text, joined by newlines."""
    root = parse(page)
    found = hashes(root) if template else {}
    same, links, lists = ({i for i, own in found.items() if own[k] in template} for k in range(3))
    text = _left(root, same, links | lists)
    if lists:
        more = _left(root, same, links)
        if 2 * len(text) < len(more):  # the lists are most of the page
            text = more
    if not text and links | lists:
        text = _left(root, same, set())
    if not text and same:  # all articles recur: they are the text, not what surrounds it
        text = _left(root, same - _around_articles(root), set())
    return text


def _around_articles(root: Element) -> set[int]:
    """ids of the articles and main elements and of all that hold them."""
    out: set[int] = set()
    todo = [(root, (None, None))]
    while todo:
        e, up = todo.pop()
        path = (id(e), up)
        if e.tag in ("article", "main"):
            at = path
            while at[0] is not None and at[0] not in out:
                out.add(at[0])
                at = at[1]
        todo += [(c, path) for c in e.children if isinstance(c, Element)]
    return out


def _left(root: Element, same: set[int], alike: set[int]) -> str:
    """Main text of what is left of the page without the elements in ``same``,
    and those in ``alike`` outside of articles: its articles', else its main
    elements', else all of it."""
    for tags in (("article",), ("main",)):
        text = _text(_outermost(root, tags, same, alike), True, same, alike)
        if text:
            return text
    return _text([root], False, same, alike)


def _text(starts: list[Element], inside: bool, same: set[int], alike: set[int]) -> str:
    blocks: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    for start in starts:
        todo: list = [start]
        while todo:
            x = todo.pop()
            if x is None:
                end()
            elif isinstance(x, str):
                line.append(x)
            elif x.tag in ("br", "wbr"):
                line.append(" " if x.tag == "br" else "")
            elif x is not start and (x.furniture(inside) or _is_template(x, same, alike, inside)):
                if x.tag in BLOCK:
                    end()
            elif x.tag not in RAW:
                if x.tag in BLOCK:
                    end()
                    todo.append(None)
                todo += reversed(x.children)
        end()
    return "\n".join(blocks)


def _is_template(x: Element, same: set[int], alike: set[int], inside: bool) -> bool:
    if inside:
        return id(x) in same and x.tag not in TEXTUAL
    return id(x) in same or (id(x) in alike and x.tag not in TEXTUAL)


def _outermost(root: Element, tags: tuple[str, ...], same: set[int], alike: set[int]) -> list[Element]:
    """The page's outermost elements of ``tags`` that are neither furniture
    nor template."""
    out, todo = [], [root]
    while todo:
        x = todo.pop()
        if _is_template(x, same, alike, False):
            continue
        if x.tag in tags:
            out.append(x)
        elif x is root or not x.furniture(False):
            todo += [c for c in reversed(x.children) if isinstance(c, Element)]
    return out


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [subtrees(x or "") for x in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("key"), pa.array(found, pa.list_(pa.int64()))],
                                         names=["host", "key", "hashes"])


def _extract(batches: Iterator[pa.RecordBatch], keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x or "", frozenset(t or ())) for x, t in
                 zip(batch.column("html").to_pylist(), batch.column("template").to_pylist(), strict=True)]
        texts = [t.encode("utf-8", "replace").decode() for t in texts]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string())],
                                         names=[*keep, "text"])


def _once(found: DataFrame) -> DataFrame:
    """A row for each distinct page of a host. Only pages that have copies are
    shuffled with their hashes, one row per page and task."""
    copied = found.groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return likely_rows(found, "key", copied, "key", likely=False).unionAll(
        likely_rows(found, "key", copied, "key").groupBy("host", "key").agg(F.first("hashes").alias("hashes")))


def extract(pages: DataFrame, store: Store, p: Template = Template()) -> DataFrame:
    """``pages`` (page_id, url, html) -> page_id, url, text, one row per row."""
    small_batches(pages.sparkSession, 64)
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    pages = pages.withColumn("host", host(F.col("url"))).withColumn(
        "key", F.md5(F.concat("host", F.lit("\n"), F.coalesce("html", F.lit(""))).cast("binary")))
    found = store.put(pages.select("host", "key", "html")
                      .mapInArrow(_subtrees, "host string, key string, hashes array<bigint>"), "subtrees")
    once = _once(found)
    each = once.select("host", "key", F.explode("hashes").alias("h"))
    sizes = once.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    common = each.groupBy("host", "h").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= p.pages)
    often = (F.col("pages") >= p.share * F.col("n")) | (F.col("pages") >= p.many)
    common = store.put(common.join(sizes, "host").where(often).select("host", "h"), "template")
    marks = store.put(each.join(common, ["host", "h"]).groupBy("key")
                      .agg(F.collect_set("h").alias("template")), "marks")
    none = F.expr("cast(null as array<bigint>)")
    some = likely_rows(pages, "key", marks, "key").join(marks, "key", "left")
    rest = likely_rows(pages, "key", marks, "key", likely=False).withColumn("template", none)
    cols = ["page_id", "url", "html", "template"]
    schema = pages.select("page_id", "url").schema.add("text", T.StringType())
    return some.select(cols).unionAll(rest.select(cols)).mapInArrow(lambda it: _extract(it, ["page_id", "url"]), schema)
