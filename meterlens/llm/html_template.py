"""Main text of web pages by equivalence-class template deduction.

Two passes over the pages.  The first cuts each page into tokens - block
elements with their path, and whole text blocks with theirs - and sums up every
token's occurrence vector over the pages of its host: two hash sums of (page,
count), the number of pages and the mean position.  Tokens of a host with equal
vectors form an equivalence class; classes on enough of the host's pages are
kept and nest by their elements' paths into the host's template.  The sums
combine map-side and the template of a host is one short row, so a host with a
third of all pages is no hot key.

The second pass walks each page beside its host's template.  A class is valid
on a page if its tokens come in the template's order there.  Text blocks of
valid classes are template; the others are slots.  Blocks inside menus, headers,
footers, side bars, notices, adverts, forms, scripts and reader comments go, by
element, role and whole class name.  Of the rest, those in the article (else the
main element) are the text.  On a page without such an element the container of
all slots is the article: template text outside it is the host's frame and
goes, template text beside the slots stays, as it is an article's own when
many pages of a host are copies of one.

Defined results: a null or empty page has an empty text; a null url is a host
of its own; unclosed and cut-off markup is closed where HTML closes it; repeated
rows get equal results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.llm.common import slices, staged

#: A class needs this share of a host's pages.  Two pages are the least to compare: the
#: template of a single one is all of it, which leaves no slot and so drops nothing.
MIN_PAGES = 2
MIN_SHARE = 0.9

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
LABEL_WORD = re.compile(r"[a-z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

# Fixed sets of HTML's element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var".split()
)
CLOSES = {  # start tags that end an open element, up to the given containers
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
    "body": (("head",), ("html",)),
}
CONTENT = frozenset(("article", "main"))
BOILER_ELEMENTS = frozenset(
    "nav footer aside form script style noscript template iframe object svg math button select "
    "textarea dialog menu head canvas audio video map".split()
)
BOILER_ROLES = frozenset(
    "navigation banner complementary contentinfo search form alert alertdialog dialog menu menubar "
    "toolbar".split()
)
BOILER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion "
    "banner sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment "
    "comments respond disqus cookie cookies consent gdpr notice notices notification popup modal "
    "overlay share sharing social related recommended newsletter subscribe signup login search "
    "widget toolbar pagination pager copyright disclaimer".split()
)


#: Kinds that often hold article elements of their own (each comment, each teaser).
OWN_ARTICLES = frozenset("comment comments respond disqus related recommended".split())
HEADER_NAMES = frozenset(("header", "page"))
#: Words for a part of a page, which leave a name's kind as it is (ad-box, comment-list).
PART_WORDS = frozenset(
    "area articles bar block body bottom box button buttons container content form global group inner left "
    "links list main outer panel posts primary right secondary section site slot top unit wrap wrapper".split()
)
#: Elements inside a text's flow; what encloses them is a container.
FLOW = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure "
    "figcaption".split()
)


class Block:
    """A text block, or an element's start, at a path.

    ``named`` is the number of the innermost enclosing element that only its name,
    role or form tag calls boilerplate (-1: none); ``content`` marks the start of an
    article or main element.
    """

    __slots__ = ("path", "text", "dropped", "article", "main", "named", "content", "element")

    def __init__(self, path, text, dropped, article, main, named=-1, content=False, element=None):
        self.path, self.text = path, text
        self.dropped, self.article, self.main = dropped, article, main
        self.named, self.content, self.element = named, content, element


class Element:
    """An element of a page, with the numbers of its first block and of the one behind it."""

    __slots__ = ("name", "path", "dropped", "article", "main", "named", "parent", "start", "end")

    def __init__(self, name, path, dropped, article, main, named=-1, parent=None, start=0):
        self.name, self.path = name, path
        self.dropped, self.article, self.main = dropped, article, main
        self.named, self.parent, self.start, self.end = named, parent, start, start


def attributes(source: str) -> dict[str, str]:
    return {
        m[1].lower(): (m[2] or "").strip("\"'").lower() for m in ATTRIBUTE.finditer(source)
    }


def names(attrs: dict[str, str]) -> list[list[str]]:
    """Words of each class name and of the id."""
    return [LABEL_WORD.findall(x) for x in f"{attrs.get('class', '')} {attrs.get('id', '')}".split()]


def name_words(attrs: dict[str, str], kinds=BOILER_NAMES) -> set[str]:
    """The ``kinds`` named by whole class names and ids, alone or with words for parts of a page.

    So ad-box is an advert, but share-price, related-work and has-sidebar name no kind.
    """
    found = set()
    for words in names(attrs):
        if all(w in kinds or w in PART_WORDS for w in words):
            found.update(w for w in words if w in kinds)
    return found


def only_named(name: str, attrs: dict[str, str]) -> bool:
    """Whether a boilerplate element is one by its name, role or form tag alone."""
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or HIDDEN.search(attrs.get("style", "")):
        return False
    return name == "form" or (name not in BOILER_ELEMENTS and name != "header")


def may_be_layout(name: str, attrs: dict[str, str]) -> bool:
    """A compound name (main-menu-wrapper) or a form may be that of the page's layout."""
    single = any(len(words) == 1 and words[0] in BOILER_NAMES for words in names(attrs))
    return not (name_words(attrs) & OWN_ARTICLES or single)


def free_layout(blocks: list[Block], parents: dict[int, int], layout: set[int], own: set[int]) -> None:
    """An element that encloses the page's only article or main element is no boilerplate.

    If no such element stands outside boilerplate, layout elements around one are
    freed; if no text is left at all, elements of any name are, the ``own`` ones
    (comments, teasers) last.  ``parents`` leads from each named element to the next one out.
    """
    free: set[int] = set()
    held = dict.fromkeys([-1], False)  # whether an element or one around it is still boilerplate

    def hold() -> None:
        for n, parent in parents.items():  # in page order, so the outer ones come first
            held[n] = n not in free or held[parent]

    def freed(which) -> None:
        seen = {-1}
        for b in blocks:
            if b.content and not b.dropped:
                n = b.named
                while n not in seen:
                    seen.add(n)
                    if which(n):
                        free.add(n)
                    n = parents[n]
        hold()

    if not parents:
        return
    hold()
    if not any(b.content and not b.dropped and not held[b.named] for b in blocks):
        freed(layout.__contains__)
    for which in (lambda n: n not in own, own.__contains__):
        if not any(b.text is not None and not b.dropped and not held[b.named] for b in blocks):
            freed(which)
    for b in blocks:
        b.dropped = b.dropped or held[b.named]


def is_boiler(name: str, attrs: dict[str, str], inside_content: bool) -> bool:
    if name in BOILER_ELEMENTS or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    if name in CONTENT or name in ("html", "body"):
        return False
    if name_words(attrs) or attrs.get("role") in BOILER_ROLES:
        return True
    if "style" in attrs and HIDDEN.search(attrs["style"]):
        return True
    # a page's header is not an article's
    return not inside_content and (name == "header" or bool(name_words(attrs, HEADER_NAMES) & {"header"}))


def page_blocks(page: str | None) -> list[Block]:
    """Element starts (text None) and text blocks of a page, in order."""
    out: list[Block] = []
    root = Element("", "", False, False, False)
    stack = [root]
    held: list[str] = []
    open_at: dict[str, list[int]] = {}  # depths of the open elements by name
    parents: dict[int, int] = {}  # named elements, each with the next one out
    layout: set[int] = set()  # numbers of named elements that may be the page's layout
    own: set[int] = set()  # numbers of those that often hold articles of their own

    def flush() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                top = stack[-1]
                out.append(Block(top.path, text, top.dropped, top.article, top.main, top.named, element=top))

    def cut(depth: int) -> None:
        flush()
        for element in stack[depth:]:
            element.end = len(out)
            open_at[element.name].pop()
        del stack[depth:]

    def innermost(which) -> int:
        return max((open_at[x][-1] for x in which if open_at.get(x)), default=0)

    def close(ended, stops) -> None:
        depth = innermost(ended)
        if depth > innermost(stops):
            cut(depth)

    page = page or ""
    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        if m is None:
            held.append(page[at:])
            break
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue  # a comment or declaration
        name = m[2].lower()
        if m[1]:
            if name in INLINE:
                # only an inline element that hides its text was put on the stack
                if stack[-1].name == name:
                    cut(len(stack) - 1)
            elif name not in VOID:
                flush()
                close((name,), ())
            continue
        if not page.endswith(">", m.start(), m.end()):
            break  # cut off inside a tag
        source = m[3]
        attrs = attributes(source) if source and not source.isspace() else {}
        if name in RAW_TEXT:
            end = re.compile(rf"</{re.escape(name)}", re.IGNORECASE).search(page, at)
            at = end.start() if end else n
            flush()
            continue
        top = stack[-1]
        if name in VOID:
            if name in ("br", "hr"):
                flush()
            continue
        inside = top.article or top.main
        boiler = is_boiler(name, attrs, inside)
        if name in INLINE and not boiler:
            continue
        flush()
        if name not in INLINE:
            close(("p",), ("table", "td", "th", "button", "object"))
            if name in CLOSES:
                close(*CLOSES[name])
        if source.rstrip().endswith("/") and name in ("svg", "math", "path"):
            continue
        top = stack[-1]
        label = ".".join(
            [name, *sorted(LABEL_WORD.findall(f"{attrs.get('class', '')} {attrs.get('id', '')}"))]
        ) if attrs else name
        main = top.main or name == "main" or attrs.get("role") == "main"
        path = f"{top.path}/{label}" if len(stack) < 64 else top.path
        named = top.named
        if boiler and only_named(name, attrs):
            boiler, named = False, len(out)
            parents[named] = top.named
            if may_be_layout(name, attrs):
                layout.add(len(out))
            elif name_words(attrs) & OWN_ARTICLES:
                own.add(len(out))
        article = top.article or name == "article"
        element = Element(name, path, top.dropped or boiler, article, main, named, top, len(out))
        open_at.setdefault(name, []).append(len(stack))
        stack.append(element)
        content = (article, main) != (top.article, top.main)
        out.append(Block(path, None, element.dropped, article, main, named, content))
    cut(1)
    root.end = len(out)
    free_layout(out, parents, layout, own)
    return out


def _name(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def token(block: Block) -> int:
    """Signed 64-bit name of an element path or of a text block at its path."""
    return _name(block.path if block.text is None else f"{block.path}\0{block.text}")


def parent_token(block: Block) -> int:
    """Name of the element that encloses a block; ``ROOT`` outside all elements."""
    path = block.path.rpartition("/")[0] if block.text is None else block.path
    return _name(path) if path else ROOT


def host_key(url):
    """Hash of a url's host; urls without one share the empty host."""
    return F.xxhash64(F.coalesce(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit("")))


TOKEN_SCHEMA = (
    "host long, token long, parent long, v1 long, v2 long, pages long, total long, place double, is_text boolean"
)
PAGE_TOKEN = ROOT = 0  # stands for the page itself and counts the pages of a host


def token_vectors(pages: DataFrame) -> DataFrame:
    """Occurrence vectors, summed per host and token."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in TOKEN_SCHEMA.split(", ")]
        for whole in batches:
            for batch in slices(whole, "html"):
                sums: dict[tuple[int, int, int], list] = {}
                columns = (batch.column(c).to_pylist() for c in ("page_key", "host", "html"))
                for key, host, page in zip(*columns, strict=True):
                    counts: dict[int, list] = {PAGE_TOKEN: [1, 0, False, ROOT]}
                    for place, block in enumerate(page_blocks(page)):
                        first = [0, place, block.text is not None, parent_token(block)]
                        counts.setdefault(token(block), first)[0] += 1
                    for name, (count, place, is_text, parent) in counts.items():
                        h = xxhash.xxh64_intdigest(b"%d:%d" % (key, count))
                        row = sums.setdefault((host, name, parent), [0, 0, 0, 0, 0.0, is_text])
                        row[0] += h & 0x7FFFFFFF
                        row[1] += h >> 33
                        row[2] += 1
                        row[3] += count
                        row[4] += place
                if sums:
                    keys = zip(*sums, strict=True)
                    values = zip(*sums.values(), strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c)) for c in (*keys, *values)], names=names
                    )

    picked = pages.select(
        F.xxhash64("page_id", "url", "html").alias("page_key"),
        host_key(pages["url"].cast("string")).alias("host"),
        pages["html"].alias("html"),
    )
    rows = picked.mapInArrow(measure, TOKEN_SCHEMA)
    return rows.groupBy("host", "token", "parent", "is_text").agg(
        *(F.sum(c).alias(c) for c in ("v1", "v2", "pages", "total", "place"))
    )


def host_templates(
    vectors: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE
) -> DataFrame:
    """One row per host with a template: its tokens with class number and place.

    Tokens of a template are on most pages of the host, so a row is no longer
    than a few pages' worth of tokens.
    """
    often = vectors.filter(F.col("pages") >= min_pages)
    hosts = often.filter(F.col("token") == PAGE_TOKEN).select("host", F.col("pages").alias("of"))
    kept = (
        often.filter(F.col("token") != PAGE_TOKEN)
        .join(hosts, "host")
        .filter(F.col("pages") >= F.col("of") * min_share)
        .select(
            "host",
            "token",
            "parent",
            F.xxhash64("v1", "v2", "pages", "total").alias("class"),  # equal vectors
            (F.col("total") == F.col("pages")).alias("once"),
            (F.col("place") / F.col("pages")).alias("place"),
            "is_text",
        )
    )
    # written once: the join can then split a host with many tokens below the share
    return staged(kept, "html-template-tokens").groupBy("host").agg(
        F.array_sort(F.collect_list(F.struct("place", "token", "parent", "class", "once", "is_text"))).alias(
            "template"
        )
    )


def template_text(blocks: list[Block], names: list[int], template) -> set[int]:
    """Numbers of the page's text blocks that belong to a valid class of the template.

    A class is valid on the page if its tokens come in the template's order and
    each lies in an element of a valid class (or of none): classes nest.
    """
    where: dict[int, list[int]] = {}
    for i, name in enumerate(names):
        where.setdefault(name, []).append(i)
    last: dict[int, int] = {}
    broken: set[int] = set()
    for t in template:
        places = where.get(t["token"])
        if places is None or (t["once"] and len(places) != 1):
            broken.add(t["class"])
        elif t["once"]:
            if places[0] < last.get(t["class"], -1):
                broken.add(t["class"])
            last[t["class"]] = places[0]
    class_of = {t["token"]: t["class"] for t in template}
    before = -1
    while before != len(broken):  # a class in a broken one is broken, too
        before = len(broken)
        broken |= {
            t["class"]
            for t in template
            if t["parent"] != ROOT and class_of.get(t["parent"]) in broken | {None}
        }
    return {
        i
        for t in template
        if t["is_text"] and t["class"] not in broken
        for i in where.get(t["token"], ())
    }


def main_text(page: str | None, template=None) -> str:
    """Article text of the page, its blocks joined by one space."""
    blocks = page_blocks(page)
    texts = [(i, b) for i, b in enumerate(blocks) if b.text is not None and not b.dropped]
    for part in ("article", "main"):
        inside = [b.text for _, b in texts if getattr(b, part)]
        if inside:
            return " ".join(inside)
    fixed = template_text(blocks, [token(b) for b in blocks], template) if template else set()
    lo, hi = container([(i, b) for i, b in texts if i not in fixed])
    return " ".join(b.text for i, b in texts if lo <= i < hi or not hi)


def container(slots: list[tuple[int, Block]]) -> tuple[int, int]:
    """Numbers of the first and behind the last block of the container of all slots.

    (0, 0) without slots.  Elements inside a text's flow are no containers.
    """
    if not slots:
        return 0, 0
    last = slots[-1][0]
    element = slots[0][1].element
    while element.parent is not None and (element.end <= last or element.name in FLOW):
        element = element.parent
    return element.start, element.end


def extract_main_text(
    pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE
) -> DataFrame:
    """``(page_id, url, text)`` for every page (columns page_id, url, html)."""
    vectors = staged(token_vectors(pages), "html-token-vectors")
    templates = staged(host_templates(vectors, min_pages, min_share), "html-templates")
    # a table of short rows: broadcast only under the session's size threshold
    keyed = templates.select(
        F.col("host").alias("__host"),
        F.transform(
            "template",
            lambda t: F.struct(
                *(t[c].alias(c) for c in ("token", "parent", "class", "once", "is_text"))
            ),
        ).alias("template"),
    )
    source = pages.select(
        pages["page_id"].cast("long").alias("page_id"),
        pages["url"].cast("string").alias("url"),
        pages["html"].alias("html"),
        host_key(pages["url"].cast("string")).alias("__host"),
    )
    joined = source.join(keyed, "__host", "left").select("page_id", "url", "html", "template")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "html"):
                rows = zip(
                    batch.column("html").to_pylist(), batch.column("template").to_pylist(), strict=True
                )
                texts = pa.array([main_text(page, template) for page, template in rows], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("url"), texts],
                    names=["page_id", "url", "text"],
                )

    return joined.mapInArrow(extract, "page_id long, url string, text string")

