"""HTML main text by equivalence classes of template tokens.

1. Pages are token sequences: tags with their path, text nodes, and the single
   words of short text nodes. For each host and token the occurrence vector
   over the host's different pages (copies of one html count once) is kept as
   a hash that adds up over pages, so a host with a third of all pages is
   pre-aggregated like any other.
2. Tokens of a host with one vector form an equivalence class; classes of
   enough tokens on enough pages are candidates for template parts.
3. A class is valid if its tokens stand in the same order on every page and
   fall into one place of the class around it; valid classes, nested this way,
   are the host's template.
4. Extraction walks each page once more: what stands between tokens of the
   template are slots. Menus, headers, footers, sidebars, notices, adverts,
   forms, comments, scripts and styles (by element, role, class or id) are no
   main text, but a class or id never excludes html, body, main or article. The
   rest is the page's blocks in page order. The main part holds the text, or the
   articles if there is none; articles with fewer words than the slots outside
   them (words of links aside) are teasers, and all blocks count. Of these, a
   block that is nothing but template is dropped as a notice, except a heading
   whose next block stays, and except all of a part without any slot. What a
   class or id excludes around an article is used only if the page has no other
   text, or no article or main part and less than a quarter of its words.

Character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined by an empty line, empty ones left out.

Nulls: null html gives an empty text; a null url is a host of its own. Rows
that repeat an id are separate pages; equal html is
one page for the template. Html without any tag is one block. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.sparkkit import materialize

#: different pages and share of a host's different pages that a template class needs, and tokens of a class
MIN_PAGES, MIN_SHARE, MIN_TOKENS = 8, 0.8, 3
#: text nodes of up to so many words also count word by word
SHORT_NODE = 8
#: hosts whose tokens a task keeps at hand
HOSTS = 64

# Elements of HTML by role.
RAW = frozenset("script style noscript template iframe object svg canvas textarea select title audio video".split())
NOT_MAIN = RAW | frozenset("head nav footer aside form button menu dialog input option datalist annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: blocks that name what follows them
LABELS = HEADINGS | frozenset("legend dt th caption".split())
#: classes and ids, or head words of them, that mark what is no main text
MARKS = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner promo promotion sponsor sponsored sidebar side menu nav navbar navigation "
    "breadcrumb breadcrumbs header masthead footer cookie cookies consent gdpr notice notices alert newsletter subscribe signup paywall "
    "share sharing social comment comments commentlist disqus respond replies related recommended widget popup modal overlay login search "
    "searchbox pagination pager copyright toolbar skip".split()
)
#: marks of parts that never surround the article
AROUND_NONE = frozenset("comment comments commentlist disqus respond replies related recommended".split())
#: words after the head word of a class (``sidebar-left``, ``footer-links``)
AFTER = frozenset(
    "area bar bottom box button buttons center col column container field fixed form grid group holder icon icons inner inside input item "
    "items left link links list mobile outer panel post posts primary region right root row secondary section slot sticky top unit wrap "
    "wrapper zone block".split()
)
#: words that make a class name a state (``has-sidebar``, ``comments-open``): before and after the others
STATE = frozenset("has have with without no not is show hide".split())
STATED = frozenset("open opened close closed active inactive enabled disabled visible hidden shown on off".split())
#: elements that no class or id excludes
NEVER_NAMED = frozenset("html body main article".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([A-Za-z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")


#: why an element is no main text: by its class or id, or by element, role or visibility
NAMED, EXCLUDED = 1, 2


@lru_cache(1 << 14)
def _names_mark(token: str) -> str | None:
    """The mark that a class or id is or has as its head word."""
    if token.lower() in MARKS:
        return token.lower()
    parts = [p.lower() for p in _PART.findall(token)]
    if not parts or parts[-1] in STATED or any(p in STATE for p in parts[:-1]):
        return None
    while len(parts) > 1 and (parts[-1] in AFTER or len(parts[-1]) == 1):
        parts.pop()
    return parts[-1] if parts[-1] in MARKS else None


def _marked(element: str, attrs: str) -> int:
    """What of class, id (NAMED), role and visibility (EXCLUDED) say that this
    is no main text; 0 if nothing does."""
    named = 0
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            if element not in NEVER_NAMED:
                for mark in map(_names_mark, value.split()):
                    if mark:
                        named = max(named, EXCLUDED if mark in AROUND_NONE else NAMED)
        elif name == "role":
            if value.lower() in ROLES:
                return EXCLUDED
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return EXCLUDED
        elif name == "style" and "display:none" in value.replace(" ", "").lower():
            return EXCLUDED
    return named


class Element(NamedTuple):
    """An open element, with what the elements around it say of its text."""

    name: str
    path: tuple[str, ...]  # names of up to four innermost elements, this one last
    block: int  # place of the innermost open block in the stack
    out: bool  # no main text, whatever stands inside
    marked: bool  # a class or id excludes it, with no article or main part in between
    behind: bool  # a class or id excludes the article or main part around it
    part: str  # article, main or body: the part that holds it
    header: bool
    label: str  # innermost block or heading that names what follows, or nothing
    link: bool


_TOP = Element("", (), -1, False, False, False, "body", False, "", False)


def _inside(up: Element, name: str, why: int, at: int) -> Element:
    part, marked, behind = up.part, up.marked or why == NAMED, up.behind
    if name in ("article", "main"):
        part = "main" if "main" in (name, up.part) else "article"
        marked, behind = why == NAMED, up.behind or up.marked
    label = name if name in LABELS else "" if name in BLOCKS else up.label
    return Element(
        name, (*up.path[-3:], name), at if name in BLOCKS else up.block, up.out or why == EXCLUDED, marked, behind,
        part, up.header or name == "header", label, up.link or name == "a",
    )


def walk(html: str) -> Iterator[tuple[str, str, Element]]:
    """Events of a page: (kind, value, innermost open element), kind one of
    open, close and text. Missing end tags of paragraphs, list items and cells
    are supplied. Every tag costs the same, however deep it stands."""
    stack: list[Element] = [_TOP]
    open_now: Counter = Counter()
    at = 0

    def close() -> tuple[str, str, Element]:
        name = stack.pop().name
        open_now[name] -= 1
        return "close", name, stack[-1]

    for m in _TOKEN.finditer(html):
        if m.start() < at:  # inside raw text
            continue
        if m.start() > at:
            yield "text", html[at : m.start()], stack[-1]
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["end"]:
            if open_now[name]:
                while True:
                    event = close()
                    yield event
                    if event[1] == name:
                        break
            elif name in ("p", "br"):
                yield "close", name, stack[-1]
            continue
        if name in BLOCKS and stack[-1].block >= 0:
            # a block ends an open paragraph; items, cells and rows end their own kind
            closes = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "option": ("option",)}.get(name, ())
            k = stack[-1].block
            if stack[k].name == "p" or stack[k].name in closes:
                while len(stack) > k:
                    yield close()
        attrs = m["attrs"] or ""
        if name in VOID or attrs.endswith("/") and name not in BLOCKS and name not in RAW:
            yield "open", name, _inside(stack[-1], name, 0, len(stack))
            continue
        why = EXCLUDED if name in NOT_MAIN else _marked(name, attrs) if attrs.strip() else 0
        stack.append(_inside(stack[-1], name, why, len(stack)))
        open_now[name] += 1
        yield "open", name, stack[-1]
        if name in RAW:  # no tags inside but its own end
            stop = re.compile(rf"</{re.escape(name)}\s*[^>]*(?:>|\Z)", re.I).search(html, at)
            at = stop.end() if stop else len(html)
            yield close()
    if at < len(html):
        yield "text", html[at:], stack[-1]


def tokens(html: str) -> Iterator[str]:
    """Template tokens of a page."""
    for kind, value, of in walk(html):
        path = "/".join(of.path)
        if kind != "text":
            yield f"{kind} {value} {path}"
            continue
        words = value.split()
        if words:
            yield f"node {path} {' '.join(words)}"
            if len(words) <= SHORT_NODE:
                for w in words:
                    yield f"word {path} {w}"


def _code(token: str) -> int:
    return xxhash.xxh3_64_intdigest(token) - (1 << 63)


def _held(cache: dict, host: int, make: Callable):
    """What ``make`` gives for a host, remembered for some hosts at a time."""
    if host not in cache:
        if len(cache) >= HOSTS:
            cache.clear()
        cache[host] = make()
    return cache[host]


# --- 1, 2: occurrence vectors and classes ------------------------------------


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held: dict[tuple[int, int], list[int]] = {}
        for host, page, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            for code, n in Counter(_code(t) for t in tokens(text.as_py())).items():
                h = xxhash.xxh3_64_intdigest(f"{page} {n}") - (1 << 63)
                e = held.get((host, code))
                if e is None:
                    held[host, code] = [1, h]
                else:
                    e[0] += 1
                    e[1] ^= h
        # one row per host and token of the batch; xor adds up over batches
        keys = list(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array([held[k][0] for k in keys], pa.int64()), pa.array([held[k][1] for k in keys], pa.int64())],
            ["host", "token", "pages", "vector"],
        )


def classes(pages: DataFrame) -> DataFrame:
    """``host, token, class`` of the equivalence classes that are large and
    frequent enough; pages has host, page (a number of its content) and html."""
    different = pages.select("host", "page", "html").dropDuplicates(["host", "page"])
    per = different.mapInArrow(_occurrences, "host long, token long, pages long, vector long")
    per = per.groupBy("host", "token").agg(F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector"))
    counts = pages.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("of")).where(F.col("of") >= MIN_PAGES)
    enough = per.join(counts, "host").where(F.col("pages") >= F.col("of") * MIN_SHARE)
    enough = materialize(enough.select("host", "token", F.xxhash64("pages", "vector").alias("class")), "html-tokens")
    size = enough.groupBy("host", "class").agg(F.count("*").alias("size")).where(F.col("size") >= MIN_TOKENS)
    return enough.join(size.select("host", "class"), ["host", "class"])


# --- 3: valid and nested classes ---------------------------------------------


def order_and_place(html: str, of: dict[int, int]) -> dict[int, tuple[int, int, bool]]:
    """For each class on a page (``of``: class of a token): hashes of the order
    of its tokens and of the place of the other classes around it, and whether
    it is broken: out of order between its cycles, or at several places."""
    seen: dict[int, list[int]] = {}
    around: dict[int, set] = {}
    last: dict[int, int] = {}
    once: dict[int, bool] = {}
    for t in tokens(html):
        code = _code(t)
        c = of.get(code)
        if c is None:
            continue
        own = seen.setdefault(c, [])
        if not own or code == own[0]:  # a cycle of the class begins: where in the others?
            around.setdefault(c, set()).add(tuple(sorted((k, v) for k, v in last.items() if k != c and once[k])))
        once[c] = once.get(c, True) and code not in own
        own.append(code)
        last[c] = code
    out = {}
    for c, own in seen.items():
        cycle = own[: len(set(own))]
        broken = own != cycle * (len(own) // len(cycle)) or len(around[c]) != 1
        out[c] = (_code(" ".join(map(str, cycle))), _code(str(min(around[c]))), broken)
    return out


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and class: least and greatest hash of the class's token order
    and of its place, and whether it is broken on a page, over the batch."""
    cache: dict[int, dict] = {}
    for batch in batches:
        held: dict[tuple[int, int], list] = {}
        for host, text, known in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            of = _held(cache, host, lambda known=known: {t["token"]: t["class"] for t in known.as_py()})
            for c, (order, place, broken) in order_and_place(text.as_py(), of).items():
                e = held.setdefault((host, c), [order, order, place, place, False])
                e[:] = min(e[0], order), max(e[1], order), min(e[2], place), max(e[3], place), e[4] or broken
        keys = list(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1)]
            + [pa.array([held[k][i] for k in keys], pa.int64()) for i in range(4)]
            + [pa.array([held[k][4] for k in keys], pa.bool_())],
            ["host", "class", "o1", "o2", "p1", "p2", "broken"],
        )


def templates(pages: DataFrame) -> DataFrame:
    """``host, template``: the tokens of the host's valid, nested classes."""
    found = materialize(classes(pages), "html-classes")
    known = materialize(found.groupBy("host").agg(F.collect_list(F.struct("token", "class")).alias("known")), "html-known")
    met = pages.join(known, "host").select("host", "html", "known")
    order = met.mapInArrow(_orders, "host long, class long, o1 long, o2 long, p1 long, p2 long, broken boolean")
    order = order.groupBy("host", "class").agg(
        F.min("o1").alias("o1"), F.max("o2").alias("o2"), F.min("p1").alias("p1"), F.max("p2").alias("p2"), F.max("broken").alias("broken")
    )
    valid = order.where("o1 = o2 and p1 = p2 and not broken").select("host", "class")
    return found.join(valid, ["host", "class"]).groupBy("host").agg(F.collect_list("token").alias("template"))


# --- 4: slots ----------------------------------------------------------------


def _clean(pieces: list[str]) -> str:
    return " ".join(entities.unescape("".join(pieces)).split())


class Block(NamedTuple):
    text: str
    part: str
    behind: bool
    slot: bool  # holds more than template
    label: bool
    link_words: int


def blocks_of(html: str, template: frozenset) -> list[Block]:
    """The blocks of a page that no element, role, class or id excludes, and
    those of articles and main parts that only a class or id around excludes."""
    out: list[Block] = []
    piece: list[str] = []
    first, slot, links = _TOP, False, 0

    def flush() -> None:
        nonlocal slot, links
        text = _clean(piece) if piece else ""
        if text:
            out.append(Block(text, first.part, first.behind, slot, first.label in LABELS, links))
        piece.clear()
        slot, links = False, 0

    for kind, value, of in walk(html):
        if kind == "text":
            if of.out or of.marked or (of.header and not (of.part != "body" and of.label in HEADINGS)):
                continue
            if value.strip():
                if not any(map(str.strip, piece)):
                    first = of
                if of.link:
                    links += len(value.split())
                if not slot:
                    slot = not template or _code(f"node {'/'.join(of.path)} {' '.join(value.split())}") not in template
            piece.append(value)
        elif value == "br":
            piece.append(" ")
        elif value in BLOCKS:
            flush()
    flush()
    return out


def _words(blocks: list[Block]) -> int:
    return sum(len(b.text.split()) for b in blocks)


def main_text(html: str, template: frozenset) -> str:
    """The main text of a page."""
    blocks = blocks_of(html, template)
    front, back = [b for b in blocks if not b.behind], [b for b in blocks if b.behind]
    if back and all(b.part == "body" for b in front) and 4 * _words(front) < _words(back):
        front = back
    part = next((p for p in ("main", "article") if any(b.part == p for b in front)), "body")
    chosen = [b for b in front if b.part == part]
    if part == "article":
        outside = [b for b in front if b.part == "body" and b.slot]
        if _words(outside) - sum(b.link_words for b in outside) > _words(chosen):
            chosen = front
    if any(b.slot for b in chosen):
        kept: list[Block] = []
        after = None
        for b in reversed(chosen):
            # a heading stays if the block after it does
            if b.slot or b.label and kept and kept[-1] is after:
                kept.append(b)
            after = b
        chosen = kept[::-1]
    return "\n\n".join(b.text for b in chosen)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache: dict[int, frozenset] = {}
    for batch in batches:
        out = []
        for host, html, known in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4), strict=True):
            template = _held(cache, host, lambda known=known: frozenset(known.as_py() or ()))
            out.append(main_text(html.as_py() or "", template))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], ["page_id", "url", "text", "n_chars"]
        )


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    host = F.xxhash64(F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)))
    html = F.coalesce("html", F.lit(""))
    named = pages.select("page_id", "url", host.alias("host"), html.alias("html"), F.xxhash64(html).alias("page"))
    known = materialize(templates(named), "html-templates")
    met = named.join(known, "host", "left").select("page_id", "url", "host", "html", "template")
    return met.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
