"""HTML extraction: templates deduced from equivalence classes of tokens.

The tokens of a page are its start tags and its text blocks, each with the path of elements
above it. Over the pages of a host, tokens with the same occurrence vector (as often on the
same pages) form a class; a class is valid if it covers at least half of the host's pages, and
`MIN_PAGES` of them. Vectors are compared by their sum of hashed (page, count) pairs, which adds
up in steps, so no task gathers a host. Pages that agree in all blocks outside of menus and the
like count once, and so do near copies: a page with over half of its text on other pages of the
host counts as one with the page that had most of it first. Copies of an article are no template.
Text is template text if its class is valid, has several members, which come in one order on every
page, and the element around it is of a valid class; text alone in its class stays. What else a
page holds is in the slots. Slots in menus, headers, footers, sidebars, notices, adverts, forms
and comments are left out, by the names of the elements around them; of a page with an article
(or else a main) element, the slots in it are the text, else all slots that are not lists of links.

Defined cases: a null or empty page has an empty text; a page without a host takes part in no
template; tags that are never closed, or cut off by the end of the page, end with the page;
repeated pages each get their result; an empty table gives an empty result; a very long page is parsed
whole in one task; columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.tables import stored

MIN_PAGES = 4
MIN_SHARE = 0.5

# Elements that start a new block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Elements whose content is no text of the page.
HIDDEN = frozenset(
    "head title script style noscript template iframe svg math canvas object audio video map "
    "button select textarea datalist".split()
)
RAW = frozenset("script style noscript template iframe svg textarea title".split())
# Elements, roles and words of class or id that mark what is not the article.
ASIDE = frozenset("nav header footer aside form menu dialog search".split())
ASIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu "
    "menubar toolbar".split()
)
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar "
    "navigation newsletter notice overlay pagination popup promo related share sharing sidebar "
    "social sponsor sponsored subscribe toolbar widget".split()
)
# A new one of these ends an open one, up to the element that holds them.
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr"}),
    "th": ({"td", "th"}, {"tr"}),
    "option": ({"option"}, {"select", "datalist"}),
}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[A-Za-z]+")
_HOST = re.compile(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)")


def host_of(url: str | None) -> str | None:
    found = _HOST.match(url or "")
    return found[1].rpartition("@")[2].lower() or None if found else None


@dataclass
class Element:
    name: str
    path: str
    hidden: bool
    aside: bool
    content: str  # "article", "main" or "" for the innermost of these around it
    link: bool


@dataclass
class Block:
    """Text between two block boundaries."""

    path: str
    text: str
    aside: bool
    content: str
    linked: int  # characters inside links
    after: int  # how many different start tags came before


def _is_aside(name: str, attributes: str) -> bool:
    if name in ASIDE:
        return True
    for kind, *values in _ATTRIBUTE.findall(attributes):
        value = next(filter(None, values), "")
        if kind.lower() == "role":
            if value.strip().lower() in ASIDE_ROLES:
                return True
        elif any(word.lower() in ASIDE_WORDS for word in _NAME.findall(value)):
            return True
    return False


def _open(stack: list[Element], name: str, attributes: str) -> Element:
    above = stack[-1]
    marked = sorted(
        f"{kind.lower()}={_SPACE.sub(' ', ''.join(values))}"
        for kind, *values in _ATTRIBUTE.findall(attributes)
        if kind.lower() != "id"
    )
    own = name + "".join(f"[{mark}]" for mark in marked)
    aside = above.aside
    # The headings of an article belong to it.
    if name not in ("body", "html", "article", "main") and not (
        name == "header" and above.content == "article"
    ):
        aside = aside or _is_aside(name, attributes)
    content = above.content
    if name == "article" or (name == "main" and not content):
        content = name
    return Element(
        name,
        f"{above.path}/{own}",
        above.hidden or name in HIDDEN,
        aside,
        content,
        above.link or name == "a",
    )


def _close_before(stack: list[Element], name: str) -> None:
    """Ends what a new element ends without an end tag."""
    if name in BLOCKS:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name == "p":
                del stack[depth:]
                break
            if stack[depth].name in BLOCKS:
                break
    if name in CLOSED_BY:
        ended, holders = CLOSED_BY[name]
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name in holders:
                break
            if stack[depth].name in ended:
                del stack[depth:]
                break


def parse(page: str) -> tuple[Counter, list[Block]]:
    """Start tags with their paths and how often they occur; the visible blocks in order."""
    stack = [Element("", "", False, False, "", False)]
    tags: Counter = Counter()
    blocks: list[Block] = []
    parts: list[tuple[str, bool]] = []
    holder = stack[0]

    def text(raw: str) -> None:
        nonlocal holder
        if raw and not stack[-1].hidden:
            if not parts or len(stack[-1].path) < len(holder.path):
                holder = stack[-1]
            parts.append((html.unescape(raw) if "&" in raw else raw, stack[-1].link))

    def end_block() -> None:
        if parts:
            joined = _SPACE.sub(" ", "".join(part for part, _ in parts)).strip()
            if joined:
                linked = sum(len(part.strip()) for part, link in parts if link)
                blocks.append(
                    Block(holder.path, joined, holder.aside, holder.content, linked, len(tags))
                )
            parts.clear()

    at = 0
    while at < len(page):
        found = _MARKUP.search(page, at)
        if found is None:
            text(page[at:])
            break
        text(page[at : found.start()])
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        if found[1] or found[4]:
            if name in BLOCKS:
                end_block()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    del stack[depth:]
                    break
                if stack[depth].name in BLOCKS and name not in BLOCKS:
                    break
            continue
        if name == "br":
            text(" ")
            continue
        if name in BLOCKS:
            end_block()
            _close_before(stack, name)
        element = _open(stack, name, found[3] or "")
        tags[element.path] += 1
        if name in VOID or (found[3] or "").endswith("/"):
            continue
        stack.append(element)
        if name in RAW:
            closing = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = closing.start() if closing else len(page)
    end_block()
    return tags, blocks


def _hash(*values: object) -> int:
    digest = xxhash.xxh64_intdigest("\0".join(map(str, values)).encode("utf-8", "replace"))
    return digest - (1 << 64) if digest >> 63 else digest


def text_token(block: Block) -> int:
    return _hash("text", block.path, block.text)


def tag_token(path: str) -> int:
    return _hash("tag", path)


def _page_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, page_key, raw, token, parent, times, place, size) of every token of pages with a host.

    `raw` tells pages of one key apart, `place` is that of the first occurrence on the page, and
    `size` counts the characters that a text has in the slots.
    """
    names = ["host", "page", "raw", "token", "parent", "times", "place", "size"]
    for batch in batches:
        columns: list[list] = [[] for _ in names]
        for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            host = host_of(url)
            if host is None or not page:
                continue
            tags, blocks = parse(page)
            key = _hash("page", *(b.text for b in blocks if not b.aside))
            texts = Counter((text_token(b), tag_token(b.path)) for b in blocks)
            seen = [(n, 1, tag_token(path)) for n, path in enumerate(tags)]
            seen += [(block.after, 0, text_token(block)) for block in blocks]
            seen.sort(key=lambda found: found[:2])
            places: dict[int, int] = {}
            for place, (_, _, token) in enumerate(seen):
                places.setdefault(token, place)
            sizes: Counter = Counter()
            for block in _slots(blocks):
                sizes[text_token(block)] += len(block.text)
            rows = [(tag_token(p), None, n) for p, n in tags.items()]
            rows += [(token, parent, n) for (token, parent), n in texts.items()]
            own = (host, key, _hash("raw", page))
            for row in rows:
                for column, value in zip(columns, (*own, *row, places[row[0]], sizes[row[0]]), strict=True):
                    column.append(value)
            if len(columns[0]) > 50_000:
                yield _batch(columns, names)
                columns = [[] for _ in names]
        if columns[0]:
            yield _batch(columns, names)


def _batch(columns: list[list], names: list[str]) -> pa.RecordBatch:
    types = [pa.string(), *[pa.int64()] * 7]
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def near_copies(tokens: DataFrame) -> DataFrame:
    """(host, page, original) of pages with over half of their text on other pages of the host.

    Each shared text speaks for the least page that has it; a page goes to the one that most of
    its text speaks for, and from there on to that page's own. Pages only go to lesser ones.
    """
    texts = tokens.filter("size > 0").select("host", "page", "token", "size")
    shared = (
        texts.groupBy("host", "token")
        .agg(F.min("page").alias("first"), F.max("page").alias("last"))
        .filter("first < last")
        .select("host", "token", "first")
    )
    by_first = (
        texts.join(shared, ["host", "token"], "left")
        .groupBy("host", "page", "first")
        .agg(F.sum("size").alias("size"))
    )
    best = F.max(F.when(F.col("first").isNotNull(), F.struct("size", F.bitwise_not("first"), "first")))
    copies = (
        by_first.groupBy("host", "page")
        .agg(
            F.sum("size").alias("all"),
            F.sum(F.when(F.col("first").isNotNull(), F.col("size"))).alias("shared"),
            best["first"].alias("original"),
        )
        .filter("2 * shared > all and original < page")
        .select("host", "page", "original")
    )
    copies = stored(copies, "near-copies")
    while True:
        above = copies.select("host", F.col("page").alias("original"), F.col("original").alias("next"))
        if copies.join(above, ["host", "original"], "left_semi").isEmpty():
            return copies
        jumped = copies.join(above, ["host", "original"], "left")
        copies = stored(
            jumped.select("host", "page", F.coalesce("next", "original").alias("original")),
            "near-copies",
        )


def deduce_templates(pages: DataFrame) -> DataFrame:
    """(host, template): the text tokens of valid classes that lie in elements of valid classes."""
    tokens = stored(
        pages.select("url", "html").mapInArrow(
            _page_tokens,
            "host string, page long, raw long, token long, parent long, times long, place long, "
            "size long",
        ),
        "page-tokens",
    )
    # Copies of one article are one entry of the vectors.
    own = tokens.join(near_copies(tokens), ["host", "page"], "left")
    entries = (
        own.withColumn("article", F.coalesce("original", "page"))
        .groupBy("host", "token", "parent", "article")
        .agg(F.max("times").alias("times"), F.max("size").alias("size"))
    )
    vectors = stored(
        entries.groupBy("host", "token", "parent").agg(
            F.count("*").alias("support"),
            F.sum(F.xxhash64("article", "times").cast("decimal(38,0)")).alias("vector"),
            F.max("size").alias("size"),
        ),
        "token-vectors",
    )
    # A token of every page: the largest support of a host is its number of pages.
    hosts = vectors.groupBy("host").agg(F.max("support").alias("pages"))
    valid = vectors.join(hosts, "host").filter(
        (F.col("support") >= MIN_PAGES) & (F.col("support") >= MIN_SHARE * F.col("pages"))
    )
    elements = valid.filter("parent is null").select("host", F.col("token").alias("parent"))
    # Only text that would be in a slot is looked for.
    classes = (
        valid.groupBy("host", "vector", "support")
        .agg(F.count("*").alias("members"), F.max("size").alias("size"))
        .filter("members > 1 and size > 0")
    )
    members = stored(
        valid.join(classes.drop("size"), ["host", "vector", "support"]).select(
            "host", "token", "parent", "vector", "support", "size", "members"
        ),
        "class-members",
    )
    # Of near copies, those that lack a member say nothing about the order.
    orders = (
        tokens.select("host", "raw", "token", "place")
        .join(members.drop("parent", "size"), ["host", "token"])
        .groupBy("host", "raw", "vector", "support", "members")
        .agg(F.sort_array(F.collect_set(F.struct("place", "token")))["token"].alias("order"))
        .filter(F.size("order") == F.col("members"))
        .groupBy("host", "vector", "support")
        .agg(F.min(F.xxhash64("order")).alias("least"), F.max(F.xxhash64("order")).alias("most"))
    )
    ordered = orders.filter("least = most").select("host", "vector", "support")
    return (
        members.filter("parent is not null and size > 0")
        .join(ordered, ["host", "vector", "support"], "left_semi")
        .join(elements, ["host", "parent"], "left_semi")
        .groupBy("host")
        .agg(F.collect_set("token").alias("template"))
    )


def _slots(blocks: list[Block]) -> Iterator[Block]:
    """The blocks of the article, or of a page without one."""
    contents = {block.content for block in blocks if not block.aside}
    wanted = "article" if "article" in contents else "main" if "main" in contents else None
    for block in blocks:
        if block.aside or (wanted and block.content != wanted):
            continue
        if not wanted and 2 * block.linked > len(block.text):
            continue
        yield block


def main_text(page: str | None, template: frozenset[int]) -> str:
    """The slots of the article, one block per line."""
    if not page:
        return ""
    _, blocks = parse(page)
    kept = (b for b in _slots(blocks) if not template or text_token(b) not in template)
    return "\n".join(block.text for block in kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [
            main_text(page, frozenset(template or ()))
            for page, template in zip(
                batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True
            )
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
            names=["page_id", "url", "text"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text), one row per input row."""
    templates = stored(deduce_templates(pages), "templates")
    kinds = [pages.schema[name].dataType.simpleString() for name in ("page_id", "url")]

    @F.pandas_udf("string")
    def host(urls: pd.Series) -> pd.Series:
        return urls.map(host_of)

    given = pages.select("page_id", "url", "html", host("url").alias("host"))
    joined = given.join(templates, "host", "left").select("page_id", "url", "html", "template")
    return joined.mapInArrow(_extract, f"page_id {kinds[0]}, url {kinds[1]}, text string")
