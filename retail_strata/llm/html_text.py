"""Main text of web pages: markup zones and a host's suffix array of repeated text.

A page is read into blocks of text. What markup names as a menu, header, footer, sidebar, notice,
advert, form or reader comment is left out, and if the page names its article (``article``, else
``main``, else an element called so), its text is sought in the article's blocks, elsewhere in those
that markup leaves open. What of them is boilerplate the text of the host's pages decides. Every page
gives the token stream of its frame: all that is outside its article, or its open blocks if it names
none. The streams are laid end to end, and suffixes that share their first ``DEPTH`` tokens stand
together. Where frames of ``PAGES`` different texts share such a beginning, those tokens are
boilerplate; the overlapping beginnings add up to the whole repeated substrings. They are cut out and
the runs unique to the page are kept. Ordering suffixes no deeper than ``DEPTH`` finds the same cover
as the full order and lets equal beginnings be counted by key, with partial sums before the shuffle,
so a host with a third of all pages is no single task's work.

Within articles, boilerplate is cut only where it also stands in articles of ``PAGES`` different texts:
a notice that the host puts into its pages. What no frames hold is never cut from an article, as copies
of an article are text, nor is what frames quote from one or two.
Character references are decoded, white space in a block is one space, blocks are joined by one.
Null and empty pages have an empty text. A null url is a host of its own; repeated rows and pages
with the same text give a row each and count as one page of the cover. An empty table gives no
rows. Only the named columns are read.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_strata.llm.common import U64, HashFilter, as_long, mix, stage, utf8, word_hashes
from retail_strata.llm.decontaminate import text_key

#: Tokens of a suffix that are compared, and different pages that must share them.
DEPTH, PAGES = 8, 3

# Elements whose content is no text, without an end tag, that stand in a line of
# text, that are never part of the article, and names and roles that say the same.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math"}
RAW |= {"object", "canvas", "audio", "video", "select", "head"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param"}
VOID |= {"source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn"}
INLINE |= {"em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small"}
INLINE |= {"span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "ruby", "rt"}
CHROME = {"nav", "footer", "aside", "form", "button", "dialog", "menu", "fieldset"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert"}
CHROME_ROLES |= {"alertdialog", "menu", "menubar", "form"}
CHROME_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor"}
CHROME_NAMES |= {"sponsored", "promo", "promotion", "banner", "cookie", "cookies", "consent"}
CHROME_NAMES |= {"gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay"}
CHROME_NAMES |= {"newsletter", "subscribe", "subscription", "signup", "sidebar", "widget", "menu"}
CHROME_NAMES |= {"nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead"}
CHROME_NAMES |= {"comment", "comments", "respond", "reply", "replies", "disqus", "share", "sharing"}
CHROME_NAMES |= {"social", "related", "recommended", "pagination", "pager", "toolbar", "topbar"}
HEADER_NAMES = {"header", "head", "top"}
ARTICLE_NAMES = {"article", "articlebody", "post", "entry", "story"}
READER_NAMES = {"comment", "comments", "respond", "reply", "replies", "disqus"}
# Last words of a compound name that say what kind of box the first word fills, and
# last words that make a compound name the body of an article.
BOXES = {"area", "bar", "block", "box", "container", "content", "form", "inner", "item", "items"}
BOXES |= {"label", "links", "list", "panel", "section", "slot", "space", "text", "top", "unit"}
BOXES |= {"widget", "wrap", "wrapper"}
BODIES = {"body", "content", "main", "text"}
# First words of a compound name that tell of a state, as in ``has-sidebar``.
STATES = {"has", "hide", "is", "no", "not", "show", "with", "without"}

#: Zones of a block: chrome by its markup, inside the article, or neither.
CHROME_ZONE, ARTICLE_ZONE, OPEN_ZONE = 0, 1, 2

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|</?[a-zA-Z][^<>]*\Z",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""")
_NAME_PARTS = re.compile(r"[^a-z0-9]+")
_END_TAGS = {name: re.compile(f"</{name}(?![a-z0-9])", re.I | re.A) for name in RAW}

#: How an element hides its text: not at all, by a name around the article, by a name, for certain.
SHOWN, NAMED_AROUND, NAMED, HIDDEN = 0, 1, 2, 3


def _named(attributes: str) -> tuple[list[list[str]], set[str]]:
    """The names in class, id and itemprop, each as its words, and the roles."""
    names, roles = [], set()
    for kind, value in _ATTRIBUTE.findall(attributes):
        kind = kind.lower()
        if kind in ("class", "id", "itemprop"):
            for name in value.strip("\"'").lower().split():
                words = [w for w in _NAME_PARTS.split(name) if w and not w.isdigit()]
                names += [words] if words else []
        elif kind == "role":
            roles.update(value.strip("\"'").lower().split())
    return names, roles


def frame_name(words: list[str], known: set[str]) -> bool:
    """Whether a name says that its element is part of the page's frame.

    One word has to be known. Of several the last has to be, or the first with a box for the last
    (``ad-slot``); a name that tells of a state (``has-sidebar``, ``share-enabled``) says nothing.
    """
    if words[0] in STATES:
        return False
    return words[-1] in known or words[0] in known and words[-1] in BOXES


def article_name(words: list[str]) -> bool:
    """Whether a name says that its element is the article: ``post``, ``post-body``, ``blog-post``."""
    if words[0] in STATES or any(w in CHROME_NAMES for w in words):
        return False
    return words[-1] in ARTICLE_NAMES or words[0] in ARTICLE_NAMES and words[-1] in BODIES


def _signs(attributes: str) -> tuple[bool, bool, bool, bool, bool, bool, bool]:
    """What names and roles say of an element.

    Reader comments, chrome by role, chrome by name, a header, an article by role, the main part by
    role, an article by name.
    """
    names, roles = _named(attributes)
    return (
        any(frame_name(w, READER_NAMES) for w in names),
        bool(roles & CHROME_ROLES),
        any(frame_name(w, CHROME_NAMES) for w in names),
        any(frame_name(w, HEADER_NAMES) for w in names),
        "article" in roles,
        "main" in roles,
        any(article_name(w) for w in names),
    )


_NO_SIGNS = _signs("")
#: The same, remembered for attributes of at most ``SHORT`` characters, which pages repeat.
_short_signs = lru_cache(maxsize=1 << 13)(_signs)
SHORT = 256


def blocks_of(page: str, links: list[str] | None = None) -> list[tuple[str, int]]:
    """``(text, zone)`` of the blocks of a page that hold text, in page order.

    The zone is ``ARTICLE_ZONE`` only within the best article element that the page names. A class or
    id around ``article`` or ``main`` does not hide these where no other is in sight. The addresses
    that the page's ``a`` elements name are added to ``links``, as they are written.
    """
    found: list[tuple[str, int, int]] = []  # text, how it is hidden, rank of the article
    line: list[str] = []
    stack: list[tuple[str, int, int]] = []  # name, how it is hidden, rank of the article
    chrome, rank = SHOWN, 0

    def close() -> None:
        if not line:
            return
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            found.append((text, chrome, rank))

    at, raw = 0, None
    while at <= len(page):
        if raw is not None:  # nothing counts up to its end tag
            end = _END_TAGS[raw].search(page, at)
            raw = None
            if end is None:
                break
            at = end.start()
        match = _TAG.search(page, at)
        text = page[at : match.start()] if match else page[at:]
        if text:
            line.append(html.unescape(text))
        if match is None:
            break
        at = match.end()
        ends, name, attributes = match.groups("")
        name = name.lower()
        if not name or name in VOID:
            if name in ("br", "hr"):
                line.append(" ")
            continue
        if ends:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if name not in INLINE or chrome != (stack[k - 1][1] if k else SHOWN):
                        close()
                    del stack[k:]
                    chrome, rank = stack[-1][1:] if stack else (SHOWN, 0)
                    break
                if name in INLINE and stack[k][0] not in INLINE:
                    break  # it does not reach out of its block
            continue
        if name in RAW and name != "head":
            raw = name
            continue
        if attributes.endswith("/") and name in INLINE:
            continue
        if links is not None and name == "a":
            links += [
                html.unescape(value[1:-1] if value[0] in "\"'" else value)
                for kind, value in _ATTRIBUTE.findall(attributes)
                if kind.lower() == "href"
            ][:1]
        signs = _NO_SIGNS
        if attributes:
            signs = _short_signs(attributes) if len(attributes) <= SHORT else _signs(attributes)
        readers, chrome_role, chrome_named, header_named, article_role, main_role, article_named = signs
        if name not in INLINE:
            close()
            if stack and stack[-1][0] == "p":  # a paragraph ends where a block begins
                stack.pop()
                chrome, rank = stack[-1][1:] if stack else (SHOWN, 0)
        inner, level = chrome, rank
        if name not in ("html", "body"):
            whole = name in ("article", "main")
            if name in CHROME or chrome_role or readers:
                inner = HIDDEN
            elif whole:
                inner = NAMED_AROUND if inner == NAMED else inner
            elif chrome_named:
                inner = max(inner, NAMED)
            if not level and not whole:
                if name == "header":
                    inner = HIDDEN
                elif header_named:
                    inner = max(inner, NAMED)
            if inner < NAMED:
                if name == "article" or article_role:
                    level = max(level, 3)
                elif name == "main" or main_role:
                    level = max(level, 2)
                elif article_named:
                    level = max(level, 1)
        if inner != chrome:
            close()
        stack.append((name, inner, level))
        chrome, rank = inner, level
    close()
    seen = max((r for _, c, r in found if c == SHOWN), default=0)
    most = SHOWN if seen > 1 else NAMED_AROUND
    best = max((r for _, c, r in found if c <= most), default=0)
    return [
        (text, CHROME_ZONE if c > most else ARTICLE_ZONE if best and r >= best else OPEN_ZONE)
        for text, c, r in found
    ]


def has_article(blocks: list[dict]) -> bool:
    return any(b["zone"] == ARTICLE_ZONE for b in blocks)


def open_blocks(blocks: list[dict]) -> list[str]:
    """Texts that markup does not exclude and whose fate the cover decides: the article, if there is one."""
    zone = ARTICLE_ZONE if has_article(blocks) else OPEN_ZONE
    return [b["text"] for b in blocks if b["zone"] == zone]


def frame_blocks(blocks: list[dict]) -> list[str]:
    """Texts whose repeats are boilerplate: all outside the article, or the open ones without one."""
    if has_article(blocks):
        return [b["text"] for b in blocks if b["zone"] != ARTICLE_ZONE]
    return open_blocks(blocks)


def stream(texts: list[str], host: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a page's tokens, and of the first ``DEPTH`` tokens of each suffix at its host."""
    offsets, data = utf8(pa.array([" ".join(texts)], pa.string()))
    words, _ = word_hashes(offsets, data)
    places = len(words) - DEPTH + 1
    if places <= 0:
        return words, np.zeros(0, dtype=U64)
    factors = mix(np.arange(1, DEPTH + 1, dtype=U64)) | U64(1)
    begin = np.zeros(places, dtype=U64)
    for k in range(DEPTH):
        begin += words[k : k + places] * factors[k]
    site, _ = word_hashes(*utf8(pa.array([f"host:{host}"], pa.string())))
    return words, mix(begin ^ site[0])


def read_blocks(pages: DataFrame) -> DataFrame:
    """``(row, id, url, host, blocks)`` of every page."""
    kind = pages.schema["id"].dataType.simpleString()

    def read(batches):
        zones = pa.list_(pa.struct([("text", pa.string()), ("zone", pa.int32())]))
        for batch in batches:
            found = [
                [{"text": t, "zone": z} for t, z in blocks_of(page or "")]
                for page in batch["html"].to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in ("row", "id", "url", "host")] + [pa.array(found, zones)],
                ["row", "id", "url", "host", "blocks"],
            )

    return pages.mapInArrow(
        read,
        f"row bigint, id {kind}, url string, host string,"
        " blocks array<struct<text:string,zone:int>>",
    )


def repeated_suffixes(pages: DataFrame) -> DataFrame:
    """``(suffix)``: beginnings of suffixes that frames of ``PAGES`` different texts of a host share."""

    def suffixes(batches):
        for batch in batches:
            for host, blocks in zip(batch["host"].to_pylist(), batch["blocks"].to_pylist(), strict=True):
                words, begin = stream(frame_blocks(blocks), host)
                begin = np.unique(begin)
                if len(begin):
                    text = pa.array([text_key(words)] * len(begin), pa.int64())
                    yield pa.RecordBatch.from_arrays([as_long(begin), text], ["suffix", "text"])

    each = pages.select("host", "blocks").mapInArrow(suffixes, "suffix bigint, text bigint")
    counts = each.groupBy("suffix", "text").agg(F.lit(1).alias("one")).groupBy("suffix")
    return counts.agg(F.count("one").alias("pages")).where(F.col("pages") >= PAGES).select("suffix")


def covered_places(pages: DataFrame, repeated: DataFrame) -> DataFrame:
    """``(row, places)``: where in the stream of a page's open blocks repeated beginnings are."""
    held = pages.sparkSession.sparkContext.broadcast(HashFilter.of(repeated, "suffix"))

    def places(batches):
        for batch in batches:
            for row, host, blocks in zip(
                *(batch[c].to_pylist() for c in ("row", "host", "blocks")), strict=True
            ):
                words, begin = stream(open_blocks(blocks), host)
                at = np.flatnonzero(held.value.has(begin))
                if len(at):
                    inside = text_key(words) if has_article(blocks) else None
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row] * len(at), pa.int64()), pa.array(at, pa.int64())]
                        + [as_long(begin[at]), pa.array([inside] * len(at), pa.int64())],
                        ["row", "place", "suffix", "inside"],
                    )

    found = pages.select("row", "host", "blocks").mapInArrow(
        places, "row bigint, place bigint, suffix bigint, inside bigint"
    )
    found = stage(found.join(repeated, "suffix"), "places")
    texts = found.where(F.col("inside").isNotNull()).groupBy("suffix", "inside").agg(F.lit(1).alias("one"))
    shared = texts.groupBy("suffix").agg(F.count("one").alias("texts")).where(F.col("texts") >= PAGES)
    boilerplate = found.where(F.col("inside").isNull()).unionByName(
        found.where(F.col("inside").isNotNull()).join(shared.select("suffix"), "suffix", "left_semi")
    )
    return boilerplate.groupBy("row").agg(F.collect_list("place").alias("places"))


def unique_runs(texts: list[str], places: list[int]) -> list[str]:
    """The texts without the tokens that the repeated beginnings cover."""
    tokens = [re.findall(r"[^\x20\x09-\x0d]+", t) for t in texts]
    covered = np.zeros(sum(map(len, tokens)), dtype=bool)
    for place in places:
        covered[place : place + DEPTH] = True
    kept, at = [], 0
    for words in tokens:
        kept.append(" ".join(w for k, w in enumerate(words) if not covered[at + k]))
        at += len(words)
    return kept


def main_text(df: DataFrame, id_column: str, url: str, page: str) -> DataFrame:
    """``(id, url, text, n_chars)`` of every page."""
    pages = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).alias("id"),
        F.col(url).alias("url"),
        F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.col(page).alias("html"),
    )
    blocks = stage(read_blocks(pages), "blocks")
    kind = blocks.schema["id"].dataType.simpleString()
    covered = stage(covered_places(blocks, stage(repeated_suffixes(blocks), "suffixes")), "covered")

    def joined(batches):
        for batch in batches:
            texts = []
            for parts, places in zip(
                batch["blocks"].to_pylist(), batch["places"].to_pylist(), strict=True
            ):
                kept = open_blocks(parts)
                kept = unique_runs(kept, places) if places else kept
                texts.append(" ".join(t for t in kept if t))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["url"], pa.array(texts, pa.string())]
                + [pa.array([len(t) for t in texts], pa.int64())],
                ["id", "url", "text", "n_chars"],
            )

    return (
        blocks.join(covered, "row", "left")
        .select("id", "url", "blocks", "places")
        .mapInArrow(joined, f"id {kind}, url string, text string, n_chars bigint")
        .withColumnRenamed("id", id_column)
    )
