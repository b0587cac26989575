"""Main text of web pages by equivalence-class template deduction.

1. Every page becomes tokens: the path of each element (tag names with all their classes),
   and each text block under its path. A token's occurrence vector says how often it stands
   on each of the host's pages. Vectors are not gathered: their digest, two sums over pages of
   hashes of page and count, is added up natively before the shuffle, so a host with a third
   of all pages is no larger a group than any other. Equal contents of a host count once.
2. Tokens of a host with the same digest are an equivalence class; classes on at least half
   of the host's pages (and ``least_pages``) are frequent. A class is valid as far as
   it nests: it holds a text's own element path too, so that the text comes and goes with a
   piece of page structure. Paths nest by their making, so the valid frequent classes nest into the host's template: element paths,
   the fixed texts of valid classes, and the *fixed paths*, on which every block is a text
   of half of the pages.
3. Text between template tokens fills its slots; each page's remaining slots are extracted.
   Inside an ``article`` or ``main`` element only fixed paths are template, and only through a
   further ``div``, ``section`` or ``span``, for a sentence or a heading
   that many articles share is text all the same; elsewhere fixed texts are as well. What remains
   also loses the elements that their tag, role or classes declare to be menus, headers,
   footers, sidebars, notices, adverts, forms, scripts, styles or reader comments; a class
   counts if all of its parts are such words or neutral ones. If ``article`` and ``main`` elements hold
   half of the remaining characters or more, the page's text is theirs; otherwise all of it.

Character references are decoded, white space in a block becomes one space, blocks are
trimmed and joined by one line break in page order.

Defined cases: null and empty pages and pages without text give the empty string; broken
and cut-off markup is read as far as it goes; null urls share the empty host; a host with
fewer than ``least_pages`` different pages has no template; each page is extracted; null ids
are carried through and rows that repeat an id are extracted one by one; an empty table gives
no rows. Other columns are left out.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_rows, materialize

#: A comment, a declaration, a start or end tag (quotes count only after "="), or a tag cut off.
TAG = re.compile(r"<!--(?s:.*?)(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|\Z)|</[^>]*(?:>|\Z)")
ATTRIBUTE = re.compile(r"([^\s=>/\"'][^\s=>/]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")

# Element names and class words of the HTML standard and of common use.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split())
CELLS = frozenset(("td", "th", "br"))
CLOSES_P = BLOCKS - {"html", "body", "caption", "tbody", "tfoot", "thead", "tr", "legend"}
DROPPED = frozenset("aside button canvas datalist dialog embed footer form head iframe input menu nav noscript object script search select style svg template textarea title audio video".split())
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
DROPPED_CLASSES = frozenset("ad ads adv advert advertisement advertising adverts banner banners breadcrumb breadcrumbs comment comments commentlist consent discussion discussions cookie cookiebar cookies disqus footer form gdpr masthead menu menubar modal nav navbar navigation newsletter notice notices popup promo promoted promotion replies reply respond share sharing sidebar sidenav signup social sponsor sponsored subscribe toolbar topbar widget".split())
NEUTRAL_PARTS = frozenset("area bar block box bottom bottoms center col column container content footer global group header holder inner item left link links list main message outer page panel right row section site slot text top unit wrap wrapper zone".split())
NEVER_DROPPED = frozenset(("html", "body", "main", "article"))
CONTAINERS = frozenset(("article", "main"))
GENERIC = frozenset(("div", "section", "span"))
LANDMARKS = frozenset("article main nav header footer h1".split())
#: Where a block stands: outside containers, in one, in a generic element of one.
OUTSIDE, INSIDE, BOXED = range(3)


def is_dropped(tag: str, attributes: str) -> bool:
    """Do the element's name, role, class or id declare it not to be main text?"""
    if tag in DROPPED:
        return True
    if not attributes or tag in NEVER_DROPPED:
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "role" and value.strip() in DROPPED_ROLES:
            return True
        if name in ("class", "id"):
            for word in value.split():
                parts = [p for p in re.split(r"[-_\d]+", word) if p]
                if any(p in DROPPED_CLASSES for p in parts) and all(p in DROPPED_CLASSES or p in NEUTRAL_PARTS for p in parts):
                    return True
    return False


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class Block:
    """Text of one block: where it stands, and what stands around it."""

    __slots__ = ("dropped", "forms", "path", "text", "within")

    def __init__(self, path: int, text: str, within: int, dropped: bool, forms: list["Form"]):
        self.path, self.text, self.within, self.dropped, self.forms = path, text, within, dropped, forms


class Form:
    """A form that is open, and whether it is the wrapper of a page."""

    __slots__ = ("depth", "wraps")

    def __init__(self, depth: int):
        self.depth, self.wraps = depth, False


def parse(page: str) -> tuple[Counter, list[Block]]:
    """(how often each element path occurs, blocks of text in page order).

    A path's name is a hash of its last element and of the name of what is above it.
    """
    paths: Counter = Counter()
    blocks: list[Block] = []
    stack: list[tuple[str, int, int, bool]] = []  # tag, path, where, dropped
    inline: list[str] = []
    forms: list[Form] = []

    def flush() -> None:
        if inline:
            text = " ".join("".join(inline).split())
            inline.clear()
            if text:
                at = next((s for s in reversed(stack) if s[0] in BLOCKS), None)
                top = stack[-1] if stack else ("", 0, OUTSIDE, False)
                blocks.append(Block(at[1] if at else 0, text, top[2], top[3], list(forms)))

    def close_to(depth: int) -> None:
        if any(s[0] in BLOCKS or s[3] for s in stack[depth:]):
            flush()
        del stack[depth:]
        while forms and forms[-1].depth >= depth:
            forms.pop()

    pos, end = 0, len(page)
    while pos < end:
        m = TAG.search(page, pos)
        if m is None:
            inline.append(entities.unescape(page[pos:]))
            break
        if m.start() > pos:
            inline.append(entities.unescape(page[pos : m.start()]))
        pos = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag in BLOCKS:
                flush()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    close_to(depth)
                    break
                if stack[depth][0] in ("td", "th", "table") and tag not in ("table", "tr", "td", "th", "tbody", "thead", "tfoot", *CONTAINERS, "body", "html", "section", "div"):
                    break
            if tag in CELLS:
                inline.append(" ")
            continue
        attributes = m[3]
        if tag in BLOCKS:
            flush()
            if tag in CLOSES_P:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == "p":
                        close_to(depth)
                        break
                    if stack[depth][0] in BLOCKS:
                        break
            if tag in ("li", "dt", "dd", "tr"):
                same = ("dt", "dd") if tag != "li" and tag != "tr" else (tag,)
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] in same:
                        close_to(depth)
                        break
                    if stack[depth][0] in ("ul", "ol", "dl", "table", "menu", "div", "section", "article"):
                        break
        elif tag in CELLS:
            inline.append(" ")
        parent = stack[-1] if stack else ("", 0, OUTSIDE, False)
        if tag in LANDMARKS:
            for form in forms:
                form.wraps = True
        dropped = parent[3] or tag != "form" and is_dropped(tag, attributes) or (tag == "header" and not parent[2])
        if dropped and not parent[3] and tag not in VOID:
            flush()
        classes = " ".join(sorted({w for n, *v in ATTRIBUTE.findall(attributes) if n.lower() == "class" for w in "".join(v).split()})) if attributes else ""
        path = signed(xxhash.xxh64_intdigest(f"{tag} {classes}".encode("utf-8", "surrogatepass"), parent[1] & (1 << 64) - 1))
        paths[path] += 1
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, pos)
            pos = close.start() if close else end
            if close:
                gt = page.find(">", pos)
                pos = gt + 1 if gt >= 0 else end
            continue
        if tag not in VOID and not (attributes.endswith("/") and tag in ("svg", "path")):
            if tag == "form":
                forms.append(Form(len(stack)))
            stack.append((tag, path, INSIDE if tag in CONTAINERS else BOXED if parent[2] and tag in GENERIC else parent[2], dropped))
    flush()
    for b in blocks:
        b.dropped = b.dropped or not all(form.wraps for form in b.forms)
    return paths, blocks


def text_token(block: Block) -> int:
    return signed(xxhash.xxh64_intdigest(block.text.encode("utf-8", "surrogatepass"), (block.path + 1) & (1 << 64) - 1))


def main_text(page: str | None, texts: frozenset[int] = frozenset(), paths: frozenset[int] = frozenset()) -> str:
    """The page's main text, given its host's fixed texts and fixed paths."""
    fixed = lambda b: b.within != INSIDE and (b.within == OUTSIDE or b.path in paths) and text_token(b) in texts
    return "\n".join(b.text for b in parse(page or "")[1] if not b.dropped and not fixed(b))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


#: Kinds of tokens: one for the page itself, an element path, the blocks of a path, a text block.
PAGE, ELEMENT, SLOT, TEXT = range(4)


def tokens(pages: DataFrame, *, url_col: str, html_col: str) -> DataFrame:
    """(host, page, kind, token, path, n) of every page; page is a hash of the content, path that of a text's block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for host, page, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                paths, blocks = parse(text or "")
                rows.append((host, page, PAGE, 0, 0, 1))
                rows += [(host, page, ELEMENT, p, 0, n) for p, n in paths.items()]
                rows += [(host, page, SLOT, p, p, n) for p, n in Counter(b.path for b in blocks).items()]
                rows += [(host, page, TEXT, t, p, n) for (t, p), n in Counter((text_token(b), b.path) for b in blocks).items()]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["host", "page", "kind", "token", "path", "n"])

    named = pages.select(F.xxhash64(host_of(F.col(url_col))).alias("host"), F.xxhash64(html_col).alias("page"), F.col(html_col).alias("html"))
    return map_rows(named, run, T._parse_datatype_string("host long, page long, kind int, token long, path long, n long"))


def templates(pages: DataFrame, *, url_col: str = "url", html_col: str = "html", least_pages: int = 3) -> DataFrame:
    """(host, texts, paths): the fixed texts and fixed paths of each host's template; host is a hash of its name.

    A host's row holds tokens of half of its pages or more, so at most twice a page's tokens.
    """
    rows = tokens(pages, url_col=url_col, html_col=html_col).groupBy("host", "page", "kind", "token", "path").agg(F.max("n").alias("n"))  # equal contents once
    vector = F.xxhash64("page", "n")
    parts = [F.sum(F.shiftrightunsigned(vector, 32)).alias("d0"), F.sum(vector.bitwiseAND(F.lit(0xFFFFFFFF))).alias("d1")]
    seen = rows.groupBy("host", "kind", "token", "path").agg(*parts, F.count(F.lit(1)).alias("support"), F.sum("n").alias("total")).where(F.col("support") >= least_pages)
    seen = materialize(seen, "vectors")
    sizes = seen.where(F.col("kind") == PAGE).select("host", F.col("support").alias("pages"))
    frequent = materialize(seen.join(sizes, "host").where("support * 2 >= pages"), "classes")
    texts = frequent.where(F.col("kind") == TEXT)
    # valid classes: a text and its own element path with the same vector
    structure = frequent.where(F.col("kind") == ELEMENT).select("host", F.col("token").alias("path"), "d0", "d1", "support")
    slots = seen.where(F.col("kind") == SLOT).select("host", "path", F.col("total").alias("blocks"))
    fixed = texts.groupBy("host", "path").agg(F.sum("total").alias("fixed")).join(slots, ["host", "path"]).where("fixed >= blocks").select("host", "path")
    every = texts.join(structure, ["host", "path", "d0", "d1", "support"], "left_semi").select("host", "token").union(texts.join(fixed, ["host", "path"], "left_semi").select("host", "token"))
    by_host = every.groupBy("host").agg(F.collect_set("token").alias("texts"))
    return by_host.join(fixed.groupBy("host").agg(F.collect_set("path").alias("paths")), "host", "left").select("host", "texts", F.coalesce("paths", F.array().cast("array<bigint>")).alias("paths"))


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_pages: int = 3, most_broadcast: int = 4 << 20) -> DataFrame:
    """(id, url, text, n_chars) of every page.

    Templates of up to ``most_broadcast`` tokens in all are broadcast; more are joined
    by a shuffle on the host, whose large partitions Spark can split.
    """
    found = materialize(templates(pages, url_col=url_col, html_col=html_col, least_pages=least_pages), "templates").select(F.col("host").alias("__host"), "texts", "paths")
    size = found.agg(F.sum(F.size("texts") + F.size("paths"))).first()[0] or 0
    if size <= most_broadcast:
        found = F.broadcast(found)
    joined = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), F.xxhash64(host_of(F.col(url_col))).alias("__of"))
    joined = joined.join(found, F.col("__of") == F.col("__host"), "left").select("id", "url", "html", "__of", "texts", "paths")
    schema = T.StructType([T.StructField(id_col, pages.schema[id_col].dataType), T.StructField(url_col, pages.schema[url_col].dataType), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, template = None, (frozenset(), frozenset())
        for batch in batches:
            texts = []
            for i, (page, of) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                if of != host:
                    host, template = of, tuple(frozenset(batch.column(k)[i].as_py() or ()) for k in (4, 5))
                texts.append(main_text(page, *template))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    return map_rows(joined, run, schema)
