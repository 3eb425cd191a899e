"""Main text of web pages by site style trees.

The pages of a host are merged by style: a node is a path of elements with their
names and class, id and role marks. A node's content importance falls with the entropy of its
texts over the host's pages (a text that all pages share says nothing), its
presentation importance rises with the entropy of its child styles. All of a page is merged; markup that names
a menu, footer, advert and so on, and a place outside of the page's articles, lower the importance of a text. Texts of
low composite importance are cut, so a branch goes if all in it are low.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

LEAST_PAGES = 5  # pages that must hold a node before its entropy counts
THRESHOLD = 0.25  # composite importance below which a text is cut
MARKED = 0.2  # weight of texts in markup that names furniture: below the threshold, as menus and adverts may differ on every page
OUTSIDE = 0.5  # weight of texts outside of article and main elements, on pages that have text in them
HINTED = 0.5  # weight of texts in markup whose names have such a word beside words of contents, as social-security has: the pages' tree decides
OWN = 0.1  # weight of a node's presentation against that of its contents

# HTML elements by their role in a document.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCKS = set(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
              "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul").split())
FURNITURE = set("nav footer aside form head menu button select dialog svg canvas object audio video map datalist".split())
CELLS = {"tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}  # which innermost scope a new row or cell ends
SCOPES = set("ul ol dl table tbody thead tfoot tr select body article section div main aside nav footer header form td th".split())
ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
MARKS = set(("ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus "
             "footer gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices notification pager pagination popup "
             "promo promotion related reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar topbar widget").split())
# Words that go with a mark's word in names of furniture, as in nav-list or ad-slot-2.
PARTS = set(("area article articles author avatar bar block body bottom box button buttons card cards col column columns container content count date desktop facebook form global google "
             "group icon icons inline inner input item items label leaderboard left link links list local mail email main meta mobile module network news outer panel post posts primary "
             "right row section secondary signup site slot small span stories story tab tabs text title top twitter ul unit up user wide widget widgets wrap wrapper zone").split())
LAYOUT = set("fixed has layout no page sticky with without wrapper".split())  # in a name, they say what a whole page looks like

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<([a-zA-Z][^\s/>]*)([^>]*)>|([^<]+)|<", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:.-]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


GROUPS = {"p": 0, "li": 1, "dt": 2, "dd": 2, "option": 3}  # elements that a new one of their group ends, within a scope


class Node:
    """An open element: its style path, how its markup weighs, and where the stack holds what later elements look for.

    scope and block are the stack's indices of the innermost scope and block, itself included; near those of the innermost open
    paragraph, list item, term and option in its scope. So an element is placed in constant time at any depth.
    """

    __slots__ = ("tag", "path", "weight", "main", "children", "scope", "block", "near")

    def __init__(self, tag: str, path: int, weight: float, main: bool, at: int = 0, up: "Node | None" = None):
        self.tag, self.path, self.weight, self.main, self.children = tag, path, weight, main, set()
        self.scope = at if tag in SCOPES or up is None else up.scope
        self.block = at if tag in BLOCKS or up is None else up.block
        self.near = (-1, -1, -1, -1) if tag in SCOPES or up is None else up.near
        if tag in GROUPS:
            k = GROUPS[tag]
            self.near = (*self.near[:k], at, *self.near[k + 1 :])


def _path(parent: int, style: str) -> int:
    """64 bits that name a style below another."""
    return int.from_bytes(hashlib.blake2b(f"{parent}>{style}".encode(), digest_size=8).digest(), "big", signed=True)


def _style(tag: str, raw: str, inside_article: bool) -> tuple[str, float]:
    """(style of an element, the weight of its texts by its markup: MARKED, HINTED or 1)."""
    found = {}
    for m in _ATTRIBUTE.finditer(raw):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    names = f"{found.get('class', '')} {found.get('id', '')}"
    named = [{x.lower() for x in _PART.findall(name)} for name in names.split()]
    marked = [name for name in named if name & MARKS and not name & LAYOUT and not (inside_article and name & MARKS == {"header"})]
    if tag in ("html", "body"):
        marked = []
    role = found.get("role", "").lower()
    furniture = (tag in FURNITURE or tag == "header" and not inside_article or any(name <= MARKS | PARTS for name in marked)
                 or role in ROLES or "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower())
    weight = MARKED if furniture else HINTED if marked else 1.0
    label = re.sub(r"\d+", "0", names).split()
    return tag + "".join(sorted(f".{x}" for x in label)) + (f"@{role}" if role else ""), weight


def parse(page: str) -> tuple[list[tuple[int, str, bool]], dict[int, set[str]]]:
    """Blocks (style path, text, in an article or main element) outside furniture, in page order; and styles: path -> child styles."""
    blocks, styles = parse_all(page)
    return [(path, text, main) for path, text, main, weight in blocks if weight > MARKED], styles


def parse_all(page: str) -> tuple[list[tuple[int, str, bool, float]], dict[int, set[str]]]:
    """Blocks (style path, text, in an article or main element, weight by markup) of the whole page, in page order; and styles: path -> child styles."""
    stack = [Node("", 0, 1.0, False)]
    blocks: list[tuple[int, str, bool, float]] = []
    styles: dict[int, set[str]] = {}
    text: list[str] = []
    inline: dict[int, list[str]] = {}  # texts of furniture that stands in a line, by its path
    owner = stack[0]
    opened: Counter[str] = Counter()

    def flush() -> None:
        nonlocal text
        for path, parts, weight in [(owner.path, text, owner.weight), *((k, x, MARKED) for k, x in inline.items())]:
            joined = " ".join(entities.unescape("".join(parts)).split())
            if joined:
                blocks.append((path, joined, owner.main, weight))
        text = []
        inline.clear()

    def write(x: str) -> None:
        (inline.setdefault(stack[-1].path, []) if stack[-1].weight <= MARKED < owner.weight else text).append(x)

    def close(k: int) -> None:
        nonlocal owner
        if any(n.tag in BLOCKS for n in stack[k:]):
            flush()
        for node in stack[k:]:
            styles.setdefault(node.path, set()).update(node.children)
            opened[node.tag] -= 1
        del stack[k:]
        owner = stack[stack[-1].block]

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.match(page, at)
        at = m.end()
        if m[6] is not None:
            write(m[6])
            continue
        tag = m[2] or m[4]
        if tag:
            tag, raw = tag.lower(), m[3] if m[2] else m[5]
            if tag in RAW:
                end = re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
                at = end.end() if end else size
                continue
            if tag == "br":
                text.append(" ")
                continue
            if tag in GROUPS and tag != "p" and (k := stack[-1].near[GROUPS[tag]]) > 0:
                close(k)
            elif tag in CELLS and (k := stack[-1].scope) > 0 and stack[k].tag in CELLS[tag]:
                close(k)
            if tag in BLOCKS:
                if (k := stack[-1].near[GROUPS["p"]]) > 0:  # a paragraph ends where a block begins
                    close(k)
                flush()
            up = stack[-1]
            style, weight = _style(tag, raw, up.main)
            up.children.add(style)
            if tag in VOID:
                continue
            node = Node(tag, _path(up.path, style), min(up.weight, weight), up.main or tag in ("article", "main"), len(stack), up)
            stack.append(node)
            opened[tag] += 1
            if tag in BLOCKS:
                owner = node
        elif m[1]:
            tag = m[1].lower()
            if tag == "p" and not opened["p"]:
                flush()
            if opened[tag]:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
        elif m[0] == "<":
            write("<")
    flush()
    close(1)
    return blocks, styles


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = pa.list_(pa.struct([("path", pa.int64()), ("text", pa.string()), ("weight", pa.float64())]))
    style = pa.list_(pa.struct([("path", pa.int64()), ("children", pa.string())]))
    for batch in batches:
        found, trees = [], []
        for page in batch.column("html"):
            blocks, styles = parse_all(page.as_py() or "")
            outside = OUTSIDE if any(main and weight > MARKED for _, _, main, weight in blocks) else 1.0
            found.append([{"path": p, "text": t, "weight": weight if main or weight <= MARKED else min(weight, outside)} for p, t, main, weight in blocks])
            trees.append([{"path": p, "children": " ".join(sorted(styles[p]))} for p in sorted({x[0] for x in blocks}) if p in styles])
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), batch.column("host"), pa.array(found, block), pa.array(trees, style)], ["page_id", "url", "host", "blocks", "styles"])


def low_nodes(pages: DataFrame, *, least_pages: int = LEAST_PAGES, below: float = THRESHOLD / OUTSIDE) -> DataFrame:
    """(host, low): a map of style paths of text to their composite importance, where it is below ``below``, from parsed pages.

    Pages of a host with the same blocks outside furniture count as one. Per host and path: content importance 1 - mean over texts of log(pages
    with the text) / log(pages with the path), presentation importance the
    entropy of child styles over log(pages).
    """
    near = pages.where("host is not null").select(
        "host", F.xxhash64(F.transform(F.filter("blocks", lambda b: b["weight"] > MARKED), lambda b: F.struct(b["path"], b["text"]))).alias("page"),
        F.array_distinct(F.transform("blocks", lambda b: F.struct(b["path"].alias("path"), F.xxhash64(b["text"]).alias("t")))).alias("texts"),
        F.transform("styles", lambda s: F.struct(s["path"].alias("path"), F.xxhash64(s["children"]).alias("kids"))).alias("styles"))
    near = near.groupBy("host", "page").agg(F.min("texts").alias("texts"), F.min("styles").alias("styles"))  # copies of a page are one
    shown = near.select("host", F.explode("styles").alias("s")).select("host", "s.*")
    kinds = shown.groupBy("host", "path", "kids").agg(F.count("*").alias("n"))
    nodes = kinds.groupBy("host", "path").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("nlog")).where(F.col("m") >= max(least_pages, 2))
    nodes = nodes.select("host", "path", "m", (1 - F.col("nlog") / (F.col("m") * F.log("m"))).alias("presented"))
    texts = near.select("host", F.explode("texts").alias("b")).groupBy("host", "b.path", "b.t").agg(F.count("*").alias("n"))
    texts = texts.groupBy("host", "path").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.log("n")).alias("nlog"))
    whole = OWN * F.col("presented") + (1 - OWN) * (1 - F.col("nlog") / (F.col("n") * F.log("m")))
    low = nodes.join(texts, ["host", "path"]).select("host", "path", whole.alias("importance")).where(F.col("importance") < below)
    return low.groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("path", "importance"))).alias("low"))


def main_text(pages: DataFrame, *, least_pages: int = LEAST_PAGES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, url, text, n_chars of every page: its main text, blocks joined by line breaks.

    Whole pages are parsed once, elements at any depth; null html is empty text. A text goes if the
    importance of its node on the host's pages, times its weight by markup (``MARKED``, ``HINTED``, ``OUTSIDE`` or 1), is below ``threshold``. Pages without a host are cleaned by markup
    alone (importance 1), as are hosts with fewer than ``least_pages`` different pages of a style. A host that
    holds a third of all pages is a few rows of sums; pages meet its map of low
    styles in a join that may split it. Repeated rows stay repeated.
    """
    scratch = Scratch(pages.sparkSession, "sitetree")
    url = F.col("url").cast("string")
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)), r"^www\.", "")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), F.when(host != "", host).alias("host"), F.col("html").cast("string").alias("html"))
    parsed = scratch.keep(rows.mapInArrow(_parsed, "page_id bigint, url string, host string, blocks array<struct<path:bigint,text:string,weight:double>>, styles array<struct<path:bigint,children:string>>"), "parsed")
    low = scratch.keep(low_nodes(parsed, least_pages=least_pages, below=threshold / min(OUTSIDE, MARKED)), "low")
    kept = F.filter("blocks", lambda b: F.coalesce(F.try_element_at("low", b["path"]), F.lit(1.0)) * b["weight"] >= threshold)
    out = parsed.select("page_id", "url", "host", "blocks").join(low, "host", "left")
    return out.select("page_id", "url", F.array_join(F.transform(kept, lambda b: b["text"]), "\n").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
