"""Main text of web pages, with site templates found by counting element subtrees per host.

Two passes over the pages. The first hashes every block element (its tag, its text, its inner blocks) and Spark counts
on how many different pages of a host each hash occurs. Subtrees on at least ``min_pages`` pages and ``share`` of the
host's pages are its template; copies of one page count once in both. Digits count as alike outside the article. The second pass takes the text of each page
without them, and without what its markup names as something else than the article: menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles, reader comments. Outside an article one such word in a class or id is
enough; inside, a whole class or id must consist of them (and of words for boxes), as ``share-price`` names no sharing.

The article is the outermost ``article`` elements, else ``main``, else the whole body; it chooses among what the
template leaves. Inside ``article`` subtrees are counted apart, over different texts of articles, so what copied
articles share stays however their pages differ. The element itself is no template, nor are list items and table
cells on their own; an article that would lose all its text keeps it. A host has at most (blocks of a page / share)
template subtrees of each kind, whatever its size, so its list is one bounded value, joined to the pages by host; adaptive execution
splits a host with many pages.

Rules: a null or empty page has the empty text; a null url or one without host belongs to the host ''; repeated rows
are answered alike. Character references are decoded, white space inside a block becomes
one space, and blocks are joined by one space.
"""

from __future__ import annotations

import hashlib
import html as markup
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from jobscape.llm.common import chunks
from jobscape.sinks.tables import settle

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+[^>]*+)>?""",
    re.S,
)
# Element kinds. Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OPAQUE = frozenset("script style title textarea noscript iframe xmp noembed noframes template svg object canvas audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr img picture "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle mspace semantics".split()
)
# Starting one of the keys ends an open element of the values.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
# Parts of a list or table, which recur with their values; the whole may be a template.
PARTS = frozenset("li dt dd caption colgroup thead tbody tfoot tr td th".split())
SCOPES = frozenset("ul ol dl table article section div body main nav aside header footer form select".split())
# What is never the article: by element, by role, by the words of class and id.
ASIDE = frozenset("nav footer aside form button select dialog menu head fieldset input".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
OTHER_PARTS = (
    "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar side footer cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription "
    "share sharing social related recommended comment comments commentlist disqus respond widget login signup search pagination pager skip"
).split()
# Words that say nothing of what a part holds.
HOLDERS = (
    "area articles banner bar block bottom box btn button buttons card container form group holder icons inner item items left link links "
    "list module outer panel posts right row section slot stories top unit wrap wrapper"
).split()
NAMED = re.compile(rf"(?:^|[\s_-])(?:{'|'.join(OTHER_PARTS)})(?:$|[\s_-])", re.I)
# Inside an article a name counts only when all its words say so: "related-posts", but not "related-work".
NAMED_INSIDE = re.compile(
    rf"(?:^|\s)(?:(?:{'|'.join(HOLDERS)})[_-])*(?:{'|'.join(OTHER_PARTS)})(?:[_-](?:{'|'.join(OTHER_PARTS + HOLDERS)}))*(?:$|\s)", re.I
)
OUTSIDE_NAMED = re.compile(r"(?:^|[\s_-])(?:header|masthead|topbar|toolbar|banner|logo)(?:$|[\s_-])", re.I)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
HIDDEN = re.compile(r"display\s*:\s*none", re.I)
DIGITS = re.compile(r"\d+")


def _elsewhere(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is named as something else than the article."""
    if tag in ASIDE or tag == "header" and not in_article:
        return True
    if not attributes.strip():
        return False
    values = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
    if "hidden" in values or HIDDEN.search(values.get("style", "")) or values.get("role", "").lower() in ROLES:
        return True
    names = f"{values.get('class', '')} {values.get('id', '')}"
    if not names.strip() or tag in ("html", "body", "article", "main") and "comment" not in names.lower():
        return False
    if in_article:
        return bool(NAMED_INSIDE.search(names))
    return bool(NAMED.search(names) or OUTSIDE_NAMED.search(names))


class _Open:
    """An element being read. ``text`` gathers its subtree when it is a block."""

    __slots__ = ("tag", "block", "article", "main", "drop", "first", "parts", "holds")

    def __init__(self, tag, block, article, main, drop, first):
        self.tag, self.block, self.article, self.main, self.drop, self.first = tag, block, article, main, drop, first
        self.parts: list[str] = []
        self.holds = tag in ("article", "main", "body", "html")


def _number(text: str) -> int:
    digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def read_page(page: str) -> tuple[list[tuple[str, bool, bool]], list[tuple[int, bool, bool, int, int]]]:
    """Blocks of text, each with: inside an article, inside main; and the subtrees.

    A subtree is its hash, whether it may belong to a template, whether it is inside an article, and the bounds of
    its blocks; blocks in named non-articles are left out.
    """
    blocks: list[tuple[str, bool, bool]] = []
    subtrees: list[tuple[int, bool, bool, int, int]] = []
    stack = [_Open("", True, False, False, False, 0)]
    text: list[str] = []

    def flush() -> None:
        if text:
            words = markup.unescape("".join(text)).split()
            text.clear()
            if words:
                top = stack[-1]
                block = " ".join(words)
                top.parts.append(block if top.article else DIGITS.sub("0", block))
                if not top.drop:
                    blocks.append((block, top.article, top.main))

    def close() -> None:
        node = stack.pop()
        parent = stack[-1]
        if not node.block:
            parent.parts += node.parts
            parent.holds |= node.holds
            return
        parent.holds |= node.holds
        if node.parts:
            # Hashes inside an article and outside differ, so a teaser does not make its paragraph a template.
            number = _number("\x00".join(("\x02" + node.tag if node.article else node.tag, *node.parts)))
            parent.parts.append(f"\x01{number}")
            may = not node.holds and not (node.article and node.tag in PARTS)
            subtrees.append((number, may, node.article, node.first, len(blocks)))

    at, end = 0, len(page)
    while at < end:
        token = TOKEN.search(page, at)
        if token is None:
            text.append(page[at:])
            break
        if token.start() > at:
            text.append(page[at : token.start()])
        at = token.end() if token.end() > at else at + 1
        tag = token[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br" or tag == "hr":
            flush()
            continue
        if token[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    if any(n.block for n in stack[depth:]):
                        flush()
                    while len(stack) > depth:
                        close()
                    break
                if stack[depth].tag in SCOPES and tag in INLINE:
                    break
            continue
        if tag in OPAQUE:
            if not token[0].endswith("/>"):
                over = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                at = over.end() if over else end
            continue
        if tag in VOID:
            continue
        block = tag not in INLINE
        if block:
            flush()
            # A block ends an open paragraph; list items, cells and terms end one another.
            ended = CLOSES.get(tag, ()) + ("p",)
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in ended:
                    while len(stack) > depth:
                        close()
                    break
                if stack[depth].tag in SCOPES:
                    break
        top = stack[-1]
        drop = top.drop or _elsewhere(tag, token[3], top.article or top.main)
        stack.append(_Open(tag, block, top.article or tag == "article", top.main or tag == "main", drop, len(blocks)))
    flush()
    while len(stack) > 1:
        close()
    return blocks, subtrees


def main_text(page: str, template: frozenset[int]) -> str:
    blocks, subtrees = read_page(page)
    gone = [False] * len(blocks)
    for number, may, _, first, last in subtrees:
        if may and number in template:
            gone[first:last] = [True] * (last - first)
    article = [k for k, b in enumerate(blocks) if b[1]]
    left = [k for k, away in enumerate(gone) if not away]
    chosen = [k for k in article if not gone[k]] or article or [k for k in left if blocks[k][2]] or left
    return " ".join(blocks[k][0] for k in chosen)


def _host() -> F.Column:
    host = F.lower(F.regexp_extract(F.col("url").cast("string"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    return F.coalesce(host, F.lit(""))


def host_templates(pages: DataFrame, min_pages: int, share: float) -> DataFrame:
    """host and ``template``, the hashes of the subtrees that recur on its pages or in its articles."""
    page = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(_host().alias("host"), page.alias("html"), F.xxhash64(page).alias("copy"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "html"):
            hosts, inside, copies, numbers = [], [], [], []
            for host, page, copy in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "copy"))):
                blocks, subtrees = read_page(page)
                article = [b[0] for b in blocks if b[1]]
                for within, whole in ((False, copy), (True, _number("\x00".join(article)))):
                    if within and not article:
                        continue
                    found = {number for number, may, own, _, _ in subtrees if may and own == within}
                    hosts += [host] * (len(found) + 1)
                    inside += [within] * (len(found) + 1)
                    copies += [whole] * (len(found) + 1)
                    numbers += [None, *found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(inside, pa.bool_()), pa.array(copies, pa.int64()), pa.array(numbers, pa.int64())],
                names=["host", "inside", "copy", "subtree"],
            )

    # The row without subtree counts the page, or its article. Copies become one row before they are counted.
    found = rows.mapInArrow(run, "host string, inside boolean, copy long, subtree long").distinct()
    counts = settle(
        found.groupBy("host", "inside", "subtree").agg(F.count("*").alias("n")).filter((F.col("n") >= min_pages) | F.col("subtree").isNull()),
        "subtree-counts",
    )
    totals = counts.filter("subtree is null").select("host", "inside", F.col("n").alias("n_all"))
    recurring = counts.filter("subtree is not null").join(totals, ["host", "inside"]).filter(F.col("n") >= share * F.col("n_all"))
    return recurring.groupBy("host").agg(F.collect_list("subtree").alias("template"))


def extract(pages: DataFrame, min_pages: int = 4, share: float = 0.3) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    templates = settle(host_templates(pages, min_pages, share), "host-templates")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), _host().alias("host"))
    rows = rows.join(templates, "host", "left").select("page_id", "url", "html", "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "html"):
            texts = [
                main_text(page or "", frozenset(template or ()))
                for page, template in zip(batch.column("html").to_pylist(), batch.column("template").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
