"""Main text of web pages by site style trees.

Every page becomes a tree of block elements. The trees of one host are merged:
an element is known by its path of tags and classes. Two entropies over the
host's different pages, in units of the logarithm of the number of pages that
have the element, tell what it is worth. Presentation: how much the sequence of
child tags varies. Content: a text on n of m pages has importance
1 - log n / log m, since text spread evenly over a site says nothing about a
page. A block's importance weighs its content with the presentation of its
parent; blocks below `IMPORTANT` are cut, if at least `PAGES` pages have the
element. Copies of a page count once, so a copied article is not site furniture.

Markup that names its role decides before that: elements for navigation, forms,
scripts and the like, and classes or ids that name menus, adverts, notices,
comments and so on, are dropped with all they hold. An `article` or `main`
element is one region with all that is nested in it, other regions included. A
page's text is what its regions hold and, unless one of them is `main`, every
block outside that is not mostly links; regions that are mostly links go too, if
the page has other text.
Length decides in one case alone: an article of bare text, without any block
element, is a teaser if another region of the page has `TEASER` times its text.

The low blocks of a host travel to its pages as one small list per host, by a
broadcast only if the planner finds the whole table below its size limit.

Cases: null or empty html gives an empty text; so does a page without any block
left. Every row gives one row, repeated rows and null ids included; rows without
a host (null or relative url) form one site. Broken markup is read as far as it
goes. Nothing is cut short. Other columns are not looked at.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.llm.batches import small_batches
from strataloom.session import new_dir

IMPORTANT = 0.35
PRESENTATION = 0.1  # share of the parent's presentation in a block's importance
PAGES = 5
TEASER = 5  # times as long as a teaser

BLOCKS = set("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer h1 h2 h3 h4 h5 h6 header hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
DROPPED = set("head nav aside footer form fieldset button select textarea dialog menu iframe object canvas audio video svg math template noscript map script style title".split())
RAW = set("script style textarea title noscript iframe template".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
BARRIER = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
NAMES = set("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion cookie cookies consent gdpr popup modal newsletter subscribe subscription signup login share sharing social related recommended comment comments commentary disqus replies respond breadcrumb breadcrumbs pagination pager copyright navbar navigation sidebar masthead topbar toolbar footer menu".split())
WEAK = set("nav header side banner notice alert widget aside announcement".split())
WRAPS = set("wrapper container layout page main content article body with has post entry story".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*)>?|<[!?][^>]*>?""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'=/>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"


@dataclass
class Block:
    """A run of text between two block tags."""

    path: str
    parent: str
    article: int  # number of the outermost article or main element around it, 0 for none
    main: bool  # whether that holds a main element around the block
    bare: bool  # stands in the article element itself
    text: str
    linked: int


@dataclass
class Element:
    tag: str
    path: str
    dropped: bool
    article: int
    main: bool
    holds: bool
    children: list[str] = field(default_factory=list)


@lru_cache(maxsize=4096)
def _judge(tag: str, raw: str) -> tuple[str, bool, str]:
    """Style (tag and classes), whether the element is dropped, and `article` or `main` if it holds one."""
    found = {k.lower(): html.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(raw)}
    names = f"{found.get('class', '')} {found.get('id', '')}"
    words = {w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", names)}
    role = found.get("role", "").lower()
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    holds = next((x for x in ("main", "article") if x in (tag, role)), "")
    dropped = tag in DROPPED or role in ROLES or hidden
    if tag not in ("html", "body", "main"):
        dropped |= bool(words & (NAMES - {"sidebar", "menu", "footer", "navigation"} if words & {"with", "has"} else NAMES)) or bool(words & WEAK and not words & WRAPS)
    style = tag + "".join("." + re.sub(r"\d+", "0", c) for c in sorted(found.get("class", "").split()))
    return style, dropped, holds


def blocks(page: str) -> tuple[list[Block], list[tuple[str, str]]]:
    """The text blocks of a page in order, and (path, child tags) of its elements."""
    root = Element("", "", False, 0, False, False)
    stack, out, styles, articles = [root], [], [], 0
    parts: list[str] = []
    anchor, linked, at, n = 0, 0, 0, len(page)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text and not stack[-1].dropped:
                parent = stack[-2].path if len(stack) > 1 else ""
                out.append(Block(stack[-1].path, parent, stack[-1].article, stack[-1].main, stack[-1].holds, text, linked))
        linked = 0

    def leave() -> None:
        last = stack.pop()
        if not last.dropped:
            styles.append((last.path, " ".join(last.children)))

    while at < n:
        match = TOKEN.search(page, at)
        text = page[at : match.start() if match else n]
        if text and not stack[-1].dropped:
            parts.append(text)
            if anchor:
                linked += len(text.strip())
        if not match:
            break
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if match[1]:
            if tag == "a":
                anchor = 0
            elif (tag in BLOCKS or tag in DROPPED) and any(e.tag == tag for e in stack):
                flush()
                while stack[-1].tag != tag:
                    leave()
                leave()
            continue
        if tag == "br":
            parts.append(" ")
        if tag == "a":
            anchor = 1
        style, dropped, holds = _judge(tag, match[3])
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else n
            if tag in BLOCKS or tag not in ("script", "style"):
                flush()
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in BLOCKS or tag in DROPPED or dropped or holds:
            flush()
            shut = CLOSES.get(tag, {"p"} if tag in BLOCKS else set())
            depth = len(stack) - 1
            while depth > 0 and stack[depth].tag not in BARRIER.get(tag, ()):
                if stack[depth].tag in shut:
                    while len(stack) > depth:
                        leave()
                    break
                if tag not in BARRIER:
                    break  # only the innermost paragraph is closed by a following block
                depth -= 1
            above = stack[-1]
            inside = above.article
            if tag == "header" and inside:
                dropped = above.dropped
            if holds and not (inside or dropped or above.dropped):
                articles += 1
                inside = articles
            above.children.append(style)
            stack.append(Element(tag, f"{above.path}/{style}", dropped or above.dropped, inside, above.main or holds == "main", bool(holds)))
            if tag not in BLOCKS and tag not in DROPPED and not holds:
                stack[-1].tag = tag
    flush()
    while len(stack) > 1:
        leave()
    return out, styles


def hashed(*parts: str) -> int:
    return xxhash.xxh64("\x00".join(parts).encode("utf-8", "surrogatepass")).intdigest() - (1 << 63)


def _style_rows(pages: DataFrame) -> DataFrame:
    """site, page (hash of its blocks), kind, element, value: what each page adds to its site's tree."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {c: [] for c in ("site", "page", "kind", "element", "value", "parent")}
            for site, page in zip(batch.column("site").to_pylist(), batch.column("html").to_pylist(), strict=True):
                found, styles = blocks(page or "")
                whole = hashed(*(b.text for b in found))
                seen = {("text", hashed(b.path), hashed(b.path, b.text), hashed(b.parent)) for b in found}
                seen |= {("style", hashed(p), hashed(c), 0) for p, c in styles}
                seen |= {("page", e, 0, 0) for _, e, _, _ in list(seen)}
                for kind, element, value, parent in seen:
                    for c, v in (("site", site), ("page", whole), ("kind", kind), ("element", element), ("value", value), ("parent", parent)):
                        rows[c].append(v)
            yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.string() if c in ("site", "kind") else pa.int64()) for c, v in rows.items()})

    return pages.mapInArrow(work, "site string, page bigint, kind string, element bigint, value bigint, parent bigint")


def unimportant(pages: DataFrame, threshold: float = IMPORTANT) -> DataFrame:
    """site, low: the (path, text) hashes of each site whose importance lies below the threshold."""
    rows = _style_rows(pages).distinct()
    counted = rows.groupBy("site", "kind", "element", "value", "parent").agg(F.count(F.lit(1)).alias("n"))
    counted = _written(counted, "styles")
    total = counted.where("kind = 'page'").select("site", "element", F.col("n").alias("m")).where(F.col("m") >= PAGES)
    share = F.col("n") / F.col("m")
    styled = counted.where("kind = 'style'").join(total, ["site", "element"])
    # a page may show an element more than once, so shares are taken of all its styles
    spread = styled.groupBy("site", "element").agg(F.least(F.lit(1.0), F.sum(-share * F.log(share)) / F.log(F.max("m"))).alias("presentation"))
    text = counted.where("kind = 'text'").join(total, ["site", "element"]).join(spread.withColumnRenamed("element", "parent"), ["site", "parent"], "left")
    content = 1 - F.log("n") / F.log("m")
    importance = (1 - PRESENTATION) * content + PRESENTATION * F.greatest(F.lit(0.0), F.coalesce("presentation", F.lit(0.0)))
    return text.where((importance < threshold) & (F.col("n") > 1)).groupBy("site").agg(F.collect_set("value").alias("low"))


def _written(df: DataFrame, label: str) -> DataFrame:
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def main_text(page: str, low: set[int]) -> str:
    """The main text of one page, without the blocks named in `low`."""
    found = [b for b in blocks(page)[0] if not low or hashed(b.path, b.text) not in low]
    size: dict[int, int] = {}
    linked: dict[int, int] = {}
    for b in found:
        size[b.article] = size.get(b.article, 0) + len(b.text)
        linked[b.article] = linked.get(b.article, 0) + b.linked
    shaped = {b.article for b in found if not b.bare}
    longest = max((s for a, s in size.items() if a), default=0)
    main = any(b.main for b in found)

    def stays(b: Block) -> bool:
        if not b.article:
            return not main and 2 * b.linked <= len(b.text)
        if b.article not in shaped and not b.main and TEASER * size[b.article] < longest:
            return False
        return b.main or 2 * linked[b.article] <= size[b.article]

    found = [b for b in found if stays(b)] or [b for b in found if b.article]
    return "\n\n".join(b.text for b in found)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    small_batches(pages.sparkSession)
    site = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1))
    known = pages.select("page_id", "url", "html", site.alias("site"))
    low = _written(unimportant(known.select("site", "html")), "low")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: dict[str, set[int]] = {}
            texts = []
            for name, page, values in zip(batch.column("site").to_pylist(), batch.column("html").to_pylist(), batch.column("low"), strict=True):
                if name not in sets:
                    sets[name] = set(values.as_py() or ())
                texts.append(main_text(page or "", sets[name]))
            yield pa.RecordBatch.from_pydict({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())})

    return known.join(low, "site", "left").select("page_id", "url", "html", "site", "low").mapInArrow(work, "page_id bigint, url string, text string, n_chars bigint")
