"""Main text of web pages: markup roles, then nearest-URL page differencing.

A page becomes lines, one per block. What the markup names as menu, header, footer,
advert, form, comment and so on goes; lines inside an article container are the main
text. The lines outside any such container are aligned with those of the pages next to it by
URL path on the same host (longest common subsequence), and shared lines go.

Pages are cut into slices of the order by (host, path); each slice also sees the last
page before it and the first one after it, so no pair is lost at a border and no host is one task.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mensario.llm.common import cut, slices

# Elements and names by role.
BLOCKS = frozenset("address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template iframe object svg math canvas audio video textarea title head select".split())
BOILER = frozenset("nav footer aside dialog menu button".split())
MAIN = frozenset("article main".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
BOILER_NAMES = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs footer sidebar aside widget widgets ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended trending comment comments commentlist disqus respond reply replies "
    "search pagination pager toolbar masthead copyright skip form".split()
)
#: Parts that say nothing of what a block holds. A name of several parts tells only if each is one of these or a boilerplate word.
FILLER = frozenset("slot box bar wrap wrapper container area block section list item items link links row col column top bottom left right inner outer main site page global primary secondary mobile desktop posts articles stories offers".split())
#: Parts of names by which a wrapper tells what it has beside the main text; an article container inside counts.
LAYOUT_NAMES = frozenset("nav navbar sidebar footer header toolbar ad ads banner cookie cookies modal overlay search form".split())
#: Names of the form around a whole page.
PAGE_FORMS = frozenset("aspnetform form1".split())
HEADER_NAMES = frozenset("header masthead topbar".split())
MAIN_NAMES = frozenset("article-body article-content post-body post-content entry-content main-content page-content story-body content-body articlebody postcontent".split())
#: Start tags that end an open element of the second set.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_TAG = re.compile(r"<(?:(/?)([A-Za-z][^\s/>]*)|(!--)|[!?])")
_STOP = re.compile(r"""["'>]""")
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")
OUT, OPEN, BODY, WRAP = 0, 1, 2, 3  # WRAP: out, but for article containers inside


def role(tag: str, attributes: str, outer: int) -> int:
    """Role of an element within one of role ``outer``."""
    if outer == OUT or tag in BOILER or (tag == "header" and outer != BODY):
        return OUT
    inside = BODY if tag in MAIN else WRAP if tag == "form" else outer
    if not attributes.strip():
        return inside
    found = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attributes)}
    names = f"{found.get('class', '')} {found.get('id', '')}".split()
    lowered = {n.lower() for n in names}
    kind = found.get("role", "").lower()
    if kind in BOILER_ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return OUT
    if tag in ("html", "body"):
        return inside
    parts = [{w.lower() for w in _NAME.split(n) if w} for n in names if not re.match(r"(?:has|no|with|is)[-_]", n)]
    words = set().union(*(p for p in parts if p <= BOILER_NAMES | FILLER))
    if tag == "form" and (lowered | {found.get("name", "").lower()}) & PAGE_FORMS:
        return outer
    if lowered & BOILER_NAMES:
        return OUT
    if tag not in MAIN and words & BOILER_NAMES:
        return WRAP if words & BOILER_NAMES <= LAYOUT_NAMES else OUT
    if inside != BODY and tag not in MAIN and words & HEADER_NAMES:
        return OUT
    return BODY if kind in ("main", "article") or lowered & MAIN_NAMES else inside


class _Tags:
    """Finds tags one after another, each character looked at a bounded number of times."""

    def __init__(self, page: str):
        self.page, self.last, self.quotes = page, page.rfind(">"), True
        self.unclosed: set[str] = set()

    def next(self, at: int) -> tuple[int, int, str, str, bool] | None:
        """Begin, end, name, attributes and whether it closes; comments have no name. None if there is no further tag."""
        while True:
            m = _TAG.search(self.page, at)
            if m is None:
                return None
            if m[3]:
                end = self.page.find("-->", m.end())
                return m.start(), end + 3 if end >= 0 else len(self.page), "", "", False
            end = self._end(m.end())
            if end is None:
                return None
            return m.start(), end + 1, (m[2] or "").lower(), self.page[m.end() : end] if m[2] else "", m[1] == "/"

    def _end(self, at: int) -> int | None:
        """The place of the ">" that ends the tag, not one in quotes. Behind a quote that nothing closes, quotes count no more."""
        if at > self.last:
            return None
        start = at
        while self.quotes:
            stop = _STOP.search(self.page, at)
            if stop is None:
                self.quotes = False
            elif stop[0] == ">":
                return stop.start()
            else:
                close = self.page.find(stop[0], stop.end())
                self.quotes = close >= 0
                at = close + 1
        found = self.page.find(">", start)
        return found if found >= 0 else None

    def body(self, at: int) -> int | None:
        """Where the next body begins; None if none does, which is looked for once."""
        found = None if "body" in self.unclosed else re.compile(r"<body\b", re.I).search(self.page, at)
        if found is None:
            self.unclosed.add("body")
        return found.start() if found else None

    def behind(self, tag: str, at: int) -> int | None:
        """The place behind the tag that closes ``tag``; None if there is none, which is looked for once."""
        if tag in self.unclosed:
            return None
        end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(self.page, at)
        if end is None:
            self.unclosed.add(tag)
        return end.end() if end else None


def lines(page: str | None) -> list[tuple[str, int]]:
    """(text, role) of each block with text that is not boilerplate, in page order. NULL has none."""
    page = page or ""
    result: list[tuple[str, int]] = []
    pieces: list[str] = []
    stack: list[tuple[str, int]] = [("", OPEN)]
    open_tags: Counter[str] = Counter()
    tags = _Tags(page)
    linked, letters, links, at = 0, 0, 0, 0

    def end_block() -> None:
        nonlocal linked, letters, links
        text = " ".join("".join(pieces).split())
        if text and stack[-1][1] in (OPEN, BODY):
            # a block outside an article that is mostly links is a menu, if there are several or it is an item of a list
            menu = 2 * linked > letters and (links > 1 or open_tags["li"])
            if stack[-1][1] == BODY or not menu:
                result.append((text, stack[-1][1]))
        pieces.clear()
        linked = letters = links = 0

    def add(raw: str) -> None:
        nonlocal linked, letters
        if not raw or stack[-1][1] not in (OPEN, BODY):
            return
        text = html.unescape(raw) if "&" in raw else raw
        pieces.append(text)
        letters += len(text.strip())
        if open_tags["a"]:
            linked += len(text.strip())

    def leave(k: int) -> None:
        open_tags.subtract(t for t, _ in stack[k:])
        del stack[k:]

    while at < len(page):
        found = tags.next(at)
        if found is None:
            add(page[at:])
            break
        begin, end, tag, attributes, closing = found
        add(page[at:begin])
        at = end
        if not tag:
            continue
        if tag in BLOCKS:
            end_block()
        if closing:
            if open_tags[tag]:
                k = next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag)
                if stack[k][1] != stack[k - 1][1]:
                    end_block()
                leave(k)
            continue
        if tag in SILENT:
            if attributes.rstrip().endswith("/"):
                continue
            behind = tags.behind(tag, at)
            if behind is None and tag == "head":  # an unclosed head ends where the body begins
                behind = tags.body(at)
                if behind is None:
                    continue
            at = len(page) if behind is None else behind
            continue
        if tag in VOID:
            continue
        if tag in CLOSES or (tag in BLOCKS and open_tags["p"]):
            ends = CLOSES.get(tag, {"p"})
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in ends:
                    leave(k)
                    break
                if stack[k][0] in ("ul", "ol", "dl", "table", "article", "section", "div"):
                    break
        inner = role(tag, attributes, stack[-1][1])
        if inner != stack[-1][1]:
            end_block()
        links += tag == "a"
        stack.append((tag, inner))
        open_tags[tag] += 1
    end_block()
    return result


def common(a: list[int], b: list[int]) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b``."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    found = {*range(low), *range(len(a) - high, len(a))}
    where = defaultdict(list)
    for j in range(len(b) - high - 1, low - 1, -1):
        where[b[j]].append(j)
    tails: list[int] = []
    links: list[tuple | None] = []
    for i in range(low, len(a) - high):
        for j in where.get(a[i], ()):
            k = bisect_left(tails, j)
            node = (i, links[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                links.append(node)
            else:
                tails[k], links[k] = j, node
    node = links[-1] if links else None
    while node:
        found.add(node[0])
        node = node[1]
    return found


def undecided(own: list[int], before: list[int] | None, after: list[int] | None) -> list[bool]:
    """Which open lines of a page stay. The first mark is that of the whole page. A neighbour with the very same lines, or with
    all lines of the shorter of the two, is a copy and tells nothing: pages of one template have lines of their own."""
    shared: set[int] = set()
    for other in (before, after):
        if other and other[0] != own[0]:
            both = common(own[1:], other[1:])
            if len(both) < min(len(own), len(other)) - 1:
                shared |= both
    return [i not in shared for i in range(len(own) - 1)]


def _key() -> F.Column:
    """Host and path of the URL (scheme, query and fragment left out), then page_id: many pages of one URL still order."""
    url = F.coalesce("url", F.lit(""))
    bare = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    bare = F.regexp_replace(bare, r"[?#].*$", "")
    host = F.lower(F.regexp_extract(bare, r"^[^/]*", 0))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    return F.concat(host, F.lit("\x01"), F.regexp_extract(bare, r"/.*$", 0), F.lit("\x02"), page)


def _bounds(keys: DataFrame, n: int) -> list[str]:
    """Keys that cut all keys into about ``n`` slices, from a sample of some 20 a slice."""
    total = keys.count()
    share = F.pmod(F.xxhash64("key", F.lit(5)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = sorted(r["key"] for r in keys.where(share < F.lit(min(1.0, 20 * n / max(1, total)))).select("key").distinct().collect())
    return [sample[len(sample) * k // n] for k in range(1, n)] if sample else []


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row of ``pages``; NULL or empty html gives an empty text.

    Repeated rows stay; copies of a page are not its neighbours in the sense of a template. Pages without URL
    are one host. Ties of host and path are ordered by page_id.
    """
    keys = cut(pages.select(_key().alias("key")))
    bounds = _bounds(keys, slices(keys.count(), 250, 256, 8192))
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"slice": [], "body": [], "open": [], "fixed": [], "marks": []}
            for key, page in zip(batch.column(2).to_pylist(), batch.column(3)):
                found = lines(page.as_py())
                rest = [t for t, r in found if r == OPEN]
                host = key.split("\x01")[0]
                out["slice"].append(bisect_right(bounds, key))
                out["body"].append(None if rest else "\n".join(t for t, _ in found))
                out["open"].append([t for t, _ in found] if rest else None)
                out["fixed"].append([r == BODY for _, r in found] if rest else None)
                whole = xxhash.xxh64_intdigest("\n".join(t for t, _ in found))
                out["marks"].append([m - (1 << 63) for m in (whole, *(xxhash.xxh64_intdigest(host + "\0" + t) for t in rest))])
            arrays = [pa.array(out["slice"], pa.int32()), pa.array(out["body"], pa.string()), pa.array(out["open"], pa.list_(pa.string())), pa.array(out["fixed"], pa.list_(pa.bool_())), pa.array(out["marks"], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *arrays], names=["page_id", "url", "key", "slice", "body", "open", "fixed", "marks"])

    schema = f"page_id {kind}, url string, key string, slice int, body string, open array<string>, fixed array<boolean>, marks array<long>"
    parsed = cut(pages.select("page_id", "url", _key().alias("key"), "html").mapInArrow(run, schema))
    settled = parsed.where("body IS NOT NULL").select("page_id", "url", F.col("body").alias("text"))
    # one slim row a page; only pages with lines still to be decided carry them
    row = parsed.select("slice", "key", "page_id", "url", "open", "fixed", "marks").withColumn("ghost", F.lit(False))
    edge = F.struct("key", "marks")
    ends = parsed.groupBy("slice").agg(F.min(edge).alias("first"), F.max(edge).alias("last"))
    by_slice = Window.orderBy("slice")  # one row a slice
    borders = ends.select("slice", F.lag("last").over(by_slice).alias("prev"), F.lead("first").over(by_slice).alias("next"))
    ghosts = borders.select("slice", F.explode(F.array("prev", "next")).alias("e")).where("e IS NOT NULL")
    ghosts = ghosts.select("slice", "e.key", F.lit(None).cast(kind).alias("page_id"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("array<string>").alias("open"), F.lit(None).cast("array<boolean>").alias("fixed"), "e.marks", F.lit(True).alias("ghost"))
    order = Window.partitionBy("slice").orderBy("key", "marks")
    host = F.substring_index("key", "\x01", 1)
    near = lambda f: F.when(f(host).over(order) == host, f("marks").over(order))
    paired = row.unionByName(ghosts).withColumn("prev", near(F.lag)).withColumn("next", near(F.lead)).where("NOT ghost AND open IS NOT NULL")

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for found, fixed, own, prev, following in zip(*(batch.column(k).to_pylist() for k in range(2, 7))):
                stay = iter(undecided(own, prev, following))
                texts.append("\n".join(t for t, sure in zip(found, fixed) if sure or next(stay)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    rest = paired.select("page_id", "url", "open", "fixed", "marks", "prev", "next").mapInArrow(differ, f"page_id {kind}, url string, text string")
    return settled.unionByName(rest)
