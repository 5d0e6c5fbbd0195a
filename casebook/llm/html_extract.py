"""Main text of HTML pages by site style trees.

Pages of one host are merged into a tree: a node is a path of elements with their classes. Its
presentation importance is the entropy of the child sequences seen there. The content importance of a text at a
node is its information, ``-log`` of the share of the node's pages that hold it. Both are relative to those of
``LEAST_PAGES`` pages that all differ, so they rest on shares alone and not on the size of the host. A text that stands in
the same place on page after page is of low importance and is removed from each; other texts of that place stay.
Elements that say what they are (fixed lists below) need no statistics: navigation, forms, scripts and the like weigh
nothing. If a page marks articles or a main part that have at least a third of its text, only those count. Names are whole
classes or ids of elements that hold blocks; of headings, paragraphs and inline elements only classes of adverts count. Names that
articles use for their own parts as well (``related``, ``notice``) are evidence inside an article, not a verdict: the tree judges such
texts, by ``SUSPECT_IMPORTANCE``. The page, its body, main part and articles, and whatever holds one of them, are never noise by name or as
a form; nor is a form around more than half of the page's text, which is a frame of the page.

* Hosts with fewer than ``LEAST_PAGES`` different pages are judged by the tree merged over all hosts.
  Equal pages of a host count once.
* Character references are decoded, white space in a block becomes one space, blocks are joined in page order by a
  line end. Unclosed elements end with their parent. A page without text gives an empty string.
* Null html is empty; a null URL or one without host belongs to the host ``""``. Repeated rows are pages of their
  own; extra columns do not matter. An empty table gives an empty result.
* Statistics are counts combined before the shuffle, so a host may hold any share of the pages; nothing
  but a list of low texts per host, as hashes, is joined back.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm.common import Scratch, narrow, query, table

LEAST_PAGES = 20
CONTENT_SHARE = 0.8  # of a text's importance; the rest is that of its node's presentation
LOW_IMPORTANCE = 0.3
SUSPECT_IMPORTANCE = 0.7  # below this, a text goes whose element has a doubtful name
SUSPECT = "?"  # before the paths of such texts, which are places of their own

# Elements and names by what they mean in HTML pages.
RAW_TEXT = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOISE_ELEMENTS = frozenset(
    "script style noscript template iframe nav footer aside button select textarea input label fieldset "
    "svg canvas object applet dialog menu title head audio video map".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar toolbar".split())
NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices popup modal overlay newsletter subscribe subscription nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar sidebars footer comment comments commentlist disqus reply replies related recommended share sharing social "
    "widget widgets pagination pager toolbar login signup search".split()
)
ADVERT_NAMES = frozenset("ad ads adv advert adverts advertisement advertising adsense".split())
DOUBTFUL_NAMES = frozenset(
    "notice notices related recommended share sharing social promo promotion widget widgets search menu footer reply replies "
    "navigation subscription sponsor sponsored login signup popup overlay modal".split()
)
MARKS = frozenset("main article".split())  # elements and roles
CORE_ELEMENTS = MARKS | frozenset("html body".split())
OUTER_NAMES = frozenset("header masthead banner topbar hero".split())  # noise outside an article only
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table caption tbody td "
    "tfoot th thead tr ul".split()
)
NAMED = BLOCKS - frozenset("p h1 h2 h3 h4 h5 h6 hgroup pre dt caption figcaption legend summary hr".split())  # whose names tell something
CLOSES_P = BLOCKS - frozenset("td th tr tbody thead tfoot caption html body option optgroup legend".split())
CLOSES_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


OUTSIDE = ("", "", False, False, 0, 0, False)  # the stack's entry for what has no element


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


class Page:
    """Text blocks of one page with their paths, and the child sequence of each element."""

    def __init__(self, source: str):
        self.blocks: list[tuple] = []  # path, text, inside an article, innermost wrapper
        self.styles: list[tuple] = []  # path, checksum of children, innermost wrapper
        self.stack: list[list] = []  # name, path, is noise, is article, checksum of children, innermost wrapper, is doubtful
        self.open = Counter()  # names on the stack
        self.text: list[str] = []
        # elements that are noise by name or as a form, unless they hold a core element: outer wrapper, holds one, is noise as a form only
        self.wrappers: list[list] = [[-1, True, False]]  # the first is the page's own
        self._read(source)
        self._keep_frames()
        noise: list[bool] = []
        for outer, holds, _ in self.wrappers:
            noise.append(not holds or (outer >= 0 and noise[outer]))
        self.blocks = [b[:3] for b in self.blocks if not noise[b[3]]]
        self.styles = [t[:2] for t in self.styles if not noise[t[2]]]
        inside = sum(len(b[1]) for b in self.blocks if b[2] or b[0].startswith(SUSPECT))
        self.has_article = inside > 0 and 3 * inside >= sum(len(b[1]) for b in self.blocks)

    def _keep_frames(self) -> None:
        """Forms with more than half of the text that is not noise by name."""
        sizes = [0] * len(self.wrappers)
        for block in self.blocks:
            sizes[block[3]] += len(block[1])
        for number in reversed(range(1, len(sizes))):  # outer wrappers come before inner ones
            outer, holds, form = self.wrappers[number]
            sizes[outer] += sizes[number] if holds or form else 0
        for wrapper, size in zip(self.wrappers, sizes):
            wrapper[1] |= wrapper[2] and 2 * size > sizes[0]

    def _noise(self, name: str, attrs: dict[str, str], in_article: bool) -> bool:
        if name in NOISE_ELEMENTS or (name == "header" and not in_article):
            return True
        return bool(attrs) and (attrs.get("role", "").lower() in NOISE_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true")

    def _wrapper(self, name: str, attrs: dict[str, str], in_article: bool) -> str:
        """``name`` or ``form`` if the element is noise as such unless it holds a core element, ``doubt`` if the tree is to judge."""
        if attrs and name not in NAMED:
            return "name" if ADVERT_NAMES & {*attrs.get("class", "").lower().split()} else ""
        if attrs:
            words = {*attrs.get("class", "").lower().split(), attrs.get("id", "").lower().strip()}
            if words & (NOISE_NAMES - DOUBTFUL_NAMES if in_article else NOISE_NAMES | OUTER_NAMES):
                return "name"
            if in_article and words & DOUBTFUL_NAMES:
                return "doubt"
        return "form" if name == "form" or attrs.get("role", "").lower() == "form" else ""

    def _flush(self) -> None:
        if self.text:
            value = " ".join(html.unescape("".join(self.text)).split())
            self.text.clear()
            if value and self.stack and not self.stack[-1][2]:
                _, path, _, article, _, wrapper, doubtful = self.stack[-1]
                self.blocks.append((SUSPECT + path if doubtful else path, value, article and not doubtful, wrapper))
            elif value and not self.stack:
                self.blocks.append(("", value, False, 0))

    def _pop(self) -> None:
        name, path, noise, _, children, wrapper, _ = self.stack.pop()
        self.open[name] -= 1
        if not noise and name in BLOCKS:
            self.styles.append((path, children, wrapper))

    def _open(self, name: str, text: str) -> None:
        if name in BLOCKS or name == "br":
            if name == "br":
                self.text.append(" ")
                return
            self._flush()
        closes = CLOSES_SAME.get(name, set())
        if name in CLOSES_P:
            closes = closes | {"p"}
        if any(self.open[c] for c in closes):
            for depth in reversed(range(len(self.stack))):
                other = self.stack[depth][0]
                if other in closes:
                    while len(self.stack) > depth:
                        self._pop()
                    break
                if other in BLOCKS and other not in ("p", "li", "td", "th", "dd", "dt"):
                    break
        if name in VOID:
            return
        attrs = attributes(text) if text.strip() else {}
        parent = self.stack[-1] if self.stack else list(OUTSIDE)
        noise = parent[2] or self._noise(name, attrs, parent[3])
        marked = name in MARKS or attrs.get("role", "").lower() in MARKS
        wrapper, doubtful = parent[5], parent[6]
        why = "" if noise or marked or name in CORE_ELEMENTS else self._wrapper(name, attrs, parent[3])
        if not noise and (marked or name in CORE_ELEMENTS):
            outer = wrapper
            while not self.wrappers[outer][1]:  # those around one that holds a core element hold it as well
                self.wrappers[outer][1] = True
                outer = self.wrappers[outer][0]
        elif why == "doubt":
            doubtful = True
        elif why:
            self.wrappers.append([wrapper, False, why == "form"])
            wrapper = len(self.wrappers) - 1
        if (noise, wrapper, doubtful) != (parent[2], parent[5], parent[6]):
            self._flush()
        article = parent[3] or (not noise and marked)
        label = ".".join([name, *sorted(attrs.get("class", "").lower().split())])
        path = parent[1]
        if name in BLOCKS:  # the path's elements and classes, whatever their number, as 64 bits
            path = blake2b(f"{path}/{label}".encode(), digest_size=8).hexdigest()
            parent[4] = zlib.crc32(label.encode(), parent[4])
        self.stack.append([name, path, noise, article, 0, wrapper, doubtful])
        self.open[name] += 1

    def _close(self, name: str) -> None:
        if not self.open[name]:
            return
        if name in BLOCKS or self.stack[-1][2]:
            self._flush()
        while True:
            was = self.stack[-1]
            outer = self.stack[-2] if len(self.stack) > 1 else OUTSIDE
            if (was[2], was[5], was[6]) != (outer[2], outer[5], outer[6]):
                self._flush()
            self._pop()
            if was[0] == name:
                return

    def _read(self, source: str) -> None:
        at = 0
        while at < len(source):
            found = TOKEN.search(source, at)
            if not found:
                self.text.append(source[at:])
                break
            if found.start() > at:
                self.text.append(source[at : found.start()])
            at = found.end()
            name = (found["name"] or found["name2"] or "").lower()
            if not name:
                continue
            if found["end"] or found["end2"]:
                self._close(name)
            elif name in RAW_TEXT:
                end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(source, at)
                at = end.end() if end else len(source)
            else:
                self._open(name, found["attrs"] or found["attrs2"] or "")
        self._flush()
        while self.stack:
            self._pop()

    def kept(self) -> list[tuple[str, str, bool]]:
        """The article's blocks, if there is one; else all of them, unmarked."""
        if self.has_article:
            return [b for b in self.blocks if b[2] or b[0].startswith(SUSPECT)]
        return [(path, text, False) for path, text, _ in self.blocks]


def with_blocks(rows: DataFrame) -> DataFrame:
    """Replaces the last column, ``html``, by the page's blocks, styles, and a checksum of its text."""
    kept = rows.schema.fields[:-1]

    def run(batches):
        block = pa.struct([("path", pa.string()), ("text", pa.string()), ("marked", pa.bool_())])
        style = pa.struct([("path", pa.string()), ("children", pa.int64())])
        for whole in batches:
            for offset in range(0, whole.num_rows, 200):
                batch = whole.slice(offset, 200)
                blocks, styles, sums = [], [], []
                for value in batch.column(len(kept)):
                    page = Page(value.as_py() or "")
                    found = page.kept()
                    blocks.append([{"path": p, "text": t, "marked": m} for p, t, m in found])
                    styles.append([{"path": p, "children": c} for p, c in page.styles])
                    sums.append(zlib.crc32("\n".join(t for _, t, _ in found).encode()))
                own = [batch.column(i) for i in range(len(kept))]
                arrays = [*own, pa.array(blocks, pa.list_(block)), pa.array(styles, pa.list_(style)), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in kept] + ["blocks", "styles", "checksum"])

    blocks = "blocks array<struct<path:string,text:string,marked:boolean>>, styles array<struct<path:string,children:long>>, checksum long"
    return rows.mapInArrow(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [blocks]))


def entropy(values: DataFrame, by: list[str], name: str) -> DataFrame:
    """Entropy of ``value`` per group, relative to its highest for so many observations, or ``LEAST_PAGES`` of them: 0 if all are equal, 1 if all differ."""
    counts = values.groupBy(*by, "value").agg(F.count("*").alias("n"))
    sums = counts.groupBy(*by).agg(F.sum("n").alias(f"{name}_n"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
    total = F.col(f"{name}_n")
    highest = F.log(F.least(total, F.lit(LEAST_PAGES)))  # that of all would make the same shares weigh less on larger hosts
    relative = F.when(total > 1, F.least((F.log(total) - F.col("nlogn") / total) / highest, F.lit(1.0))).otherwise(1.0)
    return sums.select(*by, f"{name}_n", relative.alias(name))


def place_and_text(block: Column) -> Column:
    return F.xxhash64(block["path"], block["text"])


def low_texts(scratch: Scratch, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hashes of path and text of low importance per tree, and the tree of each host: its own, or ``*`` if it has few pages."""
    distinct = pages.groupBy("host", "checksum").agg(F.min("row_id").alias("row_id"))
    hosts = distinct.groupBy("host").agg(F.count("*").alias("pages"))
    first = scratch.store(distinct.join(hosts, "host").select("row_id", "pages"), "first")
    judged = pages.join(first, "row_id").withColumn("tree", F.when(F.col("pages") >= LEAST_PAGES, F.col("host")).otherwise("*"))
    unmarked = judged.withColumn("blocks", F.filter("blocks", lambda b: ~b["marked"])).where("size(blocks) > 0")
    places = unmarked.select("tree", F.explode(F.array_distinct("blocks.path")).alias("path"))
    places = places.groupBy("tree", "path").agg(F.count("*").alias("all_n")).where(F.col("all_n") >= LEAST_PAGES)
    seen = F.transform("blocks", lambda b: F.struct(b["path"].alias("path"), place_and_text(b).alias("value")))
    texts = unmarked.select("tree", F.explode(F.array_distinct(seen)).alias("t")).groupBy("tree", "t.path", "t.value").agg(F.count("*").alias("n"))
    least = F.when(F.col("path").startswith(SUSPECT), SUSPECT_IMPORTANCE).otherwise(LOW_IMPORTANCE)
    least_share = F.pow(F.lit(float(LEAST_PAGES)), -least / CONTENT_SHARE)  # of a text of low importance, whatever its node's presentation
    texts = texts.where(F.col("n") > 0.99 * least_share * LEAST_PAGES)  # others need not meet by path
    styles = judged.select("tree", F.explode("styles").alias("s"))
    styles = styles.select("tree", F.col("s.path").alias("node"), F.col("s.children").alias("value"))
    places = places.withColumn("node", F.ltrim(F.col("path"), F.lit(SUSPECT)))
    nodes = places.join(entropy(styles, ["tree", "node"], "look"), ["tree", "node"], "left")
    nodes = scratch.store(nodes.select("tree", "path", "all_n", F.coalesce("look", F.lit(0.0)).alias("look")), "nodes")  # of known size
    content = F.least(F.log(F.col("all_n") / F.col("n")) / F.log(F.lit(LEAST_PAGES)), F.lit(1.0))
    importance = CONTENT_SHARE * content + (1 - CONTENT_SHARE) * F.col("look")
    low = texts.join(nodes, ["tree", "path"]).where(importance < least).groupBy("tree").agg(F.collect_list("value").alias("low"))
    return scratch.store(low, "low"), hosts.select("host", F.when(F.col("pages") >= LEAST_PAGES, F.col("host")).otherwise("*").alias("tree"))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """Per row of ``pages``: key, url, ``text`` and ``n_chars``."""
    scratch = Scratch(pages.sparkSession, "html-extract")
    rows = narrow(pages, key, url, source).toDF("key", "url", "html")
    host = F.lower(F.coalesce(F.regexp_extract(F.col("url").cast("string"), r"://([^/?#]*)", 1), F.lit("")))
    rows = rows.withColumn("row_id", F.monotonically_increasing_id())
    rows = rows.select("row_id", "key", "url", host.alias("host"), F.col("html").cast("string"))
    found = scratch.store(with_blocks(rows), "pages")
    low, trees = low_texts(scratch, found.select("row_id", "host", "blocks", "styles", "checksum"))
    trees = scratch.store(trees.join(low, "tree").select("host", "low"), "trees")
    none = F.array().cast("array<bigint>")
    keep = F.filter("blocks", lambda b: b["marked"] | ~F.array_contains(F.coalesce(F.col("low"), none), place_and_text(b)))
    text = F.array_join(F.transform(keep, lambda b: b["text"]), "\n")
    joined = found.select("key", "url", "host", "blocks").join(trees, "host", "left")
    return joined.select(F.col("key").alias(key), F.col("url").alias(url), text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


@query("op9_html_extract")
def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
