"""Main text of web pages by a site style tree.

Pages are cut into blocks: runs of text inside one block-level element, each with its path of elements (tag,
class, id, role). All pages of a host are merged into one tree of two kinds of nodes. An element node is a path; its
presentation nodes are the sequences of children (elements, or ``#`` for text of its own) that it shows on the pages, each
with its count. A leaf is the text of a path, with the count of each content. Leaves and elements have an importance of
their own, the entropy of contents or presentations normalised by the number of occurrences (1 for a node seen once):
a menu that says the same on every page is near 0, an article's paragraphs near 1. The composite importance of an element
with l presentations S of shares p is (1 - g^l) * sum(p * C(S)) + g^l * its own (g = ``DECAY``), where C(S) is the mean of
the composite importance of the children in S; for a leaf it is its own.

Removed from each page are leaves of low importance, and branches that are low throughout: the element and all nodes
below have a low composite importance, those too rare to be judged by themselves included. So are the branches
whose element or name says what they are (navigation, footers, forms, adverts, notices, comments).

The tree is a Spark aggregate over distinct pages (copies that differ in markup, or outside their longest runs of blocks,
count once): contents and presentations are counted by (host, path, hash) and then by (host, path), so a host with a third
of all pages is summed in every task before it is shuffled. The composite needs no loop over levels: the weights along a
path are summed as logarithms, and each node adds its share to all elements above it. An element that never
holds more than text counts as its text. A node has to occur on
``MIN_PAGES`` pages before it is removed by itself or as the top of a branch. Inside a marked article, only named
elements that say nearly the same everywhere are removed; where a page marks an article, what stands outside it is removed.

Cases: null and empty html give an empty text; a null or odd url is a host of its own name; repeated rows and
page_ids are separate pages; unclosed and misnested elements are closed by the next enclosing end tag; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.llm.common import table, written

MIN_PAGES = 8
MIN_IMPORTANCE = 0.2
#: Runs of blocks that tell a page from a copy with another date, session or link.
LONGEST = 3
#: Inside an article, named elements (class, id or role) below this importance go.
MIN_INSIDE = 0.02
#: Weight of an element's own presentations against its children, for each presentation once more.
DECAY = 0.9
#: Last step of a leaf's path: the text of the element itself.
TEXT = "#"

# Element and name lists.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
PARAGRAPH_ENDS = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 "
                           "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li dd dt tr td th".split())
DROP_TAGS = frozenset("nav footer aside form button select head menu dialog input object audio video canvas".split()) | RAW
_WORDS = (r"(?:nav|navbar|navigation|menu|breadcrumbs?|footer|sidebar|side|aside|cookies?|consent|notice|banner|"
          r"ads?|advert|advertisement|advertising|sponsor(?:ed)?|promo|popup|modal|newsletter|subscribe|signup|login|search|"
          r"share|sharing|social|related|recommended|widget|comments?|replies|disqus|pagination|pager|toolbar|skip|"
          r"(?:site|page|top|global)[_-]?header|masthead|contentinfo|complementary|alert|gdpr)")
#: A whole class, id or role: names in a row, with words for a part of a page behind them.
DROP_NAMES = re.compile(
    rf"(?:(?:site|page|main|top|bottom|global)[_-](?=nav|menu|footer|banner))?{_WORDS}(?:[_-]+(?:{_WORDS}|bar|box|list|links?|"
    r"buttons?|icons?|form|slot|unit|area|section|block|posts|overlay|wrapper|container|panel|\d+))*", re.I)
#: Names of branches that may hold articles of their own; the others are kept if they are all around the article.
OTHERS = re.compile(r"(?:comments?|replies|disqus|related|recommended|ads?|advert.*|sponsor.*|promo)(?:$|[_-])", re.I)
#: Never dropped by name.
KEEP_TAGS = frozenset("html body main article".split())
PAGE_HEADER = frozenset(["header"])

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
DIGITS = re.compile(r"\d+")

Block = tuple[str, str, bool, bool]


def page_blocks(page: str) -> list[Block]:
    """(path, text, in an article, dropped by its element or name) of each block, in page order."""
    out: list[tuple[str, str, int, list[int]]] = []
    # an open element: (tag, label, dropped, 2 in an article or 1 in the main part); dropped is -1 by the element or
    # as one of OTHERS, or the number of the branch by name
    stack: list[tuple[str, str, int, int]] = []
    named, spared, around = 0, set(), []  # branches dropped by name; those with the main part; those around each article
    text: list[str] = []
    at, size = 0, len(page)

    def flush():
        if text:
            raw = "".join(text)
            joined = " ".join((html_lib.unescape(raw) if "&" in raw else raw).split())
            text.clear()
            if joined:
                block = [x for x in stack if x[0] not in INLINE]
                out.append(("/".join(x[1] for x in block), joined, max((x[3] for x in stack), default=0),
                            [x[2] for x in stack if x[2]]))

    def close(tag):
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == tag:
                if any(x[0] not in INLINE for x in stack[k:]):
                    flush()
                del stack[k:]
                return

    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            text.append(page[at:])
            break
        if m.start() > at:
            text.append(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            close(tag)
            continue
        if tag == "br" or tag == "wbr":
            text.append(" " if tag == "br" else "")
            continue
        if tag == "svg" and m[3].rstrip().endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag not in INLINE:
            flush()
        if tag in VOID or m[3].rstrip().endswith("/"):
            continue
        if tag in PARAGRAPH_ENDS and any(x[0] == "p" for x in stack):
            close("p")
        if tag in ("li", "dd", "dt", "tr", "td", "th", "option") and stack and stack[-1][0] == tag:
            close(tag)
        names = " ".join(x[1] or x[2] or x[3] for x in ATTR.findall(m[3]))
        inside = any(x[3] for x in stack)
        drop = -1 if tag in DROP_TAGS or (tag in PAGE_HEADER and not inside) else 0
        found = [] if drop or tag in KEEP_TAGS else [x for x in names.split() if DROP_NAMES.fullmatch(x)]
        if found:
            named += 1
            drop = -1 if any(map(OTHERS.match, found)) else named
        if tag == "main":
            spared.update(x[2] for x in stack if x[2] > 0)
        elif tag == "article" and not any(x[2] < 0 or x[3] == 2 for x in stack):
            around.append({x[2] for x in stack if x[2] > 0})
        label = f"{tag}.{DIGITS.sub('0', names).replace('/', '|')}" if names else tag
        stack.append((tag, label, drop, 2 if tag == "article" else int(tag == "main")))
    flush()
    if all(x - spared for x in around):  # no article stands outside of named branches
        spared.update(*around)
    kept = [spared.issuperset(drop) for *_, drop in out]
    marked = max((b[2] for b, k in zip(out, kept, strict=True) if k), default=0)  # articles count, else the main part
    return [(path, words, 0 < marked <= level, not k) for (path, words, level, _), k in zip(out, kept, strict=True)]


def host_of(url) -> str:
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", url or "")
    return m[1].lower() if m else ""


def page_hash(texts: list[str]) -> int:
    """The same for copies of a page: its ``LONGEST`` longest runs, without the date or session id in a short one."""
    longest = sorted(sorted(texts, key=lambda t: (-len(t), t))[:LONGEST])
    return xxhash.xxh3_64_intdigest("\0".join(longest)) - (1 << 63)


def presentations(paths: list[str]) -> dict[str, str]:
    """The elements around the blocks of a page ("" is the page), each with the sequence of its children, repeats in a row
    once, joined by ``/``."""
    out: dict[str, list[str]] = {}
    for path in paths:
        above = ""
        for label in [*(path.split("/") if path else []), TEXT]:
            row = out.setdefault(above, [])
            if not row or row[-1] != label:
                row.append(label)
            above = f"{above}/{label}" if above else label
    return {element: "/".join(row) for element, row in out.items()}


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host, page_hash, blocks: kept runs of blocks (path, text, in an article) in page order; elements: the
    elements around them, with their children."""
    schema = ("page_id long, url string, host string, page_hash long, "
              "blocks array<struct<path string, text string, inside boolean, content long>>, "
              "elements array<struct<path string, style string>>")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            hosts, hashes, blocks, elements = [], [], [], []
            for url, page in zip(part["url"], part["html"], strict=True):
                page, merged = page or "", []
                for path, text, inside, drop in page_blocks(page):
                    if drop:
                        continue
                    if merged and merged[-1][0] == path and merged[-1][2] == inside:
                        merged[-1][1].append(text)
                    else:
                        merged.append((path, [text], inside))
                hosts.append(host_of(url))
                hashes.append(page_hash([" ".join(texts) for _, texts, _ in merged]))
                blocks.append([{"path": path, "text": (t := " ".join(texts)), "inside": inside,
                                "content": xxhash.xxh3_64_intdigest(t) - (1 << 63)} for path, texts, inside in merged])
                elements.append([{"path": path, "style": style}
                                 for path, style in presentations([path for path, _, _ in merged]).items()])
            yield pd.DataFrame({"page_id": part["page_id"].astype("Int64"), "url": part["url"], "host": hosts,
                                "page_hash": hashes, "blocks": blocks, "elements": elements})

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html")).mapInPandas(run, schema)


def _above(path: Column) -> Column:
    """Paths of all elements above a node, the page first."""
    steps = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(steps) - 1), lambda k: F.array_join(F.slice(steps, 1, k), "/"))


def style_tree(pages: DataFrame) -> DataFrame:
    """host, path, leaf, pages, importance, highest: the merged tree of each host, for nodes on ``MIN_PAGES`` pages or
    more (all count in the sums). A leaf's path ends in ``/#``; importance
    is the composite one, highest the largest one among the node and all nodes below."""
    leaf = F.transform("blocks", lambda b: F.struct(
        F.when(b["path"] == "", TEXT).otherwise(F.concat(b["path"], F.lit(f"/{TEXT}"))).alias("path"),
        F.lit(True).alias("leaf"), b["content"].alias("value"), F.lit(None).cast("string").alias("style")))
    element = F.transform("elements", lambda e: F.struct(
        e["path"].alias("path"), F.lit(False).alias("leaf"), F.xxhash64(e["style"]).alias("value"),
        e["style"].alias("style")))
    page = pages.groupBy("host", "page_hash").agg(F.min(F.array_sort(F.array_distinct(F.concat(leaf, element)))).alias("nodes"))
    each = page.select("host", F.explode("nodes").alias("n")).select("host", "n.*")
    shown = written(each.groupBy("host", "path", "leaf", "value").agg(F.count("*").alias("n"), F.min("style").alias("style")),
                    "tree-counts")
    own = shown.groupBy("host", "path", "leaf").agg(F.sum("n").alias("pages"), F.count("*").alias("kinds"),
                                                    F.min("style").alias("style"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
    own = own.withColumn("own", F.when(F.col("pages") == 1, 1.0).otherwise(
        (F.log("pages") - F.col("nlogn") / F.col("pages")) / F.log("pages")))
    # an element that never holds more than text counts as its text
    own = own.withColumn("bare", F.coalesce((F.col("kinds") == 1) & (F.col("style") == TEXT), F.lit(False)))
    # what a child has of its element's composite: the shares of the presentations with it, over their numbers of children
    total = own.filter("not leaf").select("host", F.col("path").alias("element"), F.col("pages").alias("shown"), "kinds", "bare")
    children = F.array_distinct(F.split("style", "/"))
    edges = shown.filter("not leaf").select(
        "host", F.col("path").alias("element"), "n", F.size(children).alias("k"), F.explode(children).alias("child"))
    edges = edges.groupBy("host", "element", "child").agg(F.sum(F.col("n") / F.col("k")).alias("part")).join(
        total, ["host", "element"]).select(
        "host", F.when(F.col("element") == "", F.col("child")).otherwise(F.concat("element", F.lit("/"), "child")).alias("path"),
        F.when(F.col("bare"), 0.0).otherwise(F.log((1 - F.pow(F.lit(DECAY), "kinds")) * F.col("part") / F.col("shown")))
        .alias("weight"))
    # all steps down to a node as one weight, so that of a node in an element above is the difference of theirs
    steps = own.filter("path != ''").select("host", "path", F.explode(F.concat(F.slice(_above(F.col("path")), 2, 1 << 30),
                                                                              F.array("path"))).alias("step"))
    down = steps.join(edges.select("host", F.col("path").alias("step"), "weight"), ["host", "step"]).groupBy(
        "host", "path").agg(F.sum("weight").alias("down"))
    nodes = own.join(down, ["host", "path"], "left").select(
        "host", "path", "leaf", "pages", F.coalesce("down", F.lit(0.0)).alias("down"),
        (F.col("own") * F.when(F.col("leaf"), 1.0).when(F.col("bare"), 0.0).otherwise(F.pow(F.lit(DECAY), "kinds"))).alias("own"))
    nodes = written(nodes, "tree-nodes")
    within = F.when(F.col("path") == "", F.array("path")).otherwise(F.concat(_above(F.col("path")), F.array("path")))
    below = nodes.select("host", F.explode(within).alias("path"), "down", "own")
    top = nodes.select("host", "path", "leaf", "pages", F.col("down").alias("top"))
    tree = written(below.join(top, ["host", "path"]).groupBy("host", "path").agg(
        F.min("leaf").alias("leaf"), F.min("pages").alias("pages"),
        F.sum(F.exp(F.col("down") - F.col("top")) * F.col("own")).alias("importance")), "tree")
    highest = tree.select("host", F.explode(within).alias("path"), "importance").groupBy("host", "path").agg(
        F.max("importance").alias("highest"))
    return tree.filter(F.col("pages") >= MIN_PAGES).join(highest, ["host", "path"])


def main_text(pages: DataFrame, min_importance: float = MIN_IMPORTANCE) -> DataFrame:
    """page_id, url, text, n_chars: the blocks of each page that no rule and no low importance removes."""
    blocks = written(parsed(pages), "page-blocks")
    low = written(style_tree(blocks).filter(F.col("highest") < min_importance), "style-tree")
    # a branch under a low one goes with it
    top = low.filter("not leaf").select("host", F.col("path").alias("above"))
    up = low.filter("path != ''").select("host", "path", F.explode(_above(F.col("path"))).alias("above"))
    covered = up.join(top, ["host", "above"], "left_semi").select("host", "path").distinct()
    branches = low.filter("not leaf").join(covered, ["host", "path"], "left_anti").groupBy("host").agg(
        F.collect_set("path").alias("branches"))
    path = F.regexp_replace("path", f"(?:^|/){TEXT}$", "")
    low = low.filter("leaf").withColumn("path", path).groupBy("host").agg(
        F.collect_set("path").alias("low"),
        F.collect_set(F.when((F.col("importance") < MIN_INSIDE)
                             & F.col("path").rlike(r"(?:^|/)(?:article|main)[^/]*/(?:.*/)?[^/]*\."),
                             F.col("path"))).alias("same"))
    low = written(low.join(branches, "host", "full_outer"), "style-low")
    marked = F.exists("blocks", lambda b: b["inside"])
    none = F.array().cast("array<string>")
    rows = blocks.join(low, "host", "left").select(
        "page_id", "url", "blocks", marked.alias("marked"), F.coalesce("low", none).alias("low"),
        F.coalesce("same", none).alias("same"), F.coalesce("branches", none).alias("branches"))
    gone = lambda b: F.array_contains("low", b["path"]) | F.exists(
        "branches", lambda x: (x == "") | F.startswith(F.concat(b["path"], F.lit("/")), F.concat(x, F.lit("/"))))
    kept = F.filter("blocks", lambda b: F.when(b["inside"], ~F.array_contains("same", b["path"]))
                    .otherwise(~F.col("marked") & ~gone(b)))
    rows = rows.select("page_id", "url", F.array_join(F.transform(kept, lambda b: b["text"]), " ").alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_text(table(spark, sf_dir, "pages"))
