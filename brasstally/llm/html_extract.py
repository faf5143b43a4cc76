"""Main text of web pages by site style trees.

All pages of a host are merged into one style tree: a node stands for the elements of
one path (names with their classes). Its importance is the mean of two entropies over
the pages that have it, each as a share of the largest possible: of its presentation
(which children it has) and of its content. What says the same on every page has
low importance and goes from each page, branch by branch, besides what its name,
class or role marks as no part of an article. Equal pages of a host count once. On every
page, with an article or main part or without, a node goes for its entropies only if it says there
what nearly all pages say, and only if more than headings is left: a copied body is no boilerplate.

The tree is never built in one place: a page gives a row for each of its nodes, and
entropies are sums over groups of these rows. A host that holds a third of all pages
is summed like the others, and its pages stay where they are as long as the list of
low nodes is small enough to be sent to them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brasstally.llm.common import table, written
from brasstally.llm.page_tree import Element, ancestors, blocks_of, digest, elements_of, read_page

LOW = 0.3
#: Less than this share of one content is no boilerplate, but copied text.
NEARLY_ALL = 0.95
#: Fewer pages than this say nothing about what a site repeats.
LEAST_PAGES = 4
# Names, roles and words of classes that mark what is no part of an article.
NOISE_NAMES = frozenset("nav aside footer form menu dialog button fieldset head".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NOISE_WORDS = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar side aside footer foot header masthead topbar ad ads adv advert adverts "
    "advertisement adsense adslot banner sponsor sponsored sponsors promo promotion cookie cookies consent gdpr notice notices notification alert "
    "popup modal overlay newsletter subscribe subscription signup login register share sharing social related recommended recommendations "
    "more-stories comment comments commentlist disqus respond reply replies discussion feedback widget widgets toolbar pagination pager paging "
    "skip skiplink copyright disclaimer legal search form".split()
)
#: Of these words, those that mark noise inside an article too.
SURE_WORDS = frozenset(
    "navbar breadcrumb breadcrumbs sidebar ad ads adv advert adverts advertisement adsense adslot sponsored promo cookie cookies gdpr popup modal "
    "newsletter subscribe share sharing more-stories comments commentlist disqus pagination skiplink".split()
)
#: Ids of these are mostly slugs of their own text.
SLUGGED = frozenset("h1 h2 h3 h4 h5 h6 section".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
KEPT_NAMES = frozenset(("html", "body", "main"))
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def host_of(url: str) -> Column:
    """The host of a url in lower case; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def words_of(marks: str) -> set[str]:
    return {w.lower() for w in WORD.findall(marks)}


def in_article(e: Element) -> bool:
    return any(x.name in ("article", "main") for x in ancestors(e.parent))


def marked_noise(e: Element, low: frozenset[int] = frozenset()) -> bool:
    """By name, role, class or style: no part of an article.

    Inside an article or main part, ids say nothing, and classes only by unmistakable words
    unless the node is also of low importance.
    """
    if e.name in KEPT_NAMES:
        return False
    if e.name in NOISE_NAMES:
        return True
    if e.name == "header":
        return not in_article(e)
    if not e.attributes:
        return False
    a = e.attributes
    if a.get("role", "").lower() in NOISE_ROLES or "hidden" in a or a.get("aria-hidden") == "true" or HIDDEN.search(a.get("style", "")):
        return True
    found = words_of(a.get("class", ""))
    if e.name != "article" and in_article(e):
        return bool(found & (NOISE_WORDS if e.key in low else SURE_WORDS))
    if e.name not in SLUGGED:
        found |= words_of(a.get("id", ""))
    noise = found & NOISE_WORDS
    if noise == {"header"} or e.name == "article":
        return bool(noise & {"comment", "comments", "reply", "related", "ad", "ads", "sponsored", "promo", "header"}) and (
            e.name != "article" and not in_article(e) or bool(noise - {"header"})
        )
    return bool(noise)


def page_nodes(html: str) -> dict[int, tuple[int, int]]:
    """Each of a page's style nodes: digests of its presentation and of its content, elements of one path together."""
    shapes: dict[int, list[str]] = {}
    texts: dict[int, list[str]] = {}
    below: dict[int, list[str]] = {}
    for e in reversed(list(elements_of(read_page(html)))):  # children before their parents
        # Above a node, its content is a digest: each text is read once, not once for each level.
        parts = [x for c in e.children for x in ([c] if isinstance(c, str) else below.pop(id(c)))]
        below[id(e)] = [str(digest("\n".join(parts)))] if parts else []
        if parts:
            shapes.setdefault(e.key, []).append(" ".join("#" if isinstance(c, str) else c.name for c in e.children))
            texts.setdefault(e.key, []).extend(below[id(e)])
    return {key: (digest("|".join(s)), digest("\n".join(texts[key]))) for key, s in shapes.items()}


def style_rows(pages: DataFrame) -> DataFrame:
    """(host, page, node, shape, content) of each page's nodes; ``page`` is a digest of them all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1)):
                nodes = page_nodes(html.as_py() or "")
                page = digest(repr(sorted(nodes.items())))
                rows += [(host, page, node, *x) for node, x in nodes.items()]
            columns = list(zip(*rows)) or [[]] * 5
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["host", "page", "node", "shape", "content"])

    return pages.select(host_of("url").alias("host"), "html").mapInArrow(run, "host string, page long, node long, shape long, content long")


def low_nodes(pages: DataFrame, low: float = LOW, least: int = LEAST_PAGES) -> DataFrame:
    """``host`` and ``low``: its nodes of less than such importance that say one thing on nearly all distinct pages, by key, with a digest of that."""
    # Equal pages are told by their own node rows: no page is moved for it.
    values = style_rows(pages).dropDuplicates(["host", "page", "node"]).select("host", "node", F.posexplode(F.array("shape", "content")).alias("kind", "value"))
    counts = values.groupBy("host", "node", "kind", "value").agg(F.count(F.lit(1)).alias("n"))
    sums = counts.groupBy("host", "node", "kind").agg(F.sum("n").alias("m"), F.max("n").alias("most"), F.max_by("value", "n").alias("top"), F.sum(F.col("n") * F.log("n")).alias("s"))
    entropy = (F.log("m") - F.col("s") / F.col("m")) / F.log("m")
    said = F.col("kind") == 1
    nodes = sums.where(F.col("m") >= least).groupBy("host", "node").agg(
        F.avg(entropy).alias("importance"),
        F.max(F.when(said, F.col("most") / F.col("m"))).alias("share"),
        F.max(F.when(said, F.col("top"))).alias("top"),
    )
    same = nodes.where((F.col("importance") < low) & (F.col("share") >= NEARLY_ALL))
    return same.groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("node", "top"))).alias("low"))


def low_on(html: str, low: dict[int, int]) -> frozenset[int]:
    """The keys of a site's low nodes that say on this page what they say on nearly all: what it says of its own there stays."""
    return frozenset(key for key, (_, content) in page_nodes(html).items() if low.get(key) == content) if low else frozenset()


def main_text(html: str, low: frozenset[int] = frozenset()) -> str:
    """A page's article: its blocks in page order, one on a line.

    Branches marked as noise go. Of the rest, all articles together are the text, unless
    they hold less than half of the main part, which then is; else the body. From each, nodes of low importance go too, unless
    nothing but headings would be left.
    """
    root = read_page(html)
    noise = {id(e) for e in elements_of(root) if marked_noise(e, low)}
    headings = {e.key for e in elements_of(root) if e.name in HEADINGS}

    def text_of(parts: list[Element], dropped: frozenset[int] = frozenset()) -> list[str]:
        return [line for e in parts for line in blocks_of(e, lambda x: id(x) in noise or x is not e and x.key in dropped if dropped else id(x) in noise)]

    def site_free(parts: list[Element]) -> str:
        """The text of these without what the site repeats."""
        return "\n".join(text_of(parts, low) if low and text_of(parts, low | headings) else text_of(parts))

    def parts_of(name: str) -> list[Element]:
        """All shown elements of a name or role that stand in no other one, in page order."""
        outer, below = [], set()  # below: ids of what is left out or stands in one already
        for e in elements_of(root):
            if id(e) in noise or id(e.parent) in below:
                below.add(id(e))
            elif e.name == name or e.attributes.get("role") == name:
                below.add(id(e))
                outer.append(e)
        return outer

    articles, main = site_free(parts_of("article")), site_free(parts_of("main"))
    # Articles that hold only a small part of the main text, such as teasers, are not the text.
    if articles and 2 * len(articles) >= len(main):
        return articles
    if main:
        return main
    noise |= mostly_links(root)
    return site_free([root])


def mostly_links(root: Element) -> set[int]:
    """Lists, boxes and paragraphs of which more than half the text stands in links."""
    found, sums = set(), {}
    for e in reversed(list(elements_of(root))):
        linked, size = e.linked, 0
        for c in e.children:
            more = (0, len(c)) if isinstance(c, str) else sums.pop(id(c))
            linked, size = linked + more[0], size + more[1]
        sums[id(e)] = linked, size
        if 2 * linked > size and e.name in ("ul", "ol", "div", "p", "td", "section", "table"):
            found.add(id(e))
    return found


def extract(pages: DataFrame, low: float = LOW) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every page; a null page is an empty one, with empty text.

    A null or broken url is the host of an empty name. Repeated rows each give a row;
    other columns are left out. Nothing but what is no article is dropped.
    """
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    hosts = written(low_nodes(rows, low), "low-nodes")
    joined = rows.withColumn("host", host_of("url")).join(hosts, "host", "left").select("page_id", "url", "html", "low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = [(h.as_py() or "", dict(x.as_py() or ())) for h, x in zip(batch.column(2), batch.column(3), strict=True)]
            texts = [main_text(html, low_on(html, low)) for html, low in pages]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = rows.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def op6_html_extract(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
