import html as references
import re

import pytest
from llm.frames import clashing, documents, nothing, odd

import __spark_entry__ as entry
from brasstally.llm import substring_dedup as passages
from brasstally.llm.html_extract import extract, low_nodes, main_text
from brasstally.llm.substring_dedup import STRETCH, repeated_passages, without_repeats


def article_of(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", inner)
    blocks = (" ".join(references.unescape(re.sub(r"</?b>|<br>", " ", p)).split()) for p in parts)
    return "\n".join(b for b in blocks if b)


def test_articles_of_given_pages(spark):
    folder = "/root/testdata/sf0.01"
    got = entry.queries()["op6_html_extract"](spark, folder).toPandas()
    pages = spark.read.parquet(f"{folder}/pages.parquet").toPandas()
    want = {r.page_id: article_of(r.html) for r in pages.itertuples()}
    assert dict(zip(got.page_id, got.text)) == want
    assert all(n == len(t) for n, t in zip(got.n_chars, got.text))


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("plain < text &amp; more", "plain < text & more"),
        ("<p>one<p>two&nbsp;&eacute;<br>three</p>", "one\ntwo é three"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\nb\nc\nd"),
        ("<div class=content><p>x</div><div id=sidebar>s</div><footer>f</footer><form>q</form><script>if(a<b){}</script>", "x"),
        ("<div class='cookie-notice'>c</div><div class='post'>x<div class='comments'><p>nice</div></div>", "x"),
        ("<article><header><h1>T</h1></header><p>x<aside>no</aside><footer>by</footer></article><article class=comment>zz zz zz</article>", "T\nx"),
        ("<main><p>m</main><p>outside", "m"),
        ("<nav>n</nav><p>un\"closed <a title=\"x>y</p> z", 'un"closed y\nz'),
        ("<p>a <!-- <p>no --> b <![CDATA[no]]> c</p><style>p{}</style><textarea>t</textarea>", "a b c"),
    ],
)
def test_main_text(page, text):
    assert main_text(page) == text


def test_style_tree_finds_what_a_site_repeats(spark):
    box = "<div class=top><p>All offers of the week</p></div><div class=story><p>Story {0} tells of {0} things</p><p>And more {0}</p></div>"
    rows = [(i, "http://a.example/%d" % i, box.format(i)) for i in range(12)] + [(99, "http://b.example/1", box.format(7)), (100, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract(pages.selectExpr("*", "1 as host", "2 as low")).collect()}
    assert got[3] == "Story 3 tells of 3 things\nAnd more 3"
    assert got[99] == "All offers of the week\nStory 7 tells of 7 things\nAnd more 7"
    assert got[100] == ""
    assert {r["host"] for r in low_nodes(pages).collect()} == {"a.example"}
    assert extract(pages.limit(0)).count() == 0


def test_copies_of_one_page_keep_their_text(spark):
    page = "<article><h1>Title</h1><p>Same text everywhere</p></article>"
    pages = spark.createDataFrame([(i, f"http://a.example/{i}", page) for i in range(20)], "page_id long, url string, html string")
    assert {r["text"] for r in extract(pages).collect()} == {"Title\nSame text everywhere"}


@pytest.mark.parametrize("frame", ["<article>{}</article>", "<main>{}</main>", "<div role=main>{}</div>"])
def test_style_tree_acts_inside_articles_and_main_parts(spark, frame):
    """What a site repeats beside its stories goes; what a page says of its own in the same place stays."""
    box = "<h1>Title {0}</h1><div class=lead><p>{1}</p></div><p>Story {0} tells of {0} things</p>"
    said = {i: "Own words" if i == 7 else "All stories of the week" for i in range(40)}
    rows = [(i, f"http://a.example/{i}", frame.format(box.format(i, x))) for i, x in said.items()]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: f"Title {i}\n" + ("Own words\n" if i == 7 else "") + f"Story {i} tells of {i} things" for i in said}
    assert {r["page_id"]: r["text"] for r in extract(pages).collect()} == want


@pytest.mark.parametrize(
    "page,text",
    [
        ("<article><h2 id=related-work>R</h2><p>x<h2 id='legal-history'>L</h2><section id=discussion><p>y</section></article>", "R\nx\nL\ny"),
        ("<main><h2 id='search-methods'>S</h2><div class='legal notice'>z</div></main>", "S\nz"),
        ("<h2 id=feedback>F</h2><p>x", "F\nx"),
        ("<article><p>x</p><div class=comments>c</div><div class=share-box>s</div><div role=search>q</div><nav>n</nav></article>", "x"),
    ],
)
def test_slugs_and_common_words_keep_article_text(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("frame", ["<article>{}</article>", "<div class=box>{}</div>"])
@pytest.mark.parametrize("unique", [0, 4, 30])
def test_copied_bodies_under_own_titles_keep_their_text(spark, frame, unique):
    want = {i: (f"Title {i}", f"Own text {i}" if i < unique else "Same text everywhere") for i in range(100)}
    rows = [(i, f"http://a.example/{i}", frame.format("<h1>{}</h1><p>{}</p>".format(*x))) for i, x in want.items()]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in extract(pages).collect()} == {i: "\n".join(x) for i, x in want.items()}


@pytest.mark.parametrize("page", ["<" * 100_000, "<p>" * 50_000, "<div>" * 50_000 + "x", '<a "' * 50_000, "<!--" * 50_000, "<script>" * 20_000, "<li>" * 50_000])
def test_broken_pages_take_linear_time(page):
    import time

    began = time.time()
    main_text(page)
    assert time.time() - began < 10


def shared_by_documents(pdf, words):
    seen = {}
    for i, t in zip(pdf.doc_id, pdf.text):
        w = t.encode().lower().split()
        for k in range(len(w) - words + 1):
            seen.setdefault(b" ".join(w[k : k + words]), set()).add(i)
    return set().union(*[v for v in seen.values() if len(v) > 1])


def test_passages_by_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    pdf = documents(spark, folder)
    got = entry.queries()["op9_substring_dedup"](spark, folder).toPandas()
    assert shared_by_documents(pdf, 51) <= set(got.doc_id)
    text = dict(zip(pdf.doc_id, pdf.text))
    assert all(len(text[r.doc_id][r.start : r.end].split()) >= STRETCH and r.component_id <= r.doc_id for r in got.itertuples())
    assert (got.kept == (got.doc_id == got.component_id)).all()


def test_tiles_find_all_links_across_components(spark, monkeypatch):
    """Variants of one line, most of them too far from each other, against all pairs."""
    import random

    import numpy as np

    r = random.Random(2)
    base = [f"w{i}" for i in range(70)]
    texts = []
    for _ in range(250):
        line = list(base)
        for _ in range(r.randint(0, 4)):
            line[r.randrange(70)] = f"x{r.randrange(10**6)}"
        texts.append(" ".join(line))
    texts = sorted(set(texts))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(66)} for t in texts]
    names = {g: k for k, g in enumerate(sorted(set().union(*sets)))}
    arrays = [np.array(sorted(names[g] for g in s), dtype=np.int32) for s in sets]
    ids = np.arange(len(texts))
    found = passages.tile_links(np.zeros(len(ids)), ids, ids, arrays)
    parent = list(ids)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def roots(pairs):
        parent[:] = list(ids)
        for a, b in pairs:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
        return [root(x) for x in ids]

    want = [(i, j) for i in ids for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert roots(found) == roots(want)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    linked = {i for i, r in enumerate(roots(want)) if roots(want).count(r) > 1}
    outcomes = []
    for tile in (512, 20):
        monkeypatch.setattr(passages, "TILE", tile)
        outcomes.append({tuple(r) for r in repeated_passages(docs).collect()})
        assert linked <= {r[0] for r in outcomes[-1]}
    assert outcomes[0] == outcomes[1]


def words(a, b, name="w"):
    return " ".join(f"{name}{i}" for i in range(a, b))


def test_planted_passages(spark):
    passage = words(0, 51)
    edited = words(100, 220).replace("w150", "other")
    rows = [
        (1, "start " + passage + " end"), (2, words(0, 30, "x") + " " + passage + " " + words(0, 30, "y")), (3, words(0, 45, "c")),
        (4, "z " + words(100, 220)), (5, edited), (6, words(0, STRETCH - 1) + " stop"), (7, None), (8, ""), (9, passage * 1 + "\n" + words(0, 60, "q") + "\n" + words(0, 60, "q")),
        (None, "lone " + words(0, 70, "n")),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as doc", "2 as hash", "3 as row")
    got = repeated_passages(docs).toPandas()
    assert set(got.doc_id) == {1, 2, 4, 5, 9} and set(got.component_id) == {1, 4}
    assert set(got[got.kept].doc_id) == {1, 4}
    left = {r["doc_id"]: r["text"] for r in without_repeats(docs).collect()}
    assert "w20" in left[1] and "w20" not in left[2] and left[2].startswith("x0") and left[2].endswith("y29")
    assert left[3] == words(0, 45, "c") and left[7] is None and left[8] == "" and left[None].startswith("lone")


def test_odd_texts(spark):
    for frame in (odd, clashing):
        docs = frame(spark)
        assert without_repeats(docs).columns == docs.columns and without_repeats(docs).count() == docs.count()
    assert repeated_passages(nothing(spark)).count() == 0


@pytest.mark.parametrize(
    "page, text",
    [
        ("<main><article><p>First part here.</p></article><article><p>Second part.</p></article></main>", "First part here.\nSecond part."),
        ("<article><h1>Head</h1><article><p>Inner one.</p></article><p>End.</p></article>", "Head\nInner one.\nEnd."),
        ("<main><p>A long main text of many words that is the page's own.</p><article>Teaser</article></main>", "A long main text of many words that is the page's own.\nTeaser"),
        ("<aside><article><p>Not this one, it is beside.</p></article></aside><article><p>This one.</p></article>", "This one."),
        ("<div role=article><p>By role.</p></div><nav><article>menu</article></nav>", "By role."),
    ],
)
def test_all_articles_are_the_text(page, text):
    assert main_text(f"<html><body>{page}</body></html>") == text


def test_many_nested_articles_take_linear_time():
    assert main_text("<article>" * 20_000 + "<p>deep</p>") == "deep"


def test_rows_that_share_an_id_keep_their_own_text(spark):
    """A place of one text is not cut from another that has the same id, or none."""
    line = " ".join(f"shared{k}" for k in range(60))
    own = " ".join(f"own{k}" for k in range(80))
    rows = [(1, line), (2, f"{line}\nand more of it"), (2, own), (None, line), (None, own[::-1]), (3, line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["text"]) for r in without_repeats(docs).collect()}
    assert {(2, own), (2, f"{line}\nand more of it"), (None, own[::-1]), (None, line)} <= got
    assert line not in {t for i, t in got if i == 3}
