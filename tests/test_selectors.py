"""H1-H17 on hand-written pages, and the slice rule against Python."""

from pyspark.sql import functions as F

from quarry.operators import selectors as H
from quarry.operators.selectors import python_slice_keep
from quarry.sources.pages import elements, page_nodes, parse_html, texts

CARD = """<div class="results-container">
  <div class="card card-type-comment ember-view"><a href="/comment/AG-2024-0001-0002">Title</a>
    <div class="card-metadata"><ul><li><strong>Posted</strong> Jan 29, 2024</li>
    <li><strong>ID</strong> AG-2024-0001-0002</li></ul></div></div>
  <div class="card card-type-comment ember-view"><a href="/comment/AG-9-1">Other &amp; more</a>
    <div class="card-metadata"><ul><li><strong>ID</strong> AG-9-1</li>
    <li><strong>Posted</strong> Feb 2, 2024</li></ul></div></div>
  <div class="card card-type-comment ember-view"><span>no link</span>
    <div class="card-metadata"><ul><li><strong>ID</strong> AG-9-3</li></ul></div></div>
</div>"""

BROKEN = ('<html><head><title>T &amp; U</title><script>var t="</p>";</script></head><body><nav><ul>'
          '<li><a href="/a">A</a></li><li><a href="/b">B</a></li><li><a href="/c">C</a></li></ul></nav>'
          '<article><h1>Head</h1><p><b>Bold<br><p>inner</p><p>second</p></article><footer>foot</footer>')


def _frame(spark, pages):
    pg = spark.createDataFrame(pages, "page_id long, html string")
    nodes = page_nodes(pg).cache()
    return pg, elements(nodes), texts(nodes)


def test_slice_rule_matches_python(spark):
    rows = [(n, r) for n in range(0, 7) for r in range(n)]
    df = spark.createDataFrame(rows, "n int, r int")
    for cs in [(2,), (1, 2), (-1,), (None, 2), (-2, None), (1, None, 2), (None, None, -1), (5, 1, -2), (-100, 2)]:
        got = sorted((x.n, x.r) for x in df.where(python_slice_keep(F.col("r"), F.col("n"), cs)).collect())
        assert got == sorted((n, r) for n in range(7) for r in list(range(n))[slice(*cs)]), cs


def test_broken_html_tree(spark):
    rows = parse_html(BROKEN)
    tags = [r[4] for r in rows if not r[4].startswith("#")]
    assert tags.count("p") == 3 and "script" in tags
    raw = [r[8] for r in rows if r[4] == "#text" and r[9]]
    assert raw == ['var t="</p>";']                                     # script body is raw text
    pg, els, tx = _frame(spark, [(1, BROKEN)])
    ctx = H.page_context(pg.select("page_id"))
    title = H.element_text(H.select(ctx, els, "find|elem|title", ["page_id"]), tx, ["page_id"]).first()["text"]
    assert title == "T & U"
    b = H.element_text(H.select(ctx, els, "find|elem|article~find|elem|b", ["page_id"]), tx, ["page_id"]).first()["text"]
    assert b == "Boldinnersecond"                                       # open b holds the later paragraphs
    ps = H.select(ctx, els, "find|elem|article~find_all|elem|p", ["page_id"]).count()
    assert ps == 3
    li = H.element_text(H.select(ctx, els, "find_all|elem|li|1|3", ["page_id"]), tx, ["page_id"])
    assert sorted(r["text"] for r in li.collect()) == ["B", "C"]
    last = H.element_text(H.select(ctx, els, "find_all|elem|li|-1", ["page_id"], op="index"), tx, ["page_id"])
    assert [r["text"] for r in last.collect()] == ["C"]
    alt = H.select(ctx, els, "find|elem|time<>find|elem|h1", ["page_id"]).first()
    assert alt["alt"] == 1
    kept = H.remove_elements(tx, els, "find_all|elem|nav~find_all|elem|footer~find_all|elem|script")
    body = H.element_text(H.select(ctx, els, "find|elem|body", ["page_id"]), kept, ["page_id"]).first()["text"]
    assert body == "HeadBoldinnersecond"


def test_cards_labels_and_links(spark):
    pg, els, tx = _frame(spark, [(7, CARD)])
    ctx = H.page_context(pg.select("page_id"))
    cards = H.select(ctx, els, "find|class|results-container~find_all|class|card card-type-comment ember-view", ["page_id"])
    cards = cards.withColumn("card", F.col("c_lo"))
    assert cards.count() == 3
    link = H.select(cards, els, "find|elem|a", ["card"])
    lt = {r["card"]: r["text"] for r in H.element_text(link, tx, ["card"]).collect()}
    assert sorted(lt.values()) == ["Other & more", "Title"]
    meta = H.apply_step(cards.select("card", "page_id", "c_lo", "c_hi", "c_nc"), els,
                        H.parse_spec("find|class|card-metadata")[0][0], ["card"])
    lab = {r["id"]: r["posted"] for r in H.labelled_items(meta, els, tx, ["card"]).collect()}
    assert lab == {"AG-2024-0001-0002": "Jan 29, 2024", "AG-9-1": "Feb 2, 2024", "AG-9-3": None}


def test_download_link(spark):
    pages = [(1, '<div><a class="btn btn-default btn-block" href="https://x/1.pdf">D</a><a href="/z.pdf">z</a></div>'),
             (2, '<div><a href="/a.pdf">a</a><a href="/b.pdf">b</a><a href="/c.txt">c</a></div>'),
             (3, '<div><a href="/c.txt">c</a></div>')]
    pg, els, tx = _frame(spark, pages)
    d = {r["page_id"]: r["download"] for r in H.download_link(H.page_context(pg.select("page_id")), els, ["page_id"]).collect()}
    assert d == {1: "https://x/1.pdf", 2: "/b.pdf", 3: None}


def test_html_to_text(spark):
    df = spark.createDataFrame([(BROKEN,)], "h string")
    t = df.select(H.html_to_text(F.col("h")).alias("t")).first()["t"]
    assert "var t" not in t and "T & U" in t and "Head" in t and "<" not in t


def test_first_fields_equals_general_path(spark):
    import os

    from conftest import SF_SMALL
    from quarry.sources.pages import document_context, parsed_nodes
    from quarry.sources.specs import parse_spec

    pg = spark.read.parquet(os.path.join(SF_SMALL, "pages.parquet")).select("page_id", "html")
    nodes = parsed_nodes(pg)
    els, tx = elements(nodes), texts(nodes)
    ctx = H.select(document_context(nodes), els, "find|elem|nav~find_all|elem|li", ["page_id"])
    ctx = ctx.withColumn("item", F.col("c_lo"))
    specs = {"a": "find|elem|a", "b": "find|elem|b", "ul": "find|elem|ul"}
    fast = {(r["page_id"], r["item"]): r for r in
            H.first_fields(ctx, els, tx, ["item"], {n: parse_spec(s)[0][0] for n, s in specs.items()}).collect()}
    whole = {(r["page_id"], r["item"]): r["text"] for r in H.element_text(ctx, tx, ["item"]).collect()}
    assert set(fast) == set(whole) and len(fast) > 0
    for n, s in specs.items():
        m = H.select(ctx, els, s, ["item"])
        href = {(r["page_id"], r["item"]): r["href"] for r in H.attribute(m, els, "href", ["item"]).collect()}
        txt = {(r["page_id"], r["item"]): r["text"] for r in H.element_text(m, tx, ["item"], strip=False).collect()}
        for k, r in fast.items():
            assert r[f"{n}_found"] == (k in txt), (n, k)
            assert r[f"{n}_text"] == txt.get(k), (n, k)
            if n == "a":
                assert r["a_attr"] == href.get(k), k
            assert r["text"] == whole[k]


BITS = ["<p>", "</p>", '<div class="a b">', "</div>", '<a href="x&amp;y">', "<a href='q'>", "<a href=z>", "</a>", "<br>", "<br/>", '<img src="x" />',
        '<script>var a="<p>";</script>', "<style>x</style>", "<title>a<b></title>", "<!-- c -->", "<!DOCTYPE html>", "<?pi?>", "text", "a &amp; b", " & ",
        "&lt", "<", ">", "</", "</>", "< p>", '<P CLASS="X">', "</P >", '<li\tid="1"\nclass="c" id="2">', "<x-y>", '<a b="1"c="2">', "<h2 ", '"',
        "<p/>", "<script/>", "</script>", "é\xa0", "\x0b", "<textarea>", '<a b = "1">', "&#65;", "&#x41", '<a "b"="c">', "\x00", '<i a="<b>">', "</i\x0b>"]


def test_plain_markup_is_read_as_the_library_reads_it(monkeypatch):
    import random
    from quarry.sources import pages as PG

    def by_library(html):
        b = PG._TreeBuilder()
        b.feed(html)
        return b.finish()

    rng = random.Random(4)
    for _ in range(20000):
        html = "".join(rng.choice(BITS) for _ in range(rng.randint(0, 9)))
        assert parse_html(html) == by_library(html), html
    # a page of plain tags is read in one go
    page = '<html><body><ul class="l"><li><a href="/1">one &amp; two</a><br/>x</li></ul></body></html>'
    want = by_library(page)
    monkeypatch.setattr(PG._TreeBuilder, "parse_starttag", lambda self, i: 1 / 0)
    assert parse_html(page) == want


def test_tags_read_before_are_few(monkeypatch):
    from quarry.sources import pages as PG
    monkeypatch.setattr(PG, "SEEN_MAX", 50)
    PG.SEEN_TAGS.clear()
    for k in range(500):
        rows = parse_html(f'<a href="/{k}"><img src="{"x" * 100}{k}">t</a>')
        assert [r[6] for r in rows[:2]] == [{"href": f"/{k}"}, {"src": "x" * 100 + str(k)}]
        assert len(PG.SEEN_TAGS) <= 50 and max(map(len, PG.SEEN_TAGS)) <= PG.SEEN_CHARS


def test_first_fields_meets_the_nodes_once(spark):
    from quarry.sources.specs import parse_step
    nodes = page_nodes(spark.createDataFrame([(1, "<div><a href='x'>t</a></div>")], "page_id long, html string"))
    els, tx = elements(nodes), texts(nodes)
    ctx = H.page_context(nodes.select("page_id").distinct())
    f = H.first_fields(ctx, els, tx, ["page_id"], {"a": parse_step("find|elem|a")})
    assert f._jdf.queryExecution().analyzed().toString().count("Join ") == 1
    assert [(r.a_found, r.a_attr, r.a_text, r.text) for r in f.collect()] == [(True, "x", "t", "t")]
