"""Removal and readable text of one element against plain Python on the parsed tree; dates, links, lookups;
the walk from a landing page to abstracts on hand-written pages."""

import datetime
import random
import re

from pyspark.sql import functions as F

from quarry import params as P
from quarry.functions import dates as D
from quarry.functions import text as T
from quarry.operators import selectors as H
from quarry.operators.joins import lookup, template_match
from quarry.plans.journal_issues import issue_records, journal_issues, listed_issues
from quarry.sources.pages import elements, page_nodes, parse_html, texts
from quarry.sources.specs import parse_spec

LO, HI, TAG, CLS, NC, TEXT, RAW = 0, 1, 4, 5, 7, 8, 9


def html(rng, depth=0):
    out = []
    for _ in range(rng.randint(0, 4)):
        kind = rng.randint(0, 5)
        if kind < 2:
            out.append(rng.choice(["word", " two  words ", "a &amp; b", "\n", "x\ny", "1 < 2"]))
        elif kind == 2:
            out.append(rng.choice(["<br>", "<hr>", "<img src=x>", "<!-- no -->", "<script>var a='<p>';</script>"]))
        elif depth < 4:
            tag = rng.choice(["p", "div", "b", "a", "li", "ul", "h2", "span", "tr", "td", "dd"])
            cls = rng.choice(["", ' class="ad"', ' class="ad big"', ' class="other"'])
            end = f"</{tag}>" if rng.random() < 0.85 else ""
            out.append(f"<{tag}{cls}>{html(rng, depth + 1)}{end}")
    return "".join(out)


def matches(row, st):
    if row[TAG].startswith("#"):
        return False
    return row[TAG] == st.name if st.kind == "elem" else (row[CLS] is not None and (row[CLS] == st.name or st.name in row[CLS].split()))


def gone(rows, ctx, specs):
    inside = [r for r in rows if ctx[LO] < r[LO] <= ctx[HI]]
    out = []
    for spec in specs.split("~"):
        alive = [r for r in inside if not any(a <= r[LO] <= b for a, b in out)]
        for alt in parse_spec(spec):
            st = alt[0]
            hit = [r for r in alive if matches(r, st)]
            hit = hit[slice(*H.slice_bounds(st.ints))] if st.find_all and st.ints else hit if st.find_all else hit[:1]
            if hit and (st.find_all or hit[0][NC] > 0):
                break
        out += [(r[LO], r[HI]) for r in hit]
    return sorted({(a, b) for a, b in out if not any(c < a <= d for c, d in out)})


def readable(rows, ctx, spans):
    ev = []
    for r in rows:
        if not ctx[LO] <= r[LO] <= ctx[HI] or any(a <= r[LO] <= b for a, b in spans):
            continue
        if r[TAG] == "#text" and not r[RAW]:
            ev.append((r[LO], 1, " " + re.sub("[ \t\n\r\f\v]+", " ", r[TEXT]) + " "))
        elif r[TAG] in H.BLOCK_MARKS:
            a, b = H.BLOCK_MARKS[r[TAG]]
            ev += [e for e in ((r[LO], 1, a), (r[HI], 2, b)) if e[2]]
    t = "".join(e[2] for e in sorted(ev))
    lines = [re.sub(" +", " ", x).strip(" ") for x in t.split("\n")]
    t = re.sub("\n{3,}", "\n\n", "\n".join(lines)).strip(" \n")
    return t.replace("\x02", "  ").replace("\x03", "    ")


SPECS = ("find_all|class|ad", "find|elem|p", "find|elem|b~find|elem|b", "find_all|elem|li|1|3~find|class|ad",
         "find|elem|missing<>find|elem|a", "find_all|elem|div|-1~find_all|elem|p~find|elem|span", "find|elem|img<>find_all|elem|b|2")


def test_removal_and_text_of_any_element(spark):
    rng = random.Random(11)
    pages = [(k, f"<html><body>{html(rng)}{html(rng)}</body></html>") for k in range(60)]
    nodes = page_nodes(spark.createDataFrame(pages, "page_id long, html string")).cache()
    els, tx = elements(nodes), texts(nodes)
    ctx = els.where(F.col("tag").isin("body", "div", "p", "h2")).select(
        "page_id", F.col("lo").alias("c_lo"), F.col("hi").alias("c_hi"), F.col("n_children").alias("c_nc"))
    trees = {k: parse_html(t) for k, t in pages}
    for spec in SPECS:
        spans = H.removed_spans(ctx, els, spec, ["page_id"]).cache()
        got = {(r.page_id, r.c_lo): [(x.lo, x.hi) for x in r.removed] for r in spans.collect()}
        text = {(r.page_id, r.c_lo): r.text for r in H.block_text(spans, els, tx, ["page_id"]).collect()}
        n = 0
        for k, rows in trees.items():
            for c in rows:
                if c[TAG] in ("body", "div", "p", "h2"):
                    n += 1
                    want = gone(rows, c, spec)
                    assert got[k, c[LO]] == want, (spec, pages[k])
                    assert text[k, c[LO]] == readable(rows, c, want), (spec, pages[k])
        assert n == len(got) == len(text)


def test_find_removes_one_and_the_rest_stays(spark):
    page = "<body><div><p>a</p><p>b</p><span>c</span></div><p>d</p></body>"
    nodes = page_nodes(spark.createDataFrame([(1, page)], "page_id long, html string"))
    els, tx = elements(nodes), texts(nodes)
    left = lambda spec: [r.text for r in H.remove_elements(tx, els, spec).orderBy("lo").collect()]
    assert left("find|elem|p") == ["b", "c", "d"]
    assert left("find|elem|p~find|elem|p") == ["c", "d"]
    assert left("find_all|elem|p|1|3") == ["a", "c"]
    assert left("find|elem|nav<>find|elem|span") == ["a", "b", "d"]


def test_title_without_a_child(spark):
    page = "<h1>Volume 3 <span>(new)</span> Issue</h1><h1>plain</h1>"
    nodes = page_nodes(spark.createDataFrame([(1, page)], "page_id long, html string"))
    els, tx = elements(nodes), texts(nodes)
    ctx = H.select(H.page_context(nodes.select("page_id").distinct()), els, "find_all|elem|h1", ["page_id"]).select("page_id", "c_lo", "c_hi", "c_nc")
    got = lambda spec: [r.text for r in H.title_without_child(ctx, els, tx, spec, ["page_id"]).orderBy("c_lo").collect()]
    assert got("find|elem|span") == ["Volume 3  Issue", "plain"]
    assert got("find_all|elem|span") == ["Volume 3 (new) Issue", "plain"]


def test_several_cards_on_a_page(spark):
    page = "".join(f'<div class="card"><ul><li><strong>{a}</strong> v{k}</li><li>no label</li><li><strong> {b} </strong>w{k}</li></ul></div>'
                   for k, (a, b) in enumerate([("ID", "Posted"), ("Posted", "ID"), ("ID", "ID"), ("Other", "More")]))
    nodes = page_nodes(spark.createDataFrame([(1, page), (2, page)], "page_id long, html string"))
    els, tx = elements(nodes), texts(nodes)
    cards = H.select(H.page_context(nodes.select("page_id").distinct()), els, "find_all|class|card", ["page_id"])
    cards = cards.select("page_id", F.col("c_lo").alias("card_lo"), "c_lo", "c_hi", "c_nc")
    got = H.labelled_items(cards, els, tx, ["page_id", "card_lo"]).orderBy("page_id", "card_lo").collect()
    assert [(r.id, r.posted) for r in got] == [("v0", "w0"), ("w1", "v1"), ("w2", None), (None, None)] * 2


def test_first_date_in_the_text(spark):
    cases = {"issued 2024-05-01, revised may 3, 2023": "2024-05-01", "on 5 june 2022 and may 3, 2023": "2022-06-05",
             "february 30, 2024 then march 1, 2024": "2024-03-01", "june 2022, no. 3 of 2021-01-01": "2022-06-01",
             "3/4/2020 or 2019-01-01": "2020-03-04", "13/40/2020, 2020-02-30": None, "nothing": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.d for r in df.select("t", D.parse_date(F.col("t")).cast("string").alias("d")).collect()}
    assert got == cases


def test_links_of_issues_and_abstracts(spark):
    df = spark.createDataFrame([(" /a\n",), ("https://x.lww.com/b",), (None,)], "h string")
    got = [tuple(r) for r in df.select(T.issue_link(F.col("h"), F.lit("P")), T.abstract_link(F.col("h"), F.lit("P"))).collect()]
    assert got == [("P/a", "P /a\n"), ("Phttps://x.lww.com/b", "https://x.lww.com/b"), (None, None)]


def test_lookup_takes_the_last_row(spark):
    dim = spark.createDataFrame([("1", "z", 1), ("1", "a", 2), ("2", "q", 5)], "k string, name string, line int")
    rows = spark.createDataFrame([("1",), ("2",), ("3",)], "k string")
    got = {r.k: r.name for r in lookup(rows, dim, "k", ["name"], "line").collect()}
    assert got == {"1": "a", "2": "q", "3": None}


LINE = (",,,find|class|issues~find_all|class|issue,True,find|elem|a,find|elem|h3,find|elem|i,find|class|date,,"
        "find|elem|article,find|class|ad,find_all|elem|section,find|elem|b,find|elem|h4~find|elem|a,find_all|elem|p|1,5,,D")
PARAMS = P.RunParams(as_of=datetime.date(2024, 6, 1))


def walk(spark, landing, issue, abstract, templates=(("site.org", LINE), ("short.org", "a,b,c"))):
    pages = spark.createDataFrame(landing, "page_id long, url string, html string, journal long, page_order long")
    t = spark.createDataFrame([(i, k, line) for i, (k, line) in enumerate(templates)], "prio int, keyword string, template string")
    m = template_match(pages.select(F.col("page_id").alias("row_id"), "url"), "url", t)
    matched = m.select(F.col("row_id").alias("page_id"), "keyword", F.lit("https://site.org").alias("prefix"))
    listed = listed_issues(pages, matched, templates, PARAMS).cache()
    form = "page_id long, url string, html string"
    records = issue_records(listed, spark.createDataFrame(issue, form), spark.createDataFrame(abstract, form), templates, PARAMS)
    report = journal_issues(pages, matched, templates, PARAMS)
    return {r.url: r for r in records.collect()}, sorted((r.journal, r.link or "", r.reason) for r in report.collect())


def test_walk_from_landing_page_to_abstracts(spark):
    item = '<div class="issue"><a href=" {0} "><h3>Isé {1} <i>new</i></h3></a><span class="date">{2}</span></div>'
    box = '<div class="issues">%s</div>'
    landing = [(1, "https://site.org/1", box % (item.format("/i1", 1, "May 2024") + item.format("/i2", 2, "3 Jan 2024")
                                                + item.format("/gone", 3, "May 2024") + item.format("/i4", 4, "May 2024") + item.format("/i5", 5, "no")), 7, 1),
               (2, "https://site.org/2", "<p>nothing</p>", 8, 1), (3, "https://short.org/", box, 9, 1),
               (4, "https://else.net/", box, 10, 1), (5, "https://site.org/3", None, 11, 1)]
    art = "<section><b>{0}</b> t{1}<h4><a href='{2}'>x</a></h4></section>"
    issue = [(1, "https://site.org/i1", "<article><h1>T</h1><div class='ad'>buy</div><div class='ad'>stay</div>"
              + art.format("Research", 1, "/a1") + art.format("Letters", 2, "/a2") + art.format(" papers ", 3, "/a3")
              + "<section><b>Articles</b></section>" + art.format("Research Article", 4, "/a4") + "</article>"),
             (2, "https://site.org/i2", "<article>" + art.format("Research", 1, "/lost") + "</article>"),
             (4, "https://site.org/i4", "<p>no article</p>"), (9, "https://site.org/i1", "<p>copy of the url</p>")]
    abstract = [(1, "https://site.org/a1", "<p>head</p><p> first &amp; best </p>"), (3, "https://site.org/a3", "<p>only one</p>"),
                (4, "https://site.org/a4", "<p>a</p><p>fourth</p>")]
    got, report = walk(spark, landing, issue, abstract)
    assert report == [(7, "https://site.org/gone", "ok"), (7, "https://site.org/i1", "ok"), (7, "https://site.org/i2", "ok"),
                      (7, "https://site.org/i4", "ok"), (7, "https://site.org/i5", "date_is_none"),
                      (8, "", "landing_page_containers_html_is_none"), (9, "", "csv_line"), (10, "", "no_template"),
                      (11, "", "landing_page_html_is_none")]
    r = got["https://site.org/i1"]
    # the third accepted article has no link, the second one's page no second paragraph; the fourth comes too late
    assert (r.a_id, r.head, str(r.date), r.abstract_texts, r.reason) == ("7", "Ise 1", "2024-05-01", ["first & best"], "ok")
    assert r.jdata == "# T\n\nstay\n\nResearch t1\n\n#### x\n\nLetters t2\n\n#### x\n\npapers t3\n\n#### x\n\nArticles Research Article t4\n\n#### x"
    assert {u.rsplit("/", 1)[1]: x.reason for u, x in got.items()} == {
        "i1": "ok", "i2": "abstract_missing", "gone": "issue_page_html_is_none", "i4": "description_is_none"}


def test_walk_without_any_template(spark):
    got, report = walk(spark, [(1, "https://x.net/", "<p>a</p>", 1, 1)], [], [], templates=(("short.org", "a,b"),))
    assert got == {} and report == [(1, "", "no_template")]


def test_linked_pages_reads_the_pages_once(spark):
    from quarry.plans.journal_issues import linked_pages
    rows = [(3, "u", "c"), (1, "u", "a"), (1, "u", "a"), (2, "v", "b"), (4, "w", "d"), (None, "v", "n"), (5, None, "e"), (None, "x", "n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    links = spark.createDataFrame([("u",), ("u",), ("v",), ("x",), (None,)], "link string")
    got = linked_pages(pages, links)
    assert sorted(tuple(r) for r in got.collect()) == [(1, "u", "a"), (1, "u", "a"), (2, "v", "b")]
    assert got._jdf.queryExecution().analyzed().toString().count("Join ") == 1
