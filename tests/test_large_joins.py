"""Node tables and page rows are many small rows in small files: no join may send them through the driver."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL

HTML = '<nav><li><a href="/{0}">{0}</a></li><li><a href="/b">b</a></li></nav>'


def _broadcast_rows(df):
    """Broadcast joins of the plan as it was run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin")


def test_selectors_do_not_broadcast_nodes(spark):
    from quarry.operators import selectors as H
    from quarry.sources.pages import document_context, elements, parsed_nodes, texts
    pages = spark.createDataFrame([(i, HTML.format(i)) for i in range(40)], "page_id long, html string")
    nodes = parsed_nodes(pages)
    els, tx = elements(nodes), texts(nodes)
    m = H.select(document_context(nodes), els, "find|elem|nav~find_all|elem|a", ["page_id"])
    href, text = H.attribute(m, els, "href", ["page_id"]), H.element_text(m, tx, ["page_id"])
    for df in (m, href, text, H.download_link(document_context(nodes), els, ["page_id"])):
        assert _broadcast_rows(df) == 0
    assert {(r.page_id, r.href) for r in href.collect()} == {(i, h) for i in range(40) for h in (f"/{i}", "/b")}


@pytest.mark.parametrize("name", ["H17_zip_fields", "F14_has_link", "H12_attribute", "H2_find_all", "H14_card_rows"])
def test_page_queries_do_not_broadcast_page_rows(spark, name):
    assert _broadcast_rows(E.queries()[name](spark, SF_SMALL)) == 0


def test_release_texts_are_not_broadcast(spark):
    df = E.queries()["X2_with_replies"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "rightHint=(strategy=merge)" in df._jdf.queryExecution().optimizedPlan().toString()
    assert "text_row" not in "".join(x for x in plan.splitlines() if "BroadcastHashJoin" in x)


def test_parse_hands_nodes_on_in_bounded_batches():
    from quarry.sources import pages as PG
    n, html = 3000, HTML.format("a") * 10
    batch = pa.RecordBatch.from_pydict({"page_id": list(range(n)), "html": [html] * n})
    out = list(PG._parse_arrow([batch]))
    a_page = len(PG.parse_html(html)) + 1
    assert sum(b.num_rows for b in out) == n * a_page
    assert max(b.num_rows for b in out) <= PG.ROWS_HELD + a_page
    assert list(PG._parse_arrow([batch.slice(0, 0)])) == []


def test_issue_pages_shuffle_keys_not_html(spark):
    from quarry.plans import queries as Q
    for view in (Q.issue_pages, Q.landing_pages):
        plan = view(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        # what is collected per page holds no markup
        assert not [x for x in plan.splitlines() if "partial_collect_list" in x and "<" in x.split("partial_collect_list", 1)[1]], plan


def test_landing_pages_are_built_once(spark):
    from quarry.plans import queries as Q
    pages, matched, _ = Q._issue_run(spark, SF_SMALL)
    for df in (pages, matched):
        assert "orders.parquet" not in "".join(df.inputFiles())
    assert pages.where(F.col("html").isNotNull()).count() > 0
