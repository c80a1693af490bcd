"""One query per operator of the inventory, on the driver tables.

Each function takes (spark, sf_dir) and returns a DataFrame whose column
names match the oracle SQL.  Phrase lists are parameters; the fixture
parameters below use words that occur in the generated tables (the
shipped lists match nothing there).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import params as P
from quarry.functions import dates as D
from quarry.functions import text as T
from quarry.functions.fold import ascii_fold, transliterate
from quarry.operators import rules as R
from quarry.session import written
from quarry.sources import tables as S

FIXTURE = P.RunParams(
    keyword_skips=("Congreso", "thorre", "schst", "License"),
    signers=("Thnt", "Ère"),
    title_reject=("anonymous", "CLICK", "W-", "illegible"),
    abstract_phrases=("research", "view", "signup"),
    days_back=7, months_back=1,
)


def _as_of():
    return F.lit(FIXTURE.as_of_str).cast("date")


def _docs(spark, sf):
    return S.table(spark, sf, "documents")


# ------------------------------------------------------------------ P
def p1_split_url_field(spark: SparkSession, sf: str) -> DataFrame:
    pg = S.table(spark, sf, "pages")
    host = F.regexp_extract("url", "^(https?://[^/?#]+)", 1)
    field = F.when(F.col("page_id") % 2 == 0, F.concat(F.col("url"), F.lit("|"), host)).otherwise(F.col("url"))
    full, prefix = T.split_url_field(field)
    return pg.select("page_id", full.alias("full_url"), prefix.alias("prefix"))


def p5_resolve_link(spark, sf):
    pg = S.table(spark, sf, "pages")
    host = F.regexp_extract("url", "^(https?://[^/?#]+)", 1)
    x = pg.select("page_id", host.alias("prefix"),
                  F.posexplode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)).alias("n", "href"))
    return x.select("page_id", F.col("n").cast("long").alias("n"), T.issue_link(F.col("href"), F.col("prefix")).alias("link"),
                    T.abstract_link(F.col("href"), F.col("prefix")).alias("abstract_link"))


def p6_truncate_columns(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id",
                    T.truncate(S.first_line(F.col("text")), P.HEADLINE_MAX).alias("headline"),
                    T.truncate(F.col("text"), P.PDF_TITLE_MAX).alias("pdf_title"),
                    F.length(T.truncate(F.col("text"), P.ORIG_TEXT_MAX)).cast("long").alias("orig_len"),
                    T.truncate(F.col("text"), P.POST_SIGNER_MAX).alias("post_signer"))


def p7_article_filename(spark, sf):
    a = S.articles(spark, sf)
    g = S.agencies(spark, sf)
    return a.join(g, "a_id", "left").select(
        "id", T.article_filename(F.col("filename"), F.col("date"), F.col("head")).alias("filename"))


def p8_comment_filename(spark, sf):
    c = S.cards(spark, sf)
    return c.select("event_id", T.comment_filename(F.col("id"), F.col("title")).alias("filename"))


def p9_post_headline(spark, sf):
    a = S.articles(spark, sf)
    return a.select("id", T.post_headline(F.col("journal_name"), F.col("head")).alias("post_headline"))


def p10_article_body(spark, sf):
    a = S.articles(spark, sf)
    body = T.article_body(_as_of(), T.post_headline(F.col("journal_name"), F.col("head")),
                          F.array_join("abstract_texts", " "), F.col("url"))
    return a.select("id", body.alias("body"))


def p11_story_body(spark, sf):
    r = S.replies(spark, sf)
    head, rest = T.split_reply(F.col("reply"))
    link = F.concat(F.lit(P.COMMENT_HOST + "/comment/CV"), F.col("conv_id").cast("string"), F.lit("-"),
                    F.col("turn").cast("string"))
    return r.select("conv_id", "turn", T.story_body(rest, link).alias("body"))


def p12_orig_text(spark, sf):
    from quarry.operators.model_io import prompt_dateline
    d = _docs(spark, sf)
    return d.select("doc_id", T.orig_text(F.col("text"), prompt_dateline(_as_of())).alias("orig_txt"))


def p13_ap_dateline(spark, sf):
    o = S.table(spark, sf, "orders")
    c = S.table(spark, sf, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    lede = F.concat(F.col("c_mktsegment"), F.lit(" DATE"))
    return j.select("o_orderkey", T.ap_dateline(lede, F.to_date("o_orderdate")).alias("lede"))


# ------------------------------------------------------------------ T
def t1_ascii_fold(spark, sf):
    return _docs(spark, sf).select("doc_id", ascii_fold(F.col("text")).alias("text"))


def t2_transliterate(spark, sf):
    return _docs(spark, sf).select("doc_id", transliterate(F.col("text")).alias("text"))


def t3_strip_boilerplate(spark, sf):
    return _docs(spark, sf).select("doc_id", T.strip_boilerplate(F.col("text")).alias("text"))


def t4_drop_headline(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", T.drop_headline(F.col("text"), S.first_line(F.col("text"))).alias("text"))


def t5_normalise_whitespace(spark, sf):
    return _docs(spark, sf).select("doc_id", T.normalise_whitespace(F.col("text")).alias("text"))


def t6_signer_split(spark, sf):
    post, phrase = T.signer_split(F.col("text"), FIXTURE.signers)
    return _docs(spark, sf).select("doc_id", post.alias("post_signer"), phrase.alias("signer"))


def t7_route_box(spark, sf):
    post, _ = T.signer_split(F.col("text"), FIXTURE.signers)
    return _docs(spark, sf).select("doc_id", T.route_box(post, F.col("text")).alias("box"))


def t8_split_reply(spark, sf):
    head, rest = T.split_reply(F.col("reply"))
    return S.replies(spark, sf).select("conv_id", "turn", head.alias("headline"), rest.alias("rest"))


def t9_signer_comment(spark, sf):
    post, phrase = T.signer_split(F.col("text"), FIXTURE.signers)
    return _docs(spark, sf).select("doc_id", T.signer_comment(post, phrase).alias("comment"))


# ------------------------------------------------------------------ D
def date_texts(spark, sf):
    """Date texts in the shapes the sites use, made from o_orderdate."""
    o = S.table(spark, sf, "orders")
    d = F.to_date("o_orderdate")
    mon = F.when(F.month(d) == 9, F.lit("Sept")).otherwise(F.date_format(d, "MMM"))
    k = F.col("o_orderkey") % 6
    txt = (F.when(k == 0, F.concat(F.lit("("), F.lower(F.date_format(d, "MMM")), F.lit(") "), F.year(d).cast("string")))
            .when(k == 1, F.concat(mon, F.lit(" "), F.dayofmonth(d).cast("string"), F.lit(",  "), F.year(d).cast("string")))
            .when(k == 2, F.concat(F.lit("Volume 3, "), F.date_format(d, "MMMM yyyy"), F.lit(", Issue 2")))
            .when(k == 3, F.concat(F.dayofmonth(d).cast("string"), F.lit(" "), F.date_format(d, "MMMM"), F.lit(" "), F.year(d).cast("string")))
            .when(k == 4, F.date_format(d, "yyyy-MM-dd"))
            .otherwise(F.lit("no date here")))
    return o.select("o_orderkey", txt.alias("date_text"))


def d1_clean_date_text(spark, sf):
    return date_texts(spark, sf).select("o_orderkey", D.clean_date_text(F.col("date_text")).alias("cleaned"))


def d2_comma_field_date(spark, sf):
    return date_texts(spark, sf).select("o_orderkey", D.comma_field(D.clean_date_text(F.col("date_text"))).alias("field"))


def d3_comma_pp_title(spark, sf):
    d = _docs(spark, sf)
    t = F.when(F.col("doc_id") % 2 == 0, F.concat(S.first_line(F.col("text")), F.lit(", pp 12-14"))).otherwise(S.first_line(F.col("text")))
    return d.select("doc_id", D.comma_pp_title(t).alias("title"))


def d4_formatting_steps(spark, sf):
    t = date_texts(spark, sf).select("o_orderkey", D.clean_date_text(F.col("date_text")).alias("t"))
    return t.select("o_orderkey", D.format_iso(D.formatting_steps(F.col("t"), "volume 3~issue 2")).alias("date"))


def d5_parse_date(spark, sf):
    t = date_texts(spark, sf).select("o_orderkey", D.clean_date_text(F.col("date_text")).alias("t"))
    return t.select("o_orderkey", D.format_iso(D.parse_date(F.col("t"))).alias("date"))


def d6_parse_posted(spark, sf):
    c = S.cards(spark, sf)
    posted = F.when(F.col("event_id") % 13 == 0, F.date_format("ts", "MMMM d, yyyy")).otherwise(F.col("posted"))
    return c.select("event_id", D.format_iso(D.parse_posted(posted)).alias("posted_date"))


def d7_format_dates(spark, sf):
    o = S.table(spark, sf, "orders")
    d = F.to_date("o_orderdate")
    return o.select("o_orderkey", D.format_iso(d).alias("iso"), D.format_month_year(d).alias("month_year"),
                    D.format_dateline(d).alias("dateline"), D.format_prompt_date(d).alias("prompt_date"))


# ------------------------------------------------------------------ F
def f3_title_reject(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", T.first_contained(S.first_line(F.col("text")), ("anonymous", "THE", "W-", "ére"),
                                                case_sensitive=False).alias("phrase"))


def f4_keyword_skip(spark, sf):
    return _docs(spark, sf).select("doc_id", T.first_contained(F.col("text"), FIXTURE.keyword_skips).alias("word"))


def f5_phrase_allow(spark, sf):
    e = S.table(spark, sf, "events")
    return e.select("event_id", R.phrase_allow(F.concat(F.lit("  "), F.upper("event_type"), F.lit(" ")),
                                               FIXTURE.abstract_phrases).cast("int").alias("allowed"))


def f6_nonempty_description(spark, sf):
    a = S.articles(spark, sf)
    return a.select("id", R.nonempty(F.array_join("abstract_texts", " ")).cast("int").alias("ok"))


def f7_min_length_article(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", F.length("text").cast("long").alias("n"), R.min_length_article(F.col("text")).cast("int").alias("ok"))


def f8_min_length_pdf(spark, sf):
    d = S.pdf_pages(spark, sf)
    from quarry.operators.aggregates import concat_pages
    t = concat_pages(d, "id", "page_no", "text")
    return t.select("id", F.length("text").cast("long").alias("n"), R.min_length_pdf(F.col("text")).cast("int").alias("ok"))


def f9_all_fields_present(spark, sf):
    a = S.articles(spark, sf)
    g = S.agencies(spark, sf)
    j = a.join(g, "a_id", "left").select("id", "a_id", "head", "date", "url", "filename", "lede", "uname")
    return j.select("id", R.first_null_field("a_id", "head", "date", "url", "filename", "lede", "uname").alias("missing"))


def f11_in_day_window(spark, sf):
    e = S.table(spark, sf, "events")
    return e.select("event_id", D.in_day_window(F.to_date("ts"), _as_of(), FIXTURE.days_back).cast("int").alias("ok"))


def f12_in_month_window(spark, sf):
    o = S.table(spark, sf, "orders")
    d = F.to_date("o_orderdate")
    as_of = F.lit("1998-06-15").cast("date")
    return o.select("o_orderkey",
                    D.in_month_window(d, as_of, 1).cast("int").alias("ok_month"),
                    D.in_month_window(d, as_of, 1, "year_aware").cast("int").alias("ok_year"))


def f13_page_cap(spark, sf):
    pg = S.table(spark, sf, "pages")
    # the pages' parameter is `page`; given the list pages' name, and numbers on both sides of the cap
    n = F.coalesce(F.regexp_extract("url", "[?&]page=([0-9]+)", 1).try_cast("int"), F.lit(0)) + F.col("page_id") % 60
    url = F.when(n > 0, F.concat(F.lit("https://lists.example.gov/?pageNumber="), n.cast("string"))).otherwise(F.col("url"))
    return pg.select("page_id", R.page_cap(url, P.PAGE_CAP).cast("int").alias("ok"))


def f15_recipients_valid(spark, sf):
    c = S.table(spark, sf, "customer")
    addr = F.when(F.col("c_custkey") % 2 == 0,
                  F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")))\
            .otherwise(F.concat(F.col("c_name"), F.lit("@example.com")))
    to = F.concat(addr, F.lit("; "), F.lit("desk@example.org"))
    cc = F.when(F.col("c_custkey") % 3 == 0, F.lit("")).otherwise(F.lit("a@example.com,b@example.com"))
    return c.select("c_custkey", R.recipients_valid(to).cast("int").alias("to_ok"),
                    R.recipients_valid(cc, allow_empty=True).cast("int").alias("cc_ok"))


# ------------------------------------------------------------------ templates
# A fixture template for the generated pages (same 19-field layout as the
# shipped ones): issues are the nav list items.
FIXTURE_LINE = (",,,find|elem|nav~find_all|elem|li,True,find|elem|a,find|elem|a,%%%,find|elem|time<>find|elem|h1,,"
                "find|elem|article,find|class|ad~find|elem|footer,find_all|elem|p,find|elem|b,find|elem|a,"
                "find|elem|p,5,,D")


def fixture_templates():
    from quarry.sources.specs import TEMPLATES
    return TEMPLATES + (("blog.", FIXTURE_LINE), (".net", FIXTURE_LINE))


def templates_table(spark):
    rows = [(i, k, line) for i, (k, line) in enumerate(fixture_templates())]
    return spark.createDataFrame(rows, "prio int, keyword string, template string")


def j3_template_match(spark, sf):
    from quarry.operators.joins import template_match
    pg = S.table(spark, sf, "pages").select(F.col("page_id").alias("row_id"), "url")
    m = template_match(pg, "url", templates_table(spark))
    return m.select(F.col("row_id").alias("page_id"), "keyword")


def f2_has_template(spark, sf):
    m = j3_template_match(spark, sf)
    return m.select("page_id", F.when(F.col("keyword").isNull(), F.lit("no_template")).otherwise(F.lit("ok")).alias("reason"))


SPEC_FIELDS = ("journal_containers", "link_data", "headline_data", "date_data", "journal_info_data",
               "journal_info_formatting", "journal_articles", "phrase_tag", "abstract_link", "abstract_text")


def _page_template_fields(spark, sf):
    from quarry.operators.joins import template_match
    from quarry.sources.specs import TEMPLATE_FIELDS
    pg = S.table(spark, sf, "pages").select(F.col("page_id").alias("row_id"), "url")
    m = template_match(pg, "url", templates_table(spark)).where(F.col("template").isNotNull())
    parts = F.split(F.col("template"), ",")
    cols = [F.get(parts, i + 3).alias(f) for i, f in enumerate(TEMPLATE_FIELDS)]
    return m.select(F.col("row_id").alias("page_id"), "keyword", F.size(parts).alias("width"), *cols)


def p2_template_fields(spark, sf):
    from quarry.sources.specs import TEMPLATE_FIELDS, TEMPLATE_WIDTH
    t = _page_template_fields(spark, sf)
    return t.select("page_id", *TEMPLATE_FIELDS,
                    R.parse_flag(F.col("landing_page_gathering")).cast("int").alias("landing_flag"),
                    R.nonblank_flag(F.col("bypass")).cast("int").alias("bypass_flag"),
                    R.multi_issue_flag(F.col("journal_containers")).cast("int").alias("multi_issue"),
                    F.when(F.col("width") < TEMPLATE_WIDTH, F.lit("csv_line")).otherwise(F.lit("ok")).alias("reason"))


def s3_parse_specs(spark, sf):
    from quarry.sources.specs import spec_steps
    t = _page_template_fields(spark, sf)
    long = t.select("page_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("spec"))
                                                     for f in SPEC_FIELDS])).alias("fs"))
    long = long.select("page_id", "fs.field", "fs.spec").where(F.col("spec") != "")
    steps = spec_steps(long, "spec").drop("spec")
    return steps.withColumn("alt", F.col("alt").cast("long")).withColumn("step", F.col("step").cast("long"))


# ------------------------------------------------------------------ sources and sinks
def s1_read_site_config(spark, sf):
    import uuid
    from quarry.session import scratch_dir
    from quarry.sources.sinks import read_site_config, write_site_config
    pg = S.table(spark, sf, "pages")
    host = F.regexp_extract("url", "^https?://([^/?#]+)", 1)
    prefix = F.regexp_extract("url", "^(https?://[^/?#]+)", 1)
    rows = pg.select(F.col("page_id").alias("id"), host.alias("name"),
                     F.when(F.col("page_id") % 3 != 0, F.concat(F.col("url"), F.lit("|"), prefix))
                      .otherwise(F.col("url")).alias("url_field"))
    path = scratch_dir(spark, f"site-config-{uuid.uuid4().hex}")
    write_site_config(rows, path)
    return read_site_config(spark, path)


def s4_read_agencies(spark, sf):
    from quarry.operators.joins import agency_group_join
    c = S.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("a_id"),
                                              F.col("c_name").alias("filename"),
                                              F.concat(F.col("c_mktsegment"), F.lit(" DATE")).alias("lede_raw"),
                                              F.col("c_nationkey").alias("ug_id"))
    g = S.table(spark, sf, "nation").select(F.col("n_nationkey").alias("ug_id"), F.col("n_name").alias("uname"),
                                            F.col("n_name").alias("descrip"))
    j = agency_group_join(c, g, "ug_id", "NATION_1%")
    return j.select("a_id", "filename", T.to_latin1(F.col("lede_raw")).alias("lede"), "uname")


def s5_to_latin1(spark, sf):
    return _docs(spark, sf).select("doc_id", T.to_latin1(F.col("text")).alias("text"))


def s6_read_pages(spark, sf):
    pg = S.issue_html(spark, sf)
    missing = F.col("html").isNull() | (F.length("html") == 0)
    return pg.select("page_id", "url", F.when(missing, F.lit("landing_page_html_is_none")).otherwise(F.lit("ok")).alias("reason"),
                     F.coalesce(F.length("html"), F.lit(0)).cast("long").alias("n_chars"))


def s7_read_pdf_pages(spark, sf):
    return S.pdf_pages(spark, sf).select("id", F.col("page_no").cast("long").alias("page_no"), "text")


def s8_existing_keys(spark, sf):
    from quarry.operators.dedupe import existing_keys
    return existing_keys(S.target_press_release(spark, sf)).distinct()


def _x2(spark, sf, params=None):
    from quarry.plans.press_release import press_release
    return press_release(S.articles(spark, sf), S.agencies(spark, sf), S.target_press_release(spark, sf),
                         params or FIXTURE)


def s9_append_press_release(spark, sf):
    import uuid
    from quarry.plans.press_release import press_release_rows
    from quarry.session import scratch_dir
    from quarry.sources.sinks import append_press_release, read_target
    path = scratch_dir(spark, f"press_release-{uuid.uuid4().hex}")
    append_press_release(press_release_rows(_x2(spark, sf), FIXTURE.as_of_str), path)
    t = read_target(spark, path)
    return t.select("filename", "headline", F.date_format("content_date", "yyyy-MM-dd").alias("content_date"),
                    F.col("a_id").cast("long").alias("a_id"), "box", "story_txt", "uname",
                    F.date_format("date_sent", "yyyy-MM-dd").alias("date_sent"))


def s11_write_text(spark, sf):
    import uuid
    from quarry.session import scratch_dir
    from quarry.sources.sinks import read_target, write_text
    path = scratch_dir(spark, f"journal-text-{uuid.uuid4().hex}")
    x = _x2(spark, sf).where(F.col("reason") == "loaded")
    write_text(x.select("filename", F.col("story_txt").alias("article_body"), "content_date"), path)
    t = read_target(spark, path)
    return t.select("filename", "article_body", F.col("content_date").cast("string").alias("content_date"))


# ------------------------------------------------------------------ joins
def j1_agency_group_join(spark, sf):
    return s4_read_agencies(spark, sf).select("a_id", "filename", "uname")


def j2_lookup(spark, sf):
    from quarry.operators.joins import lookup
    o = S.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("a_id"))
    c = S.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("a_id"), F.col("c_name").alias("filename"))
    j = lookup(o, c, "a_id", ["filename"])
    return j.select("o_orderkey", "filename", F.when(F.col("filename").isNull(), F.lit("no_lede")).otherwise(F.lit("ok")).alias("reason"))


def j4_not_already_stored(spark, sf):
    from quarry.operators.dedupe import not_already_stored
    f = p7_article_filename(spark, sf).where(F.col("filename").isNotNull())
    return not_already_stored(f, S.target_press_release(spark, sf), "filename").select("id", "filename")


def j5_insert_if_absent(spark, sf):
    from quarry.operators.dedupe import insert_if_absent
    # a digest and the length stand for the text as key, so no text is shuffled
    key = F.struct(F.sha2("text", 256).alias("sha"), F.length("text").alias("n"))
    d = _docs(spark, sf).select("doc_id", F.when(F.col("text").isNotNull(), key).alias("key"))
    return insert_if_absent(d, None, "key", "doc_id").select("doc_id", F.col("is_duplicate").cast("int").alias("is_duplicate"))


def comment_pages(spark, sf):
    """Comment pages the cards link to: a document per event id (a derived view)."""
    e = S.table(spark, sf, "events")
    d = _docs(spark, sf)
    # every event has a page: its document is the event id modulo the number of ids (a one-row broadcast)
    n = F.broadcast(d.agg((F.max("doc_id") + 1).alias("_n")))
    j = e.crossJoin(n).withColumn("_doc", F.col("event_id") % F.col("_n")).drop("_n")
    j = j.join(d, F.col("_doc") == d.doc_id, "inner")
    cid = F.concat(F.lit("AG-"), F.col("user_id").cast("string"), F.lit("-"), F.col("event_id").cast("string"))
    return j.select(F.concat(F.lit("/comment/"), cid).alias("url"), F.col("doc_id").alias("pdf_id"), "event_id",
                    F.when(F.col("doc_id") % 9 == 0, F.lit(None).cast("string")).otherwise(S.first_line(F.col("text"))).alias("pdf_title"),
                    F.when(F.col("doc_id") % 10 == 0, F.lit(None).cast("string"))
                     .otherwise(F.concat(F.lit("https://downloads.example.gov/"), F.col("doc_id").cast("string"), F.lit(".pdf"))).alias("download"))


def j6_follow_links(spark, sf):
    from quarry.operators.joins import follow_links
    c = S.cards(spark, sf).select("event_id", "link")
    j = follow_links(c, comment_pages(spark, sf).drop("event_id"), "link", "url")
    return j.select("event_id", F.col("pdf_id").isNotNull().cast("int").alias("has_page"), "pdf_id")


def _requests(spark, sf):
    c = S.table(spark, sf, "conversations")
    return c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("pdf_text"))


def _replies_for_requests(spark, sf):
    return S.replies(spark, sf).select("conv_id", (F.col("turn") - 1).alias("turn"), "reply")


def j7_reply_join(spark, sf):
    from quarry.operators.joins import reply_join
    j = reply_join(_requests(spark, sf), _replies_for_requests(spark, sf), ["conv_id", "turn"])
    return j.select("conv_id", "turn", "reply")


# ------------------------------------------------------------------ ordered
def _card_rules(spark, sf):
    from quarry.operators.ordered import newest_first_key
    c = S.cards(spark, sf).withColumn("k", newest_first_key())
    phrase = T.first_contained(F.col("title"), FIXTURE.title_reject, case_sensitive=False)
    posted = D.parse_posted(F.col("posted"))
    return c.select("*", phrase.alias("phrase"), posted.alias("posted_date"))


def o1_newest_first(spark, sf):
    from quarry.operators.ordered import global_position, newest_first_key
    c = S.cards(spark, sf).select("event_id", "ts").withColumn("k", newest_first_key())
    return global_position(c, "k").select("event_id", "pos")


def o2_doc_limit(spark, sf):
    from quarry.operators.ordered import doc_limit
    return doc_limit(S.cards(spark, sf), 100).select("event_id")


def o3_stop_at_first_old(spark, sf):
    from quarry.operators.ordered import stop_at_first
    c = _card_rules(spark, sf)
    reached = F.col("link").isNotNull() & F.col("phrase").isNull()
    out = ~D.in_day_window(F.col("posted_date"), _as_of(), FIXTURE.days_back)
    s = stop_at_first(c, "k", reached & out)
    return s.where("before_stop").select("event_id")


def o4_stop_after_n_invalid(spark, sf):
    from quarry.operators.ordered import newest_first_key, stop_after_n_invalid
    d = S.issue_dates(spark, sf).withColumn("k", newest_first_key())
    s = stop_after_n_invalid(d, "journal", "k", "invalid", FIXTURE.invalid_limit)
    return s.select("journal", "event_id", F.col("looked_at").cast("int").alias("looked_at"),
                    (F.col("looked_at") & ~F.col("invalid")).cast("int").alias("accepted"))


def o5_first_k_per_issue(spark, sf):
    from quarry.operators.ordered import first_k_per_group, newest_first_key
    e = S.table(spark, sf, "events").where(R.phrase_allow(F.col("event_type"), FIXTURE.abstract_phrases))
    e = e.withColumn("k", newest_first_key())
    return first_k_per_group(e, "user_id", "k", FIXTURE.abstracts_per_issue).select(
        "user_id", "event_id", F.col("rank").cast("long").alias("rank"))


def o7_paginate(spark, sf):
    """List pages are days (newest day = page 1); walk = (page, newest first),
    then the page cap, the doc limit (if any) and the stop at the first old card."""
    from quarry.operators.ordered import paginate, stop_at_first
    c = _card_rules(spark, sf)
    c = c.withColumn("page_no", (F.datediff(_as_of(), F.to_date("ts")) + 1).cast("int"))
    c = c.where(F.col("page_no") <= P.PAGE_CAP).withColumn("pk", paginate("page_no", "k"))
    lim = c.orderBy("pk").limit(FIXTURE_WALK.doc_limit) if FIXTURE_WALK.doc_limit else c
    reached = F.col("link").isNotNull() & F.col("phrase").isNull()
    out = ~D.in_day_window(F.col("posted_date"), _as_of(), FIXTURE.days_back)
    s = stop_at_first(lim, "pk", reached & out)
    return s.where("before_stop").select("event_id", F.col("page_no").cast("long").alias("page_no"))


# ------------------------------------------------------------------ aggregations and outcomes
def a1_join_texts(spark, sf):
    from quarry.operators.aggregates import join_texts
    c = S.table(spark, sf, "conversations")
    return join_texts(c, "conv_id", "turn", "text", " ")


def a2_concat_pages(spark, sf):
    from quarry.operators.aggregates import concat_pages
    return concat_pages(S.pdf_pages(spark, sf), "id", "page_no", "text")


def a4_reason_counts(spark, sf):
    from quarry.operators.aggregates import reason_counts
    return reason_counts(_x2(spark, sf))


def a5_reason_details(spark, sf):
    from quarry.operators.aggregates import reason_details
    return reason_details(_x2(spark, sf), R.reason_labels(spark))


def a6_run_metrics(spark, sf):
    from quarry.operators.aggregates import run_metrics
    return run_metrics(_x2(spark, sf), "loaded")


def a8_bad_characters(spark, sf):
    return _docs(spark, sf).select("doc_id", T.bad_characters(ascii_fold(F.col("text"))).alias("bad"))


def e1_first_failing_rule(spark, sf):
    d = _docs(spark, sf)
    body = F.substring_index(F.col("text"), "\n", -1)
    reason = R.first_failing(
        (~R.nonempty(body), "description_is_none"),
        (T.first_contained(F.col("text"), FIXTURE.keyword_skips).isNotNull(), "keyword"),
        (~R.min_length_article(F.col("text")), "too_short"),
        success="loaded")
    return d.select("doc_id", reason.alias("reason"))


def e2_reason_labels(spark, sf):
    from quarry.operators.aggregates import reason_counts
    c = reason_counts(_x2(spark, sf))
    return c.join(F.broadcast(R.reason_labels(spark)), "reason", "left").select("reason", "label", "n")


def e3_write_outcome(spark, sf):
    a = S.articles(spark, sf)
    a_id = F.when(F.col("id") % 50 == 0, F.concat(F.lit("x"), F.col("a_id"))).otherwise(F.col("a_id"))
    head = T.truncate(T.post_headline(F.col("journal_name"), F.col("head")), P.HEADLINE_MAX)
    return a.select("id", F.coalesce(R.write_outcome(a_id, head), F.lit("loaded")).alias("outcome"))


# ------------------------------------------------------------------ selectors
def _nodes(spark, sf):
    from quarry.sources.pages import parsed_nodes
    return parsed_nodes(S.issue_html(spark, sf))


def _page_ctx(nodes):
    from quarry.sources.pages import document_context
    return document_context(nodes)


def h1_page_elements(spark, sf):
    from quarry.sources.pages import elements
    return elements(_nodes(spark, sf)).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def _nav_links(spark, sf, spec="find|elem|nav~find_all|elem|a"):
    from quarry.operators import selectors as H
    from quarry.sources.pages import elements, texts
    nodes = _nodes(spark, sf)
    els, tx = elements(nodes), texts(nodes)
    m = H.select(_page_ctx(nodes), els, spec, ["page_id"])
    href = H.attribute(m, els, "href", ["page_id"]).select("page_id", "c_lo", "href")
    txt = H.element_text(m, tx, ["page_id"]).select("page_id", "c_lo", "text")
    return m.select("page_id", "c_lo", "c_rank").join(H.beside(href), ["page_id", "c_lo"]).join(H.beside(txt), ["page_id", "c_lo"])


def h2_find_all(spark, sf):
    r = _nav_links(spark, sf)
    return r.select("page_id", F.col("c_rank").cast("long").alias("n"), "href", "text")


def _first_text(spark, sf, spec, strip=True):
    from quarry.operators import selectors as H
    from quarry.sources.pages import elements, texts
    nodes = _nodes(spark, sf)
    els, tx = elements(nodes), texts(nodes)
    m = H.select(_page_ctx(nodes), els, spec, ["page_id"])
    return m, H.element_text(m, tx, ["page_id"], strip=strip)


def h3_find(spark, sf):
    _, t = _first_text(spark, sf, "find|elem|h1")
    return t.select("page_id", "text")


def _li_texts(spark, sf, spec, op="slice"):
    from quarry.operators import selectors as H
    from quarry.sources.pages import elements, texts
    nodes = _nodes(spark, sf)
    els, tx = elements(nodes), texts(nodes)
    m = H.select(_page_ctx(nodes), els, spec, ["page_id"], op=op)
    t = H.element_text(m, tx, ["page_id"])
    return m.select("page_id", "c_lo", "c_rank").join(H.beside(t.select("page_id", "c_lo", "text")), ["page_id", "c_lo"])


def h4_slice_matches(spark, sf):
    r = _li_texts(spark, sf, "find_all|elem|li|1|4")
    return r.select("page_id", F.col("c_rank").cast("long").alias("n"), "text")


def h5_index_match(spark, sf):
    from quarry.operators import selectors as H
    from quarry.sources.pages import elements, texts
    nodes = _nodes(spark, sf)
    els, tx = elements(nodes), texts(nodes)
    # the first kind names a class here, whatever it is called: no page has one, so no page is lost by it
    m = H.dedicated(_page_ctx(nodes), els, "find_all|elem|li|-1", ["page_id"])
    ads = H.dedicated(_page_ctx(nodes), els, "find_all|id|ad|0", ["page_id"])
    both = m.select("page_id", "c_lo", F.lit("li").alias("kind")).unionByName(ads.select("page_id", "c_lo", F.lit("ad").alias("kind")))
    t = H.element_text(m.unionByName(ads), tx, ["page_id"])
    return both.join(H.beside(t), ["page_id", "c_lo"]).select("page_id", "kind", "text")


def h6_chain(spark, sf):
    r = _nav_links(spark, sf, "find|elem|nav~find_all|elem|li~find|elem|a")
    return r.select("page_id", F.col("c_rank").cast("long").alias("n"), "href")


def h7_alternatives(spark, sf):
    from quarry.operators import selectors as H
    m, t = _first_text(spark, sf, "find|elem|time<>find|elem|h1")
    return m.select("page_id", "c_lo", F.col("alt").cast("long").alias("alt")).join(
        H.beside(t.select("page_id", "c_lo", "text")), ["page_id", "c_lo"]).drop("c_lo")


def h8_container_then_content(spark, sf):
    from quarry.operators import selectors as H
    from quarry.sources.pages import elements, texts
    nodes = _nodes(spark, sf)
    els, tx = elements(nodes), texts(nodes)
    m = H.container_then_content(_page_ctx(nodes), els,
                                 "find|class|missing~find|elem|h1<>find|elem|article~find|elem|h1", ["page_id"])
    t = H.element_text(m, tx, ["page_id"])
    return m.select("page_id", "c_lo", F.col("alt").cast("long").alias("alt")).join(
        H.beside(t.select("page_id", "c_lo", "text")), ["page_id", "c_lo"]).drop("c_lo")


REMOVE_SPEC = "find_all|elem|nav~find_all|elem|script~find_all|elem|style~find_all|elem|footer~find_all|class|ad"


def h9_remove_elements(spark, sf):
    from quarry.operators import selectors as H
    from quarry.sources.pages import elements, texts
    nodes = _nodes(spark, sf)
    els, tx = elements(nodes), texts(nodes)
    kept = H.remove_elements(tx, els, REMOVE_SPEC)
    body = H.select(_page_ctx(nodes), els, "find|elem|body", ["page_id"])
    t = H.element_text(body, kept, ["page_id"])
    # in the navigation: the first link only, then a slice of the items that are left
    nav = H.select(_page_ctx(nodes), els, "find|elem|nav", ["page_id"]).select("page_id", "c_lo", "c_hi", "c_nc")
    some = H.remove_elements(tx, els, "find|elem|missing<>find|elem|a~find_all|elem|li|1|3", nav)
    rest = some.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("lo", "text"))).alias("_t")).select(
        "page_id", H.strip_py(F.array_join(F.transform("_t", lambda x: x["text"]), "")).alias("nav"))
    return t.select("page_id", "text").join(H.beside(rest), "page_id", "left")


def h10_element_text(spark, sf):
    _, t = _first_text(spark, sf, "find|elem|title")
    return t.select("page_id", "text")


def h11_html_to_text(spark, sf):
    from quarry.operators.selectors import html_to_text
    return S.table(spark, sf, "pages").select("page_id", html_to_text(F.col("html")).alias("text"))


def h11_element_to_text(spark, sf):
    """The element form: the navigation of each page, without its advertisements."""
    from quarry.operators import selectors as H
    from quarry.sources.pages import elements, texts
    nodes = _nodes(spark, sf)
    els, tx = elements(nodes), texts(nodes)
    nav = H.select(_page_ctx(nodes), els, "find|elem|nav", ["page_id"]).select("page_id", "c_lo", "c_hi", "c_nc")
    spans = H.removed_spans(nav, els, "find_all|class|ad~find_all|elem|script", ["page_id"])
    return H.block_text(spans, els, tx, ["page_id"]).select("page_id", "text")


def h12_attribute(spark, sf):
    from quarry.operators import selectors as H
    from quarry.sources.pages import elements
    nodes = _nodes(spark, sf)
    els = elements(nodes)
    m = H.select(_page_ctx(nodes), els, "find_all|elem|a", ["page_id"])
    a = H.attribute(m, els, "href", ["page_id"])
    return m.select("page_id", "c_lo", "c_rank").join(H.beside(a.select("page_id", "c_lo", "href")), ["page_id", "c_lo"]) \
            .select("page_id", F.col("c_rank").cast("long").alias("n"), "href")


def h16_title_format(spark, sf):
    from quarry.operators.selectors import title_format
    from quarry.operators import selectors as H
    from quarry.sources.pages import elements, texts
    nodes = _nodes(spark, sf)
    els, tx = elements(nodes), texts(nodes)
    m = H.select(_page_ctx(nodes), els, "find|elem|title", ["page_id"])
    t = H.element_text(m, tx, ["page_id"], strip=False)
    # element form: the first item of the navigation without the text of its link
    li = H.select(_page_ctx(nodes), els, "find|elem|nav~find|elem|li", ["page_id"]).select("page_id", "c_lo", "c_hi", "c_nc")
    bare = H.title_without_child(li, els, tx, "find|elem|a", ["page_id"]).select("page_id", F.col("text").alias("item"))
    return t.select("page_id", title_format(F.col("text"), "%%%").alias("title")).join(H.beside(bare), "page_id", "left")


def h17_zip_fields(spark, sf):
    from quarry.operators import selectors as H
    from quarry.sources.pages import elements, texts
    nodes = _nodes(spark, sf)
    els, tx = elements(nodes), texts(nodes)
    ctx = _page_ctx(nodes)
    lis = H.select(ctx, els, "find|elem|nav~find_all|elem|li", ["page_id"])
    li_t = H.element_text(lis, tx, ["page_id"]).join(H.beside(lis.select("page_id", "c_lo", "c_rank")), ["page_id", "c_lo"])
    links = _nav_links(spark, sf)

    def arr(df, col, name):
        return df.groupBy("page_id").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("c_rank", col))), lambda x: x[col]).alias(name))

    j = arr(li_t, "text", "dates").join(H.beside(arr(links, "text", "titles")), "page_id").join(H.beside(arr(links, "href", "links")), "page_id")
    j = j.where(R.equal_counts(F.col("titles"), F.col("dates"), F.col("links")))
    return H.zip_fields(j, "titles", "dates", "links").select("page_id", F.col("n").cast("long").alias("n"), "title", "date", "link")


def f10_equal_counts(spark, sf):
    from quarry.sources.pages import elements
    els = elements(_nodes(spark, sf))
    c = els.groupBy("page_id").agg(F.count_if(F.col("tag") == "li").alias("n_titles"),
                                   F.count_if(F.col("tag") == "p").alias("n_dates"),
                                   F.count_if(F.col("tag") == "a").alias("n_links"))
    ok = (F.col("n_titles") == F.col("n_dates")) & (F.col("n_dates") == F.col("n_links"))
    return c.select("page_id", "n_titles", "n_dates", "n_links", ok.cast("int").alias("ok"))


def f14_has_link(spark, sf):
    """First nav item; it has no href of its own, so the first link inside it."""
    from quarry.operators import selectors as H
    from quarry.sources.pages import elements
    nodes = _nodes(spark, sf)
    els = elements(nodes)
    item = H.select(_page_ctx(nodes), els, "find|elem|nav~find|elem|li", ["page_id"])
    own = H.attribute(item, els, "href", ["page_id"]).select("page_id", F.col("href").alias("own"))
    inner = H.select(item.select("page_id", "c_lo", "c_hi", "c_nc"), els, "find|elem|a", ["page_id"])
    inner = H.attribute(inner, els, "href", ["page_id"]).select("page_id", F.col("href").alias("inner"))
    pg = S.table(spark, sf, "pages").select("page_id")
    j = pg.join(H.beside(own), "page_id", "left").join(H.beside(inner), "page_id", "left")
    link = F.coalesce("own", "inner")
    return j.select("page_id", link.alias("link"),
                    F.when(link.isNull(), F.lit("link_is_none")).otherwise(F.lit("ok")).alias("reason"))


def _esc(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


CARDS_PER_PAGE = 25


def card_pages(spark, sf):
    """The list pages of the comment site, 25 cards each, newest first (a view Spark builds from
    events): ID before Posted on every fifth card, no link on every seventh."""
    from quarry.operators.ordered import global_position, newest_first_key
    e = S.table(spark, sf, "events").select("ts", "event_id", "user_id", "event_type").withColumn("k", newest_first_key())
    e = global_position(e, "k").withColumn("at", F.col("pos") - 1)
    cid = F.concat(F.lit("AG-"), F.col("user_id").cast("string"), F.lit("-"), F.col("event_id").cast("string"))
    posted = F.concat(F.lit("<li><strong>Posted</strong> "), F.date_format("ts", "MMM d, yyyy"), F.lit("</li>"))
    ident = F.concat(F.lit("<li><strong>ID</strong> "), cid, F.lit("</li>"))
    items = F.when(F.col("event_id") % 5 == 0, F.concat(ident, posted)).otherwise(F.concat(posted, ident))
    title = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("<span>"), _esc(F.col("event_type")), F.lit("</span>"))) \
             .otherwise(F.concat(F.lit('<a href="/comment/'), cid, F.lit('">'), _esc(F.col("event_type")), F.lit("</a>")))
    card = F.concat(F.lit('<div class="card card-type-comment ember-view">'), title, F.lit('<div class="card-metadata"><ul>'),
                    items, F.lit("</ul></div></div>"))
    page = e.groupBy(F.expr(f"at div {CARDS_PER_PAGE}").alias("page_id")).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("at", card.alias("card")))), lambda x: x["card"]), "").alias("cards"))
    out = page.select("page_id", F.concat(F.lit("https://comments.example.gov/list?pageNumber="), (F.col("page_id") + 1).cast("string")).alias("url"),
                      F.concat(F.lit('<html><body><div class="results-container">'), F.col("cards"), F.lit("</div></body></html>")).alias("html"))
    return written(out, "list-pages")           # as a crawl would leave them: a table


def h13_labelled_items(spark, sf):
    from quarry.operators import selectors as H
    from quarry.plans.comments import card_contexts
    cards, els, tx = card_contexts(card_pages(spark, sf))
    keys = ["page_id", "card_lo"]
    meta = H.apply_step(cards, els, H.parse_spec("find|class|card-metadata")[0][0], keys)
    lab = H.labelled_items(meta, els, tx, keys)
    return lab.select(F.element_at(F.split("id", "-"), -1).cast("long").alias("event_id"), "id", "posted")


def h14_card_rows(spark, sf):
    from quarry.plans.comments import cards_from_pages
    c = cards_from_pages(card_pages(spark, sf))
    return c.select("page_id", F.col("n").cast("long").alias("n"), "title",
                    F.when(F.col("link").isNull(), F.lit("link_is_none")).otherwise(F.lit("ok")).alias("reason"))


def comment_page_html(spark, sf):
    cp = comment_pages(spark, sf)
    links = F.when(F.col("download").isNull(), F.lit("")) \
             .when(F.col("pdf_id") % 3 == 0, F.concat(F.lit('<a class="btn btn-default btn-block" href="'), F.col("download"), F.lit('">Download</a>'))) \
             .otherwise(F.concat(F.lit('<a href="/files/a.pdf">a</a><a href="'), F.col("download"), F.lit('">b</a><a href="/files/c.txt">c</a>')))
    title = F.when(F.col("pdf_title").isNull(), F.lit("")) \
             .otherwise(F.concat(F.lit('<h5 class="h5 mt-0 mb-1">'), _esc(F.col("pdf_title")), F.lit("</h5>")))
    html = F.concat(F.lit("<html><body><div>"), title, links, F.lit("</div></body></html>"))
    return _spread_pages(cp.select(F.col("event_id").alias("page_id"), "url", html.alias("html")))


def h15_download_link(spark, sf):
    from quarry.operators import selectors as H
    from quarry.sources.pages import elements, parsed_nodes
    pg = comment_page_html(spark, sf)
    nodes = parsed_nodes(pg)
    els = elements(nodes)
    d = H.download_link(_page_ctx(nodes), els, ["page_id"])
    return d.select(F.col("page_id").alias("event_id"), "download")


# ------------------------------------------------------------------ model tables
def m1_build_requests(spark, sf):
    from quarry.operators.model_io import build_requests, prompt_dateline
    d = _docs(spark, sf).select("doc_id", ascii_fold(F.col("text")).alias("clean"))
    r = build_requests(d, ["doc_id"], "clean", prompt_dateline(_as_of()))
    msgs = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n---\n")
    return r.select("doc_id", "model", msgs.alias("messages"))


def m2_prompt_dateline(spark, sf):
    from quarry.operators.model_io import prompt_dateline
    o = S.table(spark, sf, "orders")
    return o.select("o_orderkey", prompt_dateline(F.to_date("o_orderdate")).alias("dateline"))


def m3_consume_replies(spark, sf):
    from quarry.operators.model_io import consume_replies
    req = _requests(spark, sf).withColumn(
        "link", F.concat(F.lit(P.COMMENT_HOST + "/comment/CV"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")))
    out = consume_replies(req, _replies_for_requests(spark, sf), ["conv_id", "turn"], "pdf_text", "link",
                          signers=FIXTURE.signers)
    return out.select("conv_id", "turn", "headline", "body", "box", "signer_comment", "reply_reason")


# ------------------------------------------------------------------ pipelines X3-X6, S10
import dataclasses as _dc  # noqa: E402

FIXTURE_WALK = _dc.replace(FIXTURE, doc_limit=0)       # the whole walk; O2 is the query for the limit


def x3_comment_cards(spark, sf):
    from quarry.plans.comments import comment_cards
    return comment_cards(_list_cards(spark, sf), FIXTURE_WALK)


def _list_cards(spark, sf):
    """The cards read from the list pages, in the order of the walk."""
    from quarry.plans.comments import cards_from_pages
    c = cards_from_pages(card_pages(spark, sf))
    return c.withColumn("event_id", F.element_at(F.split("id", "-"), -1).cast("long"))


def story_target(spark, sf):
    """Story filenames already stored: the comment pages with pdf_id % 4 = 0."""
    c = S.cards(spark, sf)
    cp = comment_pages(spark, sf).where(F.col("pdf_id") % 4 == 0)
    return c.join(cp, c.link == cp.url).select(T.comment_filename(F.col("id"), F.col("pdf_title")).alias("filename"))


def x4_comment_text(spark, sf):
    return _comment_texts(spark, sf, written(x3_comment_cards(spark, sf), "cards"))


def _comment_texts(spark, sf, cards):
    from quarry.plans.comments import comment_text, read_comment_pages
    accepted = cards.where(F.col("reason") == "accepted").select("link")
    pages = read_comment_pages(comment_page_html(spark, sf), accepted)
    # the file a download link leads to is the document with that number
    pages = pages.withColumn("pdf_id", F.regexp_extract("download", "([0-9]+)[.]pdf$", 1).try_cast("long"))
    return comment_text(cards, pages, S.pdf_pages(spark, sf), story_target(spark, sf))


def _story_inputs(spark, sf):
    req = _requests(spark, sf)
    sid = F.concat(F.lit("CV"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    req = req.select("conv_id", "turn", "pdf_text", sid.alias("id"),
                     S.first_line(F.col("pdf_text")).alias("title"),
                     F.concat(F.lit(P.COMMENT_HOST + "/comment/"), sid).alias("link"),
                     F.struct("conv_id", "turn").alias("req_order"))
    return req, _replies_for_requests(spark, sf)


def x5_story(spark, sf):
    from quarry.plans.story import story
    req, rep = _story_inputs(spark, sf)
    s = story(req, rep, ["conv_id", "turn"], None, FIXTURE, "req_order")
    return s.select("conv_id", "turn", "reason", "filename", "headline", "story_txt", "status", "comments", "orig_txt")


def s10_append_story(spark, sf):
    import uuid
    from quarry.plans.story import story
    from quarry.session import scratch_dir
    from quarry.sources.sinks import append_story, read_target
    req, rep = _story_inputs(spark, sf)
    s = story(req, rep, ["conv_id", "turn"], None, FIXTURE, "req_order").where(F.col("reason") == "added")
    path = scratch_dir(spark, f"story-{uuid.uuid4().hex}")
    append_story(s.drop("conv_id", "turn", "reason"), path)
    t = read_target(spark, path)
    return t.select("filename", "uname", "source", "headline", "story_txt", "status",
                    F.col("content_date").cast("string").alias("content_date"), "comments")


def x6_run_report(spark, sf):
    from quarry.plans.report import run_report
    cards = written(x3_comment_cards(spark, sf), "cards")
    x3, x4 = cards.select("reason", "detail"), _comment_texts(spark, sf, cards).select("reason", "detail")
    outcomes = x3.where(F.col("reason") != "accepted").unionByName(x4)
    counts, _, _ = run_report(outcomes, "added")
    return counts.select("reason", "label", F.col("n").cast("long").alias("n"))


# ------------------------------------------------------------------ requests and replies between runs
def _fresh(spark, name):
    import uuid
    from quarry.session import scratch_dir
    return scratch_dir(spark, f"{name}-{uuid.uuid4().hex}")


def m1_journal_requests(spark, sf):
    from quarry.operators.ledger import request_digest
    from quarry.operators.model_io import journal_requests
    r = journal_requests(S.articles(spark, sf), ["id"])
    return r.select("id", "model", request_digest(F.col("model"), F.col("messages")).alias("request_id"))


def _ask_letters(spark, sf, ledger, letters, run):
    from quarry.operators.model_io import build_requests, prompt_dateline
    rid = F.concat_ws("-", "conv_id", "turn")
    ledger.ask(build_requests(letters.withColumn("record_id", rid), ["record_id", "conv_id", "turn"], "pdf_text",
                              prompt_dateline(_as_of())), run)


def j7_request_ledger(spark, sf):
    """Three runs over the letters of ``conversations``: the first asks for the conversations with an even
    number, the others for all; after the first come the replies of every fourth conversation, after
    the second all; each run takes what is there.  The second run is made twice, as after a failure."""
    from quarry.operators.ledger import RequestLedger, request_digest
    ledger = RequestLedger(spark, _fresh(spark, "ledger"), "conv_id long, turn long")
    letters, replies = _requests(spark, sf), _replies_for_requests(spark, sf)

    def reply(which, run):
        """The service's side: what it is asked, answered from the table."""
        said = ledger.table("records").join(replies.where(which), ["conv_id", "turn"])
        ledger.receive(said.select("request_id", "reply"), run)

    _ask_letters(spark, sf, ledger, letters.where(F.col("conv_id") % 2 == 0), "run-1")
    reply(F.col("conv_id") % 4 == 0, "run-1")
    for run in ("run-2", "run-2"):
        _ask_letters(spark, sf, ledger, letters, run)
        ledger.take(run)
    reply(F.lit(True), "run-2")
    ledger.take("run-3")
    met = ledger.status().join(ledger.table("answered").select("request_id", "reply"), "request_id", "left")
    return met.select("record_id", "request_id", "asked_in", "answered_in", "met_in", "reply")


def x2_with_replies(spark, sf):
    """X2 on the replies to the journal requests; the reply to article k is the first one of conversation k."""
    from quarry.operators.ledger import RequestLedger
    from quarry.operators.model_io import journal_requests
    from quarry.plans.press_release import press_release
    articles = S.articles(spark, sf)
    ledger = RequestLedger(spark, _fresh(spark, "journal-ledger"), "id long")
    ledger.ask(journal_requests(articles.withColumn("record_id", F.col("id").cast("string")), ["record_id", "id"]), "run-1")
    said = S.replies(spark, sf).where("turn = 1").select(F.col("conv_id").alias("id"), "reply")
    # copies of an article are one question, and the service answers it once
    ledger.receive(ledger.table("records").join(said, "id").select("request_id", "reply"), "run-1")
    return press_release(articles, S.agencies(spark, sf), S.target_press_release(spark, sf), FIXTURE, replies=ledger.take("run-1"))


def x5_story_runs(spark, sf):
    """The comment chain from list pages to stored stories in three runs: X3, X4, requests, replies, X5, S10.

    The reply to a comment is the first one of the conversation with its file's number.  Replies of odd
    conversations come after the first run, so the second run adds their stories; the third adds none."""
    from quarry.plans.story import STORY_SCHEMA, ask_stories, open_ledger, publish_stories
    from quarry.sources.sinks import read_committed
    ready = _comment_texts(spark, sf, written(x3_comment_cards(spark, sf), "cards")).where(F.col("reason") == "added")
    pages = comment_pages(spark, sf).select(F.col("url").alias("link"), "pdf_id", F.col("pdf_title").alias("title"))
    texts = ready.select("event_id", "id", F.concat(F.lit("/comment/"), F.col("id")).alias("link"), "clean_text").join(pages, "link")
    texts = written(texts.select(F.col("event_id").alias("position"), "id", "title",
                                 F.concat(F.lit(P.COMMENT_HOST), F.col("link")).alias("link"),
                                 F.col("clean_text").alias("pdf_text"), "pdf_id"), "texts")
    said = S.replies(spark, sf).where("turn = 1").select(F.col("conv_id").alias("pdf_id"), "reply")
    by_link = texts.select(F.col("link").alias("record_id"), "pdf_id").join(said, "pdf_id")
    ledger, target = open_ledger(spark, _fresh(spark, "story-ledger")), _fresh(spark, "stories")
    for run, which in (("run-1", F.col("pdf_id") % 2 == 0), ("run-2", F.lit(True)), ("run-3", F.lit(True))):
        ask_stories(texts, ledger, FIXTURE, run)
        ledger.receive(ledger.table("records").join(by_link.where(which), "record_id").select("request_id", "reply"), run)
        publish_stories(ledger, target, FIXTURE, run)
    t = read_committed(spark, target, STORY_SCHEMA)
    return t.select("batch", "filename", "uname", "source", "headline", "story_txt", "status", "content_date", "comments", "orig_txt")


def x6_journal_report(spark, sf):
    """X6 over the journal chain: landing pages, issue records, press releases."""
    from quarry.plans.journal_issues import issue_records, listed_issues
    from quarry.plans.press_release import press_release
    from quarry.plans.report import journal_report
    pages, matched, tpls = _issue_run(spark, sf)
    listed = written(listed_issues(pages, matched, tpls, FIXTURE_ISSUES), "listed-issues")
    records = written(issue_records(listed, issue_pages(spark, sf), abstract_pages(spark, sf), tpls, FIXTURE_ISSUES), "records")
    ok = records.where(F.col("reason") == "ok").withColumn("journal_name", F.concat(F.lit("Journal "), F.col("a_id")))
    released = press_release(ok, S.agencies(spark, sf), None, FIXTURE_ISSUES).select("reason")
    outcomes = (listed.where(F.col("reason") != "ok").select("reason")
                .unionByName(records.where(F.col("reason") != "ok").select("reason")).unionByName(released))
    sites = pages.join(matched.where(F.col("keyword").isNotNull()), "page_id").select("journal").distinct()
    return journal_report(written(outcomes, "outcomes"), sites, ok.select(F.array_join("abstract_texts", " ").alias("text")))


# ------------------------------------------------------------------ streaming W1-W4
def stage_events(spark, sf, parts=((21, 31), (11, 20), (1, 10))):
    """New files arriving: the events table written as three groups of files, the newest days
    first as in the walk, into a fresh folder under the shared checkpoint dir."""
    import uuid
    from quarry.session import scratch_dir
    base = scratch_dir(spark, f"events-stream-{uuid.uuid4().hex}")
    e = S.table(spark, sf, "events")
    for lo, hi in parts:
        (e.where(F.dayofmonth("ts").between(lo, hi))
          .write.mode("append").parquet(base + "/in"))
    return base, e.schema


def _stream_key():
    return F.concat(F.lit("AG-"), F.col("user_id").cast("string"), F.lit("-"), F.to_date("ts").cast("string"))


def w1_incremental_ingest(spark, sf):
    from quarry.streaming.ingest import file_stream, incremental_ingest
    base, schema = stage_events(spark, sf)
    day = F.to_date("ts").cast("string")
    st = file_stream(spark, base + "/in", schema).withColumn("key", _stream_key()).withColumn("day", day)
    incremental_ingest(st, base + "/target", base + "/ckpt", "key", ["ts", "event_id"], partition_col="day")
    # a rerun on the same folder adds nothing
    st2 = file_stream(spark, base + "/in", schema).withColumn("key", _stream_key()).withColumn("day", day)
    incremental_ingest(st2, base + "/target", base + "/ckpt2", "key", ["ts", "event_id"], partition_col="day")
    return spark.read.parquet(base + "/target").select("key", "event_id")


def w2_stream_dedupe(spark, sf):
    from quarry.streaming.ingest import file_stream, stream_dedupe
    base, schema = stage_events(spark, sf)
    st = file_stream(spark, base + "/in", schema).withColumn("key", _stream_key()) \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    stream_dedupe(st, "key", base + "/out", base + "/ckpt")
    return spark.read.parquet(base + "/out").select("key")


def w3_late_rows(spark, sf):
    from quarry.streaming.ingest import file_stream, late_rows
    base, schema = stage_events(spark, sf)
    st = file_stream(spark, base + "/in", schema).withColumn("ts", F.col("ts").cast("timestamp"))
    late_rows(st, "ts", FIXTURE.as_of_str, FIXTURE.days_back, "10 days", base + "/out", base + "/ckpt")
    return spark.read.parquet(base + "/out").select("event_id")


def w4_daily_outcomes(spark, sf):
    from quarry.streaming.ingest import daily_outcomes, file_stream
    base, schema = stage_events(spark, sf)
    st = file_stream(spark, base + "/in", schema).withColumn("ts", F.col("ts").cast("timestamp"))
    rej = T.first_contained(F.col("event_type"), FIXTURE.title_reject, case_sensitive=False)
    st = st.withColumn("reason", F.when(rej.isNotNull(), F.lit("title_rejected")).otherwise(F.lit("added")))
    daily_outcomes(st, "ts", "reason", base + "/out", base + "/ckpt")
    r = spark.read.parquet(base + "/out")
    return r.select(F.col("day").cast("string").alias("day"), F.col("reason").cast("string").alias("reason"),
                    F.col("n").cast("long").alias("n"))


# ------------------------------------------------------------------ X1
ISSUE_LINE = (",,,find|class|issues~find_all|class|issue,True,find|elem|a,find|elem|a,Issue ,find|class|cover-date,,"
              "find|elem|article,find_all|class|ad,find_all|elem|p,find|elem|b,find|elem|a,find|elem|p,5,,D")
ISSUE_HOST = "https://journals.example.org"
ISSUE_BUCKET = 4096
FIXTURE_ISSUES = _dc.replace(FIXTURE, as_of=__import__("datetime").date(1998, 8, 2), months_back=1,
                             abstract_phrases=P.ABSTRACT_PHRASES)


NO_TEMPLATE, SHORT_TEMPLATE, NO_CONTAINER, NO_HTML = 43, 47, 37, 41       # journals whose pages give no issues: multiples


def landing_pages(spark, sf):
    """Issue list pages made from orders: one page per customer and order-key
    range (at most ISSUE_BUCKET issues a page), issues in key order; every
    eleventh issue has no link.  Some journals have another host, a template
    that is too short, pages without a container or without html."""
    o = date_texts(spark, sf).join(S.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")

    def item(x):
        """The list item; made behind the grouping, so that keys and dates are shuffled, not html."""
        ok = x["o_orderkey"].cast("string")
        label = F.concat(F.lit("Issue "), ok, F.lit(", pp 1-"), (x["o_orderkey"] % 90 + 10).cast("string"))
        li = F.when(x["o_orderkey"] % 11 == 0,
                    F.concat(F.lit('<li class="issue"><span>Issue '), ok, F.lit("</span>")))\
              .otherwise(F.concat(F.lit('<li class="issue"><a href="/issue/'), ok, F.lit('">'), label, F.lit("</a>")))
        return F.concat(li, F.lit('<span class="cover-date">'), _esc(x["date_text"]), F.lit("</span></li>"))

    bucket = (F.col("o_orderkey") / ISSUE_BUCKET).cast("long")
    g = o.select(F.col("o_custkey").alias("journal"), bucket.alias("page_order"), "o_orderkey", "date_text")
    pages = g.groupBy("journal", "page_order").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("o_orderkey", "date_text"))), item), "").alias("body"))
    host = F.when(F.col("journal") % NO_TEMPLATE == 0, F.lit("https://elsewhere.example.net")) \
            .when(F.col("journal") % SHORT_TEMPLATE == 0, F.lit("https://psycnet.example.org")).otherwise(F.lit(ISSUE_HOST))
    box = F.when(F.col("journal") % NO_CONTAINER == 0, F.lit("other")).otherwise(F.lit("issues"))
    html = F.concat(F.lit('<html><body><div class="'), box, F.lit('"><ul>'), F.col("body"), F.lit("</ul></div></body></html>"))
    out = pages.select((F.col("journal") * (1 << 31) + F.col("page_order")).alias("page_id"), "journal", "page_order",
                       F.concat(host, F.lit("/loi/"), F.col("journal").cast("string"), F.lit("?page="),
                                F.col("page_order").cast("string")).alias("url"),
                       F.when(F.col("journal") % NO_HTML != 0, html).alias("html"))
    return _spread_pages(out)


ABSTRACT_DOCS = 1100                # an abstract's document is the part key modulo this; some have no page


def issue_pages(spark, sf):
    """Issue pages made from orders and lineitem: an article per line item, its phrase by the return
    flag, a link to an abstract; every seventh order has no page, every thirteenth page no articles."""
    li = S.table(spark, sf, "lineitem")
    # the place of a row's phrase in text order: " Research ", "Articles", "News"
    kind = F.when(F.col("l_returnflag") == "R", F.lit(0)).when(F.col("l_returnflag") == "A", F.lit(1)).otherwise(F.lit(2))

    def item(x):
        """The article; made behind the grouping, so that keys are shuffled, not html."""
        phrase = F.when(x["kind"] == 0, F.lit(" Research ")).when(x["kind"] == 1, F.lit("Articles")).otherwise(F.lit("News"))
        return F.concat(F.lit("<p><b>"), phrase, F.lit("</b> item "), x["l_linenumber"].cast("string"), F.lit(' <i>of</i> part<br>'), x["l_partkey"].cast("string"),
                        F.when(x["l_linenumber"] % 5 == 4, F.lit("<em>no link</em>")).otherwise(F.concat(
                            F.lit('<a href="/abstract/'), (x["l_partkey"] % ABSTRACT_DOCS).cast("string"), F.lit('">abstract</a>'))),
                        F.lit("</p>"))

    per = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", kind.alias("kind")))), item), "").alias("ps"))
    o = S.table(spark, sf, "orders").where(F.col("o_orderkey") % 7 != 0).select("o_orderkey").join(per, "o_orderkey")
    ok = F.col("o_orderkey").cast("string")
    box = F.when(F.col("o_orderkey") % 13 == 0, F.lit("section")).otherwise(F.lit("article"))
    html = F.concat(F.lit("<html><body><nav>menu</nav><"), box, F.lit("><h2>Issue &amp; list "), ok,
                    F.lit('</h2><div class="ad">buy <p>now</p></div>'), F.col("ps"), F.lit("</"), box, F.lit("></body></html>"))
    return o.select(F.col("o_orderkey").alias("page_id"), F.concat(F.lit(ISSUE_HOST + "/issue/"), ok).alias("url"), html.alias("html"))


def abstract_pages(spark, sf):
    """Abstract pages made from documents; every ninth has no paragraph."""
    d = _docs(spark, sf)
    k = F.col("doc_id").cast("string")
    tag = F.when(F.col("doc_id") % 9 == 0, F.lit("pre")).otherwise(F.lit("p"))
    return d.select(F.col("doc_id").alias("page_id"), F.concat(F.lit(ISSUE_HOST + "/abstract/"), k).alias("url"),
                    F.concat(F.lit("<html><body><"), tag, F.lit(">"), _esc(F.coalesce("text", F.lit(""))), F.lit("</"), tag,
                             F.lit("></body></html>")).alias("html"))


def _spread_pages(pages):
    """Pages built through a shuffle: AQE would coalesce the few bytes into one
    task, but parsing them is CPU work; an explicit page_id partitioning keeps
    every core busy (AQE keeps a user-given partition count)."""
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pages.repartition(n, "page_id")


def _issue_run(spark, sf):
    """(landing pages, their templates, the templates)."""
    from quarry.operators.joins import template_match
    from quarry.sources.specs import TEMPLATES
    tpls = TEMPLATES + (("journals.example.org", ISSUE_LINE),)
    pages = written(landing_pages(spark, sf), "landing-pages")         # as a crawl would leave them: a table
    t = spark.createDataFrame([(i, k, line) for i, (k, line) in enumerate(tpls)], "prio int, keyword string, template string")
    m = template_match(pages.select(F.col("page_id").alias("row_id"), "url"), "url", t)
    return pages, m.select(F.col("row_id").alias("page_id"), "keyword", F.lit(ISSUE_HOST).alias("prefix")), tpls


def x1_journal_issues(spark, sf):
    from quarry.plans.journal_issues import journal_issues
    return journal_issues(*_issue_run(spark, sf), FIXTURE_ISSUES)


def _issue_records(spark, sf):
    """The chain from landing pages to issue records, written once: X1 and X2 read it."""
    from quarry.plans.journal_issues import issue_records, listed_issues
    pages, matched, tpls = _issue_run(spark, sf)
    listed = written(listed_issues(pages, matched, tpls, FIXTURE_ISSUES), "listed-issues")
    return issue_records(listed, issue_pages(spark, sf), abstract_pages(spark, sf), tpls, FIXTURE_ISSUES)


def x1_issue_records(spark, sf):
    r = _issue_records(spark, sf)
    return r.select("a_id", "url", "head", F.date_format("date", "yyyy-MM-dd").alias("date"), "jdata",
                    F.array_join("abstract_texts", "\n--\n").alias("abstracts"), "reason")


def x2_from_issues(spark, sf):
    """Press releases of the complete issue records."""
    r = _issue_records(spark, sf).where(F.col("reason") == "ok")
    issues = r.withColumn("journal_name", F.concat(F.lit("Journal "), F.col("a_id")))
    from quarry.plans.press_release import press_release
    out = press_release(issues, S.agencies(spark, sf), None, FIXTURE_ISSUES)
    return out.drop("id")
