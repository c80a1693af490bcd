"""Selector operators over the node table.

A *context* frame has key columns plus ``page_id, c_lo, c_hi``; the page
itself is the context ``(-1, MAX)``.  A step joins contexts with matching
elements on ``page_id`` and the containment range ``c_lo < lo <= c_hi``.
Work per page is bounded by the page's size, so the equi key ``page_id``
spreads the join evenly.  Every join here is a merge join, see ``beside``.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import WS
from quarry.operators.joins import beside
from quarry.sources.specs import Step, parse_spec

MAX_POS = 2 ** 31 - 1


def _kp(keys):
    """keys plus page_id, once."""
    return [*keys] + ([] if "page_id" in keys else ["page_id"])


def page_context(pages: DataFrame, keys=("page_id",)) -> DataFrame:
    return pages.select(*keys, *([] if "page_id" in keys else ["page_id"]),
                        F.lit(-1).alias("c_lo"), F.lit(MAX_POS).alias("c_hi"), F.lit(1).alias("c_nc"))


def match_pred(kind: str, name: str) -> Column:
    """H2 predicate: tag name, class (a token or the whole attribute), or any attribute."""
    if kind == "elem":
        return F.col("tag") == F.lit(name)
    if kind == "class":
        # only a class that holds the name somewhere is cut into tokens
        return (F.col("cls") == F.lit(name)) | (F.contains(F.col("cls"), F.lit(name))
                                                & F.array_contains(F.split(F.trim(F.col("cls")), "\\s+"), F.lit(name)))
    return F.try_element_at(F.col("attrs"), F.lit(kind)) == F.lit(name)


def _descendants(ctx: DataFrame, els: DataFrame, kind: str, name: str) -> DataFrame:
    m = els.where(match_pred(kind, name)).select(
        F.col("page_id").alias("_pid"), F.col("lo").alias("m_lo"), F.col("hi").alias("m_hi"),
        F.col("n_children").alias("m_nc"))
    cond = (ctx["page_id"] == m["_pid"]) & (m["m_lo"] > ctx["c_lo"]) & (m["m_lo"] <= ctx["c_hi"])
    return ctx.join(beside(m), cond, "inner").drop("_pid")


def slice_bounds(ints):
    """(start, stop, step) of ``slice(*ints)`` as the reference builds it."""
    ints = list(ints)
    if len(ints) == 1:
        return None, ints[0], None
    if len(ints) == 2:
        return ints[0], ints[1], None
    return ints[0], ints[1], ints[2]


def python_slice_keep(r: Column, n: Column, ints) -> Column:
    """H4: is 0-based rank ``r`` of ``n`` matches inside ``list[slice(*ints)]``."""
    start, stop, step = slice_bounds(ints)
    step = 1 if step is None else step
    lo_clip = 0 if step > 0 else -1

    def bound(v, default):
        if v is None:
            return default
        if v < 0:
            return F.greatest(F.lit(v) + n, F.lit(lo_clip))
        return F.least(F.lit(v), n if step > 0 else n - 1)

    if step > 0:
        s, e = bound(start, F.lit(0)), bound(stop, n)
        return (r >= s) & (r < e) & (((r - s) % step) == 0)
    s, e = bound(start, n - 1), bound(stop, F.lit(-1))
    return (r <= s) & (r > e) & (((s - r) % (-step)) == 0)


def index_keep(r: Column, n: Column, i: int) -> Column:
    """H5: one match by index; negatives count from the end; out of range = none."""
    return r == (F.lit(i) if i >= 0 else n + F.lit(i))


def apply_step(ctx: DataFrame, els: DataFrame, st: Step, keys, op: str = "slice") -> DataFrame:
    """One step (H2/H3 + H4 or H5), evaluated inside every context element
    separately (find = first match per context, slices and indexes per
    context).  Output is a new context frame with the match rank ``c_rank``
    inside its context."""
    j = _descendants(ctx, els, st.kind, st.name)
    part = [*_kp(keys), "c_lo"]
    if not st.find_all:
        # H3: first match only, as an aggregate (no sort of the group)
        first = j.groupBy(*part).agg(F.min_by(F.struct("m_lo", "m_hi", "m_nc"), F.col("m_lo")).alias("_m"))
        out = first.select(*_kp(keys), F.col("_m.m_lo").alias("c_lo"), F.col("_m.m_hi").alias("c_hi"),
                           F.col("_m.m_nc").alias("c_nc"), F.lit(0).alias("c_rank"))
    else:
        w = Window.partitionBy(*part).orderBy("m_lo")
        j = j.withColumn("_r", F.row_number().over(w) - 1)
        if any(i is not None and i < 0 for i in st.ints) or (st.ints and op == "slice" and len(st.ints) > 2):
            # negative positions (and strides, which may step back) need the count
            j = j.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*part)))
        else:
            j = j.withColumn("_n", F.lit(MAX_POS))
        if st.ints:
            if op == "index":
                j = j.where(index_keep(F.col("_r"), F.col("_n"), st.ints[0]))
            else:
                j = j.where(python_slice_keep(F.col("_r"), F.col("_n"), st.ints))
        out = j.select(*_kp(keys), F.col("m_lo").alias("c_lo"), F.col("m_hi").alias("c_hi"),
                       F.col("m_nc").alias("c_nc"), F.col("_r").alias("c_rank"))
    if "c_rank" in ctx.columns:
        # nested contexts can reach the same element: once per key
        out = out.dropDuplicates([*_kp(keys), "c_lo"])
    return out


def chain(ctx: DataFrame, els: DataFrame, steps, keys, op: str = "slice") -> DataFrame:
    """H6: step n+1 searches inside every result of step n."""
    cur = ctx
    for st in steps:
        cur = apply_step(cur, els, st, keys, op)
    if len(steps) > 1:
        w = Window.partitionBy(*keys).orderBy("c_lo")
        cur = cur.withColumn("c_rank", F.row_number().over(w) - 1)
    return cur


def dedicated(ctx: DataFrame, els: DataFrame, spec: str, keys) -> DataFrame:
    """H5/H6 as the article lists use them: a chain of steps whose one number is an index, and where
    every kind but ``elem`` means a class.  There are no alternatives, and a single element counts as
    found whether or not it has children."""
    steps = [replace(st, kind="elem" if st.kind == "elem" else "class") for st in parse_spec(spec)[0]]
    return chain(ctx, els, steps, keys, "index")


def select(ctx: DataFrame, els: DataFrame, spec: str, keys, op: str = "slice") -> DataFrame:
    """H7: alternatives, the first that finds something wins.  'Found' for a
    single element means it has children (as the reference's length test)."""
    alts = parse_spec(spec)
    parts = []
    for i, steps in enumerate(alts):
        r = chain(ctx, els, steps, keys, op).withColumn("alt", F.lit(i))
        single = not steps[-1].find_all
        r = r.withColumn("_found", (F.col("c_nc") > 0) if single else F.lit(True))
        parts.append(r)
    return _first_found(parts, keys)


def _first_found(parts, keys) -> DataFrame:
    """Rows of the first alternative that found something, per key.  With one
    alternative that is just its found rows (no aggregate, no join)."""
    if len(parts) == 1:
        return parts[0].where("_found").drop("_found")
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    best = u.where("_found").groupBy(*keys).agg(F.min("alt").alias("_best"))
    return u.join(beside(best), list(keys)).where(F.col("alt") == F.col("_best")).drop("_best", "_found")


def container_then_content(ctx: DataFrame, els: DataFrame, spec: str, keys) -> DataFrame:
    """H8: alternatives ``container~content``; each alternative starts from
    the context (a failed container does not narrow later alternatives)."""
    parts = []
    for i, alt in enumerate(spec.split("<>")):
        pieces = alt.split("~")
        steps = [parse_spec(p)[0][0] for p in pieces]
        r = chain(ctx, els, steps, keys).withColumn("alt", F.lit(i))
        single = not steps[-1].find_all
        parts.append(r.withColumn("_found", (F.col("c_nc") > 0) if single else F.lit(True)))
    return _first_found(parts, keys)


def removed_spans(ctx: DataFrame, els: DataFrame, specs: str, keys) -> DataFrame:
    """H9: ``ctx`` with ``removed``, the disjoint spans (lo, hi) that ``specs`` take out of each context.

    Several specs are joined by ``~`` and applied in turn: each searches what the ones before it left.
    ``find`` takes the first match only, ``find_all`` its slice; of alternatives (``<>``) the first that
    finds something counts, else the last one.  One join collects a context's candidate elements (bounded
    by the context), the rest is array work on them.  Contexts without a match have an empty array.
    """
    rounds = [[alt[0] for alt in parse_spec(s)] for s in specs.split("~")]
    flags = {(k, i): match_pred(st.kind, st.name) for k, alts in enumerate(rounds) for i, st in enumerate(alts)}
    wanted = None
    for p in flags.values():
        wanted = p if wanted is None else wanted | p
    m = els.where(wanted).select(
        F.col("page_id").alias("_pid"),
        F.struct("lo", "hi", "n_children", *[p.alias(f"f{k}_{i}") for (k, i), p in flags.items()]).alias("_m"))
    part = [*_kp(keys), "c_lo", "c_hi"]
    cond = (ctx["page_id"] == m["_pid"]) & (m["_m.lo"] > ctx["c_lo"]) & (m["_m.lo"] <= ctx["c_hi"])
    got = ctx.join(beside(m), cond, "left").groupBy(*part).agg(F.sort_array(F.collect_list("_m")).alias("_all"))
    gone = F.array().cast("array<struct<lo:int,hi:int>>")

    def inside(x, spans):
        return F.exists(spans, lambda g: (x["lo"] >= g["lo"]) & (x["lo"] <= g["hi"]))

    for k, alts in enumerate(rounds):
        got = got.withColumn("_gone", gone)
        for i, st in enumerate(alts):
            hits = F.filter("_all", lambda x: F.coalesce(x[f"f{k}_{i}"], F.lit(False)) & ~inside(x, F.col("_gone")))
            got = got.withColumn(f"_h{i}", hits if st.find_all else F.slice(hits, 1, 1))
            if st.find_all and st.ints:
                n = F.size(f"_h{i}")
                got = got.withColumn(f"_h{i}", F.filter(f"_h{i}", lambda x, r: python_slice_keep(r, n, st.ints)))
        taken = F.col(f"_h{len(alts) - 1}")
        for i in range(len(alts) - 2, -1, -1):
            found = F.size(f"_h{i}") > 0
            if not alts[i].find_all:
                found = found & (F.get(f"_h{i}", 0)["n_children"] > 0)
            taken = F.when(found, F.col(f"_h{i}")).otherwise(taken)
        gone = F.concat("_gone", F.transform(taken, lambda x: F.struct(x["lo"].alias("lo"), x["hi"].alias("hi"))))
    got = got.withColumn("_gone", F.array_distinct(gone))
    # nested removals: what lies in another span is part of it
    outer = F.filter("_gone", lambda x: ~F.exists("_gone", lambda g: (g["lo"] < x["lo"]) & (x["lo"] <= g["hi"])))
    return got.select(*part, F.array_sort(outer).alias("removed"))


def remove_elements(txts: DataFrame, els: DataFrame, specs: str, ctx: DataFrame | None = None, keys=("page_id",)) -> DataFrame:
    """H9: text nodes without those inside removed subtrees.

    Without ``ctx`` the page is the context and all text nodes of the page are judged; with it only
    text nodes inside a context are kept, each with the context's keys and ``c_lo``."""
    if ctx is None:
        ctx = txts.select("page_id").distinct().select("page_id", F.lit(-1).alias("c_lo"), F.lit(MAX_POS).alias("c_hi"))
        return remove_elements(txts, els, specs, ctx).select(*txts.columns)
    spans = removed_spans(ctx, els, specs, keys)
    t = txts.withColumnRenamed("page_id", "_pid")
    cond = (spans["page_id"] == t["_pid"]) & (t["lo"] > spans["c_lo"]) & (t["lo"] <= spans["c_hi"])
    j = spans.join(beside(t), cond).where(~F.exists("removed", lambda g: (F.col("lo") >= g["lo"]) & (F.col("lo") <= g["hi"])))
    return j.drop("_pid", "removed", "c_hi")


def strip_py(c: Column) -> Column:
    return F.regexp_replace(c, "^" + WS + "+|" + WS + "+$", "")


def element_text(ctx: DataFrame, txts: DataFrame, keys, strip: bool = True) -> DataFrame:
    """Text of each context subtree in document order, stripped.
    Groups are one element of one page, so the list is bounded by page size."""
    t = txts.select(F.col("page_id").alias("_pid"), F.col("lo").alias("t_lo"), "text")
    cond = (ctx["page_id"] == t["_pid"]) & (t["t_lo"] > ctx["c_lo"]) & (t["t_lo"] <= ctx["c_hi"])
    j = ctx.join(beside(t), cond, "left")
    g = j.groupBy(*_kp(keys), "c_lo").agg(
        F.sort_array(F.collect_list(F.struct("t_lo", "text"))).alias("_parts"))
    txt = F.array_join(F.col("_parts.text"), "")
    return g.select(*_kp(keys), "c_lo", (strip_py(txt) if strip else txt).alias("text"))


def first_fields(ctx: DataFrame, els: DataFrame, txts: DataFrame, keys, fields: dict,
                 attr: str = "href") -> DataFrame:
    """Several single-step ``find`` fields of every context in one pass.

    One join of the contexts with their descendant elements and text nodes finds, per
    field, the first match (document order; a match without children is
    'not found', as in ``select``), every link inside the context, the
    context's whole text and each field's text.  Output per key: ``<field>_found``, ``<field>_attr``
    (``attr`` of the match, else of the first link inside it),
    ``<field>_text`` and ``text``.  Groups are one context of one page."""
    kp = _kp(keys)
    preds = {name: match_pred(st.kind, st.name) for name, st in fields.items()}
    any_pred = None
    for p in list(preds.values()) + [F.col("tag") == "a"]:
        any_pred = p if any_pred is None else (any_pred | p)
    m = els.where(any_pred).select(
        F.col("page_id").alias("_pid"), F.col("lo").alias("e_lo"),
        F.struct(F.col("lo").alias("m_lo"), F.col("hi").alias("m_hi"), F.col("n_children").alias("m_nc"),
                 F.try_element_at(F.col("attrs"), F.lit(attr)).alias("m_attr")).alias("_el"),
        (F.col("tag") == "a").alias("m_is_a"), *[p.alias(f"_f_{n}") for n, p in preds.items()],
        F.lit(None).cast("string").alias("_t"))
    t = txts.select(F.col("page_id").alias("_pid"), F.col("lo").alias("e_lo"),
                    F.lit(None).cast(m.schema["_el"].dataType).alias("_el"), F.lit(False).alias("m_is_a"),
                    *[F.lit(False).alias(f"_f_{n}") for n in preds], F.col("text").alias("_t"))
    e = m.unionByName(t)
    cond = (ctx["page_id"] == e["_pid"]) & (e["e_lo"] > ctx["c_lo"]) & (e["e_lo"] <= ctx["c_hi"])
    j = ctx.select(*kp, "c_lo", "c_hi").join(beside(e), cond, "left")
    aggs = [F.sort_array(F.collect_list(F.when(F.col("m_is_a"), F.struct("_el.m_lo", "_el.m_attr")))).alias("_links"),
            F.sort_array(F.collect_list(F.when(F.col("_t").isNotNull(), F.struct(F.col("e_lo").alias("t_lo"), F.col("_t").alias("text"))))).alias("_parts")]
    for n in fields:
        aggs.append(F.min_by("_el", F.when(F.col(f"_f_{n}"), F.col("e_lo"))).alias(f"_m_{n}"))
    b = j.groupBy(*kp, "c_lo", "c_hi").agg(*aggs)
    out = [*kp, strip_py(F.array_join(F.col("_parts.text"), "")).alias("text")]
    for n in fields:
        mm = F.col(f"_m_{n}")
        found = mm.isNotNull() & (mm["m_nc"] > 0)
        inside = F.filter("_links", lambda x: (x["m_lo"] > mm["m_lo"]) & (x["m_lo"] <= mm["m_hi"]))
        own = F.coalesce(mm["m_attr"], F.get(inside, 0)["m_attr"])
        txt = F.array_join(F.filter("_parts", lambda x: (x["t_lo"] > mm["m_lo"]) & (x["t_lo"] <= mm["m_hi"]))["text"], "")
        out += [found.alias(f"{n}_found"), F.when(found, own).alias(f"{n}_attr"), F.when(found, txt).alias(f"{n}_text")]
    return b.select(*out)


def attribute(ctx: DataFrame, els: DataFrame, name: str, keys) -> DataFrame:
    """Attribute of the context element."""
    e = els.select(F.col("page_id").alias("_pid"), F.col("lo").alias("_lo"), "attrs")
    j = ctx.join(beside(e), (ctx["page_id"] == e["_pid"]) & (ctx["c_lo"] == e["_lo"]), "left")
    return j.select(*_kp(keys), "c_lo", F.try_element_at(F.col("attrs"), F.lit(name)).alias(name))


# Entities decoded by html_to_text, '&amp;' last.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))
HTML_TEXT_RULES = (
    ("(?s)<!--.*?-->", ""),
    ("(?is)<script[^>]*>.*?</script>", ""),
    ("(?is)<style[^>]*>.*?</style>", ""),
    ("(?i)<br[^>]*>", "\n"),
    ("(?i)</(p|div|li|h[1-6]|tr|article|section|header|footer|nav|ul|ol|title)>", "\n"),
    ("<[^>]*>", ""),
)
HTML_TEXT_TAIL = (
    ("[ \\t]+", " "),
    ("\\n[ \\t]+", "\n"),
    ("\\n{3,}", "\n\n"),
    ("^[ \\t\\n]+|[ \\t\\n]+$", ""),
)


def html_to_text(html: Column) -> Column:
    """Readable text without links, images, tables, emphasis; all JVM."""
    c = html
    for p, r in HTML_TEXT_RULES:
        c = F.regexp_replace(c, p, r)
    for a, b in ENTITIES:
        c = F.replace(c, F.lit(a), F.lit(b))
    for p, r in HTML_TEXT_TAIL:
        c = F.regexp_replace(c, p, r)
    return c


# What the start and end of an element put into its readable text.
BLOCK_MARKS = {
    **{t: ("\n\n", "\n\n") for t in ("p", "div", "ul", "ol", "dl", "blockquote", "body", "html", "head", "title")},
    **{f"h{n}": ("\n\n" + "#" * n + " ", "\n\n") for n in range(1, 7)},
    "li": ("\n\x02* ", "\n"), "dt": ("\n", "\n"), "dd": ("\n\x03", "\n"), "br": ("\n", ""), "tr": ("", "\n"), "hr": ("\n\n* * *\n\n", ""),
}
BLOCK_TAIL = (("[ \\t]+", " "), (" ?\n ?", "\n"), ("\n{3,}", "\n\n"), ("^[ \\n]+|[ \\n]+$", ""), ("\x02", "  "), ("\x03", "    "))


def block_text(ctx: DataFrame, els: DataFrame, txts: DataFrame, keys) -> DataFrame:
    """H11 for any element: keys, page_id, c_lo, text of each context.

    The element is walked in document order.  Text nodes are parted by a blank and runs of blanks are
    one; block elements (the context itself too) start and end lines, headings and list items get
    their mark, links, images, tables and emphasis leave their text only.  What ``removed`` (array of
    spans, see ``removed_spans``) covers is left out.  A context without text gives an empty string.
    Groups are one element of one page.
    """
    blank = F.regexp_replace("text", WS + "+", " ")
    t = txts.select(F.col("page_id").alias("_pid"), F.col("lo").alias("e_lo"), F.col("lo").alias("at"), F.lit(1).alias("turn"),
                    F.concat(F.lit(" "), blank, F.lit(" ")).alias("piece"))
    marks = F.create_map(*[x for tag, (a, b) in BLOCK_MARKS.items() for x in (F.lit(tag), F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")))])
    b = (els.where(F.col("tag").isin(list(BLOCK_MARKS)))
         .select("page_id", "lo", "hi", marks[F.col("tag")].alias("_m"))
         .select(F.col("page_id").alias("_pid"), F.col("lo").alias("e_lo"), F.explode(F.array(
             F.struct(F.col("lo").alias("at"), F.lit(1).alias("turn"), F.col("_m.a").alias("piece")),
             F.struct(F.col("hi").alias("at"), F.lit(2).alias("turn"), F.col("_m.b").alias("piece")))).alias("_e"))
         .select("_pid", "e_lo", "_e.*").where("piece <> ''"))
    e = t.unionByName(b)
    part = [*_kp(keys), "c_lo", "c_hi"]
    held = ["removed"] if "removed" in ctx.columns else []
    c = ctx.select(*part, *held)
    cond = (c["page_id"] == e["_pid"]) & (e["e_lo"] >= c["c_lo"]) & (e["e_lo"] <= c["c_hi"])
    j = c.join(beside(e), cond, "left")
    piece = F.struct("at", "turn", "piece")
    if held:
        piece = F.when(~F.exists("removed", lambda g: (F.col("e_lo") >= g["lo"]) & (F.col("e_lo") <= g["hi"])), piece)
    g = j.groupBy(*_kp(keys), "c_lo").agg(F.sort_array(F.collect_list(piece)).alias("_pieces"))
    text = F.array_join(F.col("_pieces.piece"), "")
    for pat, rep in BLOCK_TAIL:
        text = F.replace(text, F.lit(pat), F.lit(rep)) if pat in ("\x02", "\x03") else F.regexp_replace(text, pat, rep)
    return g.select(*_kp(keys), "c_lo", text.alias("text"))


def labelled_items(ctx: DataFrame, els: DataFrame, txts: DataFrame, keys, labels=("ID", "Posted")) -> DataFrame:
    """List items with a bold label; every label is read regardless of order.

    ``keys`` name one context, for example (page_id, card_lo): a page may hold any number of cards.
    The item and the bold label's text come from one join of the contexts with items, labels and
    text nodes; the rest is array work inside a context."""
    part = [*_kp(keys), "c_lo", "c_hi"]
    m = els.where(F.col("tag").isin("li", "strong")).select(
        F.col("page_id").alias("_pid"), F.col("lo").alias("e_lo"), F.struct("lo", "hi", (F.col("tag") == "li").alias("li")).alias("_el"),
        F.lit(None).cast("string").alias("_t"))
    t = txts.select(F.col("page_id").alias("_pid"), F.col("lo").alias("e_lo"),
                    F.lit(None).cast(m.schema["_el"].dataType).alias("_el"), F.col("text").alias("_t"))
    e = m.unionByName(t)
    cond = (ctx["page_id"] == e["_pid"]) & (e["e_lo"] > ctx["c_lo"]) & (e["e_lo"] <= ctx["c_hi"])
    g = ctx.select(*part).join(beside(e), cond).groupBy(*_kp(keys)).agg(
        F.array_sort(F.collect_list("_el")).alias("_els"),
        F.array_sort(F.collect_list(F.when(F.col("_t").isNotNull(), F.struct(F.col("e_lo").alias("lo"), F.col("_t").alias("t"))))).alias("_ts"))

    def text_in(el):
        parts = F.filter("_ts", lambda x: (x["lo"] > el["lo"]) & (x["lo"] <= el["hi"]))
        return F.array_join(F.transform(parts, lambda x: x["t"]), "")

    items = F.filter("_els", lambda x: x["li"])
    bold = lambda li: F.get(F.filter("_els", lambda x: ~x["li"] & (x["lo"] > li["lo"]) & (x["lo"] <= li["hi"])), 0)
    read = F.transform(items, lambda li: F.struct(text_in(li).alias("all"), strip_py(text_in(bold(li))).alias("label")))
    g = g.select(*_kp(keys), F.filter(read, lambda x: x["label"].isNotNull()).alias("_items"))
    value = lambda x: strip_py(F.replace(x["all"], x["label"], F.lit("")))
    out = [F.element_at(F.concat(F.array(F.lit(None).cast("string")), F.transform(
        F.filter("_items", lambda x: x["label"] == lab), value)), -1).alias(lab.lower()) for lab in labels]
    return g.where(F.size("_items") > 0).select(*keys, *out)


def download_link(ctx: DataFrame, els: DataFrame, keys) -> DataFrame:
    """The download button's href, else the last link ending '.pdf'."""
    btn = apply_step(ctx, els, Step("find", "class", "btn btn-default btn-block", ()), keys)
    btn = attribute(btn, els, "href", keys).select(*keys, F.col("href").alias("btn_href"))
    links = apply_step(ctx, els, Step("find_all", "elem", "a", ()), keys)
    links = attribute(links, els, "href", keys)
    pdf = (links.where(F.col("href").endswith(".pdf"))
                .groupBy(*keys).agg(F.max_by("href", "c_lo").alias("pdf_href")))
    out = ctx.select(*keys).join(beside(btn), list(keys), "left").join(beside(pdf), list(keys), "left")
    return out.select(*keys, F.coalesce("btn_href", "pdf_href").alias("download"))


def title_format(title: Column, literal: str) -> Column:
    """Remove a literal and trim (Python strip)."""
    return strip_py(F.replace(title, F.lit(literal), F.lit("")) if literal else title)


def title_without_child(ctx: DataFrame, els: DataFrame, txts: DataFrame, spec: str, keys) -> DataFrame:
    """H16, element form ``find|elem|tag`` or ``find|attribute|value``: the trimmed text of each context
    (keys, page_id, c_lo, text) without the trimmed text of the first such element inside it.  No such
    element: the text as it is.  Only ``find`` can remove; another mode leaves the title alone."""
    title = element_text(ctx, txts, keys, strip=False)
    mode, kind, name = (spec.split("|") + ["", ""])[:3]
    if mode != "find":
        return title.withColumn("text", strip_py("text"))
    at = [*_kp(keys), "c_lo"]
    inner = apply_step(ctx.withColumn("_in", F.col("c_lo")), els, Step("find", kind, name, ()), [*keys, "_in"])
    child = element_text(inner, txts, [*keys, "_in"]).select(*_kp(keys), F.col("_in").alias("c_lo"), F.col("text").alias("_child"))
    text = F.when(F.coalesce(F.length("_child"), F.lit(0)) > 0, F.replace("text", "_child", F.lit(""))).otherwise(F.col("text"))
    return title.join(beside(child), at, "left").select(*at, strip_py(text).alias("text"))


def zip_fields(df: DataFrame, titles: str, dates: str, links: str) -> DataFrame:
    """H17 after F10: n-th title, date and link form one record."""
    z = F.arrays_zip(F.col(titles).alias("title"), F.col(dates).alias("date"), F.col(links).alias("link"))
    return df.select("*", F.posexplode(z).alias("n", "_z")).select(
        *[c for c in df.columns if c not in (titles, dates, links)], "n",
        F.col("_z.title").alias("title"), F.col("_z.date").alias("date"), F.col("_z.link").alias("link"))
