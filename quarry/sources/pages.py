"""H1 page_elements: pages -> one node table, parsed once per page.

``nodes(page_id, lo, hi, parent, depth, tag, cls, attrs, n_children, text, raw)``:
elements and text nodes share a counter ``lo`` in document order; an
element's ``hi`` is the last ``lo`` inside it, so "b inside a" is
``a.lo < b.lo <= a.hi`` on the same page.  Text nodes have ``tag = '#text'``
and ``raw`` marks script/style content (not part of an element's text); one
``#document`` row per page (``lo = -1``) is the page itself.

Tree rules follow the standard-library parser the reference uses: an end
tag closes the nearest open element of that name and all opened after it;
an end tag with nothing to close is ignored; void elements close at once;
whatever is open at the end closes with the document.  Script and style
bodies are raw text, so ``"</p>"`` inside a script is not a tag.

The table is written once per job, see ``parsed_nodes``.  The parse is the only Python stage of the pipeline (``mapInArrow``: Arrow
batches in and out); every selector afterwards is a join on this table.
"""

from __future__ import annotations

import re
import sys
import uuid
from html import unescape
from html.parser import HTMLParser

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The parse runs in Python workers: ship this module with the task instead
# of requiring the package to be installed on every executor.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE_SCHEMA = ("page_id long, lo int, hi int, parent int, depth int, tag string, cls string, "
               "attrs map<string,string>, n_children int, text string, raw boolean")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style"))

# Tags that have one reading only, without their brackets: start tags with plain quoted attributes, and end tags.
# What follows some start tags is read in a way of their own: those are left to the library.
PLAIN_TAG = re.compile(r'([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n\r\f]+[a-zA-Z][a-zA-Z0-9-]*="[^"&]*")*)[ \t\n\r\f]*(/?)|/([a-zA-Z][a-zA-Z0-9]*)[ \t\n\r\f]*')
PLAIN_ATTR = re.compile(r'([a-zA-Z][a-zA-Z0-9-]*)="([^"]*)"')
OWN_READING = RAW | frozenset(HTMLParser.CDATA_CONTENT_ELEMENTS) | frozenset(
    "textarea title xmp iframe noembed noframes noscript plaintext".split())
SEEN_TAGS, SEEN_MAX, SEEN_CHARS = {}, 10000, 80        # plain tags read before; at most so many, none longer


def _plain_tag(head: str):
    """(name, attributes, stays open, is an end tag) of a plain tag, or None."""
    m = PLAIN_TAG.fullmatch(head)
    if m is None:
        return None
    tag, attrs, closed, end = m.groups()
    if end is not None:
        tag = end
    tag = tag.lower()
    if tag in OWN_READING and end is None:
        return None
    a = {k.lower(): v for k, v in PLAIN_ATTR.findall(attrs)} if attrs else {}
    got = tag, a, not closed and tag not in VOID, end is not None
    if len(head) <= SEEN_CHARS:
        if len(SEEN_TAGS) >= SEEN_MAX:
            SEEN_TAGS.clear()
        SEEN_TAGS[head] = got
    return got


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows = []     # [lo, hi, parent, depth, tag, cls, attrs, n_children, text, raw]
        self.stack = []
        self.n = 0

    def _new(self, tag, attrs, text=None, raw=False):
        lo = self.n
        self.n += 1
        parent = self.stack[-1] if self.stack else None
        if parent is not None:
            parent[7] += 1
        a = {}
        for k, v in attrs:
            a[k] = "" if v is None else v
        row = [lo, lo, -1 if parent is None else parent[0], len(self.stack), tag,
               a.get("class"), a, 0, text, raw]
        self.rows.append(row)
        return row

    def handle_starttag(self, tag, attrs):
        row = self._new(tag, attrs)
        if tag not in VOID:
            self.stack.append(row)

    def handle_startendtag(self, tag, attrs):
        self._new(tag, attrs)

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][4] == tag:
                for r in self.stack[i:]:
                    r[1] = self.n - 1
                del self.stack[i:]
                return

    def handle_data(self, data):
        raw = bool(self.stack) and self.stack[-1][4] in RAW
        self._new("#text", (), text=data, raw=raw)

    def handle_comment(self, data):
        # a comment is a child (it counts for "found") but carries no text
        self._new("#comment", ())

    def plain(self, html):
        """Reads text and plain tags from the start of ``html`` as the library does; returns where it met anything
        else (or the end).  The library keeps nothing between tokens, so it can go on from there."""
        rows, stack, n = self.rows, self.stack, 0
        pieces = iter(html.split("<"))
        text = next(pieces)
        i = len(text)
        while True:
            if text:
                if "&" in text:
                    text = unescape(text)
                if stack:
                    top = stack[-1]
                    top[7] += 1
                    rows.append([n, n, top[0], len(stack), "#text", None, {}, 0, text, False])
                else:
                    rows.append([n, n, -1, 0, "#text", None, {}, 0, text, False])
                n += 1
            piece = next(pieces, None)
            if piece is None:
                break
            head, bracket, text = piece.partition(">")
            got = bracket and (SEEN_TAGS.get(head) or _plain_tag(head))
            if not got:
                break
            tag, attrs, stays_open, end = got
            if end:
                if stack and stack[-1][4] == tag:
                    stack.pop()[1] = n - 1
                else:
                    self.n = n
                    self.handle_endtag(tag)
            else:
                row = [n, n, -1, len(stack), tag, attrs.get("class"), attrs, 0, None, False]
                if stack:
                    top = stack[-1]
                    top[7] += 1
                    row[2] = top[0]
                rows.append(row)
                n += 1
                if stays_open:
                    stack.append(row)
            i += len(piece) + 1
        self.n = n
        return i

    def finish(self):
        self.close()
        for r in self.stack:
            r[1] = self.n - 1
        self.stack = []
        return self.rows


def parse_html(html: str | None):
    """Rows of one page (plain Python; also the brute-force side in tests)."""
    if html is None:
        return []
    b = _TreeBuilder()
    at = b.plain(html)
    if at < len(html):
        b.feed(html[at:])
    return b.finish()


def _arrow_schema():
    import pyarrow as pa
    return pa.schema([("page_id", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("parent", pa.int32()),
                      ("depth", pa.int32()), ("tag", pa.string()), ("cls", pa.string()),
                      ("attrs", pa.map_(pa.string(), pa.string())), ("n_children", pa.int32()),
                      ("text", pa.string()), ("raw", pa.bool_())])


ROWS_HELD = 20000                   # node rows a Python worker holds before it hands them on, besides one page's


def _parse_arrow(batches):
    """Arrow batches in, Arrow batches out, built column-wise.

    A batch of pages has as many nodes as its pages happen to hold: pages are taken one at a time, and
    their nodes handed on as soon as they are enough for a batch."""
    import pyarrow as pa
    schema = _arrow_schema()

    def batch_of(cols):
        # attrs: None for text nodes and attribute-less elements (smaller, faster)
        cols[7] = [list(a.items()) if a else None for a in cols[7]]
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)

    for batch in batches:
        cols = [[] for _ in range(11)]
        for pid, html in zip(batch.column("page_id").to_pylist(), batch.column("html").to_pylist()):
            rows = parse_html(html)
            top = sum(1 for r in rows if r[2] == -1)
            # one '#document' row per page: the context every selector starts from
            rows.insert(0, [-1, len(rows) - 1, -2, -1, "#document", None, None, top, None, False])
            cols[0].extend([pid] * len(rows))
            for c, values in zip(cols[1:], zip(*rows)):
                c.extend(values)
            if len(cols[0]) >= ROWS_HELD:
                yield batch_of(cols)
                cols = [[] for _ in range(11)]
        if cols[0]:
            yield batch_of(cols)


BUCKET_BYTES = 16 << 20             # html whose nodes one bucket of the node table should hold


def page_nodes(pages: DataFrame) -> DataFrame:
    """H1: parse every page once, where it is read."""
    return pages.select("page_id", "html").mapInArrow(_parse_arrow, NODE_SCHEMA)


def document_context(nodes: DataFrame) -> DataFrame:
    """The page as a selector context, taken from the node table so it keeps
    the node table's partitioning by page_id (no shuffle before the joins)."""
    return nodes.where((F.col("kind") == "e") & (F.col("tag") == "#document") if "kind" in nodes.columns else F.col("tag") == "#document").select(
        "page_id", F.lit(-1).alias("c_lo"), F.lit(2 ** 31 - 1).alias("c_hi"), F.lit(1).alias("c_nc"))


def elements(nodes: DataFrame) -> DataFrame:
    if "kind" in nodes.columns:
        nodes = nodes.where("kind = 'e'").drop("kind", "text", "raw")
    return nodes.where(~F.col("tag").startswith("#"))


def texts(nodes: DataFrame) -> DataFrame:
    if "kind" in nodes.columns:
        return nodes.where("kind = 't'").select("page_id", "lo", "parent", "text")
    return nodes.where((F.col("tag") == "#text") & ~F.col("raw")).select("page_id", "lo", "parent", "text")


def n_buckets(pages: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets of the node table: one for every ``bucket_bytes`` of html, and at least the session's
    shuffle partitions, so the selectors use the cluster however the pages are cut into files."""
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    return max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // bucket_bytes))


def parsed_nodes(pages: DataFrame, checkpoint: bool = True, buckets: int | None = None) -> DataFrame:
    """H1 once per job: the node table as a written columnar store.

    Elements (kind 'e') and texts (kind 't') are Parquet files apart, bucketed by ``page_id`` and
    sorted by page and place, in the shared folder.  Selector joins, windows and aggregates keyed on
    (page_id, ...) run without a shuffle, tag filters and the columns a selector names reach the scan,
    nothing parses twice, and a lost executor does not re-run the parse.  Script and style bodies and
    comments are no text and are left out; the ``#document`` row of each page is kept.
    """
    if not checkpoint:
        return page_nodes(pages)
    from quarry.session import scratch_dir
    spark = pages.sparkSession
    n = buckets or n_buckets(pages)
    text = F.col("tag") == "#text"
    # the html is dealt out, not its many nodes: a task then holds the pages of one bucket and writes one file a kind
    dealt = pages.select("page_id", "html").repartition(n, "page_id")
    rows = (page_nodes(dealt).where(~(text & F.col("raw")) & (F.col("tag") != "#comment"))
            .withColumn("kind", F.when(text, F.lit("t")).otherwise(F.lit("e"))))
    name = f"nodes_{uuid.uuid4().hex}"
    (rows.write.option("path", scratch_dir(spark, name)).partitionBy("kind")
     .bucketBy(n, "page_id").sortBy("page_id", "lo").saveAsTable(name))
    return spark.table(name)
