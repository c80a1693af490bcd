"""Exact duplicates by Grace hashing: records go to buckets by a hash of their content, and a bucket
that doesn't fit its table is spilled and dealt out again by another hash."""

from __future__ import annotations

import hashlib
from array import array

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import BLANK_RE, written

BUCKET_BYTES = 64 << 20         # content a bucket should have
TABLE_BYTES = 128 << 20         # content a bucket's table may hold; the rest is spilled
LOCAL_BYTES = 32 << 20          # content the table before the shuffle may hold
ENTRY_BYTES = 160               # memory of an entry besides its content
OUT_BYTES = 8 << 20             # content of a batch that leaves a task

MEMBER, REP, SPILLED = 0, 1, 2


class ContentTable:
    """Open addressing with linear probing; two contents are one only when all their bytes are equal."""

    def __init__(self, budget: int):
        self.budget, self.used = budget, 0
        self.hashes, self.contents = [], []
        self.slots, self.mask = [-1] * 1024, 1023

    def _probe(self, h: int, content: bytes) -> int:
        """The slot of ``content``, or the free slot where it belongs."""
        i = (h * 0x9E3779B97F4A7C15 >> 17) & self.mask
        while (e := self.slots[i]) >= 0 and not (self.hashes[e] == h and self.contents[e] == content):
            i = (i + 1) & self.mask
        return i

    def entry(self, h: int, content: bytes) -> tuple[int, bool]:
        """Number of the content's entry and whether it is new; -1 when it is new and doesn't fit.

        An empty table takes any content, so every bucket gets smaller in every round.
        """
        i = self._probe(h, content)
        if (e := self.slots[i]) >= 0:
            return e, False
        size = len(content) + ENTRY_BYTES
        if self.contents and self.used + size > self.budget:
            return -1, True
        e = self.slots[i] = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.used += size
        if 2 * len(self.contents) > self.mask:
            self.mask = 2 * self.mask + 1
            self.slots = [-1] * (self.mask + 1)
            for k, (h, content) in enumerate(zip(self.hashes, self.contents)):
                self.slots[self._probe(h, content)] = k
        return e, True


def _first(a, b) -> bool:
    """Whether doc_id ``a`` comes before ``b``; null comes last."""
    return a is not None and (b is None or a < b)


def _batches(rows, schema: pa.Schema, content: int):
    """Row tuples as record batches of bounded size; ``content`` is the place of the content."""
    kept, held = [], 0
    for row in rows:
        kept.append(row)
        held += len(row[content] or b"") + 64
        if held > OUT_BYTES:
            yield _batch(kept, schema)
            kept, held = [], 0
    if kept:
        yield _batch(kept, schema)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _rows(batches, *names):
    for batch in batches:
        columns = [batch.column(n) for n in names]
        for lo in range(0, batch.num_rows, 256):
            yield from zip(*[c.slice(lo, 256).to_pylist() for c in columns])


def _collapse(budget: int, id_type: pa.DataType):
    """Equal contents of one task become one REP row, its doc_id the smallest, and MEMBER rows."""
    schema = pa.schema([("kind", pa.int32()), ("rep", pa.int64()), ("doc_id", id_type), ("id", pa.int64()),
                        ("h", pa.int64()), ("n", pa.int64()), ("many", pa.bool_()), ("content", pa.binary())])

    def rows(batches):
        table, base, made = ContentTable(budget), TaskContext.get().partitionId() << 33, 0
        reps = []                                       # of each entry: rep, doc_id, id, n, many
        for doc, ident, h, n, content in _rows(batches, "doc_id", "id", "h", "n", "content"):
            e, new = table.entry(h, content)
            if e < 0:
                yield REP, base + made, doc, ident, h, n, False, content
                made += 1
            elif new:
                reps.append([base + made, doc, ident, n, False])
                made += 1
            else:
                r = reps[e]
                if _first(doc, r[1]):
                    r[1], r[2], doc, ident = doc, ident, r[1], r[2]
                r[3] += n
                r[4] = True
                yield MEMBER, r[0], doc, ident, 0, 0, False, None
        for (rep, doc, ident, n, many), h, content in zip(reps, table.hashes, table.contents):
            yield REP, rep, doc, ident, h, n, many, content

    return lambda batches: _batches(rows(batches), schema, 7)


def _match(budget: int, id_type: pa.DataType):
    """REP rows of a bucket meet in its table; those that find no room are SPILLED, content and all."""
    schema = pa.schema([("kind", pa.int32()), ("rep", pa.int64()), ("doc_id", id_type), ("id", pa.int64()),
                        ("n", pa.int64()), ("many", pa.bool_()), ("content", pa.binary()), ("keep_id", id_type),
                        ("group_size", pa.int64()), ("kept", pa.bool_()), ("text_sha256", pa.string())])
    blank = (None,) * 4

    def rows(batches):
        table = ContentTable(budget)
        size, keeper = array("q"), []                   # of each entry
        entry, rep_of, id_of, many_of, doc_of = array("q"), array("q"), [], array("b"), []   # of each REP row
        for kind, rep, doc, ident, h, n, many, content in _rows(batches, "kind", "rep", "doc_id", "id", "h", "n", "many", "content"):
            if kind == MEMBER:
                yield MEMBER, rep, doc, ident, None, None, None, *blank
                continue
            e, new = table.entry(h, content)
            if e < 0:
                yield SPILLED, rep, doc, ident, n, many, content, *blank
                continue
            if new:
                size.append(0)
                keeper.append((doc, rep))
            size[e] += n
            known, known_rep = keeper[e]
            if _first(doc, known) or (doc == known and rep < known_rep):
                keeper[e] = (doc, rep)
            entry.append(e)
            rep_of.append(rep)
            id_of.append(ident)
            many_of.append(many)
            doc_of.append(doc)
        digests = [hashlib.sha256(c).hexdigest() for c in table.contents]
        for e, rep, ident, many, doc in zip(entry, rep_of, id_of, many_of, doc_of):
            yield REP, rep, doc, ident, None, bool(many), None, keeper[e][0], size[e], keeper[e][1] == rep, digests[e]

    return lambda batches: _batches(rows(batches), schema, 6)


def normalised(text):
    """The text with each run of blanks as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK_RE, " ")


def _n_buckets(content: DataFrame, bucket_bytes: int) -> int:
    """So many that each has ``bucket_bytes`` of the one column's content if it were spread evenly."""
    total = content.agg(F.sum(F.coalesce(F.octet_length(content.columns[0]), F.lit(0)) + ENTRY_BYTES)).first()[0] or 0
    return max(int(content.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // bucket_bytes))


def exact_groups(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, table_bytes: int = TABLE_BYTES,
                 local_bytes: int = LOCAL_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Each task first collapses equal texts in a table of its own, so a text that a third of all rows
    have goes on once per task.  What is left is dealt to buckets by a hash of the content (Spark's
    shuffle files), and each bucket's rows meet in an open-addressing table that compares whole
    contents; memory follows the distinct contents, not the copies.  Contents that find no room
    are written to the shared folder and dealt out again by a hash with another seed, until all fit.
    A row learns its group through the row it collapsed into, not through a hash, so two texts are
    never taken for one.

    Texts are equal when they are identical once each run of blanks is one space; null counts as
    empty, and empty texts equal one another.  The smallest doc_id stays; of rows that share it, one.
    A null doc_id comes after all others and stays only in a group without any.  An empty table
    gives no rows.  Other columns are not read.
    """
    id_type = docs.schema["doc_id"].dataType
    kind = pa.string() if id_type.simpleString() == "string" else pa.int64()
    of_id = "string" if kind == pa.string() else "long"
    rows = docs.select(F.col("doc_id").cast(of_id).alias("doc_id"), F.lit(None).cast("long").alias("id"),
                       F.lit(1).cast("long").alias("n"), normalised(F.col("text")).cast("binary").alias("content"))
    rounds, held = [], docs.select("text")
    while True:
        hashed = rows.withColumn("h", F.xxhash64("content", F.lit(len(rounds))))
        one = hashed.mapInArrow(_collapse(local_bytes, kind), f"kind int, rep long, doc_id {of_id}, id long, h long, "
                                                              "n long, many boolean, content binary")
        # members follow their row, contents their hash: neither lands with all copies of one text
        place = F.when(F.col("kind") == REP, F.col("h")).otherwise(F.xxhash64("rep"))
        dealt = one.repartition(_n_buckets(held, min(bucket_bytes, table_bytes)), place)
        out = written(dealt.mapInArrow(_match(table_bytes, kind), f"kind int, rep long, doc_id {of_id}, id long, n long, "
                      f"many boolean, content binary, keep_id {of_id}, group_size long, kept boolean, text_sha256 string"),
                      f"grace-{len(rounds)}")
        rounds.append(out)
        spilled = out.where(F.col("kind") == SPILLED)
        if spilled.isEmpty():
            break
        rows = spilled.select("doc_id", F.col("rep").alias("id"), "n", "content")
        held = spilled.select("content")
    found = ("keep_id", "group_size", "kept", "text_sha256")
    later = None
    for out in reversed(rounds):
        known = out.where(F.col("kind") == REP).select("rep", "doc_id", "id", "many", *found)
        if later is not None:
            again = later.withColumnRenamed("id", "rep").withColumn("many", F.lit(True))
            known = known.unionByName(out.where(F.col("kind") == SPILLED).select("rep", "id").join(again, "rep"))
        groups = known.where("many").select("rep", "keep_id", "group_size", F.lit(False).alias("kept"), "text_sha256")
        members = out.where(F.col("kind") == MEMBER).select("rep", "doc_id", "id").join(groups, "rep")
        later = known.select("doc_id", "id", *found).unionByName(members.select("doc_id", "id", *found))
        if out is not rounds[0]:
            later = written(later, "grace-later")       # read twice by the round before
    return later.select("doc_id", *found)


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were; see ``exact_groups``.

    Of rows that share doc_id and text one stays, whichever is met first.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("key"),
                         F.sha2(normalised(F.col("text")).cast("binary"), 256).alias("sha"))
    stay = written(exact_groups(docs).where("kept").select(F.col("doc_id").alias("k"), F.col("text_sha256").alias("s")), "grace-stay")
    met = packed.join(stay, F.col("key").eqNullSafe(F.col("k")) & (F.col("sha") == F.col("s")), "left_semi")
    return met.dropDuplicates(["key", "sha"]).select("row.*")


def op12_exact_grace_dedup(spark, sf_dir: str) -> DataFrame:
    from quarry.llm.common import table
    return exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP12_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)
"""
