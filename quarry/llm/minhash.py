"""MinHash near-duplicates: minima, bands, signature check, full-set check, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import tokens as T
from quarry.llm.common import written
from quarry.llm.components import components

BANDS, ROWS = 24, 4                 # a pair at 0.8 shares no band with probability 3e-6
MINIMA = BANDS * ROWS
SIMILARITY = 80                     # percent
#: bands prove candidates only; a pair whose minima agree in fewer than this share is not
#: looked at: five standard deviations below 0.8
MIN_AGREEING = int(MINIMA * (0.8 - 5 * (0.8 * 0.2 / MINIMA) ** 0.5))

_A = T.mix(np.arange(1, MINIMA + 1, dtype=np.uint64)) | np.uint64(1)
_B = T.mix(np.arange(1001, MINIMA + 1001, dtype=np.uint64))


def shingles(column: pa.Array, size: int):
    """Shingle hashes of all rows and where each row's shingles begin (rows + 1 values).

    A row with fewer words than ``size`` has its whole sequence as one shingle; no words, none.
    """
    data, offsets = T.buffers(column)
    h, rows = T.word_hashes(data, offsets, lower=True)
    n = np.diff(rows)
    full = T.gram_hashes(h, range(size))
    count = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    begin = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(begin[-1], dtype=np.uint64)
    # place k of row r is word rows[r] + k
    at = np.arange(begin[-1]) + np.repeat(rows[:-1] - begin[:-1], count)
    short = np.flatnonzero((n > 0) & (n < size))
    whole = np.ones(begin[-1], dtype=bool)
    whole[begin[short]] = False
    out[whole] = full[at[whole]]
    for r in short:
        x = h[rows[r]: rows[r + 1]]
        out[begin[r]] = T.mix(T.mix((x * T._SLOT[: x.size]).sum(dtype=np.uint64, keepdims=True)) + np.uint64(x.size))[0]
    return out, begin


def _unique_rows(x: np.ndarray, begin: np.ndarray):
    """Distinct values of each row, sorted within the row."""
    row = np.repeat(np.arange(begin.size - 1), np.diff(begin))
    order = np.lexsort((x, row))
    x = x[order]
    first = np.ones(x.size, dtype=bool)
    first[1:] = (x[1:] != x[:-1]) | (row[1:] != row[:-1])
    n = np.bincount(row[first], minlength=begin.size - 1)
    return x[first], np.concatenate([[0], np.cumsum(n)])


_SKETCH = "doc_id long, n_shingles long, s1 long, s2 long, minima array<int>, bands array<long>"


def _sketch(size: int):
    def run(batches):
        for whole in batches:
            for batch in T.pieces(whole):
                x, begin = _unique_rows(*shingles(batch.column("text"), size))
                n = np.diff(begin)
                some = np.flatnonzero(n)
                minima = np.zeros((MINIMA, n.size), dtype=np.uint64)
                sums = np.zeros((2, n.size), dtype=np.uint64)
                if some.size:
                    at = begin[some]
                    for k in range(MINIMA):
                        minima[k, some] = np.minimum.reduceat(x * _A[k] + _B[k], at)
                    sums[0, some] = np.add.reduceat(T.mix(x), at)
                    sums[1, some] = np.add.reduceat(T.mix(x ^ _B[0]), at)
                keys = np.zeros((BANDS, n.size), dtype=np.uint64)
                for b in range(BANDS):
                    part = np.zeros(n.size, dtype=np.uint64)
                    for r in range(ROWS):
                        part = T.mix(part + minima[b * ROWS + r])
                    keys[b] = T.mix(part + np.uint64(b))
                top = (minima >> np.uint64(32)).astype(np.uint32).view(np.int32)
                fixed = lambda m, kind: pa.ListArray.from_arrays(
                    pa.array(np.arange(0, m.size + 1, m.shape[0], dtype=np.int32)), pa.array(np.ascontiguousarray(m.T).ravel(), kind))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(sums[0].view(np.int64)),
                     pa.array(sums[1].view(np.int64)), fixed(top, pa.int32()), fixed(keys.view(np.int64), pa.int64())],
                    names=["doc_id", "n_shingles", "s1", "s2", "minima", "bands"])
    return run


def _sets(size: int):
    def run(batches):
        for whole in batches:
            for batch in T.pieces(whole):
                x, begin = _unique_rows(*shingles(batch.column("text"), size))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(x.view(np.int64)))],
                    names=["node", "items"])
    return run


def _agreeing(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)


def _items(nodes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(node, items): the full sets of the named documents; rows that share a doc_id each bring one."""
    texts = docs.select("doc_id", "text").join(written(nodes.distinct(), "minhash-wanted").withColumnRenamed("node", "doc_id"), "doc_id", "left_semi")
    return written(texts.mapInArrow(_sets(size), "node long, items array<long>"), "minhash-sets")


BLOCK = 1024                        # rows of a band that are compared in one task at a time


def _links_across(similarity: int):
    """Links between members of one block, or of two, that are in different components.

    Overlaps are counted through an index of the block's shingles; only links leave the task.
    """
    def run(table: pa.Table) -> pa.Table:
        node, comp = table["node"].to_numpy(), table["c"].to_numpy()
        lists = table["items"].combine_chunks()
        size = np.asarray(lists.value_lengths())
        begin = np.concatenate([[0], np.cumsum(size)])
        _, code = np.unique(np.asarray(lists.flatten()), return_inverse=True)
        owner = np.repeat(np.arange(node.size), size)[np.argsort(code, kind="stable")]
        count = np.bincount(code) if code.size else np.zeros(0, dtype=np.int64)
        at = np.cumsum(count) - count
        kinds, n = np.unique(comp, return_counts=True)
        us, vs = [], []
        for u in np.flatnonzero(comp != kinds[np.argmax(n)]):
            own = code[begin[u]: begin[u + 1]]
            k = count[own]
            where = np.arange(k.sum()) + np.repeat(at[own] - np.cumsum(k) + k, k)
            common = np.bincount(owner[where], minlength=node.size)
            v = node[(common > 0) & (comp != comp[u]) & (100 * common >= similarity * (size[u] + size - common))]
            us.append(np.minimum(v, node[u]))
            vs.append(np.maximum(v, node[u]))
        flat = lambda x: np.concatenate(x) if x else np.zeros(0, dtype=np.int64)
        return pa.table({"u": flat(us), "v": flat(vs)})
    return run


def _across(members: DataFrame, docs: DataFrame, size: int, similarity: int) -> DataFrame:
    """Links between members (band, node, c, n) of a band whose components c differ.

    A band of n members is split into blocks of about BLOCK rows, and every two blocks meet in a
    task of their own, so a large band is neither one task nor a table of its pairs.
    """
    items = _items(members.select("node"), docs, size)
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = (members.withColumn("k", F.pmod(F.xxhash64("node"), blocks).cast("int"))
            .withColumn("o", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .select("band", F.least("k", "o").alias("k1"), F.greatest("k", "o").alias("k2"), "node", "c"))
    return rows.join(items, "node").groupBy("band", "k1", "k2").applyInArrow(_links_across(similarity), "u long, v long").distinct()


def _linked(pairs: DataFrame, reps: DataFrame, docs: DataFrame, size: int, similarity: int) -> DataFrame:
    """The pairs (u, v) that agree in signature and then in their full sets."""
    sig = reps.select("node", "minima")
    near = written(
        pairs.join(sig.toDF("u", "mu"), "u").join(sig.toDF("v", "mv"), "v")
        .where(_agreeing("mu", "mv") >= MIN_AGREEING).select("u", "v"), "minhash-pairs")
    items = _items(near.select(F.col("u").alias("node")).union(near.select("v")), docs, size)
    both = near.join(items.toDF("u", "iu"), "u").join(items.toDF("v", "iv"), "v")
    common = F.size(F.array_intersect("iu", "iv"))
    return both.where((F.size("iu") > 0) & (F.size("iv") > 0) & (
        100 * common >= similarity * (F.size("iu") + F.size("iv") - common))).select("u", "v").distinct()


def near_duplicates(docs: DataFrame, size: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents whose sets of ``size``-word shingles (A-Z in lower case) are ``similarity`` percent
    alike are linked.  Equal sets form a class, and only one representative of a class is
    compared.  In every band the members meet the smallest and the largest one there, not each
    other.  What the first round of components leaves apart within a band is then compared across
    components in blocks, so a link that neither end has is still found, and only links are emitted.

    Null, empty and blank texts have no shingles and are linked with nothing.  A null doc_id is
    linked with nothing either: component_id is null and the row is kept.  Rows that share a
    doc_id count as one document.  An empty table gives no rows.
    """
    plain = docs.select("doc_id", "text")
    marks = written(plain.mapInArrow(_sketch(size), _SKETCH), "minhash-marks")
    classes = (marks.where("n_shingles > 0 and doc_id is not null")
               .groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("node")))
    classes = written(classes, "minhash-classes")
    reps = written(marks.join(classes.withColumnRenamed("node", "doc_id"), ["s1", "s2", "n_shingles", "doc_id"], "left_semi")
                   .dropDuplicates(["s1", "s2", "n_shingles", "doc_id"])
                   .select(F.col("doc_id").alias("node"), "minima", "bands"), "minhash-reps")
    banded = reps.select("node", F.explode("bands").alias("band"))
    ends = banded.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    shared = written(banded.join(ends, "band"), "minhash-bands")
    star = (shared.where("node <> lo").select(F.col("lo").alias("u"), F.col("node").alias("v"))
            .unionByName(shared.where("node <> hi and node <> lo").select(F.col("node").alias("u"), F.col("hi").alias("v")))
            .distinct())
    links = written(_linked(star, reps, plain, size, similarity), "minhash-links")
    first = written(components(links), "minhash-first")

    # bands whose members are still in several components: compare across them
    placed = (shared.where("node <> lo and node <> hi").join(first, "node", "left")
              .select("band", "node", F.coalesce("component", "node").alias("c")))
    mixed = placed.groupBy("band").agg(F.min("c").alias("a"), F.max("c").alias("b"), F.count("*").alias("n")).where("a < b")
    open_ = written(placed.join(mixed.select("band", "n"), "band"), "minhash-open")
    more = written(_across(open_, plain, size, similarity), "minhash-more")
    final = written(components(links.unionByName(more)), "minhash-components")

    named = classes.join(final, "node", "left").select(
        F.col("s1").alias("_s1"), F.col("s2").alias("_s2"), F.col("n_shingles").alias("_n"),
        F.coalesce("component", "node").alias("_component"))
    out = marks.select("doc_id", "n_shingles", "s1", "s2").join(
        named, (F.col("s1") == F.col("_s1")) & (F.col("s2") == F.col("_s2")) & (F.col("n_shingles") == F.col("_n")), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, size: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component is kept, columns unchanged."""
    gone = near_duplicates(docs, size, similarity).where("not kept").select("doc_id").distinct()
    return docs.join(written(gone, "minhash-gone"), "doc_id", "left_anti").select(*docs.columns)


def op3_minhash_near_dup(spark, sf_dir: str) -> DataFrame:
    from quarry.llm.common import table
    return near_duplicates(table(spark, sf_dir, "documents"), size=4)


# shingles in SQL; a pair is compared when it shares a shingle, components by reaching smaller ids
OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM w)),
n AS (SELECT w.doc_id, CAST(count(g) AS BIGINT) AS n FROM w LEFT JOIN s ON w.doc_id = s.doc_id GROUP BY w.doc_id),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS r FROM n
  UNION SELECT l.v, reach.r FROM reach JOIN links l ON reach.doc_id = l.u),
c AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT n.doc_id, n.n AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept FROM n JOIN c USING (doc_id)
"""
