"""Language-model scores: stupid backoff over corpus n-gram counts, the document itself left out."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import tokens as T
from quarry.llm.common import n_words

ALPHA = 0.4
BLOCK_BYTES = 16 << 20       # text in a block, and so n-grams in a block and in a part of the counts


def _grams(column: pa.Array):
    """Unigram and bigram hashes of all words, and where each row's words begin.

    The bigram of a row's first word is not used.
    """
    data, offsets = T.buffers(column)
    uni, rows = T.word_hashes(data, offsets, lower=True)
    uni = T.mix(uni)
    bi = np.zeros(uni.size, dtype=np.uint64)
    bi[1:] = T.gram_hashes(uni, (0, 1))
    return uni, bi, rows


def _inner(rows: np.ndarray, n: int) -> np.ndarray:
    """Which words have a word before them in their row."""
    ok = np.ones(n, dtype=bool)
    ok[rows[:-1][rows[:-1] < n]] = False
    return ok


def _by_block(batches, names):
    """Tables of whole blocks from rows sorted by block."""
    held, block = [], None
    for batch in batches:
        blocks = batch.column("_block").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi > lo:
                if held and blocks[lo] != block:
                    yield block, pa.Table.from_batches(held)
                    held = []
                block = int(blocks[lo])
                held.append(batch.slice(lo, hi - lo).select(names))
    if held:
        yield block, pa.Table.from_batches(held)


def _pieces(table: pa.Table):
    for batch in table.to_batches():
        yield from T.pieces(batch, 2 << 20)


def _counted(table: pa.Table):
    """Distinct n-grams of a block in order, and how often each occurs."""
    keys = []
    for piece in _pieces(table):
        uni, bi, rows = _grams(piece.column("text"))
        keys += [uni, bi[_inner(rows, uni.size)]]
    return np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _cuts(grams: np.ndarray, parts: int) -> np.ndarray:
    """Where the parts of the hash range begin in sorted hashes."""
    edges = (np.arange(1, parts, dtype=np.uint64) * np.uint64(((1 << 64) - 1) // parts))
    return np.concatenate([[0], np.searchsorted(grams, edges), [grams.size]])


_ASK = "part int, _block int, grams array<long>, counts array<int>"
_TOLD = "_block int, part int, totals array<long>"


def _ask(parts: int):
    """The n-grams of each block with their counts in it, a row per part of the hash range."""
    def run(batches):
        for block, table in _by_block(batches, ["text"]):
            grams, counts = _counted(table)
            cuts = _cuts(grams, parts).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(parts, dtype=np.int32)), pa.array(np.full(parts, block, dtype=np.int32)),
                 pa.ListArray.from_arrays(pa.array(cuts), pa.array(grams.view(np.int64))),
                 pa.ListArray.from_arrays(pa.array(cuts), pa.array(counts.astype(np.int32)))], names=["part", "_block", "grams", "counts"])
    return run


def _tell(table: pa.Table) -> pa.Table:
    """One part of the count table, joined to the n-grams asked of it: totals in the asked order."""
    asked = table["grams"].combine_chunks()
    size = np.asarray(asked.value_lengths())
    _, code = np.unique(np.asarray(asked.flatten()), return_inverse=True)
    total = np.bincount(code, weights=np.asarray(table["counts"].combine_chunks().flatten()).astype(np.float64))
    cuts = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    totals = pa.ListArray.from_arrays(pa.array(cuts), pa.array(total[code].astype(np.int64) if code.size else np.zeros(0, np.int64)))
    return pa.table({"_block": table["_block"], "part": table["part"], "totals": totals})


def _own(row: np.ndarray, code: np.ndarray) -> np.ndarray:
    """How often each entry's code occurs in its row."""
    if not code.size:
        return np.zeros(0, dtype=np.int64)
    _, back, count = np.unique(row.astype(np.int64) << 40 | code, return_inverse=True, return_counts=True)
    return count[back]


def _scored(total: int):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        told = told.take(pa.compute.sort_indices(told, sort_keys=[("part", "ascending")]))
        totals = np.asarray(told["totals"].combine_chunks().flatten())
        grams, _ = _counted(docs.select(["text"]))
        out = []
        for piece in _pieces(docs):
            uni, bi, rows = _grams(piece.column("text"))
            n = np.diff(rows)
            row = np.repeat(np.arange(n.size), n)
            inner = _inner(rows, uni.size)
            u = np.searchsorted(grams, uni)
            elsewhere = totals[u] - _own(row, u)
            seen = np.zeros(uni.size, dtype=bool)
            at = np.flatnonzero(inner)
            b = np.searchsorted(grams, bi[at])
            pair = totals[b] - _own(row[at], b)
            seen[at[pair > 0]] = True
            rest = np.maximum(total - n, 1)[row]
            alone = np.log10(np.where(elsewhere > 0, elsewhere, ALPHA) / rest)
            score = np.where(inner, math.log10(ALPHA), 0.0) + alone
            hit = at[pair > 0]
            score[hit] = np.log10(pair[pair > 0] / elsewhere[hit - 1])
            log_score = np.bincount(row, weights=score, minlength=n.size)
            mean = np.where(n > 0, log_score / np.maximum(n, 1), np.nan)
            out.append(pa.table({
                "doc_id": piece.column("doc_id"), "n_words": n.astype(np.int64),
                "n_seen": np.bincount(row, weights=seen, minlength=n.size).astype(np.int64),
                "log_score": np.round(log_score, 4), "mean_log_score": pa.array(np.round(mean, 6), mask=n == 0)}))
        kinds = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_seen", pa.int64()), ("log_score", pa.float64()), ("mean_log_score", pa.float64())])
        return pa.concat_tables(out).cast(kinds) if out else kinds.empty_table()
    return run


def backoff_scores(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, n_seen, log_score, mean_log_score.

    Order two.  A word after another scores count(pair) / count(first) when the pair occurs in
    other documents, else ALPHA times count(word) / words; a first word starts at the latter
    without ALPHA; a word that no other document has counts as ALPHA.  All counts are over all other
    documents.  log_score sums the base-ten logarithms, mean_log_score divides them by the words.

    Documents fall into blocks of about BLOCK_BYTES by a hash, shuffled once.  A block's n-grams
    are counted before anything is shuffled, and sent as arrays by ranges of their hash: part k
    of the count table sums what all blocks send to k, joins it to their n-grams, and answers each
    with totals in the asked order.  The answers meet the block's documents, whose n-grams are
    exploded again and summed per document.  Blocks and parts grow in number with the text.

    Words are taken in lower case (A-Z).  Null, empty and blank texts have no words, log_score 0
    and a null mean.  A null doc_id is kept.  Equal rows count as separate documents.  An empty
    table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    size = docs.agg(F.sum(F.octet_length("text")).alias("b"), F.sum(n_words(F.col("text"))).alias("w")).first()
    blocks = max(1, math.ceil((size["b"] or 0) / BLOCK_BYTES))
    block = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(blocks)).cast("int")
    dealt = docs.withColumn("_block", F.coalesce(block, F.lit(0))).repartition(blocks, "_block")
    asked = dealt.sortWithinPartitions("_block").mapInArrow(_ask(blocks), _ASK)
    told = asked.groupBy("part").applyInArrow(_tell, _TOLD)
    return dealt.groupBy("_block").cogroup(told.groupBy("_block")).applyInArrow(
        _scored(size["w"] or 0), "doc_id long, n_words long, n_seen long, log_score double, mean_log_score double")


def op8_stupid_backoff(spark, sf_dir: str) -> DataFrame:
    from quarry.llm.common import table
    return backoff_scores(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
t AS (SELECT rid, w[i] AS x, CASE WHEN i > 1 THEN w[i - 1] END AS p FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
n AS (SELECT count(*) AS total FROM t),
u AS (SELECT x, count(*) AS c FROM t GROUP BY x),
ud AS (SELECT rid, x, count(*) AS c FROM t GROUP BY rid, x),
b AS (SELECT p, x, count(*) AS c FROM t WHERE p IS NOT NULL GROUP BY p, x),
bd AS (SELECT rid, p, x, count(*) AS c FROM t WHERE p IS NOT NULL GROUP BY rid, p, x),
s AS (
  SELECT t.rid, t.p, u.c - ud.c AS cx, up.c - upd.c AS cp, coalesce(b.c - bd.c, 0) AS cb, greatest(n.total - len(d.w), 1) AS rest
  FROM t JOIN d ON d.rid = t.rid JOIN u ON u.x = t.x JOIN ud ON ud.rid = t.rid AND ud.x = t.x
  LEFT JOIN u up ON up.x = t.p LEFT JOIN ud upd ON upd.rid = t.rid AND upd.x = t.p
  LEFT JOIN b ON b.p = t.p AND b.x = t.x LEFT JOIN bd ON bd.rid = t.rid AND bd.p = t.p AND bd.x = t.x, n),
g AS (
  SELECT rid, count(*) AS n_words, count(*) FILTER (cb > 0) AS n_seen,
         sum(CASE WHEN cb > 0 THEN log10(cb / cp)
             ELSE (CASE WHEN p IS NULL THEN 0.0 ELSE log10(0.4::DOUBLE) END) + log10((CASE WHEN cx > 0 THEN cx::DOUBLE ELSE 0.4::DOUBLE END) / rest) END) AS log_score
  FROM s GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_seen, 0) AS BIGINT) AS n_seen,
       round(coalesce(log_score, 0.0), 4) AS log_score, round(log_score / n_words, 6) AS mean_log_score
FROM d LEFT JOIN g USING (rid)
"""
