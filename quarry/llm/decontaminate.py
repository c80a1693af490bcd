"""Benchmark decontamination by spaced-seed hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import tokens as T
from quarry.llm.common import written

#: fixed masks over 8 word positions, 1 compared and 0 ignored.  Together they hit any 14 words
#: with two substitutions and any 18 with three but for one pattern in a thousand
MASKS = ("11011011", "11101011", "10110111", "11100111")
MIN_MATCHED = 12          # words that must agree in an overlap, or
MIN_ITEM_SHARE = 60       # percent of a shorter item's words
MIN_SHARE = 75            # percent of the overlap's words that must agree
MISMATCH = 2              # what a differing word costs while an overlap is extended; an equal one gains 1
FILTER_BITS = 24          # the bit filter of test seeds has 2**FILTER_BITS bits, whatever their number


def _masks():
    return [tuple(i for i, c in enumerate(m) if c == "1") for m in MASKS]


def _seeds(h: np.ndarray, rows: np.ndarray):
    """(seed hash, row, place) of every mask at every place inside one row."""
    row_of = np.repeat(np.arange(rows.size - 1), np.diff(rows))
    for k, mask in enumerate(_masks()):
        g = T.gram_hashes(h, mask)
        ok = np.flatnonzero(row_of[: g.size] == row_of[mask[-1]: mask[-1] + g.size])
        yield T.mix(g[ok] + np.uint64(k)), row_of[ok], ok - rows[row_of[ok]]


_SEED = "seed long, item_id long, item_at long"
_HIT = "seed long, doc_id long, doc_at long"


def _test_seeds(batches):
    for batch in batches:
        ids = batch.column("item_id").to_numpy(zero_copy_only=False)
        h, rows = T.bare_word_hashes(batch.column("text"))
        for seed, row, at in _seeds(h, rows):
            yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), pa.array(ids[row]), pa.array(at)],
                                             names=["seed", "item_id", "item_at"])


def _doc_seeds(bits):
    """Seeds of the documents that the filter of test seeds lets through."""
    def run(batches):
        known = bits.value
        for whole in batches:
            for batch in T.pieces(whole):
                ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
                h, rows = T.bare_word_hashes(batch.column("text"))
                for seed, row, at in _seeds(h, rows):
                    cell = (seed >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                    ok = np.flatnonzero((known[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1)
                    if ok.size:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(seed[ok].view(np.int64)), pa.array(ids[row[ok]]), pa.array(at[ok])], names=["seed", "doc_id", "doc_at"])
    return run


def seed_filter(seeds: DataFrame) -> np.ndarray:
    """Bit filter of the test seeds: 2**FILTER_BITS bits, gathered as the bytes that are not zero."""
    cell = F.shiftrightunsigned("seed", 64 - FILTER_BITS)
    cells = (seeds.select(F.shiftright(cell, 3).alias("byte"), F.pow(F.lit(2), cell % 8).cast("int").alias("bit"))
             .groupBy("byte").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)
    out[cells["byte"].to_numpy()] = cells["bits"].to_numpy()
    return out


def best_overlap(a: np.ndarray, b: np.ndarray, shift: int):
    """Best stretch of equal and substituted words on one diagonal (a[i] against b[i + shift]).

    Equal words gain 1 and others cost MISMATCH; the stretch with the greatest sum is taken.
    Returns (first word of a, its length, words that agree).
    """
    lo, hi = max(0, -shift), min(a.size, b.size - shift)
    if hi <= lo:
        return 0, 0, 0
    same = a[lo:hi] == b[lo + shift: hi + shift]
    total = np.concatenate([[0], np.cumsum(np.where(same, 1, -MISMATCH))])
    low = np.minimum.accumulate(total)
    gain = total - low
    end = int(np.flatnonzero(gain == gain.max())[-1])              # of equal sums the longest stretch
    begin = int(np.flatnonzero(total[: end + 1] == low[end])[0])
    return lo + begin, end - begin, int(same[begin:end].sum())


def words_needed(item_words: int) -> int:
    return min(MIN_MATCHED, -(-MIN_ITEM_SHARE * item_words // 100))


_PAIR = "doc_id long, item_id long, matched long, overlap long, item_words long, doc_begin long"


def _verify(batches):
    """Verified overlaps of (document, item) rows with the shifts at which a seed was hit."""
    for batch in batches:
        texts, items, shifts = (batch.column(c) for c in ("text", "item_text", "shifts"))
        found = []
        for r in range(batch.num_rows):
            b = T.bare_word_hashes(texts.slice(r, 1))[0]
            a = T.bare_word_hashes(items.slice(r, 1))[0]
            best = max((best_overlap(a, b, s)[::-1] + (s,) for s in shifts[r].as_py()), default=(0, 0, 0, 0))
            matched, length, begin, shift = best
            if matched >= words_needed(a.size) and 100 * matched >= MIN_SHARE * length:
                found.append((batch.column("doc_id")[r].as_py(), batch.column("item_id")[r].as_py(), matched, length, a.size, begin + shift))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)],
                                             names=["doc_id", "item_id", "matched", "overlap", "item_words", "doc_begin"])


def leaks(docs: DataFrame, tests: DataFrame) -> DataFrame:
    """One row per document and test item that share a passage, substitutions allowed.

    Columns: doc_id, item_id, matched (words that agree), overlap (words of the passage),
    item_words, doc_begin (its first word in the document).

    Words are taken in lower case (A-Z), with marks counted as blanks.  Every MASK is laid at
    every place; the compared words are hashed, the ignored ones may differ.  Seeds of documents
    pass a bit filter of fixed size (false passes end in the join), join the test seeds on the
    hash, and give shifts between document and item.  Around each shift the best stretch is
    verified on whole texts: MIN_MATCHED words agree (MIN_ITEM_SHARE percent of a shorter
    item), and MIN_SHARE percent of the stretch.

    Null and empty texts have no seeds, nor have texts under the masks' width.  Rows without an
    id are left out.  Rows that share an id each count, and the best overlap is given.  Empty
    tables give no rows.
    """
    docs = docs.select("doc_id", "text").where("doc_id is not null")
    tests = tests.select("item_id", "text").where("item_id is not null")
    seeds = written(tests.mapInArrow(_test_seeds, _SEED).distinct(), "leak-seeds")
    bits = docs.sparkSession.sparkContext.broadcast(seed_filter(seeds))
    hits = docs.mapInArrow(_doc_seeds(bits), _HIT)
    shifts = (hits.join(seeds, "seed").select("doc_id", "item_id", (F.col("doc_at") - F.col("item_at")).alias("shift"))
              .groupBy("doc_id", "item_id").agg(F.collect_set("shift").alias("shifts")))
    shifts = written(shifts, "leak-shifts")
    pairs = (docs.join(shifts, "doc_id").join(tests.withColumnRenamed("text", "item_text"), "item_id")
             .select("doc_id", "item_id", "shifts", "text", "item_text"))
    found = pairs.mapInArrow(_verify, _PAIR)
    best = F.max(F.struct("matched", "overlap", "item_words", "doc_begin")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def without_leaks(docs: DataFrame, tests: DataFrame) -> DataFrame:
    """The rows of ``docs`` that share no passage with a test item, columns unchanged."""
    gone = written(leaks(docs, tests).select("doc_id").distinct(), "leak-gone")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def op7_spaced_seed_decontamination(spark, sf_dir: str) -> DataFrame:
    from quarry.llm.common import table
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
