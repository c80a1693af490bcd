"""Toxicity scores: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import tokens as T
from quarry.llm.common import drop_clashing, written

BITS = 20                        # 2**BITS hashed features: the bound of what is broadcast
GRAMS = ((0,), (0, 1), (0, 2))   # words, pairs, pairs with one word skipped
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 0.1
#: bound of the labelled sample that is learnt from, and passes over it.  L1 and EPOCHS are those with
#: most rows right on a fifth of the training rows of sf0.1, of L1 0.5, 1, 2, 4 with 3, 6, 12 passes and 8 with 3
MAX_ROWS, EPOCHS = 40_000, 3
SEED = "tox-1"
ADDED = ("held_out", "score", "predicted")


def features(column: pa.Array):
    """Feature numbers of all rows and where each row's begin: each feature once per row.

    Words are taken in lower case (A-Z), and marks count as blanks.  Feature 0 is in every row:
    it learns how common the label is.
    """
    h, rows = T.bare_word_hashes(column)
    row_of = np.repeat(np.arange(rows.size - 1), np.diff(rows))
    keys = [np.arange(rows.size - 1, dtype=np.uint64) << np.uint64(BITS)]
    for k, gram in enumerate(GRAMS):
        g = T.gram_hashes(h, gram)
        n = g.size
        inside = row_of[:n] == row_of[gram[-1]: gram[-1] + n] if n else np.zeros(0, dtype=bool)
        slot = T.mix(g[inside] + np.uint64(k)) >> np.uint64(64 - BITS)
        keys.append((row_of[:n][inside].astype(np.uint64) << np.uint64(BITS)) | slot)
    keys = np.unique(np.concatenate(keys))
    slots = (keys & np.uint64((1 << BITS) - 1)).astype(np.int64)
    return slots, np.searchsorted(keys >> np.uint64(BITS), np.arange(rows.size, dtype=np.uint64))


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """FTRL-proximal weights: zero while |z| stays within L1."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def learn(z: np.ndarray, n: np.ndarray, slots: np.ndarray, begin: np.ndarray, labels: np.ndarray):
    """One pass over the rows in their order, a per-coordinate step each; z and n change in place."""
    for r, y in enumerate(labels):
        i = slots[begin[r]: begin[r + 1]]
        zi, ni = z[i], n[i]
        w = weights_of(zi, ni)
        p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35)))
        g = p - y
        sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
        z[i] = zi + g - sigma * w
        n[i] = ni + g * g


_WEIGHTS = "slot long, weight double"


def _learner(epochs: int):
    """Passes over the whole sample, in the order of its hash: the weights that are not zero."""
    def run(table: pa.Table) -> pa.Table:
        z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        order = pa.compute.sort_indices(table, sort_keys=[("_rank", "ascending"), ("label", "ascending")])
        for lo in [*range(0, len(order), 200)] * epochs:
            for batch in table.take(order[lo: lo + 200]).combine_chunks().to_batches():
                for part in T.pieces(batch, 2 << 20):
                    slots, begin = features(part.column("text"))
                    learn(z, n, slots, begin, part.column("label").to_numpy(zero_copy_only=False))
        w = weights_of(z, n)
        slot = np.flatnonzero(w)
        return pa.table({"slot": slot, "weight": w[slot]})
    return run


def train(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Weights learnt from the texts of ``docs`` and ``labels`` (doc_id, label).

    About MAX_ROWS labels are used: with more, those whose seeded hash falls under MAX_ROWS / all.
    That sample is what makes the labels small enough to send to the documents, and its texts small
    enough for one task, which learns from all of them in EPOCHS passes in the order of the hash:
    shares learnt apart would each have too little of a rare word.  That task has MAX_ROWS texts and
    2**BITS cells at most, whatever the corpus is, and gives the weights that are not zero.
    """
    rank = F.md5(F.concat(F.lit(SEED), F.col("doc_id").cast("string")))
    labels = (labels.where("doc_id is not null and label is not null")
              .groupBy("doc_id").agg(F.max("label").cast("double").alias("label")).withColumn("_rank", rank))
    labels = written(labels, "toxic-labels")
    share = MAX_ROWS / max(1, labels.count())
    picked = labels.where(F.conv(F.substring("_rank", 1, 8), 16, 10).cast("long") < int(share * 2 ** 32))
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    rows = written(rows.select("text", "label", "_rank", F.lit(0).alias("_all")), "toxic-rows")
    learnt = rows.groupBy("_all").applyInArrow(_learner(EPOCHS), _WEIGHTS).toArrow()
    w = np.zeros(1 << BITS)
    w[learnt["slot"].to_numpy()] = learnt["weight"].to_numpy()
    return w


def _scores(names: list, weights):
    def run(batches):
        slot, value = weights.value
        w = np.zeros(1 << BITS)
        w[slot] = value
        for whole in batches:
            for batch in T.pieces(whole, 2 << 20):
                slots, begin = features(batch.column("text"))
                total = np.concatenate([[0.0], np.cumsum(w[slots])])
                x = np.round(total[begin[1:]] - total[begin[:-1]], 9)
                p = 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in names] + [pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                    names=[*names, "score", "predicted"])
    return run


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """Every row of ``docs`` with score (0 to 1) and predicted (1 from 0.5), without its text.

    Only ``text`` is read.  Null and empty texts have the one feature that every row has, so they
    score as the label is common.  Equal texts score equally.  An empty table gives no rows.
    Columns named like the added ones are replaced.  The weights sent out are those that L1 left.
    """
    docs = drop_clashing(docs, *ADDED[1:])
    slot = np.flatnonzero(weights)
    shared = docs.sparkSession.sparkContext.broadcast((slot, weights[slot]))
    names = [c for c in docs.columns if c != "text"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")
    return docs.mapInArrow(_scores(names, shared), f"{fields}, score double, predicted int")


def op9_toxicity_ftrl(spark, sf_dir: str) -> DataFrame:
    from quarry.llm.common import table
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label")).where(fold != 0)
    out = score(docs, train(docs, labels))
    return out.select("doc_id", (fold == 0).alias("held_out"), "score", "predicted")
