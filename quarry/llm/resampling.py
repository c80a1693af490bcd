"""Importance resampling toward a target distribution over hashed word n-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import crc
from quarry.llm import tokens as T
from quarry.llm.common import in_order, written

BUCKETS = 10_000
ORDER = 3                       # words of the longest feature
MIN_WORDS = 20                  # words a document needs to be drawn
PERCENT = 5
SEED = "42"

# A-Z counts as a-z; digits, letters and all beyond ASCII make words, the rest separates
_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def _pieces(data: np.ndarray, offsets: np.ndarray):
    """(begin, stop, reach): bytes of whole rows, about T.PIECE at a time.

    A longer row is cut between words.  Its piece reaches ORDER - 1 words further, so that every
    run of words that starts before ``stop`` is in it.
    """
    pos, end = int(offsets[0]), int(offsets[-1])
    while pos < end:
        stop = min(pos + T.PIECE, end)
        row_end = int(offsets[np.searchsorted(offsets, stop, "right") - 1])
        if row_end > pos:                                       # whole rows
            yield pos, row_end, row_end
            pos = row_end
            continue
        row_end = int(offsets[np.searchsorted(offsets, pos, "right")])
        stop = _next_blank(data, stop, row_end)
        reach = stop
        for _ in range(ORDER - 1):
            word = reach
            while word < row_end and _FOLD[data[word]] == 32:
                word += 1
            reach = _next_blank(data, word, row_end)
        yield pos, stop, reach
        pos = stop


def _next_blank(data: np.ndarray, pos: int, end: int) -> int:
    while pos < end:
        hit = np.flatnonzero(_FOLD[data[pos: min(pos + 4096, end)]] == 32)
        if hit.size:
            return pos + int(hit[0])
        pos = min(pos + 4096, end)
    return end


def features(column: pa.Array, buckets: int = BUCKETS):
    """(row, bucket, order) arrays of all runs of 1 to ORDER words, a piece and an order at a time.

    A piece becomes one stream, words joined by one space; its running CRCs are computed once, and
    the CRC of a run follows from the two at its ends.  Runs never cross rows.
    """
    data, offsets = T.buffers(column)
    for begin, stop, reach in _pieces(data, offsets):
        seg = _FOLD[data[begin:reach]]
        inside = seg != 32
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        edges = offsets[np.searchsorted(offsets, begin, "left"): np.searchsorted(offsets, reach, "left")] - begin
        start[edges] = inside[edges]
        at = np.flatnonzero(start)
        if not at.size:
            continue
        letters = np.cumsum(inside)
        word_of = np.cumsum(start) - 1
        stream = np.full(int(letters[-1]) + at.size, 32, dtype=np.uint8)
        stream[(letters + word_of - 1)[inside]] = seg[inside]
        s = letters[at] - 1 + np.arange(at.size)
        e = np.append(s[1:] - 1, stream.size - 1)
        row = np.searchsorted(offsets, at + begin, "right") - 1
        own = at + begin < stop
        r_end = crc.registers(stream, e)
        r_start = np.zeros_like(r_end)
        r_start[1:] = crc._zero_byte(r_end[:-1] ^ np.uint32(32))
        for n in range(1, min(ORDER, at.size) + 1):
            first = np.flatnonzero(own[: at.size - n + 1] & (row[: at.size - n + 1] == row[n - 1:]))
            last = first + n - 1
            h = crc.substring_crc(r_start[first], r_end[last], e[last] - s[first])
            yield row[first], (h % np.uint32(buckets)).astype(np.int64), n


def _count(buckets: int):
    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, bucket, _ in features(batch.column("text"), buckets):
                total += np.bincount(bucket, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])
    return run


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over the whole texts of ``docs``; each task sends its sums, a row per bucket at most."""
    return (docs.select("text").mapInArrow(_count(buckets), "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) from the bucket counts of the raw and the target texts; a row per bucket."""
    both = (raw.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
            .unionByName(target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
            .unionByName(raw.sparkSession.range(buckets).select(
                F.col("id").alias("bucket"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t"))))
    per = written(both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")), "resample-counts")
    all_s, all_t = per.agg(F.sum("s"), F.sum("t")).first()
    one = lambda c: F.col(c).cast("double")
    ratio = ((one("t") + 1) * F.lit(float(all_s + buckets))) / ((one("s") + 1) * F.lit(float(all_t + buckets)))
    return per.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain"))


def _weigh(shared, buckets: int, id_type: pa.DataType):
    def run(batches):
        gain = shared.value
        for batch in batches:
            weight = np.zeros(batch.num_rows)
            found = np.zeros((ORDER + 1, batch.num_rows), dtype=np.int64)
            for row, bucket, n in features(batch.column("text"), buckets):
                weight += np.bincount(row, weights=gain[bucket], minlength=batch.num_rows)
                found[n] += np.bincount(row, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(id_type), pa.array(found[1]), pa.array(found.sum(axis=0)),
                 pa.array(weight.astype(np.int64))], names=["doc_id", "n_words", "n_features", "weight"])
    return run


def weights(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_features, weight, the sum of its features' gains."""
    table = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets), buckets)
    gain = np.zeros(buckets)                            # a number per bucket, whatever the corpus is
    for row in table.collect():
        gain[row.bucket] = row.gain
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    of_id, kind = ("string", pa.string()) if dict(docs.dtypes)["doc_id"] == "string" else ("long", pa.int64())
    return docs.select("doc_id", "text").mapInArrow(
        _weigh(shared, buckets, kind), f"doc_id {of_id}, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
             buckets: int = BUCKETS, seed: str = SEED) -> DataFrame:
    """Every row of ``docs``: doc_id, n_words, n_features, weight, score, rank (null: not drawn).

    The gain of a bucket is the log ratio of its smoothed shares in ``target`` and in ``docs``; a
    document's weight is the sum over its features, its score the weight plus seeded Gumbel noise,
    so the ``percent`` highest scores are a draw without replacement in proportion to the weights.
    Only rows that may be drawn are sorted: a quantile sketch over all scores, with a margin above
    its error, tells which, and the sort deals them out by range, so no task ranks them alone.

    Null, empty and blank texts have no features and weight 0 and are never drawn.  Equal scores go
    by the smaller doc_id, a null one last.  Equal rows are documents of their own.  An empty table
    gives no rows; an empty target has no counts.  Other columns are not read.
    """
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256), 1, 8), 16, 10)
    u = (noise.cast("double") + 0.5) / 4294967296.0
    score = F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log(u)))
    scored = written(weights(docs, target, buckets).withColumn("score", score), "resample-scores")
    able = F.col("n_words") >= min_words
    # the sketch errs by 1 in 10,000 rows; 2 in 1,000 are left as a margin
    share = min(1.0, max(0.0, 1 - percent / 100 - 0.002))
    n, cut = scored.where(able).agg(F.count("*"), F.percentile_approx("score", share, 10_000)).first()
    wanted = percent * n // 100
    top = able & (F.col("score") >= F.lit(cut if cut is not None else 0).cast("long"))
    if scored.where(top).count() < wanted:
        top = able
    ranked = in_order(scored.where(top), [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "resample-top")
    rank = F.when(F.col("position") < wanted, F.col("position") + 1)
    return (ranked.withColumn("rank", rank).drop("position", "_part")
            .unionByName(scored.where(~top).withColumn("rank", F.lit(None).cast("long"))))


def op13_importance_resample(spark, sf_dir: str) -> DataFrame:
    from quarry.llm.common import table
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


# SQL has no CRC-32: a step per byte of each distinct run, over the table of the polynomial
OP13_SQL = rf"""
WITH x AS MATERIALIZED (SELECT {[int(v) for v in crc.STEP]} AS step),
texts AS (
  SELECT row_number() OVER () AS rid, doc_id, 0 AS kind, text FROM documents
  UNION ALL SELECT -row_number() OVER (), item_id, 1, text FROM benchmark),
w AS (
  SELECT rid, doc_id, kind, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
grams AS MATERIALIZED (
  SELECT rid, kind, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT rid, kind, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM w, (VALUES (1), (2), (3)) o(n) WHERE len(w) >= n)),
per AS (SELECT rid, kind, g, count(*) AS c FROM grams GROUP BY ALL),
known AS MATERIALIZED (
  SELECT g, xor(list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(range(1, len(h), 2), lambda i: CAST('0x' || h[i:i + 1] AS BIGINT))),
           lambda c, b: xor(step[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT g, hex(g) AS h FROM per), x),
f AS (SELECT rid, kind, bucket, sum(c) AS c FROM per JOIN known USING (g) GROUP BY ALL),
counts AS (
  SELECT b AS bucket, coalesce(CAST(sum(c) FILTER (kind = 0) AS DOUBLE), 0) AS s, coalesce(CAST(sum(c) FILTER (kind = 1) AS DOUBLE), 0) AS t
  FROM range({BUCKETS}) r(b) LEFT JOIN f ON f.bucket = b GROUP BY b),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * (sum(s) OVER () + {BUCKETS}) / ((s + 1) * (sum(t) OVER () + {BUCKETS})))) AS BIGINT) AS gain
  FROM counts),
weights AS (SELECT rid, sum(c) AS n, sum(c * gain) AS weight FROM f JOIN gains USING (bucket) WHERE kind = 0 GROUP BY rid),
scored AS (
  SELECT doc_id, len(w) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM w LEFT JOIN weights USING (rid) WHERE kind = 0),
drawn AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {MIN_WORDS} ORDER BY score DESC, doc_id) AS r,
         {PERCENT} * count(*) FILTER (n_words >= {MIN_WORDS}) OVER () // 100 AS wanted FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= {MIN_WORDS} AND r <= wanted THEN r END AS rank FROM drawn
"""
