"""The events in three arriving files give the batch result; a rerun adds nothing."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.streaming.ingest import file_stream, incremental_ingest


def test_incremental_ingest_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="quarry-w1-")
    e = spark.read.parquet(os.path.join(SF_SMALL, "events.parquet"))
    for lo, hi in ((1, 10), (11, 20), (21, 31)):
        e.where(F.dayofmonth("ts").between(lo, hi)).coalesce(1).write.mode("append").parquet(base + "/in")
    key = F.concat(F.lit("AG-"), F.col("user_id").cast("string"), F.lit("-"), F.to_date("ts").cast("string"))
    st = file_stream(spark, base + "/in", e.schema).withColumn("key", key)
    incremental_ingest(st, base + "/t", base + "/c1", "key", ["ts", "event_id"])
    first = spark.read.parquet(base + "/t").count()
    st2 = file_stream(spark, base + "/in", e.schema).withColumn("key", key)
    incremental_ingest(st2, base + "/t", base + "/c2", "key", ["ts", "event_id"])
    got = sorted((r["key"], r["event_id"]) for r in spark.read.parquet(base + "/t").select("key", "event_id").collect())
    assert len(got) == first                                   # the rerun added nothing
    rows = sorted(e.withColumn("key", key).select("key", "ts", "event_id").collect(), key=lambda r: (r["ts"], r["event_id"]))
    want = {}
    for r in rows:
        want.setdefault(r["key"], r["event_id"])
    assert got == sorted(want.items())


def test_replayed_file_adds_nothing(spark):
    """The same rows arriving again (a retried upload, a replayed batch) add no rows."""
    base = tempfile.mkdtemp(prefix="quarry-w1r-")
    e = spark.read.parquet(os.path.join(SF_SMALL, "events.parquet"))
    key = F.concat(F.lit("AG-"), F.col("user_id").cast("string"), F.lit("-"), F.to_date("ts").cast("string"))
    day = F.to_date("ts").cast("string")
    e.coalesce(1).write.mode("append").parquet(base + "/in")
    st = file_stream(spark, base + "/in", e.schema).withColumn("key", key).withColumn("day", day)
    incremental_ingest(st, base + "/t", base + "/c", "key", ["ts", "event_id"], partition_col="day")
    before = sorted(tuple(r) for r in spark.read.parquet(base + "/t").select("key", "event_id").collect())
    e.coalesce(1).write.mode("append").parquet(base + "/in")          # the same rows again, as a new file
    st = file_stream(spark, base + "/in", e.schema).withColumn("key", key).withColumn("day", day)
    incremental_ingest(st, base + "/t", base + "/c", "key", ["ts", "event_id"], partition_col="day")
    after = sorted(tuple(r) for r in spark.read.parquet(base + "/t").select("key", "event_id").collect())
    assert after == before and len(before) > 0


def test_daily_outcomes_rerun_is_stable(spark):
    from quarry.streaming.ingest import daily_outcomes

    base = tempfile.mkdtemp(prefix="quarry-w4-")
    e = spark.read.parquet(os.path.join(SF_SMALL, "events.parquet"))
    for lo, hi in ((1, 15), (16, 31)):
        e.where(F.dayofmonth("ts").between(lo, hi)).coalesce(1).write.mode("append").parquet(base + "/in")

    def run():
        st = file_stream(spark, base + "/in", e.schema).withColumn("ts", F.col("ts").cast("timestamp"))
        st = st.withColumn("reason", F.when(F.col("event_type") == "error", F.lit("rejected")).otherwise(F.lit("added")))
        daily_outcomes(st, "ts", "reason", base + "/out", base + "/ckpt")
        return sorted((str(r["day"]), r["reason"], r["n"]) for r in spark.read.parquet(base + "/out").collect())

    first = run()
    assert run() == first                                       # nothing new: same rows
    want = {}
    for r in e.select(F.to_date("ts").cast("string").alias("d"), "event_type").collect():
        k = (r["d"], "rejected" if r["event_type"] == "error" else "added")
        want[k] = want.get(k, 0) + 1
    assert first == sorted((d, rs, n) for (d, rs), n in want.items())


def test_days_in_any_order_count_alike(spark):
    """Newest days first, a file a batch: no key and no count is lost."""
    import time

    from quarry.streaming.ingest import daily_outcomes, stream_dedupe

    base = tempfile.mkdtemp(prefix="quarry-late-")
    e = spark.read.parquet(os.path.join(SF_SMALL, "events.parquet"))
    for lo, hi in ((21, 31), (11, 20), (1, 10)):
        e.where(F.dayofmonth("ts").between(lo, hi)).coalesce(1).write.mode("append").parquet(base + "/in")
        time.sleep(1.1)
    key = F.concat(F.lit("AG-"), F.col("user_id").cast("string"), F.lit("-"), F.to_date("ts").cast("string"))
    stream = lambda: file_stream(spark, base + "/in", e.schema, 1).withColumn("ts", F.col("ts").cast("timestamp"))
    stream_dedupe(stream().withColumn("key", key), "key", base + "/keys", base + "/c1")
    got = [r["key"] for r in spark.read.parquet(base + "/keys").collect()]
    assert sorted(got) == sorted(r["key"] for r in e.select(key.alias("key")).distinct().collect())
    daily_outcomes(stream().withColumn("reason", F.lit("added")), "ts", "reason", base + "/days", base + "/c2")
    assert spark.read.parquet(base + "/days").agg(F.sum("n")).first()[0] == e.count()
