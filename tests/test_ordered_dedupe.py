"""O1-O5, J4-J5 against brute force, with one hot group holding a third of the rows."""

import random

from pyspark.sql import functions as F

from quarry.operators.dedupe import insert_if_absent, not_already_stored
from quarry.operators.ordered import (first_k_per_group, global_position, stop_after_n_invalid, stop_at_first)


def _rows(seed=3, n=3000):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        g = 0 if i % 3 == 0 else rng.randint(1, 40)           # group 0 holds a third of the rows
        out.append((i, g, rng.randint(0, 10 ** 6), rng.random() < 0.2))
    return out


def test_stop_after_n_invalid_matches_walk(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "id long, g long, k long, bad boolean").withColumn("key", F.struct("k", "id"))
    got = {r["id"]: r["looked_at"] for r in stop_after_n_invalid(df, "g", "key", "bad", 4).collect()}
    want = {}
    for g in {r[1] for r in rows}:
        seen = 0
        for r in sorted((r for r in rows if r[1] == g), key=lambda r: (r[2], r[0])):
            want[r[0]] = seen < 4
            seen += r[3]
    assert got == want


def test_first_k_per_group(spark):
    rows = _rows(5)
    df = spark.createDataFrame(rows, "id long, g long, k long, bad boolean").withColumn("key", F.struct("k", "id"))
    got = sorted((r["g"], r["rank"], r["id"]) for r in first_k_per_group(df, "g", "key", 3).collect())
    want = []
    for g in sorted({r[1] for r in rows}):
        top = sorted((r for r in rows if r[1] == g), key=lambda r: (r[2], r[0]))[:3]
        want += [(g, i + 1, r[0]) for i, r in enumerate(top)]
    assert got == sorted(want)


def test_stop_at_first(spark):
    rows = _rows(9, 500)
    df = spark.createDataFrame(rows, "id long, g long, k long, bad boolean").withColumn("key", F.struct("k", "id"))
    s = stop_at_first(df, "key", F.col("bad") & (F.col("g") > 10))
    got = sorted(r["id"] for r in s.where("before_stop").collect())
    walk = sorted(rows, key=lambda r: (r[2], r[0]))
    want = []
    for r in walk:
        if r[3] and r[1] > 10:
            break
        want.append(r[0])
    assert got == sorted(want)


def test_global_position(spark):
    rows = _rows(13, 800)
    df = spark.createDataFrame(rows, "id long, g long, k long, bad boolean").repartition(5).withColumn("key", F.struct("k", "id"))
    got = {r["id"]: r["pos"] for r in global_position(df, "key").collect()}
    want = {r[0]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (r[2], r[0])))}
    assert got == want


def test_insert_if_absent(spark):
    rng = random.Random(1)
    rows = [(i, "hot" if i % 3 == 0 else f"k{rng.randint(0, 300)}") for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, filename string")
    target = spark.createDataFrame([("k1",), ("k2",), ("k2",)], "filename string")
    got = {r["id"]: r["is_duplicate"] for r in insert_if_absent(df, target, "filename", "id").collect()}
    first = {}
    for i, k in rows:
        first.setdefault(k, i)
    want = {i: (k in ("k1", "k2")) or first[k] != i for i, k in rows}
    assert got == want
    kept = {r["id"] for r in not_already_stored(df, target, "filename").collect()}
    assert kept == {i for i, k in rows if k not in ("k1", "k2")}


def test_stored_check_is_by_key_alone(spark):
    """A target that also has dates gives the same answer: the key is the file name."""
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, None), (5, "c")], "id long, filename string")
    plain = spark.createDataFrame([("a",)], "filename string")
    dated = plain.withColumn("content_date", F.lit("1999-01-01").cast("date"))
    want = {1: True, 2: False, 3: None, 4: None, 5: False}
    for target in (plain, dated):
        out = insert_if_absent(df, target, "filename", "id")
        assert {r["id"]: r["is_duplicate"] for r in out.collect()} == want
        assert out.columns == ["id", "filename", "is_duplicate"]
