"""Requests and replies between runs, appends that are seen whole, the drop report."""

import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.functions.fold import build_map
from quarry.operators.aggregates import drop_report
from quarry.operators.ledger import MESSAGES, RequestLedger, request_digest
from quarry.params import RunParams
from quarry.plans.story import STORY_SCHEMA, ask_stories, open_ledger, publish_stories
from quarry.sources.sinks import commit_batch, committed_batches, read_committed

SCHEMA = "k string, day string"


def _folder(name):
    return tempfile.mkdtemp(prefix=f"quarry-{name}-")


def _rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


# ------------------------------------------------------------------ appends
def test_batches_add_up_and_repeat_adds_nothing(spark):
    path = _folder("batches")
    assert read_committed(spark, path, SCHEMA).count() == 0
    a = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], SCHEMA)
    b = spark.createDataFrame([("c", "2024-01-02")], SCHEMA)
    assert commit_batch(a, path, "1", "day") and commit_batch(b, path, "2", "day")
    assert not commit_batch(b, path, "1", "day")                # that batch is there; its rows stay
    assert commit_batch(a.limit(0), path, "3", "day")           # an empty run is a batch too
    assert committed_batches(spark, path) == ["1", "2", "3"]
    assert _rows(read_committed(spark, path, SCHEMA), "k", "day", "batch") == [
        ("a", "2024-01-01", "1"), ("b", "2024-01-02", "1"), ("c", "2024-01-02", "2")]


def test_half_written_batch_is_not_seen_and_is_written_anew(spark):
    path = _folder("half")
    commit_batch(spark.createDataFrame([("a", "d")], SCHEMA), path, "one")
    spark.createDataFrame([("lost", "d"), ("b", "d")], SCHEMA).write.parquet(f"{path}/batch=two")    # killed before its marker
    assert _rows(read_committed(spark, path, SCHEMA), "k") == [("a",)]
    commit_batch(spark.createDataFrame([("b", "d")], SCHEMA), path, "two")
    assert _rows(read_committed(spark, path, SCHEMA), "k") == [("a",), ("b",)]


@pytest.mark.parametrize("name", ["", "../x", "a/b", "_hidden", "a b"])
def test_batch_names_are_checked(spark, name):
    with pytest.raises(ValueError):
        commit_batch(spark.createDataFrame([], SCHEMA), _folder("names"), name)


# ------------------------------------------------------------------ digests
def test_digest_tells_parts_apart(spark):
    msgs = [[("system", "ab"), ("user", "c")], [("system", "a"), ("user", "bc")], [("system", "ab"), ("user", "c")],
            [("system", "é"), ("user", "")], [("system", None), ("user", "c")], []]
    d = spark.createDataFrame([(i, "m", m) for i, m in enumerate(msgs)], f"i int, model string, messages {MESSAGES}")
    got = [r[0] for r in d.orderBy("i").select(request_digest(F.col("model"), F.col("messages"))).collect()]
    assert got[0] == got[2] and got[4] is None
    assert len(set(got)) == 5


# ------------------------------------------------------------------ ledger
def _requests(spark, rows):
    d = spark.createDataFrame(rows, "record_id string, said string, n long")
    msgs = F.array(F.struct(F.lit("system").alias("role"), F.lit("p").alias("content")),
                   F.struct(F.lit("user").alias("role"), F.col("said").alias("content")))
    return d.select("record_id", "n", F.lit("m").alias("model"), msgs.alias("messages"))


def _said(pending):
    return sorted(r[0] for r in pending.select(F.col("messages")[1]["content"]).collect())


def _answer(ledger, run, **replies):
    d = ledger.spark.createDataFrame(list(replies.items()), "said string, reply string")
    asked = ledger.table("asked").select("request_id", F.col("messages")[1]["content"].alias("said"))
    ledger.receive(asked.join(d, "said").select("request_id", "reply"), run)


def test_ledger_asks_once_and_meets_once(spark):
    led = RequestLedger(spark, _folder("ledger"), "n long")
    led.ask(_requests(spark, [("r1", "x", 1), ("r2", "x", 2), ("r3", "y", 3), (None, "z", 4), ("r4", None, 5)]), "a")
    assert _said(led.pending()) == ["x", "y"]                       # r1 and r2 ask the same; nulls ask nothing
    _answer(led, "a", x="X")
    assert _said(led.pending()) == ["y"]
    assert _rows(led.take("a"), "record_id", "n", "reply") == [("r1", 1, "X"), ("r2", 2, "X")]
    # a known record is not asked again, though its text is another; an answered text is not asked again
    led.ask(_requests(spark, [("r1", "other", 1), ("r5", "x", 5)]), "b")
    assert _said(led.pending()) == ["y"]
    _answer(led, "b", y="Y", x="second answer")
    assert _rows(led.take("b"), "record_id", "reply") == [("r3", "Y"), ("r5", "X")]
    assert led.take("c").count() == 0
    assert _rows(led.status(), "record_id", "asked_in", "answered_in", "met_in") == [
        ("r1", "a", "a", "a"), ("r2", "a", "a", "a"), ("r3", "a", "b", "b"), ("r5", "b", "a", "b")]


def test_ledger_without_rows(spark):
    led = RequestLedger(spark, _folder("ledger0"), "n long")
    led.ask(_requests(spark, []), "a")
    led.receive(spark.createDataFrame([("nobody asked", "r"), ("x", None)], "request_id string, reply string"), "a")
    assert led.pending().count() == led.take("a").count() == led.status().count() == 0


def test_repeated_record_keeps_one_request(spark):
    led = RequestLedger(spark, _folder("ledger2"), "n long")
    led.ask(_requests(spark, [("r", "x", 1), ("r", "y", 1), ("r", "x", 1)]), "a")
    assert led.table("records").count() == 1 and len(_said(led.pending())) == 1


def test_ask_cut_off_between_its_tables_is_completed(spark):
    led = RequestLedger(spark, _folder("ledger3"), "n long")
    req = _requests(spark, [("r1", "x", 1)])
    real, led._commit = led._commit, lambda df, name, run: name == "asked" or RequestLedger._commit(led, df, name, run)
    led.ask(req, "a")                                               # killed before the requests were entered
    led._commit = real
    assert led.table("records").count() == 1 and led.pending().count() == 0
    led.ask(req, "a")
    assert led.table("records").count() == 1 and _said(led.pending()) == ["x"]


# ------------------------------------------------------------------ stories against a target
def _texts(spark):
    rows = [(1, "AG-1", "Roads", "l1", "text one"), (2, "AG-2", "Roads", "l2", "text two"),
            (3, "AG-3", "Rivers", "l3", "text three"), (4, "AG-4", "Woods", "l4", "text four")]
    return spark.createDataFrame(rows, "position long, id string, title string, link string, pdf_text string")


def _run(spark, led, target, run, **replies):
    ask_stories(_texts(spark), led, RunParams(), run)
    _answer(led, run, **replies)
    return {r["record_id"]: r["reason"] for r in publish_stories(led, target, RunParams(), run).collect()}


def test_story_runs_add_late_replies_once(spark):
    led, target = open_ledger(spark, _folder("ledger4")), _folder("stories")
    got = _run(spark, led, target, "a", **{"text two": "Head\nbody", "text four": "no line break"})
    assert got == {"l2": "added", "l4": "reply_without_newline"}
    # l1 would be first, but the name is stored by now
    assert _run(spark, led, target, "b", **{"text one": "Head\nbody", "text three": "Other\nbody"}) == {"l1": "duplicate", "l3": "added"}
    assert _run(spark, led, target, "c", **{"text one": "Again\nbody"}) == {}
    assert _rows(read_committed(spark, target, STORY_SCHEMA), "headline", "batch") == [("Head", "a"), ("Other", "b")]


def test_killed_story_run_repeats_to_the_same_target(spark, monkeypatch):
    led, target = open_ledger(spark, _folder("ledger5")), _folder("stories2")
    replies = {"text one": "Head\nbody", "text two": "Second\nbody", "text three": "Other\nbody"}

    def killed(df, path, batch, partition_col=None):
        df.limit(1).write.partitionBy(partition_col).parquet(f"{path}/batch={batch}")
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr("quarry.plans.story.commit_batch", killed)
        with pytest.raises(RuntimeError):
            _run(spark, led, target, "a", **replies)
    assert read_committed(spark, target, STORY_SCHEMA).count() == 0
    assert _run(spark, led, target, "a", **replies) == {"l1": "added", "l2": "duplicate", "l3": "added"}
    want = [("Head", "body"), ("Other", "body")]
    assert [(h, t.split("\n")[0][:4]) for h, t in _rows(read_committed(spark, target, STORY_SCHEMA), "headline", "story_txt")] == want
    _run(spark, led, target, "a", **replies)                         # the whole run once more
    assert read_committed(spark, target, STORY_SCHEMA).count() == 2


# ------------------------------------------------------------------ dropped characters
def test_no_dropped_character_goes_uncounted(spark):
    texts = ["plain", "", None, "é ж ж 漢", "漢字 😀😀 ö", "ж"]
    d = spark.createDataFrame([(t,) for t in texts], "text string")
    _, known = build_map("T2")
    n, rows = Counter(), Counter()
    for t in texts:
        lost = [c for c in t or "" if ord(c) > 127 and c not in known]
        n.update(lost)
        rows.update(set(lost))
    assert n["😀"] == 2 and n["ж"] == 3
    got = {r["code_point"]: (r["n"], r["n_rows"]) for r in drop_report(d, "text").collect()}
    assert got == {ord(c): (n[c], rows[c]) for c in n}
