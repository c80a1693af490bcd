"""Model requests and replies kept between runs.

A request is known by the digest of all it says, so the same question is asked once, by whatever
record and in whatever run.  Three tables of one folder, each appended a run at a time
(``sinks.commit_batch``):

* ``asked``: a row per digest, with the messages, for the service to read;
* ``answered``: a row per digest, the first reply that came;
* ``records``: who waits for which digest, with the columns needed once the reply is there;
* ``met``: the records that have had their reply, and in which run.

A reply that comes late finds its record in any later run, and a record meets its reply in one run
only.  A run repeated under its name after a failure asks, takes and gives the same again.  All joins
are on ids, and a text is stored once, with its digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.sinks import commit_batch, read_committed

MESSAGES = "array<struct<role:string,content:string>>"


def request_digest(model: Column, messages: Column) -> Column:
    """SHA-256 over model and messages; each part follows its byte count, so parts can't run together.
    Null if any part is null."""
    part = lambda c: F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)
    said = F.transform(messages, lambda m: F.concat(part(m["role"]), part(m["content"])))
    body = F.when(F.exists(said, lambda s: s.isNull()), None).otherwise(F.array_join(said, ""))
    return F.sha2(F.concat(part(model), body), 256)


class RequestLedger:
    """The ledger in ``path``; ``schema`` names the columns of a record besides ``record_id``."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path = spark, path
        self.columns = spark.createDataFrame([], schema).columns
        self._schemas = {
            "asked": f"request_id string, model string, messages {MESSAGES}",
            "answered": "request_id string, reply string",
            "records": f"record_id string, request_id string, {schema}",
            "met": "record_id string",
        }

    def table(self, name: str) -> DataFrame:
        return read_committed(self.spark, f"{self.path}/{name}", self._schemas[name])

    def _commit(self, df: DataFrame, name: str, run: str) -> None:
        commit_batch(df, f"{self.path}/{name}", run)

    def ask(self, requests: DataFrame, run: str) -> None:
        """Enter ``requests`` (record_id, model, messages and the record's columns): a record already
        known keeps its request, a digest already asked is not asked again.  Rows without a record_id
        or with a null in the messages are left out.  Of rows that share a record_id, the one with the
        smallest digest counts."""
        r = requests.withColumn("request_id", request_digest(F.col("model"), F.col("messages")))
        r = r.where(F.col("record_id").isNotNull() & F.col("request_id").isNotNull())
        new = r.join(self.table("records").select("record_id"), "record_id", "left_anti")
        # a key per record first: no text is shuffled to find it
        first = new.groupBy("record_id").agg(F.min("request_id").alias("request_id"))
        rec = (new.select("record_id", "request_id", *self.columns).join(first, ["record_id", "request_id"], "left_semi")
               .dropDuplicates(["record_id"]))
        self._commit(rec, "records", run)
        mine = self.table("records").where(F.col("batch") == run).select("request_id")
        said = (r.select("request_id", "model", "messages").join(mine, "request_id", "left_semi")
                .join(self.table("asked").select("request_id"), "request_id", "left_anti").dropDuplicates(["request_id"]))
        self._commit(said, "asked", run)

    def pending(self) -> DataFrame:
        """Requests without a reply, as the service is to get them."""
        return self.table("asked").drop("batch").join(self.table("answered").select("request_id"), "request_id", "left_anti")

    def receive(self, replies: DataFrame, run: str) -> None:
        """Enter ``replies`` (request_id, reply).  A digest keeps its first reply; of several in one
        run the smallest text; null replies and such to questions never asked are left out."""
        r = replies.where(F.col("reply").isNotNull()).groupBy("request_id").agg(F.min("reply").alias("reply"))
        r = r.join(self.table("asked").select("request_id"), "request_id", "left_semi")
        self._commit(r.join(self.table("answered").select("request_id"), "request_id", "left_anti"), "answered", run)

    def take(self, run: str) -> DataFrame:
        """Records that meet their reply in ``run``: record_id, the record's columns, messages and reply.
        A run that takes must end, or be repeated under its name: no other run gets these replies."""
        records, met = self.table("records").drop("batch"), self.table("met")
        ready = (records.join(self.table("answered").select("request_id"), "request_id", "left_semi")
                 .join(met.select("record_id"), "record_id", "left_anti"))
        self._commit(ready.select("record_id"), "met", run)
        now = self.table("met").where(F.col("batch") == run).select("record_id")
        return (records.join(now, "record_id", "left_semi")
                .join(self.table("asked").select("request_id", "messages"), "request_id")
                .join(self.table("answered").select("request_id", "reply"), "request_id").drop("request_id"))

    def status(self) -> DataFrame:
        """A row per record: record_id, request_id, asked_in (its run), answered_in and met_in (null: not yet)."""
        rec = self.table("records").select("record_id", "request_id", F.col("batch").alias("asked_in"))
        ans = self.table("answered").select("request_id", F.col("batch").alias("answered_in"))
        met = self.table("met").select("record_id", F.col("batch").alias("met_in"))
        return rec.join(ans, "request_id", "left").join(met, "record_id", "left")
