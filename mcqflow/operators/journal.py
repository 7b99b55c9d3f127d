"""Response journal: every model call is logged once, a run can be resumed.

The journal is an append-only Parquet folder on shared storage, one row a call:
``request_id``, the key of the row, ``run``, ``response`` (the raw body),
``call_error``, in folders by ``attempt``.  ``request_id`` is the md5 of key and
payload, so a changed prompt is a new request and rows with equal key and
payload share one call.

A run asks the model only for requests that the journal lacks at this attempt
(anti-join on the id).  Tasks are cut to at most about ``rows_per_task``
requests and each task's answers become visible when it commits, not when the
job does: a run that breaks loses the calls of its unfinished tasks only.  A
task that is repeated may log a request twice; readers take one row a request
and attempt (an answer before an error, then the least).  A logged error counts
as the outcome of its attempt; with ``retry_errors`` a resumed run asks again
where only errors are logged.

Defined cases: a NULL key is a key like any other; a NULL payload is not called
and has a NULL response and the error ``no payload``; an empty table makes no
call; a folder that does not exist yet is an empty journal.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mcqflow.operators.dedup import numbered

SCHEMA = "request_id string, key string, run string, response string, call_error string, attempt int"
ROWS_PER_TASK = 2000


def request_id(key: str, payload: str = "payload") -> Column:
    k = F.col(key).cast("string")
    return F.md5(F.concat(F.when(k.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), k)), F.lit("\n"), F.col(payload)))


class ResponseJournal:
    def __init__(self, spark: SparkSession, path: str, run: str = "1", rows_per_task: int = ROWS_PER_TASK,
                 retry_errors: bool = False):
        self.spark, self.path, self.run, self.rows_per_task, self.retry_errors = spark, path, run, rows_per_task, retry_errors
        # an empty append makes the folder; it adds nothing to one that exists
        self._write(spark.createDataFrame([], SCHEMA))

    def _write(self, rows: DataFrame) -> None:
        # version 2: a task's files are in place as soon as it commits
        (rows.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
         .partitionBy("attempt").parquet(self.path))

    def log(self) -> DataFrame:
        """All logged calls as they are."""
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def answers(self, attempt: int) -> DataFrame:
        """One row a request called at ``attempt``: request_id, response, call_error."""
        first = F.min(F.struct(F.col("call_error").isNotNull().alias("bad"), "response", "call_error"))
        return (self.log().where(F.col("attempt") == attempt).groupBy("request_id").agg(first.alias("_a"))
                .select("request_id", "_a.response", "_a.call_error"))

    def answer(self, df: DataFrame, call: Callable[[DataFrame], DataFrame], attempt: int, key: str = "index",
               payload: str = "payload", rows: DataFrame | None = None, row_id: str = "_rid") -> DataFrame:
        """``df`` with response and call_error of ``attempt``; ``call`` maps the
        requests that are still to be made to their answers.

        With ``rows``, numbered by ``row_id`` and with the payload, ``df`` has that
        number and ``request_id`` only: payloads are read for calls, in tasks by
        number, so that copies of a request never meet; logs are joined by id."""
        narrow = rows is not None
        if not narrow:
            row_id = "_rid"
            df = rows = numbered(df.withColumn("request_id", request_id(key, payload)), "requests")
        known = self.answers(attempt)
        if self.retry_errors:
            known = known.where("call_error is null")
        ask = (df.where(F.col("request_id").isNotNull()).groupBy("request_id")
               .agg(F.min(row_id).alias("_ask"), F.min(F.col(key).cast("string")).alias("key"))
               .join(known.select("request_id"), "request_id", "left_anti"))
        n = ask.count()
        if n:
            # as many tasks as all rows need: they are what the join reads
            tasks = -(-rows.count() // self.rows_per_task)
            texts = rows.select(F.col(row_id).alias("_ask"), F.col(payload).alias("payload"))
            got = call(texts.repartition(tasks, "_ask").join(ask.repartition(tasks, "_ask"), "_ask"))
            self._write(got.select("request_id", "key", F.lit(self.run).alias("run"), "response", "call_error",
                                   F.lit(attempt).alias("attempt")))
        out = df.drop("response", "call_error").join(self.answers(attempt), "request_id", "left")
        out = out.withColumn("call_error", F.when(F.col("request_id").isNull(), F.lit("no payload")).otherwise(F.col("call_error")))
        return out if narrow else out.drop("request_id", row_id)
