"""A work queue as a table: (task_type, key, status, attempts, http_status, next_retry_at, updated_at). Each step gives the table after it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = "task_type string, key string, status string, attempts int, http_status int, next_retry_at timestamp, updated_at timestamp"


def enqueue(queue: DataFrame, work: DataFrame, now: Column) -> DataFrame:
    """queue with the items of work(task_type, key) that it lacks; those it has stay as they are."""
    new = work.select("task_type", "key").distinct().join(queue.select("task_type", "key"), ["task_type", "key"], "left_anti")
    blank = new.select("task_type", "key", F.lit("pending").alias("status"), F.lit(0).alias("attempts"), F.lit(None).cast("int").alias("http_status"), F.lit(None).cast("timestamp").alias("next_retry_at"), now.alias("updated_at"))
    return queue.unionByName(blank)


def ready(queue: DataFrame, task_type: str, now: Column, limit: int) -> DataFrame:
    """Up to `limit` keys (the feature) that are pending and due, those waiting longest first."""
    due = queue.where((F.col("task_type") == task_type) & (F.col("status") == "pending") & (F.col("next_retry_at").isNull() | (F.col("next_retry_at") <= now)))
    return due.orderBy("updated_at", "key").limit(limit).select("task_type", "key")


def _changed(queue: DataFrame, hit: DataFrame, changes: dict[str, Column]) -> DataFrame:
    marked = queue.join(hit.withColumn("__hit", F.lit(True)), ["task_type", "key"], "left")
    return marked.select(*[F.when(F.col("__hit"), changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in queue.columns])


def claim(queue: DataFrame, claimed: DataFrame, now: Column) -> DataFrame:
    return _changed(queue, claimed, {"status": F.lit("in_flight"), "attempts": F.col("attempts") + 1, "updated_at": now})


def done(queue: DataFrame, finished: DataFrame, now: Column) -> DataFrame:
    return _changed(queue, finished, {"status": F.lit("done"), "updated_at": now})


def failed(queue: DataFrame, failures: DataFrame, now: Column) -> DataFrame:
    """failures(task_type, key, http, retry_after seconds): with a delay the item is pending again, without one its failure is final."""
    got = queue.join(failures.withColumn("__hit", F.lit(True)), ["task_type", "key"], "left")
    retry = F.col("retry_after").isNotNull()
    changes = {
        "status": F.when(retry, "pending").otherwise("failed"), "http_status": F.when(retry, F.col("http_status")).otherwise(F.col("http")),
        "next_retry_at": F.when(retry, F.timestamp_seconds(F.unix_timestamp(now) + F.col("retry_after"))).otherwise(F.col("next_retry_at")), "updated_at": now,
    }
    return got.select(*[F.when(F.col("__hit"), changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in queue.columns])


def reset(queue: DataFrame, now: Column) -> DataFrame:
    """What a crash left in flight is pending again."""
    stuck = F.col("status") == "in_flight"
    return queue.withColumns({"updated_at": F.when(stuck, now).otherwise(F.col("updated_at")), "status": F.when(stuck, "pending").otherwise(F.col("status"))})


def unanswered(work: DataFrame, answers: DataFrame) -> DataFrame:
    """The keys that a resumed run still has to ask: all but those that were answered."""
    return work.join(answers.select("key").distinct(), "key", "left_anti")
