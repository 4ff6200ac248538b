"""Exact dedup over a persistent digest index.

The index is a Parquet table in the shared folder, bucketed and sorted by digest. A batch of documents is reduced to
one row a digest (partial aggregation, so a text that a third of all rows share is one row a task before the
shuffle), deduplicated against the index by a sort-merge anti-join, and what is new is appended.

The index says itself how many buckets it has; whoever opens it obeys that, whatever the session's settings. A batch becomes visible,
rows and verdicts together, by one file of the log, which is made just once: a run that dies before leaves nothing that counts, and one
that is repeated under the same batch id gets the verdicts of the first. Of two batches at a time the later one looks again.

Defined results: a null text counts as empty; equal texts are those equal once each run of ASCII white space is one
space; the smallest doc_id stays, null ids after all others; of rows that repeat id and text exactly one stays, whichever. There are no
other ties. Texts of any length are digested whole, in the JVM. `keep` returns all columns of documents, whatever their names: its own get
names that none of them has.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.common import WORD_SPACE, free_name, materialise, read, shared_dir
from sedimenta.sources import files


def normalised(text: str = "text") -> F.Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WORD_SPACE, " ")


def digest(text: str = "text") -> F.Column:
    """SHA-256 of the normalised text in UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


ROWS = "doc_id long, digest binary, row long"


class DigestIndex:
    """digest -> doc_id of the row that was kept, in a bucketed table at path (a new one below the shared folder by default).

    buckets counts for a new index only. Below path: `rows` (the table; `attempt` says which run wrote a row), `layout.json`, `log`.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = (path or shared_dir(spark, "digests")).rstrip("/")
        wanted = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        files.create_once(spark, f"{self.path}/layout.json", json.dumps({"buckets": wanted}))
        self.buckets = json.loads(files.read_text(spark, f"{self.path}/layout.json"))["buckets"]
        self.table = f"digests_{uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT, attempt STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}/rows'"
        )

    def log(self) -> list[dict]:
        """The batches that count, in their order."""
        return [json.loads(files.read_text(self.spark, f"{self.path}/log/{name}")) for name in files.names(self.spark, f"{self.path}/log") if name.endswith(".json")]

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table).where(F.col("attempt").isin([batch["attempt"] for batch in self.log()])).drop("attempt")

    def _append(self, rows: DataFrame, attempt: str) -> None:
        """One file a bucket and batch: rows are dealt by the hash that the buckets use."""
        (
            rows.select("digest", "keep_id", F.lit(attempt).alias("attempt")).repartition(self.buckets, "digest").sortWithinPartitions("digest")
            .write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").option("path", f"{self.path}/rows").saveAsTable(self.table)
        )

    def _publish(self, docs: DataFrame, batch: str) -> dict:
        at = shared_dir(self.spark, "dedup-rows")
        docs.select("doc_id", digest().alias("digest"), F.monotonically_increasing_id().alias("row")).write.parquet(at)
        dig = self.spark.read.schema(ROWS).parquet(at)
        order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
        groups = dig.groupBy("digest").agg(F.min(order).alias("low"), F.count(F.lit(1)).alias("group_size"))
        groups = materialise(groups.select("digest", "group_size", F.col("low.doc_id").alias("keep_id"), F.col("low.row").alias("keep_row")), "dedup-groups")
        while True:
            number, attempt = len(self.log()), uuid.uuid4().hex
            held = groups.select("digest").join(self.rows().hint("merge"), "digest").select("digest", F.col("keep_id").alias("held_id"), F.lit(True).alias("held"))
            held = materialise(held, "dedup-held")
            self._append(groups.hint("merge").join(self.rows(), "digest", "left_anti"), attempt)
            verdicts = groups.join(held, "digest", "left").select(
                "digest", "group_size", F.when(F.col("held"), F.col("held_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.when(F.col("held").isNull(), F.col("keep_row")).alias("keep_row")
            )
            entry = {"batch": batch, "attempt": attempt, "rows": at, "verdicts": f"{self.path}/verdicts/{attempt}"}
            verdicts.write.parquet(entry["verdicts"])
            if files.create_once(self.spark, f"{self.path}/log/{number:010d}.json", json.dumps(entry)):
                return entry

    def ingest(self, docs: DataFrame, batch: str | None = None) -> DataFrame:
        """Deduplicate docs within themselves and against the index, append what is new; one verdict a row of docs.

        Returns doc_id, keep_id, group_size (rows of this batch with that text), kept, digest. A batch id that the log holds gets the
        verdicts given then.
        """
        done = next((entry for entry in self.log() if batch is not None and entry["batch"] == batch), None)
        done = done or self._publish(docs, batch or uuid.uuid4().hex)
        dig = self.spark.read.schema(ROWS).parquet(done["rows"])
        verdicts = self.spark.read.schema("digest binary, group_size long, keep_id long, keep_row long").parquet(done["verdicts"])
        # Both sides are plain scans, so a digest that holds a third of all rows is split by adaptive execution.
        return dig.join(verdicts, "digest").select("doc_id", "keep_id", "group_size", F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"), "digest")

    def keep(self, docs: DataFrame, batch: str | None = None) -> DataFrame:
        """The rows of docs that stay, with all their columns.

        Texts move once, dealt by digest and id together, so that copies under many ids are spread; rows that repeat both are
        combined before they move.
        """
        name = free_name(docs, "key")

        def key(text_digest: F.Column) -> F.Column:
            return F.concat(text_digest, F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))

        fresh = self.ingest(docs, batch).where("kept").select(key(F.col("digest")).alias(name))
        fresh = materialise(fresh, "dedup-kept")
        return docs.withColumn(name, key(digest())).dropDuplicates([name]).join(fresh, name, "left_semi").select(*docs.columns)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = DigestIndex(spark).ingest(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM d
"""
