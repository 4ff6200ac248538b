"""Incremental ingest: files of a folder, as they come, into a store.

Lateness has no bound (a good capture may follow an error years later), so there is no watermark: a batch's rows are upserted by
rank against the store, which absorbs replays; the checkpoint names the files already read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sedimenta.functions import names
from sedimenta.operators import ingest, picks
from sedimenta.operators.store import Store, new_numbered, numbered, only_new
from sedimenta.sources import files, formats, scan
from sedimenta.sources.specs import SPECS


def arriving(spark: SparkSession, path: str, pattern: str = "*", batch_bytes: int = 16 << 20) -> DataFrame:
    """(value, file_name) of the lines of new files; files still being written (`.part`) are not looked at."""
    lines = spark.readStream.option("lineSep", "\n").option("pathGlobFilter", pattern).option("maxBytesPerTrigger", str(batch_bytes)).text(path)
    return lines.select("value", F.col("_metadata.file_name").alias("file_name")).where(~F.col("file_name").endswith(".part"))


def bank(store: Store, records: DataFrame, source_id: int, evidence_type: str, method: str) -> None:
    """Kept records as evidence rows of one class, and the years of the domains that they name, in one commit; what was refused is counted
    by reason in run_metrics. A replayed batch adds nothing."""
    got = names.reduced(records.where("drop is null").withColumn("host", names.host(F.col("raw"))), "host")
    reason = F.coalesce("refused", F.when(~F.coalesce(F.col("year").between(1996, 2001), F.lit(False)), "out_of_window"))
    refused = got.select(reason.alias("reason")).where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))
    got = got.where(reason.isNull())
    rows = got.select(
        F.col("registrable").alias("domain"), F.lit(source_id).alias("source_id"), F.col("year").alias("evidence_year"), F.lit(evidence_type).alias("evidence_type"), "evidence_value", "evidence_url",
        F.lit(method).alias("acquisition_method"), F.lit(None).cast("timestamp").alias("captured_at"), F.current_timestamp().alias("ingested_at"), F.col("file_name").alias("source_file"), F.lit(None).cast("string").alias("record_location"),
    )
    key = ["domain", "source_id", "evidence_year", "evidence_type", "acquisition_method", "evidence_value", "evidence_url"]
    at = store.version()[0]
    touched = rows.select("domain").distinct()
    held = store.table("evidence").join(touched, "domain", "left_semi")
    new = new_numbered(ingest.class_skip(numbered(rows, key), held).drop("evidence_id"), store.table("evidence"), key)
    both = held.unionByName(new.select(*held.columns))
    years = ingest.assign_years(both).withColumn("verified_at", F.current_timestamp())
    fresh = touched.select("domain", names.tld(F.col("domain")).alias("tld"), F.lit(source_id).alias("discovered_source"), F.current_timestamp().alias("first_seen_at"))
    untouched = store.table("domain_year").join(touched, "domain", "left_anti")
    told = F.to_json(F.struct(F.lit(source_id).alias("source_id"), F.map_from_entries(F.collect_list(F.struct("reason", "n"))).alias("refused")))
    metrics = refused.agg(told.alias("metrics_json")).select(F.current_timestamp().alias("recorded_at"), F.lit("bank").alias("command"), F.lit(str(source_id)).alias("source"), "metrics_json")
    store.commit(
        append={"evidence": new, "domain": only_new(fresh, store.table("domain"), ["domain"]), "run_metrics": metrics},
        replace={"domain_year": untouched.unionByName(years)}, since=at,
    )


def ingest_files(store: Store, key: str, path: str) -> dict[str, int]:
    """Bank the files at path that the ledger lacks, as the source spec `key` says; a file whose contents changed under its name stops the job.

    Files are digested whole, 2 GB each at most; a larger one should come in parts.
    """
    spark, spec = store.spark, SPECS[key]
    source_id = store.source_id(spec.source, spec.kind)
    found = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.sha2("content", 256).alias("sha256"))
    new, changed = ingest.fresh_files(found.where(~F.col("file_name").endswith(".part")), store.table("ingested_file"), spec.source)
    other = changed.first()
    if other:
        raise ValueError(f"{other['file_name']} of {spec.source} changed since it was read")
    lines = scan.lines(spark, path).join(new, "file_name", "left_semi").select("value", "file_name")
    records = spec.parse(lines).persist()
    try:
        bank(store, records, source_id, spec.evidence_type, spec.method)
        rows = new.join(records.where("drop is null").groupBy("file_name").agg(F.count("*").alias("record_rows")), "file_name", "left").fillna(0, ["record_rows"])
        store.commit(append={"ingested_file": rows.select(F.lit(spec.source).alias("source_name"), "file_name", "sha256", "record_rows", F.current_timestamp().alias("ingested_at"))})
        return {r["reason"]: r["n"] for r in formats.drop_counts(records).collect()}
    finally:
        records.unpersist()


def run(lines: DataFrame, parse: Callable[[DataFrame], DataFrame], store: Store, source: tuple[str, str, str, str], checkpoint: str) -> StreamingQuery:
    """All that has arrived is read, in batches, then the query ends. source: (name, kind, evidence type, method)."""
    name, kind, evidence_type, method = source
    source_id = store.source_id(name, kind)

    def batch(df: DataFrame, _: int) -> None:
        df = df.persist()
        try:
            bank(store, parse(df), source_id, evidence_type, method)
        finally:
            df.unpersist()

    return lines.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def once_by_key(events: DataFrame, key: str, order: str, path: str, checkpoint: str) -> StreamingQuery:
    """Each key's first row, written below path, however late its repeats come: a batch is deduplicated in itself and against what is there. A batch that
    is replayed writes its own folder again, so nothing comes twice."""
    spark, schema = events.sparkSession, events.schema

    def batch(df: DataFrame, number: int) -> None:
        mine = f"{path}/batch={number}"
        others = [f"{path}/{n}" for n in files.names(spark, path) if n.startswith("batch=") and n != f"batch={number}"]
        held = spark.read.schema(schema).parquet(*others) if others else spark.createDataFrame([], schema)
        picks.first_by(df, [key], [F.col(order)]).join(held.select(key), key, "left_anti").select(*df.columns).write.mode("overwrite").parquet(mine)

    return events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
