"""The store: Parquet tables of declared schema, written as new versions and switched by one small pointer file.

A change computes the new table, writes it beside the old one and then creates the next pointer file, so readers see all of a change or
none, and of two writers that start from one version just one gets through.
Tables that only grow get their new rows as a further part of the same version list; nothing is rewritten for an append.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.sources import files

SCHEMAS = {
    "source": "source_id int, name string, kind string, notes string",
    "domain": "domain string, tld string, discovered_source int, discovered_round int, first_seen_at timestamp",
    "evidence": "evidence_id long, domain string, source_id int, evidence_year int, evidence_type string, evidence_value string, evidence_url string, "
    "acquisition_method string, captured_at timestamp, ingested_at timestamp, source_file string, record_location string",
    "domain_year": "domain string, assigned_year int, evidence_id long, verified_at timestamp",
    "hostname_year": "hostname string, parent_domain string, assigned_year int, evidence_id long, verified_at timestamp",
    "ingested_file": "source_name string, file_name string, sha256 string, record_rows long, ingested_at timestamp",
    "domain_language": "domain string, assigned_year int, verdict string, english_share double, samples int, top_other string, evidence_urls string, reason string, engine_version string, classified_at timestamp",
    "run_metrics": "recorded_at timestamp, command string, source string, metrics_json string",
}
KEYS = {
    "source": ["name"], "domain": ["domain"], "evidence": ["evidence_id"], "domain_year": ["domain", "assigned_year"], "hostname_year": ["hostname", "assigned_year"],
    "ingested_file": ["source_name", "file_name"], "domain_language": ["domain", "assigned_year"],
}
SOURCE_KINDS = ("timestamped", "candidate_only")


POINTER = re.compile(r"current-[0-9]{10}\.json")


def _pointer(version: int) -> str:
    return f"current-{version:010d}.json"


class Conflict(RuntimeError):
    """Another change was committed first."""


class Store:
    """Tables below `base`, a folder that the driver and all executors share."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def version(self) -> tuple[int, dict[str, list[str]]]:
        """The number of the last change, and table -> the folders that make it up."""
        last = max((int(n[8:-5]) for n in files.names(self.spark, self.base) if POINTER.fullmatch(n)), default=0)
        return last, json.loads(files.read_text(self.spark, f"{self.base}/{_pointer(last)}")) if last else {}

    def parts(self) -> dict[str, list[str]]:
        return self.version()[1]

    def table(self, name: str) -> DataFrame:
        """The table; columns that an older part lacks are null."""
        found = self.parts().get(name, [])
        if not found:
            return self.spark.createDataFrame([], SCHEMAS[name])
        return self.spark.read.schema(SCHEMAS[name]).parquet(*found)

    def _shape(self, name: str, df: DataFrame) -> DataFrame:
        want = self.spark.createDataFrame([], SCHEMAS[name]).schema
        return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in want])

    def commit(self, append: dict[str, DataFrame] | None = None, replace: dict[str, DataFrame] | None = None, since: int | None = None) -> None:
        """All tables of a change at once: written first, then switched by one new pointer file.

        A change that replaces tables, or that names the version it was made from (`since`), fails with Conflict if another change came
        between; one that only appends is put after it.
        """
        base = self.version()[0] if since is None else since
        written = {}
        for keep, changes in ((True, append or {}), (False, replace or {})):
            for name, df in changes.items():
                path = f"{self.base}/{name}/{uuid.uuid4().hex}"
                self._shape(name, df).write.option("compression", "zstd").parquet(path)
                written[name] = (keep, path)
        while True:
            at, now = self.version()
            if at != base and (replace or since is not None):
                raise Conflict(f"version {at} came after version {base}")
            for name, (keep, path) in written.items():
                now[name] = (now.get(name, []) if keep else []) + [path]
            if files.create_once(self.spark, f"{self.base}/{_pointer(at + 1)}", json.dumps(now)):
                return

    def source_id(self, name: str, kind: str, notes: str | None = None) -> int:
        """The source's id, given out on first use. A source keeps its kind."""
        if kind not in SOURCE_KINDS:
            raise ValueError(f"no such kind of source: {kind}")
        while True:
            at = self.version()[0]
            held = self.table("source").where(F.col("name") == name).select("source_id", "kind").first()
            if held:
                if held["kind"] != kind:
                    raise ValueError(f"source {name} is {held['kind']}, not {kind}")
                return held["source_id"]
            new = (self.table("source").agg(F.max("source_id")).first()[0] or 0) + 1
            try:
                self.commit(append={"source": self.spark.createDataFrame([(new, name, kind, notes)], SCHEMAS["source"])}, since=at)
                return new
            except Conflict:  # somebody else added a source meanwhile: look again
                continue

    def drop_source(self, source_id: int) -> None:
        """All rows that rest on a source go: its evidence, the years on that evidence, the domains that it alone discovered."""
        gone = self.table("evidence").where(F.col("source_id") == source_id).select("evidence_id")
        left = self.table("evidence").where(~F.col("source_id").eqNullSafe(F.lit(source_id)))
        years = {t: self.table(t).join(gone, "evidence_id", "left_anti") for t in ("domain_year", "hostname_year")}
        named = left.select("domain").distinct().withColumn("named", F.lit(True))
        domains = self.table("domain").join(named, "domain", "left").where(~F.col("discovered_source").eqNullSafe(F.lit(source_id)) | F.col("named"))
        self.commit(replace={"evidence": left, "domain": domains, **years, "source": self.table("source").where(F.col("source_id") != source_id)})

    def record(self, command: str, source: str, metrics: Column) -> None:
        row = self.spark.range(1).select(F.current_timestamp().alias("recorded_at"), F.lit(command).alias("command"), F.lit(source).alias("source"), F.to_json(metrics).alias("metrics_json"))
        self.commit(append={"run_metrics": row})


def only_new(rows: DataFrame, held: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Insert-or-ignore: one row a key (the first by order), of keys that held lacks."""
    from sedimenta.operators import picks

    one = picks.first_by(rows, keys, order) if order else rows.dropDuplicates(keys)
    return one.join(held.select(*keys), keys, "left_anti")


def numbered(rows: DataFrame, key: list[str], salt: int = 0) -> DataFrame:
    """rows with an evidence_id that follows from their content, so that a repeated or retried run gives the same ids.

    64 bits can't tell 10^10 rows apart for sure; `new_numbered` gives a row whose id another row has an id of its own.
    """
    content = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in key], F.lit(str(salt) if salt else "")), 256)
    return rows.withColumn("evidence_id", F.conv(F.left(content, F.lit(16)), 16, -10).cast("long"))


def new_numbered(rows: DataFrame, held: DataFrame, key: list[str]) -> DataFrame:
    """Insert-or-ignore by content: rows (one each) whose key columns held lacks, with ids that neither held nor another row has."""
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"h.{c}")) for c in key]
    new = rows.dropDuplicates(key).alias("n").join(held.select(*key).alias("h"), same, "left_anti")
    out, salt = numbered(new, key), 0
    while True:
        twice = out.groupBy("evidence_id").agg(F.count("*").alias("n")).where("n > 1").select("evidence_id")
        taken = out.join(held.select("evidence_id"), "evidence_id", "left_semi").select("evidence_id").union(twice).distinct()
        if taken.isEmpty():  # but for one case in billions
            return out
        salt += 1
        again = numbered(out.join(taken, "evidence_id", "left_semi").drop("evidence_id"), key, salt)
        out = out.join(taken, "evidence_id", "left_anti").unionByName(again)


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: count and the XOR of row hashes; equal for equal sets of distinct rows, whatever their order."""
    return df.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64(*df.columns)), F.lit(0)).alias("digest"))


def cached(spark: SparkSession, path: str, key: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A derived table, made again only where the key (query, inputs, version) has changed."""
    at = f"{path.rstrip('/')}/{key}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{at}/_SUCCESS")
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        make().write.mode("overwrite").parquet(at)
    return spark.read.parquet(at)
