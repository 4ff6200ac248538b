"""Records to evidence, evidence to assigned years: keep-first, class skip, and one ranking rule in place of updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import evidence as ev
from sedimenta.operators import picks

#: A class: rows of one kind of observation, of which a subject keeps one a year.
CLASS = ["source_id", "evidence_type", "acquisition_method"]


def nulls_last(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def keep_first(records: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One record a key: the least by order, nulls last, so that the order of arrival never shows."""
    return picks.first_by(records, keys, nulls_last(*order))


def audit(found: DataFrame, sample: int = 100) -> DataFrame:
    """What an ingest leaves behind: the first `sample` dropped lines of each reason and file."""
    lost = found.where("drop is not null")
    return picks.first_n(lost, ["file_name", "drop"], nulls_last("raw", "evidence_value"), sample)


def fresh_files(files: DataFrame, ledger: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """(new, changed) of files(file_name, sha256): names the ledger lacks, and names that it holds with other contents."""
    held = ledger.where(F.col("source_name") == source).select("file_name", F.col("sha256").alias("held"))
    both = files.join(held, "file_name", "left")
    return both.where("held is null").drop("held"), both.where("held is not null and held <> sha256").drop("held")


def ledger_upsert(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """Row counts of a file add up; the newest digest and time stay."""
    both = ledger.unionByName(rows)
    newest = F.struct("ingested_at", "sha256")
    return both.groupBy("source_name", "file_name").agg(F.max_by("sha256", newest).alias("sha256"), F.sum("record_rows").alias("record_rows"), F.max("ingested_at").alias("ingested_at"))


def class_skip(new: DataFrame, held: DataFrame) -> DataFrame:
    """Rows of `new` that their class needs: none of the same class, subject and year is held, or the held ones don't ship and the new one does.

    Held rows are reduced to one a key before they are shuffled.
    """
    parse = ev.parsed()
    key = [*CLASS, "subject", "evidence_year"]

    def told(df: DataFrame) -> DataFrame:
        df = df.withColumn("__ev", parse)
        return df.withColumn("subject", ev.subject(F.col("__ev"), F.col("domain"))).withColumn("ships", ev.qualifies_own(F.col("__ev"))).drop("__ev")

    one = keep_first(told(new).withColumn("__late", ~F.col("ships")), key, ["__late", "evidence_value", "source_file", "record_location"]).drop("__late")
    seen = told(held).groupBy(*key).agg(F.bool_or("ships").alias("held_ships"))
    on = [F.col(f"n.{k}").eqNullSafe(F.col(f"h.{k}")) for k in key]
    skip = F.col("h.held_ships") | ~F.col("n.ships")
    for test in on:
        skip = test & skip
    return one.alias("n").join(seen.alias("h"), skip, "left_anti").drop("subject", "ships")


def assign_years(evidence: DataFrame) -> DataFrame:
    """(domain, assigned_year, evidence_id): every year that a master row of the domain itself shows; the cited row is one that
    qualifies, if any, of these the one with the lowest id. Rows that name another host date nothing here."""
    e = evidence.withColumn("__ev", ev.parsed()).where(ev.master(F.col("evidence_type")) & ~ev.names_another_host(F.col("__ev"), F.col("domain")))
    best = F.min_by("evidence_id", F.struct(~ev.qualifies(F.col("__ev"), F.col("domain")), "evidence_id"))
    return e.groupBy("domain", F.col("evidence_year").alias("assigned_year")).agg(best.alias("evidence_id"))


def assign_hosts(evidence: DataFrame) -> DataFrame:
    """(hostname, parent_domain, assigned_year, evidence_id): the same for hosts below their domain. Rows that don't qualify rank by
    whether they are marked or in error, then by id."""
    e = evidence.withColumn("__ev", ev.parsed()).where(ev.master(F.col("evidence_type")) & ev.names_another_host(F.col("__ev"), F.col("domain")))
    e = e.withColumn("hostname", F.col("__ev.named")).where(F.endswith("hostname", F.concat(F.lit("."), "domain")))
    error = F.col("__ev.marked") | F.coalesce(F.col("evidence_value").rlike(r"(^| )status [45][0-9][0-9]( |\z)"), F.lit(False))
    best = F.min_by(F.struct("evidence_id", "domain"), F.struct(~ev.qualifies(F.col("__ev"), F.col("hostname")), error, "evidence_id"))
    out = e.groupBy("hostname", F.col("evidence_year").alias("assigned_year")).agg(best.alias("m"))
    return out.select("hostname", F.col("m.domain").alias("parent_domain"), "assigned_year", F.col("m.evidence_id").alias("evidence_id"))


def mark(evidence: DataFrame, ids: DataFrame, words: str) -> DataFrame:
    """evidence with `words` set before the last token of the values of the rows in ids(evidence_id); marked rows stay as they are."""
    hit = ids.select("evidence_id").distinct().withColumn("__hit", F.lit(True))
    value = F.col("evidence_value")
    todo = F.coalesce("__hit", F.lit(False)) & ~ev.marked(value)
    marked = F.regexp_replace(value, r"^(.* )?([^ ]*)\z", f"$1{words} $2")
    return evidence.join(hit, "evidence_id", "left").withColumn("evidence_value", F.when(todo, marked).otherwise(value)).drop("__hit")
