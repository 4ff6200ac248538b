"""What is shipped: claims, net-new pairs, candidate pools and manifests, each less what the released lists hold by exact name.

A release is `held(name, year)` (dated names) and `pool(name)` (candidate names).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import delegation
from sedimenta.functions import evidence as ev
from sedimenta.operators import picks


def claims(years: DataFrame, evidence: DataFrame, name: str) -> DataFrame:
    """(name, year, evidence_id) of the assignments whose cited row qualifies for exactly that name."""
    cited = evidence.select("evidence_id", ev.parsed().alias("__ev"))
    both = years.join(cited, "evidence_id").where(ev.qualifies(F.col("__ev"), F.col(name)))
    return both.select(F.col(name).alias("name"), F.col("assigned_year").alias("year"), "evidence_id")


def net_new(claimed: DataFrame, held: DataFrame, host: bool = False) -> DataFrame:
    """Claims that may be shipped and that the release doesn't hold for the same year."""
    ships = delegation.ships_host if host else delegation.ships_domain
    return claimed.where(ships(F.col("name"), F.col("year"))).join(held.select("name", "year"), ["name", "year"], "left_anti")


def attested(years: DataFrame, name: str, held: DataFrame) -> DataFrame:
    """All dated pairs beyond the release's, qualified or not."""
    return years.select(F.col(name).alias("name"), F.col("assigned_year").alias("year")).distinct().join(held.select("name", "year"), ["name", "year"], "left_anti")


def undated(domains: DataFrame, years: DataFrame, held: DataFrame, pool: DataFrame) -> DataFrame:
    """Names found but never dated, that may be shipped and that no list of the release holds."""
    names = domains.select(F.col("domain").alias("name")).where(delegation.ships_undated(F.col("name")))
    known = years.select(F.col("domain").alias("name")).union(held.select("name")).union(pool.select("name"))
    return names.join(known, "name", "left_anti").distinct()


def pool(arms: dict[str, DataFrame], held: DataFrame, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(shipped(arm, name), taken(arm, name)): a name belongs to the first arm that has it; names of the release are the taken part.

    The arms are ranked and reduced in one shuffle.
    """
    tagged = None
    for at, (arm, df) in enumerate(arms.items()):
        df = df.select(F.lit(at).alias("at"), F.lit(arm).alias("arm"), "name").where("name is not null")
        tagged = df if tagged is None else tagged.union(df)
    one = tagged.groupBy("name").agg(F.min(F.struct("at", "arm")).alias("m")).select(F.col("m.arm").alias("arm"), "name")
    known = held.select("name").union(listed.select("name"))
    return one.join(known, "name", "left_anti"), one.join(known, "name", "left_semi")


def cited_row(names: DataFrame, evidence: DataFrame, subject: Column, order: list[Column]) -> DataFrame:
    """names with the least of their evidence rows by order; names without one go."""
    e = evidence.withColumn("name", subject).join(names.select("name"), "name", "left_semi")
    return picks.first_by(e, ["name"], order)


def manifest(shipped: DataFrame, evidence: DataFrame, source: DataFrame) -> DataFrame:
    """A row for every shipped line with the evidence that it rests on."""
    e = evidence.select("evidence_id", "source_id", "evidence_type", "acquisition_method", "evidence_value", "evidence_url", "source_file", "record_location", ev.kind(F.col("acquisition_method")).alias("kind"))
    s = source.select("source_id", F.col("name").alias("source"))
    return shipped.join(e, "evidence_id").join(s, "source_id").drop("source_id")


def same_count(a: DataFrame, b: DataFrame, what: str) -> None:
    left, right = a.count(), b.count()
    if left != right:
        raise ValueError(f"{what}: {left} lines but {right} rows")


def contribution(evidence: DataFrame, years: DataFrame, shipped: DataFrame, source: DataFrame) -> DataFrame:
    """A row for every source, those without evidence too: rows, names, pairs it alone shows, assignments and shipped lines that cite it."""
    rows = evidence.groupBy("source_id").agg(F.count("*").alias("evidence_rows"), F.countDistinct("domain").alias("names"))
    alone = evidence.groupBy("domain", "evidence_year").agg(F.min("source_id").alias("source_id"), F.max("source_id").alias("top")).where("source_id = top").groupBy("source_id").agg(F.count("*").alias("pairs_alone"))
    by_id = evidence.select("evidence_id", "source_id")
    cited = years.select("evidence_id").join(by_id, "evidence_id").groupBy("source_id").agg(F.count("*").alias("assigned"))
    out = shipped.select("evidence_id").join(by_id, "evidence_id").groupBy("source_id").agg(F.count("*").alias("shipped"))
    got = source.select("source_id", "name")
    for part in (rows, alone, cited, out):
        got = got.join(part, "source_id", "left")
    return got.na.fill(0, ["evidence_rows", "names", "pairs_alone", "assigned", "shipped"])


def growth(base: DataFrame, added: DataFrame) -> DataFrame:
    """(year, base, added, merged, pct): pct is null where there was nothing."""
    both = base.select("year", F.lit(1).alias("b"), F.lit(0).alias("a")).union(added.select("year", F.lit(0), F.lit(1)))
    out = both.groupBy("year").agg(F.sum("b").alias("base"), F.sum("a").alias("added"))
    return out.withColumn("merged", F.col("base") + F.col("added")).withColumn("pct", F.round(100.0 * F.col("added") / F.nullif("base", F.lit(0)), 4))


def cut_to_shipped(tables: dict[str, DataFrame], shipped: DataFrame) -> dict[str, DataFrame]:
    """The store reduced to what the shipped names rest on."""
    names = shipped.select("name").distinct()
    hosts = tables["hostname_year"].join(names.withColumnRenamed("name", "hostname"), "hostname", "left_semi")
    keep = names.union(hosts.select(F.col("parent_domain").alias("name"))).distinct().withColumnRenamed("name", "domain")
    evidence = tables["evidence"].join(keep, "domain", "left_semi")
    domains = tables["domain"].join(keep, "domain", "left_semi")
    used = evidence.select("source_id").union(domains.select(F.col("discovered_source").alias("source_id"))).distinct()
    return {
        "evidence": evidence, "domain": domains, "hostname_year": hosts,
        "domain_year": tables["domain_year"].join(keep, "domain", "left_semi"), "source": tables["source"].join(used, "source_id", "left_semi"),
    }


def merge_audit(base: DataFrame, submitted: DataFrame) -> DataFrame:
    """One row a year: base, submitted, overlap, accepted, merged. accepted = submitted - overlap and merged = base + accepted hold by year."""
    flags = base.select("name", "year").distinct().withColumn("b", F.lit(1)).join(submitted.select("name", "year").distinct().withColumn("s", F.lit(1)), ["name", "year"], "full")
    count = flags.groupBy("year").agg(
        F.count("b").alias("base"), F.count("s").alias("submitted"), F.count_if(F.col("b").isNotNull() & F.col("s").isNotNull()).alias("overlap"), F.count("*").alias("merged")
    )
    return count.withColumn("accepted", F.col("merged") - F.col("base"))
