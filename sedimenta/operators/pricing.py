"""Price a corpus of names against a release: exact decimals, one record for each name and year, drops counted by reason.

A snapshot is held(name, year), pool(name) and dated(name, year) (what the store has itself). Weights are (tld, weight decimal).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import delegation, names

DROPS = ("no name", "bad year", "out of window", "error status", "no registrable", "not below a suffix")


def priced_items(items: DataFrame) -> DataFrame:
    """items(item, host, year, status?, free) as (name, parent, year, free, drop). `year` null: the candidate track."""
    got = items.withColumn("name", names.host(F.col("host")))
    got = names.registrable(got, "name").withColumnRenamed("registrable", "parent")
    year = F.col("year").cast("string").try_cast("int")
    reason = (
        F.when(F.coalesce("name", F.lit("")) == "", "no name")
        .when(F.col("year").isNotNull() & year.isNull(), "bad year")
        .when(~year.between(1996, 2001), "out of window")
        .when(F.col("status").cast("string").rlike(r"^[45]"), "error status")
        .when(names.refusal(F.col("name")).isNotNull(), "not a host")
        .when(F.col("parent").isNull(), "no registrable")
    )
    return got.select("item", "name", "parent", year.alias("year"), "free", reason.alias("drop"))


def distinct_records(kept: DataFrame) -> DataFrame:
    """One row for each year and name; free only where every copy is."""
    return kept.groupBy("year", "name").agg(F.min("parent").alias("parent"), F.bool_and(F.coalesce("free", F.lit(False))).alias("free"))


def leftovers(records: DataFrame, held: DataFrame, pool: DataFrame, dated: DataFrame) -> DataFrame:
    """records with flags: ships, held (for that year, or for any where there is none), pool, parent_held, dated.

    Every flag is a join on the exact name against a set with one row a key.
    """
    yes = F.lit(True)

    def flagged(df: DataFrame, flag: str, side: DataFrame, name: str, by_year: bool) -> DataFrame:
        on = ["name", "year"] if by_year else ["name"]
        keyed = side.select(*on).distinct().withColumn(flag, yes)
        keyed = keyed.select(F.col("name").alias("__n"), *([F.col("year").alias("__y")] if by_year else []), flag)
        test = F.col(name) == F.col("__n")
        if by_year:
            test = test & F.col("year").eqNullSafe(F.col("__y"))
        return df.join(keyed, test, "left").drop("__n", "__y")

    out = records.withColumn("ships", F.when(F.col("year").isNull(), delegation.ships_undated(F.col("name"))).otherwise(delegation.ships_host(F.col("name"), F.col("year"))))
    out = flagged(out, "held_pair", held, "name", True)
    out = flagged(out, "held_name", held.select("name"), "name", False)
    out = flagged(out, "in_pool", pool, "name", False)
    out = flagged(out, "parent_held", held.select("name"), "parent", False)
    out = flagged(out, "dated", dated, "name", True)
    no = F.lit(False)
    flag = {c: F.coalesce(c, no) for c in ("held_pair", "held_name", "in_pool", "parent_held", "dated")}
    held_now = F.when(F.col("year").isNull(), flag["held_name"]).otherwise(flag["held_pair"])
    return out.select("year", "name", "parent", "free", "ships", held_now.alias("held"), flag["in_pool"].alias("in_pool"), flag["parent_held"].alias("parent_held"), flag["dated"].alias("dated"))


def tally(flagged: DataFrame, weights: DataFrame) -> DataFrame:
    """(track, part, year, tld, n, value): names that the release lacks, dated and undated ones never summed together.

    The table of weights is joined to the counts, a row for each year and label, not to the names.
    """
    left = flagged.where("ships and not held and not (year is null and in_pool)")
    track = F.when(F.col("year").isNull(), "candidate").otherwise("annual")
    part = F.when(F.col("free"), "extended").otherwise("core")
    counts = left.groupBy(track.alias("track"), part.alias("part"), "year", names.tld(F.col("name")).alias("tld")).agg(F.count("*").alias("n"))
    value = F.coalesce(F.col("n") * F.col("weight").cast("decimal(12,8)"), F.lit(0).cast("decimal(33,8)"))
    return counts.join(weights, "tld", "left").select("track", "part", "year", "tld", "n", value.alias("value"))


def top(tallied: DataFrame, k: int = 5) -> DataFrame:
    by = tallied.groupBy("tld").agg(F.sum("n").alias("n"), F.sum("value").alias("value"))
    return by.orderBy(F.desc("value"), "tld").limit(k)


def reconciles(tallied: DataFrame, other: DataFrame) -> DataFrame:
    """Rows whose value differs from other(track, part, year, value) at 4 decimals, or that just one side has."""
    mine = tallied.groupBy("track", "part", "year").agg(F.sum("value").alias("mine"))
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("track", "part", "year")]
    both = mine.alias("a").join(other.alias("b"), on[0] & on[1] & on[2], "full")
    four = "decimal(38,4)"
    return both.where(~F.col("a.mine").cast(four).eqNullSafe(F.col("b.value").cast(four))).select(*[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in ("track", "part", "year")], "mine", F.col("b.value").alias("theirs"))
