"""The integrity checks over a store and its shipped files. Each is a one-row table (name, offending); zero passes.

A check whose input isn't there is skipped: it is not in the report, so it can't pass by absence.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import delegation, names
from sedimenta.functions import evidence as ev

NAME = r"^([a-z0-9_]([a-z0-9_-]{0,61}[a-z0-9_])?\.)+[a-z0-9]([a-z0-9-]{0,61}[a-z0-9])?\z"
Tables = dict[str, DataFrame]
CHECKS: dict[str, tuple[tuple[str, ...], Callable[[Tables], DataFrame]]] = {}


def check(*needs: str):
    """Registers a function from tables to its offending rows."""

    def keep(f):
        CHECKS[f.__name__] = (needs, f)
        return f

    return keep


def _cited(t: Tables, years: str, columns: list[str]) -> DataFrame:
    return t[years].join(t["evidence"].select("evidence_id", *columns), "evidence_id")


def _wall(t: Tables, years: str, name: str) -> DataFrame:
    e = t["evidence"].select("evidence_id", F.col("domain").alias("__d"), "evidence_year")
    return t[years].join(e, "evidence_id", "left").where(f"__d is null or __d <> {name} or evidence_year <> assigned_year")


def _absent(df: DataFrame, column: str, held: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(column).alias("k")).join(held.select(F.col(key).alias("k")), "k", "left_anti")


@check("domain_year", "evidence")
def evidence_wall_intact(t):
    return _wall(t, "domain_year", "domain")


@check("domain_year", "evidence")
def no_candidate_leakage(t):
    return _cited(t, "domain_year", ["evidence_type"]).where(F.col("evidence_type").isin(*ev.CANDIDATE_TYPES))


@check("domain_year", "evidence")
def every_pair_has_master_evidence(t):
    held = t["evidence"].where(~F.col("evidence_type").isin(*ev.CANDIDATE_TYPES)).select("domain", F.col("evidence_year").alias("assigned_year"))
    return t["domain_year"].join(held, ["domain", "assigned_year"], "left_anti")


@check("domain_year")
def within_year_unique(t):
    return t["domain_year"].groupBy("domain", "assigned_year").count().where("count > 1")


@check("domain_year")
def assigned_year_in_window(t):
    return t["domain_year"].where("assigned_year not between 1996 and 2001")


@check("domain")
def registered_domain_format(t):
    return t["domain"].where((F.length("domain") > 253) | ~F.col("domain").rlike(NAME))


@check("domain_year")
def no_idn_tld_in_window(t):
    return t["domain_year"].where(names.tld(F.col("domain")).startswith("xn--"))


def evidence_year_matches_its_value(t, spans: tuple[str, ...] = ("afnic_fr",)):
    """The first four-digit run of a value that reads as a year is the year it is filed under; spans name two by design."""
    year = F.regexp_extract("evidence_value", r"([0-9]{4})", 1).try_cast("int")
    e = t["evidence"].withColumn("__y", year).join(t["source"].select("source_id", "name"), "source_id")
    judged = F.col("evidence_type").isin("cdx_timestamp", "artifact_listing", "link_source") | ((F.col("evidence_type") == "whois_creation") & ~F.col("name").isin(*spans))
    return e.where(judged & (F.col("__y") != F.col("evidence_year")))


CHECKS["evidence_year_matches_its_value"] = (("evidence", "source"), evidence_year_matches_its_value)


@check("shipped", "held")
def additions_not_double_counted(t):
    return t["shipped"].join(t["held"], ["name", "year"], "left_semi")


@check("shipped")
def no_arpa_in_the_shipped_files(t):
    return t["shipped"].where(F.col("name").endswith(".arpa"))


@check("shipped")
def no_tld_predates_its_own_delegation(t):
    return t["shipped"].where(~delegation.delegated_by(F.col("name"), F.col("year")))


@check("shipped")
def no_tld_that_never_existed_in_the_window(t):
    return t["shipped"].where(~delegation.in_window_set(F.col("name")))


@check("hostname_year", "evidence")
def hostname_wall_intact(t):
    return _wall(t, "hostname_year", "parent_domain")


@check("hostname_year")
def hostname_is_below_its_parent(t):
    h = F.col("hostname")
    below = F.endswith(h, F.concat(F.lit("."), "parent_domain"))
    return t["hostname_year"].where(~below | (F.length(h) > 253) | ~h.rlike(NAME))


@check("hostname_year", "evidence", "source", "web_source")
def hostname_observed_serving_web(t):
    """web_source(name, any_method): sources whose rows show hosts in use; where any_method is false only by a web method."""
    e = _cited(t, "hostname_year", ["source_id", "acquisition_method"]).join(t["source"].select("source_id", "name"), "source_id")
    e = e.join(t["web_source"].select("name", "any_method"), "name", "left")
    return e.where(~F.coalesce(F.col("any_method") | F.col("acquisition_method").isin(*ev.WEB_METHODS) & F.col("any_method").isNotNull(), F.lit(False)))


@check("hostname_year", "evidence")
def a_host_record_has_its_own_evidence(t):
    return _cited(t, "hostname_year", ["evidence_value"]).where(~F.endswith("evidence_value", F.concat(F.lit(" "), "hostname")))


@check("shipped_domains", "evidence")
def a_registrable_record_has_its_own_capture(t):
    """Only the rows of shipped names are parsed."""
    shipped = t["shipped_domains"].select("name", "year")
    e = t["evidence"].join(shipped.select(F.col("name").alias("domain"), F.col("year").alias("evidence_year")).distinct(), ["domain", "evidence_year"], "left_semi")
    own = e.withColumn("__ev", ev.parsed()).where(ev.qualifies(F.col("__ev"), F.col("domain"))).select(F.col("domain").alias("name"), F.col("evidence_year").alias("year"))
    return shipped.join(own, ["name", "year"], "left_anti")


@check("domain_year", "evidence")
def nothing_earned_is_left_unassigned(t):
    dated = t["domain_year"].select("domain", F.col("assigned_year").alias("evidence_year"))
    left = t["evidence"].where(~F.col("evidence_type").isin(*ev.CANDIDATE_TYPES)).join(dated, ["domain", "evidence_year"], "left_anti")
    return left.where(~ev.names_another_host(ev.parsed(), F.col("domain")))


@check("domain_year", "hostname_year", "evidence", "source", "error_capture")
def no_master_record_points_to_an_error_capture(t):
    """error_capture(source, method, ts, hostname): captures that an audit found in error."""
    bad = t["error_capture"].select(F.col("source").alias("name"), F.col("method").alias("acquisition_method"), F.concat(F.lit("cdx capture "), "ts", F.lit(" "), "hostname").alias("evidence_value"))
    e = t["evidence"].join(t["source"].select("source_id", "name"), "source_id").join(bad, ["name", "acquisition_method", "evidence_value"], "left_semi").select("evidence_id")
    both = t["hostname_year"].select("evidence_id").union(t["domain_year"].select("evidence_id"))
    return both.join(e, "evidence_id", "left_semi")


@check("evidence")
def evidence_id_unique(t):
    """A row for each surplus copy of an id."""
    return t["evidence"].groupBy("evidence_id").count().where("count > 1").select(F.explode(F.sequence(F.lit(2).cast("long"), "count")))


@check("evidence", "domain", "domain_year", "hostname_year", "domain_language")
def domain_wall_intact(t):
    users = [(t["evidence"], "domain"), (t["domain_year"], "domain"), (t["hostname_year"], "parent_domain"), (t["domain_language"], "domain")]
    return _absent(reduce(DataFrame.union, [df.select(F.col(c).alias("k")) for df, c in users]), "k", t["domain"], "domain")


@check("evidence", "domain", "source")
def source_wall_intact(t):
    users = t["evidence"].select("source_id").union(t["domain"].select("discovered_source"))
    return _absent(users, "source_id", t["source"], "source_id")


@check("evidence", "first_own_id")
def new_rows_have_location(t):
    """first_own_id(evidence_id): one row, the first id that this store gave out; rows from before may lack a place."""
    first = F.broadcast(t["first_own_id"].agg(F.min("evidence_id").alias("__first")))  # one row
    return t["evidence"].where("source_file is null or record_location is null").join(first, F.col("evidence_id") >= F.col("__first"))


def report(tables: Tables) -> DataFrame:
    """(name, offending) of every check whose tables are all there. One job counts them all."""
    out = [f(tables).agg(F.count("*").alias("offending")).select(F.lit(name).alias("name"), "offending") for name, (needs, f) in CHECKS.items() if all(n in tables for n in needs)]
    return reduce(DataFrame.union, out)


def skipped(tables: Tables) -> list[str]:
    return [name for name, (needs, _) in CHECKS.items() if any(n not in tables for n in needs)]
