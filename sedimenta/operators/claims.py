"""What may stand in a claim or a candidate list, and the review of what may not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import delegation, names
from sedimenta.functions import evidence as ev
from sedimenta.operators import picks

# Names of home-row keys; sources whose names were typed, stood in a body, or are leases; staged sources of each kind.
MASHED = r"(^|\.)([asdfghjkl]+[sdfghjkl]{4}[asdfghjkl]*|[sdfghjkl]{4}[asdfghjkl]+)\."
TYPED = ("usenet_from_hostnames", "usenet_message_id_hostnames", "usenet_header_more_hostnames", "usenet_body_mention_hostnames")
TYPED_STAGED = r"^msg_[a-z0-9_]+__(from|message_id|header_more|body_mention)\z"
BODY = ("usenet_body_mention_hostnames", "usenet_body_url_hostnames", "maillist_body_url_hostnames", "usenet_mention", "usenet_address_mention", "usenet_bare_mention")
BODY_STAGED = r"^msg_[a-z0-9_]+__(body_mention|body_url)\z"
LEASE_STAGED = r"^msg_[a-z0-9_]+__lease\z"
PLACEHOLDER = r"(^|[.])(my|no|test|dummy|any|some|fake|local)domain[.][a-z.]+\z"
CUT_TLD = r"[.](co|ne|om)\z"
THIRD_LEVEL = r"^[^.]+[.](uk|au|nz|br|kr|sg|my|il|mx|ar|pe|th|ve)\z"
OLD_UK = r"^(bl|jet|mod|nhs|parliament|police)[.]uk\z"
MODERATED = ("comp.internet.net-happenings",)
NO_SPLIT = ("artifact_listing", "whois_creation")


def _true(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def typed(source: Column) -> Column:
    return _true(source.isin(*TYPED) | source.rlike(TYPED_STAGED))


def in_body(source: Column) -> Column:
    return _true(source.isin(*BODY) | source.rlike(BODY_STAGED))


def leased(source: Column, leases: tuple[str, ...] = ()) -> Column:
    return _true(source.isin(*leases) | source.rlike(LEASE_STAGED))


def mashed(name: Column) -> Column:
    return _true(name.rlike(MASHED))


def body_only(evidence: DataFrame, sources: DataFrame) -> DataFrame:
    """(domain) that some body names and no other source does: one pass over the evidence."""
    rows = evidence.join(sources.select("source_id", in_body(F.col("name")).alias("body")), "source_id")
    return rows.groupBy("domain").agg(F.bool_and("body").alias("body")).where("body").select("domain")


def claimable(claimed: DataFrame, evidence: DataFrame, sources: DataFrame, hosts: DataFrame, leases: tuple[str, ...] = (), ship_leases: bool = True) -> DataFrame:
    """claimed(name, year, evidence_id) without leases (if they don't ship), mashed names that were typed, and names that bodies alone name;
    hosts(hostname, evidence_id) are the rows that may second a name from a body."""
    cited = evidence.select("evidence_id", "source_id").join(sources.select("source_id", F.col("name").alias("source")), "source_id").select("evidence_id", "source")
    df = claimed.join(cited, "evidence_id", "left")
    other = hosts.join(cited.where(~in_body(F.col("source"))), "evidence_id", "left_semi").select(F.col("hostname").alias("name")).distinct().withColumn("seconded", F.lit(True))
    df = df.join(other, "name", "left")
    source = F.col("source")
    keep = (~mashed(F.col("name")) | ~typed(source)) & (~in_body(source) | _true(F.col("seconded")))
    if not ship_leases:
        keep = keep & ~leased(source, leases)
    return df.where(keep).select(*claimed.columns)


def unusable(name: Column, year: Column, source: Column, kind: Column, source_file: Column) -> Column:
    """A candidate that its row can't stand for: no file, a placeholder, a munge, a name of a later service, a cut or impossible name."""
    munge = (kind == "mail or news From or Message-ID host") & name.rlike("^(no)?spam")
    later = source.startswith("msg_gmane_lists") & (year < 2002) & ((name == "gmane.org") | name.endswith(".gmane.org"))
    cut = name.rlike(CUT_TLD) & ~name.rlike(rf"(^|[.])(com|net|org|edu|gov){CUT_TLD}")
    third = name.rlike(THIRD_LEVEL) & ~name.rlike(OLD_UK)
    dated = year.isNotNull() & (name.rlike(PLACEHOLDER) | _true(munge) | _true(later) | ((year < 2002) & (cut | third)))
    return (F.coalesce(source_file, F.lit("")) == "") | _true(dated)


def moderated(group: Column) -> Column:
    """A moderated announcement forum: by a component of its name, or one of the few that say so nowhere."""
    return _true(group.isin(*MODERATED) | F.arrays_overlap(F.split(group, r"\."), F.array(F.lit("announce"), F.lit("moderated"))))


def class_head(kind: Column) -> Column:
    """The first word of a free-text class, before any bracket."""
    word = F.regexp_extract(F.split_part(F.coalesce(kind, F.lit("")), F.lit("("), F.lit(1)), r"(\S+)", 1)
    return F.lower(F.regexp_replace(word, r"^[,:]+|[,:]+\z", ""))


def takes_no_split(kind: Column) -> Column:
    return class_head(kind).isin(*NO_SPLIT, *ev.WEB_METHODS, ev.STATUS_METHOD)


def funnel_reason(values: DataFrame, column: str) -> DataFrame:
    """values with `reason`: why the host grain refuses one; null where it doesn't, or there is nothing to refuse."""
    raw = F.col(column)
    bare = F.lower(F.trim(F.regexp_replace(F.regexp_replace(raw, r"^.*?://", ""), r"(?s)[/:].*\z", "")))
    df = values.withColumn("__host", names.capture_host(raw))
    df = names.registrable(df, "__host")
    reason = (
        F.when(F.col("__host").isNull(), F.when(bare == "", None).when(bare.rlike(r"\.(in-addr|ip6)\.arpa\z"), "reverse_dns").when(~bare.rlike(names.HOSTNAME), "not_rfc1123").otherwise("no_public_suffix"))
        .when(F.col("registrable").isNull(), "no_public_suffix").when(F.col("registrable") == F.col("__host"), "is_registrable")
    )
    return df.withColumn("reason", reason).drop("__host", "registrable")


def unparsed_pool(values: DataFrame, column: str) -> DataFrame:
    """Distinct (value, reason) that the host grain refuses, with how many rows have it."""
    return funnel_reason(values, column).where("reason is not null").groupBy(F.col(column).alias("value"), "reason").agg(F.count("*").alias("n"))


def droplist(lines: DataFrame) -> DataFrame:
    """(reason, raw, files) of the lines(value, file_name) that are no names, and how often their reason comes; by falling number of entries."""
    df = lines.select(F.trim("value").alias("raw"), "file_name").where("raw <> ''").withColumn("host", names.host(F.col("raw")))
    lost = names.reduced(df, "host").where("refused is not null").groupBy(F.col("refused").alias("reason"), "raw").agg(F.array_sort(F.collect_set("file_name")).alias("files"))
    return lost.join(lost.groupBy("reason").agg(F.count("*").alias("entries")), "reason")


def seed_states(seeds: DataFrame, known: DataFrame, held: DataFrame, on_file: DataFrame) -> DataFrame:
    """(name, state): confirmed by the baseline or by own evidence, candidate on file, or new."""
    def flag(df: DataFrame, name: str) -> DataFrame:
        return df.select("name").distinct().withColumn(name, F.lit(True))

    df = seeds.select("name").distinct().join(flag(held, "theirs"), "name", "left").join(flag(known, "ours"), "name", "left").join(flag(on_file, "filed"), "name", "left")
    state = F.when(F.col("theirs"), "confirmed_baseline").when(F.col("ours"), "confirmed_own").when(F.col("filed"), "candidate").otherwise("new")
    return df.select("name", state.alias("state"))


def status_class(status: Column) -> Column:
    return F.when(status.rlike(r"^[2-5][0-9]{2}\z"), F.concat(F.left(status, F.lit(1)), F.lit("xx"))).otherwise("other")


def index_rows(lines: DataFrame, stamp: int, url: int, status: int, first: int = 1996, last: int = 2001) -> DataFrame:
    """(stamp, url, status) of the rows within the window of an index whose columns stand at these places."""
    p = F.split("value", " ")
    at = F.get(p, F.lit(stamp))
    df = lines.select(at.alias("stamp"), F.get(p, F.lit(url)).alias("url"), F.get(p, F.lit(status)).alias("status"))
    return df.where(F.col("status").isNotNull() & F.col("stamp").rlike(r"^[0-9]{14}\z") & F.left("stamp", F.lit(4)).try_cast("int").between(first, last))


def error_audit(rows: DataFrame) -> DataFrame:
    """(host, stamp, status) of error captures that no good capture of the same host and second shadows, with the host-year's earliest good
    stamp (null where there is none)."""
    df = rows.select(names.capture_host(F.col("url")).alias("host"), "stamp", "status", status_class(F.col("status")).alias("class")).where("host is not null")
    good = F.col("class").isin("2xx", "3xx")
    by = df.groupBy("host", "stamp").agg(F.min(F.when(F.col("class").isin("4xx", "5xx"), F.col("status"))).alias("status"), F.bool_or(good).alias("good"))
    firsts = by.where("good").groupBy("host", F.left("stamp", F.lit(4)).alias("year")).agg(F.min("stamp").alias("good_stamp"))
    errors = by.where("status is not null and not good").select("host", "stamp", "status", F.left("stamp", F.lit(4)).alias("year"))
    return errors.join(firsts, ["host", "year"], "left").select("host", "stamp", "status", "good_stamp")


def survey_reduction(evidence: DataFrame, held: DataFrame, own: DataFrame) -> DataFrame:
    """Distinct (hostname, year) of survey rows that may ship and that neither held(name) nor own(name) has, by exact name."""
    host = F.lower(ev.last_token(F.col("evidence_value")))
    df = evidence.select(host.alias("hostname"), "domain", F.col("evidence_year").alias("year"))
    df = df.where((F.col("hostname") != F.col("domain")) & F.endswith("hostname", F.concat(F.lit("."), "domain")) & F.col("hostname").rlike(names.HOSTNAME))
    df = df.where(delegation.ships_host(F.col("hostname"), F.col("year"))).select("hostname", "year").distinct()
    known = held.select(F.col("name").alias("hostname")).union(own.select(F.col("name").alias("hostname"))).distinct()
    return df.join(known, "hostname", "left_anti")


def trace(evidence: DataFrame, sources: DataFrame, name: str, year: int | None = None) -> DataFrame:
    """All observations of one name, in a year if one is given."""
    df = evidence.where(F.col("domain") == name)
    if year is not None:
        df = df.where(F.col("evidence_year") == year)
    return df.join(sources.select("source_id", F.col("name").alias("source")), "source_id", "left").select("evidence_id", "source", "evidence_year", "evidence_type", "evidence_value")


def increment(net_new: DataFrame, evidence: DataFrame, sources: DataFrame, verified: DataFrame, since: Column) -> DataFrame:
    """(source, tld, year, n) of the net-new pairs verified since an instant; verified(evidence_id, verified_at)."""
    fresh = net_new.join(verified.where(F.col("verified_at") >= since), "evidence_id", "left_semi").join(evidence.select("evidence_id", "source_id"), "evidence_id")
    named = fresh.join(sources.select("source_id", F.col("name").alias("source")), "source_id")
    return named.groupBy("source", names.tld(F.col("name")).alias("tld"), "year").agg(F.count("*").alias("n"))


def stranded(hosts: DataFrame, evidence: DataFrame) -> DataFrame:
    """hosts(hostname, parent_domain, year, evidence_id) with the row that each should rest on: the lowest that qualifies for the host, found by
    parent, year and the host that the value names, never by a test of the value's end."""
    e = evidence.withColumn("__ev", ev.parsed()).where(F.col("__ev.web") & F.col("__ev.host").isNotNull())
    good = e.groupBy(F.col("domain").alias("parent_domain"), F.col("evidence_year").alias("year"), F.col("__ev.host").alias("hostname")).agg(F.min("evidence_id").alias("good_id"))
    return hosts.join(good, ["parent_domain", "year", "hostname"], "left").withColumn("evidence_id", F.coalesce("good_id", "evidence_id")).drop("good_id")


def replay_failed(evidence: DataFrame, failures: DataFrame) -> DataFrame:
    """(evidence_id) of rows whose value contains the stamp of a failure(domain, year, stamp): an equi join, then the test."""
    e = evidence.select("evidence_id", "domain", F.col("evidence_year").alias("year"), "evidence_value")
    both = e.join(failures.select("domain", "year", "stamp").distinct(), ["domain", "year"])
    return both.where(F.contains("evidence_value", "stamp")).select("evidence_id").distinct()


def retracted(hosts: DataFrame, evidence: DataFrame, errors: DataFrame) -> DataFrame:
    """hosts after a review: rows that rest on one of errors(evidence_id) move to the best other row that qualifies, or go."""
    bad = errors.select("evidence_id").distinct()
    kept = hosts.join(bad, "evidence_id", "left_anti")
    hit = hosts.join(bad, "evidence_id", "left_semi")
    moved = stranded(hit, evidence.join(bad, "evidence_id", "left_anti")).join(bad, "evidence_id", "left_anti")
    return kept.unionByName(moved.select(*kept.columns))


def recited(evidence: DataFrame, archives: DataFrame) -> DataFrame:
    """evidence with the place of an archive record, archives(evidence_id, arc, arc_offset), added to its address; the least record counts."""
    one = picks.first_by(archives, ["evidence_id"], [F.col("arc"), F.col("arc_offset")])
    url = F.when(F.col("arc").isNotNull(), F.concat(F.regexp_replace(F.coalesce("evidence_url", F.lit("")), r"#.*\z", ""), F.lit("#arc "), "arc", F.lit(" "), F.col("arc_offset").cast("string"))).otherwise(F.col("evidence_url"))
    return evidence.join(one, "evidence_id", "left").withColumn("evidence_url", url).drop("arc", "arc_offset")


def known_delta(names_in: DataFrame, theirs: DataFrame, ours: DataFrame) -> DataFrame:
    """(name, year, known) of pairs, known to either side."""
    both = theirs.select("name", "year").union(ours.select("name", "year")).distinct().withColumn("known", F.lit(True))
    return names_in.join(both, ["name", "year"], "left").fillna(False, ["known"])
