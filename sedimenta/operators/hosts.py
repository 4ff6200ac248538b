"""Host-grain lanes: journals of captures and lists of hosts, to (host, parent, year, value, url) of hosts below their registrable name.

Every lane gives all its lines, `drop` naming why one yields nothing, so that one pass tells the records and the counts of drops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import delegation, names
from sedimenta.operators import picks

FIRST, LAST = 1996, 2001
# Journal families by the beginning of their file's name: (source, method); the last is for all others.
FAMILIES = {
    "cdx_gap_": ("ia_cdx_hostnames", "ia_cdx_gap_hostgrain"), "availability_host_": ("ia_cdx_hostnames", "wayback_availability"),
    "nypw_": ("ia_cdx_hostnames", "nypw_timemap_hostgrain"), "early_web_": ("early_web_hostnames", "early_web_hostgrain"),
    "arquivo_": ("arquivo_hostnames", "arquivo_ia_cdxj_hostgrain"), "poland_pl_": ("poland_hostnames", "poland_pl_extract_hostgrain"),
    "": ("ia_cdx_hostnames", "ia_cdx_domain_sweep"),
}
#: Families whose rows must carry a status, and the names of lanes that hold error captures only.
STATUS_FAMILIES = ("nypw_", "early_web_", "fleetread_")
ERROR_LANE = r"^early_web_nonok_|_[45]xx(_status)?\.jsonl(\.gz)?\z"


def dispatch(file_name: Column, families: dict[str, tuple[str, str]] = FAMILIES) -> Column:
    """struct(source, method) of a journal by its name."""
    out = None
    for prefix, (source, method) in families.items():
        found = F.struct(F.lit(source).alias("source"), F.lit(method).alias("method"))
        if not prefix:
            return found if out is None else out.otherwise(found)
        out = F.when(file_name.startswith(prefix), found) if out is None else out.when(file_name.startswith(prefix), found)
    return out


def error_lane(file_name: Column) -> Column:
    return file_name.rlike(ERROR_LANE)


def status_required(file_name: Column) -> Column:
    return F.regexp_extract(file_name, f"^({'|'.join(STATUS_FAMILIES)})", 1).isin(*STATUS_FAMILIES) | error_lane(file_name)


def _row(lines: DataFrame) -> DataFrame:
    """lines that aren't blank, with their JSON object as a map `row`; a key that isn't there differs from one without a value."""
    return lines.where(F.col("value").rlike(r"\S")).withColumn("row", F.from_json("value", "map<string,string>"))


def _in(key: str) -> Column:
    return F.try_element_at("row", F.lit(key))


def _reason(drops: list[tuple[str, Column]]) -> Column:
    out = F.lit(None).cast("string")
    for name, test in reversed(drops):
        out = F.when(test, name).otherwise(out)
    return out


def capture_lines(lines: DataFrame) -> DataFrame:
    """(host, year, stamp, status, error, url, file_name, line, drop) of a journal's lines(value, file_name); `line` is the text itself."""
    status, stamp = F.trim(_in("status")), F.coalesce(_in("timestamp"), F.lit(""))
    has = F.coalesce(F.map_contains_key("row", F.lit("status")), F.lit(False))
    year, host = F.left(stamp, F.lit(4)).try_cast("int"), names.capture_host(F.coalesce(_in("url"), F.lit("")))
    error = has & status.rlike("^[45]")
    drop = _reason([
        ("unparseable", F.col("row").isNull()), ("bad_status", has & ~F.coalesce(status.rlike(r"^[2-5][0-9]{2}\z"), F.lit(False))), ("no_status", status_required(F.col("file_name")) & ~has),
        ("status_mismatch", error_lane(F.col("file_name")) & ~error), ("bad_timestamp", ~stamp.rlike(r"^[0-9]{14}\z")),
        ("out_of_window", ~F.coalesce(year.between(FIRST, LAST), F.lit(False))), ("no_host", host.isNull()),
    ])
    return _row(lines).select(
        host.alias("host"), year.alias("year"), stamp.alias("stamp"), F.when(error, status).alias("status"), F.coalesce(error, F.lit(False)).alias("error"), _in("url").alias("url"),
        "file_name", F.col("value").alias("line"), drop.alias("drop"),
    )


def refused_journals(captures: DataFrame) -> DataFrame:
    """(file_name) of journals of which a row lacks the status that its family must carry: none of their rows counts."""
    return captures.where("drop = 'no_status'").select("file_name").distinct()


def folded(captures: DataFrame) -> DataFrame:
    """One capture a host and year: a good one before any in error, then the earliest; first within each journal, then over all of them, so that
    a journal sends one row a host and year. The order of arrival never shows."""
    kept = captures.where("drop is null").join(refused_journals(captures), "file_name", "left_anti")
    order = F.struct("error", "stamp", "file_name", "line")
    what = F.struct("error", "stamp", "status", "url", "file_name")
    one = kept.groupBy("host", "year").agg(F.min_by(what, order).alias("c"))  # partial aggregation does the journals' part
    host, stamp = F.col("host"), F.col("c.stamp")
    value = F.concat(F.lit("cdx capture "), stamp, F.when(F.col("c.error"), F.concat(F.lit(" status "), "c.status")).otherwise(""), F.lit(" "), host)
    return one.select("host", "year", value.alias("evidence_value"), F.concat(F.lit("https://web.archive.org/web/"), stamp, F.lit("/"), "c.url").alias("evidence_url"), "c.error", "c.file_name")


def reread(lines: DataFrame, only: DataFrame) -> DataFrame:
    """The lines whose address names a host of only(host), found before any JSON is read."""
    host = F.rtrim(F.lower(F.regexp_extract("value", r'"url": *"[a-zA-Z][a-zA-Z0-9+.-]*://([^/:"]+)', 1)), F.lit("."))
    return lines.withColumn("host", host).join(only.select("host").distinct(), "host", "left_semi").drop("host")


def extended_screen(lines: DataFrame, first: int, last: int, strict: bool = False) -> DataFrame:
    """(host, year, stamp, statusless, drop) of capture rows for years beyond the window: eight reasons to date nothing; blank lines are `blank`."""
    df = lines.withColumn("row", F.from_json("value", "map<string,string>"))
    has = F.coalesce(F.map_contains_key("row", F.lit("status")), F.lit(False))
    status, stamp = F.trim(F.coalesce(_in("status"), F.lit("None"))), F.coalesce(_in("timestamp"), F.lit(""))
    year = F.left(stamp, F.lit(4)).try_cast("int")
    host = names.capture_host(F.regexp_replace(F.trim(F.coalesce(_in("url"), F.lit(""))), r"\s+", " "))
    df = names.registrable(df.withColumn("host", host), "host")
    drop = _reason([
        ("blank", ~F.col("value").rlike(r"\S")), ("unparseable", F.col("row").isNull()), ("bad_status", has & ~status.rlike(r"^[2-5][0-9]{2}\z")), ("error_status", has & status.rlike("^[45]")),
        ("no_status", ~has & F.lit(strict)), ("bad_timestamp", ~stamp.rlike(r"^[0-9]{14}\z")), ("outside_window", ~F.coalesce(year.between(first, last), F.lit(False))),
        ("invalid_host", F.col("host").isNull()), ("tld_did_not_exist", ~delegation.existed(names.tld(F.col("host")), year)), ("no_registrable", F.col("registrable").isNull()),
    ])
    return df.select("host", year.alias("year"), stamp.alias("stamp"), (~has).alias("statusless"), drop.alias("drop"))


def extended_firsts(screened: DataFrame) -> DataFrame:
    """The row of each host and year that is quoted: one with a status before one without, then the earliest."""
    return screened.where("drop is null").groupBy("host", "year").agg(F.min(F.struct("statusless", "stamp"))["stamp"].alias("stamp"))


def extended_export(firsts: DataFrame, held: DataFrame) -> DataFrame:
    """(year, base, added, growth in percent) of the firsts that held(name, year) lacks; no growth where the base is empty."""
    added = firsts.select(F.col("host").alias("name"), "year").join(held.select("name", "year"), ["name", "year"], "left_anti").groupBy("year").agg(F.count("*").alias("added"))
    base = held.groupBy("year").agg(F.countDistinct("name").alias("base"))
    both = base.join(added, "year", "full").fillna(0, ["base", "added"])
    return both.withColumn("growth", F.round(100 * F.try_divide("added", "base"), 4))


def below(found: DataFrame, host: str = "host") -> DataFrame:
    """found with `parent`, where the host lies below its registrable name."""
    return names.registrable(found, host).withColumnRenamed("registrable", "parent").where(F.col("parent").isNotNull() & (F.col("parent") != F.col(host)))


def family_hosts(lines: DataFrame, value: Column) -> DataFrame:
    """(host, parent, year, item, evidence_value) of rows {item, year, text}: the hosts in each text; of a host and year the lowest item counts."""
    df = _row(lines).select(_in("item").alias("item"), _in("year").try_cast("int").alias("year"), F.explode(F.split(F.lower(F.coalesce(_in("text"), F.lit(""))), r"\s+")).alias("host"))
    df = df.where(F.col("year").between(FIRST, LAST) & F.col("host").rlike(names.HOSTNAME))
    one = df.groupBy("host", "year").agg(F.min("item").alias("item"))
    return below(one).select("host", "parent", "year", "item", value.alias("evidence_value"))


def survey_hosts(lines: DataFrame) -> DataFrame:
    """(host, parent, year, evidence_value, lines) of `address host` lines of files that carry YYMM; repeated lines are counted."""
    code = F.regexp_extract("file_name", r"([0-9]{2})(0[1-9]|1[0-2])", 0)
    yy = F.left(code, F.lit(2)).try_cast("int")
    year = yy + F.when(yy >= 90, 1900).otherwise(2000)
    host = F.rtrim(F.lower(F.element_at(F.split(F.trim("value"), r"\s+"), -1)), F.lit("."))
    df = lines.where(F.col("value").rlike(r"\S")).select(host.alias("host"), year.alias("year"), F.concat(year.cast("string"), F.lit("-"), F.right(code, F.lit(2))).alias("evidence_value"))
    df = df.where(F.coalesce(F.col("year").between(FIRST, LAST), F.lit(False)) & F.col("host").rlike(names.HOSTNAME))
    return below(df.groupBy("host", "year").agg(F.min("evidence_value").alias("evidence_value"), F.count("*").alias("lines")))


def blocklist_hosts(lines: DataFrame, label: str, dated: DataFrame | None = None) -> DataFrame:
    """(host, parent, year, evidence_value, corroborated) of dated lists: hosts below their registrable; of diffs the added lines only. With
    dated(name, year), whether the parent is dated in that year by somebody else."""
    stamp = F.regexp_extract("file_name", r"([0-9]{8})", 1)
    diff = F.col("file_name").rlike(r"\.diff\z")
    text = F.regexp_replace(F.trim("value"), r"#.*\z", "")
    text = F.when(~diff, text).when(text.startswith("+") & ~text.startswith("+++"), F.substring(text, 2, 1 << 20))
    host = names.host(text)
    df = lines.select(F.when(host.rlike(names.HOSTNAME), host).alias("host"), F.left(stamp, F.lit(4)).try_cast("int").alias("year"), stamp.alias("stamp"))
    df = df.where(F.col("host").isNotNull() & F.col("year").between(FIRST, LAST)).groupBy("host", "year").agg(F.min("stamp").alias("stamp"))
    out = below(df).select("host", "parent", "year", F.concat(F.lit(f"{label}:"), "stamp", F.lit(" "), "host").alias("evidence_value"))
    if dated is None:
        return out
    known = dated.select(F.col("name").alias("parent"), "year").distinct().withColumn("corroborated", F.lit(True))
    return out.join(known, ["parent", "year"], "left").fillna(False, ["corroborated"])


def zone_targets(lines: DataFrame, year: int, label: str) -> DataFrame:
    """(host, parent, year, evidence_value) of the right-hand sides of a zone's NS records."""
    target = F.rtrim(F.lower(F.regexp_extract("value", r"(?i)^\S+\s+(?:[0-9]+\s+)?(?:IN\s+)?NS\s+(\S+)", 1)), F.lit("."))
    df = lines.select(target.alias("host")).where(F.col("host").rlike(names.HOSTNAME)).distinct()
    return below(df).select("host", "parent", F.lit(year).alias("year"), F.concat(F.lit(f"{label} "), "host").alias("evidence_value"))


def object_hosts(df: DataFrame, key: str = "nserver", changed: str = "changed") -> DataFrame:
    """(host, parent, year, evidence_value) of registry objects(object, value): an object's name servers, dated by its latest changed line."""
    day = F.regexp_extract("value", rf"(?i)^{changed}:.*?([0-9]{{8}})\s*\z", 1)
    host = F.rtrim(F.lower(F.regexp_extract("value", rf"(?i)^{key}:\s*(\S+)", 1)), F.lit("."))
    read = df.select("object", F.nullif(day, F.lit("")).alias("day"), F.when(host.rlike(names.HOSTNAME), host).alias("host"))
    last = read.groupBy("object").agg(F.max("day").alias("day"))
    got = read.where("host is not null").select("object", "host").distinct().join(last, "object").where("day is not null")
    got = got.withColumn("year", F.left("day", F.lit(4)).cast("int")).where(F.col("year").between(FIRST, LAST)).groupBy("host", "year").agg(F.min("day").alias("day"))
    return below(got).select("host", "parent", "year", F.concat(F.lit("changed "), "day", F.lit(" "), "host").alias("evidence_value"))


#: Fields of a message that name hosts, the most telling first.
FIELD_ORDER = ("from", "message_id", "received", "header_more", "body_url", "body_mention")


def staged_messages(lines: DataFrame) -> DataFrame:
    """(host, parent, year, file, pos, field, drop) of staged message rows {host, year, file, pos, field}; of a host and year the first by field, file
    and place counts (`drop` is `later` for the others)."""
    host, field = F.lower(_in("host")), _in("field")
    df = _row(lines).select(host.alias("host"), _in("year").try_cast("int").alias("year"), _in("file").alias("file"), _in("pos").alias("pos"), field.alias("field"), "row")
    doubled = names.doubled_suffix(F.col("host"), 1) | names.doubled_suffix(F.col("host"), 2) | names.doubled_suffix(F.col("host"), 3)
    df = names.registrable(df, "host").withColumnRenamed("registrable", "parent")
    drop = _reason([
        ("unparseable", F.col("row").isNull()), ("bad_field", ~F.coalesce(F.col("field").isin(*FIELD_ORDER), F.lit(False))), ("bad_position", ~F.coalesce(F.col("pos").rlike(r"^[0-9]+(:[0-9]+)?\z"), F.lit(False))),
        ("out_of_window", ~F.coalesce(F.col("year").between(FIRST, LAST), F.lit(False))), ("bad_host", ~F.coalesce(F.col("host").rlike(names.HOSTNAME), F.lit(False))),
        ("doubled_suffix", doubled), ("no_registrable", F.col("parent").isNull()),
    ])
    df = df.withColumn("drop", drop).drop("row")
    rank = F.array_position(F.array(*[F.lit(f) for f in FIELD_ORDER]), F.col("field"))
    first = picks.first_by(df.where("drop is null").withColumn("rank", rank), ["host", "year"], [F.col("rank"), F.col("file"), F.length("pos"), F.col("pos")]).drop("rank")
    return first.unionByName(df.where("drop is not null"))


#: Names that stand for an address or a slot, not for a machine of that name.
EPHEMERAL = (
    r"[0-9]{1,3}[.-][0-9]{1,3}[.-][0-9]{1,3}[.-][0-9]{1,3}",
    r"(^|[.-])(ppp|dial|dialup|dhcp|dyn|pool|modem|slip|cable|dsl|adsl|ip|host|client|user|port|line|tty|ts|pm|async|isdn|tnt|as|max)[a-z]{0,3}-?[0-9]+",
    r"^[a-z]{0,3}[0-9]+-[0-9]+(-[0-9]+)*\.", r"^[0-9a-f]{8,}\.",
)


def ephemeral(host: Column) -> Column:
    """A lease's name: an address in it, a pool word with a number, a slot label or a hex label."""
    return F.coalesce(host.rlike("|".join(f"(?:{p})" for p in EPHEMERAL)), F.lit(False))


def header_host(headers: Column) -> Column:
    """The rightmost valid host of a trace, posting-host or path header."""
    tokens = F.filter(F.split(F.lower(headers), r"[^a-z0-9.-]+"), lambda x: x.rlike(names.HOSTNAME))
    return F.try_element_at(tokens, F.lit(-1))


def seeds(parts: DataFrame) -> DataFrame:
    """Distinct (raw, year) of seed lines whose name isn't the registrable itself."""
    df = parts.select(names.host(F.col("raw")).alias("name"), "year")
    return names.registrable(df, "name").where("registrable is not null and name <> registrable").select("name", "year").distinct()


def batch_first(shards: DataFrame, order: str = "shard") -> DataFrame:
    """Of each host and year the row of the first shard that names it, its least line first."""
    return picks.first_by(shards, ["host", "year"], [F.col(order), F.col("evidence_value").asc_nulls_last()])
