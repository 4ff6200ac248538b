"""Bulk formats whose lines don't stand alone: pages read whole, objects split at their first key, and files with a header.

- Page formats take pages(value, file_name), a row a file; only for pages, which are small.
- Object formats take blocks(value, file_name) from `blocks`, whose reader splits the file at the key that opens an object, so that
  a big file is still many tasks and no object is cut in two.
- Header formats take lines; what the header says comes back to the lines as one row a file.
Records are those of `formats`.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sedimenta.sources.formats import _in_window, _nth, _words, _year, records

PAGE_FORMATS: dict[str, Callable[[DataFrame], DataFrame]] = {}
BLOCK_FORMATS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {}
HEADER_FORMATS: dict[str, Callable[[DataFrame], DataFrame]] = {}
ENCODINGS = ("UTF-8", "ISO-8859-1", "US-ASCII", "UTF-16")
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
# What the pages and files are told by, and the words that stand before what is read.
JP_TITLE, JP_RESERVED, JP_ABOLISHED = "Registered Domains in JP (", "予約ドメイン名", "廃止"
CREATED_FIRST, CREATED_ELSE = "registered on:", "dates of creation"
MY_TITLE, MY_ROWS = "domain name listing", ("new", "delete")
QUEUES, QUEUE_TITLE, QUEUE_LINK, QUEUE_WIDTH = ("warnsh", "todelsh"), "shortlisted for", "Domain=", 16
LOCAL_MONTHS = ("mei", "agu", "okt", "des", "ags", "peb", "nop")
IE_UPDATED, IE_OWN = ("updated automatically at", "last updated"), ("domainregistry.ie", "iedr.ie")


def pages(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    got = spark.read.format("binaryFile").load(path)
    text = F.decode("content", encoding) if encoding.upper() in ENCODINGS else _decoder(encoding)("content")
    return got.select(text.alias("value"), F.element_at(F.split("path", "/"), -1).alias("file_name"))


def _decoder(encoding: str):
    """Encodings that the built-in function doesn't know, as an Arrow function; bytes that are no text become U+FFFD."""

    @F.pandas_udf("string")
    def decoded(content: pd.Series) -> pd.Series:
        return content.map(lambda b: bytes(b).decode(encoding, "replace"))

    return decoded


def blocks(spark: SparkSession, path: str | list[str], opening: str) -> DataFrame:
    """A row an object: value begins after `opening`, which stands at the start of a line unless it is a tag. What precedes the first
    object is a row too; it opens with no name and formats drop it."""
    got = spark.read.option("lineSep", opening if opening.startswith("<") else "\n" + opening).text(path).select("value", F.col("_metadata.file_name").alias("file_name"))
    return got.withColumn("value", F.when(F.startswith("value", F.lit(opening)), F.expr(f"substr(value, {len(opening) + 1})")).otherwise(F.col("value")))


def page(f):
    PAGE_FORMATS[f.__name__] = f
    return f


def block(opening: str):
    def keep(f):
        BLOCK_FORMATS[f.__name__] = (opening, f)
        return f

    return keep


def header(f):
    HEADER_FORMATS[f.__name__] = f
    return f


def _tagless(value: Column, by: str) -> Column:
    return F.regexp_replace(value, r"<[^>]+>", by)


def _stem(file_name: Column) -> Column:
    return F.regexp_replace(file_name, r"\.[^.]*\z", "")


def _between(text: Column, left: str, right: str) -> Column:
    """What stands between the first `left` and the next `right`; empty where there is no such place."""
    return F.regexp_extract(text, rf"(?s)\Q{left}\E(.*?)\Q{right}\E", 1)


def _name_at(text: Column, tld: str = r"[a-z]{2,}") -> Column:
    """The name of a host that text begins with; empty if it begins with none."""
    return F.regexp_extract(text, rf"(?i)^([a-z0-9][a-z0-9.-]*\.{tld})(?![a-z0-9-])", 1)


def _or_none(items: Column) -> Column:
    """items, or one null where there are none, so that a page without rows still gives its reason."""
    return F.explode_outer(F.when(F.size(items) > 0, items))


@page
def registry_sections(df: DataFrame) -> DataFrame:
    """A national register (read with encoding Shift_JIS): the page's title ends in its date; rules of dashes carry the suffix of the names below
    them, and a `#` follows each name."""
    stamp = _between(F.col("value"), JP_TITLE, ")")
    stamp = F.when(F.size(F.split(stamp, " ")) == 3, stamp).otherwise("")
    year = F.element_at(F.split(stamp, " "), -1).try_cast("int")
    cut = df.select("*", F.posexplode(F.split("value", r"\r?\n")).alias("at", "line"))
    before = F.regexp_replace(F.split_part("line", F.lit("domains:"), F.lit(1)), r"^-+|\s+", "")
    rule = F.startswith("line", F.lit("---")) & F.contains("line", F.lit("domains:")) & (before != "")
    cut = cut.withColumn("rule", rule).withColumn("suffix", F.last(F.when(rule, F.lower(before)), ignorenulls=True).over(Window.partitionBy("file_name").orderBy("at")))
    entry = F.lower(F.regexp_replace(F.split_part("line", F.lit("#"), F.lit(1)), r"^\(?\s*|\s+\z", ""))
    listed = ~F.col("rule") & F.col("line").rlike(r"\s#") & entry.rlike(r"^[a-z0-9][a-z0-9.-]*\z") & F.col("suffix").isNotNull()
    undated = (stamp == "") | ~_in_window(year)
    cut = cut.where(F.when(undated, F.col("at") == 0).otherwise(listed))
    name = F.concat_ws(".", entry, F.when(F.col("suffix") != "jp", F.col("suffix")), F.lit("jp"))
    return records(
        cut, name, year, F.concat(F.lit("jpnic register listing "), stamp), None,
        [("no_header_stamp", stamp == ""), ("out_of_window_edition", ~_in_window(year)), ("reserved_never_registered", F.contains("line", F.lit(JP_RESERVED))), ("abolished", F.contains("line", F.lit(JP_ABOLISHED)))],
    )


@page
def transcribed_registrations(df: DataFrame) -> DataFrame:
    """A bold name opens a record, which goes on to the next bold name; its text, free of tags, says when the name was made. A record that gives the
    day of registration in words is dated by it, else by the first of its dates of creation."""
    parts = F.transform(F.split("value", r"(?i)<b>"), lambda x: F.regexp_replace(x, r"^\s*(?:<[^>]*>\s*)*", ""))
    # Bold text that is no name belongs to the record before it.
    none = F.array().cast("array<struct<name:string,text:string>>")

    def step(acc: Column, x: Column) -> Column:
        name, last = _name_at(x), F.element_at(acc, -1)
        longer = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(last["name"].alias("name"), F.concat(last["text"], F.lit(" "), x).alias("text"))))
        return F.when(name != "", F.concat(acc, F.array(F.struct(name.alias("name"), x.alias("text"))))).when(F.size(acc) > 0, longer).otherwise(acc)

    cut = df.select("file_name", F.explode(F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), none, step)).alias("r"))
    text = F.lower(F.regexp_replace(_tagless(F.col("r.text"), " "), r"\s+", " "))
    worded = F.regexp_extract(text, rf"{CREATED_FIRST} ([a-z]{{3}})[a-z]* \d+, ?(\d{{4}})", 0)
    dashed = F.regexp_extract(text, rf"{CREATED_ELSE}.*? \d+-([a-z]{{3}})-(\d{{4}})", 0)
    year = F.right(F.when(worded != "", worded).otherwise(dashed), F.lit(4))
    month = F.when(worded != "", F.substring(worded, len(CREATED_FIRST) + 2, 3)).otherwise(F.split_part(dashed, F.lit("-"), F.lit(-2)))
    return records(
        cut, F.col("r.name"), year.try_cast("int"), F.concat(F.lit("edelman_whois_created:"), year), None,
        [("no_creation_date", year == ""), ("unparseable_month", ~month.isin(*MONTHS)), ("created_out_of_window", ~_in_window(year.try_cast("int")))],
    )


@page
def change_report(df: DataFrame) -> DataFrame:
    """New and deleted names, a row a line of tabbed cells; the last day written above a row dates it. Lines are read in page order in one fold."""
    start = F.struct(F.lit("").alias("year"), F.array().cast("array<struct<name:string,year:string>>").alias("rows"))
    day = rf"\d{{1,2}}\s+(?:{'|'.join(MONTHS)})[a-z]*\s+(\d{{4}})"

    def step(acc: Column, line: Column) -> Column:
        cells = F.split(line, r"\t+")
        name = F.when(F.get(cells, F.lit(0)).isin(*MY_ROWS) & (F.size(cells) == 2), _name_at(F.trim(F.get(cells, F.lit(1))), r"my(?=\s*\z)"))
        days = F.regexp_extract_all(line, F.lit(day), 1)
        year = F.when(F.size(days) > 0, F.element_at(days, -1)).otherwise(acc["year"])
        rows = F.when(F.coalesce(name, F.lit("")) != "", F.concat(acc["rows"], F.array(F.struct(name.alias("name"), acc["year"].alias("year"))))).otherwise(acc["rows"])
        return F.struct(year.alias("year"), rows.alias("rows"))

    low = F.lower("value")
    cut = df.withColumn("listing", low.contains(MY_TITLE)).withColumn("r", F.explode_outer(F.when(low.contains(MY_TITLE), F.aggregate(F.split(low, r"\r?\n"), start, step)["rows"])))
    cut = cut.where("not listing or r is not null")
    year = F.col("r.year").try_cast("int")
    return records(cut, F.col("r.name"), year, F.concat(F.lit("mynic:"), _stem(F.col("file_name"))), None, [("not_a_listing_page", ~F.col("listing")), ("row_before_any_day_heading", F.col("r.year") == ""), ("row_out_of_window", ~_in_window(year))])


@page
def deletion_queue(df: DataFrame) -> DataFrame:
    """Labels are printed in columns of 16 and cut to fit; one that fills its column may be cut and is refused."""
    named = F.split(F.when(F.endswith("file_name", F.lit(".html")), _stem(F.col("file_name"))), "-")
    stamp = F.coalesce(F.element_at(named, -1), F.lit(""))
    told = (F.size(named) == 3) & _nth(named, 1).isin(*QUEUES) & stamp.rlike(r"^\d{14}\z")
    queue = F.when(told, _nth(named, 1)).otherwise("")
    good = (queue != "") & _in_window(_year(stamp)) & F.lower("value").contains(QUEUE_TITLE)
    labels = F.transform(F.slice(F.split("value", QUEUE_LINK), F.lit(2), F.size(F.split("value", QUEUE_LINK))), lambda x: F.regexp_extract(x, r'^([^"&]*)', 1))
    cut = df.withColumn("good", good).withColumn("label", F.explode_outer(F.when(good, F.transform(labels, lambda x: F.lower(F.trim(x)))))).where("not good or label is not null")
    return records(
        cut, F.concat("label", F.lit(".co.za")), _year(stamp), F.concat(F.lit("coza:"), queue, F.lit(":"), stamp), None,
        [("not_a_coza_capture", queue == ""), ("capture_out_of_window", ~_in_window(_year(stamp))), ("not_a_queue_page", ~F.col("good")),
         ("label_malformed", ~F.col("label").rlike(r"^[a-z0-9][a-z0-9-]*\z")), ("label_possibly_truncated", F.length("label") >= QUEUE_WIDTH)],
    )


@page
def robot_blacklist(df: DataFrame) -> DataFrame:
    """A list carries the stamp of its compilation, a difference has its day in the file's name and gives its added lines only."""
    at = r"^squidguard-([a-z0-9-]+)-(domains|urls)(?:\.(\d{8})\.diff)?\z"
    category, kind, named = (F.regexp_extract("file_name", at, i) for i in (1, 2, 3))
    inside = F.replace(F.regexp_extract("value", r"compiled in [\d:]+ on (\d{4}\.\d{2}\.\d{2})", 1), F.lit("."), F.lit(""))
    stamp = F.when(named != "", named).otherwise(inside)
    good = (category != "") & (stamp != "") & _in_window(_year(stamp))
    cut = df.withColumn("good", good).withColumn("line", F.explode_outer(F.when(good, F.split(F.regexp_replace("value", r"\r?\n\z", ""), r"\r?\n"))))
    entry = F.trim("line")
    diff = named != ""
    name = F.when(diff, F.trim(F.expr("substr(trim(line), 2)"))).otherwise(entry)
    return records(
        cut, name, _year(stamp), F.concat(F.lit("squidguard:"), category, F.lit("/"), kind, F.lit("@"), stamp), None,
        [("not_a_blacklist_file", category == ""), ("no_compile_stamp", stamp == ""), ("out_of_window_edition", ~F.col("good")), ("comment_or_blank", (entry == "") | entry.startswith("#")),
         ("diff_removal_skipped", diff & entry.startswith("-")), ("diff_context_line", diff & ~entry.startswith("+")), ("comment_or_blank", name == "")],
    )


@page
def country_register(df: DataFrame) -> DataFrame:
    """(read with encoding ISO-8859-1) The names of a page under its own label; a row's date wins over the page's stamp."""
    named = F.split(F.when(F.lower("file_name").rlike(r"\.html?\z"), _stem(F.col("file_name"))), "-")  # cctld, registry, label, day
    told = (F.size(named) == 4) & (F.lower(_nth(named, 0)) == "cctld") & _nth(named, 2).rlike(r"^[A-Za-z]{2,3}\z") & _nth(named, 3).rlike(r"^\d{8}\z")
    told = F.coalesce(told, F.lit(False))
    registry, tld, stamp = (F.when(told, x).otherwise("") for x in (_nth(named, 1), F.lower(_nth(named, 2)), _nth(named, 3)))
    good = (stamp != "") & _in_window(_year(stamp))
    months = [*MONTHS, *LOCAL_MONTHS]
    flat = F.regexp_replace(_tagless(F.col("value"), "|"), r"\s+", " ")
    low = F.lower(flat)
    dated = F.regexp_extract_all(low, F.concat(F.lit(r"\|([a-z0-9][a-z0-9.\-]*\."), tld, F.lit(r"\|+\s*\|*\s*\d{2}-[a-z]{3}-\d{4})")), 1)
    dated = F.filter(dated, lambda x: F.regexp_extract(x, r"-([a-z]{3})-\d{4}\z", 1).isin(*months) & _in_window(F.right(x, F.lit(4)).try_cast("int")))
    rows = F.map_from_entries(F.array_distinct(F.transform(dated, lambda x: F.struct(F.split_part(x, F.lit("|"), F.lit(1)).alias("k"), F.lit(1)))))
    names = F.array_distinct(F.regexp_extract_all(low, F.concat(F.lit(r"([a-z0-9][a-z0-9.\-]*\."), tld, F.lit(r"\b)")), 1))
    cut = df.withColumn("good", good).withColumn("dated", F.when(good, dated)).withColumn("rows", F.when(good, rows)).withColumn("name", F.explode_outer(F.when(good, names))).where("not good or name is not null")
    own = F.element_at(F.filter("dated", lambda x: F.startswith(x, F.concat(F.col("name"), F.lit("|")))), -1)
    own = F.when(F.map_contains_key("rows", F.col("name")), F.right(own, F.lit(4)))
    mark = F.coalesce(own, stamp)
    return records(
        cut, F.col("name"), _year(mark), F.concat(F.lit("cctld_register:"), registry, F.lit("."), tld, F.lit("@"), mark), None,
        [("not_a_cctld_listing", stamp == ""), ("file_stamp_out_of_window", ~F.col("good"))],
    )


@page
def register_letters(df: DataFrame) -> DataFrame:
    """The date at the foot of a letter's page decides the whole page; names are read from the first bracket on, each once."""
    flat = F.regexp_replace(_tagless(F.col("value"), " "), r"\s+", " ")
    words = "|".join(IE_UPDATED)
    text = F.regexp_extract(flat, rf"(?i)(?:{words}) .{{0,80}}?(?:19|20)\d\d", 0)
    year = F.right(text, F.lit(4))
    page_of = F.split(F.lower(_stem(F.col("file_name"))), "_")
    letter = F.endswith(F.lower("file_name"), F.lit(".html")) & F.element_at(page_of, -1).rlike(r"^([a-z]|0-9)-doms\z")
    good = letter & _in_window(year.try_cast("int"))
    low = F.lower(flat)
    body = F.when(low.contains("["), F.expr("substr(lower(flat), locate('[', lower(flat)))")).otherwise(low)
    tokens = F.transform(F.split(body, r"[^a-z0-9.-]+"), lambda x: F.regexp_replace(x, r"^[.-]+|[.-]+\z", ""))
    own = [F.lit(x) for x in IE_OWN]
    found = F.transform(F.filter(tokens, lambda x: x.rlike(r"[a-z0-9]\.ie\z")), lambda x: F.when(F.endswith(x, own[0]) | F.endswith(x, own[1]), x).otherwise(F.concat(F.split_part(x, F.lit("."), F.lit(-2)), F.lit(".ie"))))
    cut = df.withColumn("flat", flat).withColumn("good", good).withColumn("name", F.explode_outer(F.when(good, F.array_distinct(found)))).where("not good or name is not null")
    return records(
        cut, F.col("name"), year.try_cast("int"), F.concat(F.lit("iedr register listing "), F.trim(text)), None,
        [("not_a_register_page", ~letter), ("no_footer_date", year == ""), ("out_of_window_page", ~F.col("good")), ("registry_own_host", F.endswith("name", own[0]) | F.endswith("name", own[1]))],
    )


def _changed(df: DataFrame, key: str) -> DataFrame:
    """An object's name and the last eight digits of each of its change lines: one record for each year. Only the date leaves a line."""
    name = F.trim(F.regexp_extract("value", r"^([^\n]*)", 1))
    named = name.rlike(r"^\S+\z") & ~F.col("value").rlike(r"^[#%]")
    reverse = F.upper(name).rlike(r"\.ARPA\.?\z")
    days = F.regexp_extract_all("value", F.lit(rf"(?m)^{key}.*?(\d{{8}})[ \t\r]*$"), 1)
    cut = df.where(named).withColumn("reverse", reverse).withColumn("day", F.explode_outer(F.when(~reverse, days))).where("reverse or day is not null")
    # The first line of a year stays, whatever the order of lines: the least date.
    keep = cut.groupBy("file_name", name.alias("name"), "reverse", F.left("day", F.lit(4)).alias("y")).agg(F.min("day").alias("day"))
    return records(keep, F.col("name"), F.col("y").try_cast("int"), F.concat(F.lit("ripe_changed:"), "day"), None, [("reverse_zone_skipped", F.col("reverse")), ("changed_out_of_window", ~_in_window(F.col("y").try_cast("int")))])


@block("*dn:")
def changed_short(df: DataFrame) -> DataFrame:
    return _changed(df, r"\*ch:")


@block("domain:")
def changed_long(df: DataFrame) -> DataFrame:
    return _changed(df, "changed:")


@block("Subdomain:")
def approval_notices(df: DataFrame) -> DataFrame:
    name = F.regexp_extract("value", r"^[ \t]*(\S+)[ \t\r]*(?:\n|\z)", 1)
    day = F.regexp_extract("value", r"(?m)^Date-Approved:\s*(\d{4}/\d{2}/\d{2})\s*$", 1)
    return records(
        df.where(name != ""), name, _year(day), F.concat(F.lit("ca_date_approved:"), F.replace(day, F.lit("/"), F.lit(""))), None,
        [("no_approval_date", day == ""), ("approved_out_of_window", ~_in_window(_year(day)))],
    )


@block("<record>")
def report_records(df: DataFrame) -> DataFrame:
    """Every address of a record, in the year of its date."""
    year = F.regexp_extract("value", r"<dc:date>(\d{4})</dc:date>", 1)
    ident = F.regexp_extract("value", r"<identifier>([^<]+)</identifier>", 1)
    cut = df.where(F.col("value").contains("</record>")).withColumn("url", _or_none(F.regexp_extract_all("value", F.lit(r"<dc:identifier>(https?://[^<]+)</dc:identifier>"), 1)))
    return records(cut, F.col("url"), year.try_cast("int"), F.coalesce(F.nullif(ident, F.lit("")), F.lit("scout")), None, [("no_date", year == ""), ("out_of_window", ~_in_window(year.try_cast("int"))), ("no_url", F.col("url").isNull())])


def _with_header(lines: DataFrame, found: dict[str, Column]) -> DataFrame:
    """lines with one value a file for each of found (the least non-null). The side has a row a file, as many as the driver lists."""
    test = None
    for c in found.values():
        test = c.isNotNull() if test is None else test | c.isNotNull()
    heads = lines.where(test).groupBy("file_name").agg(*[F.min(c).alias(k) for k, c in found.items()])
    return lines.join(heads, "file_name", "left")


@header
def zone_file(lines: DataFrame) -> DataFrame:
    """The start-of-authority record gives the zone and its serial; the owner of a name-server record, one label below it, is delegated."""
    p = _words(F.col("value"))
    soa = F.when(F.array_contains(F.slice(p, 2, 3), "SOA"), F.upper(F.rtrim(_nth(p, 0), F.lit("."))))
    serial = F.when(F.col("value").contains(";serial"), _nth(p, 0))
    df = _with_header(lines, {"apex": soa, "serial": serial})
    day = F.try_to_timestamp(F.left("serial", F.lit(8)), F.lit("yyyyMMdd"))  # a serial is a day and two more digits
    year = F.when(F.col("serial").rlike(r"^\d{10}\z") & F.year(day).between(1980, 1999), F.year(day))
    owner = F.upper(F.rtrim(_nth(p, 0), F.lit(".")))
    below = F.concat(F.lit("."), "apex")
    df = df.where((F.size(p) >= 3) & F.array_contains(F.slice(p, 2, 3), "NS"))
    label = F.left(owner, F.length(owner) - F.length(below))
    return records(
        df, F.lower(owner), year, F.concat(F.lit("internic "), F.lower("apex"), F.lit(" zone serial "), "serial"), None,
        [("no_soa_serial", F.col("apex").isNull() | year.isNull()), ("out_of_window_file", ~_in_window(year)), ("apex_delegation", owner == F.col("apex")), ("owner_outside_zone", ~F.endswith(owner, below)), ("deeper_than_one_label", label.contains("."))],
    )


@header
def database_snapshot(lines: DataFrame) -> DataFrame:
    """The stamp in the head dates all; of an object only its name is read."""
    stamp = F.nullif(F.regexp_extract("value", r"^#\s*(\d{6})\s+\d{2}:\d{2}:\d{2}\s*\z", 1), F.lit(""))
    df = _with_header(lines, {"stamp": stamp})
    yy = F.left("stamp", F.lit(2)).try_cast("int")
    year = yy + F.when(yy >= 90, 1900).otherwise(2000)
    name = F.regexp_extract("value", r"^\*dn:\s*(\S+)\s*\z", 1)
    return records(
        df, name, year, F.lit("ripe_dbase:19990804"), None,
        [("no_header_stamp", F.col("stamp").isNull()), ("stamp_out_of_window", ~_in_window(year)), ("attribute_discarded", name == ""), ("reverse_zone_skipped", F.upper(name).rlike(r"\.ARPA\.?\z"))],
    )


@header
def directory_dump(lines: DataFrame) -> DataFrame:
    """Every external address of a dump, dated by its stamp or else by its file's name."""
    stamp = F.nullif(F.regexp_extract("value", r"Generated at (\d{4}-\d{2}-\d{2})", 1), F.lit(""))
    df = _with_header(lines, {"stamp": stamp}).withColumn("url", F.explode(F.regexp_extract_all("value", F.lit(r'(?:r:resource|about)="(https?://[^"]+)"'), 1)))
    named = F.nullif(F.regexp_extract("file_name", r"(?:19|20)\d{2}", 0), F.lit(""))
    year = F.coalesce(F.left("stamp", F.lit(4)), named).try_cast("int")
    stem = F.regexp_replace("file_name", r"\.[^.]*\z", "")
    return records(df, F.col("url"), year, F.concat(F.lit("odp "), F.coalesce("stamp", stem)), None, [("no_year", year.isNull())])
