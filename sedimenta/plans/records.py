"""Queries that run the engine's own operators over records made from the tables: evidence, lines, assignment, pricing, checks, streams.

Orders stand for evidence rows of the customers' names, pages for captures and index lines.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions import delegation, names
from sedimenta.functions import evidence as ev
from sedimenta.operators import checks, export, ingest, pricing
from sedimenta.plans.pairs import table
from sedimenta.sources import formats
from sedimenta.streaming import ingest as streaming

QUERIES: dict = {}
SQL: dict = {}
CTE = r"""WITH capture AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(lower(url), '^([a-z][a-z0-9+.-]*:)?//', ''), '[/?#].*', ''), ':[0-9]*$', '') AS host, url,
  CAST(1995 + page_id % 8 AS VARCHAR) || '0203040506' AS stamp, page_id % 7 AS k FROM pages),
rows AS (SELECT page_id, host, k, CASE k WHEN 0 THEN 'ia_cdx_year_query' WHEN 1 THEN 'ia_cdx_year_query' WHEN 2 THEN 'ukwa_host_link_graph' WHEN 3 THEN 'bulk_cdx_file' WHEN 4 THEN 'nypw_timemap_non_200' WHEN 5 THEN 'unheard_of' END AS method FROM capture),
e AS (SELECT o_orderkey AS id, 'c' || o_custkey || CASE WHEN o_custkey % 5 = 0 THEN '.info' WHEN o_custkey % 5 = 1 THEN '.sucks' ELSE '.com' END AS domain, CAST(o_orderkey % 3 + 1 AS INT) AS source,
  CAST(year(o_orderdate) AS INT) AS y, o_orderpriority <> '5-LOW' AS master, o_orderpriority IN ('1-URGENT','2-HIGH') AS web, o_orderstatus = 'P' AS other FROM orders),
best AS (SELECT domain, y, arg_min(id, (NOT web, id)) AS id FROM e WHERE master AND NOT other GROUP BY domain, y),
ships AS (SELECT *, NOT (domain LIKE '%.info' OR domain LIKE '%.sucks') AS ok FROM best),
held AS (SELECT DISTINCT domain, y FROM e WHERE id % 4 = 0 AND y BETWEEN 1996 AND 2001)
"""


def query(sql: str | None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = CTE + sql
        return f

    return keep


def shared(spark: SparkSession) -> str:
    """The folder that all executors see; a temporary one only on a local master that names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return f"file://{tempfile.mkdtemp(prefix='sedimenta-')}"
    raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", "url", names.host(F.col("url")).alias("host"), (F.col("page_id") % 7).alias("k"))
    return p.withColumn("stamp", F.concat((F.col("page_id") % 8 + 1995).cast("string"), F.lit("0203040506")))


def capture_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a page in one of seven forms: good, in error, link graph, bare stamp, redirect, unknown method, none."""
    k, stamp, host = F.col("k"), F.col("stamp"), F.col("host")
    method = F.when(k <= 1, "ia_cdx_year_query").when(k == 2, "ukwa_host_link_graph").when(k == 3, "bulk_cdx_file").when(k == 4, "nypw_timemap_non_200").when(k == 5, "unheard_of")
    value = (
        F.when(k == 0, F.concat(F.lit("cdx capture "), stamp, F.lit(" "), host))
        .when(k == 1, F.concat(F.lit("cdx capture "), stamp, F.lit(" status 404 "), host))
        .when(k == 2, F.concat(F.lit("host_link_graph:"), F.left(stamp, F.lit(4)), F.lit(" "), host))
        .when(k == 3, stamp)
        .when(k == 4, F.concat(F.lit("nypw timemap capture status 302 "), stamp))
        .otherwise(F.concat(F.lit("listed as "), host))
    )
    url = F.concat(F.lit("https://web.archive.org/web/"), stamp, F.lit("/"), "url")
    return captures(spark, sf_dir).select("page_id", host.alias("domain"), method.alias("acquisition_method"), value.alias("evidence_value"), url.alias("evidence_url"))


def evidence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    n = F.col("o_custkey")
    domain = F.concat(F.lit("c"), n.cast("string"), F.when(n % 5 == 0, ".info").when(n % 5 == 1, ".sucks").otherwise(".com"))
    y = F.year("o_orderdate")
    stamp = F.concat(y.cast("string"), F.lit("0203040506"))
    host = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("w."), domain)).otherwise(domain)
    web = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return o.select(
        F.col("o_orderkey").alias("evidence_id"), domain.alias("domain"), (F.col("o_orderkey") % 3 + 1).cast("int").alias("source_id"), y.alias("evidence_year"),
        F.when(F.col("o_orderpriority") == "5-LOW", "link_target").otherwise("cdx_timestamp").alias("evidence_type"), F.concat(F.lit("cdx capture "), stamp, F.lit(" "), host).alias("evidence_value"),
        F.lit(None).cast("string").alias("evidence_url"), F.when(web, "ia_cdx_year_query").otherwise("unheard_of").alias("acquisition_method"),
        F.lit("orders").alias("source_file"), F.col("o_orderkey").cast("string").alias("record_location"),
    )


def held(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = evidence_rows(spark, sf_dir).where("evidence_id % 4 = 0 and evidence_year between 1996 and 2001")
    return e.select(F.col("domain").alias("name"), F.col("evidence_year").alias("year")).distinct()


def sources(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT * FROM VALUES (1, 'one'), (2, 'two'), (3, 'three'), (4, 'none') AS t(source_id, name)")


@query("SELECT page_id, k IN (0, 2, 3, 4) AS web, CASE WHEN k <= 4 THEN host END AS exact_host, CASE WHEN k = 2 THEN 'link graph' WHEN k IN (0, 1, 3, 4) THEN 'capture' END AS kind FROM rows")
def evidence_grammar(spark, sf_dir):
    e = capture_rows(spark, sf_dir).select("page_id", ev.parsed().alias("e"))
    return e.select("page_id", "e.web", F.col("e.host").alias("exact_host"), "e.kind")


@query(
    "SELECT page_id, y, tld IN ('com', 'net', 'org') OR (tld = 'info' AND y >= 2001) AS existed, tld IN ('com', 'net', 'org') AND NOT regexp_full_match(name, 'www\\.[^.]+') AS ships FROM (SELECT page_id, y, CASE WHEN page_id % 9 = 0 THEN 'a.info' ELSE host END AS name, string_split(CASE WHEN page_id % 9 = 0 THEN 'a.info' ELSE host END, '.')[-1] AS tld FROM capture, (SELECT unnest(range(1996, 2002)) AS y))"
)
def tld_calendar(spark, sf_dir):
    name = F.when(F.col("page_id") % 9 == 0, "a.info").otherwise(F.col("host"))
    p = captures(spark, sf_dir).select("page_id", name.alias("name"), F.explode(F.sequence(F.lit(1996), F.lit(2001))).alias("y"))
    return p.select("page_id", "y", delegation.existed(names.tld(F.col("name")), F.col("y")).alias("existed"), delegation.ships_domain(F.col("name"), F.col("y")).alias("ships"))


@query(
    "SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM (SELECT CASE WHEN page_id % 11 = 0 THEN 'header_lines' WHEN page_id % 13 = 0 THEN 'malformed' WHEN CAST(stamp[:4] AS INT) NOT BETWEEN 1996 AND 2001 THEN 'out_of_window' WHEN k = 6 THEN 'non_200' END AS reason FROM capture) GROUP BY 1"
)
def index_line_drops(spark, sf_dir):
    status = F.when(F.col("k") == 6, "404").otherwise("200")
    good = F.concat_ws(" ", F.lit("key"), "stamp", "url", F.lit("text/html"), status)
    line = F.when(F.col("page_id") % 11 == 0, " CDX N b a m s").when(F.col("page_id") % 13 == 0, "cut short").otherwise(good)
    lines = captures(spark, sf_dir).select(line.alias("value"), F.lit("pages").alias("file_name"))
    return formats.drop_counts(formats.early_web_cdx(lines))


@query("SELECT domain, y AS assigned_year, id AS evidence_id FROM best")
def assigned_years(spark, sf_dir):
    return ingest.assign_years(evidence_rows(spark, sf_dir))


@query("SELECT 'w.' || domain AS hostname, domain AS parent_domain, y AS assigned_year, arg_min(id, (NOT web, id)) AS evidence_id FROM e WHERE master AND other GROUP BY domain, y")
def assigned_hosts(spark, sf_dir):
    return ingest.assign_hosts(evidence_rows(spark, sf_dir))


@query(
    "SELECT id AS evidence_id FROM (SELECT n.*, row_number() OVER (PARTITION BY source, master, web, domain, other, y ORDER BY id) AS r FROM (SELECT * FROM e WHERE id % 2 = 0) n) n WHERE r = 1 AND NOT EXISTS (SELECT 1 FROM e h WHERE h.id % 2 = 1 AND h.source = n.source AND h.master = n.master AND h.web = n.web AND h.domain = n.domain AND h.other = n.other AND h.y = n.y)"
)
def class_needs(spark, sf_dir):
    e = evidence_rows(spark, sf_dir).withColumn("record_location", F.lpad("record_location", 20, "0"))
    return ingest.class_skip(e.where("evidence_id % 2 = 0"), e.where("evidence_id % 2 = 1")).select("evidence_id")


@query("SELECT s.domain AS name, s.y AS year, s.id AS evidence_id FROM ships s JOIN e USING (id) ANTI JOIN held h ON h.domain = s.domain AND h.y = s.y WHERE ok AND web")
def shipped_net_new(spark, sf_dir):
    e = evidence_rows(spark, sf_dir)
    return export.net_new(export.claims(ingest.assign_years(e), e, "domain"), held(spark, sf_dir)).select("name", "year", "evidence_id")


@query(
    "SELECT v.name, (SELECT count(*) FROM e WHERE source = v.i) AS evidence_rows, (SELECT count(DISTINCT domain) FROM e WHERE source = v.i) AS names, (SELECT count(*) FROM (SELECT min(source) AS a, max(source) AS b FROM e GROUP BY domain, y) WHERE a = b AND a = v.i) AS pairs_alone, (SELECT count(*) FROM best JOIN e USING (id) WHERE source = v.i) AS assigned, (SELECT count(*) FROM ships JOIN e USING (id) WHERE ok AND source = v.i) AS shipped FROM (VALUES (1, 'one'), (2, 'two'), (3, 'three'), (4, 'none')) v(i, name)"
)
def contribution_by_source(spark, sf_dir):
    e = evidence_rows(spark, sf_dir)
    years = ingest.assign_years(e)
    out = years.where(delegation.in_window_set(F.col("domain")))
    return export.contribution(e, years, out, sources(spark)).drop("source_id")


@query(
    "SELECT y AS year, count(*) FILTER (WHERE b) AS base, count(*) FILTER (WHERE s) AS submitted, count(*) FILTER (WHERE b AND s) AS overlap, count(*) AS merged, count(*) FILTER (WHERE NOT b) AS accepted FROM (SELECT domain, y, bool_or(b) AS b, bool_or(s) AS s FROM (SELECT domain, y, true AS b, false AS s FROM held UNION ALL SELECT domain, y, false, true FROM best) GROUP BY ALL) GROUP BY y"
)
def merge_audit_by_year(spark, sf_dir):
    ours = ingest.assign_years(evidence_rows(spark, sf_dir)).select(F.col("domain").alias("name"), F.col("assigned_year").alias("year"))
    return export.merge_audit(held(spark, sf_dir), ours)


@query(
    "SELECT 'annual' AS track, 'core' AS part, y AS year, 'com' AS tld, count(*) AS n, CAST(count(*) * 0.5 AS DOUBLE) AS value FROM (SELECT DISTINCT domain, y FROM e WHERE domain LIKE '%.com' AND y BETWEEN 1996 AND 2001) d ANTI JOIN held h ON h.domain = d.domain AND h.y = d.y GROUP BY y"
)
def priced_items(spark, sf_dir):
    e = evidence_rows(spark, sf_dir)
    items = e.select(F.col("evidence_id").alias("item"), F.concat(F.lit("http://"), "domain", F.lit("/")).alias("host"), F.col("evidence_year").alias("year"), F.lit("200").alias("status"), F.lit(False).alias("free"))
    records = pricing.distinct_records(pricing.priced_items(items).where("drop is null"))
    flags = pricing.leftovers(records, held(spark, sf_dir), spark.createDataFrame([], "name string"), held(spark, sf_dir))
    return pricing.tally(flags, spark.sql("SELECT 'com' AS tld, CAST(0.5 AS DECIMAL(12,8)) AS weight")).withColumn("value", F.col("value").cast("double"))


DEFECTS = """, dy AS (SELECT domain, y, id FROM best UNION ALL SELECT domain, y, id FROM best WHERE id % 50 = 0 UNION ALL SELECT domain, y + 20, id FROM best WHERE id % 60 = 1 UNION ALL SELECT domain || '.xn--p1ai', y, id FROM best WHERE id % 70 = 2 UNION ALL SELECT domain, y, -id FROM best WHERE id % 80 = 3),
ev AS (SELECT * FROM e UNION ALL SELECT * FROM e WHERE id % 90 = 4), d AS (SELECT dy.*, e.domain AS edomain, e.y AS ey, e.master FROM dy LEFT JOIN e USING (id))
"""


@query(
    DEFECTS
    + """SELECT 'assigned_year_in_window' AS name, count(*) AS offending FROM dy WHERE y NOT BETWEEN 1996 AND 2001
UNION ALL SELECT 'within_year_unique', count(*) FROM (SELECT 1 FROM dy GROUP BY domain, y HAVING count(*) > 1)
UNION ALL SELECT 'evidence_wall_intact', count(*) FROM d WHERE edomain IS NULL OR edomain <> domain OR ey <> y
UNION ALL SELECT 'no_idn_tld_in_window', count(*) FROM dy WHERE domain LIKE '%.xn--p1ai'
UNION ALL SELECT 'evidence_id_unique', count(*) - count(DISTINCT id) FROM ev"""
)
def store_checks(spark, sf_dir):
    """Checks over years and evidence with planted defects: repeats, years beyond the window, names of later alphabets, rows that rest on nothing."""
    e = evidence_rows(spark, sf_dir)
    years, i = ingest.assign_years(e), F.col("evidence_id")
    bad = (
        years.union(years.where(i % 50 == 0)).union(years.where(i % 60 == 1).withColumn("assigned_year", F.col("assigned_year") + 20))
        .union(years.where(i % 70 == 2).withColumn("domain", F.concat("domain", F.lit(".xn--p1ai")))).union(years.where(i % 80 == 3).withColumn("evidence_id", -i))
    )
    names_of = ["assigned_year_in_window", "within_year_unique", "evidence_wall_intact", "no_idn_tld_in_window", "evidence_id_unique"]
    return checks.report({"evidence": e.union(e.where(i % 90 == 4)), "domain_year": bad}).where(F.col("name").isin(*names_of))


@query("SELECT doc_id, md5('7' || doc_id) AS rank FROM documents ORDER BY rank, doc_id LIMIT 25")
def seeded_sample(spark, sf_dir):
    """A sample without replacement that a seed fixes, whatever the partitions."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.concat(F.lit("7"), F.col("doc_id").cast("string"))).alias("rank"))
    return d.orderBy("rank", "doc_id").limit(25)


@query("SELECT round(regr_slope(ln(n), ln(k)), 9) AS slope, round(exp(regr_intercept(ln(n), ln(k))), 6) AS scale FROM (SELECT k, count(*)::DOUBLE AS n FROM (SELECT count(*)::DOUBLE AS k FROM orders GROUP BY o_custkey) GROUP BY k)")
def power_law_slope(spark, sf_dir):
    """Orders a customer, fitted as n = scale * k ** slope on the logs."""
    k = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").cast("double").alias("k")).groupBy("k").agg(F.count("*").cast("double").alias("n"))
    x, y = F.ln("k"), F.ln("n")
    return k.agg(F.round(F.regr_slope(y, x), 9).alias("slope"), F.round(F.exp(F.regr_intercept(y, x)), 6).alias("scale"))


@query("SELECT event_id, user_id, event_type FROM events")
def incremental_dedupe(spark, sf_dir):
    """The events as a stream, read to its end, each event once."""
    at = f"{shared(spark)}/events-{uuid.uuid4().hex[:12]}"
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).select("event_id", "user_id", "event_type", "ts")
    streaming.once_by_key(events, "event_id", "ts", f"{at}/rows", f"{at}/checkpoint").awaitTermination()
    return spark.read.schema("event_id long, user_id long, event_type string").parquet(f"{at}/rows/*")
