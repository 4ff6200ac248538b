"""Queries over host-grain lanes, claim filters, reviews, the queue and small statistics; lines and rows are made from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.functions import names, statistics
from sedimenta.operators import claims, hosts, queue
from sedimenta.plans.pairs import table
from sedimenta.plans.records import CTE, captures, evidence_rows, held

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = CTE + sql
        return f

    return keep


ENDINGS = "com net org edu gov mil int info biz co.uk ac.uk uk co.jp ne.jp jp com.au com.br br ru pl ch at or.at de fr co.nz geek.nz co.za com.mx gob.mx co.il com.sg com.tw com.hk se nl x.fj sucks yu co.yu".split()
LISTED = ", ".join(f"'{x}'" for x in ENDINGS)


@query(
    f"SELECT c_custkey AS id, CASE WHEN s <> 'sucks' THEN 'c' || c_custkey || '.' || s END AS registrable, CASE WHEN s = 'sucks' THEN 'no known suffix' END AS refused FROM (SELECT c_custkey, [{LISTED}][1 + CAST(c_custkey % {len(ENDINGS)} AS INT)] AS s FROM customer)"
)
def registrable_by_suffix(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    ending = F.element_at(F.array(*[F.lit(x) for x in ENDINGS]), (1 + F.col("id") % len(ENDINGS)).cast("int"))
    h = F.concat(F.lit("c"), F.col("id").cast("string"), F.lit("."), ending)
    k = F.col("id") % 5
    raw = F.when(k == 0, F.concat(F.lit("http://u@"), h, F.lit(":80/p?q#f"))).when(k == 1, F.concat(F.lit("//"), h, F.lit("."))).when(k == 2, F.concat(F.lit("%77ww."), h)).when(k == 3, F.concat(F.lit(" "), F.upper(h), F.lit(" "))).otherwise(h)
    return names.reduced(c.withColumn("host", names.host(raw)), "host").select("id", "registrable", "refused")


@query(
    "SELECT reason, count(*) AS n FROM (SELECT [NULL, 'empty', 'ip address', 'reverse dns', 'bad label', 'bare suffix', 'no known suffix', 'bad registered label'][1 + CAST(c_custkey % 8 AS INT)] AS reason FROM customer) GROUP BY reason"
)
def refusals_by_reason(spark, sf_dir):
    forms = ["good.com", " ,. ", "http://10.1.2.3/x", "4.3.2.1.in-addr.arpa", "-bad-.com", "co.uk", "a.sucks", "_a.com"]
    c = table(spark, sf_dir, "customer").select(F.element_at(F.array(*[F.lit(x) for x in forms]), (1 + F.col("c_custkey") % 8).cast("int")).alias("raw"))
    return names.reduced(c.withColumn("host", names.host(F.col("raw"))), "host").groupBy(F.col("refused").alias("reason")).agg(F.count("*").alias("n"))


def journal(spark, sf_dir):
    """Lines of journals: pages as captures; some broken, without status, in error or out of the window; the file by page."""
    p, k = captures(spark, sf_dir), F.col("page_id") % 17
    status = F.when(k == 3, "404").when(k == 4, "abc").otherwise("200")
    body = F.when(k == 5, F.to_json(F.struct("url", F.col("stamp").alias("timestamp")))).otherwise(F.to_json(F.struct("url", F.col("stamp").alias("timestamp"), status.alias("status"))))
    line = F.when(k == 1, F.lit('{"url": "cut')).when(k == 2, F.lit("  ")).when(k == 6, F.to_json(F.struct(F.lit("http://10.1.2.3/").alias("url"), F.col("stamp").alias("timestamp"), status.alias("status")))).otherwise(body)
    name = F.when(k == 5, "sweep_a.jsonl").when(F.col("page_id") % 2 == 0, "cdx_gap_a.jsonl").otherwise("arquivo_b.jsonl")
    return p.select("page_id", line.alias("value"), name.alias("file_name"))


JOURNAL = """, j AS (SELECT *, page_id % 17 AS m, CAST(stamp[:4] AS INT) AS y FROM capture),
screened AS (SELECT *, CASE WHEN m = 1 THEN 'unparseable' WHEN m = 4 THEN 'bad_status' WHEN y NOT BETWEEN 1996 AND 2001 THEN 'out_of_window' WHEN m = 6 THEN 'no_host' END AS reason FROM j WHERE m <> 2)
"""


@query(JOURNAL + "SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM screened GROUP BY 1")
def journal_drops(spark, sf_dir):
    got = hosts.capture_lines(journal(spark, sf_dir).drop("page_id"))
    return got.groupBy(F.coalesce("drop", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query(
    JOURNAL
    + "SELECT host, y AS year, 'cdx capture ' || arg_min(stamp, (m = 3, stamp)) || CASE WHEN bool_and(m = 3) THEN ' status 404' ELSE '' END || ' ' || host AS evidence_value, bool_and(m = 3) AS error FROM screened WHERE reason IS NULL GROUP BY host, y"
)
def journal_fold(spark, sf_dir):
    return hosts.folded(hosts.capture_lines(journal(spark, sf_dir).drop("page_id"))).select("host", "year", "evidence_value", "error")


@query(
    JOURNAL
    + "SELECT CASE WHEN m = 5 THEN 'ia_cdx_domain_sweep' WHEN page_id % 2 = 0 THEN 'ia_cdx_gap_hostgrain' ELSE 'arquivo_ia_cdxj_hostgrain' END AS method, count(*) AS n FROM j GROUP BY 1"
)
def journal_dispatch(spark, sf_dir):
    j = journal(spark, sf_dir)
    return j.groupBy(hosts.dispatch(F.col("file_name"))["method"].alias("method")).agg(F.count("*").alias("n"))


@query("SELECT 'early_web_a.jsonl' AS file_name, count(*) AS lines, count(*) FILTER (WHERE page_id % 17 NOT IN (1, 2, 5)) AS with_status, 0 AS folded FROM capture")
def status_policy(spark, sf_dir):
    """A family whose rows must carry a status is refused whole, once one has none."""
    lines = journal(spark, sf_dir).select("value", F.lit("early_web_a.jsonl").alias("file_name"))
    got = hosts.capture_lines(lines)
    folded = hosts.folded(got).agg(F.count("*").cast("int").alias("folded"))
    counts = lines.groupBy("file_name").agg(F.count("*").alias("lines"), F.count_if(F.col("value").contains('"status"')).alias("with_status"))
    return counts.join(folded, F.lit(True))


@query("SELECT count(*) AS n, min(page_id) AS least FROM capture WHERE page_id % 17 NOT IN (1, 2, 6) AND host IN (SELECT host FROM capture WHERE page_id % 10 = 0)")
def restricted_reread(spark, sf_dir):
    only = captures(spark, sf_dir).where("page_id % 10 = 0").select("host")
    return hosts.reread(journal(spark, sf_dir), only).agg(F.count("*").alias("n"), F.min("page_id").alias("least"))


EXTENDED = JOURNAL + """, x AS (SELECT *, y + 7 AS ey, CAST(y + 7 AS VARCHAR) || '0203040506' AS es FROM j),
xs AS (SELECT *, CASE WHEN m = 2 THEN 'blank' WHEN m = 1 THEN 'unparseable' WHEN m = 4 THEN 'bad_status' WHEN m = 3 THEN 'error_status' WHEN ey NOT BETWEEN 2003 AND 2007 THEN 'outside_window' WHEN m = 6 THEN 'invalid_host' END AS reason FROM x)
"""


def extended_lines(spark, sf_dir):
    return journal(spark, sf_dir).withColumn("value", F.regexp_replace("value", r'"timestamp":"([0-9]{4})', '"timestamp":"Y$1')).join(
        captures(spark, sf_dir).select("page_id", (F.left("stamp", F.lit(4)).cast("int") + 7).cast("string").alias("ey")), "page_id"
    ).select(F.regexp_replace("value", F.lit(r'Y[0-9]{4}'), F.col("ey")).alias("value"))


@query(EXTENDED + "SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM xs GROUP BY 1")
def extended_screen(spark, sf_dir):
    got = hosts.extended_screen(extended_lines(spark, sf_dir), 2003, 2007)
    return got.groupBy(F.coalesce("drop", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query(
    EXTENDED
    + ", f AS (SELECT DISTINCT host, ey FROM xs WHERE reason IS NULL), h AS (SELECT DISTINCT host, ey FROM x WHERE page_id % 3 = 0) SELECT year, base, added, CASE WHEN base > 0 THEN round(100.0 * added / base, 4) END AS growth FROM (SELECT coalesce(a.ey, b.ey) AS year, coalesce(base, 0) AS base, coalesce(added, 0) AS added FROM (SELECT ey, count(*) AS base FROM h GROUP BY ey) b FULL JOIN (SELECT ey, count(*) AS added FROM f ANTI JOIN h ON f.host = h.host AND f.ey = h.ey GROUP BY ey) a ON a.ey = b.ey)"
)
def extended_export(spark, sf_dir):
    firsts = hosts.extended_firsts(hosts.extended_screen(extended_lines(spark, sf_dir), 2003, 2007))
    base = captures(spark, sf_dir).where("page_id % 3 = 0").select(F.col("host").alias("name"), (F.left("stamp", F.lit(4)).cast("int") + 7).alias("year")).distinct()
    return hosts.extended_export(firsts, base).withColumn("growth", F.col("growth").cast("double"))


def order_hosts(spark, sf_dir):
    """(id, y, host, parent): a host below the customer's name for two orders of three."""
    o = table(spark, sf_dir, "orders")
    parent = F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit(".com"))
    host = F.when(F.col("o_orderkey") % 3 == 0, parent).otherwise(F.concat(F.lit("h"), (F.col("o_orderkey") % 4).cast("string"), F.lit("."), parent))
    return o.select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("y"), host.alias("host"), parent.alias("parent"))


HOSTS = ", oh AS (SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INT) AS y, 'c' || o_custkey || '.com' AS parent, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'h' || (o_orderkey % 4) || '.' END || 'c' || o_custkey || '.com' AS host FROM orders)\n"


@query(HOSTS + "SELECT host, parent, y AS year, lpad(CAST(min(id) AS VARCHAR), 12, '0') AS item FROM oh WHERE y BETWEEN 1996 AND 2001 AND host <> parent GROUP BY ALL")
def item_family_hosts(spark, sf_dir):
    o = order_hosts(spark, sf_dir)
    row = F.to_json(F.struct(F.lpad(F.col("id").cast("string"), 12, "0").alias("item"), F.col("y").alias("year"), F.concat_ws(" ", F.upper("host"), F.lit("not_a_host"), "parent").alias("text")))
    return hosts.family_hosts(o.select(row.alias("value"), F.lit("f").alias("file_name")), F.concat(F.lit("item "), "item")).select("host", "parent", "year", "item")


@query(HOSTS + "SELECT host, parent, y AS year, y || '-07' AS evidence_value, count(*) AS lines FROM oh WHERE y BETWEEN 1996 AND 2001 AND host <> parent GROUP BY ALL")
def survey_hosts(spark, sf_dir):
    o = order_hosts(spark, sf_dir)
    lines = o.select(F.concat(F.lit("10.0.0.1 "), F.upper("host"), F.lit(".")).alias("value"), F.concat(F.lit("survey"), F.right(F.col("y").cast("string"), F.lit(2)), F.lit("07.txt")).alias("file_name"))
    return hosts.survey_hosts(lines)


@query(
    HOSTS
    + ", dated AS (SELECT DISTINCT parent, y FROM oh WHERE id % 7 = 0) SELECT o.host, o.parent, o.y AS year, 'list:' || o.y || '0102 ' || o.host AS evidence_value, bool_or(d.parent IS NOT NULL) AS corroborated FROM oh o LEFT JOIN dated d ON d.parent = o.parent AND d.y = o.y WHERE o.y BETWEEN 1996 AND 2001 AND o.host <> o.parent AND o.id % 5 <> 0 GROUP BY ALL"
)
def blocklist_hosts(spark, sf_dir):
    o = order_hosts(spark, sf_dir)
    sign = F.when(F.col("id") % 5 == 0, "-").otherwise("+")
    lines = o.select(F.concat(sign, "host").alias("value"), F.concat(F.lit("list-"), F.col("y").cast("string"), F.lit("0102.diff")).alias("file_name"))
    dated = o.where("id % 7 = 0").select(F.col("parent").alias("name"), F.col("y").alias("year"))
    return hosts.blocklist_hosts(lines, "list", dated)


@query(HOSTS + "SELECT DISTINCT host, parent, 1999 AS year, 'zone ' || host AS evidence_value FROM oh WHERE host <> parent AND id % 2 = 0")
def zone_targets(spark, sf_dir):
    kind = F.when(F.col("id") % 2 == 0, " 3600 IN NS ").otherwise(" IN A ")
    return hosts.zone_targets(order_hosts(spark, sf_dir).select(F.concat(F.lit("x.org."), kind, F.upper("host"), F.lit(".")).alias("value")), 1999, "zone")


@query(
    HOSTS
    + ", obj AS (SELECT parent, max(y) AS y FROM oh GROUP BY parent), g AS (SELECT o.host, o.parent, obj.y FROM oh o JOIN obj USING (parent) WHERE o.host <> o.parent AND obj.y BETWEEN 1996 AND 2001) SELECT DISTINCT host, parent, y AS year, 'changed ' || y || '0203 ' || host AS evidence_value FROM g"
)
def object_hosts(spark, sf_dir):
    o = order_hosts(spark, sf_dir)
    line = F.explode(F.array(F.concat(F.lit("nserver: "), "host"), F.concat(F.lit("changed: a@b.c "), F.col("y").cast("string"), F.lit("0203"))))
    return hosts.object_hosts(o.select(F.col("parent").alias("object"), line.alias("value")))


@query(
    HOSTS
    + "SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM (SELECT CASE WHEN id % 11 = 0 THEN 'bad_field' WHEN id % 13 = 0 THEN 'bad_position' WHEN y NOT BETWEEN 1996 AND 2001 THEN 'out_of_window' WHEN id % 17 = 0 THEN 'bad_host' WHEN id % 19 = 0 THEN 'doubled_suffix' END AS reason, host, y, id, row_number() OVER (PARTITION BY host, y, id % 11 = 0 OR id % 13 = 0 OR y NOT BETWEEN 1996 AND 2001 OR id % 17 = 0 OR id % 19 = 0 ORDER BY id) AS r FROM oh) WHERE reason IS NOT NULL OR r = 1 GROUP BY 1"
)
def staged_messages(spark, sf_dir):
    o, i = order_hosts(spark, sf_dir), F.col("id")
    host = F.when(i % 17 == 0, "not a host").when(i % 19 == 0, F.concat(F.col("host"), F.lit(".com"))).otherwise(F.col("host"))
    row = F.to_json(F.struct(host.alias("host"), F.col("y").alias("year"), F.lit("f").alias("file"), F.when(i % 13 == 0, "x").otherwise(i.cast("string")).alias("pos"), F.when(i % 11 == 0, "other").otherwise("from").alias("field")))
    got = hosts.staged_messages(o.select(row.alias("value"), F.lit("f").alias("file_name")))
    return got.groupBy(F.coalesce("drop", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query(HOSTS + "SELECT DISTINCT host AS name, y AS year FROM oh WHERE host <> parent")
def seed_hosts(spark, sf_dir):
    return hosts.seeds(order_hosts(spark, sf_dir).select(F.concat(F.lit("http://"), "host", F.lit("/")).alias("raw"), F.col("y").alias("year")))


@query("SELECT c_custkey AS id, c_custkey % 4 < 3 AS lease FROM customer")
def lease_names(spark, sf_dir):
    i = F.col("c_custkey").cast("string")
    host = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("ppp"), i, F.lit(".isp.net"))).when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("10-1-2-"), (F.col("c_custkey") % 200).cast("string"), F.lit(".isp.net"))).when(F.col("c_custkey") % 4 == 2, F.concat(F.lpad(F.lower(F.hex("c_custkey")), 8, "0"), F.lit(".isp.net"))).otherwise("gateway.isp.net")
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), hosts.ephemeral(host).alias("lease"))


def sources(spark):
    return spark.sql("SELECT * FROM VALUES (1, 'one'), (2, 'usenet_body_url_hostnames'), (3, 'msg_a__from') AS t(source_id, name)")


@query("SELECT domain FROM e GROUP BY domain HAVING bool_and(source = 2)")
def body_only_domains(spark, sf_dir):
    return claims.body_only(evidence_rows(spark, sf_dir), sources(spark))


@query(
    ", nm AS (SELECT id, source, CASE WHEN id % 6 = 0 THEN 'alskdjfh.com' ELSE domain END AS name, y FROM e), sec AS (SELECT DISTINCT name FROM nm WHERE source <> 2 AND id % 2 = 0) SELECT id AS evidence_id, name, y AS year FROM nm WHERE NOT (source = 3 AND name = 'alskdjfh.com') AND (source <> 2 OR name IN (SELECT name FROM sec))"
)
def claims_filtered(spark, sf_dir):
    e = evidence_rows(spark, sf_dir)
    named = e.select(F.when(F.col("evidence_id") % 6 == 0, "alskdjfh.com").otherwise(F.col("domain")).alias("name"), F.col("evidence_year").alias("year"), "evidence_id")
    seconds = named.where("evidence_id % 2 = 0").select(F.col("name").alias("hostname"), "evidence_id")
    return claims.claimable(named, e, sources(spark), seconds).select("evidence_id", "name", "year")


UNUSABLE = [("nodomain.com", 1999, "s", "k", "f", True), ("nospamx.edu", 2000, "s", "mail or news From or Message-ID host", "f", True), ("a.gmane.org", 1999, "msg_gmane_lists_x", "k", "f", True), ("1stnet.co", 1999, "s", "k", "f", True), ("rapina.br", 1999, "s", "k", "f", True), ("nhs.uk", 1999, "s", "k", "f", False), ("a.com", None, "s", "k", "", True), ("nodomain.com", None, "s", "k", "f", False), ("a.com.co", 2001, "s", "k", "f", False), ("rapina.br", 2002, "s", "k", "f", False)]


@query(f"SELECT o_orderkey AS id, [{', '.join(str(r[5]).lower() for r in UNUSABLE)}][1 + CAST(o_orderkey % 10 AS INT)] AS unusable FROM orders")
def unusable_candidates(spark, sf_dir):
    def pick(k, kind):
        return F.element_at(F.array(*[F.lit(r[k]).cast(kind) for r in UNUSABLE]), (1 + F.col("o_orderkey") % 10).cast("int"))

    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), pick(0, "string").alias("name"), pick(1, "int").alias("year"), pick(2, "string").alias("source"), pick(3, "string").alias("kind"), pick(4, "string").alias("file"))
    return o.select("id", claims.unusable(F.col("name"), F.col("year"), F.col("source"), F.col("kind"), F.col("file")).alias("unusable"))


@query("SELECT c_custkey AS id, ['case, trailing dot or separator punctuation', 'www prefix removed', 'subdomain collapsed to registered domain', 'url parts or encoding normalized'][1 + CAST(c_custkey % 4 AS INT)] AS reason FROM customer")
def change_reasons(spark, sf_dir):
    n, k = F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit(".com")), F.col("c_custkey") % 4
    raw = F.when(k == 0, F.concat(F.lit(" "), F.upper(n), F.lit("."))).when(k == 1, F.concat(F.lit("www."), n)).when(k == 2, F.concat(F.lit("a.b."), n)).otherwise(F.concat(F.lit("http://"), n, F.lit("/")))
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), names.change_reason(raw, n).alias("reason"))


@query("SELECT s_suppkey AS id, s_suppkey % 4 < 3 AS moderated, ['whois_creation', 'artifact_listing', '', 'ia_cdx_year_query'][1 + CAST(s_suppkey % 4 AS INT)] AS head, s_suppkey % 4 <> 2 AS no_split FROM supplier")
def groups_and_classes(spark, sf_dir):
    def pick(*values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (1 + F.col("s_suppkey") % 4).cast("int"))

    group, kind = pick("news.announce.conferences", "comp.moderated", "comp.internet.net-happenings", "alt.test"), pick("whois_creation (x)", "Artifact_Listing, by hand", "(none)", "ia_cdx_year_query")
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), claims.moderated(group).alias("moderated"), claims.class_head(kind).alias("head"), claims.takes_no_split(kind).alias("no_split"))


@query(
    "SELECT value, reason, count(*) AS n FROM (SELECT ['http://a.b.com/', 'b.com', '9_8.in-addr.arpa', 'bad_host.com', 'x.sucks'][1 + CAST(c_custkey % 5 AS INT)] AS value, [NULL, 'is_registrable', 'reverse_dns', 'not_rfc1123', 'no_public_suffix'][1 + CAST(c_custkey % 5 AS INT)] AS reason FROM customer) WHERE reason IS NOT NULL GROUP BY ALL"
)
def unparsed_values(spark, sf_dir):
    values = ["http://a.b.com/", "b.com", "9_8.in-addr.arpa", "bad_host.com", "x.sucks"]
    c = table(spark, sf_dir, "customer").select(F.element_at(F.array(*[F.lit(v) for v in values]), (1 + F.col("c_custkey") % 5).cast("int")).alias("v"))
    return claims.unparsed_pool(c, "v")


@query(
    "SELECT reason, raw, array_to_string(list_sort(list(DISTINCT file)), ',') AS files, count(DISTINCT raw) OVER (PARTITION BY reason) AS entries FROM (SELECT 'ip address' AS reason, '10.0.0.' || (c_custkey % 100) AS raw, (1996 + c_nationkey % 3) || '.txt' AS file FROM customer WHERE c_custkey % 2 = 0) GROUP BY reason, raw"
)
def grouped_droplist(spark, sf_dir):
    c = F.col("c_custkey")
    raw = F.when(c % 2 == 0, F.concat(F.lit("10.0.0."), (c % 100).cast("string"))).otherwise("good.com")
    lines = table(spark, sf_dir, "customer").select(raw.alias("value"), F.concat((1996 + F.col("c_nationkey") % 3).cast("string"), F.lit(".txt")).alias("file_name"))
    return claims.droplist(lines).withColumn("files", F.array_join("files", ","))


@query(
    "SELECT name, CASE WHEN name IN (SELECT domain FROM held) THEN 'confirmed_baseline' WHEN name IN (SELECT domain FROM best) THEN 'confirmed_own' WHEN name IN (SELECT domain FROM e) THEN 'candidate' ELSE 'new' END AS state FROM (SELECT DISTINCT 'c' || c_custkey || CASE WHEN c_custkey % 5 = 0 THEN '.info' WHEN c_custkey % 5 = 1 THEN '.sucks' ELSE '.com' END AS name FROM customer)"
)
def seed_states(spark, sf_dir):
    from sedimenta.operators import ingest

    n = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), n.cast("string"), F.when(n % 5 == 0, ".info").when(n % 5 == 1, ".sucks").otherwise(".com")).alias("name"))
    e = evidence_rows(spark, sf_dir)
    return claims.seed_states(c, ingest.assign_years(e).select(F.col("domain").alias("name")), held(spark, sf_dir), e.select(F.col("domain").alias("name")))


@query(
    ", r AS (SELECT page_id, host, CAST(1996 + page_id % 3 AS VARCHAR) || '020304' || lpad(CAST(page_id % 60 AS VARCHAR), 2, '0') || '00' AS ts, CASE WHEN page_id % 3 = 0 THEN '404' WHEN page_id % 7 = 0 THEN '503' ELSE '200' END AS st FROM capture), per AS (SELECT host, ts, min(st) FILTER (WHERE st > '400') AS st, bool_or(st = '200') AS good FROM r GROUP BY host, ts) SELECT b.host, b.ts AS stamp, b.st AS status, (SELECT min(g.ts) FROM per g WHERE g.good AND g.host = b.host AND g.ts[:4] = b.ts[:4]) AS good_stamp FROM per b WHERE b.st IS NOT NULL AND NOT b.good"
)
def error_audit(spark, sf_dir):
    p, i = captures(spark, sf_dir), F.col("page_id")
    ts = F.concat((1996 + i % 3).cast("string"), F.lit("020304"), F.lpad((i % 60).cast("string"), 2, "0"), F.lit("00"))
    status = F.when(i % 3 == 0, "404").when(i % 7 == 0, "503").otherwise("200")
    line = F.concat_ws(" ", F.lit("key"), ts, "url", F.lit("text/html"), status)
    return claims.error_audit(claims.index_rows(p.select(line.alias("value")), 1, 2, 4))


@query(
    ", s AS (SELECT DISTINCT 'w.' || domain AS hostname, y AS year FROM e WHERE other AND source = 2 AND domain LIKE '%.com') SELECT * FROM s WHERE hostname NOT IN (SELECT 'w.' || domain FROM held) AND hostname NOT IN (SELECT 'w.' || domain FROM best)"
)
def survey_reduction(spark, sf_dir):
    from sedimenta.operators import ingest

    e = evidence_rows(spark, sf_dir)
    theirs = held(spark, sf_dir).select(F.concat(F.lit("w."), "name").alias("name"))
    own = ingest.assign_years(e).select(F.concat(F.lit("w."), "domain").alias("name"))
    return claims.survey_reduction(e.where("source_id = 2"), theirs, own)


@query("SELECT id AS evidence_id, ['one', 'usenet_body_url_hostnames', 'msg_a__from'][source] AS source, y AS evidence_year FROM e WHERE domain = (SELECT min(domain) FROM e)")
def trace_of_a_name(spark, sf_dir):
    e = evidence_rows(spark, sf_dir)
    return claims.trace(e, sources(spark), e.agg(F.min("domain")).first()[0]).select("evidence_id", "source", "evidence_year")


@query("SELECT ['one', 'usenet_body_url_hostnames', 'msg_a__from'][source] AS source, 'com' AS tld, s.y AS year, count(*) AS n FROM ships s JOIN e USING (id) ANTI JOIN held h ON h.domain = s.domain AND h.y = s.y WHERE ok AND web AND id % 5 >= 2 GROUP BY ALL")
def round_increment(spark, sf_dir):
    from sedimenta.operators import export, ingest

    e = evidence_rows(spark, sf_dir)
    pairs = export.net_new(export.claims(ingest.assign_years(e), e, "domain"), held(spark, sf_dir))
    verified = e.select("evidence_id", F.timestamp_seconds(F.col("evidence_id") % 5).alias("verified_at"))
    return claims.increment(pairs, e, sources(spark), verified, F.timestamp_seconds(F.lit(2)))


@query(
    ", hs AS (SELECT 'w.' || domain AS hostname, domain, y, max(id) AS id FROM e WHERE other GROUP BY domain, y), g AS (SELECT domain, y, min(id) AS id FROM e WHERE other AND web GROUP BY domain, y) SELECT hs.hostname, hs.y AS year, coalesce(g.id, hs.id) AS evidence_id FROM hs LEFT JOIN g ON g.domain = hs.domain AND g.y = hs.y"
)
def stranded_hosts(spark, sf_dir):
    e = evidence_rows(spark, sf_dir)
    rest = e.where("evidence_value like '% w.%'").groupBy(F.concat(F.lit("w."), "domain").alias("hostname"), F.col("domain").alias("parent_domain"), F.col("evidence_year").alias("year")).agg(F.max("evidence_id").alias("evidence_id"))
    return claims.stranded(rest, e).select("hostname", "year", "evidence_id")


@query("SELECT id AS evidence_id FROM e WHERE EXISTS (SELECT 1 FROM e f WHERE f.id % 9 = 0 AND f.domain = e.domain AND f.y = e.y)")
def replay_marks(spark, sf_dir):
    e = evidence_rows(spark, sf_dir)
    failures = e.where("evidence_id % 9 = 0").select("domain", F.col("evidence_year").alias("year"), F.regexp_extract("evidence_value", "([0-9]{14})", 1).alias("stamp"))
    return claims.replay_failed(e, failures)


@query(
    ", hs AS (SELECT 'w.' || domain AS hostname, domain, y, min(id) AS id FROM e WHERE other AND web GROUP BY domain, y), g AS (SELECT domain, y, min(id) AS id FROM e WHERE other AND web AND id % 4 <> 0 GROUP BY domain, y) SELECT hs.hostname, hs.y AS year, CASE WHEN hs.id % 4 <> 0 THEN hs.id ELSE g.id END AS evidence_id FROM hs LEFT JOIN g ON g.domain = hs.domain AND g.y = hs.y WHERE hs.id % 4 <> 0 OR g.id IS NOT NULL"
)
def retracted_errors(spark, sf_dir):
    e = evidence_rows(spark, sf_dir)
    web = e.where("evidence_value like '% w.%' and acquisition_method = 'ia_cdx_year_query'")
    rest = web.groupBy(F.concat(F.lit("w."), "domain").alias("hostname"), F.col("domain").alias("parent_domain"), F.col("evidence_year").alias("year")).agg(F.min("evidence_id").alias("evidence_id"))
    return claims.retracted(rest, e, e.where("evidence_id % 4 = 0").select("evidence_id")).select("hostname", "year", "evidence_id")


@query("SELECT o_orderkey AS evidence_id, CASE WHEN o_orderkey % 3 = 0 THEN '#arc a' || (o_orderkey % 10) || ' ' || o_custkey END AS evidence_url FROM orders")
def recited_archives(spark, sf_dir):
    e = evidence_rows(spark, sf_dir)
    o = table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0")
    one = o.select(F.col("o_orderkey").alias("evidence_id"), F.concat(F.lit("a"), (F.col("o_orderkey") % 10).cast("string")).alias("arc"), F.col("o_custkey").cast("long").alias("arc_offset"))
    later = one.withColumn("arc_offset", F.col("arc_offset") + 5)
    return claims.recited(e, later.union(one)).select("evidence_id", "evidence_url")


@query("SELECT c.domain AS name, c.y AS year, c.domain IN (SELECT domain FROM held h WHERE h.y = c.y) OR c.domain IN (SELECT domain FROM best b WHERE b.y = c.y) AS known FROM (SELECT DISTINCT domain, y FROM e) c")
def known_delta(spark, sf_dir):
    from sedimenta.operators import ingest

    e = evidence_rows(spark, sf_dir)
    ours = ingest.assign_years(e).select(F.col("domain").alias("name"), F.col("assigned_year").alias("year"))
    return claims.known_delta(e.select(F.col("domain").alias("name"), F.col("evidence_year").alias("year")).distinct(), held(spark, sf_dir), ours)


@query(
    "SELECT status, attempts, count(*) AS n FROM (SELECT CASE WHEN r > 40 THEN 'pending' WHEN r % 4 = 0 THEN 'done' WHEN r % 4 = 1 THEN 'failed' ELSE 'pending' END AS status, CASE WHEN r > 40 THEN 0 ELSE 1 END AS attempts FROM (SELECT row_number() OVER (ORDER BY CAST(s_suppkey AS VARCHAR)) - 1 + 1 AS r FROM supplier)) GROUP BY ALL"
)
def queue_states(spark, sf_dir):
    """Forty items claimed in the order of their keys: every fourth done, one failed for good, one to be tried again, one left by a crash."""
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    work = table(spark, sf_dir, "supplier").select(F.lit("cdx").alias("task_type"), F.col("s_suppkey").cast("string").alias("key"))
    q = queue.enqueue(spark.createDataFrame([], queue.SCHEMA), work, now)
    q = queue.enqueue(q, work, now)
    taken = queue.ready(q, "cdx", now, 40)
    ranked = taken.withColumn("r", F.expr("row_number() over (order by key)"))
    q = queue.claim(q, taken, now)
    q = queue.done(q, ranked.where("r % 4 = 0").drop("r"), now)
    lost = ranked.where("r % 4 in (1, 2)").select("task_type", "key", F.lit(503).alias("http"), F.when(F.col("r") % 4 == 2, 60).alias("retry_after"))
    q = queue.reset(queue.failed(q, lost, now), now)
    return q.groupBy("status", "attempts").agg(F.count("*").alias("n"))


@query(
    "SELECT round(scale, 6) AS scale, round(half, 6) AS half FROM (SELECT sum(y * x) / sum(x * x) AS scale, half, sum(y * y) - sum(y * x) * sum(y * x) / sum(x * x) AS error FROM (SELECT half, y, a / (a + half) AS x FROM (SELECT l_linenumber::DOUBLE AS a, 1000.0 * l_linenumber / (l_linenumber + 5) AS y FROM lineitem GROUP BY l_linenumber), (SELECT pow(10.0, step / 150.0) AS half FROM (SELECT unnest(range(1, 1201)) AS step))) GROUP BY half) ORDER BY error, half LIMIT 1"
)
def saturation_fit(spark, sf_dir):
    curve = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").cast("double").alias("a")).distinct().withColumn("y", 1000.0 * F.col("a") / (F.col("a") + 5))
    return statistics.saturation(curve, 100).select(F.round("scale", 6).alias("scale"), F.round("half", 6).alias("half"))


@query(
    "SELECT event_type AS unit, n, round(v / n, 2) AS price, round(s / n, 1) AS seconds FROM (SELECT event_type, count(*) FILTER (WHERE user_id % 3 > 0) AS n, sum(user_id)::DOUBLE AS v, sum(event_id % 10)::DOUBLE AS s FROM events GROUP BY event_type) WHERE n > 0"
)
def unit_prices(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("unit"), (F.col("user_id") % 3 > 0).alias("answered"), F.col("user_id").cast("double").alias("value"), (F.col("event_id") % 10).cast("double").alias("seconds"))
    return statistics.unit_prices(e)


@query("SELECT event_type, sum(value) * 1000 / count(*) AS projected FROM events GROUP BY event_type")
def linear_projection(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum("value").alias("v"), F.count("*").alias("n"))
    return e.select("event_type", statistics.projected(F.col("v"), F.col("n"), 1000).alias("projected"))
