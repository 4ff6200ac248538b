"""Queries over pages, documents and events: names out of URLs and texts, drop reasons, headings, intervals, rates."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sedimenta.functions import names
from sedimenta.operators import picks
from sedimenta.plans.pairs import table

#: Keys of a block of one_edit_neighbours, about.
BLOCK = 1000
QUERIES: dict = {}
SQL: dict = {}
CTE = r"""WITH host AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(lower(url), '^([a-z][a-z0-9+.-]*:)?//', ''), '[/?#].*', ''), ':[0-9]*$', '') AS host FROM pages),
lab AS (SELECT *, string_split(host, '.') AS parts, string_split(host, '.')[-1] AS tld FROM host)
"""


def query(sql: str | None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = CTE + sql
        return f

    return keep


def hosts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "url", names.host(F.col("url")).alias("host"))


@query("SELECT page_id, host FROM host")
def host_of_url(spark, sf_dir):
    return hosts(spark, sf_dir).select("page_id", "host")


@query("SELECT page_id, CASE WHEN len(parts) >= 2 AND tld IN ('com','net','org') THEN array_to_string(parts[-2:], '.') END AS registrable FROM lab")
def registrable_of_url(spark, sf_dir):
    return names.registrable(hosts(spark, sf_dir), "host").select("page_id", "registrable")


@query(r"SELECT page_id, CASE WHEN host = '' THEN 'empty' WHEN regexp_full_match(host, '[0-9]{1,3}(\.[0-9]{1,3}){3}') THEN 'ip address' WHEN len(parts) < 2 THEN 'single label' END AS reason FROM lab")
def reject_reason(spark, sf_dir):
    return hosts(spark, sf_dir).select("page_id", names.refusal(F.col("host")).alias("reason"))


@query("SELECT tld, count(*) AS n, count(DISTINCT host) AS hosts FROM lab GROUP BY tld")
def tld_counts(spark, sf_dir):
    return hosts(spark, sf_dir).groupBy(names.tld(F.col("host")).alias("tld")).agg(F.count("*").alias("n"), F.countDistinct("host").alias("hosts"))


@query("SELECT tld, CAST(count(*) * CASE tld WHEN 'com' THEN 0.50000000 WHEN 'net' THEN 0.37500000 WHEN 'org' THEN 0.62500000 ELSE 0 END AS DOUBLE) AS score FROM lab GROUP BY tld")
def ee_by_tld(spark, sf_dir):
    w = F.broadcast(spark.sql("SELECT * FROM VALUES ('com', 0.50000000BD), ('net', 0.37500000BD), ('org', 0.62500000BD) AS t(tld, w)"))  # a fixed table
    n = hosts(spark, sf_dir).groupBy(names.tld(F.col("host")).alias("tld")).agg(F.count("*").alias("n"))
    return n.join(w, "tld", "left").select("tld", F.coalesce(F.col("n") * F.col("w"), F.lit(0)).cast("double").alias("score"))


@query("SELECT count(*) FILTER (WHERE len(parts) >= 2 AND parts[-1] = parts[-2]) AS one, count(*) FILTER (WHERE len(parts) >= 4 AND parts[-2:] = parts[-4:-3]) AS two, count(*) AS n FROM lab")
def doubled_suffix(spark, sf_dir):
    h = F.col("host")
    return hosts(spark, sf_dir).agg(F.count_if(names.doubled_suffix(h, 1)).alias("one"), F.count_if(names.doubled_suffix(h, 2)).alias("two"), F.count("*").alias("n"))


@query("SELECT count(*) FILTER (WHERE starts_with(host, 'www.')) AS www, count(*) AS n FROM lab")
def www_alias_share(spark, sf_dir):
    return hosts(spark, sf_dir).agg(F.count_if(F.col("host").startswith("www.")).alias("www"), F.count("*").alias("n"))


@query("SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS heading FROM events")
def carry_forward_heading(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select("event_id", F.last(F.when(F.col("event_type") == "purchase", F.col("event_id")), ignorenulls=True).over(w).alias("heading"))


@query("SELECT event_id, event_type, date_diff('second', lag(ts) OVER w, ts) AS pause FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def previous_row_attribution(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").withColumn("was", F.lag("ts").over(w))
    return e.select("event_id", "event_type", (F.date_trunc("second", "ts").cast("long") - F.date_trunc("second", "was").cast("long")).alias("pause"))


@query("SELECT user_id, count(*) AS spans FROM (SELECT user_id, CASE WHEN since > max(till) OVER (PARTITION BY user_id ORDER BY since, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 WHEN row_number() OVER (PARTITION BY user_id ORDER BY since, event_id) = 1 THEN 1 ELSE 0 END AS new FROM (SELECT user_id, event_id, CAST(floor(epoch(ts)) AS BIGINT) AS since, CAST(floor(epoch(ts)) AS BIGINT) + 3600 AS till FROM events)) WHERE new = 1 GROUP BY user_id")
def interval_union(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").cast("long").alias("at")).withColumn("till", F.col("at") + 3600)
    w = Window.partitionBy("user_id").orderBy("at", "event_id")
    before = F.max("till").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return e.select("user_id", (before.isNull() | (F.col("at") > before)).alias("new")).where("new").groupBy("user_id").agg(F.count("*").alias("spans"))


@query("SELECT source, doc_id, nth FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS nth FROM documents WHERE n_chars < 500) WHERE nth <= 3")
def sample_first_n_per_reason(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("n_chars < 500").select("source", "doc_id")
    return picks.first_n(d, ["source"], [F.col("doc_id").asc()], 3).select("source", "doc_id", F.col("nth").cast("long").alias("nth"))


@query("SELECT event_type, avg(CASE WHEN r <= 3 THEN hit END) AS newest, avg(CASE WHEN r > 3 THEN hit END) AS history FROM (SELECT event_type, CASE WHEN value >= 50 THEN 1.0 ELSE 0.0 END AS hit, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) GROUP BY event_type")
def newest_vs_history_rate(spark, sf_dir):
    """The newest three by a window that stops at three a group; the rest by sums, without a window."""
    e = table(spark, sf_dir, "events").select("event_type", "ts", "event_id", F.when(F.col("value") >= 50, 1.0).otherwise(0.0).alias("hit"))
    new = picks.first_n(e, ["event_type"], [F.desc("ts"), F.desc("event_id")], 3).groupBy("event_type").agg(F.sum("hit").alias("new_hits"), F.count("*").alias("new_n"))
    all_of = e.groupBy("event_type").agg(F.sum("hit").alias("hits"), F.count("*").alias("n"))
    both = all_of.join(new, "event_type")
    return both.select("event_type", (F.col("new_hits") / F.col("new_n")).alias("newest"), F.try_divide(F.col("hits") - F.col("new_hits"), F.col("n") - F.col("new_n")).alias("history"))


@query("SELECT reason, count(*) AS n FROM (SELECT CASE WHEN user_id % 7 = 0 THEN 'foreign' WHEN value < 1 THEN 'too small' WHEN event_type = 'view' THEN 'not a claim' ELSE 'kept' END AS reason FROM events) GROUP BY reason")
def drop_reason_counts(spark, sf_dir):
    reason = F.when(F.col("user_id") % 7 == 0, "foreign").when(F.col("value") < 1, "too small").when(F.col("event_type") == "view", "not a claim").otherwise("kept")
    return table(spark, sf_dir, "events").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query("SELECT k, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS k FROM events) GROUP BY k")
def json_field_presence(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.explode(F.json_object_keys("props")).alias("k"))
    return e.groupBy("k").agg(F.count("*").alias("n"))


@query(r"SELECT host, count(*) AS n FROM (SELECT lower(regexp_extract(t, '@([A-Za-z0-9.-]+\.[A-Za-z]+)', 1)) AS host FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z0-9._-]+@[A-Za-z0-9.-]+\.[A-Za-z]+')) AS t FROM documents)) GROUP BY host")
def mail_hosts(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where(F.col("text").contains("@"))
    t = d.select(F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9._-]+@([A-Za-z0-9.-]+\.[A-Za-z]+)"), 1)).alias("h"))
    return t.groupBy(F.lower("h").alias("host")).agg(F.count("*").alias("n"))


@query("SELECT event_type, n, hits, round((p + 1.9208 / n - 1.96 * sqrt((p * (1 - p) + 0.9604 / n) / n)) / (1 + 3.8416 / n), 9) AS low, round((p + 1.9208 / n + 1.96 * sqrt((p * (1 - p) + 0.9604 / n) / n)) / (1 + 3.8416 / n), 9) AS high FROM (SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value >= 50) AS hits, (count(*) FILTER (WHERE value >= 50))::DOUBLE / count(*) AS p FROM events GROUP BY event_type)")
def wilson_interval(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") >= 50).alias("hits"))
    p, n = F.col("hits") / F.col("n"), F.col("n").cast("double")
    mid, half = p + 1.9208 / n, 1.96 * F.sqrt((p * (1 - p) + 0.9604 / n) / n)
    return e.select("event_type", "n", "hits", F.round((mid - half) / (1 + 3.8416 / n), 9).alias("low"), F.round((mid + half) / (1 + 3.8416 / n), 9).alias("high"))


@query(
    r"""SELECT page_id, CASE WHEN href LIKE '//%' THEN 'https:' || href WHEN href LIKE '/%' THEN regexp_extract(url, '^[a-z]+://[^/]*') || href ELSE href END AS link FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"', 1)) AS href FROM pages) WHERE regexp_matches(href, '^(/|https?://)')"""
)
def href_links(spark, sf_dir):
    """Links of the pages, however they are quoted, resolved against the page's address; other schemes and mere fragments lead nowhere."""
    found = F.regexp_extract_all("html", F.lit(r"""(?is)<a\s[^>]*?\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""), 1)
    p = table(spark, sf_dir, "pages").select("page_id", "url", F.explode(found).alias("href"))
    href = F.regexp_replace("href", r"""^["']|["']\z""", "")
    return p.select("page_id", names.resolved(href, F.col("url")).alias("link")).where("link is not null")


@query("SELECT a.p_partkey AS a, b.p_partkey AS b FROM part a JOIN part b ON a.p_partkey < b.p_partkey AND a.p_name <> b.p_name AND length(a.p_name) BETWEEN length(b.p_name) - 1 AND length(b.p_name) + 1 AND levenshtein(a.p_name, b.p_name) <= 1")
def one_edit_neighbours(spark, sf_dir):
    """Pairs one insertion, deletion or substitution apart: distinct names meet at their shared one-letter deletions and are verified; then
    each pair of names meets the keys that have them in blocks, so that frequent names are spread over all tasks and no row is shuffled for each
    of its pairs."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    cuts = F.transform(F.sequence(F.lit(1), F.length("p_name")), lambda i: F.concat(F.expr("p_name").substr(F.lit(1), i - 1), F.expr("p_name").substr(i + 1, F.length("p_name"))))
    v = p.select("p_name").distinct().select("p_name", F.explode(F.array_distinct(F.array_append(cuts, F.col("p_name")))).alias("v"))
    a, b = v.alias("a"), v.alias("b")
    near = a.join(b, (F.col("a.v") == F.col("b.v")) & (F.col("a.p_name") < F.col("b.p_name"))).select(F.col("a.p_name").alias("x"), F.col("b.p_name").alias("y")).distinct()
    near = near.where(F.levenshtein("x", "y") <= 1)
    sizes = p.groupBy("p_name").agg(F.ceil(F.count("p_partkey") / F.lit(BLOCK)).alias("blocks"))
    of = p.where("p_partkey is not null").join(sizes, "p_name").groupBy("p_name", F.pmod(F.xxhash64("p_partkey"), F.greatest("blocks", F.lit(1))).alias("block")).agg(F.collect_list("p_partkey").alias("keys"))
    x, y = of.select(F.col("p_name").alias("x"), F.col("block").alias("bx"), F.col("keys").alias("kx")), of.select(F.col("p_name").alias("y"), F.col("block").alias("by"), F.col("keys").alias("ky"))
    met = near.join(x, "x").join(y, "y").repartition("x", "bx", "y", "by")
    out = met.select(F.explode("kx").alias("kx"), "ky").select("kx", F.explode("ky").alias("ky")).where("kx <> ky")
    return out.select(F.least("kx", "ky").alias("a"), F.greatest("kx", "ky").alias("b"))
