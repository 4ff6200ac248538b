"""Queries over (subject, year) pairs. Subject: customer; evidence: order; class: status; method: priority."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sedimenta.operators import picks, sets

WINDOW = (1996, 2001)
SHIPS = ("1-URGENT", "2-HIGH")
#: Weights of the segments, exact decimals.
WEIGHTS = {"AUTOMOBILE": "0.91250000", "BUILDING": "0.52340000", "FURNITURE": "0.11110000", "HOUSEHOLD": "0.33330000", "MACHINERY": "0.70000000"}
QUERIES: dict = {}
SQL: dict = {}


def query(sql: str):
    def keep(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = CTE + sql
        return f

    return keep


CTE = """WITH ev AS (SELECT o_orderkey AS id, o_custkey AS subject, CAST(year(o_orderdate) AS BIGINT) AS y, o_orderstatus AS class, o_orderpriority AS method,
  o_orderdate AS stamp, CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderpriority IN ('1-URGENT','2-HIGH') AS ships FROM orders),
w AS (SELECT * FROM (VALUES ('AUTOMOBILE', 0.91250000), ('BUILDING', 0.52340000), ('FURNITURE', 0.11110000), ('HOUSEHOLD', 0.33330000), ('MACHINERY', 0.70000000)) t(segment, weight)),
inw AS (SELECT * FROM ev WHERE y BETWEEN 1996 AND 2001),
heldpairs AS (SELECT DISTINCT subject, y FROM inw WHERE method = '5-LOW'),
claims AS (SELECT DISTINCT subject, y FROM inw WHERE ships),
netnew AS (SELECT c.* FROM claims c ANTI JOIN heldpairs h ON c.subject = h.subject AND c.y = h.y),
seg AS (SELECT c_custkey AS subject, c_mktsegment AS segment, c_nationkey AS nation FROM customer)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("subject"), F.year("o_orderdate").cast("long").alias("y"), F.col("o_orderstatus").alias("class"),
        F.col("o_orderpriority").alias("method"), F.col("o_orderdate").alias("stamp"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"), F.col("o_orderpriority").isin(*SHIPS).alias("ships"),
    )


def in_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence(spark, sf_dir).where(F.col("y").between(*WINDOW))


def claims(spark, sf_dir) -> DataFrame:
    return in_window(spark, sf_dir).where("ships").select("subject", "y").distinct()


def held_pairs(spark, sf_dir) -> DataFrame:
    return in_window(spark, sf_dir).where("method = '5-LOW'").select("subject", "y").distinct()


def net_new(spark, sf_dir) -> DataFrame:
    return sets.minus(claims(spark, sf_dir), held_pairs(spark, sf_dir), ["subject", "y"])


def segments(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("subject"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))


def weights(spark) -> DataFrame:
    rows = ", ".join(f"('{k}', CAST('{v}' AS DECIMAL(12,8)))" for k, v in WEIGHTS.items())
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {rows} AS t(segment, weight)"))  # a fixed table


@query("SELECT id, subject, y FROM inw")
def window_filter(spark, sf_dir):
    return in_window(spark, sf_dir).select("id", "subject", "y")


@query("SELECT subject, y, arg_min(method, (stamp, id)) AS method, min(id) FILTER (WHERE ships) AS first_ship FROM inw GROUP BY ALL")
def keep_first_pair(spark, sf_dir):
    return in_window(spark, sf_dir).groupBy("subject", "y").agg(F.min_by("method", F.struct("stamp", "id")).alias("method"), F.min(F.when(F.col("ships"), F.col("id"))).alias("first_ship"))


@query("SELECT subject, y, min(id) AS id, count(*) AS n FROM inw GROUP BY ALL")
def keep_lowest_id(spark, sf_dir):
    return in_window(spark, sf_dir).groupBy("subject", "y").agg(F.min("id").alias("id"), F.count("*").alias("n"))


@query("SELECT subject, y, class, id, method FROM (SELECT *, row_number() OVER (PARTITION BY subject, y, class ORDER BY NOT ships, method, id) AS r FROM inw) WHERE r = 1")
def ships_first_pick(spark, sf_dir):
    out = picks.first_by(in_window(spark, sf_dir), ["subject", "y", "class"], [(~F.col("ships")).asc(), F.col("method").asc(), F.col("id").asc()])
    return out.select("subject", "y", "class", "id", "method")


@query("SELECT subject, y, id, ships FROM (SELECT *, row_number() OVER (PARTITION BY subject, y ORDER BY NOT ships, class = 'P', id) AS r FROM inw) WHERE r = 1")
def assign_best_row(spark, sf_dir):
    out = picks.first_by(in_window(spark, sf_dir), ["subject", "y"], [(~F.col("ships")).asc(), (F.col("class") == "P").asc(), F.col("id").asc()])
    return out.select("subject", "y", "id", "ships")


@query("SELECT * FROM claims")
def claim_pairs(spark, sf_dir):
    return claims(spark, sf_dir)


@query("SELECT * FROM netnew")
def netnew_pairs(spark, sf_dir):
    return net_new(spark, sf_dir)


@query("SELECT y, count(*) AS names, CAST(sum(weight) AS DOUBLE) AS score FROM netnew JOIN seg USING (subject) JOIN w USING (segment) GROUP BY y")
def netnew_by_year(spark, sf_dir):
    out = net_new(spark, sf_dir).join(segments(spark, sf_dir), "subject").join(weights(spark), "segment")
    return out.groupBy("y").agg(F.count("*").alias("names"), F.sum("weight").cast("double").alias("score"))


@query("SELECT DISTINCT c.subject FROM claims c SEMI JOIN heldpairs h ON c.subject = h.subject")
def held_any(spark, sf_dir):
    return sets.held(claims(spark, sf_dir), held_pairs(spark, sf_dir), ["subject"]).select("subject").distinct()


@query("SELECT c.* FROM claims c SEMI JOIN heldpairs h ON c.subject = h.subject AND c.y = h.y")
def held_pair(spark, sf_dir):
    return sets.held(claims(spark, sf_dir), held_pairs(spark, sf_dir), ["subject", "y"])


@query("SELECT subject, segment FROM seg WHERE subject NOT IN (SELECT subject FROM claims)")
def not_in_pool(spark, sf_dir):
    return sets.minus(segments(spark, sf_dir), claims(spark, sf_dir), ["subject"]).select("subject", "segment")


@query("SELECT id FROM ev e WHERE ships OR EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = e.id AND l.l_quantity >= 49)")
def exists_or_flag(spark, sf_dir):
    big = table(spark, sf_dir, "lineitem").where("l_quantity >= 49").select(F.col("l_orderkey").alias("id")).distinct().withColumn("big", F.lit(True))
    return evidence(spark, sf_dir).join(big, "id", "left").where("ships or big").select("id")


@query("SELECT n.id FROM inw n WHERE n.class = 'O' AND NOT EXISTS (SELECT 1 FROM inw h WHERE h.class = 'F' AND h.subject = n.subject AND h.y = n.y AND (h.ships OR NOT n.ships))")
def class_skip_unless_ships(spark, sf_dir):
    e = in_window(spark, sf_dir)
    h = e.where("class = 'F'").groupBy("subject", "y").agg(F.bool_or("ships").alias("held_ships"))
    n = e.where("class = 'O'")
    return n.join(h, (n.subject == h.subject) & (n.y == h.y) & (F.col("held_ships") | ~n.ships), "left_anti").select("id")


@query("SELECT a.subject, count(*) AS n FROM (SELECT subject, nullif(nation, 3) AS nation FROM seg) a JOIN (SELECT s_suppkey, nullif(s_nationkey, 3) AS nation FROM supplier) b ON a.nation IS NOT DISTINCT FROM b.nation GROUP BY a.subject")
def null_safe_join(spark, sf_dir):
    a = segments(spark, sf_dir).select("subject", F.nullif(F.col("nation"), F.lit(3)).alias("nation"))
    b = table(spark, sf_dir, "supplier").groupBy(F.nullif(F.col("s_nationkey"), F.lit(3)).alias("other")).agg(F.count("*").alias("k"))
    return a.join(b, a.nation.eqNullSafe(b.other)).groupBy("subject").agg(F.sum("k").alias("n"))


@query("SELECT k, count(*) AS n FROM claims c, (SELECT unnest(range(-3, 4)) AS k) s JOIN heldpairs h ON h.subject = c.subject AND h.y = c.y + s.k GROUP BY k")
def shifted_year_join(spark, sf_dir):
    c = claims(spark, sf_dir).select("subject", "y", F.explode(F.sequence(F.lit(-3).cast("long"), F.lit(3).cast("long"))).alias("k")).select("subject", "k", (F.col("y") + F.col("k")).alias("y"))
    return c.join(held_pairs(spark, sf_dir), ["subject", "y"]).groupBy("k").agg(F.count("*").alias("n"))


@query("SELECT c.y, CAST(count(*) FILTER (WHERE b AND a) AS BIGINT) AS between_held, CAST(count(*) FILTER (WHERE b AND NOT a) AS BIGINT) AS after_held, CAST(count(*) FILTER (WHERE a AND NOT b) AS BIGINT) AS before_held FROM (SELECT c.subject, c.y, bool_or(h.y < c.y) AS b, bool_or(h.y > c.y) AS a FROM netnew c JOIN heldpairs h ON c.subject = h.subject GROUP BY ALL) c GROUP BY c.y")
def before_after_tiers(spark, sf_dir):
    h = held_pairs(spark, sf_dir).groupBy("subject").agg(F.min("y").alias("low"), F.max("y").alias("high"))
    c = net_new(spark, sf_dir).join(h, "subject").select("y", (F.col("low") < F.col("y")).alias("b"), (F.col("high") > F.col("y")).alias("a"))
    return c.groupBy("y").agg(F.count_if(F.col("b") & F.col("a")).alias("between_held"), F.count_if(F.col("b") & ~F.col("a")).alias("after_held"), F.count_if(F.col("a") & ~F.col("b")).alias("before_held"))


@query("SELECT e.id, e.y, seg.segment, n.n_name, r.r_name FROM inw e JOIN seg USING (subject) JOIN nation n ON seg.nation = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey WHERE e.ships")
def manifest_four_way(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("nation"), "n_name", "r_name")
    return in_window(spark, sf_dir).where("ships").join(segments(spark, sf_dir), "subject").join(n, "nation").select("id", "y", "segment", "n_name", "r_name")


@query("SELECT n_name, coalesce(p.pairs, 0) AS pairs, coalesce(q.new, 0) AS new FROM nation LEFT JOIN (SELECT nation, count(*) AS pairs FROM claims JOIN seg USING (subject) GROUP BY nation) p ON p.nation = n_nationkey LEFT JOIN (SELECT nation, count(*) AS new FROM netnew JOIN seg USING (subject) GROUP BY nation) q ON q.nation = n_nationkey")
def source_contribution(spark, sf_dir):
    s = segments(spark, sf_dir)
    p = claims(spark, sf_dir).join(s, "subject").groupBy("nation").agg(F.count("*").alias("pairs"))
    q = net_new(spark, sf_dir).join(s, "subject").groupBy("nation").agg(F.count("*").alias("new"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"), "n_name")
    return n.join(p, "nation", "left").join(q, "nation", "left").select("n_name", F.coalesce("pairs", F.lit(0)).alias("pairs"), F.coalesce("new", F.lit(0)).alias("new"))


@query("SELECT y, base, new, round(100.0 * new / nullif(base, 0), 4) AS pct FROM (SELECT y, count(*) FILTER (WHERE NOT n) AS base, count(*) FILTER (WHERE n) AS new FROM (SELECT y, false AS n FROM heldpairs UNION ALL SELECT y, true FROM netnew) GROUP BY y)")
def year_growth(spark, sf_dir):
    both = held_pairs(spark, sf_dir).select("y", F.lit(False).alias("n")).union(net_new(spark, sf_dir).select("y", F.lit(True)))
    out = both.groupBy("y").agg(F.count_if(~F.col("n")).alias("base"), F.count_if("n").alias("new"))
    return out.withColumn("pct", F.round(F.lit(100.0) * F.col("new") / F.nullif(F.col("base"), F.lit(0)), 4))


@query("SELECT y, count(*) AS pairs, count(*) FILTER (WHERE k >= 2) AS confirmed, sum(k)::BIGINT AS methods FROM (SELECT subject, y, count(DISTINCT method) AS k FROM inw GROUP BY ALL) GROUP BY y")
def corroboration(spark, sf_dir):
    k = in_window(spark, sf_dir).select("subject", "y", "method").distinct().groupBy("subject", "y").agg(F.count("*").alias("k"))
    return k.groupBy("y").agg(F.count("*").alias("pairs"), F.count_if(F.col("k") >= 2).alias("confirmed"), F.sum("k").alias("methods"))


@query("SELECT subject, y, count(DISTINCT CASE WHEN method IN ('1-URGENT','2-HIGH') THEN 'fast' WHEN method = '3-MEDIUM' THEN 'mid' ELSE 'slow' END) AS lineages FROM inw GROUP BY ALL")
def independent_lineages(spark, sf_dir):
    lineage = F.when(F.col("method").isin(*SHIPS), "fast").when(F.col("method") == "3-MEDIUM", "mid").otherwise("slow")
    return in_window(spark, sf_dir).groupBy("subject", "y").agg(F.countDistinct(lineage).alias("lineages"))


@query("SELECT y, count(*) FILTER (WHERE f = y) AS discovered, count(*) FILTER (WHERE f < y) AS completed FROM (SELECT subject, y, min(y) OVER (PARTITION BY subject) AS f FROM claims) GROUP BY y")
def discovery_vs_completeness(spark, sf_dir):
    c = claims(spark, sf_dir).withColumn("f", F.min("y").over(Window.partitionBy("subject")))
    return c.groupBy("y").agg(F.count_if(F.col("f") == F.col("y")).alias("discovered"), F.count_if(F.col("f") < F.col("y")).alias("completed"))


@query("SELECT any_value(class) AS class, subject FROM inw GROUP BY subject HAVING count(DISTINCT class) = 1")
def exclusive_names(spark, sf_dir):
    out = in_window(spark, sf_dir).groupBy("subject").agg(F.min("class").alias("class"), F.max("class").alias("top"))
    return out.where("class = top").select("class", "subject")


@query("SELECT count(*) AS n, sum(id)::BIGINT AS ids, max(y) AS top, count(DISTINCT subject) AS subjects FROM ev")
def fingerprint_counts(spark, sf_dir):
    return evidence(spark, sf_dir).agg(F.count("*").alias("n"), F.sum("id").alias("ids"), F.max("y").alias("top"), F.countDistinct("subject").alias("subjects"))


@query("SELECT subject, CAST(m AS BIGINT) AS mask, ((m // (m & -m)) & (m // (m & -m) + 1)) <> 0 AS hole FROM (SELECT subject, bit_or(1::BIGINT << (y - 1996)) AS m FROM claims GROUP BY subject)")
def year_bitmask_holes(spark, sf_dir):
    m = claims(spark, sf_dir).groupBy("subject").agg(F.expr("bit_or(shiftleft(1L, cast(y - 1996 as int)))").alias("mask"))
    return m.select("subject", "mask", F.expr("(((mask div (mask & -mask)) & (mask div (mask & -mask) + 1)) <> 0)").alias("hole"))


@query("SELECT subject, unnest(range(lo, hi + 1)) AS y FROM (SELECT subject, min(y) AS lo, max(y) AS hi FROM inw GROUP BY subject) WHERE lo <= hi")
def span_to_years(spark, sf_dir):
    s = in_window(spark, sf_dir).groupBy("subject").agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
    return s.where("lo <= hi").select("subject", F.explode(F.sequence("lo", "hi")).alias("y"))


@query("SELECT track, y, segment, count(*) AS n, CAST(sum(weight) AS DOUBLE) AS price FROM (SELECT 'held' AS track, c.* FROM claims c SEMI JOIN heldpairs h ON c.subject = h.subject AND c.y = h.y UNION ALL SELECT 'new', * FROM netnew) JOIN seg USING (subject) JOIN w USING (segment) GROUP BY ALL")
def two_track_price(spark, sf_dir):
    new, held = sets.split(claims(spark, sf_dir), held_pairs(spark, sf_dir), ["subject", "y"])
    both = held.select(F.lit("held").alias("track"), "*").union(new.select(F.lit("new"), "*"))
    return both.join(segments(spark, sf_dir), "subject").join(weights(spark), "segment").groupBy("track", "y", "segment").agg(F.count("*").alias("n"), F.sum("weight").cast("double").alias("price"))


@query("SELECT y, sum(n) OVER (ORDER BY y)::BIGINT AS total FROM (SELECT y, count(*) AS n FROM claims GROUP BY y)")
def cumulative_curve(spark, sf_dir):
    n = claims(spark, sf_dir).groupBy("y").agg(F.count("*").alias("n"))  # a row a year
    return n.select("y", F.sum("n").over(Window.orderBy("y")).alias("total"))


@query("SELECT subject, y, CASE WHEN k = 0 THEN 'new name' ELSE 'new year' END AS kind FROM (SELECT n.subject, n.y, (SELECT count(*) FROM heldpairs h WHERE h.subject = n.subject) AS k FROM netnew n)")
def merge_audit(spark, sf_dir):
    known = held_pairs(spark, sf_dir).select("subject").distinct().withColumn("known", F.lit(True))
    return net_new(spark, sf_dir).join(known, "subject", "left").select("subject", "y", F.when(F.col("known"), "new year").otherwise("new name").alias("kind"))


@query("SELECT 'orphan evidence' AS check, count(*) AS offending FROM ev WHERE subject NOT IN (SELECT subject FROM seg) UNION ALL SELECT 'duplicate id', count(*) - count(DISTINCT id) FROM ev UNION ALL SELECT 'out of window', count(*) FROM ev WHERE y NOT BETWEEN 1996 AND 2001 UNION ALL SELECT 'claim not shipping', count(*) FROM claims c WHERE NOT EXISTS (SELECT 1 FROM inw e WHERE e.subject = c.subject AND e.y = c.y AND e.ships) UNION ALL SELECT 'net-new held', count(*) FROM netnew n SEMI JOIN heldpairs h ON n.subject = h.subject AND n.y = h.y")
def integrity_report(spark, sf_dir):
    e, c, n, h = evidence(spark, sf_dir), claims(spark, sf_dir), net_new(spark, sf_dir), held_pairs(spark, sf_dir)

    def counted(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("offending")).select(F.lit(name).alias("check"), "offending")

    repeats = e.groupBy("id").agg((F.count("*") - 1).alias("k")).agg(F.coalesce(F.sum("k"), F.lit(0)).alias("offending")).select(F.lit("duplicate id").alias("check"), "offending")
    return (
        counted("orphan evidence", sets.minus(e, segments(spark, sf_dir), ["subject"]))
        .union(repeats)
        .union(counted("out of window", e.where(~F.col("y").between(*WINDOW))))
        .union(counted("claim not shipping", sets.minus(c, e.where("ships").select("subject", "y"), ["subject", "y"])))
        .union(counted("net-new held", sets.held(n, h, ["subject", "y"])))
    )


@query("SELECT 'customer' AS arm, subject AS k FROM seg WHERE subject NOT IN (SELECT subject FROM claims) UNION ALL SELECT 'supplier', s_suppkey FROM supplier WHERE s_nationkey < 5 UNION ALL SELECT 'order', id FROM ev WHERE y = 1995")
def candidate_pool_three_arms(spark, sf_dir):
    a = sets.minus(segments(spark, sf_dir), claims(spark, sf_dir), ["subject"]).select(F.lit("customer").alias("arm"), F.col("subject").alias("k"))
    b = table(spark, sf_dir, "supplier").where("s_nationkey < 5").select(F.lit("supplier"), "s_suppkey")
    return a.union(b).union(evidence(spark, sf_dir).where("y = 1995").select(F.lit("order"), "id"))


@query("SELECT subject FROM inw WHERE class = 'F' EXCEPT SELECT subject FROM inw WHERE ships")
def except_distinct(spark, sf_dir):
    e = in_window(spark, sf_dir)
    return e.where("class = 'F'").select("subject").subtract(e.where("ships").select("subject"))


@query("SELECT (SELECT count(*) FROM (SELECT subject, y FROM claims EXCEPT SELECT subject, y FROM heldpairs)) + (SELECT count(*) FROM (SELECT subject, y FROM heldpairs EXCEPT SELECT subject, y FROM claims)) AS count")
def symmetric_difference_count(spark, sf_dir):
    return sets.difference_count(claims(spark, sf_dir), held_pairs(spark, sf_dir))


@query("SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 6")
def having_duplicates(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n")).where("n > 6")


@query("SELECT id FROM ev LEFT JOIN lineitem ON l_orderkey = id WHERE l_orderkey IS NULL")
def wall_left_join(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))
    return evidence(spark, sf_dir).join(lines, "id", "left_anti").select("id")


@query("SELECT l_partkey AS part, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM lineitem GROUP BY 1 ORDER BY sum(CAST(l_extendedprice AS DECIMAL(18,2))) DESC, 1 LIMIT 5")
def top_k_by_value(spark, sf_dir):
    out = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("part")).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("v"))
    return out.orderBy(F.desc("v"), "part").limit(5).select("part", F.col("v").cast("double").alias("value"))


@query("SELECT id, CASE WHEN class = 'F' AND ships THEN 'final' WHEN class = 'F' THEN 'closed' WHEN price >= 200000 THEN 'large' WHEN method LIKE '4%' THEN 'unset' ELSE 'other' END AS rule FROM inw")
def ordered_class_rules(spark, sf_dir):
    rule = F.when((F.col("class") == "F") & F.col("ships"), "final").when(F.col("class") == "F", "closed").when(F.col("price") >= 200000, "large").when(F.col("method").like("4%"), "unset").otherwise("other")
    return in_window(spark, sf_dir).select("id", rule.alias("rule"))
