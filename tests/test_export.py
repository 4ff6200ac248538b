import pytest
from pyspark.sql import functions as F

from sedimenta.operators import export, pricing
from sedimenta.operators.store import Store
from sedimenta.sources import formats, scan, sinks
from sedimenta.streaming import ingest as streaming
from tests.test_store import NOW, S, clean, evidence


def pairs(spark, rows):
    return spark.createDataFrame(rows, "name string, year int")


def test_claims_and_net_new(spark):
    t = clean(spark)
    got = export.claims(t["domain_year"], t["evidence"], "domain")
    hosts = export.claims(t["hostname_year"], t["evidence"], "hostname")
    assert [tuple(r) for r in got.collect()] == [("a.com", 1997, 1)] and [tuple(r) for r in hosts.collect()] == [("www.a.com", 1997, 2)]
    assert export.net_new(got, pairs(spark, [("a.com", 1998)])).count() == 1
    assert export.net_new(got, pairs(spark, [("a.com", 1997)])).count() == 0
    rows = export.manifest(got, t["evidence"], t["source"])
    assert rows.count() == 1 and rows.first()["source"] == "captures" and rows.first()["kind"] == "capture"
    with pytest.raises(ValueError, match="1 lines but 2 rows"):
        export.same_count(got, rows.union(rows), "manifest")
    names = spark.createDataFrame([], "name string")
    assert [r["name"] for r in export.undated(t["domain"], t["domain_year"], pairs(spark, []), names).collect()] == ["b.com"]
    c = {r["name"]: r for r in export.contribution(t["evidence"], t["domain_year"], got, t["source"]).collect()}
    assert (c["captures"]["evidence_rows"], c["captures"]["assigned"], c["captures"]["shipped"], c["links"]["assigned"]) == (2, 1, 1, 0)
    cut = export.cut_to_shipped(t, got)
    assert {r["domain"] for r in cut["evidence"].collect()} == {"a.com"} and cut["source"].count() == 1


def test_pool_growth_and_audit(spark):
    def n(*names):
        return spark.createDataFrame([(x,) for x in names], "name string")

    shipped, taken = export.pool({"one": n("a", "b", None), "two": n("b", "c"), "three": n("c", "d")}, pairs(spark, [("d", 1997)]), n("a"))
    assert sorted(map(tuple, shipped.select("arm", "name").collect())) == [("one", "b"), ("two", "c")]
    assert sorted(map(tuple, taken.select("arm", "name").collect())) == [("one", "a"), ("three", "d")]
    base, new = pairs(spark, [("a", 1997), ("b", 1997)]), pairs(spark, [("b", 1997), ("c", 1997), ("c", 1998)])
    assert {r["year"]: (r["base"], r["added"], r["merged"], r["pct"]) for r in export.growth(base, new).collect()} == {1997: (2, 2, 4, 100.0), 1998: (0, 1, 1, None)}
    audit = {r["year"]: r.asDict() for r in export.merge_audit(base, new).collect()}
    assert audit[1997] == {"year": 1997, "base": 2, "submitted": 2, "overlap": 1, "merged": 3, "accepted": 1}
    assert audit[1998]["accepted"] == 1


def test_pricing(spark):
    rows = [
        ("1", "http://www.A.com/x", "1997", "200", False), ("2", "www.a.com", "1997", None, True), ("3", "b.com", None, None, True), ("4", "c.com", "late", None, True),
        ("5", "d.com", "2005", None, True), ("6", "e.com", "1999", "404", True), ("7", "", "1999", None, True), ("8", "10.0.0.1", "1999", None, True), ("9", "f.com", "1998", None, True), ("10", "x.unknown", "1998", None, True),
    ]
    items = pricing.priced_items(spark.createDataFrame(rows, "item string, host string, year string, status string, free boolean"))
    drops = {r["item"]: r["drop"] for r in items.collect()}
    assert drops == {"1": None, "2": None, "3": None, "4": "bad year", "5": "out of window", "6": "error status", "7": "no name", "8": "not a host", "9": None, "10": "no registrable"}
    one = pricing.distinct_records(items.where("drop is null"))
    none = spark.createDataFrame([], "name string")
    flags = pricing.leftovers(one, pairs(spark, [("f.com", 1998), ("a.com", 1996)]), none, pairs(spark, [("b.com", None)]))
    got = {r["name"]: r for r in flags.collect()}
    assert got["f.com"]["held"] and got["www.a.com"]["parent_held"] and not got["www.a.com"]["free"] and got["b.com"]["dated"]
    w = spark.sql("SELECT 'com' AS tld, CAST(0.5 AS DECIMAL(12,8)) AS weight")
    tally = pricing.tally(flags, w)
    assert sorted((r["track"], r["part"], r["n"], float(r["value"])) for r in tally.collect()) == [("annual", "core", 1, 0.5), ("candidate", "extended", 1, 0.5)]
    assert float(pricing.top(tally).first()["value"]) == 1.0
    other = tally.groupBy("track", "part", "year").agg(F.sum("value").alias("value"))
    assert pricing.reconciles(tally, other).isEmpty()
    assert pricing.reconciles(tally, other.where("track = 'annual'")).count() == 1


def test_sinks(spark, tmp_path):
    df = pairs(spark, [("b.com", 1997), ("a.com", 1997), ("c.com", 1998)])
    assert sinks.name_list(df, f"{tmp_path}/names", 1) == 3
    assert [r["name"] for r in scan.name_list(spark, f"{tmp_path}/names").collect()] == ["a.com", "b.com", "c.com"]
    assert sinks.year_lists(df, f"{tmp_path}/years") == 3
    assert (tmp_path / "years" / "year=1998").is_dir()
    for bad in ([("A.com", 1997)], [("a.com", 1997)] * 2, [(None, 1997)]):
        with pytest.raises(ValueError, match="names"):
            sinks.year_lists(pairs(spark, bad), f"{tmp_path}/bad")
    with pytest.raises(ValueError, match="every line"):
        sinks.manifest(df, f"{tmp_path}/m", ["name"], 4)


def test_incremental_ingest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    store = Store(spark, f"file://{tmp_path}/store")
    source = ("early", "timestamped", "cdx_timestamp", "bulk_cdx_file")

    def go():
        streaming.run(streaming.arriving(spark, f"file://{tmp_path}/in"), formats.early_web_cdx, store, source, f"file://{tmp_path}/ck").awaitTermination()
        return sorted((r["domain"], r["assigned_year"]) for r in store.table("domain_year").collect())

    (tmp_path / "in" / "1.cdx").write_text(f"k {S} http://a.com/ t 200 x\nk {S} http://a.com/ t 200 x\nbad\n")
    (tmp_path / "in" / "2.cdx.part").write_text(f"k {S} http://never.com/ t 200 x\n")
    assert go() == [("a.com", 1997)] == go()
    (tmp_path / "in" / "3.cdx").write_text(f"k {S} http://a.com/ t 200 x\nk 19980203040506 http://b.org/ t 200 x\n")
    assert go() == [("a.com", 1997), ("b.org", 1998)]
    assert store.table("evidence").count() == 2 and store.table("domain").count() == 2


def test_evidence_helper(spark):
    assert evidence(spark, []).count() == 0 and NOW.year == 2024
