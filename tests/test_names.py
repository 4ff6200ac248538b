from pyspark.sql import functions as F

from sedimenta.functions import names

CASES = {
    "http://User@WWW.Example.com:80/a?b#c": ("www.example.com", "example.com", None),
    "//shop.example.co.uk.": ("shop.example.co.uk", "example.co.uk", None),
    "10.0.0.1": ("10.0.0.1", None, "ip address"),
    "": ("", None, "empty"),
    "localhost": ("localhost", None, "single label"),
    "-bad-.com": ("-bad-.com", None, "bad label"),
    "com": ("com", None, "single label"),
}


def test_hosts_and_refusals(spark):
    df = spark.createDataFrame([(k,) for k in CASES], "raw string").withColumn("host", names.host(F.col("raw")))
    df = names.registrable(df, "host").withColumn("reason", names.refusal(F.col("host")))
    assert {r["raw"]: (r["host"], r["registrable"], r["reason"]) for r in df.collect()} == CASES


def test_suffix_rules(spark):
    listed = names.suffix_rules("// comment\ncom\nuk\nco.uk\n*.ck\n!www.ck\n")
    cases = {
        "a.b.com": ("b.com", None), "com": (None, "bare suffix"), "x.y.z.ck": ("y.z.ck", None), "z.ck": (None, "bare suffix"), "a.www.ck": ("www.ck", None), "www.ck": ("www.ck", None),
        "a.co.uk": ("a.co.uk", None), "b.a.uk": ("a.uk", None), "a.sucks": (None, "no known suffix"), "_a.com": (None, "bad registered label"), "a.b.co.yu": ("b.co.yu", None),
    }
    df = names.reduced(spark.createDataFrame([(k,) for k in cases], "h string"), "h", listed)
    assert {r["h"]: (r["registrable"], r["refused"]) for r in df.collect()} == cases
    wide = {"a.b.ru": "b.ru", "a.com.br": "a.com.br", "x.a.pl": "a.pl", "www.a.ch": "a.ch", "a.or.at": "a.or.at", "a.museum": "a.museum", "a.b.fj": "a.b.fj", "q.a.co.jp": "a.co.jp", "a.gob.mx": "a.gob.mx"}
    df = names.registrable(spark.createDataFrame([(k,) for k in wide], "h string"), "h")
    assert {r["h"]: r["registrable"] for r in df.collect()} == wide


def test_percent_codes(spark):
    from urllib.parse import unquote

    cases = ["a%2Ecom", "%41b.com", "100%.com", "a+b.com", "%zz%20x", "%C3%A9.com", "plain", "a%2", "%25%41"]
    df = spark.createDataFrame([(x,) for x in cases], "raw string").select("raw", names.unquoted(F.col("raw")).alias("u"))
    assert {r["raw"]: r["u"] for r in df.collect()} == {x: unquote(x) for x in cases}


def test_resolved_links(spark):
    from urllib.parse import urljoin

    pages = ["http://a.com/x/y.html", "http://a.com", "https://a.com/d/?q=1"]
    links = ["about.html", "/x", "//b.com/z", "../up.html", "./here", "http://c.com/k", "?p=2", "a/b/../c", "../../../top"]
    none = ["mailto:x@y.z", "javascript:void(0)", "#top", "", "ftp://h/x"]
    df = spark.createDataFrame([(p, h) for p in pages for h in links + none], "p string, h string").select("p", "h", names.resolved(F.col("h"), F.col("p")).alias("u"))
    for r in df.collect():
        assert r["u"] == (None if r["h"] in none else urljoin(r["p"], r["h"])), r


def test_doubled_suffix(spark):
    df = spark.createDataFrame([("a.com.com",), ("a.co.uk.co.uk",), ("a.com",), ("com",)], "h string")
    got = df.select("h", names.doubled_suffix(F.col("h"), 1).alias("one"), names.doubled_suffix(F.col("h"), 2).alias("two")).collect()
    assert [(r["one"], r["two"]) for r in got] == [(True, False), (False, True), (False, False), (False, False)]
