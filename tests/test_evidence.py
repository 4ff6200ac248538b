import pytest
from pyspark.sql import functions as F

from sedimenta.functions import delegation, evidence

S = "19970203040506"
#: (method, value, url, domain) -> (host, named, web, names another host)
ROWS = [
    ("ia_cdx_year_query", f"cdx capture {S} a.com", None, "a.com", "a.com", "a.com", True, False),
    ("ia_cdx_year_query", f"cdx capture {S} www.a.com", None, "a.com", "www.a.com", "www.a.com", True, True),
    ("ia_cdx_year_query", f"cdx capture {S} status 404 a.com", None, "a.com", "a.com", "a.com", False, False),
    ("ia_cdx_year_query", f"cdx capture {S} replay failed a.com", None, "a.com", "a.com", "a.com", False, False),
    ("ia_cdx_year_query", "cdx capture 1997", None, "a.com", None, None, True, False),
    ("ukwa_host_link_graph", "host_link_graph:1999 B.com", None, "b.com", "b.com", "b.com", True, False),
    ("page_link_host", f"page link 1999 https://x/y#arc 1 2 #{S} http://p/ b.com", None, "b.com", "b.com", "b.com", True, False),
    ("httparchive_har_entry", f"har entry {S} status 301 a.com", None, "a.com", "a.com", "a.com", True, False),
    ("httparchive_har_entry", f"har entry {S} status 501 a.com", None, "a.com", None, None, False, False),
    ("bulk_cdx_file", S, f"https://web.archive.org/web/{S}/http://u@Www.A.com.:80/x", "a.com", "www.a.com", "www.a.com", True, True),
    ("bulk_cdx_file", S, "https://web.archive.org/web/19990101000000/http://a.com/", "a.com", None, None, True, False),
    ("bulk_cdx_file", S, None, "a.com", None, None, True, False),
    ("nypw_timemap_non_200", f"nypw timemap capture status 302 {S}", f"https://web.archive.org/web/{S}/http://a.com/", "a.com", "a.com", "a.com", True, False),
    ("nypw_timemap_non_200", f"nypw timemap capture status 404 {S}", f"https://web.archive.org/web/{S}/http://a.com/", "a.com", "a.com", "a.com", False, False),
    ("attrition_defacement_mirror_index", "x", "http://m/mirror/2000/01/02/a.com/", "a.com", "a.com", "a.com", True, False),
    ("unheard_of", f"cdx capture {S} a.com", None, "a.com", "a.com", "a.com", False, False),
    ("unheard_of", "listed at mail.a.com", None, "a.com", None, "mail.a.com", False, True),
    (None, "text", None, "a.com", None, None, False, False),
]


def test_evidence(spark):
    cols = "at int, acquisition_method string, evidence_value string, evidence_url string, domain string"
    df = spark.createDataFrame([(i, *r[:4]) for i, r in enumerate(ROWS)], cols).withColumn("ev", evidence.parsed())
    df = df.select("at", "ev.host", "ev.named", "ev.web", evidence.names_another_host(F.col("ev"), F.col("domain")).alias("other"), evidence.qualifies(F.col("ev"), F.col("domain")).alias("q"))
    for r in df.collect():
        want = ROWS[r["at"]]
        assert (r["host"], r["named"], r["web"], r["other"]) == want[4:], want
        assert r["q"] is (want[6] and want[4] == want[3])


@pytest.mark.parametrize(
    ("name", "year", "existed", "domain", "host", "undated"),
    [
        ("a.com", 1996, True, True, True, True), ("a.info", 2000, False, False, False, False), ("a.info", 2001, True, False, False, False), ("a.arpa", 1999, False, False, False, False),
        ("a.yu", 2001, True, True, True, True), ("a.cs", 1996, False, True, True, True), ("a.me", 2001, False, False, False, True), ("a.sucks", 2001, False, False, False, False),
        ("www.cz", 1999, True, False, False, False), ("x.a.com.a.com", 1999, True, True, False, True), ("1.in-addr.arpa.isp.br", 1999, True, False, False, False),
    ],
)
def test_calendar(spark, name, year, existed, domain, host, undated):
    from sedimenta.functions import names

    n, y = F.col("n"), F.col("y")
    r = spark.createDataFrame([(name, year)], "n string, y int").select(delegation.existed(names.tld(n), y), delegation.ships_domain(n, y), delegation.ships_host(n, y), delegation.ships_undated(n)).first()
    assert tuple(r) == (existed, domain, host, undated)
