import json

import pytest
from pyspark.sql import functions as F

from sedimenta.sources import formats, scan

STAMP = "19970203040506"
CASES = [
    ("early_web_cdx", "x", f"com,a)/ {STAMP} http://a.com/ text/html 200 X", [("http://a.com/", 1997, STAMP, None)]),
    ("early_web_cdx", "x", f"com,a)/ {STAMP} http://a.com/ text/html 404 X", ["non_200"]),
    ("early_web_cdx", "x", " CDX N b a m s", ["header_lines"]),
    ("early_web_cdx", "x", "too short", ["malformed"]),
    ("early_web_cdx", "x", "k 20050203040506 http://a.com/ t 200", ["out_of_window"]),
    ("first_capture", "x", f"q s {STAMP} http://a.com/ t 200 d 9", [("http://a.com/", 1997, f"nypw first capture {STAMP}", None)]),
    ("timemap", "x", f"q s {STAMP} http://a.com/ t 302 d 9", ["non_200"]),
    ("timemap_non_200", "x", f"q s {STAMP} http://a.com/ t 302 d 9", [("http://a.com/", 1997, f"nypw timemap capture status 302 {STAMP}", None)]),
    ("timemap_non_200", "x", f"q s {STAMP} http://a.com/ t - d 9", ["no_response"]),
    ("split_journal", "x", json.dumps({"domain": "a.com", "year": 1998, "message_id": "<1@x>", "group": "alt.b"}), [("a.com", 1998, "alt.b <1@x>", "https://archive.org/details/usenet-alt")]),
    ("split_journal", "x", "{broken", ["unparseable_line"]),
    ("split_journal", "x", json.dumps({"domain": "a.com", "year": 2020}), ["malformed"]),
    ("pasted_registrations", "x", json.dumps({"domain": "a.com", "year": 1998, "created": "1997-01-01"}), ["created_year_mismatch"]),
    ("pasted_registrations", "x", json.dumps({"domain": "a.com", "year": 1998, "created": "1998-01-01", "group": "g"}), [("a.com", 1998, "record created 1998-01-01 pasted in g", None)]),
    ("registry_items", "x", json.dumps({"host": "A.dk", "year": 2001, "text": "header 20011217"}), [("a.dk", 2001, "20011217: header 20011217", None)]),
    ("registry_items", "x", json.dumps({"host": "A.dk", "year": 2000, "text": "header 20011217"}), ["stamp_does_not_name_the_year"]),
    ("dispute_proceedings", "x", json.dumps({"domain": "a.com", "year": 2000, "proceeding": "D2000-1", "commenced": "2000-02-01"}), [("a.com", 2000, "commenced 2000-02-01 UDRP D2000-1", None)]),
    ("dispute_proceedings", "x", json.dumps({"domain": "a.com", "year": 2000, "commenced": "2000-02-01"}), ["missing_identifier"]),
    ("host_survey", "survey-9607.domains", "1.2.3.4 h.a.com", [("h.a.com", 1996, "1996-07", None)]),
    ("host_survey", "survey.txt", "a.com", ["unparsed_filename"]),
    ("host_survey", "s-9501", "a.com", ["out_of_window_file"]),
    ("dated_blocklist", "junkfilter-dated.20010528.txt", " a.com ", [("a.com", 2001, "junkfilter:20010528", None)]),
    ("tar_blocklist", "other.txt", "a.com", ["not_a_chastity_lane"]),
    ("hosted_zones", "granitecanyon-cand.20030528.txt", "a.com", ["edition_out_of_window"]),
    ("country_listing", "cctldcap-dated.sa.2001.txt", "a.sa", [("a.sa", 2001, "cctld_capture:sa:2001", None)]),
    ("federal_filings", "fac-dated.1998.tsv", "a.com\t1999", [("a.com", 1999, "fac_signature:1999", None)]),
    ("expiring_names", "x", "a.com\t25-OCT-01", [("a.com", 2001, "namewinner_expiring:25-OCT-01", None)]),
    ("expiring_names", "x", "a.com\t25-XXX-01", ["unparseable_month"]),
    ("expiring_names", "x", "heading", ["not_a_data_row"]),
    ("delegated_zones", "us-domain-delegated.19990101.txt", "CA  sf.ca.us. someone@b.com", [("sf.ca.us", 1999, "us_domain_delegated:19990101", None)]),
    ("delegated_zones", "us-domain-delegated.19990101.txt", "nothing", ["not_a_zone_row"]),
    ("creation_dates", "x", "a.com;com;n;r;1999-01-02;;;;", [("a.com", 1999, "registry created 1999-01-02", "https://lookup.icann.org/en/lookup?q=a.com")]),
    ("creation_dates", "x", "a.xn--p1ai;x;n;r;1999-01-02;;;;", ["idn_tld_out_of_window"]),
    ("creation_dates", "x", "domain;tld;dnssec;registrar;created_at", ["no_creation_date"]),
    ("host_year_census", "x", "a.com\t1998\t12", [("a.com", 1998, "ia_captures:1998:12", "https://web.archive.org/web/1998*/http://a.com/")]),
    ("host_year_census", "x", "a.com\t1998", ["malformed"]),
    ("cdxj", "x", f'pt,a)/ {STAMP} {{"url": "http://a.pt/", "status": "200"}}', [("http://a.pt/", 1997, STAMP, f"https://arquivo.pt/wayback/{STAMP}/http://a.pt/")]),
    ("cdxj", "x", f"pt,a)/ {STAMP} {{oops", ["malformed"]),
    ("cdxj", "x", f'pt,a)/ {STAMP} {{"url": "http://a.pt/"}}', ["non_200"]),
    ("link_source", "x", "1999|a.co.uk|b.com\t7", [("a.co.uk", 1999, "host_link_graph:1999", None)]),
    ("link_target", "x", "1999|a.co.uk|b.com\t7", [("b.com", 1999, "host_link_graph:1999", None)]),
    ("link_target", "x", "2004|a.co.uk|b.com\t7", ["out_of_window"]),
    ("geo_index", "x", f"{STAMP}/http://a.uk/x\tAB1", [("http://a.uk/x", 1997, STAMP, f"https://web.archive.org/web/{STAMP}/http://a.uk/x")]),
    ("registration_span", "x", "a.fr;1;2;3;4;5;6;7;8;9;01-02-1995;03-04-1998", [("a.fr", y, "registered 01-02-1995..03-04-1998", None) for y in (1996, 1997, 1998)]),
    ("registration_span", "x", "a.fr;1;2;3;4;5;6;7;8;9;01-02-2000;", [("a.fr", y, "registered 01-02-2000..active", None) for y in (2000, 2001)]),
    ("registration_span", "x", "a.fr;1;2;3;4;5;6;7;8;9;01-02-2005;", ["out_of_window"]),
    ("registration_span", "x", "n;1;2;3;4;5;6;7;8;9;created;gone", ["no_creation_date"]),
    ("registration_lookup", "x", json.dumps({"domain": "a.com", "creation_year": 1997}), [("a.com", 1997, "rdap creation 1997", None)]),
    ("registration_lookup", "x", json.dumps({"domain": "a.com", "creation_year": 1990}), ["outside_window"]),
    ("registration_lookup", "x", json.dumps({"domain": "a.com"}), ["not_dated"]),
    ("index_snapshot", "x", json.dumps({"domain": "A.com", "status": 200, "years": [1997, 1998, 2005], "stamps": {"1997": STAMP}}), [("A.com", 1997, f"cdx capture {STAMP} a.com", None), ("A.com", 1998, "cdx capture 1998", None)]),
    ("index_snapshot", "x", json.dumps({"domain": "a.com", "status": 503}), ["query_failed"]),
    ("index_snapshot", "x", json.dumps({"domain": "a.com", "status": 200, "years": []}), ["no_capture_in_window"]),
    ("page_links", "x", json.dumps({"page_url": "http://p/", "status": 200, "timestamp": STAMP, "year": 1997, "domains": ["a.com", "b.com"]}), [("a.com", 1997, f"linked from http://p/ captured {STAMP}", None), ("b.com", 1997, f"linked from http://p/ captured {STAMP}", None)]),
    ("directory_links", "x", json.dumps({"page_url": "http://p/", "status": 200, "year": 1997, "domains": ["a.com"]}), ["other_half"]),
    ("announcements", "x", "a.com\t1996-03-01", [("a.com", 1996, "ncsa whats-new entry 1996-03-01", None)]),
    ("announcements", "x", "a.com", ["no_date"]),
]


@pytest.fixture(scope="module")
def parsed(spark):
    """One job: the union of every case's records, by the case's number."""
    out = None
    for name in {c[0] for c in CASES}:
        mine = [(c[2], f"{i}|{c[1]}") for i, c in enumerate(CASES) if c[0] == name]
        df = spark.createDataFrame(mine, "value string, tag string").withColumn("file_name", F.split_part("tag", F.lit("|"), F.lit(2)))
        for value, tag in mine:
            one = formats.FORMATS[name](df.where(F.col("tag") == tag).drop("tag")).withColumn("at", F.lit(int(tag.split("|")[0])))
            out = one if out is None else out.unionByName(one)
    rows: dict[int, list] = {}
    for r in out.collect():
        rows.setdefault(r["at"], []).append(r)
    return rows


@pytest.mark.parametrize("at", range(len(CASES)), ids=[f"{i}-{c[0]}" for i, c in enumerate(CASES)])
def test_line(parsed, at):
    want = CASES[at][3]
    got = parsed[at]
    if isinstance(want[0], str):
        assert [r["drop"] for r in got] == want
    else:
        assert all(r["drop"] is None for r in got)
        assert sorted((r["raw"], r["year"], r["evidence_value"]) for r in got) == sorted(w[:3] for w in want)
        assert all(w[3] is None or w[3] in {r["evidence_url"] for r in got} for w in want)


def test_scans(spark, tmp_path):
    (tmp_path / "1997.txt").write_bytes(b" A.com \r\n\nb.com\n")
    (tmp_path / "1998.txt").write_bytes(b"c.com\n")
    (tmp_path / "1999.txt.part").write_bytes(b"no.com\n")
    got = scan.year_lists(spark, str(tmp_path)).collect()
    assert sorted((r["name"], r["year"]) for r in got) == [("a.com", 1997), ("b.com", 1997), ("c.com", 1998)]
    (tmp_path / "j.jsonl").write_text('{"url": "u", "status": null}\nbroken\n{"url": "v"}\n')
    good, bad = scan.journal(spark, str(tmp_path / "j.jsonl"), "url string, status string")
    assert sorted((r["url"], r["has"]) for r in good.withColumn("has", scan.has_key(F.col("raw"), "status")).collect()) == [("u", True), ("v", False)]
    assert bad.count() == 1
