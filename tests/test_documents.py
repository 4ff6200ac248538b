import pytest

from sedimenta.sources import documents, scan


def run(spark, tmp_path, name, files, encoding="UTF-8"):
    for file, text in files.items():
        (tmp_path / file).write_bytes(text if isinstance(text, bytes) else text.encode())
    at = [str(tmp_path / f) for f in files]
    if name in documents.PAGE_FORMATS:
        got = documents.PAGE_FORMATS[name](documents.pages(spark, at, encoding))
    elif name in documents.BLOCK_FORMATS:
        opening, f = documents.BLOCK_FORMATS[name]
        got = f(documents.blocks(spark, at, opening))
    else:
        got = documents.HEADER_FORMATS[name](scan.lines(spark, at))
    return sorted((r["drop"] or "", r["raw"] if not r["drop"] else "", r["year"] if not r["drop"] else 0, r["evidence_value"] if not r["drop"] else "") for r in got.collect())


def kept(*rows):
    return [("", *r) for r in rows]


def drops(*names):
    return [(n, "", 0, "") for n in names]


JP = "Registered Domains in JP (Jan 1 1998)\r\nx #\r\n--- CO domains: 2 (1)\r\nalpha # A\r\n(beta # 廃止\r\n--- JP domains: 1 (1)\r\nhost # B\r\n".encode("shift_jis")
CASES = [
    ("registry_sections", {"a": JP}, "Shift_JIS", kept(("alpha.co.jp", 1998, "jpnic register listing Jan 1 1998"), ("host.jp", 1998, "jpnic register listing Jan 1 1998")) + drops("abolished")),
    ("registry_sections", {"a": "nothing\nat all"}, "UTF-8", drops("no_header_stamp")),
    (
        "transcribed_registrations",
        {"a": '<B><a href="x">A.COM</a></b> Registered on: </i></font> Jun 28, 2001 by b.com <b>C.COM</b> none <b>D.COM</b> Dates of creation / x:</span> 25-May-1999 / 18-Jun-2002'},
        "UTF-8",
        kept(("A.COM", 2001, "edelman_whois_created:2001"), ("D.COM", 1999, "edelman_whois_created:1999")) + drops("no_creation_date"),
    ),
    ("change_report", {"r-1.html": "Domain Name Listing\nNew\tearly.com.my\n15 March 2001\nNew\tA.com.my\nDelete\t\tb.my\n1 May 2003\nNew\tc.my\n"}, "UTF-8", kept(("a.com.my", 2001, "mynic:r-1"), ("b.my", 2001, "mynic:r-1")) + drops("row_before_any_day_heading", "row_out_of_window")),
    ("change_report", {"r.html": "statistics"}, "UTF-8", drops("not_a_listing_page")),
    ("deletion_queue", {"co_za-todelsh-20010203040506.html": 'shortlisted for <A HREF="x?Domain=abc">abc</A><A HREF="x?Domain=abcdefghijklmnop"><A HREF="x?Domain=a_b">'}, "UTF-8", kept(("abc.co.za", 2001, "coza:todelsh:20010203040506")) + drops("label_malformed", "label_possibly_truncated")),
    ("deletion_queue", {"other.html": "x"}, "UTF-8", drops("not_a_coza_capture")),
    ("robot_blacklist", {"squidguard-ads-domains": "# compiled in 1:2 on 2001.02.03\na.com\n\nb.com/x\n"}, "UTF-8", kept(("a.com", 2001, "squidguard:ads/domains@20010203"), ("b.com/x", 2001, "squidguard:ads/domains@20010203")) + drops("comment_or_blank", "comment_or_blank")),
    ("robot_blacklist", {"squidguard-ads-urls.20010305.diff": "+a.com\n-b.com\nc.com\n"}, "UTF-8", kept(("a.com", 2001, "squidguard:ads/urls@20010305")) + drops("diff_context_line", "diff_removal_skipped")),
    ("country_register", {"cctld-idnic-id-20010102.html": "<td>A.co.id</td><td>01-Mei-1999</td><p>b.id x.com"}, "ISO-8859-1", kept(("a.co.id", 1999, "cctld_register:idnic.id@1999"), ("b.id", 2001, "cctld_register:idnic.id@20010102"))),
    ("register_letters", {"a-doms.html": "x.ie [A] <b>foo.ie</b> www.foo.ie bar.ie www.iedr.ie last updated on 21 December 2001"}, "UTF-8", kept(("bar.ie", 2001, "iedr register listing last updated on 21 December 2001"), ("foo.ie", 2001, "iedr register listing last updated on 21 December 2001")) + drops("registry_own_host")),
    ("register_letters", {"stalled.html": "foo.ie last updated 2001"}, "UTF-8", drops("not_a_register_page")),
    ("changed_short", {"r": "# head\n*dn: A.FI\n*ac: who@x 19990101\n*ch: who@x 19980315\n*ch: who@x 19980101\n*ch: q 19920101\n*dn: 1.in-addr.ARPA\n*ch: x 19980315\n"}, "UTF-8", kept(("A.FI", 1998, "ripe_changed:19980101")) + drops("changed_out_of_window", "reverse_zone_skipped")),
    ("changed_long", {"r": "domain: b.fi\nchanged: w@x 20000315\n"}, "UTF-8", kept(("b.fi", 2000, "ripe_changed:20000315"))),
    ("approval_notices", {"m": "From x\nSubdomain:      a.ca\nDate-Approved:  1999/06/30\nSubdomain: b.ca\nDate-Received: 1999/01/01\n"}, "UTF-8", kept(("a.ca", 1999, "ca_date_approved:19990630")) + drops("no_approval_date")),
    (
        "report_records",
        {"s": "<list>\n<record>\n<identifier>oai:1</identifier><dc:date>1998</dc:date><dc:identifier>http://a.com/</dc:identifier><dc:identifier>http://b.com/</dc:identifier></record><record><dc:date>1999</dc:date></record>"},
        "UTF-8",
        kept(("http://a.com/", 1998, "oai:1"), ("http://b.com/", 1998, "oai:1")) + drops("no_url"),
    ),
    (
        "zone_file",
        {"org.zone": "ORG. IN SOA a.b. c.d. (\n 1997061200 ;serial\n )\nORG. NS x.\nFOO.ORG. IN NS ns.bar.com.\nA.B.ORG. NS y.\nFOO.COM. NS z.\n"},
        "UTF-8",
        kept(("foo.org", 1997, "internic org zone serial 1997061200")) + drops("apex_delegation", "deeper_than_one_label", "owner_outside_zone"),
    ),
    ("database_snapshot", {"db": "# x\n# 990804 00:07:01\n*dn: A.FI\n*ac: someone\n*dn: 1.ARPA\n"}, "UTF-8", kept(("A.FI", 1999, "ripe_dbase:19990804")) + drops(*["attribute_discarded"] * 3, "reverse_zone_skipped")),
    ("directory_dump", {"kt200106.rdf": '<a about="http://a.com/"/>\n'}, "UTF-8", kept(("http://a.com/", 2001, "odp kt200106"))),
    ("directory_dump", {"c.rdf": '<!-- Generated at 2000-05-06 -->\n<l r:resource="http://a.com/"/><l r:resource="http://b.com/"/>\n'}, "UTF-8", kept(("http://a.com/", 2000, "odp 2000-05-06"), ("http://b.com/", 2000, "odp 2000-05-06"))),
]


@pytest.mark.parametrize("case", CASES, ids=[f"{i}-{c[0]}" for i, c in enumerate(CASES)])
def test_document(spark, tmp_path, case):
    name, files, encoding, want = case
    assert run(spark, tmp_path, name, files, encoding) == sorted(want)
