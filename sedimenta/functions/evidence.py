"""What an evidence row shows: its kind, the host it names, whether it may back a year. Everything is Column -> Column.

A row is read once by `parsed`, whose struct the predicates test; none of them is ever null, so `~predicate` is safe.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Evidence types and the acquisition methods that show a host serving the web.
MASTER_TYPES = ("cdx_timestamp", "artifact_listing", "link_source", "dated_directory", "whois_creation")
CANDIDATE_TYPES = ("link_target",)
CAPTURE_METHODS = (
    "ia_cdx_collapsed_query", "ia_cdx_domain_sweep", "ia_cdx_year_query", "ia_cdx_gap_hostgrain", "bulk_cdx_file", "wayback_availability",
    "nypw_timemap", "nypw_timemap_hostgrain", "nypw_firstcdx_hostgrain", "nypw_first_capture_index", "arquivo_cdxj", "arquivo_ia_cdxj_hostgrain",
    "poland_pl_extract_hostgrain", "early_web_hostgrain", "attrition_defacement_mirror_index",
)
KINDS = {
    "link graph": ("ukwa_host_link_graph", "ukwa_hostgrain", "bl_geoindex_extract", "page_link_host"),
    "dataset": ("crawl_list_node", "httparchive_har_entry", "copyright_registration_host"),
    "dated bookmark entry": ("bookmark_entry_host",),
    "referrer": ("page_referrer_host",),
    "proxy origin-server list": ("proxy_origin_host",),
}
#: Admitted by the status in its value, not by its name.
STATUS_METHOD = "nypw_timemap_non_200"
MIRROR_METHOD = "attrition_defacement_mirror_index"
WEB_METHODS = CAPTURE_METHODS + tuple(m for methods in KINDS.values() for m in methods)
MARKS = ("replay failed", "link withdrawn", "session name")

# The formats of an evidence value that name their host last.
NAMED_LAST = (
    r"cdx capture [0-9]{14} (status [0-9]{3} )?(replay failed )?[^ ]+",
    r"host_link_graph:[0-9]{4} [^ ]+",
    r"page link [0-9]{4} https?://[^ ]+#(arc [0-9]+ [0-9]+|replay) #[0-9]{14} [^ ]+ [^ ]+",
    r"bookmark entry [0-9]{4} https?://[^ ]+#replay #[0-9]{14} line [0-9]+ (ADD_DATE|LAST_VISIT) [0-9]+ [0-9]{8} [^ ]+",
    r"page referrer [0-9]{4} https?://[^ ]+#(arc [0-9]+ [0-9]+ #)?[0-9]+ [^ ]+",
    r"copyright registration [0-9]{4} https?://[^ ]+#[A-Z]{1,4}[0-9]+ [^ ]+",
    r"proxy origin [0-9]{4} https?://[^ ]+#line [0-9]+ period [0-9]{8}-[0-9]{8} requests [0-9]+ bytes [1-9][0-9]* [^ ]+",
    r"har entry [0-9]{14} status [23][0-9]{2} [^ ]+",
)
#: Formats that end in a stamp; the host is the replay URL's, if that repeats the stamp.
STAMPED = r"((replay failed )?[0-9]{14}|nypw (first capture|timemap capture) (status [0-9]{3} )?(replay failed )?[0-9]{14})"
REPLAY_URL = r"^https?://[^/]+/(?:web|wayback)/([0-9]{14})/(?:[a-z][a-z0-9+.-]*://)?(?:[^/@]*@)?([^/:?#]+)"
MIRROR_URL = r"/mirror/[0-9]{4}/[0-9]{2}/[0-9]{2}/([^/]+)/?\z"


def _never_null(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def last_token(value: Column) -> Column:
    return F.element_at(F.split(value, " "), -1)


def exact_host(value: Column, url: Column, method: Column) -> Column:
    """The one host that the value's format names, in lower case; null where the format is none of these."""
    link = F.lower(url)
    replayed = F.nullif(F.rtrim(F.regexp_extract(link, REPLAY_URL, 2), F.lit(".")), F.lit(""))
    same_stamp = F.regexp_extract(link, REPLAY_URL, 1) == F.right(value, F.lit(14))
    return (
        F.when(value.rlike(f"^(?:{'|'.join(NAMED_LAST)})\\z"), F.lower(last_token(value)))
        .when(value.rlike(f"^{STAMPED}\\z") & same_stamp, replayed)
        .when(method == MIRROR_METHOD, F.nullif(F.regexp_extract(link, MIRROR_URL, 1), F.lit("")))
    )


def marked(value: Column) -> Column:
    """A review took the row back: its replay failed, its link was withdrawn, or its name is a session's."""
    return _never_null(value.rlike(f"(^| )({'|'.join(MARKS)})( |\\z)"))


def web_evidence(value: Column, method: Column) -> Column:
    """The row shows a host serving the web. Unknown methods don't; error captures and marked rows don't."""
    listed = method.isin(*WEB_METHODS) & ~value.rlike(r"(^| )status [45][0-9][0-9]( |\z)")
    answered = (method == STATUS_METHOD) & F.regexp_extract(value, r"status (\d{3})", 1).rlike(r"^[23]")
    return _never_null((listed | answered) & ~marked(value))


def kind(method: Column) -> Column:
    out = None
    for name, methods in KINDS.items():
        test = method.isin(*methods)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.when(method.isin(*CAPTURE_METHODS, STATUS_METHOD), "capture")


def named_host(value: Column, url: Column, method: Column, domain: Column) -> Column:
    """The exact host, or else the last token if it lies below the row's domain."""
    token = last_token(value)
    return F.coalesce(exact_host(value, url, method), F.when(F.endswith(token, F.concat(F.lit("."), domain)), token))


def parsed(value="evidence_value", url="evidence_url", method="acquisition_method", domain="domain") -> Column:
    """struct(host, named, web, kind, marked): all that the predicates below need, read once a row."""
    v, u, m, d = (F.col(c) for c in (value, url, method, domain))
    return F.struct(
        exact_host(v, u, m).alias("host"), named_host(v, u, m, d).alias("named"), web_evidence(v, m).alias("web"), kind(m).alias("kind"), marked(v).alias("marked")
    )


def qualifies(ev: Column, name: Column) -> Column:
    """Web evidence of exactly this name."""
    return _never_null(ev["web"] & (ev["host"] == name))


def qualifies_own(ev: Column) -> Column:
    return _never_null(ev["web"] & ev["host"].isNotNull())


def subject(ev: Column, domain: Column) -> Column:
    """What the row is about: the host it names, else its domain. Rows of a class are told apart by it."""
    return F.coalesce(ev["named"], domain)


def names_another_host(ev: Column, domain: Column) -> Column:
    """Such a row never dates the domain."""
    return _never_null(ev["named"] != domain)


def master(evidence_type: Column) -> Column:
    return _never_null(~evidence_type.isin(*CANDIDATE_TYPES))
