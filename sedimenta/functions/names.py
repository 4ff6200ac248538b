"""Names: hosts out of URLs, registrable names, refusal reasons. Everything is Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABEL = r"^[a-z0-9_]([a-z0-9_-]{0,61}[a-z0-9_])?\z"
STRICT_LABEL = r"^[a-z0-9]([a-z0-9-]{0,61}[a-z0-9])?\z"
HOSTNAME = r"^(?=.{1,253}\z)[a-z0-9]([a-z0-9-]{0,61}[a-z0-9])?(\.[a-z0-9]([a-z0-9-]{0,61}[a-z0-9])?)*\.[a-z]{2,63}\z"

# Generic suffixes, and suffixes that were retired.
GENERIC = "com net org edu gov mil int arpa info biz name pro aero coop museum asia cat jobs mobi post tel travel".split()
RETIRED = "yu ac.yu co.yu edu.yu gov.yu org.yu an com.an edu.an net.an org.an bu cs dd gb tp um zr com.zr".split()
#: Second levels that countries register below, by the words used; `*` stands for any label.
SECOND_LEVELS = {
    "com net org edu gov": "ar au br cn co cy eg gr hk mt mx my ng pe ph pk pl pt ru sg tr tw ua ve vn",
    "co ac or go ne": "jp kr th cr at id",
    "co ac org gov net": "uk nz za il in zw ke",
    "ltd plc me nhs sch police mod": "uk",
    "ad ed gr lg": "jp",
    "ac geek gen govt iwi maori school": "nz",
    "asn id": "au",
    "nom mil web law": "za",
    "ind mil adv art eng med": "br",
    "ac mil bj sh": "cn",
    "gob": "mx ar pe ve",
    "re pe": "kr",
    "in mi": "th",
    "msk spb": "ru",
    "idv": "hk tw",
    "muni k12": "il",
    "*": "ck er fj fk jm kh mm np pg bd",
}


def suffix_rules(text: str | None = None) -> list[tuple[str, str]]:
    """(suffix, kind) with kind plain, wild (any label below it is a suffix) or except, from a list in the public format
    (a rule a line, `*.` before a wild one, `!` before an exception, `//` before a comment); without a list, the rules above, with every
    two-letter label a suffix."""
    if text is None:
        below = [(word, country) for words, countries in SECOND_LEVELS.items() for word in words.split() for country in countries.split()]
        return [(x, "plain") for x in GENERIC + RETIRED] + [(c if w == "*" else f"{w}.{c}", "wild" if w == "*" else "plain") for w, c in dict.fromkeys(below)] + [("", "country")]
    out = []
    for line in text.splitlines():
        rule = line.split("//")[0].strip().lower()
        if rule.startswith("!"):
            out.append((rule[1:], "except"))
        elif rule.startswith("*."):
            out.append((rule[2:], "wild"))
        elif rule:
            out.append((rule, "plain"))
    return out + [(x, "plain") for x in RETIRED]


def unquoted(raw: Column) -> Column:
    """%XX decoded as UTF-8; a percent sign that begins no such code stays, and so does a plus sign."""
    safe = F.regexp_replace(F.regexp_replace(raw, "%(?![0-9A-Fa-f]{2})", "%25"), r"\+", "%2B")
    return F.when(raw.contains("%"), F.try_url_decode(safe)).otherwise(raw)


def host(raw: Column) -> Column:
    """Percent codes are read; scheme, `//`, path, query, fragment, user and port go; case, outer white space, dots and commas at the ends too."""
    h = F.lower(F.regexp_replace(unquoted(raw), r"^\s+|\s+\z", ""))
    h = F.regexp_replace(h, r"^([a-z][a-z0-9+.-]*:)?//", "")
    h = F.regexp_replace(h, r"(?s)[/?#].*\z", "")
    h = F.regexp_replace(h, r"^.*@", "")
    h = F.regexp_replace(h, r":[0-9]+\z", "")
    return F.regexp_replace(h, r"^[.,]+|[.,]+\z", "")


def capture_host(url: Column) -> Column:
    """The host of a capture's address at host grain: strict labels and a last one of letters; null for any other."""
    rest = F.regexp_replace(url, r"(?s)^.*?://", "")
    found = F.rtrim(F.lower(F.trim(F.regexp_replace(rest, r"(?s)[/:].*\z", ""))), F.lit("."))
    return F.when(found.rlike(HOSTNAME), found)


def labels(name: Column) -> Column:
    return F.split(name, r"\.")


def tld(name: Column) -> Column:
    return F.element_at(labels(name), -1)


def is_ipv4(name: Column) -> Column:
    return name.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}\z")


def refusal(name: Column) -> Column:
    """Why a host can't be reduced to a registrable name by its form; null where nothing speaks against it."""
    return (
        F.when(F.coalesce(name, F.lit("")) == "", "empty")
        .when(is_ipv4(name), "ip address")
        .when(name.rlike(r"\.(in-addr|ip6)\.arpa\z"), "reverse dns")
        .when(F.length(name) > 253, "too long")
        .when(F.exists(labels(name), lambda x: ~x.rlike(LABEL)), "bad label")
        .when(F.size(labels(name)) < 2, "single label")
    )


def doubled_suffix(name: Column, k: int) -> Column:
    """The last k labels repeat the k before them."""
    parts = labels(name)
    return (F.size(parts) >= 2 * k) & (F.slice(parts, -k, k) == F.slice(parts, F.greatest(F.lit(-2 * k), -F.size(parts)), k))


def reduced(names: DataFrame, column: str, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """names with `registrable` (null where there is none) and `refused` (why; null where nothing is wrong).

    Works on distinct names: each is exploded to its suffixes and joined to the rules, so cost follows distinct hosts. An exception rule wins,
    else the longest rule; the rules are a list of known size, given by the caller or the default.
    """
    rules = suffix_rules() if rules is None else rules
    table = F.broadcast(names.sparkSession.createDataFrame([r for r in rules if r[1] != "country"], "suffix string, kind string"))
    parts = labels(F.col(column))
    one = names.select(column).distinct().where(F.col(column).isNotNull())
    cut = one.select(column, F.posexplode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))).alias("at", "suffix"))
    found = cut.join(table, "suffix", "left")
    if any(kind == "country" for _, kind in rules):
        found = found.withColumn("kind", F.coalesce("kind", F.when(F.col("suffix").rlike(r"^[a-z]{2}\z"), "plain")))
    begin = F.when(F.col("kind") == "plain", F.col("at")).when((F.col("kind") == "wild"), F.greatest(F.col("at") - 1, F.lit(0)))
    longest = found.groupBy(column).agg(F.coalesce(F.max(F.when(F.col("kind") == "except", F.col("at") + 1)), F.min(begin)).alias("at"))
    label = F.get(parts, F.col("at") - 1)
    form = refusal(F.col(column))
    reason = (
        F.when(form != "single label", form).when(F.col("at").isNull(), "no known suffix").when(F.col("at") <= 0, "bare suffix")
        .when(~label.rlike(STRICT_LABEL), "bad registered label")
    )
    named = longest.select(column, F.when(reason.isNull(), F.array_join(F.slice(parts, F.greatest("at", F.lit(1)), F.size(parts)), ".")).alias("registrable"), reason.alias("refused"))
    return names.join(named, column, "left").withColumn("refused", F.coalesce("refused", F.when(F.coalesce(F.col(column), F.lit("")) == "", "empty")))


def registrable(names: DataFrame, column: str, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """names with `registrable`: the longest known suffix and one label more; null where there is none."""
    return reduced(names, column, rules).drop("refused")


def change_reason(raw: Column, normal: Column) -> Column:
    """Why a kept line differs from its original."""
    low = F.lower(F.trim(raw))
    return (
        F.when(F.regexp_replace(low, r"^[.,]+|[.,]+\z", "") == normal, "case, trailing dot or separator punctuation")
        .when(low == F.concat(F.lit("www."), normal), "www prefix removed")
        .when(F.endswith(low, F.concat(F.lit("."), normal)), "subdomain collapsed to registered domain")
        .otherwise("url parts or encoding normalized")
    )


def resolved(href: Column, page: Column) -> Column:
    """A link as an absolute http address, by the address of its page; null for other schemes and for what leads nowhere else."""
    link = F.regexp_replace(F.regexp_replace(F.trim(href), r"#.*\z", ""), r"[\t\n\r]", "")
    scheme = F.lower(F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    root = F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_replace(F.regexp_replace(F.substring(page, F.length(root) + 1, F.length(page)), r"[?#].*\z", ""), r"[^/]*\z", "")
    path = F.when(path == "", "/").otherwise(path)
    bare = F.regexp_replace(F.regexp_replace(page, r"#.*\z", ""), r"\?.*\z", "")
    joined = (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(link.startswith("?"), F.concat(bare, link))
        .otherwise(F.concat(root, path, link))
    )

    def shorter(url: Column, _: Column) -> Column:
        url = F.regexp_replace(url, r"(?<![:/])/\.(?=/|\z)", "")
        url = F.regexp_replace(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)/\.\.(?=/|\z)", "$1")
        return F.regexp_replace(url, r"(?<=[^/:])/(?!\.\.?(?:/|\z))[^/?]+/\.\.(?=/|\z)", "")

    # Dot segments, as often as there may be any; a fold keeps the generated code small.
    dots = F.sequence(F.lit(1), F.size(F.split(joined, r"/\.")))
    joined = F.when(joined.contains("/."), F.aggregate(dots, joined, shorter)).otherwise(joined)
    return F.when((link != "") & joined.rlike(r"^(?i)https?://[^/]"), joined)
