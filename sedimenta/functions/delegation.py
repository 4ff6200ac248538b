"""Which top-level labels existed in which year, and which names may be shipped. Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sedimenta.functions import names

# The year a label was delegated, the generic labels of the whole window, the last year of a retired label (0: never).
DELEGATED = {
    "aero": 2001, "biz": 2001, "coop": 2001, "info": 2001, "museum": 2001, "name": 2001, "pro": 2002,
    "asia": 2007, "cat": 2005, "eu": 2005, "jobs": 2005, "mobi": 2005, "post": 2012, "tel": 2007, "travel": 2005,
    "ax": 2006, "bl": 2007, "bq": 2010, "cw": 2010, "me": 2007, "mf": 2007, "rs": 2007, "ss": 2011, "sx": 2010, "tl": 2005, "xk": 2016,
}
WINDOW_GENERIC = ("com", "net", "org", "edu", "gov", "mil", "int", "arpa")
RETIRED = {"an": 2011, "bu": 0, "cs": 1995, "dd": 0, "tp": 2015, "um": 2008, "yu": 2010, "zr": 2001}


def _of(table: dict[str, int], key: Column) -> Column:
    """A small fixed table as a literal map: no join."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def existed(tld: Column, year: Column) -> Column:
    """A host under tld could exist in year. Labels that nothing is known about fail."""
    delegated, retired = _of(DELEGATED, tld), _of(RETIRED, tld)
    country = (F.coalesce(delegated, F.lit(0)) <= year) & (year <= F.coalesce(retired, year))
    return (
        F.when(tld.isin(*WINDOW_GENERIC), tld != "arpa")
        .when(F.length(tld) == 2, country)
        .otherwise(F.coalesce(delegated <= year, F.lit(False)))
    )


def in_window_set(name: Column) -> Column:
    """The last label is a country's or one of the generic labels of the whole window."""
    tld = F.lower(names.tld(name))
    return (F.length(tld) == 2) | tld.isin(*WINDOW_GENERIC)


def delegated_by(name: Column, year: Column) -> Column:
    return F.coalesce(_of(DELEGATED, names.tld(name)) <= year, F.lit(True))


def _structure(name: Column) -> Column:
    reverse = name.like("%.arpa") | name.like("%.in-addr.arpa.%") | name.like("%.ip6.arpa.%")
    return ~reverse & ~name.rlike(r"^www\.[^.]+\z")


def ships_domain(name: Column, year: Column) -> Column:
    return F.coalesce(_structure(name) & in_window_set(name) & delegated_by(name, year), F.lit(False))


def ships_host(name: Column, year: Column) -> Column:
    """Hosts also fail when their last one to three labels are written twice."""
    doubled = names.doubled_suffix(name, 1) | names.doubled_suffix(name, 2) | names.doubled_suffix(name, 3)
    return ships_domain(name, year) & F.coalesce(~doubled, F.lit(False))


def ships_undated(name: Column) -> Column:
    return F.coalesce(_structure(name) & in_window_set(name), F.lit(False))
