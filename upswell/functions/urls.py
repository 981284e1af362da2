"""URL expressions: hosts, registrable domains, canonical form, link safety."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from upswell import config as C
from upswell.functions.text import SPACE, contains_any, extract, null_if_blank, strip, text_or_empty

HREF = r"""href=["'](https?://[^"']+)["']"""
HEAD_PATTERN = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/]*)?"
URL_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


# A scheme in front, or no scheme anywhere; then an optional user part; then the host.
HOST_PATTERN = rf"(?s)^{SPACE}*(?:[a-z][a-z0-9+.\-]*://|(?!.*://))(?:[^/?#]*@)?([^:/?#]*)"
REGISTRABLE_PATTERN = (
    r"((?:[^.]*\.)?(?:" + "|".join(re.escape(x) for x in C.TWO_PART_SUFFIXES) + r")|[^.]*\.[^.]*|[^.]+)$"
)


def host(c: Column) -> Column:
    """Lower-cased host without user, port or path; the scheme may be missing."""
    return null_if_blank(strip(F.regexp_extract(F.lower(c), HOST_PATTERN, 1)))


def registrable(host_name: Column) -> Column:
    """Last two labels of a host, or three under a known two-part suffix."""
    return extract(host_name, REGISTRABLE_PATTERN, 1)


def registrable_domain(c: Column) -> Column:
    return registrable(host(c))


def parent_domains(domain: Column) -> Column:
    """``a.b.c`` -> ``[a.b.c, b.c, c]``."""
    labels = F.split(domain, r"\.")
    n = F.size(labels)
    return F.transform(
        F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n - i + F.lit(1)), ".")
    )


def denylisted(domain: Column, denylist: Iterable[str] | None = None) -> Column:
    """The domain, or a parent of it, is on the list: one set lookup per label count."""
    names = set(denylist) if denylist is not None else {d for ds in C.DENYLIST.values() for d in ds}
    by_labels: dict[int, list[str]] = {}
    for name in sorted(names):
        by_labels.setdefault(name.count(".") + 1, []).append(name)
    low = F.lower(domain)
    hits = [F.substring_index(low, ".", -k).isin(listed) for k, listed in sorted(by_labels.items())]
    return F.coalesce(reduce(lambda a, b: a | b, hits), F.lit(False))


def url_path(c: Column) -> Column:
    """Path of an absolute URL; a bare path is returned up to its query."""
    return F.when(c.contains("://"), F.regexp_extract(c, URL_PARTS, 3)).otherwise(F.split(c, r"\?").getItem(0))


def has_asset_extension(c: Column) -> Column:
    pattern = r"\.(?:" + "|".join(C.ASSET_EXTENSIONS) + ")$"
    return F.coalesce(F.lower(url_path(c)).rlike(pattern), F.lit(False))


def is_tracking(c: Column) -> Column:
    return F.coalesce(contains_any(F.lower(c), C.TRACKING_MARKERS), F.lit(False))


def is_non_html(content_type: Column) -> Column:
    """Content types that cannot be a page; a missing type passes."""
    pattern = "^(?:" + "|".join(re.escape(p) for p in C.NON_HTML_TYPES) + ")"
    return F.coalesce(F.trim(F.lower(content_type)).rlike(pattern), F.lit(False))


def _encode(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def _sorted_query(query: Column) -> Column:
    pairs = F.filter(F.split(query, "&"), lambda p: p.rlike("^[^=]*=."))
    decoded = F.transform(
        pairs,
        lambda p: F.struct(
            _decode(F.substring_index(p, "=", 1)).alias("k"),
            _decode(F.regexp_extract(p, "(?s)=(.*)$", 1)).alias("v"),
        ),
    )
    kept = F.filter(decoded, lambda p: ~F.lower(p["k"]).isin(C.TRACKING_QUERY_KEYS))
    return F.array_join(
        F.transform(F.sort_array(kept), lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&"
    )


def canonical_url(c: Column) -> Column:
    """Scheme and host lower-cased, fragment and tracking keys dropped, the other
    query pairs sorted, trailing slashes of the path cut (an empty path is ``/``).

    Only the query stands in a branch: what is read several times outside of one is computed once a row.
    """
    whole = F.substring_index(strip(text_or_empty(c)), "#", 1)
    base = F.substring_index(whole, "?", 1)
    head = F.regexp_extract(base, HEAD_PATTERN, 0)
    path = F.rtrim(F.substr(base, F.length(head) + 1), F.lit("/"))
    path = F.when(path != "", path).when(text_or_empty(c) == "", F.lit("")).otherwise(F.lit("/"))
    query = F.when(whole.contains("?"), F.regexp_replace(_sorted_query(F.substr(whole, F.length(base) + 2)), "(?s)^(?=.)", "?"))
    return F.concat(F.lower(head), path, F.coalesce(query, F.lit("")))


def absolute_links(html: Column) -> Column:
    """All absolute href values in page order, query strings cut."""
    found = F.regexp_extract_all(text_or_empty(html), F.lit(HREF), F.lit(1))
    return F.transform(found, lambda u: F.regexp_replace(u, r"(?s)\?.*$", ""))


def all_hrefs(html: Column) -> Column:
    return F.regexp_extract_all(text_or_empty(html), F.lit(r"""(?i)href=["']([^"']*)["']"""), F.lit(1))


def href_verdict(url: Column, http_hosts: Iterable[str] = ()) -> Column:
    """``safe`` for https or an allowed http host; otherwise why it is not."""
    v = strip(text_or_empty(url))
    low = F.lower(v)
    scheme = F.regexp_extract(low, r"^([a-z][a-z0-9+.\-]*):", 1)
    dangerous = "^(?:" + "|".join(C.DANGEROUS_SCHEMES) + "):"
    allowed = list(http_hosts)
    http_ok = host(v).isin(allowed) if allowed else F.lit(False)
    return (
        F.when(low.rlike(dangerous), "dangerous_scheme")
        .when(scheme == "https", "safe")
        .when((scheme == "http") & http_ok, "safe")
        .when(scheme == "http", "plain_http")
        .otherwise("no_scheme")
    )
