"""Canonical form of URLs as column expressions, with the same rules in SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query keys that only track visits, beside every key that starts with utm_.
TRACKING_KEYS = ("fbclid", "gclid", "mc_cid", "mc_eid", "ref", "source")


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no `www.`, user or fragment, single slashes, no final slash, no tracking keys; null stays null."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    scheme = F.lower(F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    rest = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*:(?=//)", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^//(?:[^/?]*@)?([^/?@]*)", 1)), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(F.regexp_extract(rest, r"^(?://[^/?]*)?([^?]*)", 1), r"/{2,}", "/"), r"(?<=[^/])/$", "")
    path = F.when(path == "", F.lit("/")).otherwise(path)
    pairs = F.filter(F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~F.lower(F.substring_index(p, "=", 1)).rlike(rf"^(utm_.*|{'|'.join(TRACKING_KEYS)})$"))
    query = F.array_join(F.transform(pairs, lambda p: F.when(p.contains("="), p).otherwise(F.concat(p, F.lit("=")))), "&")
    return F.when(url.isNotNull(), F.concat(F.when(scheme == "", F.lit("https")).otherwise(scheme), F.lit("://"), host, path, F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query))))


def canonical_url_sql(url: str) -> str:
    """The same expression in DuckDB SQL."""
    bare = f"regexp_replace(trim({url}), '#.*$', '')"
    scheme = f"lower(regexp_extract({bare}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"
    rest = f"CASE WHEN regexp_matches({bare}, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN substr({bare}, strpos({bare}, ':') + 1) ELSE {bare} END"
    host = f"regexp_replace(lower(regexp_extract({rest}, '^//(?:[^/?]*@)?([^/?@]*)', 1)), '^www\\.', '')"
    path = f"regexp_replace(regexp_replace(regexp_extract({rest}, '^(?://[^/?]*)?([^?]*)', 1), '/{{2,}}', '/', 'g'), '([^/])/$', '\\1')"
    pairs = f"list_filter(string_split(regexp_extract({rest}, '\\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_full_match(lower(split_part(p, '=', 1)), 'utm_.*|{'|'.join(TRACKING_KEYS)}'))"
    query = f"array_to_string(list_transform({pairs}, lambda p: CASE WHEN contains(p, '=') THEN p ELSE p || '=' END), '&')"
    return f"(CASE WHEN {url} IS NOT NULL THEN coalesce(nullif({scheme}, ''), 'https') || '://' || {host} || coalesce(nullif({path}, ''), '/') || CASE WHEN {query} = '' THEN '' ELSE '?' || {query} END END)"


# Public suffixes of two labels.
TWO_LABEL_SUFFIXES = (
    "com.cn", "net.cn", "org.cn", "gov.cn", "edu.cn", "ac.cn", "co.uk", "org.uk", "ac.uk", "gov.uk", "me.uk", "net.uk", "co.jp", "or.jp",
    "ne.jp", "ac.jp", "go.jp", "com.au", "net.au", "org.au", "edu.au", "gov.au", "co.kr", "or.kr", "com.hk", "org.hk", "com.tw", "org.tw",
    "com.sg", "com.br", "com.mx", "co.in", "co.nz", "co.za",
)


def url_host(url: Column) -> Column:
    """Host of a URL in lower case without `www.` and port; empty where there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#@:]*)", 1)), r"^www\.", "")


def url_host_sql(url: str) -> str:
    return f"regexp_replace(lower(regexp_extract(trim({url}), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#@:]*)', 1)), '^www\\.', '')"


def registrable_domain(url: Column) -> Column:
    """The domain under the public suffix; null without a host."""
    labels = F.split(url_host(url), r"\.")
    keep = F.when(F.array_join(F.slice(labels, -2, 2), ".").isin(*TWO_LABEL_SUFFIXES), 3).otherwise(2)
    return F.when(url_host(url) != "", F.when(F.size(labels) <= keep, F.array_join(labels, ".")).when(keep == 3, F.array_join(F.slice(labels, -3, 3), ".")).otherwise(F.array_join(F.slice(labels, -2, 2), ".")))


def registrable_domain_sql(url: str) -> str:
    labels = f"string_split({url_host_sql(url)}, '.')"
    suffixes = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
    keep = f"CASE WHEN array_to_string({labels}[-2:], '.') IN ({suffixes}) THEN 3 ELSE 2 END"
    return f"(CASE WHEN {url_host_sql(url)} <> '' THEN array_to_string({labels}[-({keep}):], '.') END)"


def allowed_fetch(url: Column) -> Column:
    """A URL that may be fetched: https, no credentials, a host that is neither local nor a private or reserved IPv4 address."""
    text = F.trim(url)
    host = url_host(url)
    private = r"^(localhost|.*\.localhost|.*\.local|0\..*|10\..*|127\..*|169\.254\..*|192\.168\..*|172\.(1[6-9]|2\d|3[01])\..*|100\.(6[4-9]|[7-9]\d|1[01]\d|12[0-7])\..*|22[4-9]\..*|2[3-5]\d\..*)$"
    return F.coalesce(F.lower(text).startswith("https://") & ~text.rlike(r"^[^/]*//[^/?#]*@") & (host != "") & ~host.rlike(private), F.lit(False))


def origin(url: Column) -> Column:
    """Scheme, host and port of a URL, the scheme's own port where none is given; null without scheme or host."""
    text = F.trim(url)
    scheme = F.lower(F.regexp_extract(text, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.lower(F.regexp_extract(text, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#@:]+)", 1))
    port = F.regexp_extract(text, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?[^/?#@:]+:([0-9]+)", 1)
    given = F.when(port != "", port).when(scheme == "https", "443").when(scheme == "http", "80").otherwise("")
    return F.when((scheme != "") & (host != ""), F.concat_ws("|", scheme, host, given))
