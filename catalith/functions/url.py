"""Column functions over URLs.

Hosts and queries are read with regular expressions rather than ``parse_url``:
catalogue links hold raw Korean text, spaces and brackets, which a strict URI
parser rejects as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith.functions.text import _c

# Query keys whose values are secrets.
SECRET_QUERY_KEYS = (
    "servicekey", "apikey", "api_key", "authkey", "access_token", "token", "key",
    "authorization", "password", "signature", "x-amz-signature", "x-amz-credential",
    "x-amz-security-token",
)
# Hosts whose pages describe a licence, not a dataset.
LICENCE_HOSTS = ("www.kogl.or.kr", "kogl.or.kr", "ccl.cckorea.org", "creativecommons.org")


def stable_url(c: Column | str) -> Column:
    """The URL without a ``;jsessionid=`` segment."""
    return F.trim(F.regexp_replace(F.coalesce(_c(c), F.lit("")), "(?i);jsessionid=[^/?#;]+", ""))


def hostname(c: Column | str) -> Column:
    """Lower-case host of the URL, without user or port; null when absent."""
    authority = F.regexp_extract(_c(c), "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)
    bare = F.lower(F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), ":[0-9]*$", ""))
    return F.when(bare != "", bare)


def host(c: Column | str) -> Column:
    """Host without a leading ``www.``; empty text when there is none."""
    return F.regexp_replace(F.coalesce(hostname(c), F.lit("")), "^www\\.", "")


def url_path(c: Column | str) -> Column:
    return F.regexp_extract(_c(c), "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def query_string(c: Column | str) -> Column:
    return F.regexp_extract(_c(c), "^[^?#]*\\?([^#]*)", 1)


def _decoded(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def query_pairs(c: Column | str) -> Column:
    """Array of (key, value) of the query string, decoded, blanks kept."""
    pieces = F.filter(F.split(query_string(c), "&"), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(
        _decoded(F.substring_index(p, "=", 1)).alias("key"),
        _decoded(F.regexp_extract(p, "^[^=]*=(.*)$", 1)).alias("value")))


def query_param(c: Column | str, key: str) -> Column:
    """First non-empty value of ``key``; keys such as ``df[id]`` are literal."""
    hits = F.filter(query_pairs(c), lambda p: (p["key"] == key) & (p["value"] != ""))
    return F.get(hits, F.lit(0))["value"]


def _form_encode(c: Column) -> Column:
    # Form encoding leaves "~" alone and escapes "*"; Java's encoder does the reverse.
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def redact_url(c: Column | str, keys: tuple[str, ...] = SECRET_QUERY_KEYS) -> Column:
    """The URL with the value of every secret query key replaced.

    A URL without a secret value is returned byte for byte.  Otherwise the query
    is written again in form encoding with ``[REDACTED]`` in the secret places.
    """
    col = _c(c)
    written = F.array_join(F.transform(query_pairs(col), lambda p: F.concat(
        _form_encode(p["key"]), F.lit("="),
        _form_encode(F.when(_secret(p, keys), F.lit("[REDACTED]")).otherwise(p["value"])))), "&")
    head = F.regexp_extract(col, "^([^?#]*)", 1)
    fragment = F.regexp_extract(col, "(#.*)$", 1)
    return F.when(has_secret(col, keys), F.concat(head, F.lit("?"), written, fragment)).otherwise(col)


def _secret(pair: Column, keys: tuple[str, ...]) -> Column:
    return F.lower(pair["key"]).isin(*keys) & (pair["value"] != "")


def has_secret(c: Column | str, keys: tuple[str, ...] = SECRET_QUERY_KEYS) -> Column:
    """True when the URL is http(s) and carries a non-empty secret value."""
    col = _c(c)
    return F.coalesce(col.rlike("^https?://") & F.exists(query_pairs(col), lambda p: _secret(p, keys)), F.lit(False))


def reference_kind(c: Column | str) -> Column:
    """``license_reference`` / ``external_page_reference``; null for other schemes."""
    name = hostname(c)
    usable = _c(c).rlike("(?i)^https?://") & name.isNotNull()
    return F.when(usable, F.when(name.isin(*LICENCE_HOSTS), F.lit("license_reference"))
                  .otherwise(F.lit("external_page_reference")))


def site_key(c: Column | str) -> Column:
    """Canonical key of a site: host without ``www.`` plus path without a final slash."""
    authority = F.regexp_extract(_c(c), "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.concat(F.regexp_replace(F.lower(authority), "^www\\.", ""), F.regexp_replace(url_path(c), "/+$", ""))


def _no_dots(path: Column) -> Column:
    """Path with ``.`` and ``..`` segments resolved."""
    parts = F.split(path, "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, x: F.when(x == ".", acc).when(
        x == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(acc)
    ).otherwise(F.array_append(acc, x)))
    ends_in_dots = F.element_at(parts, -1).isin(".", "..")
    joined = F.array_join(kept, "/")
    return F.when(ends_in_dots & ~joined.endswith("/"), F.concat(joined, F.lit("/"))).otherwise(joined)


def resolve(base: Column, link: Column) -> Column:
    """Absolute URL of ``link`` found on the page ``base``."""
    scheme = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    root = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(F.when(url_path(base) == "", F.lit("/")).otherwise(url_path(base)), "^(.*/)", 1)
    tail = F.regexp_extract(link, "([?#].*)$", 1)
    path = F.regexp_extract(link, "^([^?#]*)", 1)
    return (F.when(link.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), link)
            .when(link.startswith("//"), F.concat(scheme, link))
            .when(path.startswith("/"), F.concat(root, _no_dots(path), tail))
            .when(link.startswith("?"), F.concat(root, url_path(base), link))
            .when(path == "", F.concat(F.regexp_extract(base, "^([^#]*)", 1), tail))
            .otherwise(F.concat(root, _no_dots(F.concat(folder, path)), tail)))
