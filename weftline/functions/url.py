"""URL functions: Column in, Column out."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions.text import col

# Second-level labels that belong to the public suffix, and extensions not followed.
SUFFIX_LABELS = ("co", "com", "net", "org", "edu", "gov")
DENY_15 = (".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".zip", ".rar", ".7z",
           ".tar", ".gz", ".bz2", ".exe", ".dmg")

NETLOC = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"
QUERY = r"^[^?#]*\?([^#]*)"


def url_domain(url):
    """Network location with port and user info."""
    return F.regexp_extract(col(url), NETLOC, 1)


def url_host(url):
    netloc = F.regexp_replace(url_domain(url), "^.*@", "")
    return F.lower(F.regexp_replace(netloc, ":[0-9]*$", ""))


def url_path(url):
    return F.regexp_extract(col(url), PATH, 1)


def root_domain(netloc):
    labels = F.split(col(netloc), r"\.")
    n = F.size(labels)
    wide = (n >= 3) & F.try_element_at(labels, F.lit(-2)).isin(*SUFFIX_LABELS)
    keep = F.when(wide, 3).otherwise(F.least(n, F.lit(2)))
    return F.array_join(F.slice(labels, n - keep + 1, keep), ".")


def canonical_url(url):
    """Query parameters sorted, fragment dropped, empty path made '/'."""
    base = F.regexp_extract(col(url), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.when(url_path(url) == "", "/").otherwise(url_path(url))
    query = F.regexp_extract(col(url), QUERY, 1)
    pairs = F.array_join(F.array_sort(F.split(query, "&")), "&")
    return F.concat(base, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), pairs)))


def extension(url):
    return F.lower(F.regexp_extract(url_path(url), r"(\.[^./]+)$", 1))


def has_denied_extension(url, deny=DENY_15):
    return extension(url).isin(*deny)


def host_suffixes(host):
    """Every domain the host belongs to: a.b.c gives a.b.c, b.c and c."""
    labels = F.split(col(host), r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def on_domains(url, domains):
    """The host is one of the domains or lies under one; no join needed for a parameter list."""
    return F.arrays_overlap(host_suffixes(url_host(url)), F.array(*[F.lit(d.lower()) for d in domains]))


def doc_id(url, unix_ts):
    return F.concat_ws("_", F.lit("crawl"), F.lit(unix_ts).cast("string"), F.substring(F.md5(col(url)), 1, 8))
