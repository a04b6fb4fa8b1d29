"""URL predicates and projections as column expressions: all JVM-side, none parses with Python."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values (P3): file endings and schemes that are left out.
FILE_ENDINGS = r"\.(ics|pdf|jpg|jpeg|png|zip|docx?|mp4|avi|xlsx?|ps|ps\.gz|mov|pptx?|dotx|wmv|tar\.gz|gz)(\?.*)?$"
FOREIGN_SCHEMES = r"^(callto|davs?|mattermost|file|ftp|tel|mailto|javascript|data|doi|ttps|urn):"
EMPTY_HOST = r"^https?://\s*$"
SKIPPED_HREF = "^(#|javascript:|mailto:)"


def normalize(url: Column) -> Column:
    """The URL without ``www.`` behind its scheme; null for null or empty."""
    return F.when(url != "", F.replace(url, F.lit("://www."), F.lit("://")))


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))


def host(url: Column) -> Column:
    """The network location, '' where there is none."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)


def invalid_reason(url: Column) -> Column:
    """Why a URL isn't fetched; null if it is valid."""
    kind = scheme(url)
    return (
        F.when(url.isNull() | (F.trim(url) == ""), "empty_or_not_string")
        .when(kind.isin("mailto", "tel", "javascript", "data"), F.concat(F.lit("protocol_"), kind))
        .when(kind != "https", "invalid_scheme")
        .when(host(url) == "", "missing_netloc")
    )


def excluded(url: Column) -> Column:
    """Left out of a crawl: files, other schemes, empty hosts."""
    other = url.contains("://") & ~url.rlike("^https?://")
    return url.rlike(FILE_ENDINGS) | url.rlike(FOREIGN_SCHEMES) | url.rlike(EMPTY_HOST) | other


def is_pdf(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([^?#]*)", 1)).rlike(r"\.pdf|/pdf/|/pdfs/|/document/")


def bare_host(url: Column) -> Column:
    """The host, lower case, without any ``www.``."""
    return F.replace(F.lower(host(url)), F.lit("www."), F.lit(""))


def in_domain(url: Column, domain: str) -> Column:
    """The host is the domain or ends with it behind a dot."""
    name = bare_host(url)
    return (name == domain) | name.endswith("." + domain)


def safe_filename(url: Column) -> Column:
    """A file name: no scheme, ``/`` and ``:`` as ``_``, at most 200 characters, then ``.md``."""
    return F.concat(F.substring(F.translate(F.regexp_replace(url, "^https?://", ""), "/:", "__"), 1, 200), F.lit(".md"))


def skipped_href(href: Column) -> Column:
    return (href == "") | href.rlike(SKIPPED_HREF)


def resolve(base: Column, href: Column) -> Column:
    """A root-relative or absolute reference against its page; other forms by ``resolve_any``."""
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    return F.when(href.startswith("//"), F.concat(scheme(base), F.lit(":"), href)).when(href.startswith("/"), F.concat(root, href)).otherwise(href)


def hrefs(html: Column) -> Column:
    """Targets of all anchors, in order."""
    return F.regexp_extract_all(html, F.lit(r'<a\s[^>]*href="([^"]*)"'), F.lit(1))


def anchors(html: Column) -> Column:
    """Targets that a crawl follows, in order."""
    return F.filter(hrefs(html), lambda h: ~skipped_href(h))


def is_listed(text: Column, markers: list[str], least: int) -> Column:
    """At least so many of the markers occur in the text."""
    lower = F.lower(text)
    count = F.lit(0)
    for m in markers:
        count = count + lower.contains(m).cast("int")
    return count >= least


def resolve_any():
    """The general resolver as an Arrow function, for references with dots, queries or no leading slash."""
    @F.pandas_udf("string")
    def joined(base: pd.Series, href: pd.Series) -> pd.Series:
        from urllib.parse import urljoin

        return pd.Series([None if b is None or h is None else urljoin(b, h) for b, h in zip(base, href, strict=True)])

    return joined


def has_content(html: Column, markdown: Column) -> Column:
    """Over 100 characters of HTML, or of markdown where there is no HTML."""
    long = lambda c: F.length(F.trim(F.coalesce(c, F.lit("")))) > 100
    return F.when(F.coalesce(html, F.lit("")) != "", long(html)).otherwise(long(markdown))


def not_found(final_url: Column, status: Column, content: Column) -> Column:
    """A page that is gone: status 404, or an address that says so, and nothing on it."""
    return (final_url.contains("/404/") | F.coalesce(status == 404, F.lit(False))) & ~content


def is_repository_page(url: Column, html: Column, hosts: list[str], markers: list[str], least: int = 2) -> Column:
    """A page of a publication repository: by a part of its address, or by at least so many markers in its text."""
    lower = F.lower(F.coalesce(url, F.lit("")))
    by_url = F.lit(False)
    for name in hosts:
        by_url = by_url | lower.contains(name)
    return by_url | F.coalesce(is_listed(html, markers, least), F.lit(False))


def is_event_page(url: Column, host: str) -> Column:
    """A page of an event system: its host and ``/event/`` in the address."""
    lower = F.lower(F.coalesce(url, F.lit("")))
    return lower.contains(host) & lower.contains("/event/")
