"""URL functions.  All stay in the JVM; a text that is no URL comes back trimmed, or as null where parts are asked for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
TRACKING = ("fbclid", "gclid", "mc_cid", "mc_eid", "utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term")
DISCLOSURE_WORDS = ("disclos", "joho", "kyufu", "shien", "youken", "yoken", "info", "support", "schoolguide", "valuation", "kakunin", "shinsei", "musho")
DIRECTORY_HOSTS = (
    "best-shingaku.net", "korekarashinro.jp", "manabi.benesse.ne.jp", "minkou.jp", "nicjp.niad.ac.jp", "shingakunet.com", "shinronavi.com", "studyplus.jp",
)
QUALITY_RANK = {"direct_pdf": 3, "disclosure": 2, "homepage": 1, "none": 0}
PROBE_PATHS = ("/disclosure/", "/information/", "/joho/", "/public/", "/about/disclosure/")
SOCIAL_HOSTS = (
    "facebook.com", "twitter.com", "x.com", "instagram.com", "youtube.com", "youtu.be", "tiktok.com", "linkedin.com", "note.com", "ameblo.jp",
    "fc2.com", "blog.livedoor.jp", "hatenablog.com", "wantedly.com", "rikunabi.com", "mynavi.jp", "indeed.com", "doda.jp",
)


def _part(url: Column, part: str) -> Column:
    return F.try_parse_url(url, F.lit(part))


def canonical(url: Column) -> Column:
    """URL-01: lower scheme and host, no default port, single slashes, no trailing one, no tracking parameters, sorted
    query, no fragment."""
    url = F.trim(url)
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1))
    host = F.when(scheme == "https", F.regexp_replace(host, ":443$", "")).when(scheme == "http", F.regexp_replace(host, ":80$", "")).otherwise(host)
    path = F.regexp_replace(F.regexp_replace(F.regexp_extract(url, r"^[^:]+://[^/?#]+([^?#]*)", 1), "/+", "/"), "/$", "")
    pairs = F.filter(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda p: (p != "") & ~F.lower(F.regexp_extract(p, "^([^=]*)", 1)).isin(*TRACKING))
    name = lambda p: F.lower(F.regexp_extract(p, "^([^=]*)", 1))
    # a download manager's links change with every visit
    pairs = F.when(F.exists(pairs, lambda p: name(p) == "wpdmdl"), F.filter(pairs, lambda p: name(p) != "refresh")).otherwise(pairs)
    query = F.array_join(F.array_sort(pairs), "&")
    whole = F.concat(scheme, F.lit("://"), host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.when((scheme == "") | (host == ""), url).otherwise(whole)


def dedupe_key(url: Column) -> Column:
    """URL-02: canonical, with percent codes of the path decoded; a plus sign stays one."""
    key = canonical(url)
    path = F.regexp_extract(key, r"^[^:]+://[^/?#]+([^?]*)", 1)
    decoded = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    return F.concat(F.regexp_extract(key, r"^([^:]+://[^/?#]+)", 1), decoded, F.regexp_extract(key, r"(\?.*)$", 1))


def host(url: Column) -> Column:
    """URL-03: the host in lower case, without port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def quality(url: Column) -> Column:
    """URL-04: direct_pdf, disclosure, homepage or none."""
    low = F.lower(url)
    words = low.contains(DISCLOSURE_WORDS[0])
    for w in DISCLOSURE_WORDS[1:]:
        words = words | low.contains(w)
    return F.when(url.isNull() | (url == ""), "none").when(low.endswith(".pdf"), "direct_pdf").when(words, "disclosure").otherwise("homepage")


def _rank(q: Column) -> Column:
    out = F.lit(0)
    for name, rank in QUALITY_RANK.items():
        out = F.when(q == name, rank).otherwise(out)
    return out


def writer_action(new: Column, existing: Column) -> Column:
    """URL-05: add, upgrade or noop for a quality against an array of existing ones."""
    best = F.coalesce(F.array_max(F.transform(existing, _rank)), F.lit(0))
    return F.when(new == "none", "noop").when(best == 0, "add").when(_rank(new) > best, "upgrade").otherwise("noop")


def origin(url: Column) -> Column:
    """URL-06: scheme and host with port, in lower case."""
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1))


def delivery_pattern(url: Column, raw: Column, source: Column) -> Column:
    """URL-07: how a document is delivered, prefixed by the extractor that found it."""
    pattern = F.when(url.contains("/wp-content/"), "wordpress").when(raw.contains("?"), "cache_busted").otherwise("direct")
    return F.when(source.isNull(), pattern).otherwise(F.concat(source, F.lit("_"), pattern))


def first_url(text: Column) -> Column:
    """URL-08: the first URL in free text; null if none."""
    found = F.regexp_extract(text, r"(https?://[^\s\"'<>]+)", 1)
    return F.when(found != "", found)


def probe_urls(site: Column) -> Column:
    """URL-09: pages of a site's host worth a look."""
    return F.transform(F.array(*map(F.lit, PROBE_PATHS)), lambda p: F.concat(origin(site), p))


def host_matches(h: Column, suffixes: tuple[str, ...] = SOCIAL_HOSTS) -> Column:
    """URL-10: whether a host is one of the suffixes or below one."""
    hit = F.lit(False)
    for s in suffixes:
        hit = hit | (h == s) | h.endswith("." + s)
    return hit


def document_in_query(url: Column) -> Column:
    """URL-11: a document's URL that stands in a query value; null if none."""
    values = F.transform(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda p: F.coalesce(F.try_url_decode(F.regexp_extract(p, "=(.*)$", 1)), F.lit("")))
    return F.get(F.filter(values, lambda v: v.rlike(r"(?i)^(https?:/)?/.*\.pdf$")), F.lit(0))


def content_path(period: Column, content: Column, name: Column) -> Column:
    """URL-12: a path by content: period, SHA-256, file name."""
    return F.concat_ws("/", period.cast("string"), F.sha2(content.cast("binary"), 256), name)
