"""URL rules as column expressions.

Three normalisers exist on purpose; they answer different questions and must not be
merged:

* ``canonical_url``: identity of a captured page (scheme kept, ``www.`` dropped,
  query sorted);
* ``match_url``: key for matching links across sources (https forced, ``www.`` kept,
  query order kept);
* ``audit_url``: the laxer matching form used when scoring candidate sources.

All of them split the URL with one RFC 3986 pattern, because ``parse_url`` returns
NULL for hosts with ``_`` and for internationalised hosts.
"""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5
from typing import NamedTuple

from pyspark.sql import Column, functions as F

from newsledger import fixed_values as fixed

_PARTS = r"^([A-Za-z][A-Za-z0-9+.\-]*):(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
_BARE_ENTITIES = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
_CLOSED_ENTITIES = "|".join(
    n for n in html5 if n.endswith(";") and any(n.startswith(b) for b in _BARE_ENTITIES))


class UrlParts(NamedTuple):
    scheme: Column
    user: Column
    host: Column
    port: Column
    path: Column
    query: Column


def strip(value: Column) -> Column:
    """Trim all white space, not only blanks."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def unescape_html(value: Column) -> Column:
    """Decode character references, with or without the closing semicolon."""
    closed = F.regexp_replace(value, r"&(#[0-9]+|#[xX][0-9a-fA-F]+)(?![0-9a-fA-F;])", "&$1;")
    closed = F.regexp_replace(
        closed, f"&(?!(?:{_CLOSED_ENTITIES}))({'|'.join(_BARE_ENTITIES)})", "&$1;")
    closed = F.regexp_replace(closed, "&apos;", "'")
    decoded = F.reflect(
        F.lit("org.apache.commons.text.StringEscapeUtils"), F.lit("unescapeHtml4"), closed)
    return F.when(value.contains("&"), decoded).otherwise(value)


def once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, however often ``then`` refers to it. Inside
    lambdas and generators Spark works out every occurrence of an expression again."""
    return F.element_at(F.transform(F.array(value), then), 1)


def with_parts(value: Column, then: Callable[[UrlParts], Column]) -> Column:
    """``then`` of the parts of a URL."""
    def split(clean: Column) -> Column:
        return F.struct(*[F.regexp_extract(clean, _PARTS, i).alias(name) for i, name in enumerate(
            ("scheme", "authority", "path", "query"), 1)])

    def server(parts: Column) -> Column:
        authority = parts["authority"]
        user = F.when(authority.contains("@"), F.regexp_extract(authority, "^(.*)@", 1))
        return F.struct(F.lower(parts["scheme"]).alias("scheme"), user.alias("user"),
                        F.regexp_replace(authority, "^.*@", "").alias("server"),
                        parts["path"].alias("path"), parts["query"].alias("query"))

    def finish(parts: Column) -> Column:
        server = parts["server"]
        host = F.when(server.startswith("["), F.regexp_extract(
            server, r"^\[([^\]]*)\]", 1)).otherwise(F.regexp_extract(server, "^([^:]*)", 1))
        port = F.regexp_extract(F.regexp_replace(server, r"^\[[^\]]*\]", ""), ":(.*)$", 1)
        return F.struct(parts["scheme"].alias("scheme"), parts["user"].alias("user"),
                        F.lower(host).alias("host"), port.alias("port"),
                        parts["path"].alias("path"), parts["query"].alias("query"))

    parts = F.array(F.regexp_replace(value, r"[\t\r\n]", ""))
    for step in (split, server, finish):
        parts = F.transform(parts, step)
    return F.element_at(F.transform(parts, lambda p: then(
        UrlParts(*[p[name] for name in UrlParts._fields]))), 1)


def _decode(value: Column) -> Column:
    return F.try_url_decode(F.regexp_replace(value, r"%(?![0-9A-Fa-f]{2})", "%25"))


def _encode(value: Column) -> Column:
    return F.replace(F.replace(F.url_encode(value), F.lit("%7E"), F.lit("~")),
                     F.lit("*"), F.lit("%2A"))


def _query(query: Column, drop_keys: list[str], drop_prefix: str | None = None,
           ordered: bool = False) -> Column:
    """Rewrite a query string: drop tracking pairs, keep blanks, re-encode."""
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda piece: piece != ""),
        lambda piece: F.struct(
            _decode(F.substring_index(piece, "=", 1)).alias("k"),
            _decode(F.regexp_extract(piece, "^[^=]*=?(.*)$", 1)).alias("v")))

    def wanted(pair: Column) -> Column:
        key = F.lower(pair["k"])
        keep = ~key.isin(drop_keys)
        return keep & ~key.startswith(drop_prefix) if drop_prefix else keep

    kept = F.filter(pairs, wanted)
    kept = F.array_sort(kept) if ordered else kept
    text = F.array_join(
        F.transform(kept, lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&")
    return F.when(query == "", "").otherwise(text)


def _path(path: Column) -> Column:
    return once(F.regexp_replace(path, "/+$", ""),
                  lambda bare: F.when(bare == "", "/").otherwise(bare))


def _join(scheme: Column, authority: Column, path: Column, query: Column) -> Column:
    return F.concat(scheme, F.lit("://"), authority, path, once(
        query, lambda q: F.when(q == "", "").otherwise(F.concat(F.lit("?"), q))))


def _web(parts: UrlParts) -> Column:
    return parts.scheme.isin("http", "https") & (parts.host != "")


def _valid_port(port: Column) -> Column:
    return (port == "") | (port.rlike("^[0-9]{1,5}$") & (port.try_cast("int") <= 65535))


def canonical_url(value: Column) -> Column:
    """Identity form of a page URL; NULL when it is not a web URL."""
    def form(parts: UrlParts) -> Column:
        host = F.regexp_replace(parts.host, r"^www\.", "")
        port = parts.port.try_cast("int")
        authority = F.concat(host, F.when(port > 0, F.concat(F.lit(":"), port.cast("string")))
                             .otherwise(""))
        query = _query(parts.query, fixed.CANONICAL_DROP_KEYS, fixed.CANONICAL_DROP_PREFIX, True)
        return F.when(_web(parts) & _valid_port(parts.port),
                      _join(parts.scheme, authority, _path(parts.path), query))
    return with_parts(strip(value), form)


def story_url(value: Column) -> Column:
    """Canonical URL, or the trimmed text when there is none."""
    return F.coalesce(canonical_url(value), strip(value), F.lit(""))


def safe_canonical(value: Column) -> Column:
    return F.coalesce(canonical_url(value), F.lit(""))


def _unpunctuated(value: Column) -> Column:
    return F.regexp_replace(once(strip(value), unescape_html), r"[.,);\]}]+$", "")


def match_url(value: Column) -> Column:
    """Matching form of a link; NULL for credentials, odd ports and other schemes."""
    def form(parts: UrlParts) -> Column:
        def built(host: Column) -> Column:
            default_port = F.when(parts.scheme == "https", 443).otherwise(80)
            usable = (_web(parts) & (host != "") & parts.user.isNull()
                      & ((parts.port == "") | (parts.port.try_cast("int") == default_port)))
            authority = F.when(host.contains(":"), F.concat(F.lit("["), host, F.lit("]"))
                               ).otherwise(host)
            return F.when(usable, _join(F.lit("https"), authority, _path(parts.path),
                                        _query(parts.query, fixed.MATCH_DROP_KEYS)))
        return once(F.regexp_replace(parts.host, r"\.+$", ""), built)
    return with_parts(F.substring(_unpunctuated(value), 1, fixed.MAX_URL_CHARS), form)


def url_signal_key(value: Column) -> Column:
    return F.concat(F.lit("url-sha256:"), F.sha2(match_url(value), 256))


def safe_url(value: Column) -> Column:
    """Matching form without its query, safe to keep for long."""
    return F.substring_index(match_url(value), "?", 1)


def audit_url(value: Column) -> Column:
    """Lax matching form; empty text when unusable."""
    def form(clean: Column) -> Column:
        return with_parts(clean, lambda parts: F.when(
            clean.rlike("^https?://") & (parts.host != ""),
            _join(F.lit("https"), parts.host, _path(parts.path),
                  _query(parts.query, fixed.AUDIT_DROP_KEYS))))
    return F.coalesce(once(_unpunctuated(value), form), F.lit(""))


def raw_host(value: Column) -> Column:
    return with_parts(value, lambda parts: parts.host)


def url_host(value: Column) -> Column:
    """Lower-case host without a leading ``www.``; empty when there is none."""
    return F.coalesce(F.regexp_replace(raw_host(value), r"^www\.", ""), F.lit(""))


def host_matches(host: Column, domains: list[str]) -> Column:
    """Host equals a configured domain or is one of its subdomains."""
    low = F.lower(host)
    hits = low.isin([d.lower() for d in domains])
    for domain in domains:
        hits = hits | low.endswith("." + domain.lower())
    return hits


def is_community_url(value: Column) -> Column:
    return once(F.regexp_replace(raw_host(value), r"\.+$", ""), lambda host: (
        (host == "reddit.com") | host.endswith(".reddit.com")))


def found_urls(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(fixed.HTTP_URL_PATTERN), 0)


def unescaped(*texts: Column) -> Column:
    """The texts, decoded one by one and joined by blanks: no reference spans a blank, and a URL
    with an ampersand beside a long text does not make the text be decoded too. Texts without
    ``://`` or a reference come out empty, for they hold no link."""
    def piece(text: Column) -> Column:
        return F.when(text.contains("&"), unescape_html(text)).when(text.contains("://"), text)
    return F.concat_ws(" ", *[piece(t) for t in texts])


def _distinct_urls(decoded: Column, normalise) -> Column:
    """Links of an ``unescaped`` text, sorted."""
    links = F.filter(F.transform(found_urls(decoded), normalise),
                     lambda u: u.isNotNull() & (u != ""))
    # most texts hold no link at all: skip the whole pipeline for them
    return F.when(decoded.contains("://"), F.array_sort(F.array_distinct(links))).otherwise(
        F.array().cast("array<string>"))


def extract_match_urls(*texts: Column) -> Column:
    return once(unescaped(*texts), lambda decoded: _distinct_urls(decoded, match_url))


def extract_audit_urls(*texts: Column) -> Column:
    return once(unescaped(*texts), lambda decoded: _distinct_urls(decoded, audit_url))


def extract_absolute_links(text: Column) -> Column:
    """Web links named by href or in plain text, for bodies without relative links."""
    decoded = unescape_html(F.coalesce(text, F.lit("")))
    named = F.transform(F.regexp_extract_all(decoded, F.lit(fixed.HREF_PATTERN), 1), strip)
    links = F.transform(F.concat(named, found_urls(decoded)),
                        lambda u: F.regexp_replace(u, r"[.,);\]}]+$", ""))
    links = F.filter(links, lambda u: u.rlike("(?i)^https?://[^/?#]"))
    return F.array_sort(F.array_distinct(links))


def status_links(text: Column) -> Column:
    """Author/status links, normalised, reserved path heads left out."""
    text = F.coalesce(text, F.lit(""))
    heads = F.regexp_extract_all(text, F.lit(fixed.STATUS_LINK_PATTERN), 1)
    ids = F.regexp_extract_all(text, F.lit(fixed.STATUS_LINK_PATTERN), 2)
    pairs = F.filter(F.arrays_zip(heads.alias("h"), ids.alias("s")),
                     lambda p: ~F.lower(p["h"]).isin(fixed.STATUS_RESERVED_HEADS))
    links = F.transform(
        pairs, lambda p: F.concat(F.lit("x.com/"), p["h"], F.lit("/status/"), p["s"]))
    return F.array_sort(F.array_distinct(links))


def names_artifact(url: Column) -> Column:
    """A normalised link to code, a model or a paper rather than to a front page."""
    rules = [r"github\.com/+[^/?#]+/+[^/?#]",
             r"huggingface\.co/+(?!(?:blog|docs|papers)(?:/|$))[^/?#]+/+[^/?#]",
             r"arxiv\.org/+(?:abs|pdf|html)(?:[/?#]|$)",
             r"openreview\.net/+(?:forum|pdf)(?:[/?#]|$)"]
    return url.rlike(f"^https://(?:{'|'.join(rules)})")


def is_artifact_url(value: Column) -> Column:
    return names_artifact(audit_url(value))


def linkify(value: Column) -> Column:
    """Clickable form of a hand-written link; NULL for paths, files and prose."""
    link = strip(F.coalesce(value, F.lit("")))
    head = F.substring_index(link, "/", 1)
    host_like = head.rlike(fixed.LINK_HOST_PATTERN) & ~head.rlike(fixed.LINK_FILE_PATTERN)
    return (F.when(link == "", None)
            .when(F.lower(link).rlike("^https?://"), link)
            .when(link.contains(" "), None)
            .when(host_like, F.concat(F.lit("https://"), link)))
