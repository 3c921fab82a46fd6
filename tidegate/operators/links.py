"""Link extraction from pages and URL safety screening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.text import java_regex, strip
from tidegate.functions.urls import (
    hostname, in_networks, ipv4_number, ipv6_hex, is_mapped_ipv4, netloc, resolve_all, scheme)

# --- fixed values: link pattern, skipped prefixes, schemes, blocked networks ---------
HREF_PATTERN = r"""<a\s[^>]*?href=["']([^"']+)["']"""
SKIPPED_PREFIXES = ["#", "javascript:", "mailto:", "tel:"]
ALLOWED_SCHEMES = ["http", "https"]
BLOCKED_NETWORKS = [
    "10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16", "127.0.0.0/8", "169.254.0.0/16",
    "::1/128", "fc00::/7", "0.0.0.0/8",
]
# --- end of fixed values -------------------------------------------------------------


def hrefs(html: Column) -> Column:
    """Every link target as written, in page order."""
    return F.regexp_extract_all(html, F.lit(java_regex(HREF_PATTERN)), F.lit(1))


def followable(found: Column) -> Column:
    """Stripped targets without empty ones and skipped prefixes."""
    def kept(h: Column) -> Column:
        keep = h != ""
        for prefix in SKIPPED_PREFIXES:
            keep = keep & ~h.startswith(prefix)
        return keep

    return F.filter(F.transform(found, strip), kept)


def page_links(pages: DataFrame) -> DataFrame:
    """``page_id, url, links``: distinct absolute targets in order of first occurrence."""
    return (pages.select("page_id", "url", followable(hrefs(F.col("html"))).alias("_refs"))
            .select("page_id", "url", F.array_distinct(
                resolve_all(F.col("url"), F.col("_refs"))).alias("links")))


def link_payload(pages: DataFrame) -> DataFrame:
    """``source_url, link_count, links`` per page."""
    return page_links(pages).select(
        F.col("url").alias("source_url"),
        F.size("links").cast("bigint").alias("link_count"), "links")


def link_edges(pages: DataFrame) -> DataFrame:
    """One row per distinct target of a page."""
    return page_links(pages).select("page_id", "url", F.explode("links").alias("target"))


def host_in_degree(edges: DataFrame) -> DataFrame:
    """Distinct links per target host."""
    return (edges.groupBy(hostname(netloc(F.col("target"))).alias("host"))
            .agg(F.count("*").alias("n_edges")))


def syntax_verdict(url_scheme: Column, url_netloc: Column, host: Column) -> Column:
    """The first syntax failure of a URL given its parts, or null."""
    return (F.when(~url_scheme.isin(ALLOWED_SCHEMES), F.lit("unsupported_scheme"))
            .when(url_netloc == "", F.lit("no_host"))
            .when(host == "", F.lit("no_hostname")))


def screen_urls(urls: DataFrame, host_ips: DataFrame, networks=BLOCKED_NETWORKS) -> DataFrame:
    """Add ``host`` and ``verdict`` to a table with a ``url`` column.

    Verdicts: ``ok``, three syntax failures, ``mapped_ipv4`` and ``ssrf_blocked``. A host
    that is an address is tested itself; another is looked up in ``host_ips(host, ip)``,
    and one without an entry, or with an entry that is no address, is unsafe.
    The lookup table is reduced to one row per host, so the join keeps the row count; a
    host that many URLs share is split by adaptive skew handling.
    """
    v4, v6, host = F.col("_v4"), F.col("_v6"), F.col("host")
    lookup = (host_ips.select(F.lower("host").alias("host"), F.lower("ip").alias("_ip"))
              .withColumns({"_v4": ipv4_number(F.col("_ip")), "_v6": ipv6_hex(F.col("_ip"))})
              .groupBy("host")
              .agg(F.bool_or(F.coalesce(in_networks(v4, v6, networks), F.lit(True))).alias("_private"),
                   F.bool_or(is_mapped_ipv4(v6)).alias("_mapped")))
    literal = v4.isNotNull() | v6.isNotNull()
    private = F.when(literal, in_networks(v4, v6, networks)).otherwise(F.col("_private"))
    mapped = F.when(literal, is_mapped_ipv4(v6)).otherwise(F.col("_mapped"))
    verdict = (F.when(F.col("_syntax").isNotNull(), F.col("_syntax"))
               .when(F.coalesce(mapped, F.lit(False)), F.lit("mapped_ipv4"))
               .when(F.coalesce(private, F.lit(True)), F.lit("ssrf_blocked"))
               .otherwise(F.lit("ok")))
    return (urls
            .withColumns({"_scheme": scheme(F.col("url")), "_netloc": netloc(F.col("url"))})
            .withColumn("host", hostname(F.col("_netloc")))
            .withColumns({"_v4": ipv4_number(host), "_v6": ipv6_hex(host),
                          "_syntax": syntax_verdict(F.col("_scheme"), F.col("_netloc"), host)})
            .join(lookup, "host", "left")
            .select(*urls.columns, "host", verdict.alias("verdict")))
