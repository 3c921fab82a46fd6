"""Crawl frontier: links of pages, screened before anyone fetches them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidegate.operators.links import link_edges, link_payload, screen_urls


def screened_frontier(pages: DataFrame, host_ips: DataFrame) -> DataFrame:
    """Distinct targets of all pages with host and verdict."""
    targets = link_edges(pages).select("target").distinct().withColumnRenamed("target", "url")
    return screen_urls(targets, host_ips)


def write_link_payloads(pages: DataFrame, path: str) -> None:
    """One JSON object per page: source URL, link count, links."""
    link_payload(pages).write.mode("overwrite").json(path)
