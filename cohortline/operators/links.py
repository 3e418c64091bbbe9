"""Links of stored directory-listing pages (A16, re-aimed one-hop walk).

The ``href`` of every ``<a>`` tag is found by tokenizing the page (comments, scripts, styles and
quoted values hide their contents), its character references are decoded, and it is resolved
against the page's URL, dot segments included. A link is in scope when its URL starts with the
page's directory URL; in-scope links ending in ``/`` are directories, the others files, with their
path relative to that directory. Only one hop: listed directories are not fetched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.functions.markup import anchor_hrefs
from cohortline.functions.urls import join_url


def extract_hrefs(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """One row per anchor: the page's columns (minus the HTML) and ``href``."""
    keep = [c for c in pages.columns if c != html_col]
    anchors = pages.select(*keep, F.explode(anchor_hrefs(F.col(html_col))).alias("href"))
    return anchors.withColumn("href", F.trim("href"))


def directory_of(url: Column) -> Column:
    """The URL of the folder holding ``url`` (query and fragment removed)."""
    no_query = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), r"\?.*$", "")
    bare_host = no_query.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*$")
    return F.when(bare_host, F.concat(no_query, F.lit("/"))).otherwise(F.regexp_extract(no_query, r"^(.*/)", 1))


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id..., href, link_url, kind, in_scope, rel_path`` for every anchor."""
    anchors = extract_hrefs(pages, html_col)
    base = F.col(url_col)
    folder = directory_of(base)
    url = join_url(base, F.col("href"))
    in_scope = F.coalesce(url.startswith(folder), F.lit(False))
    kind = F.when(url.endswith("/"), F.lit("directory")).otherwise(F.lit("file"))
    rel = F.substr(url, F.length(folder) + 1)
    rel = F.when(kind == "directory", F.regexp_replace(rel, "^/+|/+$", "")).otherwise(rel)
    keep = [c for c in anchors.columns if c not in (url_col, "href")]
    return anchors.select(
        *keep, "href", url.alias("link_url"), kind.alias("kind"), in_scope.alias("in_scope"),
        F.when(in_scope, rel).alias("rel_path"),
    )
