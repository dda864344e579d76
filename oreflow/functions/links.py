"""Links in directory listings: extraction, selection of data files, file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# href with double quotes, single quotes or none
HREF = r"""(?i)href=("[^"]*"|'[^']*'|[^\s>]+)"""
URL_PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"


def extract_links(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """One row per link target, ``pos`` counting from 0 within the page."""
    found = F.regexp_extract_all(F.col(html), F.lit(HREF), F.lit(1))
    links = pages.select(*keep, F.posexplode(found).alias("pos", "_raw"))
    raw = F.col("_raw")
    quote = F.substring(raw, 1, 1)
    quoted = quote.isin('"', "'") & (F.length(raw) >= 2) & raw.endswith(quote)
    bare = F.substring(raw, F.lit(2), F.length(raw) - 2)
    return links.select(*keep, "pos", F.when(quoted, bare).otherwise(raw).alias("href"))


def index_directory(url: Column) -> Column:
    """Path of an index URL with exactly one slash at its end."""
    return F.concat(F.regexp_replace(F.regexp_extract(url, URL_PATH, 1), "/+$", ""), F.lit("/"))


def is_data_file(href: Column, index_url: Column) -> Column:
    """True for a link to a file of the index's own directory.

    A link has a directory part, up to its last slash, and a name. Without a name,
    or with a name that says "up", there is no file; a query, an anchor or a mail
    address is none either. An absolute directory must be the index's own; a
    relative target is taken to be there.
    """
    directory = F.regexp_extract(href, "^(.*/)?", 1)
    name = F.substr(href, F.length(directory) + 1)
    is_file = (name != "") & (name != "..") & ~href.rlike("^([?#]|mailto:)")
    at_home = ~directory.startswith("/") | (directory == index_directory(index_url))
    return F.coalesce(is_file & at_home, F.lit(False))


def file_name(href: Column) -> Column:
    """Last part of an absolute path; relative targets are kept as they are."""
    return F.when(href.startswith("/"), F.element_at(F.split(href, "/"), -1)).otherwise(href)


def first_links(links: DataFrame, page: str = "page_id") -> DataFrame:
    """Each file name once per page, at the place where it first occurs."""
    return links.groupBy(page, file_name(F.col("href")).alias("name")).agg(F.min("pos").alias("first_pos"))
