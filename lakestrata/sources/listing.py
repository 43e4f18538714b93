"""Listings as tables: files in a folder, links in web pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata.functions.html import attributes
from lakestrata.functions.keys import (
    extract_all, file_key, file_name, partition_value, strip_suffix,
)

#: Attribute that holds the file name of a link in a repository's folder page.
TITLE = "title"
HREF_LINK = r'<a href="([^"]*)"'


def list_files(spark: SparkSession, path: str, glob: str | None = None,
               recursive: bool = False, uri: bool = False) -> DataFrame:
    """(path, length) of the files under ``path``; file contents are not read.

    With ``uri`` also the path as ``_metadata.file_path`` of a scan gives it, so keys
    taken from either agree.

    The listing is Spark's own file index (listed in parallel when folders
    are many), and the binary source prunes ``content`` when it is not
    selected.
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.load(path).select("path", "length", *([F.col("_metadata.file_path").alias("uri")] if uri else []))


def any_case(ext: str) -> str:
    """A glob matching ``ext`` in any letter case (``.csv`` -> ``.[cC][sS][vV]``)."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in ext)


def file_keys(spark: SparkSession, path: str, ext: str = ".csv", name_col: str = "Cam_Lake",
              key_col: str = "DATE_KEY", partition_column: str | None = None) -> DataFrame:
    """(file name, key) per file; the key is the name without its extension
    (in any letter case), or, with ``partition_column``, the value of that
    Hive folder."""
    files = list_files(spark, path, glob=f"*{any_case(ext)}" if ext else None,
                       recursive=partition_column is not None, uri=True)
    key = partition_value("uri", partition_column) if partition_column else file_key("uri", ext)
    return files.select(file_name("uri").alias(name_col), key.alias(key_col))


def page_links(pages: DataFrame, html_col: str = "html", pattern: str | None = None,
               ext: str = ".csv", tipo: str = "General", id_cols: Sequence[str] = (),
               link_col: str = "Cam_Git", key_col: str = "DATE_KEY",
               kind_col: str = "Tipo") -> DataFrame:
    """One row per link in each page: (ids, link, key, kind).

    A link is the title of a tag, as a parser sees it, that ends in ``ext`` (in this letter case), or, with ``pattern``, what
    the group of that expression matches anywhere in the page.  The key is the link with a trailing ``ext`` removed, in any letter case.
    Runs per row on the executors; pages stay whole.
    """
    if pattern is None:
        found = F.filter(attributes(F.col(html_col), TITLE), lambda v: v.endswith(ext))
    else:
        found = extract_all(html_col, pattern)
    links = pages.select(*id_cols, F.explode(found).alias(link_col))
    return links.select(*id_cols, link_col,
                        strip_suffix(link_col, ext, case_insensitive=True).alias(key_col),
                        F.lit(tipo).alias(kind_col))
