"""Key expressions: file names to keys, composite keys, links in pages."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_suffix(c: str | Column, suffix: str, case_insensitive: bool = False) -> Column:
    """Remove a literal suffix at the end only (``xcsv-01.csv`` -> ``xcsv-01``)."""
    flags = "(?i)" if case_insensitive else ""
    return F.regexp_replace(_c(c), F.lit(f"{flags}{re.escape(suffix)}$"), F.lit(""))


def _unescaped(c: Column) -> Column:
    """``%XX`` escapes decoded once; a plus sign stays one."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def file_name(uri: str | Column) -> Column:
    """Name of a file from its URI (``_metadata.file_path``), as it is on disk.

    A scan works it out for every row: no pattern, which would be tried at each place of a long address.
    """
    return _unescaped(F.substring_index(_c(uri), "/", -1))


def partition_value(uri: str | Column, column: str) -> Column:
    """Value of a Hive-style ``column=value`` folder in a file's URI, '' if absent.

    The URI escapes the folder's name, and the folder's name the value.
    """
    value = F.regexp_extract(_c(uri), rf"/{re.escape(column)}=([^/]*)/", 1)
    return _unescaped(_unescaped(value))


def file_key(uri: str | Column, ext: str = ".csv") -> Column:
    """Key of a source file: its name without the extension, in any letter case."""
    return strip_suffix(file_name(uri), ext, case_insensitive=True)


def composite_key(optional: Sequence[str], required: Sequence[str], sep: str = "") -> Column:
    """Concatenate key parts.

    Optional parts count as '' when NULL; a NULL required part makes the key
    NULL.  With ``sep=''`` ("AB","C") and ("A","BC") collide, as in the
    layered lake this reproduces; pass a separator to keep them apart.
    """
    parts: list[Column] = [F.coalesce(F.col(c), F.lit("")) for c in optional]
    parts += [F.col(c) for c in required]
    if sep:
        joined: list[Column] = []
        for i, p in enumerate(parts):
            if i:
                joined.append(F.lit(sep))
            joined.append(p)
        parts = joined
    return F.concat(*parts)


def source_url(base: str, key: str | Column, ext: str = ".csv") -> Column:
    """``base + key + ext``: where the file for a key is fetched from."""
    return F.concat(F.lit(base), _c(key), F.lit(ext))


def extract_all(text: str | Column, pattern: str, group: int = 1) -> Column:
    """All matches of a regex group in a text, as an array."""
    return F.regexp_extract_all(_c(text), F.lit(pattern), group)
