"""Find what the lake lacks and load only that, each offered row once.

Source listing (links in the source's folder page, or its files) minus lake
listing = missing keys; the source rows of missing keys are written to the
raw zone, transcoded to the lake's dialect.  The missing keys are an anti-join; a bit filter of them, of
bounded size, tells Spark which files to open as it plans the scan, and a semi-join keeps exactly their rows.  No
list of keys or files is fetched.  A key is written as one folder that
replaces whatever the folder held, so a repeated load adds nothing, and is then
recorded as loaded, so a file without rows isn't offered again.

Files of any column order may stand in one folder: every file is read with its
own header, and columns are taken by name or alias.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from lakestrata import schemas as S
from lakestrata.functions.bits import bit_filter, bits_for, may_hold
from lakestrata.functions.casts import quote_ident
from lakestrata.functions.keys import file_key, file_name
from lakestrata.operators.reconcile import load_missing, missing_keys
from lakestrata.sources.csv import read_csv, read_or_empty
from lakestrata.sources.headers import FIELDS, FILE, by_header, header_names, plain_rows, wide_enough
from lakestrata.sources.listing import file_keys, page_links
from lakestrata.sources.sinks import write_csv, write_single_csv

KEY = "DATE_KEY"
#: Missing keys that are broadcast to the rows' tasks at most: some tens of bytes each.
BROADCAST_KEYS = 500_000
#: Folder of a raw zone that records the loaded keys; readers of the zone skip it.
LOADED = "_loaded"


def source_listing(pages: DataFrame, tipo: str, html_col: str = "html",
                   pattern: str | None = None) -> DataFrame:
    """(Cam_Git, DATE_KEY, Tipo) for every data-file link in the given pages."""
    return page_links(pages, html_col=html_col, pattern=pattern, tipo=tipo).select(
        *[F.col(f.name).cast(f.dataType) for f in S.SOURCE_LISTING.fields])


def lake_listing(spark: SparkSession, lake_dir: str, ext: str = ".csv",
                 partition_column: str | None = KEY) -> DataFrame:
    """(Cam_Lake, DATE_KEY) of what the raw zone holds or records as loaded; empty when it has nothing."""
    held = read_or_empty(
        spark, lambda: file_keys(spark, lake_dir, ext=ext, partition_column=partition_column),
        S.LAKE_LISTING)
    recorded = read_or_empty(
        spark, lambda: spark.read.schema(S.MISSING_LIST).parquet(f"{lake_dir}/{LOADED}"), S.MISSING_LIST)
    return held.unionByName(recorded.select(F.lit(None).cast("string").alias("Cam_Lake"), KEY))


def record_loaded(keys: DataFrame, lake_dir: str) -> None:
    """Adds keys to the zone's record; a key may be there twice."""
    keys.select(F.col(KEY).cast("string")).where(F.col(KEY).isNotNull()).distinct().write.mode("append").parquet(
        f"{lake_dir}/{LOADED}")


def find_missing(source: DataFrame, lake: DataFrame) -> DataFrame:
    """Keys offered by the source and absent from the lake."""
    return missing_keys(source, lake, KEY)


def write_missing(missing: DataFrame, path: str) -> int:
    """The missing-key list as one ``|`` CSV with a header; the number of keys, counted while they are written."""
    written = Observation()
    write_single_csv(missing.select(KEY).observe(written, F.count(F.lit(1)).alias("n")), path, sep="|")
    return written.get["n"]


def read_missing(spark: SparkSession, path: str) -> DataFrame:
    """A missing-key list, or an empty one when it was never written."""
    return read_or_empty(spark, lambda: read_csv(spark, path, S.MISSING_LIST, sep="|"),
                         S.MISSING_LIST)


def _paths(source: str | Sequence) -> list[str]:
    return [source] if isinstance(source, str) else [p for s in source for p in _paths(s)]


def keyed_source(spark: SparkSession, source: str | Sequence[str | Sequence[str]],
                 sep: str = ",", ext: str = ".csv", columns: Sequence[str] | None = None,
                 aliases: Mapping[str, Sequence[str]] | None = None, optional: Sequence[str] = (),
                 glob: str | None = None, modified_after: str | None = None, fields: int = FIELDS,
                 only: DataFrame | None = None) -> DataFrame:
    """Rows of all source files, by column name, with the key of the file each comes from.

    ``source`` is a folder or file, or a (nested) list of them.  A file's first row is its
    header, and no data.  Each of ``columns`` is taken from the header field of its name, or of
    one of its ``aliases``, in any letter case.  A file that lacks a column fails the job, which names both, unless
    the column is ``optional``: then it is NULL.  Without ``columns`` the result has every name of any header,
    NULL where a file lacks it; this costs one more pass, over the headers.

    ``only`` (a table with a ``DATE_KEY``) is the keys to read: files of nearly no other key are opened, whatever
    the number of keys, and the rows are those of these keys.  The keys stay a table; what the driver holds is a filter of
    ``functions.bits.BITS`` at most.  ``glob`` (a file name pattern) and ``modified_after`` (a timestamp) narrow
    the files too.  A file with more than ``fields`` fields fails the job; see ``wide_enough``.
    """
    keep, n = None, 0
    if only is not None:
        only = only.select(F.col(KEY).cast("string")).where(F.col(KEY).isNotNull()).distinct()
        n = only.count()
        bits = bit_filter(only, KEY, bits_for(n))
        keep = lambda key: may_hold(bits, key)
    rows = plain_rows(spark, _paths(source), sep, ext, glob, modified_after, fields, keep)
    if columns is None:
        optional = columns = header_names(rows)
    out = by_header(rows, columns, aliases or {}, optional)
    out = out.select(*[F.col(quote_ident(c)) for c in columns], file_key(FILE, ext).alias(KEY))
    if only is not None:
        kept = load_missing(out, F.broadcast(only) if n <= BROADCAST_KEYS else only, KEY)
        out = kept.select(*[F.col(quote_ident(c)) for c in out.columns])
    return out


def ingest_missing(spark: SparkSession, source: str | Sequence[str | Sequence[str]],
                   lake_dir: str, missing: DataFrame, src_sep: str = ",",
                   lake_sep: str = "|", columns: Sequence[str] | None = None,
                   ext: str = ".csv", aliases: Mapping[str, Sequence[str]] | None = None,
                   optional: Sequence[str] = (), glob: str | None = None,
                   modified_after: str | None = None) -> None:
    """Write the rows of the missing keys to the raw zone, one folder per key, and record the keys.

    Only the files of missing keys are opened, and each is read once; a file's rows stay in its task, so nothing is shuffled.
    The folders of these keys are replaced.  For ``columns``, ``aliases``, ``optional``, ``glob`` and ``modified_after`` see ``keyed_source``;
    with ``columns`` every file of the zone has the same header.
    """
    def load(fields: int) -> None:
        rows = keyed_source(spark, source, sep=src_sep, ext=ext, columns=columns, aliases=aliases, optional=optional,
                            glob=glob, modified_after=modified_after, fields=fields, only=missing)
        if rows.columns == [KEY]:  # no file of a missing key has a header
            return
        write_csv(rows, lake_dir, sep=lake_sep, partition_by=[KEY], dynamic_overwrite=True, rebalance=False)

    wide_enough(load)
    record_loaded(missing, lake_dir)


__all__ = ["KEY", "file_name", "find_missing", "ingest_missing", "keyed_source", "lake_listing", "read_missing",
           "record_loaded", "source_listing", "write_missing"]
