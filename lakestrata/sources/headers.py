"""CSV files of any column order, read once, each by its own header.

The scan reads rows without a header, whole files to a task (a field may hold line
breaks), so a file's first row is its header.  One pass over the Arrow batches
of each task carries the header of the file at hand and picks the wanted
columns by name; nothing is joined or shuffled, and no value is copied.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakestrata.functions.keys import file_key
from lakestrata.sources.csv import READ_OPTIONS
from lakestrata.sources.listing import any_case

#: Fields that a scan takes at first; files with more are read with more (``wide_enough``).
FIELDS = 63
TOO_WIDE = "more fields than the scan takes"
#: Column of the scan's schema that is left out of every row.
UNREAD = "_unread"
#: Column of the file's address beside the picked ones.
FILE = "__file"

Got = TypeVar("Got")


def wide_enough(run: Callable[[int], Got], fields: int = FIELDS) -> Got:
    """``run(fields)``, with four times the fields each time a file has more."""
    while True:
        try:
            return run(fields)
        except Exception as e:
            if TOO_WIDE not in str(e):
                raise
            fields *= 4


def plain_rows(spark: SparkSession, paths: Sequence[str], sep: str = ",", ext: str = ".csv", glob: str | None = None,
               modified_after: str | None = None, fields: int = FIELDS, keep: Callable[[Column], Column] | None = None) -> DataFrame:
    """(file, _0, _1, ...): all rows as they are, headers included; ``fields`` of them and one that shows whether a row has more.

    ``keep`` is a condition on a file's key; files that fail it aren't opened.
    """
    names = [f"_{i}" for i in range(fields + 1)]
    # Spark raises and catches an error for every field that a row lacks, unless the parser picks columns: then they are NULL.
    # It picks them where the schema has one more, that is never read; for files with line breaks in fields it must be told to.
    reader = spark.read.schema(", ".join(f"{n} string" for n in [*names, UNREAD])).options(
        header=False, sep=sep, columnPruning=True, maxColumns=max(20480, 4 * fields), pathGlobFilter=glob or f"*{any_case(ext)}", **READ_OPTIONS)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    rows = reader.csv(list(dict.fromkeys(paths)))
    if keep is not None:
        # A condition on file metadata alone: Spark drops the files as it plans the scan.
        rows = rows.where(keep(file_key(F.col("_metadata.file_path"), ext)))
    return rows.select(F.col("_metadata.file_path").alias("file"), *names)


def _header(batch: pa.RecordBatch, at: int) -> list[str]:
    cells = (batch.column(k)[at].as_py() for k in range(1, batch.num_columns))
    return [(c or "").replace("﻿", "").strip() for c in cells]


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str] | None, pa.RecordBatch]]:
    """(file, its header, rows) and then (file, None, rows): the runs of rows of one file, in order."""
    at_hand = None
    for batch in batches:
        if not batch.num_rows:
            continue
        files = batch.column(0).dictionary_encode()
        codes = files.indices.to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1], [True]])).tolist()
        for a, b in zip(edges, edges[1:], strict=False):
            file = files.dictionary[int(codes[a])].as_py()
            header = None
            if file != at_hand:
                at_hand, header = file, _header(batch, a)
                if header[-1]:
                    raise ValueError(f"{TOO_WIDE} in {file}")
                a += 1
            yield file, header, batch.slice(a, b - a)


def header_names(rows: DataFrame) -> list[str]:
    """The names in all headers of ``plain_rows``, by their first place, one for those that differ in case only: one pass, a row per header."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, header, _ in _files(batches):
            named = {n: k for k, n in reversed(list(enumerate(header or []))) if n}
            yield pa.record_batch([pa.array(list(named), pa.string()), pa.array(list(named.values()), pa.int32())], ["name", "at"])

    found = rows.mapInArrow(run, "name string, at int").groupBy(F.lower("name").alias("key")).agg(
        F.min(F.struct("at", "name")).alias("first")).select("first.*").orderBy("at", "name")
    return [r["name"] for r in found.collect()]  # the result's columns


def by_header(rows: DataFrame, columns: Sequence[str], aliases: Mapping[str, Sequence[str]] = {},
              optional: Sequence[str] = ()) -> DataFrame:
    """``columns`` of ``plain_rows`` by each file's header, in any letter case, and ``FILE``.

    The first of a column's name and aliases that the header has gives it.  A file that has none fails the job, which names both,
    unless the column is ``optional``: then it is NULL.  Only the row in a header's place is no data.
    """
    names = {c: [n.lower() for n in (c, *aliases.get(c, ()))] for c in columns}

    def places(file: str, header: list[str]) -> list[int | None]:
        known = {n.lower(): k for k, n in reversed(list(enumerate(header)))}
        out = []
        for c, wanted in names.items():
            at = next((known[n] for n in wanted if n in known), None)
            if at is None and c not in optional:
                raise ValueError(f"no column {c} in {file}")
            out.append(at)
        return out

    schema = StructType([StructField(c, StringType()) for c in [*columns, FILE]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: list[int | None] = []
        for file, header, part in _files(batches):
            if header is not None:
                at = places(file, header)
            if not part.num_rows:
                continue
            if part.column(part.num_columns - 1).null_count < part.num_rows:
                raise ValueError(f"{TOO_WIDE} in {file}")
            picked = [pa.nulls(part.num_rows, pa.string()) if k is None else part.column(k + 1) for k in at]
            yield pa.RecordBatch.from_arrays([*picked, part.column(0)], names=schema.names)

    return rows.mapInArrow(run, schema)
