"""Writers for the lake zones.

Partitioned writes go through a ``rebalance`` hint on the partition columns:
rows of a partition value meet in few tasks (few files per folder), and AQE
splits a value that holds too many rows over several tasks instead of one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from lakestrata.sources.csv import WRITE_OPTIONS

#: Rows of one CSV file at most: a file is read by one task.
ROWS_PER_FILE = 1_000_000


def _rebalanced(df: DataFrame, partition_by: Sequence[str], rebalance: bool | None) -> DataFrame:
    """Rebalance partitioned writes by default; unpartitioned ones only on request
    (it costs a shuffle, worth it only after a skewed stage)."""
    if rebalance is None:
        rebalance = bool(partition_by)
    if not rebalance:
        return df
    return df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")


def _overwrite_mode(w, dynamic: bool):
    return w.option("partitionOverwriteMode", "dynamic") if dynamic else w


def _timestamps_as_text(df: DataFrame) -> DataFrame:
    """Timestamps in their shortest text, with every digit of the second's fraction."""
    return df.withColumns({f.name: F.col(f"`{f.name}`").cast("string") for f in df.schema.fields
                           if isinstance(f.dataType, (TimestampType, TimestampNTZType))})


def write_csv(df: DataFrame, path: str, sep: str = "|", header: bool = True,
              mode: str = "overwrite", partition_by: Sequence[str] = (),
              rebalance: bool | None = None, dynamic_overwrite: bool = False,
              rows_per_file: int = ROWS_PER_FILE) -> None:
    """CSV with a header; ``mode='overwrite'`` replaces the whole table, or
    with ``dynamic_overwrite`` only the partitions present in ``df``."""
    w = (_rebalanced(_timestamps_as_text(df), partition_by, rebalance).write.mode(mode)
         .options(header=header, sep=sep, maxRecordsPerFile=rows_per_file, **WRITE_OPTIONS))
    if partition_by:
        w = _overwrite_mode(w.partitionBy(*partition_by), dynamic_overwrite)
    w.csv(path)


def write_single_csv(df: DataFrame, path: str, sep: str = "|", header: bool = True) -> None:
    """Exactly one CSV file, of any size, in one pass.

    What produces the rows keeps its parallelism; one task then streams them to the file, as a file has one writer.
    """
    write_csv(df.repartition(1), path, sep=sep, header=header, rebalance=False, rows_per_file=0)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = (), rebalance: bool | None = None,
                sep: str = "|", dynamic_overwrite: bool = False) -> None:
    """A zone table as Parquet (default) or CSV."""
    if fmt == "csv":
        write_csv(df, path, sep=sep, mode=mode, partition_by=partition_by, rebalance=rebalance,
                  dynamic_overwrite=dynamic_overwrite)
        return
    w = _rebalanced(df, partition_by, rebalance).write.mode(mode).format(fmt)
    if partition_by:
        w = _overwrite_mode(w.partitionBy(*partition_by), dynamic_overwrite)
    w.save(path)
