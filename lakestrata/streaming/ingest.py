"""Load new source files into the raw zone with Structured Streaming.

The batch path (``plans.ingest``) lists both sides and anti-joins them.  A
file stream does the same bookkeeping itself: its checkpoint records which
files were committed, so each run reads only files it has not seen, and an
``availableNow`` trigger processes them and stops — a batch job with memory.
Each batch goes through the batch path's writer, so both fill one zone in one
layout, replace the folders of their keys, and see each other's keys.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakestrata.functions.keys import file_key
from lakestrata.plans.ingest import KEY, record_loaded
from lakestrata.session import checkpoint_root
from lakestrata.sources.csv import READ_OPTIONS
from lakestrata.sources.listing import any_case
from lakestrata.sources.sinks import write_csv


def default_checkpoint(spark: SparkSession, lake_dir: str) -> str:
    """A stable checkpoint per target folder, below the shared checkpoint root."""
    tag = hashlib.sha1(lake_dir.encode()).hexdigest()[:16]
    return f"{checkpoint_root(spark)}/lakestrata/ingest-{tag}"


def ingest_new_files(spark: SparkSession, source_dir: str, schema: StructType, lake_dir: str,
                     checkpoint: str | None = None, *, src_sep: str = ",",
                     lake_sep: str = "|", ext: str = ".csv", key_col: str = KEY,
                     max_files_per_trigger: int | None = None,
                     wait: bool = True) -> StreamingQuery:
    """Rows of not yet loaded files to ``lake_dir``, keyed by file name."""
    # Every file's header is checked against the schema's names, so a file
    # laid out otherwise stops the stream instead of shifting its values.
    reader = spark.readStream.schema(schema).options(
        header=True, sep=src_sep, enforceSchema=False, pathGlobFilter=f"*{any_case(ext)}", **READ_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.csv(source_dir).withColumn(key_col, file_key(F.col("_metadata.file_path"), ext))

    def load(batch: DataFrame, _: int) -> None:
        write_csv(batch, lake_dir, sep=lake_sep, partition_by=[key_col], dynamic_overwrite=True)
        record_loaded(batch.select(F.col(key_col).alias(KEY)), lake_dir)

    query = (rows.writeStream.foreachBatch(load)
             .option("checkpointLocation", checkpoint or default_checkpoint(spark, lake_dir))
             .trigger(availableNow=True).start())
    if wait:
        query.awaitTermination()
    return query
