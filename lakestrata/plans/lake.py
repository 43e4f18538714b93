"""The whole lake run: reconcile, load what is missing, trusted, refined.

Each zone is written before the next step reads it and records the file keys it has taken in, after
its tables are written.  A step does what its input has and its record lacks, so a run that fails
anywhere is finished by the next one, and each step can be run alone.
A file's rows replace what an earlier attempt wrote of them.

New files touch the locations of their rows, from the first day of these on: only these series are
recomputed, each from its last snapshot before that day.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakestrata import schemas as S
from lakestrata.operators.reconcile import has_pending
from lakestrata.plans.checks import verify_lake
from lakestrata.plans.ingest import (
    KEY, _paths, find_missing, ingest_missing, keyed_source, lake_listing, read_missing, write_missing,
)
from lakestrata.plans.refined import STATE as LOCATION_STATE
from lakestrata.plans.refined import publish_refined, read_trusted, refine, refine_more
from lakestrata.plans.trusted import harmonise_reports, last_rows, quality_table, trusted_from_quality
from lakestrata.session import scratch_path
from lakestrata.sources.commit import has_released
from lakestrata.sources.csv import read_or_empty, read_partitioned_csv
from lakestrata.sources.headers import wide_enough
from lakestrata.sources.listing import file_keys
from lakestrata.sources.sinks import write_table

# The two report sources of the lake.
GENERAL = "general"
US = "us"
RAW_COLUMNS = {GENERAL: S.RAW_GENERAL_COLUMNS, US: S.RAW_US_COLUMNS}
TAGS = {GENERAL: S.TAG_GENERAL, US: S.TAG_US}

STATE = StructType([StructField(S.SOURCE_COLUMN, StringType()), StructField(KEY, StringType())])


@dataclass(frozen=True)
class LakePaths:
    root: str

    def raw(self, source: str) -> str:
        return f"{self.root}/raw/{source}"

    def missing(self, source: str) -> str:
        return f"{self.root}/raw/missing/{source}"

    def state(self, zone: str) -> str:
        """The file keys a zone has taken in."""
        return f"{self.root}/state/{zone}"

    @property
    def quality(self) -> str:
        return f"{self.root}/trusted/quality"

    @property
    def trusted(self) -> str:
        return f"{self.root}/trusted/base_trusted"

    @property
    def refined(self) -> str:
        return f"{self.root}/refined"


Source = str | Sequence[str]


def offered_by_folder(spark: SparkSession, source: Source) -> DataFrame:
    """What a source offers, listed from its folder(s): (Cam_Lake, DATE_KEY)."""
    first, *more = [file_keys(spark, p) for p in _paths(source)]
    for m in more:
        first = first.union(m)
    return first


def reconcile(spark: SparkSession, paths: LakePaths,
              offered: Mapping[str, DataFrame]) -> dict[str, int]:
    """Write each source's missing-key list; return how many keys each lacks."""
    return {src: write_missing(find_missing(listing, lake_listing(spark, paths.raw(src))),
                               paths.missing(src))
            for src, listing in offered.items()}


def load(spark: SparkSession, paths: LakePaths, source_dirs: Mapping[str, Source]) -> bool:
    """Load the listed missing keys of every source; False when nothing was due.

    Each source's raw files get that source's fixed column set, by name or alias.
    """
    missing = {src: read_missing(spark, paths.missing(src)) for src in source_dirs}
    if not has_pending(*missing.values()):
        return False
    for src, src_dir in source_dirs.items():
        ingest_missing(spark, src_dir, paths.raw(src), missing[src], columns=RAW_COLUMNS.get(src),
                       aliases=S.RAW_ALIASES, optional=S.RAW_OPTIONAL)
    return True


def taken_in(spark: SparkSession, paths: LakePaths, zone: str) -> DataFrame:
    """(FONTE, DATE_KEY) that a zone has recorded."""
    return read_or_empty(spark, lambda: spark.read.schema(STATE).parquet(paths.state(zone)), STATE).distinct()


def _record(keys: DataFrame, paths: LakePaths, zone: str) -> None:
    keys.write.mode("append").parquet(paths.state(zone))


def raw_keys(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """(FONTE, DATE_KEY) of all files in the raw zone."""
    a, b = [lake_listing(spark, paths.raw(src)).select(F.lit(TAGS[src]).alias(S.SOURCE_COLUMN), KEY).distinct()
            for src in (GENERAL, US)]
    return a.union(b)


def raw_rows(spark: SparkSession, paths: LakePaths, source: str) -> DataFrame:
    """A source's raw rows with their file key, all as text."""
    schema = StructType([StructField(c, StringType()) for c in [*RAW_COLUMNS[source], KEY]])
    return read_or_empty(spark, lambda: read_partitioned_csv(spark, paths.raw(source), schema, sep="|"), schema)


def build_quality(spark: SparkSession, paths: LakePaths, *, date_formats: Iterable[str] = (),
                  date_column: str = "Last_Update") -> bool:
    """Labelled rows of the raw files that the quality table lacks, a folder per source and file; False if none was due."""
    keys = [S.SOURCE_COLUMN, KEY]
    due = raw_keys(spark, paths).join(taken_in(spark, paths, "quality"), keys, "left_anti")
    if due.isEmpty():
        return False
    due = due.cache()
    try:
        frames = [raw_rows(spark, paths, src).join(
            due.where(F.col(S.SOURCE_COLUMN) == TAGS[src]).select(KEY), KEY, "left_semi") for src in (GENERAL, US)]
        labelled = quality_table(harmonise_reports(*frames, date_formats, date_column, carry=True))
        write_table(labelled.withColumn(KEY, F.col("FILE_KEY")), paths.quality,
                    partition_by=[S.SOURCE_COLUMN, KEY], dynamic_overwrite=True)
        _record(due, paths, "quality")
    finally:
        due.unpersist()
    return True


def quality_rows(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """The labelled table; the folders' values are text."""
    sample = quality_table(harmonise_reports(
        *[spark.createDataFrame([], StructType([StructField(c, StringType()) for c in [*RAW_COLUMNS[s], KEY]]))
          for s in (GENERAL, US)], carry=True))
    schema = StructType([*sample.schema.fields, StructField(KEY, StringType())])
    return read_or_empty(spark, lambda: spark.read.schema(schema).parquet(paths.quality), schema)


def touched(spark: SparkSession, paths: LakePaths, zone: str) -> tuple[bool, DataFrame | None]:
    """(due, series): whether the zone lacks files of the quality table, and the (STATE, COUNTRY, FIRST) that they touch.

    FIRST is the first touched day, NULL where the whole series is: a row without a date comes first in it.  The series are None
    where the zone is empty.
    """
    keys = [S.SOURCE_COLUMN, KEY]
    taken = taken_in(spark, paths, zone)
    due = taken_in(spark, paths, "quality").join(taken, keys, "left_anti")
    if due.isEmpty():
        return False, None
    if taken.isEmpty():
        return True, None
    rows = quality_rows(spark, paths).join(due, keys, "left_semi")
    first = F.when(F.count_if(F.col("DATE_ID").isNull()) == 0, F.min("DATE_ID"))
    return True, rows.groupBy(*S.LOCATION).agg(first.alias("FIRST"))


def _since(rows: DataFrame, series: DataFrame, how: str) -> DataFrame:
    """The rows of these series from their first touched day on (``left_semi``), or all others (``left_anti``)."""
    s = series.select(*[F.col(c).alias(f"__{c}") for c in S.LOCATION], F.col("FIRST").alias("__first"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in S.LOCATION])
    return rows.join(s, same & (F.col("__first").isNull() | (F.col("DATE_ID") >= F.col("__first"))), how)


def _before(rows: DataFrame, series: DataFrame) -> DataFrame:
    """The rows of these series before their first touched day, those without a date included."""
    s = series.where("FIRST is not null").select(*[F.col(c).alias(f"__{c}") for c in S.LOCATION], F.col("FIRST").alias("__first"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in S.LOCATION])
    return rows.join(s, same & (F.col("DATE_ID").isNull() | (F.col("DATE_ID") < F.col("__first"))), "left_semi")


def _on_days(rows: DataFrame, days: DataFrame) -> DataFrame:
    d = days.select(F.col("DATE_ID").alias("__day")).distinct()
    return rows.join(d, F.col("DATE_ID").eqNullSafe(F.col("__day")), "left_semi")


def build_trusted(spark: SparkSession, paths: LakePaths, *, fmt: str = "parquet", ignore_null_gaps: bool = False,
                  **kwargs) -> bool:
    """Bring the trusted table up to the quality table; False if it is.

    Only the series that new files touch are recomputed, each from its first touched day, and subtracted from its last snapshot
    before it.  The folders of the days on which such rows lie are replaced; the other series' rows of these days are kept as they are.
    """
    due, series = touched(spark, paths, "trusted")
    if not due:
        return False
    taken, q = taken_in(spark, paths, "quality"), quality_rows(spark, paths)
    if series is None:
        trusted = trusted_from_quality(q, ignore_null_gaps=ignore_null_gaps, **kwargs)
        write_table(trusted, paths.trusted, fmt=fmt, partition_by=["DATE_ID"])
    else:
        series = _written(series, "touched-series")
        recent = _since(q, series, "left_semi").unionByName(last_rows(_before(q, series), ignore_null_gaps))
        recent = _written(recent, "touched-rows")  # a small part of the table; the series reads it more than once
        new = _written(_since(trusted_from_quality(recent, ignore_null_gaps=ignore_null_gaps, **kwargs), series, "left_semi"), "touched-days")
        old = read_or_empty(spark, lambda: read_trusted(spark, paths.trusted, fmt), S.TRUSTED)
        kept = _written(_since(_on_days(old, new), series, "left_anti"), "kept-rows")  # its folders are replaced below
        write_table(new.unionByName(kept), paths.trusted, fmt=fmt, partition_by=["DATE_ID"], dynamic_overwrite=True)
    _record(taken.join(taken_in(spark, paths, "trusted"), [S.SOURCE_COLUMN, KEY], "left_anti"), paths, "trusted")
    return True


def build_refined(spark: SparkSession, paths: LakePaths, *, fmt: str = "parquet") -> bool:
    """Bring the star up to the trusted table; False if it is.  Only the fact's days with rows of touched series are replaced."""
    keys = [S.SOURCE_COLUMN, KEY]
    due = taken_in(spark, paths, "trusted").join(taken_in(spark, paths, "refined"), keys, "left_anti")
    if due.isEmpty():
        return False
    _, series = touched(spark, paths, "refined")
    trusted = read_trusted(spark, paths.trusted, fmt)
    days = None if series is None else _written(
        _since(trusted, _written(series, "touched-series"), "left_semi").select("DATE_ID").distinct(), "touched-days")
    tables = refine(trusted)
    if days is not None and has_released(spark, paths.refined, LOCATION_STATE):
        # Rows are only ever added: the dimensions take those of the files that the star lacks.
        new = quality_rows(spark, paths).join(due, keys, "left_semi")
        tables = refine_more(spark, trusted, new, paths.refined, fmt)
    publish_refined(tables, paths.refined, fmt, days=days)
    _record(due, paths, "refined")
    return True


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_lake(spark: SparkSession, paths: LakePaths, source_dirs: Mapping[str, Source], *,
             offered: Mapping[str, DataFrame] | None = None, fmt: str = "parquet",
             date_formats: Iterable[str] = (), date_column: str = "Last_Update", verify: bool = False,
             steps: Sequence[str] = ("load", "trusted", "refined"), **trusted_kwargs) -> dict[str, object]:
    """Reconcile and load -> trusted -> refined; ``steps`` names those to run.

    ``source_dirs`` maps ``general`` and ``us`` to folders of daily CSV files
    (``,``-separated, one file per day, in any column order), or to lists of folders;
    ``offered`` may give the source listings instead (e.g. from ``plans.ingest.source_listing`` over pages).
    Each step does what its zone lacks.  ``verify`` adds the violation counts of the
    published files' invariants, the rows of the sources against those of each zone included.
    """
    out: dict[str, object] = {}
    if "load" in steps:
        listings = offered or {src: offered_by_folder(spark, d) for src, d in source_dirs.items()}
        out["missing"] = reconcile(spark, paths, listings)
        out["loaded"] = load(spark, paths, source_dirs)
    if "trusted" in steps:
        build_quality(spark, paths, date_formats=date_formats, date_column=date_column)
        build_trusted(spark, paths, fmt=fmt, **trusted_kwargs)
    if "refined" in steps:
        build_refined(spark, paths, fmt=fmt)
    if verify:
        loaded = {src: lake_listing(spark, paths.raw(src)).select(KEY).distinct() for src in source_dirs}

        def offered_rows(src: str, fields: int) -> DataFrame:
            rows = keyed_source(spark, source_dirs[src], columns=RAW_COLUMNS[src], aliases=S.RAW_ALIASES, optional=S.RAW_OPTIONAL,
                                fields=fields)
            return rows.join(loaded[src], KEY, "left_semi")

        out["violations"] = wide_enough(lambda fields: verify_lake(
            spark, paths.refined, fmt, read_trusted(spark, paths.trusted, fmt), quality_rows(spark, paths),
            {src: (offered_rows(src, fields), raw_rows(spark, paths, src)) for src in source_dirs},
            kept={GENERAL: F.col(S.COUNTY_COLUMN).isNull(), US: F.lit(True)}))
    return out
