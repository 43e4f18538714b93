"""CSV readers for the raw, trusted and refined zones.

One dialect serves all readers and writers of the library, so that any text
comes back as it was: a quote inside a field is doubled, blanks are kept, a
field may hold line breaks, NULL is an empty field and the empty text a
quoted one.  A field with line breaks means that a file is read whole by one
task, so the writers bound the rows of a file.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType


#: Options of both readers and writers.
DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
           "ignoreTrailingWhiteSpace": "false"}
#: An empty field reads as this noncharacter inside the parser, then as NULL; a quoted empty one as the empty text.
READ_OPTIONS = {**DIALECT, "nullValue": "\uffff", "emptyValue": "", "multiLine": "true", "mode": "PERMISSIVE"}
WRITE_OPTIONS = {**DIALECT, "nullValue": "", "emptyValue": '""'}


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None,
             sep: str = ",", header: bool = True, infer: bool = False,
             **options: str) -> DataFrame:
    """Read a CSV file or folder.

    With ``schema`` nothing is inferred (no extra pass over the data, fixed
    types every run); the schema is matched to the columns by position, as
    Spark's CSV reader does.  ``infer=True`` without a schema costs a full
    extra scan and should stay for small files only.
    """
    reader = spark.read.options(header=header, sep=sep, **{**READ_OPTIONS, **options})
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer)
    return reader.csv(list(path) if not isinstance(path, str) else path)


def read_csv_strings(spark: SparkSession, path: str | Sequence[str], sep: str = ",",
                     check_headers: bool = True, **options: str) -> DataFrame:
    """Column names from the header, every value as text (no inference).

    A folder read takes its column names from one file and every other
    file's values by position.  With ``check_headers`` each file's header is
    compared with those names as the file is read, and a file laid out
    differently fails the job instead of shifting its values into the wrong
    columns; read such folders per layout (``read_csv_layouts``).
    """
    df = read_csv(spark, path, None, sep=sep, header=True, infer=False, **options)
    if not check_headers:
        return df
    schema = StructType([StructField(f.name, f.dataType) for f in df.schema.fields])
    return read_csv(spark, path, schema, sep=sep, header=True, enforceSchema="false",
                    **options)


def read_or_empty(spark: SparkSession, read: Callable[[], DataFrame],
                  schema: StructType) -> DataFrame:
    """``read()``, or an empty table of ``schema`` when the input does not exist."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return spark.createDataFrame([], schema)
        raise


def read_csv_layouts(spark: SparkSession, groups: Sequence[str | Sequence[str]], sep: str = ",",
                     **options: str) -> DataFrame:
    """Files whose headers differ, read one layout at a time and unioned by name.

    A single read of a folder takes every file's columns by the position
    given in the first header; when a later file orders its columns otherwise
    the values land in the wrong columns.  Reading each layout on its own and
    unioning by name keeps them apart; columns a layout lacks become NULL.
    """
    frames = [read_csv_strings(spark, g, sep=sep, **options) for g in groups]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_partitioned_csv(spark: SparkSession, root: str, schema: StructType, sep: str = "|",
                         paths: Sequence[str] | None = None) -> DataFrame:
    """A Hive-partitioned CSV table; partition columns are typed by ``schema``.

    ``paths`` may name some partition folders only; ``basePath`` keeps the
    partition column on them.  Filters on a partition column prune folders
    without opening files.
    """
    reader = spark.read.schema(schema).options(header=True, sep=sep, basePath=root, **READ_OPTIONS)
    return reader.csv(list(paths) if paths else root)
