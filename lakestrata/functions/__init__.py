from lakestrata.functions.calendar import calendar_attributes
from lakestrata.functions.casts import (
    as_date, as_decimal, as_double, as_int, as_long, as_string, cast_columns, typed,
)
from lakestrata.functions.keys import (
    composite_key, extract_all, file_name, partition_value, source_url, strip_suffix,
)

__all__ = [
    "as_date", "as_decimal", "as_double", "as_int", "as_long", "as_string",
    "calendar_attributes", "cast_columns", "composite_key", "extract_all",
    "file_name", "partition_value", "source_url", "strip_suffix", "typed",
]
