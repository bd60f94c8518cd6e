"""Column-level helpers: tolerant casts, date parsing, text normalisation, recodes, names."""

from terrace.functions.clean import (
    ACCENTED, UNACCENTED, cast_columns, combine_date_time, normalize_text, parse_date,
    parse_decimal_comma, recode, recode_numeric_text, try_cast, underscores_to_spaces,
)
from terrace.functions.names import lower_columns, rename, safe_column_name, safe_columns

__all__ = [
    "ACCENTED", "UNACCENTED", "cast_columns", "combine_date_time", "normalize_text",
    "parse_date", "parse_decimal_comma", "recode", "recode_numeric_text", "try_cast", "underscores_to_spaces",
    "lower_columns", "rename", "safe_column_name", "safe_columns",
]
