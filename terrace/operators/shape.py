"""Row and column shaping: explode/flatten, regex row filter, NULL filling, constants."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def explode_records(df: DataFrame, field: str, alias: str = "rec", keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of the array column ``field`` (NULL or empty array -> no row),
    with a struct element flattened into top-level columns (a scalar element becomes
    column ``alias``). ``keep`` columns of the parent row are carried along."""
    carried = [F.col(f"`{c}`") for c in keep]
    exploded = df.select(*carried, F.explode(F.col(f"`{field}`")).alias(alias))
    element = exploded.schema[alias].dataType
    if isinstance(element, T.StructType):
        return exploded.select(*carried, f"{alias}.*")
    return exploded


def flatten_struct(df: DataFrame, field: str) -> DataFrame:
    """Replace struct column ``field`` by its fields (``field.*``), keeping the other columns."""
    others = [F.col(f"`{c}`") for c in df.columns if c != field]
    return df.select(*others, f"`{field}`.*")


def keep_matching(df: DataFrame, column: str, regex: str) -> DataFrame:
    """Keep rows whose ``column`` is not NULL and matches ``regex`` (numbers are matched
    on their text form)."""
    c = F.col(f"`{column}`")
    return df.filter(c.isNotNull() & c.cast("string").rlike(regex))


def _fill_compatible(dtype: T.DataType, value) -> bool:
    if isinstance(value, bool):
        return isinstance(dtype, T.BooleanType)
    if isinstance(value, (int, float)):
        return isinstance(dtype, T.NumericType)
    if isinstance(value, str):
        return isinstance(dtype, T.StringType)
    return False


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULLs column by column. A value is only applied to a column of a matching
    type (text into text columns, numbers into numeric ones); missing columns are ignored."""
    types = {f.name: f.dataType for f in df.schema.fields}
    applicable = {c: v for c, v in values.items() if c in types and _fill_compatible(types[c], v)}
    return df.fillna(applicable) if applicable else df


def with_constant(df: DataFrame, name: str, value=1) -> DataFrame:
    """Add a constant measure column (a row counter for additive facts)."""
    return df.withColumn(name, F.lit(value))

