"""DataFrame-level operators."""

from terrace.operators.combine import (
    consolidate, count_rows, dedupe, distinct_members, distinct_values, first_non_null, preview,
    sorted_distinct_values, union_all_by_name,
)
from terrace.operators.keys import add_surrogate_key
from terrace.operators.profile import describe_schema, profile_filter
from terrace.operators.shape import explode_records, fill_nulls, flatten_struct, keep_matching, with_constant
from terrace.operators.star import (
    DimRef, Dimension, DimensionSpec, build_dimension, build_dimensions, build_fact, lookup, materialize,
    size_checked_broadcast, star_rollup, store_dimension,
)

__all__ = [
    "consolidate", "count_rows", "dedupe", "distinct_members", "distinct_values", "first_non_null",
    "preview", "sorted_distinct_values", "union_all_by_name", "add_surrogate_key", "describe_schema",
    "profile_filter", "explode_records", "fill_nulls", "flatten_struct", "keep_matching",
    "with_constant", "DimRef", "Dimension", "DimensionSpec", "build_dimension", "build_dimensions",
    "build_fact", "lookup", "materialize",
    "size_checked_broadcast", "star_rollup", "store_dimension",
]
