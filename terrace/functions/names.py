"""Column-name shaping: bulk rename, lower-casing, storable ("safe") names."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping

from pyspark.sql import DataFrame


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename many columns in one plan node. Source names are matched case-insensitively
    and missing ones are ignored (older extracts lack some columns). Two present columns
    renamed to one name (both spellings of a field in one extract) is an error."""
    _check_unique(df.columns)
    present = {c.lower(): c for c in df.columns}
    resolved = {present[src.lower()]: dst for src, dst in mapping.items() if src.lower() in present}
    if not resolved:
        return df
    _check_unique([resolved.get(c, c) for c in df.columns])
    return df.withColumnsRenamed(resolved)


def _check_unique(names: list[str]) -> list[str]:
    """``names``, unless two are equal but for case: Spark could not tell them apart."""
    seen: dict[str, int] = {}
    for n in names:
        seen[n.lower()] = seen.get(n.lower(), 0) + 1
    dup = sorted(n for n in names if seen[n.lower()] > 1)
    if dup:
        raise ValueError(f"column names collide after renaming: {dup}")
    return names


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name (Unicode aware); fails on a collision."""
    return df.toDF(*_check_unique([c.lower() for c in df.columns]))


def safe_column_name(name: str) -> str:
    """``'Perímetro Urbano'`` -> ``'perimetro_urbano'``: strip accents, lower-case, and turn
    spaces, commas, hyphens and other non-word characters into single underscores."""
    stripped = "".join(ch for ch in unicodedata.normalize("NFKD", name) if not unicodedata.combining(ch))
    cleaned = re.sub(r"[^0-9a-zA-Z_]+", "_", stripped.lower())
    return re.sub(r"_+", "_", cleaned).strip("_") or "col"


def safe_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*_check_unique([safe_column_name(c) for c in df.columns]))
