"""Cleaning expressions. All of them are built-in Catalyst expressions (JVM side,
whole-stage codegen); none throws under ANSI mode: malformed input becomes NULL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The accent map used by the admissions job (lower-case letters only;
# capital accented letters pass through unchanged unless fold_upper=True).
ACCENTED = "áàãâäéèêëíìîïóòõôöúùûüç"
UNACCENTED = "aaaaaeeeeiiiiooooouuuuc"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# What a cast of text ignores around a value, and the shapes that may be cast at all. Text of
# another shape is NULL without trying: a failing cast costs an exception for each value.
_PAD = r"[\x00-\x20\x7F-\x9F\p{Z}]*"
_WHOLE = rf"^{_PAD}[+-]?[0-9]+{_PAD}$"
_SHAPES = {"tinyint": _WHOLE, "smallint": _WHOLE, "int": _WHOLE, "integer": _WHOLE, "bigint": _WHOLE, "long": _WHOLE,
           "boolean": rf"(?i)^{_PAD}(t|true|y|yes|1|f|false|n|no|0){_PAD}$"}


def try_cast(c: str | Column, to: str) -> Column:
    """Tolerant cast: text that does not parse becomes NULL (``' 7 '`` -> 7, ``'7.9'`` -> NULL
    for int, ``'y'``/``'1'`` -> true for boolean)."""
    col, shape = _col(c), _SHAPES.get(to.lower())
    if shape is None:
        return col.try_cast(to)
    # typeof is folded while the plan is made; other types than text are cast as they are.
    return F.when((F.typeof(col) != "string") | col.cast("string").rlike(shape), col.try_cast(to))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Tolerant casts of several columns in one projection (missing columns are ignored)."""
    present = {c.lower(): c for c in df.columns}
    mapping = {present[k.lower()]: try_cast(F.col(f"`{present[k.lower()]}`"), t)
               for k, t in types.items() if k.lower() in present}
    return df.withColumns(mapping) if mapping else df


def parse_date(c: str | Column, pattern: str = "dd/MM/yyyy") -> Column:
    """Text -> DATE with ``pattern``; any trailing time in the pattern is discarded.
    Impossible dates (``31/02/2020``) and malformed text give NULL."""
    return F.try_to_date(_col(c), pattern)


def combine_date_time(date_col: str | Column, time_col: str | Column,
                      pattern: str = "yyyy-MM-dd HH:mm") -> Column:
    """DATE + ``HH:mm`` text -> TIMESTAMP, only when the time part is present.

    ``concat_ws`` skips NULLs, so the guard keeps a date-only string from being parsed.
    """
    t = _col(time_col)
    return F.when(t.isNotNull(), F.try_to_timestamp(F.concat_ws(" ", _col(date_col), t), F.lit(pattern)))


def normalize_text(c: str | Column, fold_upper: bool = False) -> Column:
    """Upper-case text with the lower-case accents removed first (``são joão`` -> ``SAO JOAO``).

    As in the source job, capital accented letters survive (``Á`` stays ``Á``) because the
    accent map only lists lower-case letters and upper-casing runs afterwards.
    ``fold_upper=True`` lower-cases first, so capitals lose their accents too.
    """
    base = _col(c)
    if fold_upper:
        base = F.lower(base)
    return F.upper(F.translate(base, ACCENTED, UNACCENTED))


def parse_decimal_comma(c: str | Column, to: str = "double") -> Column:
    """``'1234,56'`` -> 1234.56. Thousands separators are not removed, so ``'1.234,56'``
    becomes ``'1.234.56'`` and then NULL, without a failing cast, which costs an exception for each
    value: no number has two points."""
    text = F.replace(_col(c).cast("string"), F.lit(","), F.lit("."))
    if not to.lower().startswith(("double", "float", "decimal")):
        return text.try_cast(to)
    return F.when(F.substring_index(text, ".", 2) == text, text.try_cast(to))


def underscores_to_spaces(c: str | Column) -> Column:
    return F.regexp_replace(_col(c), "_", " ")


def recode(c: str | Column, mapping: Mapping, default=None) -> Column:
    """Map code values to labels with a ``CASE`` chain.

    With ``default`` the ELSE branch catches unknown codes *and* NULL; without it they
    become NULL. Keys are compared in the column's own type; for integer codes stored as
    text use ``recode_numeric_text`` so a stray text value cannot raise under ANSI mode.
    """
    src = _col(c)
    expr = None
    for code, label in mapping.items():
        cond = src == F.lit(code)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default)) if default is not None else expr


def recode_numeric_text(c: str | Column, mapping: Mapping[int, str], default=None) -> Column:
    """``recode`` for integer codes stored as text: compares ``try_cast(c AS INT)``."""
    return recode(_col(c).try_cast("int"), mapping, default)
