"""Typed CSV landing in one parse: text is staged as columns while its types are worked out.

Reading a CSV extract with inferred types normally parses it twice, once to infer and once to
read. Here one job parses it, writes the values as text columns to the shared folder, and folds
every column's types on the way. The fold is a lattice: each value has a set of types that can
hold it, sets meet by intersection, and the column gets the narrowest type left in the meet of
all its values. Intersection is associative and commutative, so tasks fold in any order
(``bit_and``) and the result does not depend on how the extract is split. The typed table is a
projection of the staged columns.

The types are those of Spark's own inference: whole numbers widen from int to long, decimal and
double, dates to timestamps, true and false are boolean; numbers, times and truth values do not
mix, and whatever nothing else holds is text. A column without values is text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrace.session import shared_dir

# Types from narrow to wide within their family, each with its bit.
_BITS = 7
INT, LONG, DECIMAL, DOUBLE, DATE, TIMESTAMP, BOOLEAN = (1 << k for k in range(_BITS))
_SHORT = r"^[0-9]{1,9}$"
_WHOLE = r"^[+-]?[0-9]+$"
# How everything but words, truth values and times with a leading T begins.
_NUMBER_OR_TIME = r"^(?:[0-9\x00-\x20+.-]|Na|In)"
_DOUBLE = (r"^\s*[+-]?(?:NaN|Inf|Infinity|(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
           r"|0[xX][0-9a-fA-F]*\.?[0-9a-fA-F]*[pP][+-]?[0-9]+)[fFdD]?)\s*$")
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^\s*(?:[0-9]{4,6}(?:-[0-9]{1,2}(?:-[0-9]{1,2}(?:[ T].*)?)?)?|T?[0-9]{1,2}:[0-9]{1,2}.*)\s*$"
_MOST_DIGITS = 38


def _digits(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"^[+-]?0*", ""))


def types_that_hold(text: Column) -> Column:
    """The bits of all types that can hold a value; NULL for NULL, 0 if only text can.

    It runs for every value of an extract, mostly as it is written here, so the commonest kinds are
    told by one test each: no type but text holds a comma, short whole numbers and dates have a
    shape of their own, and how a value begins rules numbers and times out for most words.
    """
    head = F.ascii(text)
    as_long = text.try_cast("bigint")
    whole = (F.when((F.length(text) <= 9) | as_long.between(-(1 << 31), (1 << 31) - 1), INT | LONG | DECIMAL | DOUBLE)
             .when(as_long.isNotNull(), LONG | DECIMAL | DOUBLE)
             .when(_digits(text) <= _MOST_DIGITS, DECIMAL | DOUBLE).otherwise(DOUBLE))
    time = F.when((text.contains("-") | text.contains(":")) & text.rlike(_TIME) & text.try_cast("timestamp").isNotNull(), TIMESTAMP)
    word = (F.when(~head.isin(*map(ord, "TtFf")), 0).when(F.lower(text).isin("true", "false"), BOOLEAN)
            .when(head == ord("T"), F.coalesce(time, F.lit(0))).otherwise(0))
    return (F.when(text.isNull(), F.lit(None).cast("int")).when(text.contains(","), 0)
            .when(text.rlike(_SHORT), INT | LONG | DECIMAL | DOUBLE).when(~text.rlike(_NUMBER_OR_TIME), word)
            .when((F.length(text) == 10) & text.rlike(_DATE) & text.try_cast("date").isNotNull(), DATE | TIMESTAMP)
            .when(text.rlike(_WHOLE), whole)
            .when(~text.contains("/") & ~text.contains(":") & text.rlike(_DOUBLE) & text.try_cast("double").isNotNull(), DOUBLE)
            .otherwise(F.coalesce(time, F.lit(0))))


def narrowest(bits: int | None, digits: int | None) -> str:
    """The type for the meet of all values' bits (None: no values)."""
    names = ((INT, "int"), (LONG, "bigint"), (DECIMAL, f"decimal({max(20, digits or 0)},0)"), (DOUBLE, "double"),
             (DATE, "date"), (TIMESTAMP, "timestamp"), (BOOLEAN, "boolean"))
    return next((name for bit, name in names if (bits or 0) & bit), "string")


def land_csv(spark: SparkSession, path: str | list[str], delimiter: str = ",", header: bool = True) -> DataFrame:
    """A headered CSV extract as a table with the types of its values; parsed once, now.

    Every column is kept, under its name in the file. The result reads the staged text columns,
    so it can be evaluated any number of times without touching the extract again.
    """
    text = spark.read.option("header", header).option("delimiter", delimiter).csv(path)
    names = text.columns
    staged = [f"c{k}" for k in range(len(names))]  # positions: file names may hold any character
    text = text.toDF(*staged)
    # One lambda over an array of all columns: written out for every column, the checks would be too
    # much generated code for the JVM to compile. It gives one number a value, the digits of long
    # whole numbers above the bits: making a struct for each would cost more than the checks.
    kinds = text.withColumn("kinds", F.transform(F.array(*staged), lambda x: types_that_hold(x) + F.when(
        F.octet_length(x) > 18, F.when(x.rlike(_WHOLE), F.shiftleft(_digits(x), _BITS)).otherwise(0)).otherwise(0)))
    metrics = [F.count(F.lit(1)).alias("rows")]
    for k, c in enumerate(staged):
        kind = F.get("kinds", F.lit(k))
        metrics += [F.bit_and(kind.bitwiseAND(F.lit((1 << _BITS) - 1))).alias(f"t_{c}"), F.max(F.shiftright(kind, _BITS)).alias(f"d_{c}")]
    observation = Observation(f"landing_{uuid.uuid4().hex}")  # unique: extracts may land side by side
    out = shared_dir(spark, "landing-text")
    kinds.observe(observation, *metrics).drop("kinds").write.mode("overwrite").parquet(out)
    seen = observation.get
    stored = spark.read.schema(text.schema).parquet(out)
    typed = [(c, name, narrowest(seen.get(f"t_{c}"), seen.get(f"d_{c}"))) for c, name in zip(staged, names)]
    return stored.select(*[(F.col(c) if kind == "string" else F.col(c).try_cast(kind)).alias(name) for c, name, kind in typed])
