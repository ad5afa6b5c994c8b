"""Lenient typing: text that cannot be read as the wanted type becomes null, never an error."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# Text accepted as a number. Spark's own cast also takes suffixes such as '1.0f'.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|inf|Inf|infinity|Infinity)\s*$"

WHOLE = r"^[+-]?\d+$"

# The only spellings taken as booleans.
TRUE_WORDS = ("true", "True", "1")
FALSE_WORDS = ("false", "False", "0")


def cast_timestamp(col: Column) -> Column:
    return F.trim(col.cast("string")).try_cast("timestamp_ntz")


def cast_double(col: Column) -> Column:
    text = col.cast("string")
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def cast_int_rounded(col: Column) -> Column:
    """Nearest whole number, halves to even. Whole numbers keep all their digits; beyond 64 bits it is null."""
    text, near = F.trim(col.cast("string")), F.rint(cast_double(col))
    fits = (near >= -(2.0**63)) & (near < 2.0**63)  # a cast would take larger ones to the largest
    return F.when(text.rlike(WHOLE), text.try_cast("bigint")).otherwise(F.when(fits, near.cast("bigint")))


def cast_bool_map(col: Column) -> Column:
    """Numbers equal to 1 and 0 are the spellings ``1`` and ``0``; text must be a spelling as it stands."""
    text = col.cast("string")
    number = F.typeof(col).isin("double", "float", "tinyint", "smallint", "int", "bigint") | F.typeof(col).startswith("decimal")
    text = F.when(number & (text.try_cast("double") == 1), F.lit("1")).when(number & (text.try_cast("double") == 0), F.lit("0")).otherwise(text)
    return F.when(text.isin(*TRUE_WORDS), F.lit(True)).when(text.isin(*FALSE_WORDS), F.lit(False))


def cast_string(col: Column) -> Column:
    return col.cast("string")


def finite(col: Column) -> Column:
    """NaN to null, so that comparisons treat it as missing."""
    return F.when(~F.isnan(col), col)


CASTS = {
    "timestamp": cast_timestamp,
    "int": lambda c: cast_int_rounded(c).try_cast("int"),
    "bigint": cast_int_rounded,
    "double": cast_double,
    "boolean": cast_bool_map,
    "string": cast_string,
}


def cast_frame(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Cast the mapped columns and pass the others through.

    A mapped column that is absent is only warned about; a type outside ``CASTS`` is handed to
    Spark's ``try_cast``.
    """
    for name in mapping:
        if name not in df.columns:
            log.warning("column %r is mapped but not present", name)
    out = []
    for name in df.columns:
        kind = mapping.get(name)
        if kind is None:
            out.append(F.col(name))
        elif kind in CASTS:
            out.append(CASTS[kind](F.col(name)).alias(name))
        else:
            out.append(F.col(name).try_cast(kind).alias(name))
    return df.select(*out)


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
