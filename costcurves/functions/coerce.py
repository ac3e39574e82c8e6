"""Column coercions (numeric, timestamp, key) and the reporting cast.

Numbers that cannot be read become 0; timestamps that cannot be read raise.
Everything here is a built-in Catalyst expression, so it stays inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A plain decimal or scientific literal, as a numeric parser accepts it
# ('1,000', '1d', 'abc' are rejected; Spark's own cast would accept '1d').
_NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def to_decimal_or_zero(df: DataFrame, name: str, dtype: T.DecimalType) -> Column:
    """Numeric coercion with bad or missing values -> 0, as an exact decimal."""
    src = _type_of(df, name)
    c = F.col(name)
    if isinstance(src, T.StringType):
        parsed = F.when(c.rlike(_NUMBER_TEXT), F.trim(c).try_cast(dtype))
    elif isinstance(src, (T.DoubleType, T.FloatType)):
        parsed = F.when(~F.isnan(c), c.try_cast(dtype))
    else:
        parsed = c.try_cast(dtype)
    return F.coalesce(parsed, F.lit(0).cast(dtype))


def to_double_or_zero(df: DataFrame, name: str) -> Column:
    """Numeric coercion to double with bad, missing or NaN values -> 0.0."""
    src = _type_of(df, name)
    c = F.col(name)
    if isinstance(src, T.StringType):
        parsed = F.when(c.rlike(_NUMBER_TEXT), F.trim(c).try_cast("double"))
    else:
        parsed = c.try_cast("double")
    return F.coalesce(F.nanvl(parsed, F.lit(None).cast("double")), F.lit(0.0))


def to_timestamp_strict(df: DataFrame, name: str) -> Column:
    """Timestamp coercion that raises on unreadable text, whatever the ANSI setting."""
    src = _type_of(df, name)
    c = F.col(name)
    if isinstance(src, T.TimestampNTZType):
        return c
    if isinstance(src, T.StringType):
        parsed = F.trim(c).try_cast("timestamp_ntz")
        return F.when(c.isNotNull() & parsed.isNull(),
                      F.raise_error(F.concat(F.lit(f"unreadable timestamp in {name}: "), c))
                      ).otherwise(parsed).cast("timestamp_ntz")
    return c.cast("timestamp_ntz")


def key_as_string(name: str) -> Column:
    """Key columns are text in every output; null stays null."""
    return F.col(name).cast("string").alias(name)


def for_report(df: DataFrame) -> DataFrame:
    """Cast exact decimals to double and small integers to bigint at the edge.

    The decimal -> double cast is correctly rounded, so a value computed
    exactly here and exactly elsewhere reports as the same double.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
