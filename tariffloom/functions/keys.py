"""Derived keys and portable output forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def md5_key(*parts: Column | str, sep: str = ".") -> Column:
    """md5 of the joined parts; NULL when any part is NULL (plain concatenation, not ``concat_ws``)."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    joined = [cols[0]]
    for col in cols[1:]:
        joined += [F.lit(sep), col] if sep else [col]
    return F.md5(F.concat(*joined))


def surrogate(*parts: Column | str) -> Column:
    """Stable 60-bit number from the key columns, to show; no global numbering, so no single-partition sort. Joins use the whole
    ``md5_key``."""
    return F.conv(F.substring(md5_key(*parts), 1, 15), 16, 10).cast("bigint")


def money(value: Column) -> Column:
    """Four decimals; the guard keeps exact halves from depending on the order of a distributed sum."""
    return F.round(value + F.lit(1e-7), 4) + F.lit(0.0)


def portable(df: DataFrame) -> DataFrame:
    """Dates as ISO text, decimals as double: the forms every client reads alike."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DateType, T.TimestampNTZType)):
            out.append(F.col(f.name).cast("string").alias(f.name))
        elif isinstance(f.dataType, T.DecimalType):
            out.append(F.col(f.name).cast("double").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
