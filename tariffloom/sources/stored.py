"""Contract tables stored as Parquet or CSV, read with a declared schema (no inference pass over the data)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffloom import schemas


# rule tables get a stable row id: it settles ties between rules and spreads crowded contracts
RULE_TABLES = ("cnsr", "cnsu", "cngr", "cnem")


class StoredContracts:
    """``root/<table>`` per contract table, under the names the operators use.

    Text dates (``yyyyMMdd``) are parsed when ``text_dates`` is set.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", text_dates: bool = False):
        self.spark, self.root, self.fmt, self.text_dates = spark, root, fmt, text_dates

    def table(self, name: str) -> DataFrame:
        schema = schemas.TABLES[name]
        declared = text_schema(schema) if self.text_dates else schema
        reader = self.spark.read.schema(declared)
        if self.fmt == "csv":
            # as database exports write it: nothing between commas is NULL, quoted nothing is a blank
            reader = reader.option("header", "true").option("nullValue", "\\N").option("emptyValue", "")
        df = reader.format(self.fmt).load(f"{self.root}/{name}")
        if self.text_dates:
            df = parse_text_dates(df, schema)
        if name in RULE_TABLES:
            df = df.withColumn("rule_id", F.xxhash64(*schema.fieldNames()))
        return df.withColumnRenamed("supplement_or_discount_code", "code")


def text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DateType) else f.dataType) for f in schema]
    )


def parse_text_dates(df: DataFrame, schema: T.StructType, pattern: str = "yyyyMMdd") -> DataFrame:
    """Dirty text becomes NULL instead of failing the job."""
    parsed = {
        f.name: F.try_to_timestamp(F.col(f.name), F.lit(pattern)).cast("date")
        for f in schema
        if isinstance(f.dataType, T.DateType) and f.name in df.columns
    }
    return df.withColumns(parsed) if parsed else df


def conform(df: DataFrame, name: str) -> DataFrame:
    """Cast to the declared schema, add absent columns, fill the declared defaults."""
    have, defaults = set(df.columns), schemas.DEFAULTS.get(name, {})
    out = []
    for f in schemas.TABLES[name]:
        if f.name not in have:
            out.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
        else:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return df.select(*out)


def key_violations(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Keys that are NULL or occur more than once. Counts are combined before the shuffle."""
    missing = F.lit(False)
    for k in key:
        missing = missing | F.col(k).isNull()
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) | missing)
    )
