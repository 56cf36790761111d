"""Supplier answers as text files: written as an export would be, read with a declared schema, broken lines kept apart."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffloom import schemas
from tariffloom.sources.sinks import stored, stored_root
from tariffloom.sources.stored import conform, parse_text_dates, text_schema

BROKEN = "_corrupt_record"


def answer_line(values: dict[str, str], cut: str = "false") -> str:
    """SQL of one line: the declared fields in their order, absent ones empty. Where ``cut`` holds, the line ends half way."""
    fields = ", ".join(f"coalesce(cast({values[f.name]} as string), '')" if f.name in values else "''" for f in schemas.API)
    whole = f"concat_ws(',', {fields})"
    return f"if({cut}, substring({whole}, 1, cast(length({whole}) / 2 as int)), {whole})"


def write_lines(lines: DataFrame) -> str:
    """``lines`` (one text column) to a folder of this session; its path."""
    path = f"{stored_root(lines.sparkSession)}/answers-{uuid.uuid4().hex}"
    lines.write.text(path)
    return path


def read_answers(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Typed answers, and the lines that are none (``line``), of all files under ``path``.

    A line with too few or too many fields, or with text where a number belongs, is broken. Which lines are must not depend on the columns
    a query reads, so the text is parsed whole and once, into a stored table. A date that can't be read is NULL, as in the
    contract tables; blanks are NULL.
    """
    declared = T.StructType([*text_schema(schemas.API), T.StructField(BROKEN, T.StringType())])
    reader = spark.read.schema(declared).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN)
    lines = stored(reader.option("columnPruning", "false").csv(path))
    good = lines.filter(F.col(BROKEN).isNull()).drop(BROKEN)
    return conform(parse_text_dates(good, schemas.API), "api"), lines.filter(F.col(BROKEN).isNotNull()).select(F.col(BROKEN).alias("line"))
