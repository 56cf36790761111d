"""Load step: contract tables written once, as tables in buckets of contracts, their rules numbered.

A stored rule has no id. Making one from its content reads every column at each scan and gives equal rules one id, so that
crowded contracts of equal rules can't be spread. Here a rule gets a dense number, and equal rules numbers for their
copies, when it is loaded; a scan then reads the columns that a query asks for.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tariffloom.operators import pieces
from tariffloom.sources.sinks import stored, stored_root
from tariffloom.sources.stored import RULE_TABLES, conform

COPY = "rule_copy"
CHUNK = 1 << 12  # copies of a rule that are written out beside each other
#: Contract tables that are joined on the contract.
CONTRACT_TABLES = ("ccon", "cnct", "cnha", *RULE_TABLES, "cnoe")


def _digest(rules: DataFrame) -> Column:
    return F.md5(F.to_json(F.struct(*[f"`{c}`" for c in rules.columns]), {"ignoreNullFields": "false"}))


def numbered(rules: DataFrame) -> DataFrame:
    """``rules`` with ``rule_id`` (1, 2, .. by contract, then content) and ``rule_copy`` (1, 2, .. among equal rows).

    The numbers are the same at every load of the same rows (of a declared rule table: no floating-point columns). Equal rows are counted, combined before their shuffle, and numbered as they are
    written out again, many copies in chunks that are dealt anew. Rows are then range-partitioned by contract, digest and copy, so that equal
    rows, however many, lie in several pieces; a piece's offset is the sum of the sizes before it.
    """
    counted = rules.groupBy(*[f"`{c}`" for c in rules.columns]).agg(F.count(F.lit(1)).alias("_n")).withColumn("_digest", _digest(rules))
    n, one = F.col("_n"), F.lit(1).cast("long")
    few = counted.filter(n <= CHUNK).withColumn(COPY, F.explode(F.sequence(one, n)))
    chunks = counted.filter(n > CHUNK).withColumn("_from", F.explode(F.sequence(one, n, F.lit(CHUNK).cast("long")))).repartition("_digest", "_from")
    many = chunks.withColumn(COPY, F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + (CHUNK - 1), n)))).drop("_from")
    rows = stored(pieces.placed(few.unionByName(many), [F.col("file_id"), F.col("_digest"), F.col(COPY)], [*rules.columns, COPY]))
    piece = F.shiftright("_at", 33).alias("_piece")
    sizes = rows.groupBy(piece).agg(F.count(F.lit(1)).alias("_size"))  # a row a piece
    earlier = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(sizes.select("_piece", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")))
    within = F.col("_at").bitwiseAND((1 << 33) - 1)
    return rows.withColumn("_piece", piece).join(offsets, "_piece").select(
        *[f"`{c}`" for c in rules.columns], (F.col("_offset") + within + 1).alias("rule_id"), COPY)


def contract_rows(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows of every contract (``file_id``) of the tables, ``_n``, and of all contracts before it, by table and contract, ``_before``."""
    parts = [df.groupBy("file_id").agg(F.count(F.lit(1)).alias("_n")).withColumn("_table", F.lit(name)) for name, df in frames.items()]
    counts = stored(pieces.placed(reduce(DataFrame.unionByName, parts), [F.col("_table"), F.col("file_id")])).withColumn(
        "_piece", F.shiftright("_at", 33))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("_piece").agg(F.sum("_n").alias("_total"))  # a row a piece
    offsets = totals.select("_piece", F.coalesce(F.sum("_total").over(earlier(Window.orderBy("_piece"))), F.lit(0)).alias("_offset"))
    within = F.coalesce(F.sum("_n").over(earlier(Window.partitionBy("_piece").orderBy("_at"))), F.lit(0))
    return stored(counts.withColumn("_within", within).join(offsets, "_piece").select(
        "_table", "file_id", "_n", (F.col("_offset") + F.col("_within")).alias("_before")))


def numbered_in_buckets(rules: DataFrame, earlier: DataFrame, buckets: int) -> DataFrame:
    """The same numbers as ``numbered`` where no contract is larger than a bucket: rules are dealt once, into the buckets they are written to, and
    numbered there after the rows of earlier contracts (``file_id``, ``_offset``). Rows without a contract come first."""
    order = Window.partitionBy("file_id").orderBy("_digest")
    rows = rules.repartition(buckets, "file_id").withColumn("_digest", _digest(rules)).withColumns(
        {"_place": F.row_number().over(order), "_first": F.rank().over(order)})
    met = rows.join(earlier.repartition(buckets, "file_id"), "file_id", "left")
    return met.select(
        *[f"`{c}`" for c in rules.columns], (F.coalesce("_offset", F.lit(0)) + F.col("_place")).alias("rule_id"),
        (F.col("_place") - F.col("_first") + 1).cast("long").alias(COPY))


def bucket_count(tables: Sequence[DataFrame], per_bucket: int) -> int:
    """A power of two, so that the largest table has about ``per_bucket`` rows a bucket."""
    return _buckets(max((t.count() for t in tables), default=0), per_bucket)


def _buckets(most: int, per_bucket: int) -> int:
    count = 1
    while count * per_bucket < most:
        count *= 2
    return count


class LoadedContracts:
    """Tables of a load, under the names the operators use."""

    def __init__(self, spark: SparkSession, prefix: str):
        self.spark, self.prefix = spark, prefix

    def table(self, name: str) -> DataFrame:
        return self.loaded(name).drop(COPY).withColumnRenamed("supplement_or_discount_code", "code")

    def loaded(self, name: str) -> DataFrame:
        """With the numbers of copies, under the declared names."""
        return self.spark.table(f"{self.prefix}_{name}")


def load_contracts(source, spark: SparkSession, prefix: str, names: Sequence[str] = CONTRACT_TABLES, root: str | None = None,
                   per_bucket: int = 1 << 20) -> LoadedContracts:
    """Write ``names`` of ``source`` (``table(name)``) as ``<prefix>_<name>``, at ``root`` where it is given, else in the warehouse.

    All tables of a load have the same number of buckets, so those in buckets join on the contract without a shuffle.
    """
    frames = {}
    for name in names:
        df = source.table(name)
        if "code" in df.columns:
            df = df.withColumnRenamed("code", "supplement_or_discount_code")
        frames[name] = conform(df, name)
    contracts = contract_rows(frames)
    sizes = {r["_table"]: r for r in contracts.groupBy("_table").agg(
        F.sum("_n").alias("rows"), F.max("_n").alias("largest"), F.min("_before").alias("start")).collect()}
    buckets = _buckets(max((r["rows"] for r in sizes.values()), default=0), per_bucket)
    for name, df in frames.items():
        # a bucket is read by one task, so a table in which one contract is larger is written without buckets: its joins shuffle, and skewed
        # contracts are split there
        if name in sizes and sizes[name]["largest"] > per_bucket:
            rows = stored(numbered(df)) if name in RULE_TABLES else df
            writer = rows.repartitionByRange("file_id", F.rand(7)).sortWithinPartitions("file_id").write
        else:
            # a task's rows belong to whole buckets, as the writer hashes contracts in the same way: a file a bucket
            earlier = contracts.filter(F.col("_table") == name).select("file_id", (F.col("_before") - (sizes[name]["start"] if name in sizes else 0)).alias("_offset"))
            rows = numbered_in_buckets(df, earlier, buckets) if name in RULE_TABLES else df.repartition(buckets, "file_id")
            writer = rows.write.bucketBy(buckets, "file_id").sortBy("file_id")
        if root:
            writer = writer.option("path", f"{root}/{name}")
        writer.mode("overwrite").format("parquet").saveAsTable(f"{prefix}_{name}")
    return LoadedContracts(spark, prefix)


def load_rules(source, spark: SparkSession) -> LoadedContracts:
    """The rule tables, loaded among this session's intermediate tables."""
    mark = uuid.uuid4().hex
    return load_contracts(source, spark, f"rules_{mark}", RULE_TABLES, f"{stored_root(spark)}/{mark}")
