"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """A-Z only; other capitals stay. All-ASCII text takes the quicker function of the same result."""
    return F.when(F.length(col) == F.octet_length(col), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def broadcast_if_small(df: DataFrame, size: Column, most: int = 8 << 20) -> tuple[DataFrame, bool]:
    """``df`` with a broadcast hint if ``size`` bytes a row, summed, stay within ``most``; and whether they do."""
    total = df.agg(F.sum(size + 64)).first()[0] or 0
    return (F.broadcast(df), True) if total <= most else (df, False)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one in the warehouse, which is shared as well, where the session names none."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(named or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints")
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this session wrote."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def fold(doc_id: str, folds: int) -> Column:
    """Fold of a row: crc32 of the id as text. A NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds


def row_of_each(rows: DataFrame, *cols: str) -> DataFrame:
    """``cols`` and text: of the rows that agree in ``cols``, the one with the least hash of its text. Partial minima, so an id
    with very many rows is a row per task."""
    least = rows.groupBy(*cols).agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    return least.select(*cols, F.col("least.text").alias("text"))


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema) -> DataFrame:
    """``fn`` over the Arrow batches of each partition. The subpackage's code travels with the task, so the workers need not
    have it installed."""
    cloudpickle.register_pickle_by_value(sys.modules[__package__])
    return df.mapInArrow(fn, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column; NULL is empty."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary())
    return [b"" if x is None else x for x in column.to_pylist()]


def ids_of(batch: pa.RecordBatch, name: str = "doc_id") -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (src, dst: long, not NULL): node, component (its smallest node).

    Alternating large-star and small-star steps, each a minimum per node and a join back, until nothing changes:
    a logarithmic number of rounds in practice. Each round's edges are checkpointed. A hub's neighbours are spread by
    partial aggregation and by the skew handling of the joins; no neighbour list is gathered.
    """
    a, b = F.col("src"), F.col("dst")
    edges = checkpointed(edges.filter(a != b).select(F.greatest(a, b).alias("src"), F.least(a, b).alias("dst")).distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(b.alias("src"), a.alias("dst")))
        least = both.groupBy("src").agg(F.least(F.min("dst"), F.first("src")).alias("low"))
        # large star: larger neighbours move to the smallest neighbour
        large = both.filter(b > a).join(least, "src").filter("dst <> low").select(b.alias("src"), F.col("low").alias("dst")).distinct()
        # small star: smaller neighbours, and the node itself, move to the smallest one
        low = large.groupBy("src").agg(F.min("dst").alias("low"))
        joined = large.join(low, "src")
        small = (
            joined.filter("dst <> low").select(b.alias("src"), F.col("low").alias("dst"))
            .unionByName(joined.select("src", F.col("low").alias("dst"))).distinct()
        )
        edges = checkpointed(small)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    nodes = edges.select(a.alias("node"), b.alias("component"))
    return nodes.unionByName(edges.select(b.alias("node"), b.alias("component")).distinct())
