"""Materialising results: create-as, truncate-and-insert, empty, delete-by-key.

Tables are replaced, never edited in place. A table that is also an input is first written under a second
name, so a lost executor can recompute its input at any time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tariffloom.schemas import CACHE
from tariffloom.session import checkpoint_dir


def write_cache(df: DataFrame, path: str, by_city: bool = False) -> None:
    """Price cache as Parquet, laid out for the search filters: country and city prune directories.

    Rebalancing sizes the files at run time: small cities share a task, a city with a third of the rows is split. Rows that ``build_cache`` has
    dealt ``by_city`` are not dealt again.
    """
    (
        (df if by_city else df.hint("rebalance", "country_code", "city_code"))
        .sortWithinPartitions("country_code", "city_code", "file_id", "lo")
        .write.mode("overwrite")
        .partitionBy("country_code", "city_code")
        .parquet(path)
    )


def refresh_cache(spark: SparkSession, df: DataFrame, path: str, contracts: DataFrame) -> None:
    """Bring the cached rows of some contracts (``file_id``) up to date: ``df`` holds their new rows.

    Only the cities that the contracts are sold in, or were, are rewritten; all other folders stay as they are. The new cities are
    written beside the cache first and then put in place by dynamic partition overwrite, so nothing is read while it is
    replaced. A city that loses its last row has nothing to overwrite it with, and its folder is removed.
    """
    city = ["country_code", "city_code"]
    old, changed = read_cache(spark, path), contracts.select("file_id").distinct()
    before = old.join(changed, "file_id", "left_semi").select(*city).distinct()
    touched = stored(before.union(df.select(*city).distinct()).distinct())
    kept = old.join(touched, city, "left_semi").join(changed, "file_id", "left_anti")
    staged = stored(kept.unionByName(df.select(*old.columns)))
    staged.hint("rebalance", *city).sortWithinPartitions(*city, "file_id", "lo").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*city).parquet(path)
    emptied = touched.join(staged.select(*city).distinct(), city, "left_anti")
    for row in emptied.toLocalIterator():  # folders, not rows: at most the cities of the changed contracts
        _delete(spark, f"{path}/country_code={_folder(row.country_code)}/city_code={_folder(row.city_code)}")


def _folder(value: str | None) -> str:
    """A partition value as Spark names its folder."""
    if value in (None, ""):
        return "__HIVE_DEFAULT_PARTITION__"
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or c in "\"#%'*/:=?\\{[]^\x7f" else c for c in value)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """Declared schema: codes that look like numbers stay text, also as directory names."""
    return spark.read.schema(CACHE).parquet(path)


def create_table_as(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def truncate_insert(df: DataFrame, name: str) -> None:
    """Columns are matched by name, then inserted by position as SQL does."""
    target = df.sparkSession.table(name).columns
    df.select(*target).write.mode("overwrite").insertInto(name, overwrite=True)


def empty_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def delete_matching(table: DataFrame, doomed: DataFrame, key: list[str]) -> DataFrame:
    """What is left after deleting the keys of ``doomed``. NULL keys are never deleted."""
    return table.join(doomed.select(*key).distinct(), key, "left_anti")


def replace_table(spark: SparkSession, df: DataFrame, name: str) -> None:
    """Overwrite a table by a query that reads it. The old one is dropped when the new one stands in its place."""
    staged, old = f"{name}__next", f"{name}__old"
    create_table_as(df, staged)
    if spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE IF EXISTS {old}")
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def stored_root(spark: SparkSession) -> str:
    """Folder of this session's intermediate tables."""
    return f"{checkpoint_dir(spark)}/stored-{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Remove the intermediate tables of this session; frames that read them can't be used afterwards."""
    _delete(spark, stored_root(spark))


def stored(df: DataFrame) -> DataFrame:
    """Write an intermediate table once, in the shared checkpoint folder, and read it back.

    It survives lost executors, cuts the lineage, and keeps column pruning and filter pushdown for its readers.
    ``release`` removes what a session stored.
    """
    path = f"{stored_root(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
