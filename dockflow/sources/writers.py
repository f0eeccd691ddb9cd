"""Batch sinks, catalog entries and file layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.session import scratch_path
from dockflow.sources.readers import read_table


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", by: Sequence[str] = (), **options
) -> None:
    """Write a table folder, by default replacing what was there; ``by`` names folder columns."""
    writer = df.write.mode(mode).format(fmt).options(**options)
    (writer.partitionBy(*by) if by else writer).save(path)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared scratch folder and read it back.

    For a result that several branches of one plan read: without this each branch computes it again, and a lost
    executor takes the computation back to the first input.
    """
    path = scratch_path(df.sparkSession, label)
    write_table(df, path)
    return read_table(df.sparkSession, path)


def ensure_database(spark: SparkSession, database: str) -> None:
    """Create a database if needed and make it current."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(f"USE `{database}`")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def save_managed(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Write a table owned by the catalog, replacing one of that name."""
    df.write.mode("overwrite").format(fmt).saveAsTable(name)


def publish(df: DataFrame, path: str, name: str, fmt: str = "parquet", by: Sequence[str] = (), parts: bool = False) -> None:
    """Write a table once and register it by name over the same files.

    With ``parts`` only the ``by`` folders that ``df`` has rows for are replaced; a run that is repeated replaces what
    it wrote before.
    """
    spark = df.sparkSession
    write_table(df, path, fmt, by=by, **({"partitionOverwriteMode": "dynamic"} if parts else {}))
    register(spark, path, name, fmt, by)


def register(spark: SparkSession, path: str, name: str, fmt: str = "parquet", by: Sequence[str] = ()) -> None:
    """Name a table over files that are there, replacing an entry of that name; ``by`` are its folder columns."""
    drop_table(spark, name)
    spark.catalog.createTable(name, path=path, source=fmt)
    if by:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def balance(df: DataFrame, n: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Even out the files of a write: to ``n`` of them, or to the advised size when no number is given.

    ``by`` brings the rows of a folder together, so that a partitioned write makes few files in each.
    """
    return df.repartition(n, *by) if n else df.hint("rebalance", *by)


def files_for(df: DataFrame, file_bytes: int = 512 << 20) -> int:
    """Number of files of about ``file_bytes`` for a frame, from the bytes of the tables and files that its plan reads."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return max(1, -(-size // file_bytes))


def cluster_by(
    df: DataFrame, columns: str | Sequence[str], n: int | None = None, spread: Sequence[str] = ()
) -> DataFrame:
    """Order files by columns, so a filter on the leading one skips most files and row groups.

    Ranges are cut over ``columns`` and then ``spread``: a value of the leading columns that holds a large share of
    the rows is cut along the ``spread`` columns instead of landing in one file. Without ``n`` the number of files
    follows from the size of the input, and is at least the session's shuffle width.
    """
    keys = ([columns] if isinstance(columns, str) else list(columns)) + list(spread)
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n or max(least, files_for(df)), *keys).sortWithinPartitions(*keys)


def table_detail(df: DataFrame) -> DataFrame:
    """Rows, files and bytes of a table read from files. Reads file facts only, no data column."""
    per_file = df.groupBy(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")
    ).agg(F.count(F.lit(1)).alias("rows"))
    return per_file.agg(
        F.count(F.lit(1)).alias("num_files"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("size_in_bytes"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("num_rows"),
    ).withColumn("num_columns", F.lit(len(df.columns)))


def partition_count(df: DataFrame) -> int:
    """Partitions a scan or plan would run as."""
    return df.rdd.getNumPartitions()
