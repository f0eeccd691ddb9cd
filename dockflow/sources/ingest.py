"""Incremental ingestion: each run reads only the files that came since the last one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.sources.readers import read_csv_contract

_FILES = "path string, modificationTime timestamp, length long, content binary"


def ingest_new_files(
    spark: SparkSession,
    path: str,
    dst: str,
    checkpoint: str,
    contract: dict[str, str],
    extras: bool = True,
    files_per_batch: int = 1000,
) -> list[dict]:
    """Append the ``.csv`` files of a folder that no earlier run has read to a table: [{batch, files, bytes}] of this run.

    A file stream over the folder keeps the ledger in its checkpoint; it lists files and reads none of their content.
    The files of a batch are grouped by header and read like :func:`read_csv_contract` does, so layouts may change from
    file to file. Columns beyond the contract are kept unless ``extras`` is off. Every batch has a folder of its own in
    the table, ``batch=n``, which a repeated batch replaces: a run that was cut off leaves no row missing or twice.

    A file counts by its name: one that is changed afterwards is not read again. Files without rows, and a folder
    without files, add nothing. At most ``files_per_batch`` names come to the driver at a time.
    """
    done: list[dict] = []

    def write(files: DataFrame, batch: int) -> None:
        found = files.collect()
        if found:
            rows = read_csv_contract(spark, [r.path for r in found], contract, mixed_headers=True, extras=extras)
            rows.write.mode("overwrite").parquet(f"{dst}/batch={batch}")
            done.append({"batch": batch, "files": len(found), "bytes": sum(r.length for r in found)})

    listing = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", files_per_batch)
    query = (
        listing.load(path)
        .select("path", "length")
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return done


def read_ingested(spark: SparkSession, dst: str, batches: list[int] | None = None) -> DataFrame:
    """All rows of an ingested table, or those of some batches; columns that came later are null in earlier rows."""
    rows = spark.read.option("mergeSchema", True).parquet(dst)
    if batches is not None:
        rows = rows.where(F.col("batch").isin(batches))
    return rows.drop("batch")
