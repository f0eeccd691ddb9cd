"""Model registry as an append-only table of events.

A row registers a version of a model or moves one to a stage. Nothing is updated in place: the current stage of a
version is that of its newest event.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.sources.readers import empty, read_table
from dockflow.sources.writers import write_table

REGISTRY_SCHEMA = (
    "model_name string, version int, event string, stage string, "
    "params map<string,string>, metrics map<string,double>, event_ts timestamp"
)
STAGES = ("None", "Staging", "Production", "Archived")


def open_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry's events; create the folder with :func:`create_registry` first."""
    return read_table(spark, path)


def create_registry(spark: SparkSession, path: str) -> None:
    write_table(empty(spark, REGISTRY_SCHEMA), path, mode="ignore")


def next_versions(registry: DataFrame, models: DataFrame) -> DataFrame:
    """Add the version each named model would get, one above its highest."""
    highest = registry.groupBy("model_name").agg(F.max("version").alias("_highest"))
    return (
        models.join(highest, "model_name", "left")
        .withColumn("version", (F.coalesce("_highest", F.lit(0)) + 1).cast("int"))
        .drop("_highest")
    )


def register_versions(registry_path: str, models: DataFrame, at: datetime) -> None:
    """Register one new version of every row of ``models``: model_name, params and metrics; names differ."""
    registry = open_registry(models.sparkSession, registry_path)
    register_numbered(registry_path, next_versions(registry, models), at)


def register_numbered(registry_path: str, numbered: DataFrame, at: datetime) -> None:
    """Register the versions that ``numbered`` already carries, but none twice: a repeated run adds nothing."""
    known = open_registry(numbered.sparkSession, registry_path).where("event = 'register'").select("model_name", "version")
    events = numbered.join(known, ["model_name", "version"], "left_anti").select(
        "model_name",
        "version",
        F.lit("register").alias("event"),
        F.lit("None").alias("stage"),
        "params",
        "metrics",
        F.lit(at).cast("timestamp").alias("event_ts"),
    )
    write_table(events, registry_path, mode="append")


def transition_stage(registry_path: str, versions: DataFrame, stage: str, at: datetime) -> None:
    """Move every (model_name, version) of ``versions`` to a stage."""
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}")
    events = versions.select(
        "model_name",
        F.col("version").cast("int").alias("version"),
        F.lit("transition").alias("event"),
        F.lit(stage).alias("stage"),
        F.lit(None).cast("map<string,string>").alias("params"),
        F.lit(None).cast("map<string,double>").alias("metrics"),
        F.lit(at).cast("timestamp").alias("event_ts"),
    )
    write_table(events, registry_path, mode="append")


def current_stages(registry: DataFrame) -> DataFrame:
    """The stage each version is in now."""
    newest = F.max(F.struct("event_ts", "event", "stage")).alias("_newest")
    return registry.groupBy("model_name", "version").agg(newest).select(
        "model_name", "version", F.col("_newest.stage").alias("stage")
    )


def latest_versions(registry: DataFrame, stages: Sequence[str] = ("Staging", "Production")) -> DataFrame:
    """The highest version of each model in each of the stages."""
    return (
        current_stages(registry)
        .where(F.col("stage").isin(*stages))
        .groupBy("model_name", "stage")
        .agg(F.max("version").alias("version"))
    )
