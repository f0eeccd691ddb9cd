"""Batch readers: delimited files bound by header name, tables by path."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dockflow.spec import TRIPS_RAW, WEATHER_RAW


def _quoted(name: str) -> str:
    return f"`{name}`"


def _typed(name: str, type_name: str) -> Column:
    """A text cell as its contract type, null where it does not parse."""
    if type_name == "timestamp":
        return F.try_to_timestamp(F.col(_quoted(name)))
    return F.col(_quoted(name)).try_cast(type_name)


def to_contract(df: DataFrame, contract: dict[str, str], extras: bool = True) -> DataFrame:
    """Pick and type the contract's columns by name.

    A contract column the input lacks comes out null; a column the contract lacks is kept as it is, unless ``extras``
    is off.
    """
    have = set(df.columns)
    picked = [
        (_typed(name, kind) if name in have else F.lit(None).cast(kind)).alias(name)
        for name, kind in contract.items()
    ]
    if extras:
        picked += [F.col(_quoted(name)) for name in df.columns if name not in contract]
    return df.select(*picked)


def _text_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Headered files that share one header, every column as text.

    ``enforceSchema=false`` makes Spark compare each file's header with the first one's and stop on a difference,
    where its default would silently bind columns by position.
    """
    reader = spark.read.option("header", True).option("pathGlobFilter", "*.csv")
    names = reader.csv(paths[0]).columns
    schema = ", ".join(f"{_quoted(n)} string" for n in names)
    return reader.option("enforceSchema", False).schema(schema).csv(paths)


def _by_header(spark: SparkSession, path: str | list[str]) -> list[list[str]]:
    """The files under some paths, grouped by their header line, in one job over all of them.

    Each task reads its file's first bytes only as far as Spark splits them; what reaches the driver is one list of
    paths per layout.
    """
    lines = spark.read.option("pathGlobFilter", "*.csv").text(path)
    first = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value")
    heads = first.where(F.col("at") == 0).groupBy("path").agg(F.first("value").alias("head"))
    groups = heads.groupBy("head").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    return [list(r.paths) for r in groups.orderBy("head").collect()]


def unreadable_cells(spark: SparkSession, path: str | list[str], contract: dict[str, str], mixed_headers: bool = False) -> DataFrame:
    """Rows of a folder and, per contract column, cells with text that is not of the column's type: (column, rows, unreadable).

    Such cells come out null in the typed table; this says how many there are, in one pass over the text.
    """
    paths = [path] if isinstance(path, str) else list(path)
    groups = _by_header(spark, paths) if mixed_headers else [paths]
    text = union_sources([_text_csv(spark, g) for g in groups]) if groups else empty(spark, ", ".join(f"{_quoted(n)} string" for n in contract))
    have = [n for n in contract if n in text.columns]
    bad = [F.count_if(F.col(_quoted(n)).isNotNull() & _typed(n, contract[n]).isNull()).alias(f"c{i}") for i, n in enumerate(have)]
    counts = text.agg(F.count(F.lit(1)).alias("rows"), *bad)
    pairs = F.array(*[F.struct(F.lit(n).alias("column"), F.col("rows"), F.col(f"c{i}").alias("unreadable")) for i, n in enumerate(have)])
    return counts.select(F.explode(pairs).alias("p")).select("p.*")


def _bad_cells(text: DataFrame, contract: dict[str, str]) -> list[Column]:
    """Rows, and cells of each contract column that hold text which is not of its type."""
    have = set(text.columns)
    none = F.sum(F.lit(0).cast("long"))
    bad = [F.count_if(F.col(_quoted(n)).isNotNull() & _typed(n, kind).isNull()) if n in have else none for n, kind in contract.items()]
    return [F.count(F.lit(1)).alias("rows"), *[c.alias(f"c{i}") for i, c in enumerate(bad)]]


def read_csv_counted(
    spark: SparkSession, path: str | list[str], contract: dict[str, str], mixed_headers: bool = False, extras: bool = True
) -> tuple[DataFrame, Observation | None]:
    """:func:`read_csv_contract`, and an observation that fills with counts while the table is first read to its end.

    So the report on unreadable cells costs no read of its own. Let that first read be a plain write (:func:`settle`): a
    plan that looks at its input twice, as one that cuts ranges does, would count twice. Without files there is nothing
    to observe, and the observation is None.
    """
    paths = [path] if isinstance(path, str) else list(path)
    groups = _by_header(spark, paths) if mixed_headers else [paths]
    if not groups:
        return empty(spark, ", ".join(f"{_quoted(n)} {t}" for n, t in contract.items())), None
    text = union_sources([_text_csv(spark, g) for g in groups])
    seen = Observation()
    return to_contract(text.observe(seen, *_bad_cells(text, contract)), contract, extras), seen


def counted_cells(spark: SparkSession, seen: Observation | None, contract: dict[str, str]) -> DataFrame:
    """(column, rows, unreadable) of a finished observation, like :func:`unreadable_cells`."""
    counts = seen.get if seen else {}
    rows = [(name, counts.get("rows", 0), counts.get(f"c{i}") or 0) for i, name in enumerate(contract)]
    return spark.createDataFrame(rows, "column string, rows long, unreadable long")


def read_csv_contract(
    spark: SparkSession,
    path: str | list[str],
    contract: dict[str, str],
    mixed_headers: bool = False,
    extras: bool = True,
) -> DataFrame:
    """Headered delimited files as one typed table.

    All ``.csv`` files under ``path`` are one scan. With ``mixed_headers`` files are first grouped by header and the
    groups, one scan each, are united by name; that costs one job that looks at first lines, so it is for folders
    whose files changed layout over time, not the default.
    """
    paths = [path] if isinstance(path, str) else list(path)
    groups = _by_header(spark, paths) if mixed_headers else [paths]
    if not groups:
        return empty(spark, ", ".join(f"{_quoted(n)} {t}" for n, t in contract.items()))
    return union_sources([to_contract(_text_csv(spark, g), contract, extras) for g in groups])


def read_weather_csv(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Raw weather readings; ``dt`` still in epoch seconds, dotted names kept."""
    return read_csv_contract(spark, path, WEATHER_RAW, **options)


def read_trips_csv(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Raw trips; timestamps with or without fractions, malformed cells null."""
    return read_csv_contract(spark, path, TRIPS_RAW, **options)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Headered files with inferred types. Inference is a second pass, so this is for a first look only."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A table by path in any batch format the session knows."""
    return spark.read.format(fmt).options(**options).load(path)


def stream_table(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """A growing table as a stream. Bound the files of a micro-batch to bound its size."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def empty(spark: SparkSession, schema) -> DataFrame:
    """No rows, but a schema: the neutral element of a union."""
    return spark.createDataFrame([], schema)


def union_sources(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by column name; a column some source lacks is null for its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def clean_names(df: DataFrame) -> DataFrame:
    """Dots in column names become underscores, so names need no quoting."""
    return df.withColumnsRenamed({c: c.replace(".", "_") for c in df.columns if "." in c})
