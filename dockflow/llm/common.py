"""What several text operators share: table access, scratch tables, and word arithmetic on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.sources.writers import settle

WORD = r"[^\x20\x09-\x0D]+"
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SALT = np.random.Generator(np.random.PCG64(20240917)).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[str, np.ndarray] = {}

__all__ = ["WORD", "column_text", "let", "map_texts", "mixed", "mixed_long", "settle", "slices", "table", "word_hashes", "word_spans", "windows_of"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def map_texts(docs: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Batches of all columns through a function that needs ``text`` only and keeps the columns; names may hold dots."""
    plain = docs.toDF(*("text" if c == "text" else f"column{i}" for i, c in enumerate(docs.columns)))
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into row ranges of about ``most`` text bytes, so that work arrays stay small; a longer text is alone."""
    ends = text_bytes(batch.column(column))[1][1:]
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the row offsets in them; null texts are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, ends - ends[0]


def column_text(column: pa.Array) -> list[str]:
    """Texts of a column as Python strings; null texts are empty."""
    return [x or "" for x in column.to_pylist()]


def word_spans(body: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the offsets of each row's words among them."""
    inside = ~_SPACE[body]
    before = np.empty(len(inside), bool)
    after = np.empty(len(inside), bool)
    if len(inside):
        before[0], after[-1] = False, False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        cuts = ends[(ends > 0) & (ends < len(inside))]
        before[cuts] = False
        after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    stops = np.flatnonzero(inside & ~after) + 1
    return starts, stops, np.searchsorted(starts, ends, "left")


def _power(kind: str, n: int) -> np.ndarray:
    if kind not in _powers or len(_powers[kind]) < n:
        size = 1 << max(20, int(n - 1).bit_length())
        out = np.full(size, _BASE if kind == "up" else _BASE_INVERSE, np.uint64)
        out[0] = 1
        _powers[kind] = np.multiply.accumulate(out)
    return _powers[kind][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit keys (one-to-one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mixed_long(x: np.ndarray) -> np.ndarray:
    return mixed(x).view(np.int64)


def word_hashes(body: np.ndarray, starts: np.ndarray, stops: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over salted bytes, taken from one running sum over the batch."""
    n = len(body)
    if n == 0 or len(starts) == 0:
        return np.zeros(0, np.uint64)
    salted = _SALT[_LOWER[body] if lower else body]
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(salted * _power("up", n), out=run[1:])
    raw = (run[stops] - run[starts]) * _power("down", n + 1)[starts]
    return mixed(raw ^ (stops - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def windows_of(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` consecutive words of one text; a shorter text is one run, none if it is empty."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(size, n)
    out = np.full(n - width + 1, width * 0x2545F4914F6CDD1D & (2**64 - 1), np.uint64)
    for k in range(width):
        out = mixed(out) * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[k : n - width + 1 + k]
    return mixed(out)
