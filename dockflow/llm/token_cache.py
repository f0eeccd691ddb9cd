"""Token counts kept in a cache by digest of normalised text and tokenizer version."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import column_text, slices
from dockflow.session import scratch_path

PIECE_MODEL = "piece_bpe_32k.model"
CACHE = "digest binary, version string, n_tokens long"
_loaded: dict[str, Callable[[list[str]], list[int]]] = {}


def piece_normalised(text: Column) -> Column:
    """The normal form of the piece model: nothing changes but that a space is its own space mark."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit(" "), F.lit("▁"))


def as_given(text: Column) -> Column:
    """The normal form that holds for any tokenizer: the text itself."""
    return F.coalesce(text, F.lit(""))


def normal_form(path: str) -> Callable[[Column], Column]:
    """Texts that a tokenizer cannot tell apart, as far as that is known of it; for any other one, the text itself."""
    return piece_normalised if path.rsplit("/", 1)[-1] == PIECE_MODEL else as_given


def tokenizer_version(path: str, normalised: Callable[[Column], Column]) -> str:
    """Digest of a tokenizer file and the name of the normal form that texts are looked up by.

    The file is read on the driver; it is a few megabytes at most.
    """
    with open(path, "rb") as f:
        return f"{hashlib.sha256(f.read()).hexdigest()}/{normalised.__name__}"


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """The library's counts for a tokenizer file, loaded once per Python process."""
    if path not in _loaded:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _loaded[path] = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(path)
            whole.no_truncation()
            whole.no_padding()
            _loaded[path] = lambda texts: [len(x.ids) for x in whole.encode_batch(texts, add_special_tokens=False)]
    return _loaded[path]


def _encode(path: str, version: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                counts = counter(path)(column_text(part.column("text")))
                yield pa.record_batch(
                    [part.column("digest"), pa.array([version] * part.num_rows, pa.string()), pa.array(counts, pa.int64())],
                    names=["digest", "version", "n_tokens"],
                )

    return run


def cached_counts(
    docs: DataFrame,
    cache: str,
    tokenizer: str | None = None,
    limit: int = 4096,
    normalised: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Token counts of every text: (doc_id, n_bytes, n_tokens, over_limit).

    ``cache`` is a folder of (digest, version, n_tokens). Texts are looked up by the SHA-256 of their normal form and
    of the tokenizer file and the normal form's name; each distinct miss is encoded once, and its count appended before the result is read from
    the cache. A run that stops half-way leaves counts that hold, and a cache with a repeated key is read correctly.

    A null text is empty. Equal texts, repeated rows included, share one entry. An empty table gives an empty result
    and appends nothing. Other columns are ignored. Only digests move for the lookup; texts move once, and only misses.
    """
    spark = docs.sparkSession
    path = tokenizer or public_tokenizers.path(PIECE_MODEL)
    normalised = normalised or normal_form(path)
    version = tokenizer_version(path, normalised)
    body = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", body.alias("text"), F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"))
    known = stored(spark, cache, version)
    wanted = keyed.select("digest", "text")
    misses = wanted if known is None else wanted.join(known.select("digest"), "digest", "left_anti")
    misses.dropDuplicates(["digest"]).mapInArrow(_encode(path, version), CACHE).write.mode("append").parquet(cache)
    sized = keyed.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
    return sized.join(stored(spark, cache, version), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def stored(spark, cache: str, version: str) -> DataFrame | None:
    """One count per digest of one tokenizer version, or None where the cache was never written."""
    at = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return None
    rows = spark.read.schema(CACHE).parquet(cache).filter(F.col("version") == version)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def new_cache(spark) -> str:
    """A folder for an empty cache under the shared scratch folder."""
    return scratch_path(spark, "token-cache")
