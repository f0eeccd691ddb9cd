"""A training corpus from raw documents: toxic ones out, one of each near-duplicate group, secrets masked, mixed, encoded."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dockflow.llm.bpe import encode_documents
from dockflow.llm.common import settle, table
from dockflow.llm.mixing import mixed_documents
from dockflow.llm.overlap import similar_documents
from dockflow.llm.secrets import redacted
from dockflow.llm.toxicity import learn_toxicity, without_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon model does not score as toxic; it learns from the labelled rows outside fold 0.

    Null and empty texts show no term and stay. Long texts are read whole. Equal texts score alike, so repeated rows
    stay or go together. An empty table stays empty; columns of any name pass through.
    """
    model = learn_toxicity(docs, table(spark, sf_dir, "labels"))
    return without_toxic(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group whose sets of ``width``-word shingles are linked by a Jaccard similarity of ``percent`` %.

    The row with the smallest id stays. Rows are told apart by id and text: of rows that repeat an id, each is
    decided by the group of its own text, and rows equal in both are one document. Rows without an id can link others
    but name no document, and stay. Null and empty texts link with nothing. Long texts are compared whole. An empty
    table stays empty; columns of any name pass through.
    """
    text = F.coalesce("text", F.lit(""))
    own = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("?")), F.lit(":"), F.col("text").isNull().cast("string"), text))
    keyed = docs.select(own.alias("doc_id"), F.col("doc_id").alias("id"), "text")
    groups = similar_documents(keyed.select("doc_id", "text"), width, percent).distinct()
    named = keyed.filter("id is not null").select("doc_id", "id").distinct().join(groups, "doc_id")
    first = named.groupBy("component_id").agg(F.min(F.struct("id", "doc_id")).alias("first")).select(F.col("first.doc_id").alias("own"))
    packed = docs.select(own.alias("own"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("kept"))
    chosen = packed.filter("kept.doc_id is not null").join(first, "own")
    orderable = [f"kept.`{c}`" for c, kind in docs.dtypes if c != "text" and "map<" not in kind and "variant" not in kind]
    place = F.row_number().over(Window.partitionBy("own").orderBy(*orderable))
    once = chosen.withColumn("place", place).filter("place = 1").select("kept.*")
    return once.unionByName(docs.filter("doc_id is null"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with every secret masked; ``n_chars`` follows the new text.

    Null texts stay null and keep their count, empty ones stay empty. Long texts are scanned whole. Repeated rows
    repeat; an empty table stays empty; columns of any name pass through.
    """
    return redacted(docs).withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, each as often as it takes them.

    Null texts and texts without words are never taken. A long document is taken whole where the mix has at least half
    of its words. Ties in virtual time are broken by source and place; rows that repeat an id share its highest count.
    An empty table stays empty; columns of any name pass through.
    """
    return mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, and a digest of what they decode to.

    Null and empty texts have no ids. Long texts are encoded whole. Repeated rows repeat; an empty table stays empty;
    other columns are left out.
    """
    return encode_documents(docs).select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secrets),
    ("mixing", mixing),
    ("byte-level BPE", encoding),
]

#: No SQL: learned lexicon, token ids. Tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, stages: Sequence[tuple[str, Stage]] = tuple(STAGES)) -> DataFrame:
    """All stages over the documents table, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in stages:
        docs = settle(stage(spark, docs, sf_dir), "corpus-" + "".join(c if c.isalnum() else "-" for c in name))
    return docs
