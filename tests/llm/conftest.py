import pytest

TEXT_COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Make a documents table from (doc_id, text) or (doc_id, text, source), with columns whose names may clash."""

    def make(rows, extra=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, TEXT_COLUMNS)
        if extra:
            from pyspark.sql import functions as F

            for name in ("key", "n", "node", "size", "label", "block", "rank", "digest", "score", "tokens", "doc"):
                df = df.withColumn(name, F.lit("other"))
        return df.repartition(3)

    return make


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
