import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("score", T.StringType()),  # a name that operators use themselves
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def documents(spark):
    """A documents table of (doc_id, text) pairs with clashing extra columns, over several partitions."""

    def make(pairs, partitions=3):
        rows = [(i, t, "x", len(t) if t is not None else None) for i, t in pairs]
        return spark.createDataFrame(rows, DOCUMENTS).repartition(partitions, "doc_id")

    return make


@pytest.fixture(scope="session")
def vocabularies():
    import public_tokenizers

    return {n: public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")}
