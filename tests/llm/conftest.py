import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def documents(spark, tmp_path):
    """Documents of (doc_id, text[, lang[, source]]) rows, written and read again as a cluster would read them."""

    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        path = f"{tmp_path}/{len(list(tmp_path.iterdir()))}/documents.parquet"
        spark.createDataFrame(full, DOCUMENTS).repartition(parts).write.parquet(path)
        return spark.read.schema(DOCUMENTS).parquet(path)

    return make
