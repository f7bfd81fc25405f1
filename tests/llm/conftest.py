import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a table of (doc_id, text) rows with columns that clash by name."""
    def make(rows, partitions=3):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(list(rows), DOC).repartition(partitions)
        return df.select("doc_id", "text", F.lit("x").alias("mark"), F.lit(0).alias("n_words"),
                         F.lit("y").alias("hash"), F.lit(None).cast("string").alias("source"))
    return make
