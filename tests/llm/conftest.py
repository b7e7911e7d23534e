import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"

LONG = "lorem ipsum dolor sit amet " * 4000


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


EDGE = [
    (1, "one two three four five six seven eight nine ten eleven twelve " * 3),
    (2, None), (3, ""), (4, "   \n\t "), (5, "word"), (6, LONG),
    (7, "one two three four five six seven eight nine ten eleven twelve " * 3),
    (8, "tie"), (8, "tie"), (8, "another text under one id, long enough to be told apart " * 4),
    (None, "no id here " * 20), (None, None), (9, "x" * 5000), (10, "Ünïcode ÄÖ   \u0001 ✓ " * 12),
    (11, "no id here " * 20),
]
# Names that the operators use inside.
CLASH = ("doc", "rid", "t", "fp", "n", "_b", "_text", "_row", "slot", "rep", "mask", "bucket", "m", "label")


@pytest.fixture(scope="session")
def edge(spark):
    df = spark.createDataFrame(EDGE, "doc_id long, text string")
    return df.select("*", *[F.lit("z").alias(c) for c in CLASH])


@pytest.fixture(scope="session")
def empty(edge):
    return edge.where("doc_id < 0")
