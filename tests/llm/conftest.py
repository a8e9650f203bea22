import random

import pytest
from pyspark.sql import types as T

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, spans string, score double, label int, key string, part int"

WORDS = "harbor stone winter paper garden silver market window yellow simple river candle bridge forest travel letter method number".split()


def prose(seed, n=60):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n)) + "."


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls everywhere, empty, blank and very long texts, repeated rows and ids, and columns that clash with internal names."""
    texts = [(1, prose(1)), (1, prose(1)), (2, prose(1)), (2, prose(2)), (3, None), (4, ""), (5, "  \n\t "), (None, prose(3)), (None, None), (6, "x" * 300_000), (7, "wörd " * 40_000), (8, "a"), (9, "\n" * 5000), (10, "😀 \u3000ß\x00 ok")]
    rows = [(i, t, None, "s", None, 5, "z", 0.5, None, "k", 1) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(50, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.01], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [None, 1.0], 1), (None, [1.0, 0.0], 1), (9, [0.0, 1.0], 2), (100, [0.0, 1.0, 0.0], 2), (10, [], 1)]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), T.StructField("id", T.StringType()), T.StructField("v", T.StringType())])
    return spark.createDataFrame([(*r, "i", "v") for r in rows], schema).repartition(3)
