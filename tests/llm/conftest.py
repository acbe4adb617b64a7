import pandas as pd
import pytest
from pyspark.sql import types as T

LONG = " ".join(f"word{i % 977} said" for i in range(40_000))
ROWS = [
    (1, "", "en", "a", 0), (2, None, "fr", None, None), (None, "the cat sat on the mat", "en", "a", 22),
    (3, "the cat sat on the mat", None, "a", 22), (3, "the cat sat on the mat", None, "a", 22), (4, LONG, "en", "b", len(LONG)),
    (5, " \n\n \t\n", "en", "a", 6), (6, "Äpfel und Öl\nÄpfel und Öl\n", "de", "a", 26), (7, "12 34 <|endoftext|> !!", "en", "a", 21),
    (8, "x y  z   q", "en", "a", 9), (None, None, None, None, None),
]
#: Columns of other tables and of the operators' own working tables.
EXTRA = ["item_id", "score", "size", "slot", "shard", "_s", "_k1", "words", "start", "length", "_class", "n_words", "kept", "fp", "line"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("text", "lang", "source")],
                       T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.IntegerType()) for c in EXTRA]])


@pytest.fixture(scope="session")
def odd(spark):
    """NULLs everywhere, empty, blank and long texts, repeated rows, clashing further columns."""
    return spark.createDataFrame([(*r, *range(len(EXTRA))) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_rows(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 0, 0), (4, 1, 0), (4, 1, 0), (6, None, 1), (None, 1, 1), (7, 0, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents) -> pd.DataFrame:
    return documents.toPandas()
