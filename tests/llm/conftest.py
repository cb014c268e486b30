import pytest
from pyspark.sql import types as T

#: Texts every operator has to take: null, empty, blank, one word, ties, repeats, beyond ASCII, very long.
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
TEXTS = [
    None, "", "  \n\t ", "one", "a b a b a b", "Zürich straße 東京 İx \U0001f600!", "same text here for two rows", "same text here for two rows",
    "1 2 3 4 5", "line\nline\nline\nother line", LONG, "x" * 50_000,
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows with extra columns whose names the operators use inside; the last row is repeated whole."""
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("spans", T.LongType()),
         T.StructField("n_words", T.StringType()), T.StructField("node", T.StringType()), T.StructField("score", T.StringType()), T.StructField("items", T.StringType())]
    )
    inner = ["t_terms", "t_id", "t_hash", "hit_id", "hit_hash", "hit_spans", "__hash", "kept_id", "kept_hash", "f_id", "f_hash", "row", "row_id", "text_hash", "likely", "block", "is_id", "base"]
    for name in inner:  # names that operators join by
        schema.add(name, T.LongType())
    rows = [(i, t, "en" if i % 2 else None, 7, "n", "k", None, "i", *range(len(inner))) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[7], (None, "a null id", *[None] * (6 + len(inner)))], schema)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.filter("false")
