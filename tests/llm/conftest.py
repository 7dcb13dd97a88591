import pytest
from pyspark.sql import types as T

# Names that the operators use inside; the inputs have them as extra columns.
CLASHES = ["row", "size", "copies", "taken", "uid", "depth", "lang_pred", "kept", "piece", "sequence_id", "item", "bin", "of", "rank",
           "key", "one", "words", "th", "cid", "n_lines", "common", "target", "doc", "rest", "h"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
                      + [T.StructField(c, T.IntegerType()) for c in CLASHES])

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
TEXTS = [None, "", " \n\t ", "a", "A.", "1234 %% 77", "one two three four five six seven eight nine ten eleven twelve",
         "one two three four five six seven eight nine ten eleven twelve", "x y\nx y\nx y\n\nz", "ünï cödé 日本 語  x <|endoftext|> y", LONG,
         "der die das und ist ein " * 40, "the of and to in that it is was " * 40, "the of and to in that it is was " * 40]


def documents(spark, texts=TEXTS, ids=None, sources=None, langs=None):
    rows = []
    for i, t in enumerate(texts):
        d = i if ids is None else ids[i]
        rows.append((d, t, (["en", "de", None, "fr"][i % 4] if langs is None else langs[i]), (["b", "a", None, "ö"][i % 4] if sources is None else sources[i]),
                     None if t is None else len(t), *[7] * len(CLASSES_N)))
    return spark.createDataFrame(rows, SCHEMA)


CLASSES_N = CLASHES


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows."""
    ids = [*range(len(TEXTS) - 2), None, None]
    df = documents(spark, ids=ids)
    return df.unionByName(documents(spark, [TEXTS[6]], [6], ["b"], ["en"]))


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
