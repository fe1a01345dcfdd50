import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use inside
    T.StructField("row", T.StringType()), T.StructField("size", T.IntegerType()), T.StructField("Shard", T.StringType()),
    T.StructField("key", T.StringType()), T.StructField("mark", T.StringType()), T.StructField("doc", T.StringType()),
    T.StructField("id", T.StringType()), T.StructField("once", T.StringType()), T.StructField("s", T.StringType())])


def corpus() -> list[tuple]:
    """Documents with copies, shared passages, near copies, nulls, long texts, ties and repeated rows."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    passage = text(50)
    texts = [text(rng.randint(1, 150)) for _ in range(40)]
    texts += [texts[3], texts[3], texts[5], f"{text(20)} {passage} {text(9)}", f"{passage}\n{text(30)}", passage]
    long = text(400)
    texts += [long, long[:-3] + " end", "x " + long, "\t".join(long.split()), long.upper()]
    texts += [None, "", " \n", "a " * 100, "a " * 40, "b a " * 60, "one", "Ärger naïve 日本   end", text(9000), "z" * 9000,
              "# $ % " * 40, "line of words\n" * 30, f"{passage} {passage}"]
    rows = []
    for i, t in enumerate(texts):
        rows.append((i, t, ["en", "de", None][i % 3], [None, "s1", "s0", "é", ""][i % 5], len(t or "")))
    rows += [rows[3], rows[3], (None, "no id here", "en", "s1", 1), (None, None, None, None, None),
             (7, "another text of the same id", "en", "s0", 2)]
    return [(*r, "x", 1, "y", None, "m", "d", "i", "o", "s") for r in rows]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def pages_schema():
    return "page_id long, url string, html string, text string, digest string, host string"
