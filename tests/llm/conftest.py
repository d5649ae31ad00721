import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """The small documents table and awkward rows: null and empty texts, repeated rows, white space only, a very long text, nulls everywhere."""
    odd = [(-1, None, None, None, None), (-2, "", "en", "s", 0), (-3, " \n\t ", "en", "s", 4), (-4, "a b", "en", "s", 3), (-4, "a b", "en", "s", 3), (-5, "x 日本 😀\0ﬁ '" + "é" * 70, None, "s", 0),
           (-6, "the same line again\n" * 4000, "en", "s", 80000), (-7, "12345 !!! ###", "de", None, 13), (-8, "a" * 30000, "fr", "s", 30000), (None, "no id here", "en", "s", 10)]
    return spark.read.parquet(f"{SF}/documents.parquet").limit(120).union(spark.createDataFrame(odd, SCHEMA)).cache()


@pytest.fixture(scope="session")
def clashing(docs):
    """The same rows with columns whose names the operators use inside or return."""
    from pyspark.sql import functions as F

    names = ["__id", "__text", "r", "c", "row", "ids", "score", "spans", "runs", "n_words", "host", "class_id", "license", "k1", "label", "key", "h", "dir", "name", "path", "items", "kept", "bands", "__w", "to"]
    return docs.select("*", *(F.lit("clash").alias(n) for n in names))


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]
