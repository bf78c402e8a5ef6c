import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows (doc_id, text) as a documents table; ``extra`` adds columns whose names clash with the operators' own."""
    def make(rows, extra=False):
        df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
        if extra:
            for name in ("fp", "label", "words", "found", "quality", "m", "row", "clean", "ids", "start", "place", "path_x"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df
    return make


@pytest.fixture(scope="session")
def real(spark):
    """(doc_id, text) of the small documents table, with null, empty, blank, long, repeated and unusual texts added."""
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    odd = [None, "", " \n\t\r\x0b\x0c ", "a", "x" * 30000, "word " * 20000, "a  b\tc\nd\r\ne", "  é   é 中文 𝄞 \x00\x01\x1c\x85 İΣς",
           "<|endoftext|> <|startoftext|>", "one two three", "one two three four", rows[0][1]]
    return rows + [(10**6 + k, t) for k, t in enumerate(odd)] + [rows[3], (None, "no id here"), (None, None)]
