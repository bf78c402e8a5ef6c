"""Registered corpus queries: names, columns, oracles, and tables with nulls, repeated rows and no rows."""

import re

import pytest

import __spark_entry__ as entry
from keyrelay.llm import queries
from tools.check_oracle import check

SF = "/root/testdata/sf0.001"


def test_names():
    names = {n for n in entry.queries() if n == "pipeline" or re.match(r"op\d+_", n)}
    assert names == {*queries.MODULES, "pipeline"}
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.MODULES) == list(range(1, 14))
    assert set(queries.oracle_sql()) == set(queries.ORACLES)


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_matches_oracle(spark, name):
    assert check(spark, SF, [name])[name]["ok"]


@pytest.fixture(scope="module")
def odd_tables(spark, docs_of, tmp_path_factory):
    """Tables of nulls, empty texts, repeated rows and extra columns, and the same tables without rows."""
    docs = docs_of([(1, None), (2, ""), (2, ""), (None, None), (3, "x" * 40000), (4, "a b c d e f g h i j k l"), (4, "a b c d")], True)
    tables = {
        "documents": docs,
        "benchmark": spark.createDataFrame([(1, None), (None, "a b c"), (2, ""), (2, "a b c d e f g h i j k")], "item_id long, text string"),
        "pages": spark.createDataFrame([(1, None, None, "t"), (1, None, "<p>x", None)], "page_id long, url string, html string, text string"),
        "embeddings": spark.createDataFrame([(1, None, "x"), (None, [0.5, 1.0], "x"), (2, [], None), (2, [1.5, None], None),
                                             (3, [float("nan"), 1.0], None), (4, [2.0, 0.0], None), (4, [2.0, 0.0], None)],
                                            "vec_id long, embedding array<float>, component string"),
        "conversations": spark.createDataFrame([(1, None, None, None), (1, None, None, None), (None, 0, "user", "x")],
                                               "conv_id long, turn long, role string, text string")}
    roots = []
    for rows in (True, False):
        root = str(tmp_path_factory.mktemp("odd"))
        for name, df in tables.items():
            (df if rows else df.filter("1 = 0")).write.parquet(f"{root}/{name}.parquet")
        roots.append(root)
    return roots


@pytest.mark.parametrize("name", [*queries.MODULES, "pipeline"])
def test_odd_tables(spark, odd_tables, name):
    full, empty = (entry.queries()[name](spark, root).collect() for root in odd_tables)
    source = {"op3_html_text": 2, "op5_chat": 3, "op12_whitening": 3, "pipeline": 0}.get(name, 7)
    assert len(full) == source                          # nothing crashes, no row is lost
    assert len(empty) == (1 if name == "op5_chat" else 0)      # conversation -7 is always there
