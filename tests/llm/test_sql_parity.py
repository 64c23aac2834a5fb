"""Every query with an SQL statement equals DuckDB on a small table and on edge rows."""

import duckdb
import pytest

from fieldlens.llm.queries import ORACLE, QUERIES

from .conftest import DOCS, edge_rows

TABLES = ["documents", "benchmark", "pages", "conversations", "labels"]


def compare(spark, name, folder):
    out = QUERIES[name](spark, folder)
    cols = out.columns
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')" if "testdata" not in folder
                else f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    want = sorted(con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})").fetchall(), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_table(spark, name):
    compare(spark, name, "/root/testdata/sf0.001")


def write(spark, folder, docs):
    long_html = "<p>" + "x" * 3000 + "</p>"
    data = {
        "documents": (docs, DOCS),
        "benchmark": ([(1, "One two three four five six seven eight nine ten"), (2, "null id text"), (3, None), (4, ""),
                       (5, "two three four five six seven eight nine ten eleven"), (6, "W1 x1 w2 x2 w3 x3 w4 x4 w5 x5 w6")] if docs else [],
                      "item_id long, text string"),
        "pages": ([(1, "http://a.b/c", long_html), (2, None, long_html), (3, "x", None), (4, "http://B.a/?q=1", ""), (5, "http://u/\n", "short"),
                   (6, "http://u/", "short"), (7, "http://[bad", long_html)] if docs else [], "page_id long, url string, html string"),
        "conversations": ([(1, 0, "user", None), (1, 1, "assistant", "a\n<|im_end|>"), (1, 1, "assistant", "[INST] <\\s> \\"), (2, None, None, "x"),
                           (2, 3, "assistant", ""), (1, 0, "user", None)] if docs else [], "conv_id long, turn long, role string, text string"),
        "labels": ([(5, 1, 0), (5, 0, 1), (6, None, 1), (None, 1, 1), (3, 1, None), (99, 1, 1), (1, 0, 0)] if docs else [],
                   "doc_id long, quality int, toxic int"),
    }
    for name, (rows, schema) in data.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_edge_rows(spark, tmp_dir, name):
    write(spark, tmp_dir, edge_rows())
    compare(spark, name, tmp_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tmp_dir, name):
    write(spark, tmp_dir, [])
    rows = QUERIES[name](spark, tmp_dir).collect()
    assert [r["conv_id"] for r in rows] == [-1] if name == "op3_chat" else rows == []
