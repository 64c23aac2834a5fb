"""The JVM doesn't compile methods of over 8,000 bytes: what runs per note stays below."""

import contextlib
import io
import re

import pytest

from fieldlens.plans.catalog import Lakehouse


@pytest.mark.parametrize("table", ["silver_extracted", "note_rollup", "next_best_engagement"])
def test_methods_over_notes_are_small_enough_to_be_compiled(spark, tmp_dir, table):
    rows = spark.range(3)
    made = {
        "lineitem": rows.selectExpr("id AS l_orderkey", "id AS l_linenumber", "id AS l_partkey", "id AS l_suppkey", "DATE'1998-01-01' AS l_shipdate",
                                    "'A' AS l_returnflag"),
        "orders": rows.selectExpr("id AS o_orderkey", "id AS o_custkey", "'F' AS o_orderstatus", "DATE'1998-01-01' AS o_orderdate"),
        "customer": rows.selectExpr("id AS c_custkey", "'n' AS c_name", "'m' AS c_mktsegment", "id AS c_nationkey"),
        "nation": rows.selectExpr("id AS n_nationkey", "'n' AS n_name"),
        "part": rows.selectExpr("id AS p_partkey", "id AS p_size", "'p' AS p_name"),
        "events": rows.selectExpr("id AS event_id", "id AS user_id", "TIMESTAMP'2024-01-01 00:00:00' AS ts", "'view' AS event_type", "1.0D AS value"),
    }
    for name, df in made.items():
        df.write.parquet(f"{tmp_dir}/{name}.parquet")
    text, adaptive = io.StringIO(), "spark.sql.adaptive.enabled"
    before = spark.conf.get(adaptive)
    spark.conf.set(adaptive, "false")   # an adaptive plan shows no code before it runs
    try:
        with contextlib.redirect_stdout(text):
            Lakehouse(spark, tmp_dir).table(table).explain("codegen")
    finally:
        spark.conf.set(adaptive, before)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8_000
