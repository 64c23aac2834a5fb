import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    def make(rows, schema=DOCS):
        return spark.createDataFrame(rows, schema)

    return make


def table(spark, name, sf="0.001"):
    return spark.read.parquet(f"/root/testdata/sf{sf}/{name}.parquet")


def edge_rows():
    """Nulls, empty and long texts, ties, repeated rows."""
    long_text = " ".join(f"w{i % 977} x{i % 13}" for i in range(30_000)) + "\nend"
    same = "one two three four five six seven eight nine ten eleven twelve\nsame line here"
    return [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", None, 4), (4, long_text, "en", "b", len(long_text)),
            (5, same, "en", "a", 60), (5, same, "en", "a", 60), (6, same, "fr", "b", 60), (None, "null id text", "en", "c", 12),
            (None, None, None, None, None), (7, "É É é 🙂 naïve x İ ß", "fr", "b", 10)]
