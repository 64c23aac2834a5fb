"""The corpus pipeline: quality rules, near-duplicates, decontamination, mixing, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of policy v1."""
    from fieldlens.llm import quality

    return quality.ledger(docs).where(quality.verdict("v1")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of each SimHash group (3-word shingles, 3 bits)."""
    from fieldlens.llm import simhash

    return simhash.one_per_group(docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified benchmark window."""
    from fieldlens.llm import decontaminate, text

    grams = decontaminate.ngrams(text.read_table(spark, sf_dir, "benchmark"))
    return decontaminate.remove_documents(docs, grams).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, each as often as the mix draws it."""
    from fieldlens.llm import mixing as mix

    return mix.mixed_documents(docs).select(*COLUMNS)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document copy, read back from the token files: place, length and checksum of its ids.

    Workers share an executor with what the stages before left in its memory, so they remember less than the library's default.
    """
    from fieldlens.llm import token_files as files

    return files.round_trip(spark, docs, plain_special=False, memo_bytes=64 << 20, batch_chars=500_000)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_files", token_files),
]

#: SimHash groups, the draw of the mix and the tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    from fieldlens.llm.text import read_table, shared_folder

    docs = read_table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "corpus-pipeline")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
    return docs
