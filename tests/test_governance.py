"""Classification that follows columns, and the bucketed store of newest versions."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldlens.operators import governance as GOV
from fieldlens.plans.buckets import NewestByKey


@pytest.fixture()
def people(spark):
    return spark.createDataFrame([("h1", "100", "x", 1), ("h2", "200", "y", 2), ("h2", None, "y", 3)], "hcp_id string, npi string, territory string, n int")


def test_tags_follow_renamed_cut_joined_and_aggregated_columns(spark, people):
    tags = lambda df: GOV.derived_columns(df)
    assert tags(people) == {"npi": "pii"}
    assert tags(people.withColumnRenamed("npi", "licence")) == {"licence": "pii"}
    assert tags(people.select("n", F.upper(F.substring("npi", 1, 2)).alias("a"), F.concat("territory", "npi").alias("b"), "territory")) == {"a": "pii", "b": "pii"}
    assert tags(people.groupBy("hcp_id").agg(F.max("npi").alias("m"), F.collect_set("npi").alias("s"), F.count("npi").alias("k"))) == {"m": "pii", "s": "pii"}
    assert tags(people.where("npi > '1'").select("hcp_id")) == {}
    other = spark.createDataFrame([("h1", 5)], "hcp_id string, v int")
    assert tags(people.join(other, "hcp_id").select("v", "npi")) == {"npi": "pii"}
    assert tags(other.select(F.col("hcp_id").alias("z")).union(people.select("npi"))) == {"z": "pii"}
    assert tags(people.select(F.explode(F.split("npi", "0")).alias("digit"))) == {"digit": "pii"}
    assert tags(people.withColumn("w", F.max("npi").over(Window.partitionBy("hcp_id"))).select("w", "n")) == {"w": "pii"}
    assert tags(people.selectExpr("struct(npi, n) AS both").select("both.npi", "both.n"))["npi"] == "pii"
    newest = people.groupBy("hcp_id").agg(F.max_by(F.struct("npi", "territory"), F.struct("n", "npi")).alias("r"))
    assert tags(newest.select("r.territory", F.col("r.npi").alias("x"), "hcp_id")) == {"x": "pii"} and tags(newest) == {"r": "pii"}
    people.createOrReplaceTempView("people_view")
    assert tags(spark.sql("WITH a AS (SELECT npi AS q, n FROM people_view) SELECT q || '-' AS c, n FROM a ORDER BY n")) == {"c": "pii"}


def test_tags_survive_files_and_unmasked_publishing_fails(spark, people, tmp_dir):
    made = GOV.classify_derived(people.select("hcp_id", F.concat(F.lit("N"), "npi").alias("code")))
    made.write.parquet(f"{tmp_dir}/t")
    back = spark.read.parquet(f"{tmp_dir}/t").select("hcp_id", F.lower("code").alias("lowered"))
    assert GOV.derived_columns(back) == {"lowered": "pii"}   # from the file's own tags: the name says nothing
    with pytest.raises(ValueError, match="lowered"):
        GOV.publishable(back)
    masked = GOV.publishable(GOV.mask(GOV.classify_derived(back), "secret"))
    clear = {r.lowered for r in back.collect()}
    assert not {r.lowered for r in masked.collect() if r.lowered} & clear
    with pytest.raises(ValueError, match="not allowed"):
        GOV.classify(people, {"npi": "top secret"})


def test_only_buckets_with_new_versions_are_rewritten(spark, tmp_dir):
    schema = "hcp_id string, hcp_name string, influence_score int, _ingested_at timestamp, _source_file string"
    version = lambda i, name, day: (i, name, 1, dt.datetime(2024, 1, day), "f")
    order = lambda: F.struct("_ingested_at", "_source_file", "hcp_name")
    store = NewestByKey(spark, f"{tmp_dir}/s", "hcp_id", order, buckets=16)
    first = [version(f"h{i}", "old", 1) for i in range(200)] + [version(None, "none", 1)]
    store.update(spark.createDataFrame(first, schema))
    before = store.folders()
    assert len(before) == 16
    wave = [version("h3", "new", 2), version("h3", "newer", 3), version("h4", "late", 1), version("h999", "first", 2)]
    commit = store.update(spark.createDataFrame(wave, schema))
    after = store.folders()
    assert {b for b in before if before[b] != after[b]} == set(commit["hit"]) and len(commit["hit"]) <= 3
    names = {r.hcp_id: r.hcp_name for r in store.table(spark.createDataFrame([], schema).schema).collect()}
    assert len(names) == 201 and (names["h3"], names["h4"], names["h5"], names["h999"]) == ("newer", "old", "old", "first")
    assert store.update(spark.createDataFrame([], schema)) is None
    stale = store.update(spark.createDataFrame([version("h3", "older again", 1)], schema))
    assert stale and {r.hcp_id: r.hcp_name for r in store.table(spark.createDataFrame([], schema).schema).collect()} == names

