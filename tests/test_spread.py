"""Shuffles begin with a number of partitions that follows the size of the tables."""

from fieldlens.sources import tables

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_partitions_follow_the_size_of_the_tables(spark, tmp_dir, monkeypatch):
    from fieldlens.plans.registry import lakehouse

    spark.range(20_000).withColumnRenamed("id", "l_orderkey").write.parquet(f"{tmp_dir}/lineitem.parquet")
    before = spark.conf.get(INITIAL, None)
    try:
        spark.conf.unset(INITIAL)
        own = int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert tables.spread(spark, tmp_dir) == own and spark.conf.get(INITIAL, None) is None   # small tables: the session's number
        monkeypatch.setattr(tables, "BYTES_A_PARTITION", 1_000)
        lakehouse(spark, tmp_dir)
        first = int(spark.conf.get(INITIAL))
        assert first > own
        spark.range(60_000).withColumnRenamed("id", "l_orderkey").write.mode("append").parquet(f"{tmp_dir}/lineitem.parquet")
        assert tables.spread(spark, tmp_dir) > 2 * first
        spark.conf.set(INITIAL, "1000000")
        assert tables.spread(spark, tmp_dir) == 1_000_000 == int(spark.conf.get(INITIAL))   # a larger number stays
    finally:
        spark.conf.unset(INITIAL) if before is None else spark.conf.set(INITIAL, before)


def test_tasks_get_a_few_mb_of_shuffled_keys(spark, tmp_dir):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "64MB")
        tables.spread(spark, tmp_dir)
        assert int(spark.conf.get(name)) == tables.SHUFFLED_BYTES_A_TASK
        spark.conf.set(name, "1MB")
        tables.spread(spark, tmp_dir)
        assert spark.conf.get(name) == "1MB"   # a smaller size stays
    finally:
        spark.conf.set(name, before)
