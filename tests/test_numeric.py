"""Exact HALF_UP rounding of ratios, checked against Python's Decimal on random inputs."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldlens.functions.numeric import exact_avg, quotient


def half_up(num: int, den: int, scale: int) -> float:
    return float((Decimal(num) / Decimal(den)).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP))


pairs = st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 10**6)), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None)
@given(pairs)
def test_quotient_rounds_half_up(spark, rows):
    df = spark.createDataFrame(rows, "n long, d long")
    out = df.select(*[F.round(quotient(F.col("n"), F.col("d")), s).cast("double").alias(f"s{s}")
                      for s in (1, 2, 3)]).collect()
    for (n, d), r in zip(rows, out):
        assert (r.s1, r.s2, r.s3) == (half_up(n, d, 1), half_up(n, d, 2), half_up(n, d, 3))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=60), st.integers(1, 7))
def test_exact_avg_independent_of_partitioning(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(parts)
    got = df.agg(F.round(exact_avg(F.col("v")), 1).cast("double")).first()[0]
    assert got == half_up(sum(values), len(values), 1)


def test_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(3, 0)], "n long, d long")
    assert df.select(quotient(F.col("n"), F.col("d"))).first()[0] is None
