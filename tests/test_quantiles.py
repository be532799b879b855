"""Exact distributed quantiles vs brute force and Spark's percentile_disc."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterlens.operators.quantiles import exact_quantiles

LEVELS = [0.0, 0.25, 0.5, 0.75, 1.0]


def brute(values, p):
    s = sorted(values, key=lambda x: (math.isnan(x), x))
    return s[max(1, math.ceil(len(s) * p)) - 1]


def same(a, b):
    return (a is None and b is None) or (a == b) or (math.isnan(a) and math.isnan(b))


random.seed(7)
CASES = {
    "single": [1.0],
    "constant": [0.3] * 50,
    "two": [1.0, 2.0],
    "three": [3.0, 1.0, 2.0],
    "uniform": [random.random() for _ in range(3000)],
    "metered": [round(random.expovariate(3), 3) for _ in range(5000)],
    "hot_value": [0.5] * 4000 + [random.random() for _ in range(2000)],
    "negative": [-random.random() * 100 for _ in range(500)] + [0.0, 1.0],
    "huge_range": [-1e308, 1e308, 0.0, 5.0, -3.0],
    "subnormal": [5e-324, 1e-323, 0.0, 1.5e-323],
    "with_nan": [1.0, float("nan"), 2.0, 3.0],
    "with_infinities": [1.0, float("inf"), float("-inf"), 2.0, -0.0, float("inf")],
    "mixed_scale": [1e-300, -1e300, 3.5, 3.5000000000000004, -2.0, 7e200, 0.0],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_matches_brute_force(spark, name):
    values = CASES[name]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantiles(df, "x", LEVELS, buckets=64)
    assert all(same(g, brute(values, p)) for g, p in zip(got, LEVELS)), (got, name)


def test_matches_spark_percentile_disc(spark):
    values = CASES["metered"]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    disc = df.select(
        *[F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY x)") for p in (0.25, 0.75)]
    ).first()
    assert exact_quantiles(df, "x", [0.25, 0.75]) == list(disc)


def test_empty_and_nulls(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact_quantiles(df, "x", [0.5]) == [None]
    df2 = spark.createDataFrame([(None,), (2.0,), (1.0,)], "x double")
    assert exact_quantiles(df2, "x", [0.5, 1.0]) == [1.0, 2.0]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.floats(allow_nan=False, allow_infinity=False, width=64), min_size=1, max_size=40
    ),
    st.sampled_from([0.1, 0.25, 0.5, 0.75, 0.9]),
)
def test_property_random_lists(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert exact_quantiles(df, "x", [p], buckets=8) == [brute(values, p)]
