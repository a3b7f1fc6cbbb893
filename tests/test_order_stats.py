import inspect
import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenurecast.functions import order_stats
from tenurecast.functions.order_stats import exact_quantiles, from_ordered_bits, ordered_bits, values_at_ranks


@pytest.fixture(scope="module")
def values(spark):
    """Continuous, hot-valued, constant, sparse and integer columns."""
    df = spark.range(0, 3000, 1, 6).select(
        F.randn(1).alias("normal"),
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.rand(2) * 20).alias("hot"),
        F.lit(4.5).alias("constant"),
        F.when(F.col("id") % 50 == 0, F.rand(3)).alias("sparse"),
        (F.col("id") % 12).alias("month"),
        F.lit(None).cast("double").alias("empty"),
    )
    return df.persist()


# Few bits a pass and a tiny fetch limit force every branch of the search.
@pytest.mark.parametrize("limits", [{}, {"bits": 5, "fetch_limit": 5}, {"bits": 20, "fetch_limit": 40}])
def test_quantiles_equal_numpy(values, limits):
    names = values.columns
    shares = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    found = exact_quantiles(values, names, shares, **limits)
    frame = values.toPandas().astype(float)
    for c in names:
        if c == "empty":
            assert found[c] == [None] * len(shares)
        else:
            want = np.nanpercentile(frame[c], [100 * s for s in shares])
            assert np.allclose(found[c], want, rtol=1e-12, atol=1e-12), c


def test_every_rank(spark):
    data = sorted([1.0] * 40 + [2.0] * 3 + [float(i) for i in range(50)] + [-1e300, 1e300])
    df = spark.createDataFrame([(x,) for x in data], "x double")
    ranks = list(range(len(data)))
    found = values_at_ranks(df, {"x": ranks}, {"x": len(data)}, bits=9, fetch_limit=3)
    assert [found["x", r] for r in ranks] == data


def test_rank_out_of_range(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError):
        values_at_ranks(df, {"x": [1]}, {"x": 1})


def test_interpolation_of_two(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double")
    assert exact_quantiles(df, ["x"], [0.25])["x"] == [1.5]
    assert math.isclose(exact_quantiles(df, ["x"], [0.9])["x"][0], 3.6)


def test_bits_order_like_doubles(spark):
    """The 64 bits of every kind of double, and back."""
    random = np.random.default_rng(4)
    raw = random.integers(0, 2**63, 4000).astype(np.uint64) | (random.integers(0, 2, 4000).astype(np.uint64) << np.uint64(63))
    some = [x for x in raw.view(np.float64).tolist() if math.isfinite(x)]
    powers = [s * math.ldexp(m, e) for e in range(-1074, 1024, 7) for m in (1.0, 1.0 - 2**-53, 1.0 + 2**-52) for s in (1, -1)]
    data = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, math.inf, -math.inf, 1e308, 7.0, *some, *powers]
    df = spark.createDataFrame([(x,) for x in data], "x double")
    rows = ordered_bits(df, "x", "b").collect()
    for r in rows:
        bits = struct.unpack("<q", struct.pack("<d", abs(r.x)))[0]
        assert r.b == (-bits if r.x < 0 else bits)
        assert from_ordered_bits(r.b) == r.x


def test_search_has_no_sketch_and_sums_before_it_shuffles(spark, values):
    assert "percentile" not in inspect.getsource(order_stats)
    inside = order_stats._rows_inside(values, order_stats._slots([order_stats._Search("hot", 0, None, 0, 0, 3000)]), 0)
    text = inside.groupBy("slot", F.shiftright("bits", 50)).count()._jdf.queryExecution().executedPlan().toString()
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text


def test_huge_and_tiny_values(spark):
    data = [math.inf, -math.inf, 5e-324, -5e-324, 0.0, 1e308, -1e308, 3.0, None]
    df = spark.createDataFrame([(x,) for x in data], "x double")
    known = sorted(x for x in data if x is not None)
    found = values_at_ranks(df, {"x": list(range(8))}, {"x": 8}, bits=14, fetch_limit=0)
    assert [found["x", r] for r in range(8)] == known


def test_a_pass_sums_rows_before_they_leave_their_batch(values):
    """Quantiles of wide tables made one row of every value, 27 a row of features."""
    searches = [order_stats._Search(c, 0, None, 0, 0, 3000) for c in ("constant", "month")]
    rows = order_stats._rows_inside(values, order_stats._slots(searches), 0, 16).collect()
    assert len(rows) <= 6 * (1 + 12)
    assert [sum(r["n"] for r in rows if r["slot"] == slot) for slot in (0, 1)] == [3000, 3000]
    assert {(r["bits"], r["most"]) for r in rows if r["slot"] == 0} == {(4616752568008179712, 4616752568008179712)}


def test_nan_is_above_infinity(spark):
    df = spark.createDataFrame([(math.nan,), (1.0,), (math.inf,), (-math.nan,), (None,), (-0.0,)], "x double")
    found = values_at_ranks(df, {"x": list(range(5))}, {"x": 5}, bits=7, fetch_limit=0)
    assert [found["x", r] for r in range(3)] == [0.0, 1.0, math.inf]
    assert math.isnan(found["x", 3]) and math.isnan(found["x", 4])
