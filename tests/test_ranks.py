"""Exact percentiles by search against those of one aggregation."""

import random

import pytest
from pyspark.sql import functions as F

from cadenza.operators.ranks import exact_percentiles

SHARES = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p99": 0.999, "p100": 1.0}


@pytest.mark.parametrize("large", [0, 3, 50, 10**6])
def test_percentiles(spark, large):
    r = random.Random(large)
    rows = [(1, r.lognormvariate(0, 4)) for _ in range(3000)] + [(2, float(r.randrange(5))) for _ in range(400)] + [(3, 7.5)]
    rows += [(4, None), (5, None), (5, -1.0), (5, 2.0), (None, 1.0), (1, -1e300), (1, 1e300), *[(6, 1.0 + k * 2**-52) for k in range(40)]]
    df = spark.createDataFrame(rows, "k int, v double")
    want = df.where("v is not null and k is not null").groupBy("k").agg(*(F.percentile("v", s).alias(n) for n, s in SHARES.items()))
    got = exact_percentiles(df.where("k is not null"), ["k"], "v", SHARES, large)
    as_rows = lambda d: {x["k"]: tuple(x[n] for n in SHARES) for x in d.collect()}
    a, b = as_rows(got), as_rows(want)
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], rel=1e-12) for k in a)
    assert exact_percentiles(df.limit(0), ["k"], "v", SHARES, large).count() == 0
