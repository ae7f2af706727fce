"""Merging by buckets of time against merging by one window."""

import random

import pytest

from cadenza.operators import intervals as I


@pytest.mark.parametrize("gap, inclusive", [(0, True), (500, False), (700_000, True)])
def test_split_gives_the_same_rows(spark, gap, inclusive):
    rng = random.Random(gap)
    starts = [rng.randrange(0, 20_000_000, 500) for _ in range(3000)]
    rows = [(1, a, a + rng.choice([0, 500, 4000, 2_000_000 if rng.random() < 0.01 else 1000])) for a in starts]
    rows += rows[:50] + [(2, 599_500, 600_000), (2, 600_000, 600_500), (None, 5, 9), (None, 9, 12), (3, None, 4), (3, 1, None), (3, 2, 3)]
    df = spark.createDataFrame(rows, "video_id long, start_ms long, end_ms long")
    key = lambda r: tuple((v is not None, v or 0) for v in r)
    one, two = (sorted(map(tuple, I.merge_intervals(df, gap, inclusive, split=s).collect()), key=key) for s in (False, True))
    assert two == one
