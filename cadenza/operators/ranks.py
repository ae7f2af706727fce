"""Exact percentiles of groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.sources.scratch import cut

#: Groups with more different values than this, and than one in SHARE of all, are searched; there are fewer than SHARE of them.
LARGE = 100_000
SHARE = 2000
BINS = 1024


def exact_percentiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float], large: int = LARGE) -> DataFrame:
    """keys and a column for each of shares (name: share from 0 to 1), interpolated linearly; nulls are left out.

    Rows are counted by value first. A group with few different values is one aggregation's. In a large one every wanted
    rank is looked for in rounds: its values are counted in BINS of equal width, and the bin that holds the rank is the
    next round's range, until it has one value; no task holds a group. Values must be finite; a null key is no large group.
    """
    v = F.col(value).cast("double")
    counts = cut(df.where(v.isNotNull()).groupBy(*keys, v.alias("__v")).agg(F.count("*").alias("__n")))
    groups = cut(
        counts.groupBy(*keys).agg(
            F.count("*").alias("__kinds"), F.sum("__n").alias("__total"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")
        )
    )
    bar = max(large, (groups.agg(F.sum("__kinds")).first()[0] or 0) // SHARE)
    hot = groups.where(F.col("__kinds") > bar).drop("__kinds")
    few = counts.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    small = few.groupBy(*keys).agg(*(F.percentile("__v", share, F.col("__n")).alias(name) for name, share in shares.items()))
    if hot.isEmpty():
        return small

    def place(share: float) -> Column:
        return F.lit(share) * (F.col("__total") - 1)

    ranks = [f(place(s)).cast("bigint") for s in shares.values() for f in (F.floor, F.ceil)]
    todo = hot.select(*keys, "__lo", "__hi", F.lit(0).cast("bigint").alias("__under"), F.explode(F.array_distinct(F.array(*ranks))).alias("__rank"))
    found = None
    while True:
        inside = counts.join(F.broadcast(todo), keys).where("__v between __lo and __hi")
        width = F.col("__hi") - F.col("__lo")
        at = F.when(width > 0, F.least(F.floor((F.col("__v") - F.col("__lo")) / width * BINS), F.lit(BINS - 1))).otherwise(0)
        bins = inside.groupBy(*keys, "__rank", "__under", at.alias("__bin")).agg(
            F.sum("__n").alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")
        )
        lower = Window.partitionBy(*keys, "__rank").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
        bins = bins.withColumn("__under", F.col("__under") + F.coalesce(F.sum("__n").over(lower), F.lit(0)))
        holds = (F.col("__under") <= F.col("__rank")) & (F.col("__rank") < F.col("__under") + F.col("__n"))
        todo = cut(bins.where(holds).select(*keys, "__lo", "__hi", "__under", "__rank"))
        done = todo.where("__lo = __hi").select(*keys, "__rank", F.col("__lo").alias("__v"))
        found = done if found is None else found.unionByName(done)
        todo = todo.where("__lo < __hi")
        if todo.isEmpty():
            break
    known = found.join(F.broadcast(hot.select(*keys, "__total")), keys).groupBy(*keys).agg(
        F.first("__total").alias("__total"), F.map_from_entries(F.collect_list(F.struct("__rank", "__v"))).alias("__at")
    )

    def between(share: float) -> Column:
        p = place(share)
        low, high = (F.element_at("__at", f(p).cast("bigint")) for f in (F.floor, F.ceil))
        return F.when(F.floor(p) == F.ceil(p), low).otherwise((F.ceil(p) - p) * low + (p - F.floor(p)) * high)

    return small.unionByName(known.select(*keys, *(between(s).alias(n) for n, s in shares.items())))
