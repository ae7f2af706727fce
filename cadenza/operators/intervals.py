"""Interval algebra over (key, start_ms, end_ms) tables, half open, in whole milliseconds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = "video_id"
#: Width of the buckets by which a range join becomes an equi-join: long intervals are copied into each that they meet.
BUCKET_MS = 600_000


def islands(df: DataFrame, breaks: Column, order: list[str], name: str = "island", key: str = KEY) -> DataFrame:
    """Running count of rows where breaks holds, per key: rows between two breaks share a number."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(F.when(breaks, 1).otherwise(0)).over(w))


def running(df: DataFrame, name: str, value: Column, how: Callable[[Column], Column], last: int, key: str = KEY) -> DataFrame:
    """df with name: how (sum or max) of value over its key's rows by start_ms and end_ms, up to the row itself (last 0) or the one before (-1).

    The same as a window over the key, but a task holds a key's rows of one bucket of time only: buckets run by themselves, and
    what the earlier ones come to is added from one row for each. Rows alike in key, start_ms and end_ms: the greatest value first.
    """
    plus = F.greatest if how is F.max else lambda a, b: F.when(a.isNull() | b.isNull(), F.coalesce(a, b)).otherwise(a + b)
    parted = df.withColumns({"__b": F.floor(F.col("start_ms") / BUCKET_MS), "__v": value})
    inside = Window.partitionBy(key, "__b").orderBy("start_ms", "end_ms", F.desc("__v")).rowsBetween(Window.unboundedPreceding, last)
    earlier = Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    sums = parted.groupBy(key, "__b").agg(how(F.col("__v")).alias("__s"))
    sums = sums.select(F.col(key).alias("__k"), F.col("__b").alias("__c"), how(F.col("__s")).over(earlier).alias("__e"))
    own = parted.withColumn("__o", how(F.col("__v")).over(inside))
    met = own.join(sums, F.col(key).eqNullSafe(F.col("__k")) & F.col("__b").eqNullSafe(F.col("__c")))
    return met.withColumn(name, plus(F.col("__o"), F.col("__e"))).drop("__b", "__v", "__k", "__c", "__o", "__e")


def merge_intervals(
    df: DataFrame, gap: int, inclusive: bool = True, pad: int = 0, limit: Column | None = None, key: str = KEY, split: bool = False
) -> DataFrame:
    """(key, start_ms, end_ms, n): intervals no further apart than gap joined, then widened by pad within 0 and limit.

    inclusive: a gap of exactly that length joins. Nested intervals do not shorten the result. split: a key may hold more rows
    than a task should sort; costs two more shuffles and gives the same rows.
    """
    held = df.select(key, "start_ms", "end_ms")
    apart = F.col("start_ms") - F.col("reach")
    fresh = ~F.coalesce(apart <= gap if inclusive else apart < gap, F.lit(False))
    if split:
        held = running(held, "reach", F.col("end_ms"), F.max, -1, key)
        joined = running(held, "island", F.when(fresh, 1).otherwise(0), F.sum, 0, key)
    else:
        w = Window.partitionBy(key).orderBy("start_ms", "end_ms")
        held = held.withColumn("reach", F.max("end_ms").over(w.rowsBetween(Window.unboundedPreceding, -1)))
        joined = islands(held, fresh, ["start_ms", "end_ms"], key=key)
    out = joined.groupBy(key, "island").agg(
        F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.count("*").alias("n")
    )
    end = F.col("end_ms") + pad
    return out.select(
        key, F.greatest(F.col("start_ms") - pad, F.lit(0)).alias("start_ms"),
        (F.least(end, limit) if limit is not None else end).alias("end_ms"), "n",
    )


def range_join(points: DataFrame, ranges: DataFrame, at: str, start: str, end: str, how: str = "inner", key: str = KEY) -> DataFrame:
    """points joined with the ranges of their key where start <= at < end.

    The range's buckets are exploded and the join is on key and bucket, so that it shuffles instead of comparing every pair;
    a point lies in one bucket and meets each range once.
    """
    bucketed = ranges.withColumn(
        "__bucket",
        F.explode(F.sequence(F.floor(F.col(start) / BUCKET_MS), F.floor(F.greatest(F.col(end) - 1, F.col(start)) / BUCKET_MS))),
    ).withColumnRenamed(key, "__key")
    cond = (
        (F.col(key) == F.col("__key"))
        & (F.floor(F.col(at) / BUCKET_MS) == F.col("__bucket"))
        & (F.col(start) <= F.col(at))
        & (F.col(at) < F.col(end))
    )
    out = points.join(bucketed, cond, how)
    return out.drop("__key", "__bucket") if how in ("inner", "left") else out


def uncovered_spans(speech: DataFrame, words: DataFrame, least: int = 4000, join: int = 2000, key: str = KEY) -> DataFrame:
    """(key, start_ms, end_ms): stretches of at least that length inside a speech segment which no word covers.

    A segment's words are those that start in it. Stretches up to join apart become one.
    """
    seg = speech.select(F.col(key), F.col("start_ms").alias("a"), F.col("end_ms").alias("b"))
    inside = range_join(words.select(key, "start_ms", "end_ms"), seg, "start_ms", "a", "b", key=key)
    marks = inside.select(key, "a", "b", "start_ms", "end_ms").unionByName(
        seg.select(key, "a", "b", F.col("b").alias("start_ms"), F.col("b").alias("end_ms"))
    )
    w = Window.partitionBy(key, "a", "b").orderBy("start_ms", "end_ms").rowsBetween(Window.unboundedPreceding, -1)
    cursor = F.greatest(F.col("a"), F.coalesce(F.max("end_ms").over(w), F.col("a")))
    holes = marks.withColumn("from", cursor).where(F.col("start_ms") - F.col("from") >= least)
    found = holes.select(key, F.col("from").alias("start_ms"), F.col("start_ms").alias("end_ms"))
    return merge_intervals(found, join, key=key).drop("n").where(F.col("end_ms") - F.col("start_ms") >= least)


def subtract_intervals(spans: DataFrame, occupied: DataFrame, limit: int | None = None, least: int = 250, key: str = KEY) -> DataFrame:
    """(key, start_ms, end_ms): what of each span no occupied interval covers, up to limit, in pieces of at least that length."""
    taken = merge_intervals(occupied, 0, key=key).select(F.col(key).alias("__k"), F.col("start_ms").alias("oa"), F.col("end_ms").alias("ob"))
    s = spans.select(key, F.col("start_ms").alias("a"), F.col("end_ms").alias("b"))
    if limit is not None:
        s = s.withColumn("b", F.least("b", F.lit(limit)))
    s = s.where("a < b").distinct()
    buckets = lambda x, y: F.explode(F.sequence(F.floor(F.col(x) / BUCKET_MS), F.floor((F.col(y) - 1) / BUCKET_MS)))
    left = s.withColumn("k", buckets("a", "b"))
    right = taken.where("oa < ob").withColumn("ok", buckets("oa", "ob"))
    met = left.join(right, (F.col(key) == F.col("__k")) & (F.col("k") == F.col("ok")) & (F.col("oa") < F.col("b")) & (F.col("a") < F.col("ob")))
    blocks = met.select(key, "a", "b", "oa", "ob").distinct()
    marks = blocks.unionByName(s.select(key, "a", "b", F.col("b").alias("oa"), F.col("b").alias("ob")))
    w = Window.partitionBy(key, "a", "b").orderBy("oa", "ob").rowsBetween(Window.unboundedPreceding, -1)
    start = F.greatest(F.col("a"), F.coalesce(F.max("ob").over(w), F.col("a")))
    return marks.withColumn("s", start).where(F.col("oa") - F.col("s") >= least).select(key, F.col("s").alias("start_ms"), F.col("oa").alias("end_ms"))


def hole_windows(holes: DataFrame, margin: int = 5000, most: int = 20, key: str = KEY) -> DataFrame:
    """The first holes of each key with the window to read again around each."""
    w = Window.partitionBy(key).orderBy("start_ms", "end_ms")
    return holes.withColumn("n", F.row_number().over(w)).where(F.col("n") <= most).select(
        key, "n", "start_ms", "end_ms", F.greatest(F.col("start_ms") - margin, F.lit(0)).alias("read_from"),
        (F.col("end_ms") + margin).alias("read_to"),
    )


def splice_recovered(words: DataFrame, recovered: DataFrame, holes: DataFrame, key: str = KEY) -> DataFrame:
    """words and those recovered ones that start inside a hole."""
    inside = range_join(recovered, holes.select(key, F.col("start_ms").alias("a"), F.col("end_ms").alias("b")), "start_ms", "a", "b", key=key)
    return words.unionByName(inside.select(*words.columns))


def hole_summary(videos: DataFrame, holes: DataFrame, scanned: DataFrame, key: str = KEY) -> DataFrame:
    """Holes and their milliseconds per key; null where the key was not scanned, zero where it was and has none."""
    sums = holes.groupBy(key).agg(F.count("*").alias("n"), F.sum(F.col("end_ms") - F.col("start_ms")).alias("ms"))
    known = videos.select(key).distinct().join(scanned.select(key, F.lit(True).alias("known")).distinct(), key, "left").join(sums, key, "left")
    value = lambda c: F.when(F.col("known"), F.coalesce(F.col(c), F.lit(0)))
    return known.select(key, value("n").alias("n_holes"), value("ms").alias("hole_ms"))


def unit_extents(units: DataFrame, rate: int = 24) -> DataFrame:
    """Span that each non-empty unit occupies: to its end or that of its sound, whichever is later."""
    end = F.expr(f"greatest(end_ms, start_ms + samples div {rate})")
    return units.where("samples > 0").select(KEY, "lead", "start_ms", end.alias("end_ms"))


def place_units(units: DataFrame, rate: int = 24, key: str = KEY) -> DataFrame:
    """Slot, placed length and silence of each unit, in samples; a slot that is not positive is null and flagged."""
    w = Window.partitionBy(key).orderBy("lead")
    offset = F.col("start_ms") * rate
    u = units.withColumn("offset", offset).withColumn("raw", F.lead(offset).over(w) - offset)
    last = Window.partitionBy(key)
    u = u.withColumn("slot", F.when(F.col("raw") > 0, F.col("raw")))
    u = u.withColumn("total", F.max_by(F.col("offset") + F.col("samples"), F.col("lead")).over(last))
    placed = F.greatest(F.least("samples", F.coalesce("slot", "samples"), F.col("total") - F.col("offset")), F.lit(0))
    return u.withColumn("placed", placed).select(
        key, "lead", "offset", "slot", "placed", F.when(F.col("raw") <= 0, "bad_slot").alias("flag"),
        F.greatest((F.col("end_ms") - F.col("start_ms")) * rate - F.col("placed"), F.lit(0)).alias("span_silence"),
        F.greatest(F.col("slot") - F.col("placed"), F.lit(0)).alias("slot_silence"),
    )


def merge_id_ranges(df: DataFrame, key: str = KEY) -> DataFrame:
    """Id ranges (lo, hi inclusive, reasons) that overlap or touch joined, with all their reasons sorted."""
    w = Window.partitionBy(key).orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    held = df.withColumn("reach", F.max("hi").over(w))
    joined = islands(held, ~F.coalesce(F.col("lo") <= F.col("reach") + 1, F.lit(False)), ["lo", "hi"], key=key)
    return joined.groupBy(key, "island").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("reasons")))), ",").alias("reasons"),
    ).drop("island")


def clip_spans(ranges: DataFrame, sentences: DataFrame, pad: int = 250, key: str = KEY) -> DataFrame:
    """Time of each id range widened by pad, but never into the sentence before or after."""
    s = sentences.select(key, "id", "start_ms", "end_ms")
    at = lambda i, name: s.select(key, F.col("id").alias(i), F.col(name).alias(f"{i}_{name}"))
    r = ranges.withColumn("before", F.col("lo") - 1).withColumn("after", F.col("hi") + 1)
    r = r.join(at("lo", "start_ms"), [key, "lo"]).join(at("hi", "end_ms"), [key, "hi"])
    r = r.join(at("before", "end_ms"), [key, "before"], "left").join(at("after", "start_ms"), [key, "after"], "left")
    return r.select(
        key, "lo", "hi",
        F.greatest(F.col("lo_start_ms") - pad, F.coalesce("before_end_ms", F.lit(0)), F.lit(0)).alias("start_ms"),
        F.least(F.col("hi_end_ms") + pad, F.coalesce("after_start_ms", F.col("hi_end_ms") + pad)).alias("end_ms"),
    )


def place_cues(units: DataFrame, sentences: DataFrame, key: str = KEY) -> DataFrame:
    """Cue of each sentence: its share, by characters, of the unit's time; onsets never run backwards and ends meet the next.

    units has lead, start_ms and end_ms of what is heard, sentences the lead of their unit; a sentence without a unit keeps its
    own times.
    """
    u = units.select(key, "lead", F.col("start_ms").alias("ua"), F.col("end_ms").alias("ub"))
    s = sentences.join(u, [key, "lead"], "left").withColumn("width", F.greatest(F.char_length("text"), F.lit(1)).cast("bigint"))
    w = Window.partitionBy(key, "lead")
    before = F.coalesce(F.sum("width").over(w.orderBy("id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    s = s.withColumn("all", F.sum("width").over(w)).withColumn("before", before)
    start = F.expr("coalesce(ua + (ub - ua) * before div all, start_ms)")
    end = F.expr("coalesce(ua + (ub - ua) * (before + width) div all, end_ms)")
    v = Window.partitionBy(key).orderBy("id")
    s = s.withColumn("s", start).withColumn("e", end)
    s = s.withColumn("onset", F.max("s").over(v.rowsBetween(Window.unboundedPreceding, 0)))
    return s.select(key, "id", F.col("onset").alias("start_ms"), F.greatest(F.col("e"), F.coalesce(F.lead("onset").over(v), F.col("e"))).alias("end_ms"))


def span_breakdown(df: DataFrame) -> DataFrame:
    """Milliseconds waited and worked of each stage span; null where a stamp is missing."""
    return df.withColumn("wait_ms", F.col("started_ms") - F.col("enqueued_ms")).withColumn("work_ms", F.col("finished_ms") - F.col("started_ms"))
