"""Similarity of texts by matching blocks, near-duplicate neighbours, and agreement of readings."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions import text as T
from cadenza.operators.intervals import KEY
from cadenza.operators.matching import letters, longest_blocks, matching_blocks

#: Letters that letter_counts counts one by one.
FREQUENT = "etaoinsrhldcu"


#: Characters of pairs that are matched together.
TOGETHER = 50_000


def _in_parts(a: pd.Series, b: pd.Series) -> Iterator[tuple[list, list]]:
    """The pairs as code points, as many at a time as have TOGETHER characters."""
    left, right, size = [], [], 0
    for x, y in zip(map(letters, a), map(letters, b), strict=True):
        left.append(x)
        right.append(y)
        size += len(x) + len(y)
        if size >= TOGETHER:
            yield left, right
            left, right, size = [], [], 0
    yield left, right


def _ratios(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        out: list[float] = []
        for x, y in _in_parts(a, b):
            for p, q, blocks in zip(x, y, matching_blocks(x, y), strict=True):
                n = len(p) + len(q)
                out.append(2 * sum(k for _, _, k in blocks) / n if n else 1.0)
        yield pd.Series(out, dtype="float64")


def _shares(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        out: list[float] = []
        for x, y in _in_parts(a, b):
            out += [k / min(len(p), len(q)) if k else 0.0 for p, q, k in zip(x, y, longest_blocks(x, y), strict=True)]
        yield pd.Series(out, dtype="float64")


def seq_ratio(a: Column | str, b: Column | str) -> Column:
    """Twice the characters in matching blocks over all characters; nulls count as empty."""
    return F.pandas_udf(_ratios, "double")(a, b)


def containment(a: Column | str, b: Column | str) -> Column:
    """Longest common substring over the shorter length; 0 if either is empty."""
    return F.pandas_udf(_shares, "double")(a, b)


def letter_counts(c: Column) -> Column:
    """A struct of counts: frequent letters, the other ones of a-z, and all other characters."""
    count = lambda x: F.char_length(c) - F.char_length(F.replace(c, F.lit(x), F.lit("")))
    rest = {"rare": F.regexp_count(c, F.lit(r"[bfgjkmpqvwxyz]")), "other": F.regexp_count(c, F.lit(r"[^a-z]"))}
    return F.struct(*(count(x).alias(x) for x in FREQUENT), *(v.alias(k) for k, v in rest.items()))


def letter_overlap(a: Column, b: Column) -> Column:
    """Characters that two texts can share at most, from their letter_counts."""
    total = F.least(a["rare"], b["rare"]) + F.least(a["other"], b["other"])
    for x in FREQUENT:
        total = total + F.least(a[x], b[x])
    return total


def _alike(ratio: float, inside: float):
    def run(pairs: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b, middle in pairs:
            out = []
            for x, y, held in zip(a, b, middle, strict=True):
                m = SequenceMatcher(None, x, y, False)
                near = x == y or m.quick_ratio() > ratio and m.ratio() > ratio
                out.append(near or held and m.find_longest_match(0, len(x), 0, len(y)).size / min(len(x), len(y)) > inside)
            yield pd.Series(out, dtype=bool)

    return F.pandas_udf(run, "boolean")


def duplicate_adjacent(sentences: DataFrame, least: int = 25, ratio: float = 0.80, inside: float = 0.85) -> DataFrame:
    """(video_id, id, twin): neighbours that are nearly equal or of which one holds the other; both are listed.

    Pairs reach Python only if their letters allow the ratio, or if the longer one holds the middle of the shorter one: any
    common part over the share inside, which is above a half, covers it. In a run, inner members keep the later twin.
    """
    w = Window.partitionBy(KEY).orderBy("id")
    s = sentences.select(KEY, "id", F.col("text").alias("a"), letter_counts(F.col("text")).alias("ca"))
    p = s.select(KEY, "id", "a", "ca", *(F.lead(c).over(w).alias(n) for c, n in (("a", "b"), ("ca", "cb"), ("id", "next"))))
    la, lb = F.char_length("a"), F.char_length("b")
    n = F.least(la, lb)
    start, stop = F.floor(n * (1 - inside)).cast("int") + 1, F.ceil(n * inside).cast("int") - 1  # a character less on each side
    first = la <= lb
    middle = F.substring(F.when(first, F.col("a")).otherwise(F.col("b")), start + 1, stop - start)
    p = p.where((la > least) & (lb > 0)).select(
        KEY, "id", "next", "a", "b", (2 * letter_overlap(F.col("ca"), F.col("cb")) > ratio * (la + lb)).alias("close"),
        F.contains(F.when(first, F.col("b")).otherwise(F.col("a")), middle).alias("held"),
    )
    hit = p.where("close or held").where(_alike(ratio, inside)("a", "b", "held"))
    both = hit.select(KEY, F.explode(F.array(F.struct(F.col("id").alias("id"), F.col("next").alias("twin")), F.struct(F.col("next").alias("id"), F.col("id").alias("twin")))).alias("x"))
    return both.groupBy(KEY, "x.id").agg(F.max("x.twin").alias("twin"))


def readings_agree(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per window (video_id, lo) whether two readings, word by word in seq, say the same and anything at all.

    Both are gathered by one aggregation, so that words are shuffled at most once and no texts are sorted for a join.
    """
    both = a.select(KEY, "lo", F.lit(0).alias("side"), "seq", "word").unionByName(b.select(KEY, "lo", F.lit(1).alias("side"), "seq", "word"))

    def said(side: int) -> Column:
        held = F.array_sort(F.collect_list(F.when(F.col("side") == side, F.struct("seq", "word"))))
        return F.when(F.count_if(F.col("side") == side) > 0, T.norm_text(F.array_join(F.transform(held, lambda x: x["word"]), "")))

    j = both.groupBy(KEY, "lo").agg(said(0).alias("a"), said(1).alias("b"))
    return j.select(KEY, "lo", F.coalesce((F.col("a") == F.col("b")) & (F.col("a") != ""), F.lit(False)).alias("agree"))


def collateral_ids(sentences: DataFrame, readings: DataFrame) -> DataFrame:
    """Sentences of a window, seeds aside, whose text the new reading (video_id, lo, hi, text) does not hold."""
    j = sentences.join(readings.select(KEY, "lo", "hi", F.col("text").alias("reading")), KEY).where("id between lo and hi and not seed")
    return j.where(~F.contains(T.norm_text(F.col("reading")), T.norm_text(F.col("text")))).select(KEY, "lo", "id")


def repair_decisions(windows: DataFrame) -> DataFrame:
    """Outcome of each window (span_ms, error, reading_a, reading_b, old): the first that holds of empty_span, error,
    readings_differ, empty_reading, else accepted, and whether nothing changed."""
    a, b, old = (T.norm_text(F.coalesce(F.col(c), F.lit(""))) for c in ("reading_a", "reading_b", "old"))
    out = (
        F.when(F.coalesce("span_ms", F.lit(0)) <= 0, "empty_span").when(F.col("error").isNotNull(), "error")
        .when(a != b, "readings_differ").when(a == "", "empty_reading").otherwise("accepted")
    )
    return windows.withColumn("outcome", out).withColumn("unchanged", (F.col("outcome") == "accepted") & (a == old))


def verify_units(units: DataFrame, hypotheses: DataFrame, threshold: float = 0.9, enabled: bool = True) -> DataFrame:
    """(video_id, id, flag, similarity, hypothesis) for each sentence of units (lead, ids, ref) against what was heard.

    Flags: empty_ref, missing_wav, unreadable_wav (a row with a null hyp), empty_hyp, low_similarity, null where all is well; members share their unit's, the heard text
    stands with the leader only. Not enabled: all null.
    """
    j = units.join(hypotheses.select(KEY, "lead", "hyp", F.lit(True).alias("heard")), [KEY, "lead"], "left")
    ref, hyp = (F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(c), F.lit(""))), r"[^\p{L}\p{N}_]+", " ")) for c in ("ref", "hyp"))
    j = j.withColumn("r", ref).withColumn("h", hyp).withColumn("similarity", seq_ratio("r", "h"))
    flag = (
        F.when(F.col("r") == "", "empty_ref").when(F.col("heard").isNull(), "missing_wav")
        .when(F.col("hyp").isNull(), "unreadable_wav").when(F.col("h") == "", "empty_hyp")
        .when(F.col("similarity") < threshold, "low_similarity")
    )
    on = F.lit(enabled)
    return j.withColumn("id", F.explode("ids")).select(
        KEY, "id", F.when(on, flag).alias("flag"), F.when(on, F.col("similarity")).alias("similarity"),
        F.when(on & (F.col("id") == F.col("lead")), F.col("hyp")).alias("hypothesis"),
    )


def ab_summary(cells: DataFrame) -> DataFrame:
    """Per video: least similarity within a variant's repeats and across variants, by a self-join on the video.

    cells: video, variant, repeat, text; repeats of one video and variant are few by design.
    """
    x, y = cells.alias("x"), cells.alias("y")
    later = (F.col("x.variant") < F.col("y.variant")) | ((F.col("x.variant") == F.col("y.variant")) & (F.col("x.repeat") < F.col("y.repeat")))
    p = x.join(y, (F.col("x.video") == F.col("y.video")) & later).select(
        F.col("x.video").alias("video"), (F.col("x.variant") == F.col("y.variant")).alias("same"), F.col("x.text").alias("a"), F.col("y.text").alias("b")
    )
    p = p.withColumn("s", seq_ratio("a", "b"))
    return p.groupBy("video").agg(F.min(F.when(F.col("same"), F.col("s"))).alias("worst_same"), F.min(F.when(~F.col("same"), F.col("s"))).alias("worst_cross"))
