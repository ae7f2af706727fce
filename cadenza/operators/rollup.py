"""Aggregations per video, per stage and over a batch. Null is unknown, never zero; vocabularies always give every key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions import text as T
from cadenza.operators.intervals import KEY

BROKEN_MILLI = 1800


def whole(c: Column) -> Column:
    """Rounded down, with room for an interpolated value that falls just short of a whole one."""
    return F.floor(c + 0.01).cast("bigint")


def unit_leaders(report: DataFrame) -> DataFrame:
    """First row by id of each unit."""
    group = F.coalesce("group_id", "id")
    w = Window.partitionBy(KEY, group).orderBy("id")
    return report.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


def _ranked(df: DataFrame, value: Column) -> DataFrame:
    """df with __v, the value, __rank, its place from 0 among its key's values, and __n, how many there are; nulls come last.

    Ranks cost one sort, where percentile keeps and serializes a map of counts for each key.
    """
    w = Window.partitionBy(KEY).orderBy(F.col("__v").asc_nulls_last())
    all_ = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn("__v", value).withColumns({"__rank": F.row_number().over(w) - 1, "__n": F.count("__v").over(all_)})


def _percentile(q: float) -> Column:
    """An aggregate over _ranked rows: the same as percentile of the value; null without values."""
    at = (F.col("__n") - 1) * F.lit(q)
    low, high = F.floor(at), F.ceil(at)
    share = F.when(F.col("__rank") == low, F.when(low == high, 1.0).otherwise(high - at)).when(F.col("__rank") == high, at - low)
    return F.sum(share * F.col("__v"))


def _speed() -> list[Column]:
    c = F.col("__v")
    return [
        whole(_percentile(0.5)).alias("median"), whole(_percentile(0.95)).alias("p95"),
        F.max(c).alias("most"), F.when(F.count(c) > 0, F.count_if(c >= BROKEN_MILLI)).alias("n_broken"),
    ]


def speed_stats(report: DataFrame) -> DataFrame:
    """Median, 95th percentile and maximum of the leaders' factors in thousandths, and how many are broken; null without any."""
    return _ranked(unit_leaders(report), F.col("combined_milli")).groupBy(KEY).agg(*_speed())


def _histogram(flag: str, vocabulary: list[str]) -> list[Column]:
    known = F.when(F.col(flag).isin([v for v in vocabulary if v != "unknown"]), F.col(flag)).when(F.col(flag).isNotNull(), "unknown")
    return [F.count_if(known == v).alias(v) for v in vocabulary]


def flag_histogram(df: DataFrame, flag: str, vocabulary: list[str]) -> DataFrame:
    """Counts per video of every listed flag; others fall to unknown."""
    return df.groupBy(KEY).agg(*_histogram(flag, vocabulary))


def actionable(flags: Column) -> Column:
    """Flags that are not advisory ones, each once."""
    return F.array_except(flags, F.array(*map(F.lit, T.ADVISORY_COMPLETENESS)))


def _completeness() -> list[Column]:
    act = F.size(actionable(F.col("completeness_flags"))) > 0
    any_ = F.size("completeness_flags") > 0
    return [F.count_if(any_).alias("n_flagged"), F.count_if(act).alias("n_actionable"), F.count_if(any_ & ~act).alias("n_advisory")]


def completeness_rollup(report: DataFrame) -> DataFrame:
    """Rows with any flag, with one to act on, and with advisory ones only."""
    return report.groupBy(KEY).agg(*_completeness())


def source_rollup(translation: DataFrame, kinds: list[str], most: int = 40) -> DataFrame:
    """Anomalies by kind, null unless every record carries a mark; the first ids of the marked ones."""
    scanned = F.bool_and(F.col("src").isNotNull())
    kind = F.when(F.col("src").isin(kinds), F.col("src")).when(F.col("src") != "", "unknown")
    t = translation.withColumn("kind", kind)
    ids = F.slice(F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull(), F.col("id")))), 1, most)
    out = t.groupBy(KEY).agg(
        scanned.alias("scanned"), *(F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in [*kinds, "unknown"]), ids.alias("ids")
    )
    return out.select(KEY, "scanned", *(F.when(F.col("scanned"), F.col(f"n_{k}")).alias(f"n_{k}") for k in [*kinds, "unknown"]), F.array_join("ids", ",").alias("ids"))


def stage_overhead(stages: DataFrame) -> DataFrame:
    """Overhead of each stage, negative or unknown ones left out; total work, stages measured and whether all are."""
    over = F.col("wall_ms") - F.col("work_ms")
    return stages.groupBy(KEY).agg(
        F.sum(F.when(over >= 0, over)).alias("overhead_ms"), F.sum("work_ms").alias("work_ms"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("work_ms").isNotNull(), F.col("stage")))), ",").alias("measured"),
        F.bool_and(F.col("work_ms").isNotNull()).alias("complete"),
    )


def stage_coverage(timed: DataFrame, measured: DataFrame) -> DataFrame:
    """Per video of either: timed stages without work, measured ones without a time, and whether both are one set and not empty."""
    both = timed.select(KEY, F.col("stage").alias("t"), F.lit(None).cast("string").alias("m")).unionByName(
        measured.select(KEY, F.lit(None).cast("string").alias("t"), F.col("stage").alias("m"))
    )
    s = both.groupBy(KEY).agg(F.collect_set("t").alias("t"), F.collect_set("m").alias("m"))
    lack = lambda a, b: F.size(F.array_except(a, b)).cast("bigint")
    s = s.select(KEY, "t", lack("t", "m").alias("unmeasured"), lack("m", "t").alias("unknown"))
    return s.select(KEY, "unmeasured", "unknown", ((F.size("t") > 0) & (F.col("unmeasured") + F.col("unknown") == 0)).alias("complete"))


def run_timing(stages: DataFrame, durations: DataFrame) -> DataFrame:
    """Wall time of all stages, work (wall less every known overhead; null where none is known), whether all overheads are known,
    duration, and both over the duration in thousandths; an unknown duration or one of zero leaves these null."""
    over = F.col("wall_ms") - F.col("work_ms")
    s = stages.groupBy(KEY).agg(
        F.sum("wall_ms").alias("wall_ms"), F.sum(F.when(over >= 0, over)).alias("over"), F.bool_and(F.coalesce(over >= 0, F.lit(False))).alias("complete")
    )
    j = s.withColumn("work_ms", F.col("wall_ms") - F.col("over")).join(durations.select(KEY, "dur_ms"), KEY, "left")
    return j.select(
        KEY, "wall_ms", "work_ms", "complete", "dur_ms", F.expr("wall_ms * 1000 div nullif(dur_ms, 0)").alias("rtf_milli"),
        F.expr("work_ms * 1000 div nullif(dur_ms, 0)").alias("rtf_work_milli"),
    )


def duration_ladder(stated: DataFrame, probed: DataFrame, sentences: DataFrame) -> DataFrame:
    """Duration stated, else probed, else the last sentence's end, with its source."""
    last = sentences.groupBy(KEY).agg(F.max("end_ms").alias("last"))
    j = last.join(stated, KEY, "full").join(probed, KEY, "full")
    source = F.when(F.col("stated") > 0, "info").when(F.col("probed") > 0, "probed").when(F.col("last") > 0, "sentences")
    value = F.when(F.col("stated") > 0, F.col("stated")).when(F.col("probed") > 0, F.col("probed")).when(F.col("last") > 0, F.col("last"))
    return j.select(KEY, value.alias("dur_ms"), source.alias("source"))


def stage_shares(stages: DataFrame) -> DataFrame:
    """Tenths of a percent of a video's wall time in each stage."""
    total = F.sum("wall_ms").over(Window.partitionBy(KEY))
    with_total = stages.withColumn("total", total)
    return with_total.select(KEY, "stage", "wall_ms", F.expr("wall_ms * 1000 div nullif(total, 0)").alias("permille"))


def _triage() -> list[Column]:
    advisory = F.array(*map(F.lit, T.ADVISORY_COMPLETENESS))
    act = (
        (F.col("translate_flag").isNotNull() & (F.col("translate_flag") != "english_echo")).cast("int")
        + F.col("verify_flag").isNotNull().cast("int")
        + (F.size(F.array_except("completeness_flags", advisory)) > 0).cast("int")
    )
    total = F.col("translate_flag").isNotNull().cast("int") + F.col("verify_flag").isNotNull().cast("int") + (F.size("completeness_flags") > 0).cast("int")
    all_, acted = F.sum(total), F.sum(act)
    return [all_.alias("flags_total"), acted.alias("flags_actionable"), (all_ - acted).alias("flags_advisory"), (acted > 0).alias("needs_triage")]


def triage(report: DataFrame) -> DataFrame:
    """Flags in all, to act on and advisory, and whether the video needs a listener."""
    return report.groupBy(KEY).agg(*_triage())


def run_rollup(report: DataFrame, *more: DataFrame) -> DataFrame:
    """One row for each video: rows, units, speed, flags and triage; with the columns of more, such as run_timing, source_rollup,
    unit_counters or placement_stats, of one row per video and no names in common. A video only in more stands too.

    All of a report's figures come from one aggregation, so that it is read and shuffled once. A unit's leader is its first row by id.
    """
    group = F.coalesce("group_id", "id")
    before = F.lag(F.struct(group.alias("group"))).over(Window.partitionBy(KEY).orderBy(group, "id"))
    marked = report.withColumn("__leads", ~F.coalesce(before["group"].eqNullSafe(group) & before.isNotNull(), F.lit(False)))
    out = _ranked(marked, F.when(F.col("__leads"), F.col("combined_milli"))).groupBy(KEY).agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("__leads") & group.isNotNull()).alias("n_units"),
        *_speed(), *_histogram("verify_flag", T.VERIFY_FLAGS), *_completeness(), *_triage(),
    )
    for part in more:
        out = out.join(part, KEY, "full")
    return out


def batch_totals(stages: DataFrame) -> DataFrame:
    """Wall time of each stage over the batch with its share in tenths of a percent, and of all (stage null): one ROLLUP."""
    r = stages.rollup("stage").agg(F.sum("wall_ms").alias("wall_ms"), F.countDistinct(KEY).alias("n_videos"))
    total = F.max(F.when(F.col("stage").isNull(), F.col("wall_ms"))).over(Window.partitionBy(F.lit(1)))
    return r.withColumn("total", total).select("stage", "wall_ms", "n_videos", F.expr("wall_ms * 1000 div nullif(total, 0)").alias("permille"))


def queue_totals(items: DataFrame) -> DataFrame:
    """Over waves (wave_ms, draft_ms, sec_ms): wall time from the first start to the last draft of each, summed; items without.

    A draft older than its wave was carried over and is left out.
    """
    fresh = items.where("wave_ms is not null and draft_ms >= wave_ms")
    waves = fresh.groupBy("wave_ms").agg((F.max("draft_ms") - F.min(F.col("draft_ms") - F.col("sec_ms"))).alias("ms"), F.count("*").alias("n"))
    missing = items.agg(F.count_if(F.col("wave_ms").isNull() | (F.col("draft_ms") < F.col("wave_ms"))).alias("unmeasured"))
    return waves.agg(F.sum("ms").alias("wall_ms"), F.sum("n").alias("n_items"), F.count("*").alias("n_waves")).crossJoin(F.broadcast(missing))


def wave_window(inventory: DataFrame, marker: str, drafts: list[str]) -> DataFrame:
    """From the marker to the newest draft; null without a marker or where it is newer than all drafts."""
    a = F.max(F.when(F.col("artifact") == marker, F.col("modified_ms")))
    b = F.max(F.when(F.col("artifact").isin(drafts), F.col("modified_ms")))
    w = inventory.groupBy(KEY).agg(a.alias("start_ms"), b.alias("end_ms"))
    return w.select(KEY, F.when(F.col("end_ms") >= F.col("start_ms"), F.col("end_ms") - F.col("start_ms")).alias("wave_ms"))


def run_window(runs: DataFrame, info: DataFrame) -> DataFrame:
    """Runs (run_id, started_ms, finished_ms, ids) with the milliseconds of those videos whose duration is known, and how many."""
    each = runs.select("run_id", F.explode("ids").alias(KEY)).join(info.where("dur_ms > 0"), KEY, "left")
    sums = each.groupBy("run_id").agg(F.sum("dur_ms").alias("audio_ms"), F.count("dur_ms").alias("audio_n"))
    elapsed = F.when(F.col("finished_ms") >= F.col("started_ms"), F.col("finished_ms") - F.col("started_ms"))
    return runs.select("run_id", elapsed.alias("elapsed_ms")).join(sums, "run_id", "left")


def clean_stats(records: DataFrame) -> DataFrame:
    """Characters in and out and emptied rows for each chunk and the whole document (chunk null): GROUPING SETS by rollup."""
    r = records.rollup(KEY, "chunk").agg(
        F.sum(F.char_length("src")).alias("chars_in"), F.sum(F.char_length("text")).alias("chars_out"),
        F.count("*").alias("n"), F.count_if(F.trim("text") == "").alias("emptied"),
    )
    r = r.where(F.col(KEY).isNotNull()).withColumn("permille", F.expr("chars_out * 1000 div nullif(chars_in, 0)"))
    warn = F.when(F.col("permille") < F.when(F.col("chunk").isNull(), 600).otherwise(650), "short").when(
        F.col("emptied") * 100 > 25 * F.col("n"), "emptied"
    )
    return r.withColumn("warning", warn)


def placement_stats(placed: DataFrame) -> DataFrame:
    """Median fill of slots in thousandths, and silence in and between units, in samples."""
    fill = F.when(F.col("slot") > 0, F.expr("placed * 1000 div slot"))
    return _ranked(placed, fill).groupBy(KEY).agg(
        whole(_percentile(0.5)).alias("fill_median"), F.sum("slot_silence").alias("slot_silence"),
        F.sum("span_silence").alias("span_silence"), F.count("flag").alias("n_bad"), F.count("*").alias("n_units"),
    )


def unit_counters(report: DataFrame) -> DataFrame:
    """Units flagged, retried (attempts over one) and repaired (retried and now clean)."""
    retried = F.col("attempts") > 1
    return report.groupBy(KEY).agg(
        F.count("verify_flag").alias("flagged"), F.count_if(retried).alias("retried"), F.count_if(retried & F.col("verify_flag").isNull()).alias("repaired")
    )


def block_order(variants: DataFrame, repeats: int) -> DataFrame:
    """(position, variant, repeat): variants in order, mirrored in every second repeat. variants has variant and n from 0."""
    size = F.count("*").over(Window.partitionBy(F.lit(1)))
    v = variants.withColumn("size", size).withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    at = F.when(F.col("repeat") % 2 == 1, F.col("size") - 1 - F.col("n")).otherwise(F.col("n"))
    return v.select((F.col("repeat") * F.col("size") + at).cast("bigint").alias("position"), "variant", F.col("repeat").cast("bigint").alias("repeat"))


def claim_verdicts(cells: DataFrame, a: str, b: str) -> DataFrame:
    """Per video and metric: overlap where the variants' ranges meet, else confirms (a above b) or against."""
    side = lambda f, v: f(F.when(F.col("variant") == v, F.col("value")))
    r = cells.groupBy("video", "metric").agg(
        side(F.min, a).alias("a_lo"), side(F.max, a).alias("a_hi"), side(F.min, b).alias("b_lo"), side(F.max, b).alias("b_hi")
    )
    verdict = F.when(F.col("a_lo") > F.col("b_hi"), "confirms").when(F.col("a_hi") < F.col("b_lo"), "against").otherwise("overlap")
    return r.where("a_lo is not null and b_lo is not null").select("video", "metric", verdict.alias("verdict"))


def overlap_summary(rows: DataFrame) -> DataFrame:
    """Per mode (serial or parallel): runs and mean wall time; with the parallel mode's speed-up in hundredths."""
    m = rows.groupBy("mode").agg(F.count("*").alias("n"), F.sum("wall_ms").alias("ms"))
    serial = F.max(F.when(F.col("mode") == "serial", F.expr("ms div n"))).over(Window.partitionBy(F.lit(1)))
    return m.withColumn("serial", serial).select("mode", "n", F.expr("ms div n").alias("mean_ms"), F.expr("serial * 100 div nullif(ms div n, 0)").alias("speedup_centi"))


def ab_times(cells: DataFrame) -> DataFrame:
    """Least time of each variant per video."""
    return cells.groupBy("video", "variant").agg(F.min("work_ms").alias("work_ms"), F.count("*").alias("n"))


def status_counts(items: DataFrame, fail: list[str], stop: list[str]) -> DataFrame:
    """Items by status, with the class of exit: a failure outranks a stop."""
    s = items.groupBy("status").agg(F.count("*").alias("n"))
    return s.withColumn("exit", F.when(F.col("status").isin(fail), 2).when(F.col("status").isin(stop), 1).otherwise(0))


def summarize_time(items: DataFrame) -> DataFrame:
    """Milliseconds from an item's start, or the draft before it in its wave, to its draft; null where they are the wrong way round.

    items: video_id, marker_ms (the wave's start), draft_ms.
    """
    w = Window.partitionBy("marker_ms").orderBy("draft_ms", KEY)
    begun = F.greatest("marker_ms", F.coalesce(F.lag("draft_ms").over(w), F.col("marker_ms")))
    took = items.withColumn("begun", begun)
    known = F.col("marker_ms").isNotNull() & (F.col("draft_ms") >= F.col("marker_ms"))
    return took.select(KEY, F.when(known, F.col("draft_ms") - F.col("begun")).alias("took_ms"))


def detect_lang(sentences: DataFrame, high: float = 0.70, low: float = 0.05) -> DataFrame:
    """ru from a high share of Cyrillic letters, en up to a low one, null between them and without letters."""
    c, n = T.cyrillic_and_letters(F.col("text"))
    s = sentences.groupBy(KEY).agg(F.sum(c).alias("cyrillic"), F.sum(n).alias("letters"))
    lang = F.when(F.col("letters") == 0, None).when(F.col("cyrillic") >= high * F.col("letters"), "ru")
    return s.withColumn("lang", lang.when(F.col("cyrillic") <= low * F.col("letters"), "en"))


def full_rollup(parts: dict[str, DataFrame]) -> DataFrame:
    """One row for each video of any part, with a struct of each part's columns under its name, null where it has no row.

    The parts, such as run_rollup, run_timing, source_rollup, unit_counters, placement_stats, audit_counts and
    floor_run_ratio, have one row a video each. They are stacked and gathered by one aggregation instead of a chain of joins. A figure of 0
    stays apart from an unknown one.
    """
    stacked = None
    for name, part in parts.items():
        row = part.select(KEY, F.struct(*(part[c] for c in part.columns if c != KEY)).alias(name))
        stacked = row if stacked is None else stacked.unionByName(row, allowMissingColumns=True)
    return stacked.groupBy(KEY).agg(*(F.first(name, ignorenulls=True).alias(name) for name in parts))
