"""Joins that hold one timed-text table against another and report what does not fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions import text as T
from cadenza.operators.intervals import KEY, range_join


def missing_ids(sentences: DataFrame, draft: DataFrame) -> DataFrame:
    """Sentences without a draft row."""
    return sentences.select(KEY, "id").join(draft.select(KEY, "id"), [KEY, "id"], "left_anti")


def extra_ids(sentences: DataFrame, draft: DataFrame) -> DataFrame:
    """Draft rows without a sentence."""
    return draft.select(KEY, "id").join(sentences.select(KEY, "id"), [KEY, "id"], "left_anti")


def duplicate_ids(df: DataFrame) -> DataFrame:
    return df.groupBy(KEY, "id").agg(F.count("*").alias("n")).where("n > 1")


def join_chunks(chunks: DataFrame, plan: DataFrame, sentences: DataFrame) -> DataFrame:
    """A row for each fault: sentences that no chunk covers, and chunk rows outside their chunk's range.

    chunks has (video_id, chunk, id), plan (video_id, chunk, lo, hi inclusive).
    """
    placed = chunks.join(plan, [KEY, "chunk"], "left")
    outside = placed.where(F.col("lo").isNull() | (F.col("id") < F.col("lo")) | (F.col("id") > F.col("hi")))
    inside = placed.where((F.col("id") >= F.col("lo")) & (F.col("id") <= F.col("hi")))
    uncovered = sentences.select(KEY, "id").join(inside.select(KEY, "id"), [KEY, "id"], "left_anti")
    return uncovered.withColumn("fault", F.lit("uncovered")).unionByName(
        outside.select(KEY, "id").withColumn("fault", F.lit("outside"))
    )


def contiguity(df: DataFrame) -> DataFrame:
    """Per video, whether ids are 0 to n - 1, each once."""
    a = df.groupBy(KEY).agg(F.count("*").alias("n"), F.countDistinct("id").alias("d"), F.min("id").alias("lo"), F.max("id").alias("hi"))
    return a.select(KEY, "n", ((F.col("n") == F.col("d")) & (F.col("lo") == 0) & (F.col("hi") == F.col("n") - 1)).alias("ok"))


def require_contiguous(df: DataFrame) -> DataFrame:
    """df, or an error when it is read if any video's ids are not contiguous: in order, each must be its own place. df is read once."""
    place = F.row_number().over(Window.partitionBy(KEY).orderBy("id")) - 1
    ok = F.when(F.col("__place") == F.col("id"), True).otherwise(F.raise_error(F.lit("ids are not contiguous")).cast("boolean"))
    return df.withColumn("__place", place).where(ok).drop("__place")


def coverage(units: DataFrame, sentences: DataFrame) -> DataFrame:
    """Per video, whether its units' ids (array) are its sentences' ids, each once."""
    u = units.select(KEY, F.explode("ids").alias("id")).groupBy(KEY).agg(F.array_sort(F.collect_list("id")).alias("u"))
    s = sentences.groupBy(KEY).agg(F.array_sort(F.collect_list("id")).alias("s"))
    return s.join(u, KEY, "full").select(KEY, F.coalesce(F.col("u") == F.col("s"), F.lit(False)).alias("ok"))


def draft_ready(draft: DataFrame, sentences: DataFrame) -> DataFrame:
    """Per video with a draft, whether it covers all of the video's sentences, and how many are missing."""
    want = sentences.groupBy(KEY).agg(F.count("*").alias("n"))
    lack = missing_ids(sentences, draft).groupBy(KEY).agg(F.count("*").alias("n_missing"))
    have = draft.select(KEY).distinct()
    out = have.join(want, KEY, "left").join(lack, KEY, "left")
    missing = F.coalesce("n_missing", F.lit(0))
    return out.select(KEY, missing.alias("n_missing"), ((F.coalesce("n", F.lit(0)) > 0) & (missing == 0)).alias("ready"))


def already_built(inventory: DataFrame, built: str, source: str) -> DataFrame:
    """Per video, whether the built artifact is there and not older than its source."""
    at = lambda a: F.max(F.when(F.col("artifact") == a, F.col("modified_ms")))
    p = inventory.groupBy(KEY).agg(at(built).alias("b"), at(source).alias("s"))
    return p.select(KEY, F.coalesce(F.col("b") >= F.coalesce("s", F.lit(0)), F.lit(False)).alias("built"))


def validate_ids(named: DataFrame, sentences: DataFrame) -> DataFrame:
    """Videos of which all named ids exist; one bad id rejects the video."""
    n = sentences.groupBy(KEY).agg(F.count("*").alias("n"))
    j = named.join(n, KEY, "left")
    return j.groupBy(KEY).agg(F.bool_and((F.col("id") >= 0) & (F.col("id") < F.coalesce("n", F.lit(0)))).alias("ok"))


def reasons() -> Column:
    """Flags of a report row in order: translation, verification, completeness."""
    return F.concat(F.array_compact(F.array("translate_flag", "verify_flag")), F.coalesce("completeness_flags", F.array().cast("array<string>")))


def offenders(report: DataFrame, translation: DataFrame, limit: int = 40) -> DataFrame:
    """Flagged report rows with their text, the first ones by id of each video."""
    bad = report.withColumn("reasons", reasons()).where(F.size("reasons") > 0)
    w = Window.partitionBy(KEY).orderBy(F.col("id").asc_nulls_last())
    first = bad.withColumn("n", F.row_number().over(w)).where(F.col("n") <= limit)
    return first.join(translation, [KEY, "id"], "left").select(KEY, "id", F.array_join("reasons", ",").alias("reasons"), "text")


def flagged_units(report: DataFrame, translation: DataFrame, limit: int = 500) -> DataFrame:
    """Units with a flag: the leader's factor, all members' reasons as first seen, their joined texts and times."""
    j = report.withColumn("reasons", reasons()).join(translation, [KEY, "id"], "left")
    rows = F.array_sort(F.collect_list(F.struct("id", "reasons", "text")))
    u = j.groupBy(KEY, "group_id").agg(
        F.min_by("combined_milli", "id").alias("combined_milli"), F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), rows.alias("rows")
    )
    u = u.select(
        KEY, F.col("group_id").alias("lead"), "combined_milli", "start_ms", "end_ms",
        F.array_distinct(F.flatten(F.transform("rows", lambda r: r["reasons"]))).alias("r"),
        F.array_join(F.transform("rows", lambda r: r["text"]), " ").alias("text"),
    ).where(F.size("r") > 0)
    w = Window.partitionBy(KEY).orderBy(F.col("lead").asc_nulls_last())
    return u.withColumn("n", F.row_number().over(w)).where(F.col("n") <= limit).select(
        KEY, "lead", "combined_milli", "start_ms", "end_ms", F.array_join("r", ",").alias("reasons"), "text"
    )


def splice(sentences: DataFrame, windows: DataFrame, new_rows: DataFrame) -> DataFrame:
    """sentences with the ids of each window (video_id, lo, hi) replaced by its new rows (video_id, lo, k, text, …); renumbered."""
    gone = range_join(
        sentences.select(KEY, "id"), windows.select(KEY, F.col("lo").alias("a"), (F.col("hi") + 1).alias("b")), "id", "a", "b"
    ).select(KEY, "id")
    kept = sentences.join(gone, [KEY, "id"], "left_anti").select(KEY, "text", "start_ms", "end_ms", F.col("id").alias("at"), F.lit(-1).cast("bigint").alias("k"))
    put = new_rows.select(KEY, "text", "start_ms", "end_ms", F.col("lo").alias("at"), F.col("k").cast("bigint").alias("k"))
    w = Window.partitionBy(KEY).orderBy("at", "k")
    return kept.unionByName(put).withColumn("id", F.row_number().over(w).cast("bigint") - 1).select(KEY, "id", "text", "start_ms", "end_ms")


def splice_faults(windows: DataFrame, new_rows: DataFrame, sentences: DataFrame) -> DataFrame:
    """Windows that splice must not apply: overlap, out_of_range, empty or backwards."""
    n = sentences.groupBy(KEY).agg(F.count("*").alias("n"))
    w = Window.partitionBy(KEY).orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    v = Window.partitionBy(KEY, "lo").orderBy("k")
    r = new_rows.withColumn("back", F.col("start_ms") < F.lag("start_ms").over(v)).groupBy(KEY, "lo").agg(
        F.count("*").alias("rows"), F.bool_or(F.coalesce("back", F.lit(False))).alias("back")
    )
    j = windows.withColumn("reach", F.max("hi").over(w)).join(n, KEY, "left").join(r, [KEY, "lo"], "left")
    fault = (
        F.when(F.col("lo") <= F.col("reach"), "overlap")
        .when((F.col("lo") < 0) | (F.col("hi") >= F.coalesce("n", F.lit(0))), "out_of_range")
        .when(F.coalesce("rows", F.lit(0)) == 0, "empty")
        .when(F.col("back"), "backwards")
    )
    return j.select(KEY, "lo", "hi", fault.alias("fault")).where("fault is not null")


def stale_units(units: DataFrame, sentences: DataFrame) -> DataFrame:
    """Units (lead, ids, text) whose text is no longer that of their sentences, or whose sentences are not all there."""
    each = units.select(KEY, "lead", F.posexplode("ids").alias("k", "id"))
    now = each.join(sentences.select(KEY, "id", "text"), [KEY, "id"], "left").groupBy(KEY, "lead").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "text"))), lambda x: x["text"]), " ").alias("now"),
        F.count("text").alias("found"), F.count("*").alias("wanted"),
    )
    j = units.join(now, [KEY, "lead"], "left")
    return j.where(~F.col("text").eqNullSafe(F.col("now")) | (F.col("found") < F.col("wanted"))).select(KEY, "lead")


def stale_reports(stamped: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """Videos whose report was made under other keys than the manifest has; an absent key is another one."""
    j = manifest.select(KEY, *keys).join(stamped.select(KEY, *(F.col(k).alias(f"was_{k}") for k in keys)), KEY, "left")
    differs = [~F.col(k).eqNullSafe(F.col(f"was_{k}")) for k in keys]
    out = differs[0]
    for d in differs[1:]:
        out = out | d
    return j.where(out).select(KEY)


def provenance_audit(stamps: DataFrame, wanted: str) -> DataFrame:
    """mixed where the decode key's core is another one, condition where only the condition is, ok otherwise or unstamped."""
    c = F.col("asr_key")
    state = F.when(c.isNull() | (c == wanted), "ok").when(T.key_core(c) == T.key_core(F.lit(wanted)), "condition").otherwise("mixed")
    return stamps.select(KEY, state.alias("state"))


def reusable_units(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Current units with whether the previous rendering can be kept: same ids and text, and not failed."""
    old = previous.where("not failed").select(KEY, "ids", F.col("text").alias("old"))
    j = current.join(old, [KEY, "ids"], "left")
    return j.select(KEY, "lead", F.coalesce(F.col("old") == F.col("text"), F.lit(False)).alias("reuse"))


def gained_tracks(stamp: DataFrame, now: DataFrame) -> DataFrame:
    """Artifacts that are there now and are not in the stamp."""
    return now.select(KEY, "artifact").distinct().join(stamp.select(KEY, "artifact"), [KEY, "artifact"], "left_anti")


def read_queue_lines(lines: DataFrame, unmatched: str = "hash") -> DataFrame:
    """(pos, video_id) of a queue's lines, each id at its first place; comments and blanks skipped."""
    clean = F.trim(F.regexp_replace("line", "^\ufeff", ""))
    q = lines.select("pos", clean.alias("line")).where("line <> '' and line not like '#%'")
    q = q.withColumn("video_id", T.video_id(F.col("line"), unmatched)).where("video_id is not null")
    return q.groupBy("video_id").agg(F.min("pos").alias("pos"), F.count("*").alias("n"))


def collect_entries(queue: DataFrame, inventory: DataFrame) -> DataFrame:
    """Queue order kept, no row dropped; other directories follow, numbered on, with their state."""
    kinds = directory_kind(inventory)
    q = queue.select("video_id", "pos").join(kinds, "video_id", "left")
    extra = kinds.join(queue.select("video_id"), "video_id", "left_anti")
    return q.select("video_id", F.lit(True).alias("queued"), "pos", F.coalesce("kind", F.lit("missing")).alias("kind")).unionByName(
        extra.select("video_id", F.lit(False).alias("queued"), F.lit(None).cast("bigint").alias("pos"), "kind")
    )


def queue_entries(
    queue: DataFrame, inventory: DataFrame, rollup: DataFrame, scout: DataFrame, summary: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Entries of a queue view and what it skips.

    Entries (video_id, queued, place, kind, rollup, scout, summary): queue rows in their order, none dropped, then other
    directories by id, numbered on from the queue's last. The last three are the video's row there as a struct, or null.
    Other directories without sentences or a report, kinds missing and fetched, are skipped (video_id, kind). The lists have
    as many rows as a batch has videos, and one order.
    """
    both = collect_entries(queue, inventory)
    wanted = F.col("queued") | ~F.col("kind").isin("missing", "fetched")
    place = F.row_number().over(Window.orderBy(F.col("queued").desc(), "pos", "video_id"))
    out = both.where(wanted).withColumn("place", place.cast("bigint")).select("video_id", "queued", "place", "kind")
    for name, more in (("rollup", rollup), ("scout", scout), ("summary", summary)):
        row = F.struct(*(more[c] for c in more.columns if c != "video_id")).alias(name)
        out = out.join(more.select("video_id", row), "video_id", "left")
    return out, both.where(~wanted).select("video_id", "kind")


def directory_kind(inventory: DataFrame) -> DataFrame:
    """run with a report, pending with a translation or video and sentences, scout with sentences, fetched with a video only."""
    has = lambda a: F.bool_or(F.col("artifact") == a)
    h = inventory.groupBy(KEY).agg(
        has("report").alias("r"), has("translation").alias("t"), has("sentences").alias("s"), has("source_video").alias("v")
    )
    kind = (
        F.when(F.col("r"), "run").when(F.col("s") & (F.col("t") | F.col("v")), "pending").when(F.col("s"), "scout")
        .when(F.col("v"), "fetched").otherwise("missing")
    )
    return h.select(KEY, kind.alias("kind"))


def degradation(inventory: DataFrame) -> DataFrame:
    """Why a video can only be assembled without voice: no_transcript, no_translation, no_synthesis; null if it can."""
    has = lambda a: F.bool_or(F.col("artifact") == a)
    h = inventory.groupBy(KEY).agg(has("translation").alias("t"), has("sentences").alias("s"), has("report").alias("r"))
    why = F.when(~F.col("s"), "no_transcript").when(~F.col("t"), "no_translation").when(~F.col("r"), "no_synthesis")
    return h.select(KEY, why.alias("reason"))


def pair_transcripts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per video, whether both transcripts are there: compared, one_sided, no_other_side, with their word counts."""
    n = lambda d, name: d.groupBy(KEY).agg(F.count("word").alias(name))
    j = n(a, "n_a").join(n(b, "n_b"), KEY, "full")
    state = F.when(F.col("n_a").isNull() | F.col("n_b").isNull(), "no_other_side").when(
        (F.col("n_a") == 0) | (F.col("n_b") == 0), "one_sided"
    ).otherwise("compared")
    return j.select(KEY, "n_a", "n_b", state.alias("state"))


def stamp_repaired(detail: DataFrame, accepted: DataFrame) -> DataFrame:
    """Window counts add up; a decode key becomes mixed where one was stamped and windows were accepted."""
    k = accepted.groupBy(KEY).agg(F.count("*").alias("k"))
    j = detail.join(k, KEY, "left")
    return j.select(
        KEY, (F.coalesce("n_windows", F.lit(0)) + F.coalesce("k", F.lit(0))).alias("n_windows"),
        F.when(F.col("asr_key").isNotNull() & (F.coalesce("k", F.lit(0)) > 0), "mixed").otherwise(F.col("asr_key")).alias("asr_key"),
    )


def upsert_segments(base: DataFrame, patch: DataFrame, live: DataFrame) -> DataFrame:
    """base with patch's columns written over it by (video_id, id), other fields kept, rows that are not live gone.

    A column that the patch has overwrites even with null; rows only in the patch are added.
    """
    given = [c for c in patch.columns if c not in (KEY, "id")]
    p = patch.select(KEY, "id", *(F.col(c).alias(f"new_{c}") for c in given), F.lit(True).alias("given"))
    j = base.join(p, [KEY, "id"], "full")
    cols = [
        F.when(F.col("given"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) if c in given else F.col(c)
        for c in base.columns if c not in (KEY, "id")
    ]
    new = [F.col(f"new_{c}").alias(c) for c in given if c not in base.columns]
    return j.select(KEY, "id", *cols, *new).join(live.select(KEY, "id"), [KEY, "id"], "left_semi")


def queue_difference(queue: DataFrame, playlist: DataFrame) -> DataFrame:
    """Ids on one side only, each with its side."""
    return queue.select("video_id").distinct().exceptAll(playlist.select("video_id").distinct()).withColumn("side", F.lit("queue")).unionByName(
        playlist.select("video_id").distinct().exceptAll(queue.select("video_id").distinct()).withColumn("side", F.lit("playlist"))
    )


def rederive_diff(rows: DataFrame, stored: str, derived: Column) -> DataFrame:
    """Rows whose stored derived text is not what it would be now."""
    return rows.where(~F.col(stored).eqNullSafe(derived))


def build_translation(sentences: DataFrame, draft: DataFrame) -> DataFrame:
    """Sentences with their draft row: written and spoken form, status and first reason for a failure; none is dropped.

    draft has video_id, id, text_ru; a sentence without one is pending.
    """
    d = draft.select(KEY, "id", "text_ru")
    j = sentences.join(d, [KEY, "id"], "left")
    flag = T.translation_gate(F.col("text_ru"), F.col("text"))
    status = F.when(F.col("text_ru").isNull(), "pending").when(flag.isNotNull(), "failed").otherwise("ok")
    return j.select(
        KEY, "id", "start_ms", "end_ms", F.col("text").alias("src_en"), T.written_form(F.col("text_ru")).alias("text_ru"),
        T.spoken_form(F.col("text_ru")).alias("text_spoken"), status.alias("status"),
        F.when(F.col("text_ru").isNotNull(), flag).alias("flag"),
    )


def queue_view(entries: DataFrame, info: DataFrame, scout: DataFrame, summary: DataFrame) -> DataFrame:
    """Rows to show for entries (video_id, pos, kind): state, title, duration and one line, each from the first source that has it.

    A scouted video with a summary shows as summarized; titles come from the metadata, the scout document, then the id.
    """
    i = info.select(KEY, F.col("title").alias("i_title"), F.col("duration").alias("i_duration"))
    s = scout.select(KEY, F.col("title").alias("s_title"), F.col("duration_sec").alias("s_duration"), F.col("one_liner").alias("s_line"))
    m = summary.select(KEY, F.col("one_liner").alias("m_line"), F.col("highlight"))
    j = entries.join(i, KEY, "left").join(s, KEY, "left").join(m, KEY, "left")
    state = F.when((F.col("kind") == "scout") & F.coalesce("m_line", "s_line").isNotNull(), "summarized").otherwise(F.col("kind"))
    return j.select(
        KEY, "pos", state.alias("state"), F.coalesce("i_title", "s_title", F.col(KEY).cast("string")).alias("title"),
        F.when(F.col("i_duration") > 0, F.col("i_duration")).otherwise(F.col("s_duration")).alias("duration"),
        F.coalesce("m_line", "s_line").alias("one_liner"), "highlight",
    )


def validate_scout(rows: DataFrame, caps: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """Rows whose required prose fields all hold text, cut to their caps with the cut ones listed in warnings; and the rejects."""
    empty = F.array_compact(F.array(*(F.when(F.trim(F.coalesce(c, F.lit(""))) == "", c) for c in caps)))
    over = F.array_compact(F.array(*(F.when(F.char_length(c) > n, c) for c, n in caps.items())))
    r = rows.withColumn("missing", empty).withColumn("warnings", over)
    good = r.where(F.size("missing") == 0).drop("missing").withColumns({c: F.rtrim(F.substring(c, 1, n)) for c, n in caps.items()})
    return good, r.where(F.size("missing") > 0).select(KEY, "missing")
