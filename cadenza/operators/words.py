"""Transforms of a video's ordered words: (video_id, seq, word, start_ms, end_ms, seg_end)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions import text as T
from cadenza.operators.intervals import KEY, islands

FLOOR_MS = 20
def in_order():
    return Window.partitionBy(KEY).orderBy("seq")



def _before(w, n: int = -1):
    return w.rowsBetween(Window.unboundedPreceding, n)


def explode_segments(segments: DataFrame) -> DataFrame:
    """Words of segments (video_id, seg_no, text, start_ms, end_ms, words); a segment without words is one word.

    Blank words go; seg_end marks the word at a segment's last place, if it is not blank.
    """
    whole = F.array(F.struct(F.col("text").alias("word"), F.col("start_ms").alias("start_ms"), F.col("end_ms").alias("end_ms")))
    listed = segments.withColumn("w", F.when(F.size("words") > 0, F.col("words")).otherwise(whole))
    each = listed.select(KEY, "seg_no", F.size("w").alias("n"), F.posexplode("w").alias("i", "x"))
    rows = each.select(
        KEY, "seg_no", "i", F.trim("x.word").alias("word"), "x.start_ms", "x.end_ms", (F.col("i") == F.col("n") - 1).alias("seg_end")
    ).where(F.coalesce(F.col("word"), F.lit("")) != "")
    seq = F.row_number().over(Window.partitionBy(KEY).orderBy("seg_no", "i")).cast("bigint") - 1
    return rows.withColumn("seq", seq).select(KEY, "seq", "word", "start_ms", "end_ms", "seg_end")


def clamp_monotone(words: DataFrame) -> DataFrame:
    """No word starts before the last one ended or is shorter than the floor.

    The recurrence end = max(end, start + floor, end before + floor) is a running maximum once a floor per word is taken off.
    """
    i = F.row_number().over(in_order()) - 1
    w = words.withColumn("i", i).withColumn(
        "lifted", F.greatest(F.coalesce("end_ms", F.lit(0)), F.coalesce("start_ms", F.lit(0)) + FLOOR_MS, F.lit(FLOOR_MS)) - FLOOR_MS * F.col("i")
    )
    w = w.withColumn("e", F.max("lifted").over(_before(in_order(), 0)) + FLOOR_MS * F.col("i"))
    w = w.withColumn("s", F.greatest(F.coalesce("start_ms", F.lit(0)), F.coalesce(F.lag("e").over(in_order()), F.lit(0))))
    return w.select(KEY, "seq", "word", F.col("s").cast("bigint").alias("start_ms"), F.col("e").cast("bigint").alias("end_ms"), "seg_end")


def collapse_runs(words: DataFrame, most: int = 4) -> DataFrame:
    """Runs of one word repeated as a single row over their whole time.

    Runs of most or more collapse; shorter ones only if a word is shorter than the floor or all are written alike and end a
    sentence.
    """
    w = words.withColumn("norm", T.norm_text(F.col("word")))
    same = (F.col("norm") == F.lag("norm").over(in_order())) & (F.col("norm") != "")
    w = islands(w, ~F.coalesce(same, F.lit(False)), ["seq"], "run")
    run = Window.partitionBy(KEY, "run")
    whole = run.orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    alike = (F.min("word").over(run) == F.max("word").over(run)) & F.regexp_like(T.core(F.col("word")), F.lit("[.!?…]$"))
    w = w.withColumn("n", F.count("*").over(run)).withColumn("short", F.min(F.col("end_ms") - F.col("start_ms")).over(run) < FLOOR_MS)
    w = w.withColumn("gone", (F.col("n") >= most) | ((F.col("n") >= 2) & (F.col("short") | alike)))
    w = w.withColumn("first", F.row_number().over(run.orderBy("seq")) == 1)
    last_end = F.max("end_ms").over(run)
    seg = F.last("seg_end").over(whole)
    w = w.withColumn("last_end", last_end).withColumn("last_seg", seg).where(~F.col("gone") | F.col("first"))
    return w.select(
        KEY, "seq", "word", "start_ms",
        F.when(F.col("gone"), F.col("last_end")).otherwise(F.col("end_ms")).alias("end_ms"),
        F.when(F.col("gone"), F.col("last_seg")).otherwise(F.col("seg_end")).alias("seg_end"),
    )


def floor_run_ratio(words: DataFrame) -> DataFrame:
    """(video_id, n_words, n_floor, longest): words at the floor that start where the last one ended, and their longest run."""
    chained = (F.col("end_ms") - F.col("start_ms") == FLOOR_MS) & (F.col("start_ms") == F.lag("end_ms").over(in_order()))
    w = islands(words.withColumn("hit", F.coalesce(chained, F.lit(False))), ~F.col("hit"), ["seq"], "run")
    runs = w.groupBy(KEY, "run").agg(F.count("*").alias("n"), F.count_if("hit").alias("hits"))
    return runs.groupBy(KEY).agg(F.sum("n").alias("n_words"), F.sum("hits").alias("n_floor"), F.max("hits").alias("longest"))


def choose_decode(score_a: DataFrame, score_b: DataFrame, limit: float = 0.085) -> DataFrame:
    """Whether to take the alternate decode: the first one's floor share is over the limit and the second's at most half of it."""
    share = lambda d, name: d.select(KEY, (F.col("n_floor") / F.col("n_words")).alias(name))
    j = share(score_a, "a").join(share(score_b, "b"), KEY, "left")
    take = (F.col("a") > limit) & (F.col("b") <= F.col("a") / 2)
    return j.select(KEY, (F.col("a") > limit).alias("candidate"), F.coalesce(take, F.lit(False)).alias("take_b"))


def sentence_ends(words: DataFrame) -> DataFrame:
    """words with ends: whether a sentence ends there."""
    return words.withColumn("ends", T.is_sentence_end(F.col("word"), F.lead("word").over(in_order()), F.col("seg_end")))


def assign_sentences(words: DataFrame) -> DataFrame:
    """words with sentence, counted from 0; an unfinished one at the end is kept."""
    w = sentence_ends(words)
    count = F.sum(F.when(F.col("ends"), 1).otherwise(0)).over(_before(in_order()))
    return w.withColumn("sentence", F.coalesce(count, F.lit(0)))


def sentence_table(words: DataFrame) -> DataFrame:
    """(video_id, id, text, start_ms, end_ms) of assigned sentences."""
    ordered = F.array_sort(F.collect_list(F.struct("seq", "word")))
    return assign_sentences(words).groupBy(KEY, F.col("sentence").alias("id")).agg(
        F.array_join(F.transform(ordered, lambda x: x["word"]), " ").alias("text"),
        F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"),
    )


def overlong(words: DataFrame, max_ms: int = 15_000, max_chars: int = 240) -> DataFrame:
    """Sentences (video_id, sentence) that are over either limit."""
    per = assign_sentences(words).groupBy(KEY, "sentence").agg(
        (F.max("end_ms") - F.min("start_ms")).alias("ms"), F.sum(F.char_length("word") + 1).alias("chars")
    )
    return per.where((F.col("ms") > max_ms) | (F.col("chars") > max_chars))


#: A stretch of words as text: place of its first word, times, characters with a blank behind each word, text.
Stretch = tuple[int, int, int, int, str]


def _long(start_ms: int, end_ms: int, chars: int, max_ms: int = 15_000, max_chars: int = 240) -> bool:
    return end_ms - start_ms > max_ms or chars > max_chars


def _pieces(w: list) -> Iterable[Stretch]:
    """Stretches into which an overlong sentence's words are cut: at a real pause, else a clause, else anywhere, nearest its
    middle; no piece of up to three words is cut."""
    upto = [0, *accumulate(len(x["word"]) + 1 for x in w)]
    todo = [(0, len(w) - 1)]
    while todo:
        lo, hi = todo.pop()
        start, end, chars = w[lo]["start_ms"], w[hi]["end_ms"], upto[hi + 1] - upto[lo]
        if hi - lo < 3 or not _long(start, end, chars):
            yield w[lo]["seq"], start, end, chars, " ".join(x["word"] for x in w[lo : hi + 1])
            continue
        middle = (start + end) / 2
        best = []
        for k in range(lo, hi):
            pause = w[k]["seg_end"] and w[k + 1]["start_ms"] - w[k]["end_ms"] >= 200
            rank = 2 if not w[k]["may_cut"] else 0 if pause else 1 if w[k]["clause"] else 2
            best.append((rank, not w[k]["may_cut"], abs(w[k]["end_ms"] - middle), k))
        cut = min(best)[3]
        todo += [(cut + 1, hi), (lo, cut)]


def _merged(pieces: list[Stretch], least: int = 15, gap: int = 600, total: int = 1500) -> list[Stretch]:
    """Pieces under least characters joined with the nearer neighbour, within the limits on pauses and length."""
    at = [[*p, 0] for p in pieces]  # the last field is the pause taken in
    i = 0
    while i < len(at):
        options = []
        for side, j in ((0, i - 1), (1, i)) if at[i][3] - 1 < least else ():
            if 0 <= j and j + 1 < len(at):
                left, right = at[j], at[j + 1]
                pause = right[1] - left[2]
                if pause <= gap and left[5] + pause + right[5] <= total and not _long(left[1], right[2], left[3] + right[3]):
                    options.append((pause, side, j))
        if not options:
            i += 1
            continue
        pause, _, j = min(options)
        (seq, start, _, n, text, own), (_, _, end, m, more, its) = at[j : j + 2]
        at[j : j + 2] = [[seq, start, end, n + m, f"{text} {more}", own + pause + its]]
        i = j
    return [tuple(x[:5]) for x in at]


def resegment(words: DataFrame) -> DataFrame:
    """(video_id, id, text, start_ms, end_ms): sentences, overlong ones cut and very short ones merged; ids from 0.

    Sentences further apart than any merge may reach are independent, so the fold runs over the sentences of islands between
    long pauses, held one at a time; only overlong sentences bring their words along.
    """
    w = assign_sentences(words)
    s = w.groupBy(KEY, "sentence").agg(
        F.min_by("start_ms", "seq").alias("start_ms"), F.max_by("end_ms", "seq").alias("end_ms"),
        F.sum(F.char_length("word") + 1).alias("chars"), F.array_sort(F.collect_list(F.struct("seq", "word", "start_ms", "end_ms", "seg_end"))).alias("words"),
    )
    long = (F.col("end_ms") - F.col("start_ms") > 15_000) | (F.col("chars") > 240)
    text = F.array_join(F.transform("words", lambda x: x["word"]), " ")

    def judged(x: Column, i: Column) -> Column:
        """A word of an overlong sentence with where it may be cut; after the last one no cut is looked for."""
        following = F.get("words", i + 1)["word"]
        clause = F.regexp_like(T.core(x["word"]), F.lit("[,;:]$")) | F.coalesce(T.bare(following).isin(T.CLAUSE_OPENERS), F.lit(False))
        return x.withField("may_cut", T.may_cut_after(x["word"], following)).withField("clause", clause)

    s = s.select(
        KEY, "sentence", F.col("words")[0]["seq"].alias("seq"), "start_ms", "end_ms", "chars", F.when(~long, text).alias("text"),
        F.when(long, F.transform("words", judged)).alias("words"),
        F.coalesce(F.col("start_ms") - F.lag("end_ms").over(Window.partitionBy(KEY).orderBy("sentence")), F.lit(0)).alias("pause"),
    )
    s = islands(s, F.col("pause") > 600, ["sentence"])
    kind = s.schema[KEY].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Islands in order; a video's come one after another, so its ids are counted along."""
        key, island, n, held, out = None, None, 0, [], []

        def told() -> Iterable[tuple]:
            for k, (_, start, end, _, text) in enumerate(_merged(held), n):
                yield key, k, text, start, end

        for rows in batches:
            for video, seq, start, end, chars, text, words, now in rows.itertuples(index=False, name=None):
                if (video, now) != (key, island):
                    out += told()
                    n = out[-1][1] + 1 if held and video == key else 0 if video != key else n
                    key, island, held = video, now, []
                if words is None:
                    held.append((seq, start, end, chars, text))
                else:
                    held += _pieces(list(words))
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=names)
                out = []
        out += told()
        yield pd.DataFrame(out, columns=names)

    names = [KEY, "id", "text", "start_ms", "end_ms"]
    # The windows by video have brought each video's sentences to one task, where they stay.
    placed = s.sortWithinPartitions(KEY, "sentence").select(KEY, "seq", "start_ms", "end_ms", "chars", "text", "words", "island")
    return placed.mapInPandas(run, f"{KEY} {kind}, id bigint, text string, start_ms bigint, end_ms bigint")


def decode_windows(durations: DataFrame, whole: int = 900_000, size: int = 600_000, overlap: int = 15_000) -> DataFrame:
    """(video_id, win_no, w_start, w_end): one window for a short video, else windows that overlap, the last one clamped."""
    stride = size - overlap
    n = F.when(F.col("dur_ms") <= whole, 1).otherwise(F.ceil((F.col("dur_ms") - overlap) / stride)).cast("int")
    each = durations.select(KEY, "dur_ms", F.explode(F.sequence(F.lit(0), n - 1)).alias("win_no"))
    short = F.col("dur_ms") <= whole
    return each.select(
        KEY, F.col("win_no").cast("bigint").alias("win_no"), F.when(short, 0).otherwise(F.col("win_no") * F.lit(stride).cast("bigint")).alias("w_start"),
        F.when(short, F.col("dur_ms")).otherwise(F.least(F.col("win_no") * F.lit(stride).cast("bigint") + size, "dur_ms")).alias("w_end"),
    )


def stitch_windows(window_words: DataFrame) -> DataFrame:
    """Words of overlapping windows (win_no, w_start, w_end, …) once each: cut at the middle of every real overlap.

    A window is one row for all its words, so a task holds those of its share of windows and sorts no words.
    """
    wins = window_words.select(KEY, "win_no", "w_start", "w_end").distinct()
    w = Window.partitionBy(KEY).orderBy("win_no")
    last, following = F.lag("w_end").over(w), F.lead("w_start").over(w)
    edges = wins.select(
        KEY, "win_no",
        F.when(last > F.col("w_start"), (last + F.col("w_start")) / 2).otherwise(F.col("w_start")).alias("lo"),
        F.when(following < F.col("w_end"), (following + F.col("w_end")) / 2).otherwise(F.lit(1e15)).alias("hi"),
    )
    return window_words.join(edges.hint("shuffle_hash"), [KEY, "win_no"]).where("start_ms >= lo and start_ms < hi").drop("lo", "hi")


def core_windows(durations: DataFrame, chunk: int, margin: int) -> DataFrame:
    """Cores that tile a duration once, each with a margin on either side within it."""
    n = F.greatest(F.ceil(F.col("dur_ms") / chunk), F.lit(1)).cast("int")
    each = durations.select(KEY, "dur_ms", F.explode(F.sequence(F.lit(0), n - 1)).alias("i"))
    a, b = F.col("i") * F.lit(chunk).cast("bigint"), F.least((F.col("i") + 1) * F.lit(chunk).cast("bigint"), "dur_ms")
    return each.select(
        KEY, F.col("i").cast("bigint").alias("i"), a.alias("core_from"), b.alias("core_to"),
        F.greatest(a - margin, F.lit(0)).alias("from_ms"), F.least(b + margin, "dur_ms").alias("to_ms"),
    )


def claim_metrics(words: DataFrame, sentences: DataFrame) -> DataFrame:
    """Per video: floor stamps, equal adjacent sentences, sentence ends and the longest stretch without one.

    A token of nothing but quotes counts as an end.
    """
    term = F.regexp_like(T.core(F.col("word")), F.lit("(^|[.!?…])$"))
    w = words.withColumn("term", term)
    start = F.first("start_ms").over(_before(in_order(), 0))
    last = F.last(F.when(F.col("term"), F.col("end_ms")), ignorenulls=True).over(_before(in_order()))
    w = w.withColumn("gap", F.col("end_ms") - F.coalesce(last, start))
    a = w.groupBy(KEY).agg(
        F.count("*").alias("n_words"), F.count_if(F.col("end_ms") - F.col("start_ms") == FLOOR_MS).alias("n_floor"),
        F.count_if("term").alias("n_term"), F.greatest(F.max("gap"), F.lit(0)).alias("longest_gap_ms"),
    )
    s = sentences.withColumn("norm", T.norm_text(F.col("text")))
    s = s.withColumn("dup", F.col("norm") == F.lead("norm").over(Window.partitionBy(KEY).orderBy("id")))
    dur = F.col("end_ms") - F.col("start_ms")
    b = s.groupBy(KEY).agg(
        F.count_if("dup").alias("dup_pairs"), F.max(F.when(dur > 0, F.floor(F.char_length("text").cast("bigint") * 10000 / dur))).cast("bigint").alias("max_deci_cps")
    )
    return a.join(b, KEY, "left")


def structure_metrics(words: DataFrame) -> DataFrame:
    """Per video: words, ends, longest pause, time in words and from first to last."""
    term = F.regexp_like(F.regexp_replace(F.trim("word"), r"""["'”’»)\]}]+$""", ""), F.lit("[.!?…]$"))
    w = words.withColumn("pause", F.lead("start_ms").over(in_order()) - F.col("end_ms"))
    return w.groupBy(KEY).agg(
        F.count("*").alias("n_words"), F.count_if(term).alias("n_term"), F.coalesce(F.max("pause"), F.lit(0)).alias("gap_max_ms"),
        F.sum(F.col("end_ms") - F.col("start_ms")).alias("speech_ms"),
        (F.max_by("end_ms", "seq") - F.min_by("start_ms", "seq")).alias("span_ms"),
        F.percentile(F.char_length("word"), 0.5).alias("word_chars_median"),
    )


def nonlatin_share(words: DataFrame) -> DataFrame:
    """Letters and those of them beyond ASCII per video."""
    return words.groupBy(KEY).agg(
        F.sum(F.regexp_count("word", F.lit(r"\p{L}"))).alias("letters"),
        F.sum(F.regexp_count("word", F.lit(r"[\p{L}&&[^\x00-\x7F]]"))).alias("beyond_ascii"),
    )
