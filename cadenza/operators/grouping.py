"""Bounded ordered folds: units, chunks, paragraphs and widened windows.

A fold's state resets where the rows cannot belong together (a long pause, an empty text), so windows first number those
islands and each island is a group of its own. Chunk plans and widened windows have no such break: chunks walk along
pointers in blocks, and windows look at as many sentences around their seeds as they need.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.operators.intervals import KEY, islands
from cadenza.sources.scratch import cut


def fold(df: DataFrame, keys: list[str], order: str, step: Callable[[list], Iterable[tuple]], columns: str) -> DataFrame:
    """Rows of each group in order through step, whose tuples follow the group's key columns.

    Groups are many and small, so a task reads its sorted partition once and parts it where the key changes, which costs
    nothing for each group; only one group is held at a time.
    """
    names = [*keys, *(c.split()[0] for c in columns.split(", "))]
    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, out = None, [], []
        for rows in batches:
            at = [rows.columns.get_loc(k) for k in keys]
            for r in rows.itertuples(index=False):
                now = tuple(r[i] for i in at)
                if now != key and held:
                    out += [(*key, *t) for t in step(held)]
                    held = []
                key = now
                held.append(r)
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=names)
                out = []
        if held:
            out += [(*key, *t) for t in step(held)]
        yield pd.DataFrame(out, columns=names)

    return df.repartition(*keys).sortWithinPartitions(*keys, order).mapInPandas(run, f"{kinds}, {columns}")


def build_units(sentences: DataFrame, gap: int = 1200, span: int = 20_000, chars: int = 600) -> DataFrame:
    """(video_id, lead, ids, gaps, start_ms, end_ms, text): sentences joined while pause, span and characters allow.

    An empty text stands alone; a gap of 0 joins nothing.
    """
    w = Window.partitionBy(KEY).orderBy("id")
    pause = F.col("start_ms") - F.lag("end_ms").over(w)
    alone = (F.trim("text") == "") | (F.lag(F.trim("text")).over(w) == "")
    fresh = F.lit(gap <= 0) | F.coalesce((pause > gap) | alone, F.lit(True))
    marked = islands(sentences.withColumn("fresh", fresh), F.col("fresh"), ["id"])

    def step(rows: list) -> Iterable[tuple]:
        held: list = []
        for r in rows:
            long = held and (r.end_ms - held[0].start_ms > span or sum(len(x.text) + 1 for x in held) + len(r.text) > chars)
            if long:
                yield emit(held)
                held = []
            held.append(r)
        if held:
            yield emit(held)

    def emit(held: list) -> tuple:
        gaps = [b.start_ms - a.end_ms for a, b in zip(held, held[1:], strict=False)]
        return held[0].id, [x.id for x in held], gaps, held[0].start_ms, held[-1].end_ms, " ".join(x.text for x in held)

    out = "lead bigint, ids array<bigint>, gaps array<bigint>, start_ms bigint, end_ms bigint, text string"
    return fold(marked, [KEY, "island"], "id", step, out).drop("island")


def chain_starts(steps: DataFrame, block: int = 4096) -> DataFrame:
    """(video_id, pos): the places of steps (video_id, pos, next) that a walk from 0 along next touches; next is beyond pos.

    A task walks within blocks of places only. Where a video has more than one, each place's way out of its block is found
    first; ways out meet soon, so there are few, and those that the walk takes are found by doubling: reached places
    grow by jumps, and jumps by themselves, in as many rounds as the number of blocks has bits.
    """
    s = steps.select(KEY, "pos", "next", F.floor(F.col("pos") / block).alias("block"))

    def leave(rows: list) -> Iterable[tuple]:
        out: dict[int, int] = {}
        for r in reversed(rows):
            out[r.pos] = out.get(r.next, r.next)
        yield from out.items()

    long = s.where("block > 0").select(KEY).distinct()
    exits = cut(fold(s.join(long, KEY, "left_semi"), [KEY, "block"], "pos", leave, "pos bigint, exit bigint").drop("block"))
    zero = F.lit(0).cast("bigint").alias("pos")
    taken = exits.select(KEY, F.col("exit").alias("pos")).unionByName(exits.select(KEY, zero)).distinct()
    jumps = cut(exits.join(taken, [KEY, "pos"]))
    reached = s.select(KEY, zero).distinct()
    while not jumps.isEmpty():
        reached = cut(reached.unionByName(reached.join(jumps, [KEY, "pos"]).select(KEY, F.col("exit").alias("pos"))).distinct())
        further = jumps.select(KEY, F.col("pos").alias("exit"), F.col("exit").alias("after"))
        jumps = cut(jumps.join(further, [KEY, "exit"]).select(KEY, "pos", F.col("after").alias("exit")))

    def walk(rows: list) -> Iterable[tuple]:
        at = None
        for r in rows:
            if r.entered or r.pos == at:
                yield (r.pos,)
                at = r.next

    entered = reached.withColumn("entered", F.lit(True))
    marked = s.join(entered, [KEY, "pos"], "left").fillna(False, ["entered"])
    return fold(marked, [KEY, "block"], "pos", walk, "pos bigint").drop("block")


def plan_chunks(sentences: DataFrame, target: int = 80, slide: float = 0.15, tail: float = 0.5) -> DataFrame:
    """(video_id, chunk, lo, hi): inclusive id ranges of about target sentences that cover every id once.

    A cut slides to the widest pause nearby, the first of equal ones; a short rest goes with the last chunk. Where a chunk
    that begins at some sentence would end is a matter of windows; the chunks are the walk along these ends from the first.
    """
    target, reach = max(target, 1), int(target * slide)
    w = Window.partitionBy(KEY).orderBy("id")
    s = sentences.select(KEY, "id", "start_ms", "end_ms").select(
        KEY, "id", (F.row_number().over(w) - 1).cast("bigint").alias("pos"), F.count("*").over(Window.partitionBy(KEY)).alias("n"),
        F.greatest(F.coalesce(F.lead("start_ms").over(w), F.lit(0)) - F.coalesce("end_ms", F.lit(0)), F.lit(0)).alias("pause"),
    )
    w = Window.partitionBy(KEY).orderBy("pos")
    cuts = F.when(F.col("pos") < F.col("n") - 1, F.struct("pause", (-F.col("pos")).alias("back")))
    widest = F.max(cuts).over(w.rowsBetween(-min(reach, target - 1), reach))
    s = s.withColumn("best", -widest["back"] if reach else F.col("pos"))
    stop = F.when(F.col("pos") + target >= F.col("n"), F.col("n") - 1).otherwise(F.lead("best", target - 1).over(w))
    s = s.withColumn("stop", stop)
    stop = F.when(F.col("n") - 1 - F.col("stop") < target * tail, F.col("n") - 1).otherwise(F.col("stop"))
    s = s.withColumn("next", stop + 1)
    starts = chain_starts(s).withColumn("starts", F.lit(True))
    ends = s.select(KEY, F.col("next").alias("pos"), F.col("id").alias("lo"), F.col("pos").alias("from"))
    lows = ends.join(starts.select(KEY, F.col("pos").alias("from")), [KEY, "from"])
    last = s.select(KEY, (F.col("pos") + 1).alias("pos"), F.col("id").alias("hi"))
    chunk = F.row_number().over(Window.partitionBy(KEY).orderBy("from")).cast("bigint") - 1
    return lows.join(last, [KEY, "pos"]).select(KEY, chunk.alias("chunk"), "lo", "hi")


def paragraphs(records: DataFrame, pause: int = 1000, most: int = 900) -> DataFrame:
    """(video_id, start_ms, text): texts joined until a pause or most characters; empty texts are left out."""
    r = records.where(F.trim("text") != "")
    w = Window.partitionBy(KEY).orderBy("id")
    gap = F.col("start_ms") - F.lag("end_ms").over(w)
    marked = islands(r.withColumn("gap", gap), F.coalesce(F.col("gap") >= pause, F.lit(False)), ["id"])

    def step(rows: list) -> Iterable[tuple]:
        held: list = []
        for x in rows:
            if held and sum(len(h.text) + 1 for h in held) >= most:
                yield held[0].start_ms, " ".join(h.text for h in held)
                held = []
            held.append(x)
        if held:
            yield held[0].start_ms, " ".join(h.text for h in held)

    return fold(marked, [KEY, "island"], "id", step, "start_ms bigint, text string").drop("island")


def id_runs(df: DataFrame) -> DataFrame:
    """(video_id, lo, hi) of consecutive ids."""
    w = Window.partitionBy(KEY).orderBy("id")
    ids = df.select(KEY, "id").distinct().withColumn("run", F.col("id") - F.row_number().over(w))
    return ids.groupBy(KEY, "run").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).drop("run")


def units_of(manifest: DataFrame) -> DataFrame:
    """Units of a manifest; one of the old kind lists segments, each a unit of its own."""
    single = F.transform("segments", lambda s: F.struct(s["id"].alias("lead"), F.array(s["id"]).alias("ids")))
    return manifest.select(KEY, F.explode(F.coalesce("units", single)).alias("u")).select(KEY, "u.lead", "u.ids")


def widen(seeds: DataFrame, sentences: DataFrame, least: int = 20_000, reach: int = 8) -> DataFrame:
    """(video_id, seed, lo, hi): each seed's window grown by whole sentences, left first and by turns, to least milliseconds.

    After k steps a window has taken k sentences, half of them on each side as far as there are any. A round looks at the
    reach sentences around each seed; seeds whose windows need more go on to a round with four times as many.
    """
    w = Window.partitionBy(KEY).orderBy("id")
    s = sentences.join(seeds.select(KEY).distinct(), KEY, "left_semi").select(
        KEY, "id", "start_ms", "end_ms", (F.row_number().over(w) - 1).cast("bigint").alias("pos"), F.count("*").over(Window.partitionBy(KEY)).alias("n")
    )
    s = cut(s)
    todo = s.join(seeds.select(KEY, "id").distinct(), [KEY, "id"]).select(KEY, F.col("id").alias("seed"), F.col("pos").alias("at"), "n")
    done = None
    while True:
        near = F.sequence(F.greatest(F.col("at") - reach, F.lit(0)), F.least(F.col("at") + reach, F.col("n") - 1))
        rows = todo.select("*", F.explode(near).alias("pos")).join(s.drop("n"), [KEY, "pos"])
        around = F.array_sort(F.collect_list(F.struct("pos", "id", "start_ms", "end_ms"))).alias("around")
        seen = rows.groupBy(KEY, "seed", "at", "n").agg(around)
        left, right = F.col("at"), F.col("n") - 1 - F.col("at")

        def window(k):
            back = F.least(left, F.greatest(F.ceil(k / 2), k - right))
            first = F.col("at") - F.get("around", F.lit(0))["pos"]  # the seed's own place in around
            at = lambda i: F.get("around", i.cast("int"))
            return at(first - back), at(first + k - back)

        def enough(k):
            lo, hi = window(k)
            return (hi["end_ms"] - lo["start_ms"] >= least) | (k == F.col("n") - 1)

        first_k = F.get(F.filter(F.sequence(F.lit(0).cast("bigint"), F.least(F.lit(reach), F.col("n") - 1)), enough), F.lit(0))
        seen = cut(seen.withColumn("k", first_k))
        lo, hi = window(F.col("k"))
        found = seen.where("k is not null").select(KEY, "seed", lo["id"].alias("lo"), hi["id"].alias("hi"))
        done = found if done is None else done.unionByName(found)
        todo = seen.where("k is null").select(KEY, "seed", "at", "n")
        if todo.isEmpty():
            return done
        reach *= 4


def split_cues(cues: DataFrame, max_ms: int = 6000, max_chars: int = 84, least: int = 1200) -> DataFrame:
    """Cues over either cap cut at the clause mark nearest their middle, again and again; time goes by characters."""
    import re

    def halves(a: int, b: int, text: str) -> list[tuple[int, int, str]]:
        todo, done = [(a, b, text)], []
        while todo:
            a, b, text = todo.pop()
            cuts = [m.end() for m in re.finditer(r"[,;:—.!?…]\s+", text)] if b - a > max_ms or len(text) > max_chars else []
            for k in sorted(cuts, key=lambda k: abs(k - len(text) / 2)):
                middle = a + round((b - a) * k / len(text))
                if min(middle - a, b - middle) >= least and text[k:].strip():
                    todo += [(middle, b, text[k:].strip()), (a, middle, text[:k].strip())]
                    break
            else:
                done.append((a, b, text))
        return done

    def run(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for rows in batches:
            out = [
                (r.video_id, r.id, k, a, b, t)
                for r in rows.itertuples(index=False)
                for k, (a, b, t) in enumerate(halves(r.start_ms, r.end_ms, r.text))
            ]
            yield pd.DataFrame(out, columns=[KEY, "id", "part", "start_ms", "end_ms", "text"])

    long = (F.col("end_ms") - F.col("start_ms") > max_ms) | (F.char_length("text") > max_chars)
    c = cues.select(KEY, "id", "start_ms", "end_ms", "text")
    kind = c.schema[KEY].dataType.simpleString()
    cut = c.where(long).mapInPandas(run, f"{KEY} {kind}, id bigint, part bigint, start_ms bigint, end_ms bigint, text string")
    whole = c.where(~long).select(KEY, "id", F.lit(0).cast("bigint").alias("part"), "start_ms", "end_ms", "text")
    return whole.unionByName(cut)
