"""Word alignment of two transcripts of a video, cut at anchors.

An anchor is a word whose run of GRAM words stands once in either transcript. Anchors that cross no other part a video for
sure; of those that cross, each stretch between two sure ones keeps a longest rising run. Anchored words are equal; the words
between two anchors are a gap, aligned by the recursive longest-block method, many gaps at once. So no task needs a whole
video, and where no run is unique, as in short or monotonous transcripts, the gap is the video and the result is that method's.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cadenza.functions import text as T
from cadenza.operators.grouping import fold
from cadenza.operators.intervals import KEY
from cadenza.operators.matching import matching_blocks, opcodes
from cadenza.sources.scratch import cut

GRAM = 3


def numbered(words: DataFrame, blank: bool = True, dense: bool = True) -> DataFrame:
    """words with norm, their compared form, and pos, counted from 0 in each video; without blank, empty norms go first.

    Where only the order matters, pos need not be dense and is seq.
    """
    w = words.withColumn("norm", F.coalesce(T.norm_text(F.col("word")), F.lit("")))
    if not blank:
        w = w.where("norm <> ''")
    count = F.row_number().over(Window.partitionBy(KEY).orderBy("seq")).cast("bigint") - 1
    return w.withColumn("pos", count if dense else F.col("seq"))


def _rising(rows: list) -> Iterable[tuple[int, int]]:
    """A longest run of (pa, pb), sorted by pa, that rises in pb."""
    tails: list[int] = []
    places: list[int] = []
    before: list[int | None] = []
    for i, r in enumerate(rows):
        at = bisect_left(tails, r.pb)
        tails[at : at + 1] = [r.pb]
        places[at : at + 1] = [i]
        before.append(places[at - 1] if at else None)
    at = places[-1] if places else None
    while at is not None:
        yield rows[at].pa, rows[at].pb
        at = before[at]


def _marked(a: DataFrame, b: DataFrame, gram: int) -> DataFrame:
    """(video_id, pa, pb, sure, part): words of numbered a and b that begin a run found once in each; sure ones cross no other.

    Runs are compared by 64 bits, and their first words by 64 more.
    """

    def runs(d: DataFrame, side: int) -> DataFrame:
        w = Window.partitionBy(KEY).orderBy("seq")
        run = [F.lead("norm", k).over(w) if k else F.col("norm") for k in range(gram)]
        g = d.select(KEY, "pos", F.xxhash64("norm").alias("first"), F.xxhash64(*run).alias("gram"), run[-1].isNotNull().alias("whole"))
        return g.where("whole").select(KEY, "gram", "first", "pos", F.lit(side).alias("side"))

    def of(side: int, what: str) -> Column:
        return F.when(F.col("side") == side, F.col(what))

    both = runs(a, 0).unionByName(runs(b, 1)).groupBy(KEY, "gram").agg(
        F.count(of(0, "pos")).alias("n"), F.count(of(1, "pos")).alias("m"), F.min(of(0, "pos")).alias("pa"), F.min(of(1, "pos")).alias("pb"),
        (F.min("first") == F.max("first")).alias("alike"),
    )
    met = both.where("n = 1 and m = 1 and alike").select(KEY, "pa", "pb")
    w = Window.partitionBy(KEY).orderBy("pa")
    before = lambda order: Window.partitionBy(KEY).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    above, below = F.max("pb").over(before("pa")), F.min("pb").over(before(F.col("pa").desc()))
    sure = F.coalesce(F.col("pb") > above, F.lit(True)) & F.coalesce(F.col("pb") < below, F.lit(True))
    return met.withColumn("sure", sure).withColumn("part", F.count_if("sure").over(w.rowsBetween(Window.unboundedPreceding, 0)))


def _thinned(marked: DataFrame) -> DataFrame:
    """(video_id, pa, pb) of those that are not sure: of each part a longest rising run."""
    return fold(marked.where("not sure").select(KEY, "part", "pa", "pb"), [KEY, "part"], "pa", _rising, "pa bigint, pb bigint").select(KEY, "pa", "pb")


def anchors(a: DataFrame, b: DataFrame, gram: int = GRAM, *, joined: bool = False, tasks: int | None = None) -> DataFrame:
    """(video_id, pa, pb), rising in both: words of numbered a and b that begin a run found once in each; joined: their stretches."""
    marked = _marked(a, b, gram)
    if joined:
        return _stretched(marked, tasks)
    return marked.where("sure").select(KEY, "pa", "pb").unionByName(_thinned(marked))


def _following(c: str, ends: str, w: Window) -> Column:
    """Whether a stretch begins where the one before it ended."""
    return F.col(c) - F.lag(ends).over(w) == 1


def _dealt(rows: DataFrame, tasks: int | None) -> DataFrame:
    """rows dealt by video to so many tasks, or as many as shuffles have; Spark leaves them in place if they are dealt so already."""
    return rows.repartition(tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), KEY)


def _stretched(marked: DataFrame, tasks: int | None) -> DataFrame:
    """The stretches of marked anchors, with the words gone through once.

    Sure anchors become stretches at once, which are few; these and the anchors that are not sure are written to the shared
    folder and read by all that needs them, dealt like words that are dealt by video already, which then stay where they are.
    """
    w = Window.partitionBy(KEY).orderBy("pa")
    goes_on = F.col("sure") & F.lag("sure").over(w) & _following("pa", "pa", w) & _following("pb", "pb", w)
    runs = marked.withColumn("new", ~F.coalesce(goes_on, F.lit(False)))
    runs = runs.withColumn("run", F.count_if("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    few = cut(runs.groupBy(KEY, "run").agg(
        F.min("pa").alias("pa"), F.max("pa").alias("pa_to"), F.min("pb").alias("pb"), F.max("pb").alias("pb_to"), F.first("sure").alias("sure"),
        F.max("part").alias("part"),
    ))
    rest = _thinned(few).select(KEY, "pa", F.col("pa").alias("pa_to"), "pb", F.col("pb").alias("pb_to"))
    both = few.where("sure").select(*rest.columns).unionByName(rest)
    return _dealt(cut(_joined(both)), tasks)


def _joined(found: DataFrame) -> DataFrame:
    """Stretches that follow each other on both sides as one."""
    w = Window.partitionBy(KEY).orderBy("pa")
    new = ~F.coalesce(_following("pa", "pa_to", w) & _following("pb", "pb_to", w), F.lit(False))
    runs = found.withColumn("new", new).withColumn("run", F.count_if("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(KEY, "run").agg(
        F.min("pa").alias("pa"), F.max("pa_to").alias("pa_to"), F.min("pb").alias("pb"), F.max("pb_to").alias("pb_to")
    ).drop("run")


def stretches(found: DataFrame) -> DataFrame:
    """(video_id, pa, pa_to, pb, pb_to): anchors that follow each other on both sides as one, ends inclusive."""
    return _joined(found.select(KEY, "pa", F.col("pa").alias("pa_to"), "pb", F.col("pb").alias("pb_to")))


def _gaps(a: DataFrame, b: DataFrame, sure: DataFrame, *keep: str, around: int = 0) -> DataFrame:
    """Words of both sides (0: a, 1: b) outside the stretches: gap, the stretches before; pos; other, its place on the other side.

    Of a's stretches that many words at either end come along, which are not inside; they have the gap that follows them.
    """
    sides = []
    for side, d, here, there in ((0, a, "pa", "pb"), (1, b, "pb", "pa")):
        none = F.lit(-1).cast("bigint")
        words = d.select(KEY, "pos", F.lit(1).alias("kind"), F.lit(0).cast("bigint").alias("other"), none.alias("since"), none.alias("upto"), "norm", *keep)
        cuts = sure.select(
            KEY, F.col(here).alias("pos"), F.lit(0).alias("kind"), (F.col(f"{there}_to") + 1).alias("other"), F.col(here).alias("since"), F.col(f"{here}_to").alias("upto")
        )
        sides.append(words.unionByName(cuts, allowMissingColumns=True).withColumn("side", F.lit(side)))
    upto = Window.partitionBy(KEY, "side").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, 0)
    marked = sides[0].unionByName(sides[1]).select(
        KEY, "side", "pos", "kind", "norm", *keep, F.count_if(F.col("kind") == 0).over(upto).alias("gap"),
        *(F.max(c).over(upto).alias(c) for c in ("other", "since", "upto")),
    )
    inside = F.col("pos") > F.col("upto")
    near = (F.col("side") == 0) & ((F.col("pos") < F.col("since") + around) | (F.col("pos") > F.col("upto") - around))
    return marked.where("kind = 1").where(inside | near if around else inside).withColumn("inside", inside).drop("kind", "since", "upto")


def _whole(batches: Iterator[pa.RecordBatch], around: int) -> Iterator[tuple[pa.Table, int, int]]:
    """Tables with the rows from which and up to which their gaps are whole and not given yet; of a, around words stand on either side of these."""
    held: pa.Table | None = None
    given, due = 0, 0
    for b in batches:
        t = pa.Table.from_batches([b])
        held = pa.concat_tables([held, t]) if held is not None else t
        if held.num_rows < due or not held.num_rows:
            continue
        held = held.combine_chunks()
        key, gap, of_a = _codes(held, KEY), held.column("gap").to_numpy(), held.column("side").to_numpy() == 0
        other = np.diff(key) != 0
        at = np.flatnonzero(other | (np.diff(gap) != 0)) + 1  # rows where gaps begin
        at = at[at > given]
        behind = np.append(0, np.cumsum(of_a))
        at = at[other[at - 1] | (key[at] != key[-1]) | (behind[-1] - behind[at] >= around)]
        if not len(at):
            due = 2 * held.num_rows
            continue
        stop = int(at[-1])
        yield held, given, stop
        tail = np.flatnonzero(of_a[:stop] & (key[:stop] == key[stop]))[-around:] if around else np.zeros(0, np.int64)
        held, given, due = pa.concat_tables([held.take(pa.array(tail)), held.slice(stop)]), len(tail), 0
    if held is not None and held.num_rows > given:
        yield held.combine_chunks(), given, held.num_rows


def _codes(t: pa.Table, column: str) -> np.ndarray:
    """A number for each distinct value."""
    return t.column(column).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)


def _said(words: list[str | None]) -> str:
    return " ".join(w for w in words if w is not None)


def _solved(t: pa.Table, start: int, stop: int) -> Iterator[tuple[int, int, int, int, list[tuple[str, int, int, int, int]]]]:
    """For each gap of these rows: the rows where its words of a and of b begin, their places, and its opcodes."""
    code, key = _codes(t, "norm"), _codes(t, KEY)
    gap, side, pos, other, inside = (t.column(c).to_numpy(zero_copy_only=False) for c in ("gap", "side", "pos", "other", "inside"))
    new = start + np.flatnonzero((np.diff(key[start:stop], prepend=-1) != 0) | (np.diff(gap[start:stop], prepend=-1) != 0))
    count = lambda held: np.add.reduceat(held[start:stop], new - start, dtype=np.int64)
    ends = np.append(new[1:], stop)
    middle = new + count(side == 0)
    first = middle - count((side == 0) & inside)
    left = [code[x:m] for x, m in zip(first, middle, strict=True)]
    right = [code[m:e] for m, e in zip(middle, ends, strict=True)]
    for f, m, e, blocks in zip(first.tolist(), middle.tolist(), ends.tolist(), matching_blocks(left, right), strict=True):
        if f == e:
            continue  # nothing but words around
        p, q = (pos[f], other[f]) if f < m else (other[m], pos[m])
        yield f, m, int(p), int(q), opcodes(blocks, m - f, e - m)


def _table(rows: list[tuple], kinds: pa.Schema) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)


def edits(a: DataFrame, b: DataFrame, sure: DataFrame, words: bool = False, tasks: int | None = None) -> DataFrame:
    """(video_id, what, a_from, a_to, b_from, b_to) inside the gaps between stretches: equal, replace, delete, insert.

    Ends are exclusive. With words, was and now hold the words of both sides, null where equal. Words stay where their video
    is; a task holds one gap at a time.
    """
    keep = ["word"] if words else []
    rows = _gaps(a, b, sure, *keep).select(KEY, "gap", "side", "pos", "other", "inside", "norm", *keep)
    kind = rows.schema[KEY].dataType.simpleString()
    schema = f"{KEY} {kind}, what string, a_from bigint, a_to bigint, b_from bigint, b_to bigint" + (", was string, now string" if words else "")
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, start, stop in _whole(batches, 0):
            text = t.column("word").to_pylist() if words else []
            video = t.column(KEY).to_pylist()
            out: list[tuple] = []
            for f, m, p, q, found in _solved(t, start, stop):
                for what, i, j, k, n in found:
                    said = () if not words else (None, None) if what == "equal" else (_said(text[f + i : f + j]), _said(text[m + k : m + n]))
                    out.append((video[f], what, p + i, p + j, q + k, q + n, *said))
            yield from _table(out, kinds).to_batches()

    return _dealt(rows, tasks).sortWithinPartitions(KEY, "gap", "side", "pos").mapInArrow(run, schema)


def align_words(a: DataFrame, b: DataFrame, tasks: int | None = None) -> DataFrame:
    """Per video: equal, substituted, inserted and deleted words of b against a, agreement in thousandths.

    Words are compared by their norm; those without one are left out. Of a replaced stretch as many words as both sides have
    are substituted. Videos of one side only are all deleted or inserted. Words that are dealt by video to so many tasks are not
    shuffled.
    """
    a, b = numbered(a, blank=False, dense=False), numbered(b, blank=False, dense=False)
    sure = anchors(a, b, joined=True, tasks=tasks)
    n, m = F.col("a_to") - F.col("a_from"), F.col("b_to") - F.col("b_from")
    when = lambda is_equal, value: F.when((F.col("what") == "equal") == is_equal, value).otherwise(0)
    parts = edits(a, b, sure, tasks=tasks).select(
        KEY, when(True, n).alias("n_equal"), when(False, F.least(n, m)).alias("n_sub"),
        when(False, F.greatest(m - n, F.lit(0))).alias("n_ins"), when(False, F.greatest(n - m, F.lit(0))).alias("n_del"),
    )
    zero = F.lit(0).cast("bigint")
    same = sure.select(KEY, (F.col("pa_to") - F.col("pa") + 1).alias("n_equal"), *(zero.alias(c) for c in ("n_sub", "n_ins", "n_del")))
    sums = parts.unionByName(same).groupBy(KEY).agg(*(F.sum(c).alias(c) for c in ("n_equal", "n_sub", "n_ins", "n_del")))
    total = F.col("n_equal") + F.col("n_sub") + F.greatest("n_ins", "n_del")
    return sums.withColumn("agreement_milli", F.floor(1000 * F.col("n_equal") / total))


def diff_hunks(a: DataFrame, b: DataFrame, context: int = 6, tasks: int | None = None) -> DataFrame:
    """(video_id, n, at_ms, before, was, now, after): places where two transcripts differ, with words of a around them.

    at_ms is where the first word of a begins that is gone, or before which, at the end behind which, words come in. Words
    around a gap go through with it, so that hunks are told in order, and nothing is joined or numbered afterwards.
    """
    a, b = numbered(a), numbered(b)
    around = max(context, 1)
    kinds_of = {c: a.schema[c].dataType.simpleString() for c in (KEY, "start_ms")}
    schema = f"{KEY} {kinds_of[KEY]}, n bigint, at_ms {kinds_of['start_ms']}, before string, was string, now string, after string"
    kinds = to_arrow_schema(StructType.fromDDL(schema))
    b = b.withColumn("start_ms", F.lit(None).cast(kinds_of["start_ms"]))
    rows = _gaps(a, b, anchors(a, b, joined=True, tasks=tasks), "word", "start_ms", around=around)
    rows = rows.select(KEY, "gap", "side", "pos", "other", "inside", F.when(F.col("inside"), F.col("norm")).alias("norm"), "word", "start_ms")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, told = None, 0
        for t, start, stop in _whole(batches, around):
            key, of_a = _codes(t, KEY), t.column("side").to_numpy() == 0
            video, word = t.column(KEY).to_pylist(), t.column("word").to_pylist()
            at_a = np.flatnonzero(of_a)
            said, times = [word[i] for i in at_a.tolist()], t.column("start_ms").take(pa.array(at_a)).to_pylist()
            before_row = np.append(0, np.cumsum(of_a)).tolist()
            ends = np.append(np.flatnonzero(np.diff(key)) + 1, len(key))
            which = np.searchsorted(ends, np.arange(len(key)), "right")
            edges = [0, *(before_row[e] for e in ends.tolist())]  # a's words of the k-th video are said[edges[k] : edges[k + 1]]
            out: list[tuple] = []
            for f, m, p, q, found in _solved(t, start, stop):
                if video[f] != last:
                    last, told = video[f], 0
                lo, hi, here = edges[which[f]], edges[which[f] + 1], before_row[f] if f < m else before_row[m]
                for what, i, j, k, n in found:
                    if what == "equal":
                        continue
                    x, y = here + i, here + j
                    at = times[x] if x < hi else None
                    if at is None and x > lo:
                        at = times[x - 1]
                    out.append((
                        video[f], told, at, _said(said[max(lo, x - context) : x]), _said(said[x:y]), _said(word[m + k : m + n]), _said(said[y : min(hi, y + context)]),
                    ))
                    told += 1
            yield from _table(out, kinds).to_batches()

    return _dealt(rows, tasks).sortWithinPartitions(KEY, "gap", "side", "pos").mapInArrow(run, schema)


def compare_transcripts(a: DataFrame, b: DataFrame, k: int = 10, tasks: int | None = None) -> DataFrame:
    """The k videos that agree least."""
    return align_words(a, b, tasks).orderBy("agreement_milli", KEY).limit(k)


def compare_summary(aligned: DataFrame) -> DataFrame:
    """Medians, sums and extremes over all compared videos."""
    return aligned.agg(
        F.count("*").alias("n"), F.percentile("agreement_milli", 0.5).alias("median_milli"), F.min("agreement_milli").alias("least_milli"),
        F.sum("n_sub").alias("n_sub"), F.sum("n_ins").alias("n_ins"), F.sum("n_del").alias("n_del"),
    )
