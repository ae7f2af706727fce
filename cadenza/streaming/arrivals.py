"""Inputs that arrive piece by piece: a completeness gate, field upserts and a run log."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from cadenza.operators.intervals import KEY


#: Ids that share an entry of the gate's state.
SPAN = 63


class _Gate(StatefulProcessor):
    """State of a video: for every SPAN ids a bit for each that is wanted and each that is there, counts, the timer's time and when it is due.

    Each call to the store is a round trip, so the bits of the first SPAN ids, which most videos never leave, stand with the
    counts in one value; others have an entry for every SPAN ids, and a batch touches only the entries of its ids. The timer
    stays when something arrives; one that fires before the video is due is set anew.
    """

    def __init__(self, deadline_ms: int) -> None:
        self.deadline_ms = deadline_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ids = handle.getMapState("ids", "part bigint", "want bigint, have bigint")
        self.head = handle.getValueState("head", "n_want bigint, n_met bigint, closed boolean, want bigint, have bigint, more boolean, timer bigint, due bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        held = self.head.get()
        n_want, n_met, closed, *first, more, timer, _ = held or (0, 0, False, 0, 0, False, None, None)
        new: dict[int, list[int]] = {}
        for b in rows:
            for kind, i in zip(b["kind"].tolist(), b["id"].tolist(), strict=True):
                if i is None or i != i:
                    closed = closed or kind == "want"
                elif kind in ("want", "have"):
                    part, bit = divmod(int(i), SPAN)
                    new.setdefault(part, [0, 0])[kind == "have"] |= 1 << bit
        for part, (want, have) in new.items():
            old_want, old_have = first if part == 0 else self.ids.getValue((part,)) if more and self.ids.containsKey((part,)) else (0, 0)
            want, have = want | old_want, have | old_have
            n_want += want.bit_count() - old_want.bit_count()
            n_met += (want & have).bit_count() - (old_want & old_have).bit_count()
            if part == 0:
                first = [want, have]
            else:
                self.ids.updateValue((part,), (want, have))
                more = True
        ready = closed and n_want and n_met == n_want
        due = timerValues.getCurrentProcessingTimeInMs() + self.deadline_ms
        if timer is not None and (ready or due < timer):
            self.handle.deleteTimer(timer)
            timer = None
        if ready:
            self._clear(held is not None, more)
            yield self._told(key, "ready", n_want, [])
        else:
            self.head.update((n_want, n_met, closed, *first, more, due if timer is None else timer, due))
            if timer is None:
                self.handle.registerTimer(due)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        n_want, n_met, closed, want, have, more, _, due = self.head.get() or (0, 0, False, 0, 0, False, None, None)
        if due is not None and due > timerValues.getCurrentProcessingTimeInMs():
            self.head.update((n_want, n_met, closed, want, have, more, due, due))
            self.handle.registerTimer(due)
            return
        parts = [(0, want, have), *((part, *bits) for (part,), bits in (self.ids.iterator() if more else ()))]
        lack = [part * SPAN + bit for part, want, have in parts for bit in range(SPAN) if (want & ~have) >> bit & 1]
        self._clear(True, more)
        yield self._told(key, "pending", n_want, sorted(lack))

    def _clear(self, held: bool, more: bool) -> None:
        if held:
            self.head.clear()
        if more:
            self.ids.clear()

    def _told(self, key: tuple, state: str, n: int, missing: list[int]) -> pd.DataFrame:
        return pd.DataFrame([(key[0], state, n, missing)], columns=[KEY, "state", "n_ids", "missing"])

    def close(self) -> None:
        pass


def completeness_gate(arrivals: DataFrame, deadline_ms: int = 600_000) -> DataFrame:
    """(video_id, state, n_ids, missing): ready once all ids of a video are there, pending with the missing ones at the deadline.

    arrivals: video_id, kind (want for the sentences, have for the draft), id. A part of the ids is never ready, an end of the
    wanted ids is marked by a row want with id null. The deadline counts from a video's last arrival. State goes as soon as
    a video is told; rows that arrive later begin anew. The session's state store must be RocksDB's (STORE).
    """
    kind = arrivals.schema[KEY].dataType.simpleString()
    return arrivals.groupBy(KEY).transformWithStateInPandas(
        _Gate(deadline_ms), f"{KEY} {kind}, state string, n_ids bigint, missing array<bigint>", "Append", "ProcessingTime"
    )


#: The setting, and its value, that the gate's kind of state needs.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


#: Parts of an upserted table; a batch rewrites those that it touches.
BUCKETS = 256


def _commits(spark: SparkSession, path: str, before: int | None) -> dict[int, int]:
    """For each bucket the version that holds it, by the last whole manifest, of those before a version if one is given.

    A manifest has a row for each bucket, with the number of all; one with fewer was torn and does not count.
    """
    try:
        rows = spark.read.schema("bucket int, held int, n int, version int").json(f"{path}/commits")
    except AnalysisException:  # nothing is there yet
        return {}
    if before is not None:
        rows = rows.where(F.col("version") < before)
    whole = rows.groupBy("version").agg(F.countDistinct("bucket").alias("k"), F.max("n").alias("n")).where("k = n")
    last = whole.agg(F.max("version")).first()[0]
    if last is None:
        return {}
    return {r["bucket"]: r["held"] for r in rows.where(F.col("version") == last).select("bucket", "held").distinct().collect()}


def _held(spark: SparkSession, path: str, versions: dict[int, int]) -> DataFrame | None:
    """Rows of buckets in the versions that hold them."""
    folders = [f"{path}/data/version={v}/bucket={b}" for b, v in sorted(versions.items())]
    return spark.read.option("mergeSchema", "true").parquet(*folders) if folders else None


def snapshot(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The table as of its last commit, or of the last one before a version; None where there is none."""
    return _held(spark, path, _commits(spark, path, before))


def _upserted(base: DataFrame | None, batch: DataFrame, stamp: str, bucket: Column) -> DataFrame:
    """base with the batch's newest fields over it, and bucket. Rows are dealt once, as they are written; a bucket of one video
    still goes to eight tasks."""
    fields = [c for c in batch.columns if c not in (KEY, "id", stamp)]
    names = [c for c in (base.columns if base is not None else []) if c not in (KEY, "id")]
    age = F.col(stamp) if stamp in batch.columns else F.lit(0)
    rows = batch.select(KEY, "id", *fields, age.alias("__age"), F.lit(True).alias("__given"))
    if base is not None:
        rows = base.unionByName(rows, allowMissingColumns=True)
    rows = rows.withColumns({"bucket": bucket, "__part": F.pmod(F.xxhash64(KEY, "id"), F.lit(8))}).repartition("bucket", "__part")

    def value(c: str) -> Column:
        newest = F.max(F.when(F.col("__given") & F.col(c).isNotNull(), F.struct(F.col("__age"), F.col(c).alias("value"))))["value"]
        before = F.max(F.when(F.col("__given").isNull(), F.col(c)))
        if c not in fields:
            return before
        return F.when(F.bool_or("__given"), newest).otherwise(before) if c in names else newest

    return rows.groupBy("bucket", "__part", KEY, "id").agg(*(value(c).alias(c) for c in dict.fromkeys([*names, *fields]))).drop("__part")


def upsert_into(path: str, stamp: str = "at", buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: each micro-batch's fields over the table at path, which snapshot reads.

    Rows are dealt to buckets by their video. A batch reads and writes the buckets of its own videos, as a new version of
    them; a manifest of at most buckets rows, written last and at once, says which version holds which bucket. So a
    reader, or a failure between the two, finds the last whole table, and a batch that is run again writes its own version
    again over the state before it. Of several values of a field in one batch the one with the greatest stamp stays, the
    greatest one among equals or where the batch has no stamp column.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int").alias("bucket")
        touched = {r["bucket"] for r in batch.select(bucket).distinct().collect()}  # at most buckets
        now = _commits(spark, path, epoch)
        base = _held(spark, path, {b: v for b, v in now.items() if b in touched})
        rows = _upserted(base, batch, stamp, bucket)
        if touched:
            rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/version={epoch}")
        held = now | dict.fromkeys(touched, epoch)
        manifest = spark.createDataFrame([(b, v, len(held), epoch) for b, v in held.items()], "bucket int, held int, n int, version int")
        manifest.coalesce(1).write.mode("overwrite").json(f"{path}/commits/of={epoch}")

    return write


def run_ingest(runs: DataFrame, late: str = "1 hour") -> DataFrame:
    """Runs once each, with elapsed seconds: of a stream, repeated ids within the watermark are dropped; of a table, all but the
    row that started first, the least one among equals."""
    once = runs.where("run_id is not null and started is not null")
    if runs.isStreaming:
        once = once.withWatermark("started", late).dropDuplicatesWithinWatermark(["run_id"])
    else:
        rest = [c for c in runs.columns if c != "started"]
        once = once.groupBy("run_id").agg(F.min(F.struct("started", *rest)).alias("first")).select("first.*").select(*runs.columns)
    seconds = F.unix_timestamp("finished") - F.unix_timestamp("started")
    return once.withColumn("seconds", F.when(seconds >= 0, seconds))


def runs_by_window(runs: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Runs and seconds per configuration and window of their start."""
    r = run_ingest(runs, late)
    return r.groupBy(F.window("started", width), "config_key").agg(F.count("*").alias("n"), F.sum("seconds").alias("seconds"))
