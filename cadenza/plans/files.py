"""Queries of the readers and writers: a table is written by Spark to the shared folder in the form a source has, and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.plans.registry import query
from cadenza.sources import readers as R
from cadenza.sources import sinks
from cadenza.sources import views as V
from cadenza.sources.artifacts import write_artifacts
from cadenza.streaming import arrivals


def place(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which all machines reach; in one process, as in tests, a temporary one will do."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and spark.sparkContext.master.startswith("local"):
        named = tempfile.mkdtemp(prefix="cadenza-")
    if not named:
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{named}/files-{uuid.uuid4()}"


def artifacts(rows: DataFrame, fields: list[str], order: str, name: str, dealt: bool = False) -> str:
    """Root of a folder for each video with its rows' fields as one JSON list, in order, in the file name."""
    root = place(rows.sparkSession)
    held = F.array_sort(F.collect_list(F.struct(order, *(f for f in fields if f != order))))
    if order not in fields:
        held = F.transform(held, lambda x: F.struct(*(x[f].alias(f) for f in fields)))
    write_artifacts(rows.groupBy("video_id").agg(F.to_json(held).alias("value")), root, name, dealt)
    return root


def numbered(df: DataFrame) -> DataFrame:
    return df.withColumn("video_id", F.col("video_id").cast("bigint"))


@query("src1_read_words", "SELECT video_id, seq, word, start_ms, end_ms, seg_end FROM f_words")
def _(spark, d):
    """Lists of words take ten times the bytes of their texts, so the files are compressed, and written where texts were dealt."""
    w = V.words(spark, d).select("video_id", "seq", F.col("word").alias("text"), (F.col("start_ms") / 1000).alias("start"), (F.col("end_ms") / 1000).alias("end"), "seg_end")
    name = "words.json.zst"
    return numbered(R.read_words(spark, artifacts(w, ["text", "start", "end", "seg_end"], "seq", name, dealt=True), name))


@query("src2_read_sentences", "SELECT video_id, id, text, start_ms, end_ms FROM f_sentences")
def _(spark, d):
    s = V.sentences(spark, d).select("video_id", "id", "text", (F.col("start_ms") / 1000).alias("start"), (F.col("end_ms") / 1000).alias("end"))
    return numbered(R.read_sentences(spark, artifacts(s, ["id", "text", "start", "end"], "id", "sentences.json")))


@query("src3_read_draft", """SELECT video_id, id, text AS text_ru, NULL::VARCHAR AS reason FROM f_draft WHERE id % 7 <> 3 AND id % 11 <> 5
UNION ALL SELECT video_id, id, NULL, CASE WHEN id % 7 = 3 THEN 'no_text' ELSE 'duplicate_id' END FROM f_draft, (VALUES (0), (1)) t(k) WHERE (id % 7 = 3 AND k = 0) OR (id % 7 <> 3 AND id % 11 = 5)""")
def _(spark, d):
    """Some rows without a text, some twice."""
    rows = V.draft(spark, d).withColumn("text_ru", F.when(F.col("id") % 7 != 3, F.col("text")))
    times = F.expr("sequence(1, if(id % 7 <> 3 and id % 11 = 5, 2, 1))")
    rows = rows.withColumn("copy", F.explode(times)).drop("copy")
    read = R.draft_rows(spark, artifacts(rows, ["id", "text_ru"], "id", "draft.json"))
    return numbered(read.select("video_id", "id", F.when(F.col("reason").isNull(), F.col("text_ru")).alias("text_ru"), "reason"))


@query("src10_read_inventory", "SELECT conv_id AS video_id, count(*) AS n FROM (SELECT DISTINCT conv_id FROM conversations) GROUP BY 1")
def _(spark, d):
    turns = V.table(spark, d, "conversations").select(F.col("conv_id").alias("video_id"), "turn", "text")
    i = R.read_inventory(spark, artifacts(turns, ["turn", "text"], "turn", "turns.json")).where("bytes > 0 and artifact = 'turns.json'")
    return numbered(i).groupBy("video_id").agg(F.count("*").alias("n"))


@query("src11_read_video_info", """SELECT doc_id AS video_id, source AS title, CASE WHEN doc_id % 3 = 0 THEN n_chars + 1.0 END::DOUBLE AS duration, '2026-01-02' AS upload_date FROM documents""")
def _(spark, d):
    """Durations that are true, or not over zero, are unknown."""
    docs = V.table(spark, d, "documents")
    seconds = F.expr("case when doc_id % 3 = 0 then cast(n_chars + 1 as string) when doc_id % 3 = 1 then 'true' else '-1' end")
    info = F.concat(F.lit('{"title": '), F.to_json(F.array("source")).substr(F.lit(2), F.char_length(F.to_json(F.array("source"))) - 2), F.lit(', "duration": '), seconds, F.lit(', "upload_date": "20260102"}'))
    root = place(spark)
    write_artifacts(docs.select(F.col("doc_id").alias("video_id"), info.alias("value")), root, "source.info.json")
    return numbered(R.read_video_info(spark, root)).select("video_id", "title", "duration", "upload_date")


def run_log(spark: SparkSession, d: str) -> DataFrame:
    e = V.table(spark, d, "events")
    at = F.col("ts").cast("timestamp")
    return e.select(
        F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("run_id"), at.alias("started"),
        (at + F.expr("make_interval(0, 0, 0, 0, 0, 0, user_id % 60)")).alias("finished"), F.col("event_type").alias("config_key"),
    )


RUN_LOG = "SELECT 'r' || event_id AS run_id, (user_id % 60)::BIGINT AS seconds, event_type AS config_key FROM events"


@query("src8_read_runs", RUN_LOG)
def _(spark, d):
    """Appended in two parts, as by two batches."""
    path, log = place(spark), run_log(spark, d)
    half = F.pmod(F.xxhash64("run_id"), F.lit(2))
    for k in (0, 1):
        sinks.append_run(log.where(half == k), path)
    return R.read_runs(spark, path).select("run_id", (F.unix_timestamp("finished") - F.unix_timestamp("started")).alias("seconds"), "config_key")


@query("ss3_run_ingest", RUN_LOG)
def _(spark, d):
    """Each run is logged twice."""
    log = run_log(spark, d)
    return arrivals.run_ingest(log.unionByName(log)).select("run_id", "seconds", "config_key")


@query("snk1_replace_artifacts", """SELECT video_id, id, CASE WHEN video_id % 3 = 0 AND id % 2 = 0 THEN 'new ' || text ELSE text END AS text FROM f_draft
  WHERE video_id % 3 <> 0 OR id % 2 = 0 OR video_id NOT IN (SELECT video_id FROM f_draft WHERE id % 2 = 0)""")
def _(spark, d):
    """All videos are written, then every third one again, with fewer rows; where none is left, the video is not written again and stays."""
    path, rows = place(spark), V.draft(spark, d)
    sinks.write_table(rows, path)
    again = rows.where("video_id % 3 = 0 and id % 2 = 0").withColumn("text", F.concat(F.lit("new "), "text"))
    sinks.write_table(again, path)
    return numbered(spark.read.parquet(path)).select("video_id", "id", "text")


def run_to_end(told: DataFrame, root: str) -> DataFrame:
    """What a stream writes until all that is there has been read."""
    write = told.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{root}/offsets").option("path", f"{root}/out")
    stream = write.trigger(availableNow=True).start()
    try:
        stream.awaitTermination()
    finally:
        stream.stop()
    return told.sparkSession.read.schema(told.schema).parquet(f"{root}/out")


@query("ss1_gate", """SELECT video_id, 'ready' AS state, count(DISTINCT id) AS n_ids, 0 AS n_missing FROM f_sentences s
  WHERE NOT EXISTS (SELECT * FROM f_sentences t WHERE t.video_id = s.video_id AND t.id % 7 <> 3 AND t.video_id % 3 = 0 AND t.id % 5 = 4) GROUP BY video_id""")
def _(spark, d):
    """Wanted ids and drafts arrive as files, read one at a time; a third of the videos never get some of their drafts."""
    root, s = place(spark), V.sentences(spark, d)
    want = s.select("video_id", F.lit("want").alias("kind"), "id")
    end = s.select("video_id").distinct().select("video_id", F.lit("want").alias("kind"), F.lit(None).cast("bigint").alias("id"))
    have = s.where("not (video_id % 3 = 0 and id % 5 = 4 and id % 7 <> 3)").select("video_id", F.lit("have").alias("kind"), "id")
    half = F.pmod(F.xxhash64("video_id", "id"), F.lit(2))
    for part in (have.where(half == 0), want, have.where(half == 1).unionByName(end)):
        part.write.mode("append").parquet(f"{root}/in")
    store, idle = arrivals.STORE[0], "spark.sql.streaming.noDataMicroBatches.enabled"
    was = {k: spark.conf.get(k, None) for k in (store, idle)}
    spark.conf.set(*arrivals.STORE)
    spark.conf.set(idle, "false")  # with timers there would be a next batch for ever
    try:
        files = max(1, len(spark.read.parquet(f"{root}/in").inputFiles()) // 3)
        stream = spark.readStream.schema(want.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/in")
        told = run_to_end(arrivals.completeness_gate(stream), root)
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return told.select("video_id", "state", "n_ids", F.size("missing").alias("n_missing"))


@query("ss2_upsert_batches", """SELECT video_id, id, CASE WHEN id % 2 = 0 THEN 'b' || (CASE WHEN id % 3 = 0 THEN 3 ELSE 2 END) ELSE 'a' END AS status, text FROM f_sentences""")
def _(spark, d):
    """Two batches through the upsert: all rows, then for some a status of their own, set twice for some of these."""
    path, s = place(spark), V.sentences(spark, d).select("video_id", "id", "text")
    first = s.withColumn("status", F.lit("a")).withColumn("at", F.lit(1))
    none = F.lit(None).cast("string")
    second = s.where("id % 2 = 0").select("video_id", "id", F.lit("b2").alias("status"), F.lit(2).alias("at"))
    third = s.where("id % 6 = 0").select("video_id", "id", F.lit("b3").alias("status"), F.lit(3).alias("at"))
    empty = s.where("id % 4 = 0").select("video_id", "id", none.alias("status"), F.lit(4).alias("at"))
    write = arrivals.upsert_into(path)
    write(first, 0)
    write(third.unionByName(second).unionByName(empty), 1)
    return arrivals.snapshot(spark, path).select("video_id", "id", "status", "text")
