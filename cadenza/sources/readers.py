"""Readers of per-video JSON artifacts, queues, run logs and dictionaries.

root holds one folder for each video; its name, or what follows video_id= as partitioned writers call it, is the video_id. A missing or torn file gives no rows or null, never an error;
inconsistent content is refused or listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.operators.integrity import read_queue_lines, require_contiguous
from cadenza.operators.intervals import KEY
from cadenza.sources.artifacts import artifacts, typed_rows

WORDS = "text string, start double, end double, seg_end boolean"
SENTENCES = "id bigint, text string, start double, end double"
RUNS = "run_id string, started timestamp, finished timestamp, elapsed_s double, n int, ids array<string>, config_key string"


def ms(c: str) -> Column:
    return F.round(F.col(c) * 1000).cast("bigint")


def read_artifact(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """Rows of root/*/name, a JSON list or object: video_id, file, modified, bytes, seq, the fields of schema, _rejects, _corrupt.

    _corrupt is the text of a torn file, which is one row; _rejects names the fields that cannot be read as their types. A filter
    on video_id reads only the folders of those videos.
    """
    return typed_rows(artifacts(spark, root, name), schema)


def read_words(spark: SparkSession, root: str, name: str = "words.json") -> DataFrame:
    """video_id, seq, word, start_ms, end_ms, seg_end (false where absent), in the file's order."""
    return read_artifact(spark, root, name, WORDS).where("_corrupt is null").select(
        KEY, "seq", F.col("text").alias("word"), ms("start").alias("start_ms"), ms("end").alias("end_ms"), F.coalesce("seg_end", F.lit(False)).alias("seg_end")
    )


def read_sentences(spark: SparkSession, root: str, strict: bool = True, name: str = "sentences.json") -> DataFrame:
    """video_id, id, text, start_ms, end_ms; strict: reading fails unless ids are 0 to n - 1."""
    s = read_artifact(spark, root, name, SENTENCES).where("_corrupt is null and id is not null")
    s = s.select(KEY, "id", "text", ms("start").alias("start_ms"), ms("end").alias("end_ms"))
    return require_contiguous(s) if strict else s


def draft_rows(spark: SparkSession, root: str, name: str = "draft.json") -> DataFrame:
    """All rows of drafts, read once: video_id, id, text_ru, src, src_note and the reason for which one is rejected, else null.

    Rejected: torn files, missing ids or texts, texts that are not strings, repeated ids. A src or note that is no string becomes
    empty.
    """
    raw = read_artifact(spark, root, name, "id variant, text_ru variant, src variant, src_note variant")
    kind = lambda c: F.schema_of_variant(c)
    typed = raw.select(
        KEY, F.col("_corrupt").isNotNull().alias("torn"), F.try_variant_get("id", "$", "bigint").alias("id"),
        (kind("text_ru") == "STRING").alias("is_text"), F.try_variant_get("text_ru", "$", "string").alias("text_ru"),
        F.when(kind("src") == "STRING", F.try_variant_get("src", "$", "string")).alias("src"),
        F.coalesce(F.when(kind("src_note") == "STRING", F.try_variant_get("src_note", "$", "string")), F.lit("")).alias("src_note"),
    )
    times = F.count("*").over(Window.partitionBy(KEY, "id"))
    reason = (
        F.when(F.col("torn"), "torn").when(F.col("id").isNull(), "no_id").when(F.col("is_text").isNull(), "no_text")
        .when(~F.col("is_text"), "text_type").when(F.col("times") > 1, "duplicate_id")
    )
    return typed.withColumn("times", times).select(KEY, "id", "text_ru", "src", "src_note", reason.alias("reason"))


def read_draft(spark: SparkSession, root: str, name: str = "draft.json") -> tuple[DataFrame, DataFrame]:
    """Rows (video_id, id, text_ru, src, src_note) and rejects (video_id, id, reason) of draft_rows; each reads the files."""
    rows = draft_rows(spark, root, name)
    return rows.where("reason is null").drop("reason"), rows.where("reason is not null").select(KEY, "id", "reason")


def read_clean_chunks(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Rows (video_id, chunk, lo, hi, id, text) of files named lo-hi.json and rejects; an empty text is fine, null is not."""
    raw = read_artifact(spark, root, "*-*.json", "id bigint, text string")
    lo, hi = (F.regexp_extract("file", r"^(\d+)-(\d+)\.json$", i) for i in (1, 2))
    r = raw.where(lo != "").select(
        KEY, F.regexp_replace("file", r"\.json$", "").alias("chunk"), lo.cast("bigint").alias("lo"), hi.cast("bigint").alias("hi"), "id", F.trim("text").alias("text"),
        F.when(F.col("_corrupt").isNotNull(), "torn").when(F.col("id").isNull(), "no_id").when(F.col("text").isNull(), "null_text").alias("reason"),
    )
    return r.where("reason is null").drop("reason"), r.where("reason is not null").select(KEY, "chunk", "id", "reason")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split(F.regexp_replace("value", "^﻿", ""), r"\r?\n")).alias("pos", "line"))


def read_queue(spark: SparkSession, path: str, unmatched: str = "drop") -> DataFrame:
    """video_id, pos, n of a queue file; n counts its lines. Lines without an id are dropped or get a hash."""
    return read_queue_lines(_lines(spark, path).withColumn("pos", F.col("pos").cast("bigint")), unmatched)


def queue_header(lines: DataFrame) -> DataFrame:
    """title and url of the first line '# playlist: title | url'; either may be missing."""
    h = lines.where(F.lower("line").rlike(r"^#\s*playlist:")).agg(F.min_by("line", "pos").alias("line"))
    body = F.trim(F.regexp_replace("line", r"(?i)^#\s*playlist:", ""))
    url = F.regexp_extract(body, r"(https?://\S+)\s*$", 1)
    title = F.trim(F.regexp_replace(F.regexp_replace(body, r"https?://\S+\s*$", ""), r"\|\s*$", ""))
    return h.select(F.nullif(title, F.lit("")).alias("title"), F.nullif(url, F.lit("")).alias("url"))


def read_runs(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """The append-only run log; a torn line costs one line."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(RUNS).option("mode", "DROPMALFORMED").json(path)


def read_stress_dict(spark: SparkSession, path: str) -> DataFrame:
    """word, stress: place among its vowels of the one with primary stress; alternates and comments skipped, first listing wins."""
    lines = _lines(spark, path).where("line <> '' and line not like ';;;%'")
    parts = F.split(F.trim("line"), r"\s+")
    vowels = F.filter(F.slice(parts, 2, 1000), lambda p: F.regexp_like(p, F.lit(r"\d$")))
    place = F.array_position(F.transform(vowels, lambda p: F.substring(p, -1, 1)), "1") - 1
    w = lines.select(F.lower(parts[0]).alias("word"), place.alias("stress"), "pos").where("word not like '%(%' and stress >= 0")
    return w.groupBy("word").agg(F.min_by("stress", "pos").alias("stress"))


def read_inventory(spark: SparkSession, root: str) -> DataFrame:
    """video_id, artifact, modified, bytes of every file; contents are not read."""
    return artifacts(spark, root, contents=False).select(KEY, F.col("file").alias("artifact"), "modified", "bytes")


def read_video_info(spark: SparkSession, root: str, name: str = "source.info.json") -> DataFrame:
    """Title, duration (null unless a positive number) and channel; the date as year-month-day."""
    raw = read_artifact(spark, root, name, "title string, duration variant, channel string, uploader string, upload_date string")
    number = F.when(F.schema_of_variant("duration") != "BOOLEAN", F.try_variant_get("duration", "$", "double"))
    date = F.regexp_replace("upload_date", r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return raw.where("_corrupt is null").select(
        KEY, "title", F.when(number > 0, number).alias("duration"), F.coalesce("channel", "uploader").alias("channel"), date.alias("upload_date")
    )
