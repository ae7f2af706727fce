"""Writers: tables by video, subtitle and Markdown lines, logs and comparison sheets."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.functions import text as T
from cadenza.operators.intervals import KEY


#: Files of a table by video; a write replaces those that its videos belong to.
FILES = 256


class _Place:
    """The files of a table, k-of-n.parquet each, on whatever filesystem Spark has for its path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, self.path = spark._jvm, path
        self.at = lambda *names: self.jvm.org.apache.hadoop.fs.Path("/".join([path, *names]))
        self.fs = self.at().getFileSystem(spark._jsc.hadoopConfiguration())
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), spark._jsc.hadoopConfiguration())
        self.over = spark.sparkContext._gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        self.over[0] = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE

    def names(self, *folder: str) -> list[str]:
        at = self.at(*folder)
        return sorted(x.getPath().getName() for x in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def files(self) -> tuple[dict[int, str], int]:
        """The name of each file by its number, and how many there can be."""
        found = [n for n in self.names() if n[0] not in "._"]
        parts = [re.fullmatch(r"(\d+)-of-(\d+)\.parquet", n) for n in found]
        if not all(parts) or len({m[2] for m in parts}) > 1:
            raise ValueError(f"{self.path} holds something else than a table by video")
        return {int(m[1]): m[0] for m in parts}, int(parts[0][2]) if parts else FILES

    def replace(self, new: str, n: int) -> None:
        """Files of the folders of new take the place of those that are there, each at once.

        On a local disk a plain rename does so, and the other starts a process for each file.
        """
        local = self.fs.getUri().getScheme() == "file"
        for folder in self.names(new):
            for name in self.names(new, folder):
                if name.endswith(".parquet"):
                    k = int(folder.removeprefix("__file="))
                    made, there = self.at(new, folder, name), self.at(f"{k:05}-of-{n:05}.parquet")
                    if not (local and self.fs.rename(made, there)):
                        self.context.rename(made, there, self.over)


def write_table(df: DataFrame, path: str) -> None:
    """Replace the rows of the videos in df and leave the others; spark.read.parquet(path) has the table.

    A table has at most FILES files, to which videos are dealt. A write puts a new file in place of each that its videos belong
    to, with the rows of the file's other videos; a video is in one file, which is replaced at once by a rename, so that a
    reader finds its old rows or its new ones, and a write that breaks off leaves every video whole. Two writes at a time may
    undo one another.
    """
    spark = df.sparkSession
    place = _Place(spark, path)
    there, n = place.files()
    file = F.pmod(F.xxhash64(F.col(KEY).cast("string")), F.lit(n)).cast("int")
    rows = df.withColumn("__file", file)
    if there:
        touched = [r[0] for r in rows.select("__file").distinct().collect()]  # at most n
        old = [f"{path}/{there[k]}" for k in touched if k in there]
        if old:
            held = spark.read.option("mergeSchema", "true").parquet(*old).withColumn("__new", F.lit(False)).withColumn("__file", file)
            rows = held.unionByName(rows.withColumn("__new", F.lit(True)), allowMissingColumns=True)
    new = f"_new-{uuid.uuid4()}"
    dealt = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "__file")
    if "__new" in rows.columns:
        newest = F.max("__new").over(Window.partitionBy("__file", KEY))
        dealt = dealt.withColumn("__newest", newest).where("__new = __newest").drop("__new", "__newest")
    try:
        if not there and df.isEmpty():  # a file without rows, for its columns
            df.limit(0).coalesce(1).write.parquet(f"{path}/{new}/__file=0")
        else:
            dealt.write.option("maxRecordsPerFile", 0).partitionBy("__file").parquet(f"{path}/{new}")
        place.replace(new, n)
    finally:
        place.fs.delete(place.at(new), True)


def srt_lines(cues: DataFrame) -> DataFrame:
    """(video_id, n, block): numbered subtitle blocks; no cue is shorter than 50 ms, an empty text becomes an ellipsis."""
    n = F.row_number().over(Window.partitionBy(KEY).orderBy("start_ms", "end_ms"))
    end = F.greatest("end_ms", F.col("start_ms") + 50)
    text = F.when(F.trim(F.coalesce("text", F.lit(""))) == "", "…").otherwise(F.col("text"))
    times = F.concat(T.srt_time(F.col("start_ms")), F.lit(" --> "), T.srt_time(end))
    return cues.withColumn("n", n).select(KEY, "n", F.concat_ws("\n", F.col("n").cast("string"), times, text, F.lit("")).alias("block"))


def write_srt(cues: DataFrame, path: str) -> None:
    """One text file in a folder for each video."""
    rows = srt_lines(cues).repartition(KEY).sortWithinPartitions(KEY, "n")
    rows.select(KEY, F.col("block").alias("value")).write.mode("overwrite").partitionBy(KEY).text(path)


def transcript_lines(sentences: DataFrame, info: DataFrame) -> DataFrame:
    """(video_id, n, line): a title, then [time] text; a video without sentences says so."""
    head = info.select(KEY, F.lit(-1).cast("bigint").alias("n"), F.concat(F.lit("# "), F.coalesce(F.col("title"), F.col(KEY).cast("string"))).alias("line"))
    body = sentences.select(KEY, F.col("id").alias("n"), F.concat(F.lit("["), T.clock(F.col("start_ms")), F.lit("] "), "text").alias("line"))
    none = info.join(sentences.select(KEY).distinct(), KEY, "left_anti").select(KEY, F.lit(0).cast("bigint").alias("n"), F.lit("(no speech)").alias("line"))
    return head.unionByName(body).unionByName(none)


def clean_markdown(paragraphs: DataFrame, info: DataFrame, every: int = 120_000) -> DataFrame:
    """(video_id, n, line): a title and paragraphs, the first of every so many milliseconds with its time."""
    from cadenza.operators.grouping import fold

    def step(rows: list):
        stamped = None
        for n, r in enumerate(rows):
            due = stamped is None or r.start_ms - stamped >= every
            stamped = r.start_ms if due else stamped
            s = r.start_ms // 1000
            mark = f"**{s // 3600}:{s // 60 % 60:02d}:{s % 60:02d}** " if s >= 3600 else f"**{s // 60}:{s % 60:02d}** "
            yield n, (mark if due else "") + r.text

    head = info.select(KEY, F.lit(-1).cast("bigint").alias("n"), F.concat(F.lit("# "), F.coalesce(F.col("title"), F.col(KEY).cast("string"))).alias("line"))
    return head.unionByName(fold(paragraphs, [KEY], "start_ms", step, "n bigint, line string"))


def append_run(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_compare_csv(df: DataFrame, path: str) -> None:
    """Columns in a fixed order under a header."""
    columns = [KEY, "n_equal", "n_sub", "n_ins", "n_del", "agreement_milli"]
    df.select(*columns).orderBy("agreement_milli", KEY).write.mode("overwrite").csv(path, header=True)


def batch_table(rollup: DataFrame) -> DataFrame:
    """Text cells of a batch table: a dash where unknown."""
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("—"))
    return rollup.select(
        KEY, cell("n_rows").alias("rows"), cell("n_units").alias("units"), F.concat(cell("median"), F.lit("/"), cell("p95")).alias("speed"),
        F.when(F.col("needs_triage"), "listen").otherwise("ok").alias("triage"), F.concat(cell("flags_actionable"), F.lit(" of "), cell("flags_total")).alias("flags"),
    )


def digest_lines(rollup: DataFrame, offenders: DataFrame) -> DataFrame:
    """(video_id, n, line): a video's figures, then its offenders."""
    head = batch_table(rollup).select(KEY, F.lit(0).cast("bigint").alias("n"), F.concat_ws("  ", KEY, "rows", "units", "speed", "triage", "flags").alias("line"))
    n = F.row_number().over(Window.partitionBy(KEY).orderBy("id")).cast("bigint")
    return head.unionByName(offenders.select(KEY, n.alias("n"), F.concat(F.lit("  #"), F.col("id").cast("string"), F.lit(": "), "reasons").alias("line")))
