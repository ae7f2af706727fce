"""Timed-text tables derived from the given ones, and the same as DuckDB common table expressions.

Times are whole milliseconds. Documents become videos: their words and sentences get times from their positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.operators.intervals import merge_intervals


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mixed(a: str, b: str, m: int) -> Column:
    return F.expr(f"({a} * 7 + {b} * 13) % {m}")


#: Bytes of the files of texts to a task, which holds a hundred times as many when it sorts their words.
TASK_BYTES = 4 << 20


def text_tasks(spark: SparkSession, sf_dir: str) -> int:
    """To how many tasks texts are dealt."""
    files = spark.read.format("binaryFile").load(f"{sf_dir}/documents.parquet")
    size = files.agg(F.sum("length")).first()[0] or 0  # lengths alone; contents are not read
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and text of documents, dealt by doc_id before they are taken apart.

    So texts are shuffled, once for all views with a video's rows together, and not their words, which take many times the
    bytes. A number is given, so that small texts do not end up in few tasks; it grows with the files, as a task sorts its words.
    """
    return table(spark, sf_dir, "documents").select("doc_id", "text").repartition(text_tasks(spark, sf_dir), "doc_id")


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """video_id, seq, word, start_ms, end_ms, seg_end; some words have no length, some follow a pause."""
    each = texts(spark, sf_dir).select(
        F.col("doc_id").alias("video_id"),
        F.posexplode(F.regexp_extract_all("text", F.lit(r"[^ \t\r\n]+"), F.lit(0))).alias("seq", "word"),
    )
    start = F.expr("seq * 320L + ((video_id * 7 + seq * 13) % 11) * 30 + (seq div 40) * 900")
    return each.select(
        "video_id", F.col("seq").cast("bigint").alias("seq"), "word", start.alias("start_ms"),
        (start + F.when(F.col("seq") % 17 == 0, 0).otherwise(40 + 20 * F.char_length("word"))).alias("end_ms"),
        (F.col("seq") % 12 == 11).alias("seg_end"),
    )


def sparse_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """words with holes."""
    return words(spark, sf_dir).where(~(F.col("seq") % 60).between(20, 45))


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """video_id, id, text, start_ms, end_ms; ids from 0."""
    parts = F.filter(
        F.transform(F.regexp_extract_all("text", F.lit(r"[^.!?\n]+[.!?]?"), F.lit(0)), lambda x: F.trim(x)), lambda x: x != ""
    )
    each = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("video_id"), F.posexplode(parts).alias("id", "text")
    )
    n = F.char_length("text").cast("bigint")
    timed = each.withColumn("dur", F.when(mixed("video_id", "id", 23) == 0, 10 * n).otherwise(55 * n + 200))
    w = Window.partitionBy("video_id").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("dur") + mixed("video_id", "id", 5) * 400).over(w), F.lit(0))
    return timed.withColumn("start_ms", start.cast("bigint")).select(
        "video_id", F.col("id").cast("bigint").alias("id"), "text", "start_ms",
        (F.col("start_ms") + F.col("dur")).cast("bigint").alias("end_ms"),
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """video_id, id, src, tgt: a user's turn and the assistant's answer, some cut short."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.col("text").alias("src"),
        F.lead("role").over(w).alias("next_role"), F.lead("text").over(w).alias("next_text"),
    )
    cut = F.expr("substring(next_text, 1, cast(char_length(next_text) * 3 div 10 as int))")
    return c.where("role = 'user' and next_role = 'assistant'").select(
        F.col("conv_id").alias("video_id"), F.col("turn").alias("id"), "src",
        F.when(mixed("conv_id", "turn", 9) == 0, cut).otherwise(F.col("next_text")).alias("tgt"),
    )


def draft(spark: SparkSession, sf_dir: str) -> DataFrame:
    """video_id, id, text: labelled documents' sentences, some missing, and some ids that no sentence has."""
    s = sentences(spark, sf_dir).join(
        table(spark, sf_dir, "labels").select(F.col("doc_id").alias("video_id")).distinct(), "video_id", "left_semi"
    )
    own, foreign = F.when(mixed("video_id", "id", 29) != 0, F.col("id")), F.when(mixed("video_id", "id", 37) == 0, F.col("id") + 10000)
    return s.select("video_id", F.explode(F.array_compact(F.array(own, foreign))).alias("id"), "text")


def speech(spark: SparkSession, sf_dir: str) -> DataFrame:
    """video_id, start_ms, end_ms: words merged over gaps of two seconds and widened by five."""
    return merge_intervals(words(spark, sf_dir), 2000, pad=5000).select("video_id", "start_ms", "end_ms")


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """video_id, start_ms, end_ms of events."""
    a = F.expr("unix_micros(cast(ts as timestamp)) div 1000")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("video_id"), a.alias("start_ms"),
        (a + F.round(F.col("value") * 1000).cast("bigint")).alias("end_ms"),
    )


def stage_wall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """video_id, stage, wall_ms, work_ms (null for errors, sometimes over wall_ms)."""
    e = table(spark, sf_dir, "events")
    wall = e.groupBy(F.col("user_id").alias("video_id"), F.col("event_type").alias("stage")).agg(
        F.sum(F.round(F.col("value") * 1000).cast("bigint")).alias("wall_ms")
    )
    work = F.expr(
        "case when stage = 'signup' and video_id % 2 = 0 then wall_ms + 1 when stage <> 'error' then wall_ms * 9 div 10 end"
    )
    return wall.withColumn("work_ms", work)


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-sentence report rows of orders' lines: two sentences to a unit, flags from the lines' own."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
    w = Window.partitionBy("l_orderkey").orderBy(*order)
    li = table(spark, sf_dir, "lineitem").withColumn("id", F.row_number().over(w).cast("bigint") - 1)
    li = li.withColumn("group_id", F.col("id") - F.col("id") % 2)
    unit = Window.partitionBy("l_orderkey", "group_id").orderBy("id")
    return li.select(
        F.col("l_orderkey").alias("video_id"), "id", "group_id",
        F.first(F.round(1000 + F.col("l_discount") * 10000).cast("bigint")).over(unit).alias("combined_milli"),
        F.when(F.col("l_returnflag") == "R", "low_similarity").alias("verify_flag"),
        F.when(F.col("l_linestatus") == "F", F.when(F.col("id") % 3 == 0, "english_echo").when(F.col("id") % 5 == 0, "odd")).alias("translate_flag"),
        F.array_compact(F.array(
            F.when(F.col("l_tax") >= 0.07, "number_loss"), F.when(F.col("l_tax") <= 0.01, "length_short"),
            F.when(F.col("l_tax") == 0.04, "dup_adjacent"))).alias("completeness_flags"),
    )


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pos, line: watch addresses with repeats, other addresses, comments and blank lines."""
    p = table(spark, sf_dir, "pages")
    line = F.expr(
        "case when page_id % 10 = 9 then case when page_id % 20 = 9 then '# note ' || page_id else '' end "
        "when page_id % 2 = 0 then 'https://youtu.be/' || lpad(cast(page_id % 40 as string), 11, 'A') else url end"
    )
    return p.select(F.col("page_id").alias("pos"), line.alias("line"))


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """video_id, lead, start_ms, end_ms, text, samples (24 a millisecond): two sentences to a unit."""
    s = sentences(spark, sf_dir).withColumn("lead", F.col("id") - F.col("id") % 2)
    u = s.groupBy("video_id", "lead").agg(
        F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "text"))), lambda x: x["text"]), " ").alias("text"),
    )
    return u.withColumn("samples", F.expr("24 * (end_ms - start_ms) * (80 + (video_id * 7 + lead * 13) % 50) div 100"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """run_id, started_ms, finished_ms, ids, audio_n: one run for each user and day."""
    base = table(spark, sf_dir, "events").select(
        "user_id", "event_id", F.expr("unix_micros(cast(ts as timestamp)) div 1000").alias("ms"), "value"
    )
    return base.groupBy(F.col("user_id"), F.expr("ms div 86400000").alias("day")).agg(
        F.min("ms").alias("started_ms"), F.max("ms").alias("finished_ms"), F.count("*").alias("n"),
        F.count_if(F.col("value") > 10).alias("audio_n"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """video_id, artifact, modified_ms: what each document has."""
    d = table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("labelled")).distinct(), "doc_id", "left"
    )
    has = F.array_compact(F.array(
        F.when(F.col("n_chars") > 0, F.struct(F.lit("sentences").alias("artifact"), F.expr("doc_id % 7 * 1000").alias("modified_ms"))),
        F.when(F.col("labelled"), F.struct(F.lit("report").alias("artifact"), F.expr("doc_id % 11 * 1000").alias("modified_ms"))),
        F.when(F.col("doc_id") % 3 == 0, F.struct(F.lit("source_video").alias("artifact"), F.expr("doc_id % 5 * 1000").alias("modified_ms"))),
        F.when(F.col("doc_id") % 4 == 0, F.struct(F.lit("translation").alias("artifact"), F.expr("doc_id % 13 * 1000").alias("modified_ms"))),
    ))
    return d.select(F.col("doc_id").alias("video_id"), F.explode(has).alias("x")).select("video_id", "x.*")


SQL = {
    "f_words": (
        [],
        r"""SELECT video_id, seq, w AS word, seq * 320 + ((video_id * 7 + seq * 13) % 11) * 30 + (seq // 40) * 900 AS start_ms,
  seq * 320 + ((video_id * 7 + seq * 13) % 11) * 30 + (seq // 40) * 900
    + CASE WHEN seq % 17 = 0 THEN 0 ELSE 40 + 20 * length(w) END AS end_ms, seq % 12 = 11 AS seg_end
FROM (SELECT doc_id AS video_id, unnest(regexp_extract_all(text, '[^ \t\r\n]+')) AS w,
             unnest(range(len(regexp_extract_all(text, '[^ \t\r\n]+')))) AS seq FROM documents)""",
    ),
    "f_words_sparse": (["f_words"], "SELECT * FROM f_words WHERE seq % 60 NOT BETWEEN 20 AND 45"),
    "f_sentences": (
        [],
        r"""SELECT video_id, id, text, start_ms, start_ms + dur AS end_ms FROM (
  SELECT *, coalesce(sum(dur + ((video_id * 7 + id * 13) % 5) * 400) OVER (PARTITION BY video_id ORDER BY id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_ms FROM (
    SELECT *, CASE WHEN (video_id * 7 + id * 13) % 23 = 0 THEN 10 * length(text) ELSE 55 * length(text) + 200 END AS dur FROM (
      SELECT video_id, unnest(p) AS text, unnest(range(len(p))) AS id FROM (
        SELECT doc_id AS video_id, list_filter(list_transform(regexp_extract_all(text, '[^.!?\n]+[.!?]?'),
               lambda x: trim(x)), lambda x: x <> '') AS p FROM documents))))""",
    ),
    "f_pairs": (
        [],
        """SELECT conv_id AS video_id, turn AS id, src, CASE WHEN (conv_id * 7 + turn * 13) % 9 = 0
  THEN substring(next_text, 1, length(next_text) * 3 // 10) ELSE next_text END AS tgt FROM (
  SELECT conv_id, turn, role, text AS src, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
WHERE role = 'user' AND next_role = 'assistant'""",
    ),
    "f_draft": (
        ["f_sentences"],
        """SELECT video_id, id, text FROM f_sentences WHERE video_id IN (SELECT doc_id FROM labels) AND (video_id * 7 + id * 13) % 29 <> 0
UNION ALL SELECT video_id, id + 10000, text FROM f_sentences
WHERE video_id IN (SELECT doc_id FROM labels) AND (video_id * 7 + id * 13) % 37 = 0""",
    ),
    "f_speech": (
        ["f_words"],
        """SELECT video_id, greatest(min(start_ms) - 5000, 0) AS start_ms, max(end_ms) + 5000 AS end_ms FROM (
  SELECT *, sum(CASE WHEN start_ms - reach <= 2000 THEN 0 ELSE 1 END) OVER (PARTITION BY video_id ORDER BY start_ms, end_ms
         ROWS UNBOUNDED PRECEDING) AS g FROM (
    SELECT *, max(end_ms) OVER (PARTITION BY video_id ORDER BY start_ms, end_ms
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM f_words))
GROUP BY video_id, g""",
    ),
    "f_spans": (
        [],
        """SELECT user_id AS video_id, epoch_us(ts) // 1000 AS start_ms,
       epoch_us(ts) // 1000 + round(value * 1000)::BIGINT AS end_ms FROM events""",
    ),
    "f_stage_wall": (
        [],
        """SELECT *, CASE WHEN stage = 'signup' AND video_id % 2 = 0 THEN wall_ms + 1 WHEN stage <> 'error' THEN wall_ms * 9 // 10 END AS work_ms
FROM (SELECT user_id AS video_id, event_type AS stage, sum(round(value * 1000)::BIGINT)::BIGINT AS wall_ms FROM events GROUP BY ALL)""",
    ),
    "f_report": (
        [],
        """SELECT l_orderkey AS video_id, id, id - id % 2 AS group_id,
  first_value(round(1000 + l_discount * 10000)::BIGINT) OVER (PARTITION BY l_orderkey, id - id % 2 ORDER BY id) AS combined_milli,
  CASE WHEN l_returnflag = 'R' THEN 'low_similarity' END AS verify_flag,
  CASE WHEN l_linestatus = 'F' THEN CASE WHEN id % 3 = 0 THEN 'english_echo' WHEN id % 5 = 0 THEN 'odd' END END AS translate_flag,
  list_filter([CASE WHEN l_tax >= 0.07 THEN 'number_loss' END, CASE WHEN l_tax <= 0.01 THEN 'length_short' END,
               CASE WHEN l_tax = 0.04 THEN 'dup_adjacent' END], lambda x: x IS NOT NULL) AS completeness_flags
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) - 1 AS id
      FROM lineitem)""",
    ),
    "f_queue": (
        [],
        """SELECT page_id AS pos, CASE WHEN page_id % 10 = 9 THEN CASE WHEN page_id % 20 = 9 THEN '# note ' || page_id ELSE '' END
  WHEN page_id % 2 = 0 THEN 'https://youtu.be/' || lpad((page_id % 40)::VARCHAR, 11, 'A') ELSE url END AS line FROM pages""",
    ),
    "f_units": (
        ["f_sentences"],
        """SELECT *, 24 * (end_ms - start_ms) * (80 + (video_id * 7 + lead * 13) % 50) // 100 AS samples FROM (
  SELECT video_id, id - id % 2 AS lead, min(start_ms) AS start_ms, max(end_ms) AS end_ms, string_agg(text, ' ' ORDER BY id) AS text
  FROM f_sentences GROUP BY ALL)""",
    ),
    "f_inventory": (
        [],
        """SELECT doc_id AS video_id, 'sentences' AS artifact, doc_id % 7 * 1000 AS modified_ms FROM documents WHERE n_chars > 0
UNION ALL SELECT doc_id, 'report', doc_id % 11 * 1000 FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
UNION ALL SELECT doc_id, 'source_video', doc_id % 5 * 1000 FROM documents WHERE doc_id % 3 = 0
UNION ALL SELECT doc_id, 'translation', doc_id % 13 * 1000 FROM documents WHERE doc_id % 4 = 0""",
    ),
    "f_runs": (
        [],
        """SELECT user_id, epoch_us(ts) // 1000 // 86400000 AS day, min(epoch_us(ts) // 1000) AS started_ms,
  max(epoch_us(ts) // 1000) AS finished_ms, count(*) AS n, count(*) FILTER (value > 10) AS audio_n FROM events GROUP BY ALL""",
    ),
}


def with_views(body: str, **more: str) -> str:
    """body, a SELECT, after the common table expressions that it or those names, in order."""
    import re

    known = {k: v[1] for k, v in SQL.items()} | more
    order: list[str] = []

    def need(text: str) -> None:
        for name in known:
            if name not in order and re.search(rf"\b{name}\b", text) and known[name] != text:
                need(known[name])
                if name not in order:
                    order.append(name)

    need(body)
    return ("WITH " + ",\n".join(f"{k} AS ({known[k]})" for k in order) + "\n" if order else "") + body
