"""Queries of the smaller operators: word predicates, thresholds, lists cut by rank, sets of flags and stages, sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.functions import text as T
from cadenza.operators import grouping as G
from cadenza.operators import integrity as J
from cadenza.operators import intervals as I
from cadenza.operators import rollup as A
from cadenza.operators import similarity as S
from cadenza.operators import words as W
from cadenza.plans.registry import CORE, NORM, clamped, query
from cadenza.sources import sinks
from cadenza.sources import views as V

ADVISORY = ", ".join(f"'{f}'" for f in T.ADVISORY_COMPLETENESS)
#: Many report rows to a video, so that lists cut by rank are cut: orders dealt to 40 videos, ids in the order of orders.
WIDE = "video_id % 40 AS video_id, video_id * 10 + id AS id, video_id * 10 + group_id AS group_id"


def wide_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = V.report(spark, sf_dir)
    rest = [c for c in r.columns if c not in ("video_id", "id", "group_id")]
    return r.selectExpr(*WIDE.split(", "), *rest)


def wide_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = wide_report(spark, sf_dir)
    return r.select("video_id", "id", F.concat(F.lit("line "), F.col("id").cast("string")).alias("text"), (F.col("id") * 1000).alias("start_ms"), (F.col("id") * 1000 + 900).alias("end_ms"))


# Words


@query("fn2_core", f"SELECT {CORE % 'word'} AS core, count(*) AS n FROM f_words GROUP BY 1")
def _(spark, d):
    return V.words(spark, d).groupBy(T.core(F.col("word")).alias("core")).agg(F.count("*").alias("n"))


@query("fn3_sentence_ends", "SELECT video_id, seq, ends FROM ends")
def _(spark, d):
    return W.sentence_ends(clamped(spark, d)).select("video_id", "seq", "ends")


@query("fn10_unmarked", r"SELECT video_id, id, regexp_matches(text, '[0-9A-Za-z]') AS spoken_latin, regexp_matches(replace(text, '|', ' '), '[0-9A-Za-z]') AND NOT id % 2 = 0 AS marked_latin FROM f_sentences")
def _(spark, d):
    """Plain lines, and lines marked up as a whole: their spoken side is empty for even ids."""
    flat = F.regexp_replace("text", r"[\[\]|]", " ")
    marked = F.concat(F.lit("[["), flat, F.lit("|"), F.when(F.col("id") % 2 == 0, "").otherwise(flat), F.lit("]]"))
    s = V.sentences(spark, d)
    return s.select("video_id", "id", T.has_unmarked(F.col("text")).alias("spoken_latin"), T.has_unmarked(marked).alias("marked_latin"))


@query("fn38_unit_threshold", "SELECT video_id, id, CASE WHEN combined_milli > 1000 THEN 950 ELSE 900 END AS threshold_milli FROM f_report")
def _(spark, d):
    least = T.unit_threshold(F.col("combined_milli") / 1000, 0.9, 0.95)
    return V.report(spark, d).select("video_id", "id", F.round(least * 1000).cast("bigint").alias("threshold_milli"))


@query("fn36_pause_markup", r"""SELECT video_id, lead, CASE WHEN len(parts) = len(gaps) + 1 THEN parts[1] || CASE WHEN len(gaps) = 0 THEN ''
  WHEN gaps[1] < 120 THEN ' ' || parts[2] ELSE ' <break time="' || least(gaps[1], 2000) || 'ms"/> ' || parts[2] END END AS ssml FROM (
  SELECT video_id, lead, gaps, string_split(regexp_replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '([.!?…]) +', E'\\1\x01', 'g'), E'\x01') AS parts FROM (
    SELECT video_id, id - id % 2 AS lead, string_agg(text, ' ' ORDER BY id) AS text, list_filter(list(gap ORDER BY id), lambda g: g IS NOT NULL) AS gaps FROM (
      SELECT *, start_ms - lag(end_ms) OVER (PARTITION BY video_id, id - id % 2 ORDER BY id) AS gap FROM f_sentences) GROUP BY ALL))""")
def _(spark, d):
    rows = F.array_sort(F.collect_list(F.struct("id", "text", "start_ms", "end_ms")))
    u = V.sentences(spark, d).groupBy("video_id", F.expr("id - id % 2").alias("lead")).agg(rows.alias("r"))
    text = F.array_join(F.transform("r", lambda x: x["text"]), " ")
    gaps = F.expr("transform(sequence(1, size(r) - 1), i -> r[i].start_ms - r[i - 1].end_ms)")
    none = F.array().cast("array<bigint>")
    return u.select("video_id", "lead", T.pause_markup(text, F.when(F.size("r") > 1, gaps).otherwise(none), 120, 2000).alias("ssml"))


# Units and readings


@query("gr5_units_of", """SELECT video_id, id AS lead, id::VARCHAR AS ids FROM f_report WHERE video_id % 2 = 0
UNION ALL SELECT video_id, group_id, string_agg(id::VARCHAR, ',' ORDER BY id) FROM f_report WHERE video_id % 2 = 1 GROUP BY ALL""")
def _(spark, d):
    """Orders of even number have a manifest of the old kind."""
    r = V.report(spark, d)
    old = r.where("video_id % 2 = 0").groupBy("video_id").agg(F.collect_list(F.struct("id")).alias("segments"))
    units = r.where("video_id % 2 = 1").groupBy("video_id", F.col("group_id").alias("lead")).agg(F.array_sort(F.collect_list("id")).alias("ids"))
    new = units.groupBy("video_id").agg(F.collect_list(F.struct("lead", "ids")).alias("units"))
    u = G.units_of(old.unionByName(new, allowMissingColumns=True))
    return u.select("video_id", "lead", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@query("sm5_collateral", f"""SELECT s.video_id, lo, id FROM f_sentences s JOIN (
  SELECT video_id, id AS lo, id + 2 AS hi, CASE WHEN id % 6 = 0 THEN text ELSE '' END || ' and more' AS reading FROM f_sentences WHERE id % 3 = 0) w
ON s.video_id = w.video_id AND id BETWEEN lo AND hi WHERE id % 3 <> 1 AND NOT contains({NORM % "reading"}, {NORM % "text"})""")
def _(spark, d):
    s = V.sentences(spark, d)
    reading = F.concat(F.when(F.col("id") % 6 == 0, F.col("text")).otherwise(""), F.lit(" and more"))
    w = s.where("id % 3 = 0").select("video_id", F.col("id").alias("lo"), (F.col("id") + 2).alias("hi"), reading.alias("text"))
    return S.collateral_ids(s.withColumn("seed", F.col("id") % 3 == 1), w)


# Lists cut by rank


@query("tk1_first_offenders", f"""SELECT video_id, id, array_to_string(r, ',') AS reasons FROM (
  SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY id) AS n FROM (SELECT {WIDE}, r FROM f_reasons) WHERE len(r) > 0) WHERE n <= 40""")
def _(spark, d):
    return J.offenders(wide_report(spark, d), wide_text(spark, d)).select("video_id", "id", "reasons")


@query("tk2_first_units", f"""SELECT video_id, lead, start_ms, end_ms FROM (
  SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY lead) AS n FROM (
    SELECT video_id, group_id AS lead, min(id) * 1000 AS start_ms, max(id) * 1000 + 900 AS end_ms FROM (SELECT {WIDE}, r FROM f_reasons) GROUP BY ALL HAVING max(len(r)) > 0)) WHERE n <= 500""")
def _(spark, d):
    return J.flagged_units(wide_report(spark, d), wide_text(spark, d)).select("video_id", "lead", "start_ms", "end_ms")


@query("tk5_first_holes", """SELECT video_id, n, start_ms, end_ms FROM (
  SELECT video_id, start_ms, end_ms, row_number() OVER (PARTITION BY video_id ORDER BY start_ms, end_ms) AS n FROM f_spans) WHERE n <= 20""")
def _(spark, d):
    return I.hole_windows(V.spans(spark, d)).select("video_id", "n", "start_ms", "end_ms")


@query("tk6_queue_order", "SELECT video_id, pos, count(*) OVER (ORDER BY pos) AS place FROM f_queue_ids")
def _(spark, d):
    """Ids at their first places; a place is counted by chunks of the queue, not in one window over all of it."""
    q = J.read_queue_lines(V.queue(spark, d)).withColumn("chunk", F.expr("pos div 4096"))
    sizes = q.groupBy("chunk").agg(F.count("*").alias("size"))
    before = sizes.withColumn("before", F.coalesce(F.sum("size").over(Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("chunk").orderBy("pos")) + F.col("before")
    return q.join(before, "chunk").select("video_id", "pos", place.alias("place"))


# Sets of flags and stages


@query("st2_actionable", f"SELECT video_id, id, array_to_string(list_filter(completeness_flags, lambda f: f NOT IN ({ADVISORY})), ',') AS flags FROM f_report")
def _(spark, d):
    return V.report(spark, d).select("video_id", "id", F.array_join(A.actionable(F.col("completeness_flags")), ",").alias("flags"))


@query("st4_stage_coverage", """SELECT video_id, count(*) FILTER (t AND NOT m) AS unmeasured, count(*) FILTER (m AND NOT t) AS unknown, bool_or(t) AND bool_and(t = m) AS complete FROM (
  SELECT video_id, stage, wall_ms > 50000 AS t, work_ms IS NOT NULL AS m FROM f_stage_wall) WHERE t OR m GROUP BY 1""")
def _(spark, d):
    s = V.stage_wall(spark, d)
    return A.stage_coverage(s.where("wall_ms > 50000"), s.where("work_ms is not null"))


@query("ag2_percentile", """SELECT user_id AS video_id, floor(quantile_cont(v, 0.25) + 0.01)::BIGINT AS p25, floor(quantile_cont(v, 0.5) + 0.01)::BIGINT AS p50, floor(quantile_cont(v, 0.95) + 0.01)::BIGINT AS p95
FROM (SELECT user_id, round(value * 1000)::BIGINT AS v FROM events) GROUP BY 1""")
def _(spark, d):
    v = F.round(F.col("value") * 1000).cast("bigint")
    return V.table(spark, d, "events").groupBy(F.col("user_id").alias("video_id")).agg(*(A.whole(F.percentile(v, p / 100)).alias(f"p{p}") for p in (25, 50, 95)))


# Documents


@query("fn35_required_fields", """SELECT doc_id AS video_id, CASE WHEN trim(text) <> '' THEN length(text) > 400 END AS cut, CASE WHEN coalesce(trim(text), '') = '' THEN 'text' ELSE '' END AS missing FROM documents""")
def _(spark, d):
    docs = V.table(spark, d, "documents").select(F.col("doc_id").alias("video_id"), "text", F.lit("title").alias("title"))
    good, bad = J.validate_scout(docs, {"title": 80, "text": 400})
    return good.select("video_id", F.array_contains("warnings", "text").alias("cut"), F.lit("").alias("missing")).unionByName(
        bad.select("video_id", F.lit(None).cast("boolean").alias("cut"), F.array_join("missing", ",").alias("missing"))
    )


@query("snk4_clean_lines")
def _(spark, d):
    info = V.table(spark, d, "documents").select(F.col("doc_id").alias("video_id"), F.col("source").cast("string").alias("title"))
    return sinks.clean_markdown(G.paragraphs(V.sentences(spark, d)), info)
