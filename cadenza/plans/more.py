"""Further queries: folds, similarity, spoken forms, experiment summaries and the smaller functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.functions import text as T
from cadenza.operators import alignment as L
from cadenza.operators import grouping as G
from cadenza.operators import integrity as J
from cadenza.operators import intervals as I
from cadenza.operators import rollup as A
from cadenza.operators import similarity as S
from cadenza.operators import spoken as P
from cadenza.operators import words as W
from cadenza.plans.registry import LOST, RUN_ROLLUP, clamped, query
from cadenza.sources import sinks
from cadenza.sources import views as V


# Folds


#: Lines of a video in order, one at a time; every line joins the group of the one before it or begins its own.
def folded(rows: str, begins: str, carried: str, adds: str) -> str:
    return f"""WITH RECURSIVE s AS MATERIALIZED ({rows}), g AS (
    SELECT video_id, k, k AS lead, start_ms AS since, {adds} AS held FROM s WHERE k = 1
    UNION ALL SELECT s.video_id, s.k, CASE WHEN {begins} THEN s.k ELSE g.lead END, CASE WHEN {begins} THEN s.start_ms ELSE g.since END,
      CASE WHEN {begins} THEN 0 ELSE g.held END + {adds.replace("text", "s.text")} FROM g JOIN s ON s.video_id = g.video_id AND s.k = g.k + 1
  ) SELECT {carried} FROM g JOIN s USING (video_id, k) GROUP BY video_id, lead"""


UNITS = folded(
    """SELECT *, row_number() OVER w AS k, start_ms - lag(end_ms) OVER w > 1200 OR trim(text) = '' OR trim(lag(text) OVER w) = '' AS fresh
  FROM f_sentences WINDOW w AS (PARTITION BY video_id ORDER BY id)""",
    "(s.fresh OR s.end_ms - g.since > 20000 OR g.held + length(s.text) > 600)",
    """video_id, min(id) AS lead, count(*) AS n, min_by(start_ms, k) AS start_ms, max_by(end_ms, k) AS end_ms, string_agg(text, ' ' ORDER BY k) AS text""",
    "length(text) + 1",
)
PARAGRAPHS = folded(
    """SELECT *, row_number() OVER w AS k, coalesce(start_ms - lag(end_ms) OVER w >= 1000, false) AS fresh
  FROM f_sentences WHERE trim(text) <> '' WINDOW w AS (PARTITION BY video_id ORDER BY id)""",
    "(s.fresh OR g.held >= 900)",
    "video_id, min_by(start_ms, k) AS start_ms, string_agg(text, ' ' ORDER BY k) AS text",
    "length(text) + 1",
)
CHUNKS = """SELECT video_id, chunk, s.ids[lo + 1] AS lo, s.ids[hi + 1] AS hi FROM (
  WITH RECURSIVE v AS MATERIALIZED (SELECT video_id, count(*) AS n, list(pause ORDER BY id) AS pauses FROM (
    SELECT video_id, id, greatest(coalesce(lead(start_ms) OVER (PARTITION BY video_id ORDER BY id), 0) - end_ms, 0) AS pause FROM f_sentences) GROUP BY video_id
  ), ends AS (
    SELECT *, CASE WHEN lo + 80 >= n THEN n - 1 ELSE lo + 67 + list_position(pauses[lo + 68:least(n - 1, lo + 92)], list_max(pauses[lo + 68:least(n - 1, lo + 92)])) - 1 END AS stop
    FROM (SELECT *, unnest(range(n)) AS lo FROM v)
  ), g AS (
    SELECT video_id, 0::BIGINT AS chunk, lo, CASE WHEN n - 1 - stop < 40 THEN n - 1 ELSE stop END AS hi FROM ends WHERE lo = 0
    UNION ALL SELECT g.video_id, chunk + 1, e.lo, CASE WHEN n - 1 - stop < 40 THEN n - 1 ELSE stop END FROM g JOIN ends e ON e.video_id = g.video_id AND e.lo = g.hi + 1
  ) SELECT * FROM g) JOIN (SELECT video_id, list(id ORDER BY id) AS ids FROM f_sentences GROUP BY video_id) s USING (video_id)"""
WINDOWS = """WITH RECURSIVE s AS MATERIALIZED (SELECT *, max(id) OVER (PARTITION BY video_id) AS top FROM f_sentences), g AS (
    SELECT video_id, id AS seed, id AS lo, id AS hi, true AS goes_left, start_ms, end_ms, top FROM s WHERE (video_id * 7 + id * 13) % 23 = 0
    UNION ALL SELECT g.video_id, seed, CASE WHEN g.l THEN lo - 1 ELSE lo END, CASE WHEN g.l THEN hi ELSE hi + 1 END, NOT goes_left,
      CASE WHEN g.l THEN s.start_ms ELSE g.start_ms END, CASE WHEN g.l THEN g.end_ms ELSE s.end_ms END, g.top
    FROM (SELECT *, (goes_left AND lo > 0) OR hi = top AS l FROM g WHERE end_ms - start_ms < 20000 AND (lo > 0 OR hi < top)) g
    JOIN s ON s.video_id = g.video_id AND s.id = CASE WHEN g.l THEN lo - 1 ELSE hi + 1 END
  ) SELECT video_id, seed, lo, hi FROM g WHERE end_ms - start_ms >= 20000 OR (lo = 0 AND hi = top)"""


@query("gr1_build_units", f"SELECT * FROM ({UNITS})")
def _(spark, d):
    u = G.build_units(V.sentences(spark, d))
    return u.select("video_id", "lead", F.size("ids").alias("n"), "start_ms", "end_ms", "text")


@query("gr2_plan_chunks", CHUNKS)
def _(spark, d):
    return G.plan_chunks(V.sentences(spark, d))


@query("gr3_paragraphs", f"SELECT * FROM ({PARAGRAPHS})")
def _(spark, d):
    return G.paragraphs(V.sentences(spark, d))


@query("gr4_id_runs", """SELECT video_id, min(id) AS lo, max(id) AS hi FROM (
  SELECT video_id, id, id - row_number() OVER (PARTITION BY video_id ORDER BY id) AS run FROM (SELECT DISTINCT video_id, id FROM f_draft)) GROUP BY video_id, run""")
def _(spark, d):
    return G.id_runs(V.draft(spark, d))


@query("iv10_split_cues")
def _(spark, d):
    return G.split_cues(V.sentences(spark, d))


@query("iv12_widen", f"SELECT * FROM ({WINDOWS})")
def _(spark, d):
    s = V.sentences(spark, d)
    return G.widen(s.where(V.mixed("video_id", "id", 23) == 0), s)


@query("iv11_source_timed_rows", "SELECT video_id, id, start_ms, end_ms FROM f_sentences WHERE trim(text) <> ''")
def _(spark, d):
    s = V.sentences(spark, d)
    return s.where("start_ms is not null and end_ms is not null and trim(text) <> ''").select("video_id", "id", "start_ms", "end_ms")


@query("iv15_clamp_into", "SELECT video_id, id, least(greatest(start_ms - 500, 1000), 60000) AS start_ms, least(greatest(end_ms - 500, 1000), 60000) AS end_ms FROM f_sentences")
def _(spark, d):
    at = lambda c: F.least(F.greatest(F.col(c) - 500, F.lit(1000)), F.lit(60000)).alias(c)
    return V.sentences(spark, d).select("video_id", "id", at("start_ms"), at("end_ms"))


# Similarity


@query("sm1_duplicate_adjacent")
def _(spark, d):
    return S.duplicate_adjacent(V.sentences(spark, d))


@query("sm1_equal_adjacent", """SELECT video_id, id FROM (SELECT *, lead(text) OVER (PARTITION BY video_id ORDER BY id) AS nxt FROM f_sentences) WHERE text = nxt AND length(text) > 25""")
def _(spark, d):
    from pyspark.sql import Window

    s = V.sentences(spark, d).withColumn("nxt", F.lead("text").over(Window.partitionBy("video_id").orderBy("id")))
    return s.where("text = nxt and char_length(text) > 25").select("video_id", "id")


def other_words(spark, d):
    w = V.words(spark, d).where("if(video_id % 41 = 0, seq < 0, seq % 19 <> 0)")  # in one condition, so that texts are dealt once for both sides
    return w.withColumn("word", F.when(F.col("seq") % 23 == 0, F.reverse(F.lower("word"))).otherwise(F.col("word")))


@query("sm7_align_words")
def _(spark, d):
    return L.align_words(V.words(spark, d), other_words(spark, d), V.text_tasks(spark, d))


@query("sm8_diff_hunks")
def _(spark, d):
    return L.diff_hunks(V.words(spark, d), other_words(spark, d), tasks=V.text_tasks(spark, d))


@query("ag23_compare_summary")
def _(spark, d):
    return L.compare_summary(L.align_words(V.words(spark, d), other_words(spark, d), V.text_tasks(spark, d)))


@query("tk3_worst_pairs")
def _(spark, d):
    return L.compare_transcripts(V.words(spark, d), other_words(spark, d), tasks=V.text_tasks(spark, d))


@query("sm2_pair_ratio")
def _(spark, d):
    p = V.pairs(spark, d)
    return p.select("video_id", "id", S.seq_ratio("src", "tgt").alias("ratio"), S.containment("src", "tgt").alias("inside"))


NORM = r"regexp_replace(lower(%s), '[^\p{L}\p{N}\p{M}_]', '', 'g')"


@query("sm4_readings_agree", f"""SELECT video_id, lo, coalesce(a = b AND a <> '', false) AS agree FROM (
  SELECT video_id, lo, {NORM % "string_agg(word, '' ORDER BY seq)"} AS a, {NORM % "string_agg(CASE WHEN video_id % 3 = 0 AND seq % 40 = 7 THEN word || 'x' WHEN regexp_full_match(word, '[ -~]+') THEN upper(word) ELSE word || '.' END, '' ORDER BY seq)"} AS b
  FROM (SELECT *, seq // 20 * 20 AS lo FROM f_words) GROUP BY ALL)""")
def _(spark, d):
    w = V.words(spark, d).withColumn("lo", F.expr("seq div 20 * 20"))
    b = w.withColumn("word", F.expr("case when video_id % 3 = 0 and seq % 40 = 7 then word || 'x' when word rlike '^[ -~]+$' then upper(word) else word || '.' end"))
    return S.readings_agree(w, b)


@query("sm6_repair_decisions", f"""SELECT video_id, id, CASE WHEN end_ms - start_ms <= 0 THEN 'empty_span' WHEN id % 11 = 0 THEN 'error' WHEN {NORM % "src"} <> {NORM % "tgt"} THEN 'readings_differ'
  WHEN {NORM % "src"} = '' THEN 'empty_reading' ELSE 'accepted' END AS outcome FROM (SELECT *, text AS src, CASE WHEN id % 5 = 0 THEN text || ' more' ELSE lower(text) END AS tgt FROM f_sentences)""")
def _(spark, d):
    s = V.sentences(spark, d)
    w = s.select("video_id", "id", (F.col("end_ms") - F.col("start_ms")).alias("span_ms"), F.expr("case when id % 11 = 0 then 'x' end").alias("error"),
                 F.col("text").alias("reading_a"), F.expr("case when id % 5 = 0 then text || ' more' else lower(text) end").alias("reading_b"), F.col("text").alias("old"))
    return S.repair_decisions(w).select("video_id", "id", "outcome")


@query("sm9_verify_units")
def _(spark, d):
    u = G.build_units(V.sentences(spark, d)).select("video_id", "lead", "ids", F.col("text").alias("ref"))
    hyp = u.where("lead % 7 <> 0").select("video_id", "lead", F.when(F.col("lead") % 5 == 0, F.substring("ref", 1, 20)).when(F.col("lead") % 11 != 0, F.upper("ref")).alias("hyp"))
    return S.verify_units(u, hyp).select("video_id", "id", "flag")


# Spoken forms


@query("fn20_normalize_spoken")
def _(spark, d):
    return P.normalize_spoken(V.pairs(spark, d), "src").select("video_id", "id", "spoken")


@query("fn21_normalize_compare")
def _(spark, d):
    return P.normalize_compare(V.pairs(spark, d), "src").select("video_id", "id", "compared")


@query("ag9_token_audit")
def _(spark, d):
    return P.token_audit(V.pairs(spark, d).withColumn("text", F.col("src")), "text").select("video_id", "token", "count", "via", "out")


@query("fn24_spell_numbers")
def _(spark, d):
    n = V.table(spark, d, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"\d+(?:[.,]\d+)?"), F.lit(0))).alias("number"))
    return P.spell_numbers(n.distinct())


@query("jn18_rederive_diff")
def _(spark, d):
    s = P.normalize_spoken(V.pairs(spark, d), "src")
    kept = s.withColumn("stored", F.when(V.mixed("video_id", "id", 13) == 0, F.col("src")).otherwise(F.col("spoken")))
    return J.rederive_diff(kept, "stored", F.col("spoken")).select("video_id", "id")


# Translation and smaller functions


@query("jn1_build_translation", """SELECT s.video_id, s.id, CASE WHEN d.id IS NULL THEN 'pending' ELSE 'failed' END AS status,
  CASE WHEN d.id IS NOT NULL THEN CASE WHEN trim(d.text) = '' THEN 'empty' ELSE 'no_cyrillic' END END AS flag
FROM f_sentences s LEFT JOIN f_draft d USING (video_id, id)""")
def _(spark, d):
    return J.build_translation(V.sentences(spark, d), V.draft(spark, d).withColumnRenamed("text", "text_ru")).select("video_id", "id", "status", "flag")


@query("fn8_dual_form", r"""SELECT video_id, id, md5(regexp_replace(t, '\[\[([^\[\]|]*)\|([^\[\]|]*)\]\]', '\1', 'g')) AS written, md5(regexp_replace(t, '\[\[([^\[\]|]*)\|([^\[\]|]*)\]\]', '\2', 'g')) AS spoken,
  len(regexp_extract_all(t, '\[\[[^\[\]|]*\|[^\[\]|]*\]\]')) AS n FROM (SELECT video_id, id, '[[' || id || '|' || text || ']] and ' || text AS t FROM f_sentences)""")
def _(spark, d):
    s = V.sentences(spark, d)
    t = F.concat(F.lit("[["), F.col("id").cast("string"), F.lit("|"), "text", F.lit("]] and "), "text")
    return s.withColumn("t", t).select("video_id", "id", F.md5(T.written_form(F.col("t"))).alias("written"), F.md5(T.spoken_form(F.col("t"))).alias("spoken"), T.dual_count(F.col("t")).cast("bigint").alias("n"))


@query("fn9_clamp_source", """SELECT doc_id, CASE WHEN source IS NOT NULL AND source <> '' AND source NOT IN ('src0', 'src1') THEN 'unknown' ELSE source END AS src,
  CASE WHEN length(n) > 200 THEN rtrim(substring(n, 1, 200)) || ' …[truncated]' ELSE n END AS note FROM (SELECT *, CASE WHEN source IS NOT NULL AND source <> '' AND source NOT IN ('src0', 'src1')
  THEN '[raw src=' || source || '] ' || coalesce(text, '') ELSE text END AS n FROM documents)""")
def _(spark, d):
    src, note = T.clamp_source(F.col("source"), F.col("text"), ["src0", "src1"])
    return V.table(spark, d, "documents").select("doc_id", src.alias("src"), note.alias("note"))


@query("fn22_plural_form", """SELECT n, CASE WHEN n % 100 BETWEEN 11 AND 14 THEN 'many' WHEN n % 10 = 1 THEN 'one' WHEN n % 10 BETWEEN 2 AND 4 THEN 'few' ELSE 'many' END AS form, count(*) AS k
FROM (SELECT doc_id % 200 AS n FROM documents) GROUP BY 1""")
def _(spark, d):
    n = V.table(spark, d, "documents").select((F.col("doc_id") % 200).alias("n")).groupBy("n").agg(F.count("*").alias("k"))
    return n.withColumn("form", T.plural_form(F.col("n"), "one", "few", "many"))


@query("fn12_negation_lost", f"SELECT {LOST} AS lost, count(*) AS n FROM f_pairs GROUP BY 1")
def _(spark, d):
    p = V.pairs(spark, d)
    return p.groupBy(T.negation_lost(F.col("src"), F.col("tgt")).alias("lost")).agg(F.count("*").alias("n"))


@query("fn6_latin_prose")
def _(spark, d):
    return V.sentences(spark, d).groupBy("video_id").agg(F.sum(T.latin_prose_chars(F.col("text"))).alias("chars"))


@query("fn19_script_drift", r"""SELECT video_id, abs(a - b) AS drift_milli, abs(a - b) >= 300 AS drift FROM (SELECT video_id,
  sum(len(regexp_extract_all(text, '[^\x00-\x7F]')))::BIGINT * 1000 // nullif(sum(length(text)), 0)::BIGINT AS a,
  sum(len(regexp_extract_all(substring(text, 1, 20), '[^\x00-\x7F]')))::BIGINT * 1000 // nullif(sum(length(substring(text, 1, 20))), 0)::BIGINT AS b FROM f_sentences GROUP BY 1)""")
def _(spark, d):
    (n1, m1), (n2, m2) = [(F.sum(F.regexp_count(c, F.lit(r"[^\x00-\x7F]"))), F.sum(F.char_length(c))) for c in (F.col("text"), F.substring("text", 1, 20))]
    g = V.sentences(spark, d).groupBy("video_id").agg(n1.alias("n1"), m1.alias("m1"), n2.alias("n2"), m2.alias("m2"))
    drift = F.expr("abs(n1 * 1000 div nullif(m1, 0) - n2 * 1000 div nullif(m2, 0))")
    return g.select("video_id", drift.alias("drift_milli"), (drift >= 300).alias("drift"))


@query("fn30_safe_filename", r"""SELECT page_id, CASE WHEN c = '' THEN '_' WHEN upper(split_part(c, '.', 1)) IN ('CON', 'PRN', 'AUX', 'NUL') THEN '_' || c ELSE c END AS name FROM (
  SELECT page_id, regexp_replace(substring(trim(regexp_replace(url, '[<>:"/\\|?*\x00-\x1f]', '_', 'g')), 1, 120), '[. ]+$', '') AS c FROM pages)""")
def _(spark, d):
    return V.table(spark, d, "pages").select("page_id", T.safe_filename(F.col("url")).alias("name"))


@query("fn31_key_core", r"""SELECT doc_id, 'asr|lang=' || lang || '|cond=' || (doc_id % 2) || '|src=' || source AS key, 'asr|lang=' || lang || '|src=' || source AS core FROM documents""")
def _(spark, d):
    key = F.concat(F.lit("asr|lang="), "lang", F.lit("|cond="), (F.col("doc_id") % 2).cast("string"), F.lit("|src="), "source")
    return V.table(spark, d, "documents").select("doc_id", key.alias("key"), T.key_core(key).alias("core"))


@query("fn34_summary_fields", r"""SELECT doc_id, md5(t) AS summary, substring(regexp_extract(t, '^[^.!?\n]*[.!?]?'), 1, 200) AS one_liner FROM (
  SELECT doc_id, nullif(substring(trim(regexp_replace(regexp_replace(text, '(?m)^#{1,6}[ \t]+', '', 'g'), '\n{3,}', E'\n\n', 'g')), 1, 4000), '') AS t FROM documents)""")
def _(spark, d):
    f = T.summary_fields(F.col("text"))
    return V.table(spark, d, "documents").select("doc_id", F.md5(f["summary"]).alias("summary"), f["one_liner"].alias("one_liner"))


@query("fn37_target_chars", "SELECT video_id, lead, CASE WHEN slot IS NOT NULL THEN greatest(floor((slot // 24 - 163) * 1985 / 100000), 0)::BIGINT END AS chars FROM f_placed")
def _(spark, d):
    p = I.place_units(V.units(spark, d)).withColumn("slot_ms", F.expr("slot div 24"))
    return p.select("video_id", "lead", T.target_chars(F.col("slot_ms"), F.lit(163), F.lit(1985)).alias("chars"))


@query("fn40_lowpass", "SELECT doc_id, coalesce(n_chars > 0 AND n_chars * 10 < 24000 * 4, false) AS applies FROM documents")
def _(spark, d):
    return V.table(spark, d, "documents").select("doc_id", T.lowpass_applies(F.col("n_chars"), F.lit(24000)).alias("applies"))


@query("snk3_transcript_lines", """SELECT video_id, id AS n, '[' || CASE WHEN start_ms >= 3600000 THEN format('{:d}:{:02d}:{:02d}', start_ms // 3600000, start_ms // 60000 % 60, start_ms // 1000 % 60)
  ELSE format('{:d}:{:02d}', start_ms // 60000, start_ms // 1000 % 60) END || '] ' || text AS line FROM f_sentences
UNION ALL SELECT doc_id, -1, '# ' || source FROM documents UNION ALL SELECT doc_id, 0, '(no speech)' FROM documents WHERE doc_id NOT IN (SELECT video_id FROM f_sentences)""")
def _(spark, d):
    info = V.table(spark, d, "documents").select(F.col("doc_id").alias("video_id"), F.col("source").alias("title"))
    return sinks.transcript_lines(V.sentences(spark, d), info.withColumn("title", F.col("title").cast("string")))


@query("snk8_batch_table", f"""SELECT video_id, n_rows::VARCHAR AS "rows", n_units::VARCHAR AS units, coalesce(median::VARCHAR, '—') || '/' || coalesce(p95::VARCHAR, '—') AS speed,
  CASE WHEN needs_triage THEN 'listen' ELSE 'ok' END AS triage, flags_actionable || ' of ' || flags_total AS flags FROM ({RUN_ROLLUP})""")
def _(spark, d):
    return sinks.batch_table(A.run_rollup(V.report(spark, d)))


# Roll-ups


@query("ag6_source_rollup", """SELECT doc_id % 50 AS video_id, bool_and(source IS NOT NULL) AS scanned, count(*) FILTER (source = 'src0') AS n_src0, count(*) FILTER (source = 'src1') AS n_src1,
  count(*) FILTER (source NOT IN ('src0', 'src1')) AS n_unknown FROM documents GROUP BY 1""")
def _(spark, d):
    t = V.table(spark, d, "documents").select((F.col("doc_id") % 50).alias("video_id"), F.col("doc_id").alias("id"), F.col("source").alias("src"))
    return A.source_rollup(t, ["src0", "src1"]).drop("ids")


@query("ag16_run_window", """SELECT user_id * 100000 + day AS run_id, finished_ms - started_ms AS elapsed_ms, CASE WHEN user_id % 3 <> 0 THEN user_id * 1000 END AS audio_ms, CASE WHEN user_id % 3 <> 0 AND user_id > 0 THEN 1 ELSE 0 END AS audio_n FROM f_runs WHERE user_id > 0""")
def _(spark, d):
    r = V.runs(spark, d).where("user_id > 0").select((F.col("user_id") * 100000 + F.col("day")).alias("run_id"), "started_ms", "finished_ms", F.array("user_id").alias("ids"))
    info = V.runs(spark, d).select(F.col("user_id").alias("video_id"), F.when(F.col("user_id") % 3 != 0, F.col("user_id") * 1000).alias("dur_ms")).distinct()
    return A.run_window(r, info)


@query("ag19_unit_counters", """SELECT l_orderkey AS video_id, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS flagged, count(*) FILTER (l_quantity > 25) AS retried, count(*) FILTER (l_quantity > 25 AND l_returnflag <> 'R') AS repaired FROM lineitem GROUP BY 1""")
def _(spark, d):
    li = V.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("video_id"), F.when(F.col("l_quantity") > 25, 2).otherwise(1).alias("attempts"), F.when(F.col("l_returnflag") == "R", "x").alias("verify_flag"))
    return A.unit_counters(li)


CELLS = "SELECT user_id % 6 AS video, event_type AS variant, event_id % 4 AS rep, round(value * 1000)::BIGINT AS work_ms FROM events WHERE event_type IN ('click', 'view')"


def cells(spark, d):
    return V.table(spark, d, "events").where("event_type in ('click', 'view')").select(
        (F.col("user_id") % 6).alias("video"), F.col("event_type").alias("variant"), (F.col("event_id") % 4).alias("repeat"), F.round(F.col("value") * 1000).cast("bigint").alias("work_ms")
    )


@query("ag20_ab_times", f"SELECT video, variant, min(work_ms) AS work_ms, count(*) AS n FROM ({CELLS}) GROUP BY ALL")
def _(spark, d):
    return A.ab_times(cells(spark, d))


@query("ag20_ab_summary")
def _(spark, d):
    t = V.table(spark, d, "documents").select(
        F.expr("doc_id div 4").alias("video"), F.concat(F.lit("v"), (F.col("doc_id") % 2).cast("string")).alias("variant"), F.expr("doc_id % 4 div 2").alias("repeat"), "text"
    )
    return S.ab_summary(t)


@query("ag21_claim_verdicts", f"""SELECT video, metric, CASE WHEN a_lo > b_hi THEN 'confirms' WHEN a_hi < b_lo THEN 'against' ELSE 'overlap' END AS verdict FROM (
  SELECT video, 'work' || rep AS metric, min(CASE WHEN variant = 'click' THEN work_ms END) AS a_lo, max(CASE WHEN variant = 'click' THEN work_ms END) AS a_hi,
    min(CASE WHEN variant = 'view' THEN work_ms END) AS b_lo, max(CASE WHEN variant = 'view' THEN work_ms END) AS b_hi FROM ({CELLS}) GROUP BY ALL) WHERE a_lo IS NOT NULL AND b_lo IS NOT NULL""")
def _(spark, d):
    c = cells(spark, d).select("video", "variant", F.concat(F.lit("work"), F.col("repeat").cast("string")).alias("metric"), F.col("work_ms").alias("value"))
    return A.claim_verdicts(c, "click", "view")


@query("ag22_block_order", """SELECT rep * size + CASE WHEN rep % 2 = 1 THEN size - 1 - n ELSE n END AS position, variant, rep AS repeat FROM (
  SELECT event_type AS variant, row_number() OVER (ORDER BY event_type) - 1 AS n, count(*) OVER () AS size FROM (SELECT DISTINCT event_type FROM events)), (SELECT unnest(range(3)) AS rep)""")
def _(spark, d):
    from pyspark.sql import Window

    v = V.table(spark, d, "events").select(F.col("event_type").alias("variant")).distinct()
    return A.block_order(v.withColumn("n", F.row_number().over(Window.orderBy("variant")) - 1), 3)


@query("ag24_overlap_summary", """SELECT mode, n, ms // n AS mean_ms, (max(CASE WHEN mode = 'serial' THEN ms // n END) OVER ()) * 100 // nullif(ms // n, 0) AS speedup_centi FROM (
  SELECT CASE WHEN event_type = 'click' THEN 'serial' ELSE 'parallel' END AS mode, count(*) AS n, sum(round(value * 1000)::BIGINT)::BIGINT AS ms FROM events GROUP BY 1)""")
def _(spark, d):
    e = V.table(spark, d, "events").select(F.when(F.col("event_type") == "click", "serial").otherwise("parallel").alias("mode"), F.round(F.col("value") * 1000).cast("bigint").alias("wall_ms"))
    return A.overlap_summary(e)


# Reports, sets and state


@query("jn10_stale_reports", "SELECT user_id AS video_id FROM (SELECT DISTINCT user_id FROM events) WHERE user_id % 4 = 0 OR user_id % 5 = 0")
def _(spark, d):
    m = V.table(spark, d, "events").select(F.col("user_id").alias("video_id")).distinct().withColumn("synth_key", F.lit("a")).withColumn("fit_key", F.lit("f"))
    stamped = m.where("video_id % 5 <> 0").withColumn("synth_key", F.when(F.col("video_id") % 4 == 0, "b").otherwise("a"))
    return J.stale_reports(stamped, m, ["synth_key", "fit_key"])


@query("jn11_provenance_audit", "SELECT doc_id AS video_id, CASE WHEN doc_id % 3 = 0 OR doc_id % 4 = 1 THEN 'ok' WHEN doc_id % 4 = 2 THEN 'condition' ELSE 'mixed' END AS state FROM documents")
def _(spark, d):
    key = F.when(F.col("doc_id") % 3 == 0, None).when(F.col("doc_id") % 4 == 1, "m|cond=1|x").when(F.col("doc_id") % 4 == 2, "m|cond=0|x").otherwise("n|cond=1|x")
    return J.provenance_audit(V.table(spark, d, "documents").select(F.col("doc_id").alias("video_id"), key.alias("asr_key")), "m|cond=1|x")


@query("jn17_stamp_repaired", """SELECT doc_id AS video_id, doc_id % 3 + coalesce(k, 0) AS n_windows, CASE WHEN doc_id % 2 = 0 THEN CASE WHEN coalesce(k, 0) > 0 THEN 'mixed' ELSE 'key' END END AS asr_key
FROM documents LEFT JOIN (SELECT doc_id, count(*) AS k FROM labels GROUP BY 1) l USING (doc_id)""")
def _(spark, d):
    detail = V.table(spark, d, "documents").select(F.col("doc_id").alias("video_id"), (F.col("doc_id") % 3).alias("n_windows"), F.when(F.col("doc_id") % 2 == 0, "key").alias("asr_key"))
    return J.stamp_repaired(detail, V.table(spark, d, "labels").select(F.col("doc_id").alias("video_id")))


@query("st3_seed_union", """SELECT video_id, id, string_agg(DISTINCT reason, ',' ORDER BY reason) AS reasons FROM (
  SELECT video_id, id, 'rate' AS reason FROM f_sentences WHERE length(text) >= 20 AND end_ms > start_ms AND length(text) * 1000 > 40 * (end_ms - start_ms)
  UNION ALL SELECT video_id, id, 'short' FROM f_sentences WHERE length(text) < 8) GROUP BY ALL""")
def _(spark, d):
    s = V.sentences(spark, d)
    rate = s.where(T.implausible_rate_centi(F.col("text"), F.col("end_ms") - F.col("start_ms")).isNotNull()).select("video_id", "id", F.lit("rate").alias("reason"))
    short = s.where(F.char_length("text") < 8).select("video_id", "id", F.lit("short").alias("reason"))
    return rate.unionByName(short).groupBy("video_id", "id").agg(F.array_join(F.array_sort(F.collect_set("reason")), ",").alias("reasons"))


@query("st5_queue_guards", "SELECT page_id, url LIKE '%&list=%' OR url LIKE '%?list=%' AS has_list FROM pages")
def _(spark, d):
    return V.table(spark, d, "pages").select("page_id", F.col("url").rlike("[?&]list=").alias("has_list"))


@query("cl2_status_counts", "SELECT o_orderstatus AS status, count(*) AS n, CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'P' THEN 1 ELSE 0 END AS exit FROM orders GROUP BY 1")
def _(spark, d):
    return A.status_counts(V.table(spark, d, "orders").select(F.col("o_orderstatus").alias("status")), ["F"], ["P"])


@query("cl4_no_speech", "SELECT doc_id AS video_id, count(id) = 0 AS no_speech FROM documents LEFT JOIN f_sentences ON video_id = doc_id GROUP BY 1")
def _(spark, d):
    n = V.sentences(spark, d).groupBy("video_id").agg(F.count("*").alias("n"))
    j = V.table(spark, d, "documents").select(F.col("doc_id").alias("video_id")).join(n, "video_id", "left")
    return j.select("video_id", (F.coalesce("n", F.lit(0)) == 0).alias("no_speech"))


@query("cl5_status_line", "SELECT doc_id AS video_id, coalesce(n, 0) || ' sentences, ' || CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'ok' ELSE 'pending' END AS line FROM documents LEFT JOIN (SELECT video_id, count(*) AS n FROM f_sentences GROUP BY 1) ON video_id = doc_id")
def _(spark, d):
    n = V.sentences(spark, d).groupBy("video_id").agg(F.count("*").alias("n"))
    done = V.table(spark, d, "labels").select(F.col("doc_id").alias("video_id"), F.lit("ok").alias("s")).distinct()
    j = V.table(spark, d, "documents").select(F.col("doc_id").alias("video_id")).join(n, "video_id", "left").join(done, "video_id", "left")
    return j.select("video_id", F.concat(F.coalesce("n", F.lit(0)).cast("string"), F.lit(" sentences, "), F.coalesce("s", F.lit("pending"))).alias("line"))


@query("ss1_gate_batch_twin", "SELECT video_id, count(*) AS n FROM f_draft WHERE (video_id, id) IN (SELECT video_id, id FROM f_sentences) GROUP BY 1")
def _(spark, d):
    j = V.draft(spark, d).join(V.sentences(spark, d).select("video_id", "id"), ["video_id", "id"], "left_semi")
    return j.groupBy("video_id").agg(F.count("*").alias("n"))


@query("ws8_sentence_count")
def _(spark, d):
    return W.resegment(clamped(spark, d)).groupBy("video_id").agg(F.count("*").alias("n"))


@query("ag15_summarize_time", """SELECT o_orderkey AS video_id, CASE WHEN t >= m THEN t - greatest(m, coalesce(lag(t) OVER (PARTITION BY m ORDER BY t, o_orderkey), m)) END AS took_ms
FROM (SELECT o_orderkey, o_custkey % 20 * 1000 AS m, o_orderkey % 50 * 1000 + o_orderkey % 7 AS t FROM orders)""")
def _(spark, d):
    o = V.table(spark, d, "orders").selectExpr(
        "o_orderkey as video_id", "o_custkey % 20 * 1000 as marker_ms", "o_orderkey % 50 * 1000 + o_orderkey % 7 as draft_ms"
    )
    return A.summarize_time(o)


@query("jn15_queue_view", """SELECT page_id % 300 AS video_id, min(page_id) AS pos, CASE WHEN arg_min(kind, page_id) = 'scout' AND any_value(page_id % 300) % 2 = 0 THEN 'summarized' ELSE coalesce(any_value(kind), 'missing') END AS state
FROM pages LEFT JOIN f_kinds ON video_id = page_id % 300 GROUP BY 1""")
def _(spark, d):
    q = V.table(spark, d, "pages").groupBy((F.col("page_id") % 300).alias("video_id")).agg(F.min("page_id").alias("pos"))
    e = J.collect_entries(q, V.inventory(spark, d)).where("queued")
    docs = V.table(spark, d, "documents").select(F.col("doc_id").alias("video_id"), F.col("source").alias("title"), F.col("n_chars").alias("duration"), F.lit(None).cast("double").alias("duration_sec"), F.lit("x").alias("one_liner"), F.lit("y").alias("highlight"))
    return J.queue_view(e, docs, docs.where("video_id < 0"), docs.where("video_id % 2 = 0")).select("video_id", "pos", "state")
