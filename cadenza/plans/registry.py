"""Queries of the timed-text operators over the given tables, each with SQL that DuckDB can run where it can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions import lexicon as X
from cadenza.functions import text as T
from cadenza.operators import integrity as J
from cadenza.operators import intervals as I
from cadenza.operators import rollup as A
from cadenza.operators import words as W
from cadenza.sources import views as V
from cadenza.sources.views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

WRAP = r"""[''"“”‘’«»()\[\]{}]"""
CORE = "regexp_replace(trim(%s), '^" + WRAP + "+|" + WRAP + "+$', '', 'g')"
NORM = r"regexp_replace(lower(%s), '[^\p{L}\p{N}\p{M}_]', '', 'g')"
ABBREVIATIONS = ", ".join(f"'{a}'" for a in T.ABBREVIATIONS)

#: Whether src negates and tgt does not: whole words by letters of any script, which RE2's own word boundary does not know.
OUTSIDE = r"[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200C}\x{200D}\x{24B6}-\x{24E9}]"
IDIOMS = reduce(lambda c, i: f"replace({c}, '{i}', ' ')", T.NEGATION_IDIOMS, "lower(src)")
LOST = rf"""(regexp_matches({IDIOMS}, '(^|{OUTSIDE})({"|".join(T.NEGATION_WORDS)})($|{OUTSIDE})|n[''’]t($|{OUTSIDE})')
  AND NOT len(list_filter(regexp_extract_all(translate(lower(tgt), 'ё', 'е'), '[а-я]+'), lambda w: regexp_matches(w, '^({"|".join(T.RU_NEGATION_STARTS)})')
    AND NOT regexp_matches(w, '^({"|".join(T.RU_NOT_NEGATION)})'))) > 0)"""


def _stems(number: str) -> str:
    """First three letters of the words of a number, as numeral_stems has them."""
    listed = lambda words: "[" + ", ".join(f"'{w[:3].replace('ё', 'е')}'" for w in words) + "]"
    digits = rf"regexp_replace({number}, '^0+(.)', '\1')"
    parts = []
    for k, noun in enumerate(("мил", "тыс", None)):
        h, t, o = (f"substring(lpad({digits}, 9, '0'), {3 * k + i}, 1)::INT" for i in (1, 2, 3))
        ones = ["ноль", "одна", "две", *X.ONES[3:]] if noun == "тыс" else X.ONES
        parts += [
            f"CASE WHEN {h} > 0 THEN {listed(X.HUNDREDS)}[{h}] END", f"CASE WHEN {t} = 1 THEN {listed(X.TEENS)}[{o} + 1] WHEN {t} > 1 THEN {listed(X.TENS)}[{t} - 1] END",
            f"CASE WHEN {t} <> 1 AND {o} > 0 THEN {listed(ones)}[{o} + 1] END",
        ]
        if noun:
            parts.append(f"CASE WHEN {h} + {t} + {o} > 0 THEN '{noun}' END")
    single = f"list_transform(string_split({digits}, ''), lambda c: {listed(X.ONES)}[c::INT + 1])"
    return f"CASE WHEN {digits} = '0' THEN {listed(X.ONES[:1])} WHEN length({digits}) > 9 THEN {single} ELSE [{', '.join(parts)}] END"


#: Distinct numbers of src that tgt has neither as digits nor spelled.
MISSING = rf"""list_filter(list_distinct(regexp_extract_all(src, '\d+')), lambda x: NOT contains(tgt, x)
  AND len(list_filter({_stems("x")}, lambda s: contains(translate(lower(tgt), 'ё', 'е'), s))) = 0)"""

STEPS = {
    "clamped": f"""SELECT video_id, seq, word, greatest(start_ms, coalesce(lag(e) OVER w, 0))::BIGINT AS start_ms, e::BIGINT AS end_ms, seg_end FROM (
  SELECT *, max(greatest(end_ms, start_ms + 20, 20) - 20 * i) OVER (PARTITION BY video_id ORDER BY seq ROWS UNBOUNDED PRECEDING) + 20 * i AS e
  FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY seq) - 1 AS i FROM f_words))
WINDOW w AS (PARTITION BY video_id ORDER BY seq)""",
    "ends": rf"""SELECT *, CASE WHEN NOT regexp_matches(c, '[.!?…]$') THEN false
  WHEN regexp_matches(c, '(…|\.\.\.)$') THEN nxt IS NULL OR regexp_matches(f, '^\p{{Lu}}')
  WHEN NOT regexp_matches(c, '\.$') THEN true
  WHEN stem IN ({ABBREVIATIONS}) OR regexp_matches(stem, '^\p{{L}}$') THEN false
  WHEN nxt IS NULL OR regexp_matches(f, '^\p{{Lu}}') OR regexp_matches(f, '^\p{{Nd}}') THEN true ELSE seg_end END AS ends FROM (
  SELECT *, replace(lower(regexp_replace(c, '[.!?…]+$', '')), '.', '') AS stem, substring({CORE % "nxt"}, 1, 1) AS f FROM (
    SELECT *, {CORE % "word"} AS c, lead(word) OVER (PARTITION BY video_id ORDER BY seq) AS nxt FROM clamped))""",
    "assigned": """SELECT *, coalesce(sum(CASE WHEN ends THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY seq
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sentence FROM ends""",
    "f_holes": """SELECT video_id, s AS start_ms, start_ms AS end_ms FROM (
  SELECT *, greatest(a, coalesce(max(end_ms) OVER (PARTITION BY video_id, a, b ORDER BY start_ms, end_ms
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a)) AS s FROM (
    SELECT p.video_id, p.start_ms AS a, p.end_ms AS b, w.start_ms, w.end_ms FROM f_speech p JOIN f_words_sparse w
      ON p.video_id = w.video_id AND w.start_ms >= p.start_ms AND w.start_ms < p.end_ms
    UNION ALL SELECT video_id, start_ms, end_ms, end_ms, end_ms FROM f_speech)) WHERE start_ms - s >= 4000""",
    "f_uncovered": """SELECT video_id, min(start_ms) AS start_ms, max(end_ms) AS end_ms FROM (
  SELECT *, sum(CASE WHEN start_ms - reach <= 2000 THEN 0 ELSE 1 END) OVER (PARTITION BY video_id ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS g FROM (
    SELECT *, max(end_ms) OVER (PARTITION BY video_id ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM f_holes))
GROUP BY video_id, g""",
    "f_merged": """SELECT video_id, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS n FROM (
  SELECT *, sum(CASE WHEN start_ms - reach <= 3600000 THEN 0 ELSE 1 END) OVER (PARTITION BY video_id ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS g FROM (
    SELECT *, max(end_ms) OVER (PARTITION BY video_id ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM f_spans))
GROUP BY video_id, g""",
    "f_reasons": """SELECT *, list_filter([translate_flag, verify_flag], lambda x: x IS NOT NULL) || completeness_flags AS r FROM f_report""",
    "f_queue_ids": r"""SELECT video_id, min(pos) AS pos, count(*) AS n FROM (
  SELECT pos, CASE WHEN found <> '' THEN found ELSE substring(sha1(line), 1, 11) END AS video_id FROM (
    SELECT *, regexp_extract(line, '(?:youtu\.be/|[?&]v=|/shorts/|/embed/|/live/)([A-Za-z0-9_-]{11})(?:[^A-Za-z0-9_-]|$)', 1) AS found
    FROM (SELECT pos, trim(line) AS line FROM f_queue) WHERE line <> '' AND line NOT LIKE '#%')) GROUP BY video_id""",
    "f_kinds": """SELECT video_id, CASE WHEN r THEN 'run' WHEN s AND (t OR v) THEN 'pending' WHEN s THEN 'scout' WHEN v THEN 'fetched' ELSE 'missing' END AS kind FROM (
  SELECT video_id, bool_or(artifact = 'report') AS r, bool_or(artifact = 'translation') AS t, bool_or(artifact = 'sentences') AS s,
         bool_or(artifact = 'source_video') AS v FROM f_inventory GROUP BY video_id)""",
    "f_placed": """SELECT video_id, lead, off AS "offset", CASE WHEN raw > 0 THEN raw END AS slot,
  greatest(least(samples, CASE WHEN raw > 0 THEN raw ELSE samples END, total - off), 0) AS placed, CASE WHEN raw <= 0 THEN 'bad_slot' END AS flag,
  (end_ms - start_ms) * 24 AS span FROM (
  SELECT *, start_ms * 24 AS off, lead(start_ms * 24) OVER (PARTITION BY video_id ORDER BY lead) - start_ms * 24 AS raw,
         last_value(start_ms * 24 + samples) OVER (PARTITION BY video_id ORDER BY lead ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS total
  FROM f_units)""",
    "f_leaders": "SELECT * FROM f_report WHERE id = group_id",
    "f_floor": """SELECT video_id, sum(n) AS n_words, sum(hits) AS n_floor, max(hits) AS longest FROM (
  SELECT video_id, run, count(*) AS n, count(*) FILTER (hit) AS hits FROM (
    SELECT *, sum(CASE WHEN hit THEN 0 ELSE 1 END) OVER (PARTITION BY video_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS run FROM (
      SELECT *, coalesce(end_ms - start_ms = 20 AND start_ms = lag(end_ms) OVER (PARTITION BY video_id ORDER BY seq), false) AS hit FROM clamped))
  GROUP BY ALL) GROUP BY video_id""",
}


def query(name: str, sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"two queries are called {name}")
        QUERIES[name] = f
        if sql:
            SQL[name] = with_views(sql, **STEPS)
        return f

    return add


def clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.clamp_monotone(V.words(spark, sf_dir))


def line_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks of orders' lines as sentences."""
    from pyspark.sql import Window

    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
    w = Window.partitionBy("l_orderkey").orderBy(*order)
    li = V.table(spark, sf_dir, "lineitem").withColumn("id", F.row_number().over(w).cast("bigint") - 1)
    return li.select(
        F.col("l_orderkey").alias("video_id"), "id", F.concat("l_returnflag", "l_linestatus").alias("text"),
        (F.col("id") * 1000).alias("start_ms"), (F.col("id") * 1000 + 900).alias("end_ms"),
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences, characters a second and lines too fast to be spoken for each document."""
    s = W.sentence_table(W.collapse_runs(clamped(spark, sf_dir)))
    dur = F.col("end_ms") - F.col("start_ms")
    fast = T.implausible_rate_centi(F.col("text"), dur)
    return s.groupBy("video_id").agg(
        F.count("*").alias("n_sentences"), F.sum(F.char_length("text")).alias("chars"), F.sum(dur).alias("ms"), F.count(fast).alias("n_fast")
    )


# Words


@query("ws1_flatten_clamp", "SELECT video_id, seq, start_ms, end_ms FROM clamped")
def _(spark, d):
    return clamped(spark, d).select("video_id", "seq", "start_ms", "end_ms")


@query(
    "ws2_collapse_runs",
    rf"""SELECT video_id, seq, start_ms, CASE WHEN gone THEN last_end ELSE end_ms END AS end_ms FROM (
  SELECT *, n >= 4 OR (n >= 2 AND (short OR (lo = hi AND regexp_matches({CORE % "word"}, '[.!?…]$')))) AS gone FROM (
    SELECT *, count(*) OVER r AS n, min(end_ms - start_ms) OVER r < 20 AS short, min(word) OVER r AS lo, max(word) OVER r AS hi,
           max(end_ms) OVER r AS last_end, row_number() OVER (PARTITION BY video_id, run ORDER BY seq) AS k FROM (
      SELECT *, sum(CASE WHEN norm = prev AND norm <> '' THEN 0 ELSE 1 END) OVER (PARTITION BY video_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS run FROM (
        SELECT *, {NORM % "word"} AS norm, lag({NORM % "word"}) OVER (PARTITION BY video_id ORDER BY seq) AS prev FROM f_words))
    WINDOW r AS (PARTITION BY video_id, run))) WHERE NOT gone OR k = 1""",
)
def _(spark, d):
    return W.collapse_runs(V.words(spark, d)).select("video_id", "seq", "start_ms", "end_ms")


@query("ws3_floor_runs", "SELECT video_id, n_words::BIGINT AS n_words, n_floor::BIGINT AS n_floor, longest FROM f_floor")
def _(spark, d):
    return W.floor_run_ratio(clamped(spark, d))


@query(
    "ws4_choose_decode",
    """SELECT a.video_id, a.n_floor / a.n_words > 0.085 AS candidate,
  coalesce(a.n_floor / a.n_words > 0.085 AND b.s <= a.n_floor / a.n_words / 2, false) AS take_b
FROM f_floor a LEFT JOIN (SELECT video_id, count(*) FILTER (end_ms - start_ms = 20 AND seq % 3 = 0) / count(*) AS s FROM clamped GROUP BY 1) b USING (video_id)""",
)
def _(spark, d):
    w = clamped(spark, d)
    other = w.groupBy("video_id").agg(F.count_if((F.col("end_ms") - F.col("start_ms") == 20) & (F.col("seq") % 3 == 0)).alias("n_floor"), F.count("*").alias("n_words"))
    return W.choose_decode(W.floor_run_ratio(w), other)


@query("ws5_sentences", "SELECT video_id, count(DISTINCT sentence) AS n_sentences, count(*) FILTER (ends) AS n_ends, count(*) AS n_words FROM assigned GROUP BY video_id")
def _(spark, d):
    w = W.assign_sentences(clamped(spark, d))
    return w.groupBy("video_id").agg(F.countDistinct("sentence").alias("n_sentences"), F.count_if("ends").alias("n_ends"), F.count("*").alias("n_words"))


@query("ws5_sentence_table", "SELECT video_id, sentence::BIGINT AS id, string_agg(word, ' ' ORDER BY seq) AS text, min(start_ms) AS start_ms, max(end_ms) AS end_ms FROM assigned GROUP BY ALL")
def _(spark, d):
    return W.sentence_table(clamped(spark, d))


@query("fn4_overlong", "SELECT video_id, sentence::BIGINT AS sentence, max(end_ms) - min(start_ms) AS ms, sum(length(word) + 1)::BIGINT AS chars FROM assigned GROUP BY ALL HAVING ms > 15000 OR chars > 240")
def _(spark, d):
    return W.overlong(clamped(spark, d))


@query(
    "fn5_may_cut",
    f"""SELECT video_id, count(*) FILTER (NOT b IN ({", ".join(f"'{w}'" for w in T.STOP_WORDS)}) AND NOT coalesce(starts_with(ltrim(nxt), '-'), false)) AS n_cuts, count(DISTINCT b) AS n_bare FROM (
  SELECT *, regexp_extract(lower({CORE % "word"}), '^[a-z0-9'']+') AS b, lead(word) OVER (PARTITION BY video_id ORDER BY seq) AS nxt FROM f_words) GROUP BY video_id""",
)
def _(spark, d):
    w = V.words(spark, d).withColumn("cut", T.may_cut_after(F.col("word"), F.lead("word").over(W.in_order()))).withColumn("b", T.bare(F.col("word")))
    return w.groupBy("video_id").agg(F.count_if("cut").alias("n_cuts"), F.countDistinct("b").alias("n_bare"))


@query("fn1_norm_text", f"SELECT {NORM % 'word'} AS norm, count(*) AS n FROM f_words GROUP BY 1")
def _(spark, d):
    return V.words(spark, d).groupBy(T.norm_text(F.col("word")).alias("norm")).agg(F.count("*").alias("n"))


@query(
    "ws9_decode_windows",
    """SELECT video_id, k AS win_no, CASE WHEN dur <= 900000 THEN 0 ELSE k * 585000 END AS w_start,
  CASE WHEN dur <= 900000 THEN dur ELSE least(k * 585000 + 600000, dur) END AS w_end FROM (
  SELECT video_id, dur, unnest(range(CASE WHEN dur <= 900000 THEN 1 ELSE ceil((dur - 15000) / 585000)::BIGINT END)) AS k
  FROM (SELECT video_id, max(end_ms) AS dur FROM f_words GROUP BY 1))""",
)
def _(spark, d):
    return W.decode_windows(V.words(spark, d).groupBy("video_id").agg(F.max("end_ms").alias("dur_ms")))


@query("ws10_stitch_windows", "SELECT video_id, count(*) AS n, sum(seq)::BIGINT AS seqs FROM f_words GROUP BY 1")
def _(spark, d):
    w = V.words(spark, d)
    wins = W.decode_windows(w.groupBy("video_id").agg((F.max("end_ms") + 1).alias("dur_ms")))
    inside = I.range_join(w, wins.hint("shuffle_hash"), "start_ms", "w_start", "w_end")
    return W.stitch_windows(inside).groupBy("video_id").agg(F.count("*").alias("n"), F.sum("seq").alias("seqs"))


@query(
    "ws11_core_windows",
    """SELECT video_id, k AS i, k * 60000 AS core_from, least((k + 1) * 60000, dur) AS core_to, greatest(k * 60000 - 4000, 0) AS from_ms,
  least(least((k + 1) * 60000, dur) + 4000, dur) AS to_ms FROM (
  SELECT video_id, dur, unnest(range(greatest(ceil(dur / 60000), 1)::BIGINT)) AS k FROM (SELECT video_id, max(end_ms) AS dur FROM f_words GROUP BY 1))""",
)
def _(spark, d):
    return W.core_windows(V.words(spark, d).groupBy("video_id").agg(F.max("end_ms").alias("dur_ms")), 60_000, 4_000)


@query(
    "ws12_claim_metrics",
    rf"""SELECT a.*, dup_pairs, max_deci_cps FROM (
  SELECT video_id, count(*) AS n_words, count(*) FILTER (end_ms - start_ms = 20) AS n_floor, count(*) FILTER (term) AS n_term,
         greatest(max(end_ms - coalesce(last, first)), 0) AS longest_gap_ms FROM (
    SELECT *, last_value(CASE WHEN term THEN end_ms END IGNORE NULLS) OVER (PARTITION BY video_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last,
           first_value(start_ms) OVER (PARTITION BY video_id ORDER BY seq) AS first
    FROM (SELECT *, regexp_matches({CORE % "word"}, '(^|[.!?…])$') AS term FROM clamped)) GROUP BY video_id) a
LEFT JOIN (SELECT video_id, count(*) FILTER (norm = nxt) AS dup_pairs, max(CASE WHEN end_ms > start_ms THEN floor(length(text) * 10000 / (end_ms - start_ms)) END)::BIGINT AS max_deci_cps FROM (
    SELECT *, {NORM % "text"} AS norm, lead({NORM % "text"}) OVER (PARTITION BY video_id ORDER BY id) AS nxt FROM f_sentences) GROUP BY video_id) USING (video_id)""",
)
def _(spark, d):
    return W.claim_metrics(clamped(spark, d), V.sentences(spark, d))


@query(
    "ws13_structure_metrics",
    r"""SELECT video_id, count(*) AS n_words, count(*) FILTER (regexp_matches(regexp_replace(trim(word), '["''”’»)\]}]+$', ''), '[.!?…]$')) AS n_term,
  coalesce(max(nxt - end_ms), 0) AS gap_max_ms, sum(end_ms - start_ms)::BIGINT AS speech_ms, arg_max(end_ms, seq) - arg_min(start_ms, seq) AS span_ms,
  median(length(word)) AS word_chars_median FROM (SELECT *, lead(start_ms) OVER (PARTITION BY video_id ORDER BY seq) AS nxt FROM clamped) GROUP BY video_id""",
)
def _(spark, d):
    return W.structure_metrics(clamped(spark, d))


@query(
    "ws14_nonlatin_share",
    r"""SELECT video_id, sum(len(regexp_extract_all(word, '\p{L}')))::BIGINT AS letters,
  sum(len(list_filter(regexp_extract_all(word, '\p{L}'), lambda x: ord(x) > 127)))::BIGINT AS beyond_ascii FROM f_words GROUP BY video_id""",
)
def _(spark, d):
    return W.nonlatin_share(V.words(spark, d))


# Detectors


@query("fn11_missing_numbers", r"""SELECT video_id, id, len(m) AS n, array_to_string(m, ',') AS missing FROM (
  SELECT *, list_filter(list_distinct(regexp_extract_all(src, '\d+')), lambda x: NOT contains(tgt, x)) AS m0 FROM f_pairs), LATERAL (
  SELECT list_sort(m0) AS m) WHERE len(m) > 0""")
def _(spark, d):
    p = V.pairs(spark, d).withColumn("m", F.array_sort(T.missing_numbers(F.col("src"), F.col("tgt"))))
    return p.where(F.size("m") > 0).select("video_id", "id", F.size("m").cast("bigint").alias("n"), F.array_join("m", ",").alias("missing"))


@query("fn13_length_ratio", "SELECT video_id, id, floor(1000 * length(tgt) / nullif(length(src), 0))::BIGINT AS milli, length(src) >= 30 AND length(tgt) < 0.45 * length(src) AS short FROM f_pairs")
def _(spark, d):
    p = V.pairs(spark, d)
    return p.select("video_id", "id", T.length_ratio_milli(F.col("src"), F.col("tgt")).alias("milli"), T.length_short(F.col("src"), F.col("tgt")).alias("short"))


@query("fn14_completeness", f"""SELECT video_id, id, array_to_string(list_filter([CASE WHEN length(src) >= 30 AND length(tgt) < 0.45 * length(src) THEN 'length_short' END,
  CASE WHEN {LOST} THEN 'neg_loss' END, CASE WHEN len({MISSING}) > 0 THEN 'number_loss' END], lambda x: x IS NOT NULL), ',') AS flags FROM f_pairs""")
def _(spark, d):
    p = V.pairs(spark, d)
    return p.select("video_id", "id", F.array_join(T.completeness_flags(F.col("src"), F.col("tgt")), ",").alias("flags"))


@query("fn15_implausible_rate", """SELECT video_id, id, floor(length(text) * 100000 / (end_ms - start_ms))::BIGINT AS centi_cps FROM f_sentences
WHERE length(text) >= 20 AND end_ms > start_ms AND length(text) * 1000 > 40 * (end_ms - start_ms)""")
def _(spark, d):
    s = V.sentences(spark, d).withColumn("centi_cps", T.implausible_rate_centi(F.col("text"), F.col("end_ms") - F.col("start_ms")))
    return s.where("centi_cps is not null").select("video_id", "id", "centi_cps")


@query("fn16_missing_digits", r"""SELECT video_id, id, array_to_string(list_sort(m), ',') AS missing FROM (
  SELECT video_id, id, list_filter(list_distinct(regexp_extract_all(src, '\d+')), lambda x: NOT contains(lower(tgt), lower(x))) AS m FROM f_pairs) WHERE len(m) > 0""")
def _(spark, d):
    p = V.pairs(spark, d).withColumn("m", T.missing_tokens(F.col("src"), F.col("tgt"), T.DIGITS))
    return p.where(F.size("m") > 0).select("video_id", "id", F.array_join(F.array_sort("m"), ",").alias("missing"))


@query("fn17_cyrillic_share", r"""SELECT video_id, sum(len(regexp_extract_all(text, '\p{Cyrillic}')))::BIGINT AS cyrillic, sum(len(regexp_extract_all(text, '\p{L}')))::BIGINT AS letters,
  CASE WHEN sum(len(regexp_extract_all(text, '\p{L}'))) = 0 THEN NULL WHEN sum(len(regexp_extract_all(text, '\p{Cyrillic}'))) >= 0.7 * sum(len(regexp_extract_all(text, '\p{L}'))) THEN 'ru'
       WHEN sum(len(regexp_extract_all(text, '\p{Cyrillic}'))) <= 0.05 * sum(len(regexp_extract_all(text, '\p{L}'))) THEN 'en' END AS lang FROM f_sentences GROUP BY video_id""")
def _(spark, d):
    return A.detect_lang(V.sentences(spark, d))


@query("fn7_gate", r"""SELECT CASE WHEN trim(tgt) = '' THEN 'empty' WHEN NOT regexp_matches(tgt, '[А-Яа-яЁё]') THEN 'no_cyrillic' END AS reason, count(*) AS n FROM f_pairs GROUP BY 1""")
def _(spark, d):
    return V.pairs(spark, d).groupBy(T.translation_gate(F.col("tgt"), F.col("src")).alias("reason")).agg(F.count("*").alias("n"))


@query("fn29_video_id", "SELECT video_id, pos, n FROM f_queue_ids")
def _(spark, d):
    return J.read_queue_lines(V.queue(spark, d))


@query("fn32_units_key", "SELECT video_id, substring(sha1(string_agg(lead || ':' || samples || ':' || text, '|' ORDER BY lead)), 1, 12) AS key FROM f_units GROUP BY 1")
def _(spark, d):
    rows = F.array_sort(F.collect_list(F.struct("lead", "samples", "text")))
    text = F.array_join(F.transform(rows, lambda r: F.concat_ws(":", r["lead"], r["samples"], r["text"])), "|")
    return V.units(spark, d).groupBy("video_id").agg(F.substring(F.sha1(text), 1, 12).alias("key"))


@query("fn33_clock", """SELECT video_id, ms, CASE WHEN ms >= 3600000 THEN format('{:d}:{:02d}:{:02d}', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60) ELSE format('{:d}:{:02d}', ms // 60000, ms // 1000 % 60) END AS clock
FROM (SELECT video_id, max(end_ms) AS ms FROM f_sentences GROUP BY 1)""")
def _(spark, d):
    return V.sentences(spark, d).groupBy("video_id").agg(F.max("end_ms").alias("ms")).withColumn("clock", T.clock(F.col("ms")))


@query("snk2_srt_lines", """SELECT video_id, id, format('{:02d}:{:02d}:{:02d},{:03d} --> {:02d}:{:02d}:{:02d},{:03d}', start_ms // 3600000, start_ms // 60000 % 60, start_ms // 1000 % 60, start_ms % 1000,
  e // 3600000, e // 60000 % 60, e // 1000 % 60, e % 1000) AS times FROM (SELECT *, greatest(end_ms, start_ms + 50) AS e FROM f_sentences)""")
def _(spark, d):
    s = V.sentences(spark, d).withColumn("e", F.greatest("end_ms", F.col("start_ms") + 50))
    return s.select("video_id", "id", F.concat(T.srt_time(F.col("start_ms")), F.lit(" --> "), T.srt_time(F.col("e"))).alias("times"))


@query("fn39_tempo", """SELECT video_id, lead, CASE WHEN samples > 0 AND slot > 0 AND samples > slot THEN samples * 1000 // slot ELSE 1000 END AS req,
  CASE WHEN samples > 0 AND slot > 0 AND samples > slot THEN least(samples * 1000 // slot, 100000) ELSE 1000 END AS factor,
  CASE WHEN samples > 0 AND slot > 0 AND samples <= slot THEN least(greatest(samples * 1000 // slot, 750), 1000) ELSE 1000 END AS stretch
FROM f_units JOIN (SELECT video_id, lead, slot FROM f_placed) USING (video_id, lead)""")
def _(spark, d):
    u = V.units(spark, d)
    p = u.join(I.place_units(u).select("video_id", "lead", "slot"), ["video_id", "lead"])
    return p.select("video_id", "lead", *(v.cast("bigint").alias(k) for k, v in T.tempo_milli(F.col("samples"), F.col("slot")).items()))


# Intervals


@query("iv1_merge_intervals", "SELECT video_id, start_ms, end_ms, n FROM f_merged")
def _(spark, d):
    return I.merge_intervals(V.spans(spark, d), 3_600_000)


@query("iv2_merge_strict", """SELECT video_id, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS n FROM (
  SELECT *, sum(CASE WHEN start_ms - reach < 200 THEN 0 ELSE 1 END) OVER (PARTITION BY video_id ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS g FROM (
    SELECT *, max(end_ms) OVER (PARTITION BY video_id ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM f_words)) GROUP BY video_id, g""")
def _(spark, d):
    return I.merge_intervals(V.words(spark, d), 200, inclusive=False)


@query("iv3_uncovered_spans", "SELECT video_id, start_ms, end_ms FROM f_uncovered WHERE end_ms - start_ms >= 4000")
def _(spark, d):
    return I.uncovered_spans(V.speech(spark, d), V.sparse_words(spark, d))


@query("iv4_splice_recovered", """SELECT video_id, count(*) AS n, sum(seq)::BIGINT AS seqs FROM (
  SELECT video_id, seq FROM f_words_sparse UNION ALL SELECT w.video_id, w.seq FROM f_words w JOIN f_uncovered h ON h.video_id = w.video_id AND w.start_ms >= h.start_ms AND w.start_ms < h.end_ms
  WHERE w.seq % 60 BETWEEN 20 AND 45) GROUP BY 1""")
def _(spark, d):
    w = V.words(spark, d)
    sparse = V.sparse_words(spark, d)
    holes = I.uncovered_spans(V.speech(spark, d), sparse)
    lost = w.where((F.col("seq") % 60).between(20, 45))
    return I.splice_recovered(sparse, lost, holes).groupBy("video_id").agg(F.count("*").alias("n"), F.sum("seq").alias("seqs"))


@query("iv4_hole_windows", """SELECT * FROM (SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY start_ms, end_ms) AS n, start_ms, end_ms, greatest(start_ms - 5000, 0) AS read_from, end_ms + 5000 AS read_to
FROM f_uncovered) WHERE n <= 20""")
def _(spark, d):
    return I.hole_windows(I.uncovered_spans(V.speech(spark, d), V.sparse_words(spark, d)))


@query("iv5_hole_summary", """SELECT v.video_id, CASE WHEN v.video_id % 4 <> 0 THEN coalesce(n, 0) END AS n_holes, CASE WHEN v.video_id % 4 <> 0 THEN coalesce(ms, 0) END AS hole_ms
FROM (SELECT DISTINCT video_id FROM f_words) v LEFT JOIN (SELECT video_id, count(*) AS n, sum(end_ms - start_ms)::BIGINT AS ms FROM f_uncovered GROUP BY 1) h USING (video_id)""")
def _(spark, d):
    v = V.words(spark, d).select("video_id").distinct()
    return I.hole_summary(v, I.uncovered_spans(V.speech(spark, d), V.sparse_words(spark, d)), v.where("video_id % 4 <> 0"))


@query("iv6_subtract_intervals", """SELECT video_id, s AS start_ms, oa AS end_ms FROM (
  SELECT *, greatest(a, coalesce(max(ob) OVER (PARTITION BY video_id, a, b ORDER BY oa, ob ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a)) AS s FROM (
    SELECT s.video_id, s.start_ms AS a, s.end_ms AS b, o.start_ms AS oa, o.end_ms AS ob FROM f_merged s JOIN f_merged_short o ON o.video_id = s.video_id AND o.start_ms < s.end_ms AND s.start_ms < o.end_ms
    UNION ALL SELECT video_id, start_ms, end_ms, end_ms, end_ms FROM f_merged)) WHERE oa - s >= 250""".replace("f_merged_short", "(SELECT * FROM f_spans WHERE end_ms > start_ms)"))
def _(spark, d):
    s = V.spans(spark, d)
    return I.subtract_intervals(I.merge_intervals(s, 3_600_000), s)


@query("iv7_unit_extents", "SELECT video_id, lead, start_ms, greatest(end_ms, start_ms + samples // 24) AS end_ms FROM f_units WHERE samples > 0")
def _(spark, d):
    return I.unit_extents(V.units(spark, d))


@query("iv8_place_units", """SELECT video_id, lead, "offset", slot, placed, flag, greatest(span - placed, 0) AS span_silence, greatest(slot - placed, 0) AS slot_silence FROM f_placed""")
def _(spark, d):
    return I.place_units(V.units(spark, d))


@query("iv9_place_cues", """SELECT video_id, id, onset AS start_ms, greatest(e, coalesce(lead(onset) OVER (PARTITION BY video_id ORDER BY id), e)) AS end_ms FROM (
  SELECT *, max(s) OVER (PARTITION BY video_id ORDER BY id ROWS UNBOUNDED PRECEDING) AS onset FROM (
    SELECT *, ua + (ub - ua) * before // total AS s, ua + (ub - ua) * (before + width) // total AS e FROM (
      SELECT f.video_id, f.id, u.start_ms AS ua, greatest(u.end_ms, u.start_ms + u.samples // 24) AS ub, greatest(length(f.text), 1) AS width,
        coalesce(sum(greatest(length(f.text), 1)) OVER (PARTITION BY f.video_id, u.lead ORDER BY f.id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
        sum(greatest(length(f.text), 1)) OVER (PARTITION BY f.video_id, u.lead)::BIGINT AS total
      FROM f_sentences f JOIN f_units u ON u.video_id = f.video_id AND u.lead = f.id - f.id % 2 WHERE u.samples > 0)))""")
def _(spark, d):
    u = I.unit_extents(V.units(spark, d))
    s = V.sentences(spark, d).withColumn("lead", F.col("id") - F.col("id") % 2)
    return I.place_cues(u, s)


@query("iv13_merge_windows", """SELECT video_id, min(lo) AS lo, max(hi) AS hi, array_to_string(list_sort(list_distinct(list(reason))), ',') AS reasons FROM (
  SELECT *, sum(CASE WHEN lo <= reach + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY video_id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS g FROM (
    SELECT *, max(hi) OVER (PARTITION BY video_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM (
      SELECT video_id, greatest(id - 1, 0) AS lo, id + 1 AS hi, 'r' || id % 3 AS reason FROM f_sentences WHERE (video_id * 7 + id * 13) % 11 = 0))) GROUP BY video_id, g""")
def _(spark, d):
    s = V.sentences(spark, d).where(V.mixed("video_id", "id", 11) == 0)
    return I.merge_id_ranges(s.select("video_id", F.greatest(F.col("id") - 1, F.lit(0)).alias("lo"), (F.col("id") + 1).alias("hi"), F.array(F.concat(F.lit("r"), F.col("id") % 3)).alias("reasons")))


@query("iv14_clip_spans", """SELECT a.video_id, a.id AS lo, b.id AS hi, greatest(a.start_ms - 250, coalesce(p.end_ms, 0), 0) AS start_ms, least(b.end_ms + 250, coalesce(q.start_ms, b.end_ms + 250)) AS end_ms
FROM f_sentences a JOIN f_sentences b ON b.video_id = a.video_id AND b.id = a.id + 2 LEFT JOIN f_sentences p ON p.video_id = a.video_id AND p.id = a.id - 1
LEFT JOIN f_sentences q ON q.video_id = a.video_id AND q.id = b.id + 1 WHERE (a.video_id * 7 + a.id * 13) % 19 = 0""")
def _(spark, d):
    s = V.sentences(spark, d)
    r = s.where(V.mixed("video_id", "id", 19) == 0).select("video_id", F.col("id").alias("lo"), (F.col("id") + 2).alias("hi"))
    return I.clip_spans(r, s)


@query("iv16_span_breakdown", "SELECT user_id, count(*) AS n, sum(finished_ms - started_ms)::BIGINT AS work_ms, sum(started_ms - day * 86400000)::BIGINT AS wait_ms FROM f_runs GROUP BY 1")
def _(spark, d):
    r = I.span_breakdown(V.runs(spark, d).withColumn("enqueued_ms", F.col("day") * 86400000))
    return r.groupBy("user_id").agg(F.count("*").alias("n"), F.sum("work_ms").alias("work_ms"), F.sum("wait_ms").alias("wait_ms"))


# Joins and integrity


@query("jn2_missing_ids", "SELECT video_id, id FROM f_sentences WHERE (video_id, id) NOT IN (SELECT video_id, id FROM f_draft)")
def _(spark, d):
    return J.missing_ids(V.sentences(spark, d), V.draft(spark, d))


@query("jn3_extra_ids", "SELECT video_id, id FROM f_draft WHERE (video_id, id) NOT IN (SELECT video_id, id FROM f_sentences)")
def _(spark, d):
    return J.extra_ids(V.sentences(spark, d), V.draft(spark, d))


@query("jn4_duplicate_ids", "SELECT video_id, id, count(*) AS n FROM (SELECT video_id, id % 10000 AS id FROM f_draft) GROUP BY ALL HAVING count(*) > 1")
def _(spark, d):
    return J.duplicate_ids(V.draft(spark, d).withColumn("id", F.col("id") % 10000))


@query("jn5_join_chunks", """SELECT video_id, id, 'uncovered' AS fault FROM f_sentences WHERE (video_id * 7 + id * 13) % 29 = 0
UNION ALL SELECT video_id, id + 80, 'outside' FROM f_sentences WHERE (video_id * 7 + id * 13) % 37 = 0""")
def _(spark, d):
    s = V.sentences(spark, d).select("video_id", "id", F.expr("id div 80").alias("chunk"))
    plan = s.select("video_id", "chunk", (F.col("chunk") * 80).alias("lo"), (F.col("chunk") * 80 + 79).alias("hi")).distinct()
    chunks = s.where(V.mixed("video_id", "id", 29) != 0).unionByName(s.where(V.mixed("video_id", "id", 37) == 0).withColumn("id", F.col("id") + 80))
    return J.join_chunks(chunks.select("video_id", "chunk", "id"), plan, V.sentences(spark, d))


@query("qa1_contiguity", "SELECT video_id, count(*) AS n, count(*) = count(DISTINCT id) AND min(id) = 0 AND max(id) = count(*) - 1 AS ok FROM f_draft GROUP BY 1")
def _(spark, d):
    return J.contiguity(V.draft(spark, d))


@query("qa2_draft_ready", """SELECT d.video_id, coalesce(m, 0) AS n_missing, coalesce(n, 0) > 0 AND coalesce(m, 0) = 0 AS ready FROM (SELECT DISTINCT video_id FROM f_draft) d
LEFT JOIN (SELECT video_id, count(*) AS n FROM f_sentences GROUP BY 1) USING (video_id)
LEFT JOIN (SELECT video_id, count(*) AS m FROM f_sentences WHERE (video_id, id) NOT IN (SELECT video_id, id FROM f_draft) GROUP BY 1) USING (video_id)""")
def _(spark, d):
    return J.draft_ready(V.draft(spark, d), V.sentences(spark, d))


@query("qa3_already_built", """SELECT video_id, coalesce(max(modified_ms) FILTER (artifact = 'translation') >= coalesce(max(modified_ms) FILTER (artifact = 'sentences'), 0), false) AS built FROM f_inventory GROUP BY 1""")
def _(spark, d):
    return J.already_built(V.inventory(spark, d), "translation", "sentences")


@query("qa4_validate_ids", "SELECT d.video_id, bool_and(d.id >= 0 AND d.id < coalesce(n, 0)) AS ok FROM f_draft d LEFT JOIN (SELECT video_id, count(*) AS n FROM f_sentences GROUP BY 1) USING (video_id) GROUP BY 1")
def _(spark, d):
    return J.validate_ids(V.draft(spark, d), V.sentences(spark, d))


@query("jn6_offenders", """SELECT video_id, id, array_to_string(r, ',') AS reasons FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY id) AS n FROM f_reasons WHERE len(r) > 0) WHERE n <= 40""")
def _(spark, d):
    return J.offenders(V.report(spark, d), line_text(spark, d)).select("video_id", "id", "reasons")


@query("jn7_flagged_units", """SELECT video_id, group_id AS lead, arg_min(combined_milli, id) AS combined_milli, min(id) * 1000 AS start_ms, max(id) * 1000 + 900 AS end_ms FROM f_reasons GROUP BY ALL HAVING max(len(r)) > 0""")
def _(spark, d):
    return J.flagged_units(V.report(spark, d), line_text(spark, d)).select("video_id", "lead", "combined_milli", "start_ms", "end_ms")


@query("jn8_splice", """SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY pos, k) - 1 AS id, text FROM (
  SELECT video_id, id AS pos, -1 AS k, text FROM f_sentences WHERE id NOT IN (1, 2) UNION ALL
  SELECT video_id, 1, k, 'new ' || k FROM (SELECT DISTINCT video_id FROM f_sentences WHERE id = 2), (VALUES (0), (1), (2)) t(k) UNION ALL
  SELECT video_id, id, -1, text FROM f_sentences f WHERE id = 1 AND NOT EXISTS (SELECT 1 FROM f_sentences g WHERE g.video_id = f.video_id AND g.id = 2))""")
def _(spark, d):
    s = V.sentences(spark, d)
    win = s.where("id = 2").select("video_id", F.lit(1).cast("bigint").alias("lo"), F.lit(2).cast("bigint").alias("hi"))
    new = win.select("video_id", "lo", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k"), F.lit(0).cast("bigint").alias("start_ms"), F.lit(0).cast("bigint").alias("end_ms"))
    return J.splice(s, win, new.withColumn("text", F.concat(F.lit("new "), "k"))).select("video_id", "id", "text")


@query("jn9_stale_units", "SELECT video_id, lead FROM f_units WHERE (video_id * 7 + lead * 13) % 31 = 0")
def _(spark, d):
    s = V.sentences(spark, d)
    u = s.withColumn("lead", F.col("id") - F.col("id") % 2).groupBy("video_id", "lead").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    u = u.join(V.units(spark, d).select("video_id", "lead", "text"), ["video_id", "lead"])
    old = u.withColumn("text", F.when(V.mixed("video_id", "lead", 31) == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text")))
    return J.stale_units(old, s)


@query("jn12_reusable_units", "SELECT video_id, lead, (video_id * 7 + lead * 13) % 31 <> 0 AND lead % 6 <> 4 AS reuse FROM f_units")
def _(spark, d):
    s = V.sentences(spark, d)
    u = s.withColumn("lead", F.col("id") - F.col("id") % 2).groupBy("video_id", "lead").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    u = u.join(V.units(spark, d).select("video_id", "lead", "text"), ["video_id", "lead"])
    old = u.withColumn("text", F.when(V.mixed("video_id", "lead", 31) == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))).withColumn("failed", F.col("lead") % 6 == 4)
    return J.reusable_units(old, u)


@query("jn13_gained_tracks", "SELECT video_id, artifact FROM f_inventory WHERE NOT (artifact = 'sentences' OR modified_ms < 4000)")
def _(spark, d):
    inv = V.inventory(spark, d)
    return J.gained_tracks(inv.where("artifact = 'sentences' or modified_ms < 4000"), inv)


@query("jn14_collect_entries", """SELECT q.video_id, true AS queued, pos, coalesce(kind, 'missing') AS kind FROM (SELECT page_id % 300 AS video_id, min(page_id) AS pos FROM pages GROUP BY 1) q LEFT JOIN f_kinds USING (video_id)
UNION ALL SELECT video_id, false, NULL, kind FROM f_kinds WHERE video_id NOT IN (SELECT page_id % 300 FROM pages)""")
def _(spark, d):
    q = V.table(spark, d, "pages").groupBy((F.col("page_id") % 300).alias("video_id")).agg(F.min("page_id").alias("pos"))
    return J.collect_entries(q, V.inventory(spark, d))


@query("jn16_pair_transcripts", """SELECT coalesce(a.video_id, b.video_id) AS video_id, n_a, n_b, CASE WHEN n_a IS NULL OR n_b IS NULL THEN 'no_other_side' WHEN n_a = 0 OR n_b = 0 THEN 'one_sided' ELSE 'compared' END AS state
FROM (SELECT video_id, count(*) AS n_a FROM f_words GROUP BY 1) a FULL JOIN (SELECT video_id, count(CASE WHEN video_id % 5 <> 0 THEN word END) AS n_b FROM f_words WHERE seq % 19 <> 0 AND video_id % 41 <> 0 GROUP BY 1) b ON a.video_id = b.video_id""")
def _(spark, d):
    w = V.words(spark, d)
    b = w.where("seq % 19 <> 0 and video_id % 41 <> 0").withColumn("word", F.expr("case when video_id % 5 <> 0 then word end"))
    return J.pair_transcripts(w, b)


@query("snk6_upsert", """SELECT video_id, id, CASE WHEN id % 3 = 0 THEN NULL ELSE verify_flag END AS verify_flag, combined_milli FROM f_report WHERE id <> 2""")
def _(spark, d):
    base = V.report(spark, d).select("video_id", "id", "verify_flag", "combined_milli")
    patch = base.where("id % 3 = 0").select("video_id", "id", F.lit(None).cast("string").alias("verify_flag"))
    return J.upsert_segments(base, patch, base.where("id <> 2"))


@query("st1_queue_difference", "SELECT video_id, 'queue' AS side FROM f_queue_ids WHERE pos % 3 = 0 AND pos % 5 <> 0 UNION ALL SELECT video_id, 'playlist' FROM f_queue_ids WHERE pos % 5 = 0 AND pos % 3 <> 0")
def _(spark, d):
    q = J.read_queue_lines(V.queue(spark, d))
    return J.queue_difference(q.where("pos % 3 = 0"), q.where("pos % 5 = 0"))


# Roll-ups


@query("ag1_unit_leaders", "SELECT video_id, id, combined_milli FROM f_leaders")
def _(spark, d):
    return A.unit_leaders(V.report(spark, d)).select("video_id", "id", "combined_milli")


@query("ag3_speed_stats", """SELECT video_id, floor(quantile_cont(combined_milli, 0.5) + 0.01)::BIGINT AS median, floor(quantile_cont(combined_milli, 0.95) + 0.01)::BIGINT AS p95, max(combined_milli) AS most,
  count(*) FILTER (combined_milli >= 1800) AS n_broken FROM f_leaders GROUP BY 1""")
def _(spark, d):
    return A.speed_stats(V.report(spark, d))


@query("ag4_flag_histogram", "SELECT video_id, " + ", ".join(f"count(*) FILTER (translate_flag = '{v}') AS {v}" for v in T.TRANSLATE_FLAGS if v != "unknown") + ", count(*) FILTER (translate_flag = 'odd') AS unknown FROM f_report GROUP BY 1")
def _(spark, d):
    return A.flag_histogram(V.report(spark, d), "translate_flag", T.TRANSLATE_FLAGS)


@query("ag5_completeness_rollup", """SELECT video_id, count(*) FILTER (len(completeness_flags) > 0) AS n_flagged, count(*) FILTER (list_contains(completeness_flags, 'number_loss')) AS n_actionable,
  count(*) FILTER (len(completeness_flags) > 0 AND NOT list_contains(completeness_flags, 'number_loss')) AS n_advisory FROM f_report GROUP BY 1""")
def _(spark, d):
    return A.completeness_rollup(V.report(spark, d))


@query("ag7_stage_overhead", """SELECT video_id, sum(CASE WHEN wall_ms - work_ms >= 0 THEN wall_ms - work_ms END)::BIGINT AS overhead_ms, sum(work_ms)::BIGINT AS work_ms,
  coalesce(string_agg(CASE WHEN work_ms IS NOT NULL THEN stage END, ',' ORDER BY stage), '') AS measured, bool_and(work_ms IS NOT NULL) AS complete FROM f_stage_wall GROUP BY 1""")
def _(spark, d):
    return A.stage_overhead(V.stage_wall(spark, d))


@query("ag8_duration_ladder", """SELECT video_id, CASE WHEN video_id % 3 = 0 THEN 1000 * video_id + 1 WHEN video_id % 3 = 1 THEN 500 * video_id + 1 ELSE last END AS dur_ms,
  CASE WHEN video_id % 3 = 0 THEN 'info' WHEN video_id % 3 = 1 THEN 'probed' ELSE 'sentences' END AS source FROM (SELECT video_id, max(end_ms) AS last FROM f_sentences GROUP BY 1)""")
def _(spark, d):
    s = V.sentences(spark, d)
    ids = s.select("video_id").distinct()
    return A.duration_ladder(
        ids.where("video_id % 3 = 0").select("video_id", (F.col("video_id") * 1000 + 1).alias("stated")),
        ids.where("video_id % 3 = 1").select("video_id", (F.col("video_id") * 500 + 1).alias("probed")), s,
    )


@query("ag8_stage_shares", "SELECT video_id, stage, wall_ms, wall_ms * 1000 // nullif(sum(wall_ms) OVER (PARTITION BY video_id), 0)::BIGINT AS permille FROM f_stage_wall")
def _(spark, d):
    return A.stage_shares(V.stage_wall(spark, d)).select("video_id", "stage", "wall_ms", "permille")


TRIAGE = """SELECT video_id, sum(t)::BIGINT AS flags_total, sum(a)::BIGINT AS flags_actionable, (sum(t) - sum(a))::BIGINT AS flags_advisory, sum(a) > 0 AS needs_triage FROM (
  SELECT video_id, (translate_flag IS NOT NULL)::INT + (verify_flag IS NOT NULL)::INT + (len(completeness_flags) > 0)::INT AS t,
    coalesce(translate_flag <> 'english_echo', false)::INT + (verify_flag IS NOT NULL)::INT + list_contains(completeness_flags, 'number_loss')::INT AS a FROM f_report) GROUP BY 1"""


@query("ag10_triage", TRIAGE)
def _(spark, d):
    return A.triage(V.report(spark, d))


RUN_ROLLUP = f"""SELECT video_id, n_rows, n_units, median, p95, most, n_broken, low_similarity, flags_total, flags_actionable, needs_triage FROM
  (SELECT video_id, count(*) AS n_rows, count(DISTINCT group_id) AS n_units, count(verify_flag) AS low_similarity FROM f_report GROUP BY 1) JOIN
  (SELECT video_id, floor(quantile_cont(combined_milli, 0.5) + 0.01)::BIGINT AS median, floor(quantile_cont(combined_milli, 0.95) + 0.01)::BIGINT AS p95, max(combined_milli) AS most,
   count(*) FILTER (combined_milli >= 1800) AS n_broken FROM f_leaders GROUP BY 1) USING (video_id) JOIN ({TRIAGE}) USING (video_id)"""


@query("ag11_run_rollup", RUN_ROLLUP)
def _(spark, d):
    return A.run_rollup(V.report(spark, d)).select(
        "video_id", "n_rows", "n_units", "median", "p95", "most", "n_broken", "low_similarity", "flags_total", "flags_actionable", "needs_triage"
    )


@query("ag11_run_timing", """SELECT video_id, w AS wall_ms, CASE WHEN k > 0 THEN w - coalesce(o, 0) END AS work_ms, k = n AS complete, d AS dur_ms,
  w * 1000 // nullif(d, 0) AS rtf_milli, CASE WHEN k > 0 THEN (w - coalesce(o, 0)) * 1000 // nullif(d, 0) END AS rtf_work_milli FROM (
  SELECT video_id, sum(wall_ms)::BIGINT AS w, (sum(wall_ms - work_ms) FILTER (wall_ms >= work_ms))::BIGINT AS o, count(*) FILTER (wall_ms >= work_ms) AS k, count(*) AS n FROM f_stage_wall GROUP BY 1)
  LEFT JOIN (SELECT video_id, max(end_ms) AS d FROM f_sentences GROUP BY 1) USING (video_id)""")
def _(spark, d):
    last = V.sentences(spark, d).groupBy("video_id").agg(F.max("end_ms").alias("dur_ms"))
    return A.run_timing(V.stage_wall(spark, d), last)


@query("st4_measured_stages", """SELECT video_id, count(*) FILTER (work_ms IS NULL) AS unmeasured, 0::BIGINT AS unknown, bool_and(work_ms IS NOT NULL) AS complete FROM f_stage_wall GROUP BY 1""")
def _(spark, d):
    s = V.stage_wall(spark, d)
    return A.stage_coverage(s, s.where("work_ms is not null"))


@query("ag12_batch_totals", """SELECT stage, sum(wall_ms)::BIGINT AS wall_ms, count(DISTINCT video_id) AS n_videos, sum(wall_ms)::BIGINT * 1000 // (SELECT sum(wall_ms)::BIGINT FROM f_stage_wall) AS permille FROM f_stage_wall GROUP BY ROLLUP (stage)""")
def _(spark, d):
    return A.batch_totals(V.stage_wall(spark, d))


@query("ag13_queue_totals", """SELECT sum(ms)::BIGINT AS wall_ms, sum(n)::BIGINT AS n_items, count(*) AS n_waves, (SELECT count(*) FILTER (o_orderkey % 7 = 0 OR o_orderkey % 50 * 1000 < o_custkey % 20 * 1000) FROM orders) AS unmeasured FROM (
  SELECT w, max(t) - min(t - s) AS ms, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey % 20 * 1000 END AS w, o_orderkey % 50 * 1000 AS t, o_orderkey % 13 * 100 AS s FROM orders) WHERE w IS NOT NULL AND t >= w GROUP BY 1)""")
def _(spark, d):
    o = V.table(spark, d, "orders")
    return A.queue_totals(o.selectExpr(
        "case when o_orderkey % 7 <> 0 then o_custkey % 20 * 1000 end as wave_ms", "o_orderkey % 50 * 1000 as draft_ms", "o_orderkey % 13 * 100 as sec_ms"))


@query("ag14_wave_window", """SELECT video_id, CASE WHEN b >= a THEN b - a END AS wave_ms FROM (SELECT video_id, max(modified_ms) FILTER (artifact = 'sentences') AS a,
  max(modified_ms) FILTER (artifact IN ('translation', 'report')) AS b FROM f_inventory GROUP BY 1)""")
def _(spark, d):
    return A.wave_window(V.inventory(spark, d), "sentences", ["translation", "report"])


@query("ag17_clean_stats", """SELECT video_id, chunk, chars_in, chars_out, n, emptied, chars_out * 1000 // nullif(chars_in, 0) AS permille,
  CASE WHEN chars_out * 1000 // nullif(chars_in, 0) < CASE WHEN chunk IS NULL THEN 600 ELSE 650 END THEN 'short' WHEN emptied * 100 > 25 * n THEN 'emptied' END AS warning FROM (
  SELECT video_id, chunk, sum(length(text))::BIGINT AS chars_in, sum(length(o))::BIGINT AS chars_out, count(*) AS n, count(*) FILTER (trim(o) = '') AS emptied FROM (
    SELECT video_id, id // 80 AS chunk, text, CASE WHEN (video_id * 7 + id * 13) % 33 = 0 THEN '' ELSE substring(text, 1, length(text) * 9 // 10) END AS o FROM f_sentences)
  GROUP BY GROUPING SETS ((video_id, chunk), (video_id)))""")
def _(spark, d):
    s = V.sentences(spark, d)
    out = F.when(V.mixed("video_id", "id", 33) == 0, "").otherwise(F.expr("substring(text, 1, char_length(text) * 9 div 10)"))
    return A.clean_stats(s.select("video_id", F.expr("id div 80").alias("chunk"), F.col("text").alias("src"), out.alias("text")))


@query("ag18_placement_stats", """SELECT video_id, floor(quantile_cont(CASE WHEN slot > 0 THEN placed * 1000 // slot END, 0.5) + 0.01)::BIGINT AS fill_median, sum(greatest(slot - placed, 0))::BIGINT AS slot_silence,
  sum(greatest(span - placed, 0))::BIGINT AS span_silence, count(flag) AS n_bad, count(*) AS n_units FROM f_placed GROUP BY 1""".replace("sum(greatest(slot - placed, 0))", "sum(CASE WHEN slot IS NOT NULL THEN greatest(slot - placed, 0) ELSE 0 END)"))
def _(spark, d):
    p = I.place_units(V.units(spark, d)).withColumn("slot_silence", F.coalesce("slot_silence", F.lit(0)))
    return A.placement_stats(p)


@query("cl1_directory_kind", "SELECT video_id, kind FROM f_kinds")
def _(spark, d):
    return J.directory_kind(V.inventory(spark, d))


@query("cl3_degradation", """SELECT video_id, CASE WHEN NOT s THEN 'no_transcript' WHEN NOT t THEN 'no_translation' WHEN NOT r THEN 'no_synthesis' END AS reason FROM (
  SELECT video_id, bool_or(artifact = 'sentences') AS s, bool_or(artifact = 'translation') AS t, bool_or(artifact = 'report') AS r FROM f_inventory GROUP BY 1)""")
def _(spark, d):
    return J.degradation(V.inventory(spark, d))


@query("tk4_stages_by_time", "SELECT stage, sum(wall_ms)::BIGINT AS wall_ms, rank() OVER (ORDER BY sum(wall_ms) DESC, stage) AS place FROM f_stage_wall GROUP BY 1")
def _(spark, d):
    from pyspark.sql import Window

    s = V.stage_wall(spark, d).groupBy("stage").agg(F.sum("wall_ms").alias("wall_ms"))
    return s.withColumn("place", F.rank().over(Window.orderBy(F.desc("wall_ms"), "stage")).cast("bigint"))


@query("ws8_resegment")
def _(spark, d):
    return W.resegment(clamped(spark, d))
