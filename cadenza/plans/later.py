"""Queries of readers of single files, keys, whole roll-ups and queue entries, and of functions over made Cyrillic texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions import text as T
from cadenza.operators import integrity as J
from cadenza.operators import rollup as A
from cadenza.operators import similarity as S
from cadenza.operators import spoken as P
from cadenza.operators import words as W
from cadenza.operators.phrases import find_phrases, replace_phrases
from cadenza.operators.ranks import exact_percentiles
from cadenza.plans import files, further, more, registry  # noqa: F401  their SQL is built upon
from cadenza.plans.files import numbered, place
from cadenza.plans.registry import LOST, MISSING, SQL, query
from cadenza.sources import readers as R
from cadenza.sources import sinks
from cadenza.sources import views as V
from cadenza.sources.artifacts import write_artifacts

# Files


def one_file(lines: DataFrame, order: str) -> str:
    """Folder of one text file with the lines in order: a source of one file, as queues and dictionaries are."""
    path = place(lines.sparkSession)
    lines.repartition(1).sortWithinPartitions(order).select(F.col("line").alias("value")).write.text(path)
    return path


@query("src5_read_queue", "SELECT video_id, pos, n FROM f_queue_ids")
def _(spark, d):
    return R.read_queue(spark, one_file(V.queue(spark, d), "pos"), "hash")


@query("src6_queue_header", "SELECT 'Pages ' || count(*) AS title, 'https://x.org/list?n=' || max(page_id) AS url FROM pages")
def _(spark, d):
    pages = V.table(spark, d, "pages")
    header = pages.agg(F.concat(F.lit("# Playlist: Pages "), F.count("*").cast("string"), F.lit(" | https://x.org/list?n="), F.max("page_id").cast("string")).alias("line"))
    lines = header.select(F.lit(-1).cast("bigint").alias("pos"), "line").unionByName(V.queue(spark, d))
    return R.queue_header(R._lines(spark, one_file(lines, "pos")))


@query("src7_read_artifact", "SELECT page_id AS video_id, page_id % 5 = 0 AS torn, CASE WHEN page_id % 5 <> 0 THEN length(url) END AS size FROM pages")
def _(spark, d):
    """Every fifth file is cut off."""
    size = F.char_length("url").cast("string")
    text = F.when(F.col("page_id") % 5 == 0, '{"size": 1, "te').otherwise(F.concat(F.lit('{"size": '), size, F.lit("}")))
    root = place(spark)
    write_artifacts(V.table(spark, d, "pages").select(F.col("page_id").alias("video_id"), text.alias("value")), root, "page.json")
    return numbered(R.read_artifact(spark, root, "page.json", "size int")).select("video_id", F.col("_corrupt").isNotNull().alias("torn"), "size")


VOWELS = "aeiou"


def stress_lines(spark: SparkSession, d: str) -> DataFrame:
    """A dictionary of the documents' words of small letters: each has its stress on the vowel that its length chooses."""
    w = V.words(spark, d).where("word rlike '^[a-z]+$'").select("word").distinct()
    n = F.char_length(F.regexp_replace("word", f"[^{VOWELS}]", ""))
    rows = w.withColumn("n", n).where("n > 0").withColumn("at", F.char_length("word") % F.col("n"))
    letters = F.transform(F.sequence(F.lit(1), F.char_length("word")), lambda i: F.struct(i.alias("i"), F.substr(F.col("word"), i, F.lit(1)).alias("c")))
    count = lambda i: F.char_length(F.regexp_replace(F.substr(F.col("word"), F.lit(1), i), f"[^{VOWELS}]", "")) - 1
    phone = lambda x: F.when(F.contains(F.lit(VOWELS), x["c"]), F.concat(F.lit("AH"), F.when(count(x["i"]) == F.col("at"), "1").otherwise("0"))).otherwise(F.upper(x["c"]))
    return rows.select(F.xxhash64("word").alias("pos"), F.concat(F.upper("word"), F.lit("  "), F.array_join(F.transform(letters, phone), " ")).alias("line"))


STRESS = """SELECT word, (length(word) % n)::INT AS stress FROM (SELECT DISTINCT word, length(regexp_replace(word, '[^aeiou]', '', 'g')) AS n
  FROM f_words WHERE regexp_full_match(word, '[a-z]+')) WHERE n > 0"""


@query("src9_read_stress_dict", STRESS)
def _(spark, d):
    return R.read_stress_dict(spark, one_file(stress_lines(spark, d), "pos")).select("word", F.col("stress").cast("int").alias("stress"))


@query("fn27_apply_stress", f"""SELECT word, regexp_replace(said, '^((?:[^аеиоу]*[аеиоу]){{' || stress || '}}[^аеиоу]*)([аеиоу])', '\\1+\\2') AS stressed FROM (
  SELECT word, stress, translate(word, 'aeiou', 'аеиоу') AS said FROM ({STRESS}))""")
def _(spark, d):
    """The dictionary is read, and its stress goes to the words with Cyrillic vowels."""
    known = R.read_stress_dict(spark, one_file(stress_lines(spark, d), "pos"))
    said = known.withColumn("said", F.translate("word", VOWELS, "аеиоу"))
    return said.select("word", P.apply_stress(F.col("said"), F.col("stress").cast("int")).alias("stressed"))


@query("snk5_append_run", "SELECT event_type AS config_key, count(*) AS n FROM events GROUP BY 1")
def _(spark, d):
    path, log = place(spark), files.run_log(spark, d).select("run_id", "config_key")
    for k in range(3):
        sinks.append_run(log.where(F.pmod(F.xxhash64("run_id"), F.lit(3)) == k), path)
    return spark.read.schema(log.schema).json(path).groupBy("config_key").agg(F.count("*").alias("n"))


@query("snk7_write_compare_csv", "SELECT doc_id AS video_id, n_chars AS n_equal, doc_id % 7 AS n_sub, 0 AS n_ins, doc_id % 3 AS n_del, n_chars % 1001 AS agreement_milli FROM documents")
def _(spark, d):
    path = place(spark)
    columns = ["doc_id AS video_id", "n_chars AS n_equal", "doc_id % 7 AS n_sub", "0 AS n_ins", "doc_id % 3 AS n_del", "n_chars % 1001 AS agreement_milli"]
    sinks.write_compare_csv(V.table(spark, d, "documents").selectExpr(*columns), path)
    back = spark.read.csv(path, header=True)
    return back.select(*(F.col(c).cast("bigint").alias(c) for c in back.columns))


# Phrases

OPENING = r"^[^A-Za-z0-9]*([A-Za-z0-9]+[^A-Za-z0-9]+[A-Za-z0-9]+(?:[^A-Za-z0-9]+[A-Za-z0-9]+)?)"


@query("fn28_replace_phrases", rf"""SELECT * FROM (WITH RECURSIVE said AS (SELECT regexp_extract(text, '{OPENING}', 1) AS phrase, '<' || id || '>' AS spoken
  FROM (SELECT text, doc_id AS id FROM documents UNION ALL SELECT text, conv_id FROM conversations)),
known AS (SELECT translate(phrase, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ’', 'abcdefghijklmnopqrstuvwxyz''') AS gram, min(spoken) AS spoken FROM said WHERE phrase <> '' GROUP BY 1),
t AS (SELECT conv_id, turn, regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9]+') AS r,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ’', 'abcdefghijklmnopqrstuvwxyz'''), '[A-Za-z0-9]+|[^A-Za-z0-9]+') AS n
  FROM (SELECT conv_id, turn, coalesce(text, '') AS text FROM conversations)),
c AS (SELECT conv_id, turn, p, size, array_to_string(n[p + 1:p + size], '') AS gram, n[p + size + 1:p + size + 4] AS a
  FROM (SELECT *, unnest(range(len(n))) AS p FROM t), (VALUES (3), (5)) s(size) WHERE p + size <= len(n)),
ends AS (SELECT conv_id, turn, p, size, spoken, CASE WHEN coalesce(a[1] = '''' AND a[2] = 's', false) AND NOT coalesce(a[3] = '''' AND len(a) = 4, false) THEN p + size + 2
    WHEN NOT coalesce(a[1] = '''' AND len(a) >= 2, false) THEN p + size END AS e FROM c JOIN known USING (gram)),
best AS (SELECT conv_id, turn, p, arg_max(e, size) AS e, arg_max(spoken, size) AS spoken FROM ends WHERE e IS NOT NULL GROUP BY ALL),
linked AS (SELECT b.conv_id, b.turn, b.p, min(n.p) AS following FROM best b JOIN best n ON b.conv_id = n.conv_id AND b.turn = n.turn AND b.e <= n.p GROUP BY ALL),
walk AS (SELECT conv_id, turn, min(p) AS p FROM best GROUP BY ALL
  UNION ALL SELECT w.conv_id, w.turn, l.following FROM walk w JOIN linked l USING (conv_id, turn, p)),
kept AS (SELECT conv_id, turn, p, e, spoken, lag(e, 1, 0) OVER (PARTITION BY conv_id, turn ORDER BY p) AS done FROM walk JOIN best USING (conv_id, turn, p))
SELECT t.conv_id AS video_id, t.turn AS id, count(k.p) AS n,
  coalesce(string_agg(array_to_string(r[done + 1:p], '') || spoken, '' ORDER BY p), '') || array_to_string(any_value(r)[coalesce(max(e), 0) + 1:], '') AS replaced
FROM t LEFT JOIN kept k ON k.conv_id = t.conv_id AND k.turn = t.turn GROUP BY t.conv_id, t.turn)""")
def _(spark, d):
    """The two or three words that documents and turns begin with, found in all turns."""
    texts = V.table(spark, d, "documents").selectExpr("text", "doc_id AS id").unionByName(V.table(spark, d, "conversations").selectExpr("text", "conv_id AS id"))
    phrases = texts.select(F.regexp_extract("text", OPENING, 1).alias("phrase"), F.concat(F.lit("<"), F.col("id").cast("string"), F.lit(">")).alias("spoken"))
    turns = V.table(spark, d, "conversations").select(F.col("conv_id").alias("video_id"), F.col("turn").alias("id"), "text")
    found = find_phrases(turns, "text", phrases).groupBy("video_id", "id").agg(F.count("*").alias("n"))
    said = replace_phrases(turns, "text", phrases).join(found, ["video_id", "id"], "left")
    return said.select("video_id", "id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "replaced")


# Functions


@query("fn14_completeness_check", f"""SELECT p.video_id, p.id, floor(1000 * length(tgt) / nullif(length(src), 0))::BIGINT AS ratio_milli, array_to_string(list_sort({MISSING}), ',') AS missing,
  {LOST} AS negation_lost, f.flags FROM f_pairs p JOIN ({SQL["fn14_completeness"]}) f USING (video_id, id)""")
def _(spark, d):
    c = V.pairs(spark, d).select("video_id", "id", T.completeness_check(F.col("src"), F.col("tgt")).alias("c"))
    return c.select(
        "video_id", "id", "c.ratio_milli", F.array_join(F.array_sort("c.missing"), ",").alias("missing"), "c.negation_lost",
        F.array_join("c.flags", ",").alias("flags"),
    )


LATIN = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
CYRILLIC = "абвгдежзийклмнопрстуфхцчшщАБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩ"
#: Made translations, one of six kinds by id: none, untranslated, half translated, far too long, a refusal, a good one.
MADE = f"""SELECT video_id, id, text, kind, low, regexp_matches(text, '[A-Za-z]') AS latin FROM (SELECT *, id % 6 AS kind,
  length(regexp_replace(text, '[^a-z]', '', 'g')) AS low FROM f_sentences)"""
REASON = """CASE WHEN kind = 0 THEN 'empty' WHEN kind = 1 THEN 'no_cyrillic' WHEN kind = 2 THEN CASE WHEN low / (low + 2) > 0.3 THEN 'english_echo' WHEN low + 3 > 3 * length(text) THEN 'runaway' END
  WHEN kind = 4 THEN CASE WHEN 39 > 3 * length(text) THEN 'runaway' ELSE 'refusal' END WHEN NOT latin THEN 'no_cyrillic' WHEN kind = 3 THEN 'runaway' END"""
REFUSED = "Извините, я не могу перевести это, нет."


def made_translations(spark: SparkSession, d: str) -> DataFrame:
    kind, said = F.col("id") % 6, F.translate("text", LATIN, CYRILLIC)
    echo = F.concat(F.lit("да "), F.regexp_replace("text", "[^a-z]", ""))
    ru = (
        F.when(kind == 0, " ").when(kind == 1, F.regexp_replace("text", "[А-Яа-яЁё]", "")).when(kind == 2, echo).when(kind == 3, F.repeat(said, 4))
        .when(kind == 4, REFUSED).otherwise(said)
    )
    return V.sentences(spark, d).withColumn("text_ru", ru)


@query("fn7_gate_reasons", f"SELECT video_id, id, {REASON} AS reason FROM ({MADE})")
def _(spark, d):
    return made_translations(spark, d).select("video_id", "id", T.translation_gate(F.col("text_ru"), F.col("text")).alias("reason"))


@query("jn1_made_translation", f"""SELECT video_id, id, CASE WHEN id % 7 = 0 THEN 'pending' WHEN reason IS NULL THEN 'ok' ELSE 'failed' END AS status, CASE WHEN id % 7 <> 0 THEN reason END AS flag,
  CASE WHEN id % 7 <> 0 AND reason IS NULL AND kind = 5 THEN translate(text, '{LATIN}', '{CYRILLIC}') END AS good FROM (SELECT *, {REASON} AS reason FROM ({MADE}))""")
def _(spark, d):
    """Every seventh sentence has no draft row."""
    made = made_translations(spark, d)
    out = J.build_translation(made.drop("text_ru"), made.where("id % 7 <> 0").select("video_id", "id", "text_ru"))
    good = F.when((F.col("status") == "ok") & (F.col("id") % 6 == 5), F.col("text_ru"))
    return out.select("video_id", "id", "status", "flag", good.alias("good"))


@query("fn18_detect_lang", """SELECT video_id, CASE WHEN n > 0 AND 10 * c >= 7 * n THEN 'ru' WHEN n > 0 AND 20 * c <= n THEN 'en' END AS lang FROM (
  SELECT video_id, sum(len(regexp_extract_all(t, '\\p{L}'))) AS n, sum(len(regexp_extract_all(t, '\\p{Cyrillic}'))) AS c FROM (
    SELECT video_id, CASE WHEN video_id % 3 = 0 OR (video_id % 3 = 1 AND id % 2 = 0) THEN translate(text, 'abcdefghijklmnopqrstuvwxyz', 'абвгдежзийклмнопрстуфхцчшщ') ELSE text END AS t
    FROM f_sentences) GROUP BY video_id)""")
def _(spark, d):
    """A third of the videos has Cyrillic small letters, a third has them in every other sentence."""
    other = F.translate("text", "abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщ")
    some = F.expr("video_id % 3 = 0 or (video_id % 3 = 1 and id % 2 = 0)")
    return A.detect_lang(V.sentences(spark, d).withColumn("text", F.when(some, other).otherwise(F.col("text")))).select("video_id", "lang")


@query("fn25_resolve_tokens")
def _(spark, d):
    """How each distinct Latin token of all documents is said; transcription by rule is the last resort."""
    t = V.table(spark, d, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z]+(?:['’][A-Za-z]+)*"), F.lit(0))).alias("token"))
    return P.resolve_tokens(t.distinct()).select("token", "via", "spoken")


@query("fn31_keys", """SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'm' || doc_id % 3 || '|int8|beam=' || doc_id % 5 || '|cond=' || CASE WHEN doc_id % 7 = 0 THEN 'mixed' WHEN doc_id % 3 = 0 THEN 'True' ELSE 'False' END
    ELSE 'p|vad=' || CASE WHEN doc_id % 3 = 0 THEN 'True' ELSE 'False' END END AS decoded,
  CASE WHEN doc_id % 2 = 0 THEN 'm' || doc_id % 3 || '|int8|beam=' || doc_id % 5 ELSE 'p|vad=' || CASE WHEN doc_id % 3 = 0 THEN 'True' ELSE 'False' END END AS core,
  coalesce((CASE WHEN doc_id % 2 = 0 THEN 'm' || doc_id % 3 || '|int8|beam=' || doc_id % 5 || '|cond=' || CASE WHEN doc_id % 7 = 0 THEN 'mixed' WHEN doc_id % 3 = 0 THEN 'True' ELSE 'False' END
    ELSE 'p|vad=' || CASE WHEN doc_id % 3 = 0 THEN 'True' ELSE 'False' END END) || '||silero|' || source || '|v|sr=24000|breaks=' || CASE WHEN doc_id % 4 = 0 THEN 1 ELSE 0 END, 'unknown') AS run FROM documents""")
def _(spark, d):
    doc = F.col("doc_id")
    yes = doc % 3 == 0
    condition = F.when(doc % 7 == 0, "mixed").otherwise(yes.cast("string"))
    whole = T.decode_key(F.concat(F.lit("m"), (doc % 3).cast("string")), F.lit("int8"), doc % 5, condition)
    decoded = F.when(doc % 2 == 0, whole).otherwise(T.gated_decode_key(F.lit("p"), yes))
    voice = T.synthesis_key(F.col("source"), F.lit("v"), F.lit(24000), doc % 4 == 0)
    return V.table(spark, d, "documents").select("doc_id", decoded.alias("decoded"), T.key_core(decoded).alias("core"), T.run_key(decoded, voice).alias("run"))


@query("sm3_containment", """SELECT video_id, id, round(1000 * max(k) / least(length(src), length(tgt)))::BIGINT AS milli FROM (
  SELECT *, len(list_filter(range(1, length(src) - i + 2), lambda k: contains(tgt, substring(src, i, k)))) AS k FROM (
    SELECT *, unnest(range(1, length(src) + 1)) AS i FROM f_pairs WHERE src <> '' AND tgt <> '')) GROUP BY video_id, id, src, tgt""")
def _(spark, d):
    p = V.pairs(spark, d).where("src <> '' and tgt <> ''")
    return p.select("video_id", "id", F.round(1000 * S.containment("src", "tgt")).cast("bigint").alias("milli"))


# Roll-ups and entries


@query("ag2_large_groups", """SELECT l_returnflag, floor(quantile_cont(v, 0.25) + 0.01)::BIGINT AS p25, floor(quantile_cont(v, 0.5) + 0.01)::BIGINT AS p50, floor(quantile_cont(v, 0.95) + 0.01)::BIGINT AS p95
FROM (SELECT l_returnflag, round(l_extendedprice * 100)::BIGINT AS v FROM lineitem) GROUP BY 1""")
def _(spark, d):
    """Three groups hold all lines: their ranks are searched for."""
    lines = V.table(spark, d, "lineitem").select("l_returnflag", F.round(F.col("l_extendedprice") * 100).alias("v"))
    found = exact_percentiles(lines, ["l_returnflag"], "v", {"p25": 0.25, "p50": 0.5, "p95": 0.95}, large=1000)
    return found.select("l_returnflag", *(A.whole(F.col(p)).alias(p) for p in ("p25", "p50", "p95")))


@query("ag11_full_rollup", f"""SELECT video_id, r.n_rows, r.n_units, r.flags_total, r.flags_actionable, t.wall_ms, t.work_ms, u.flagged, u.retried, u.repaired, p.fill_median, p.slot_silence,
  f.n_words::BIGINT AS n_words, f.n_floor::BIGINT AS n_floor, s.scanned
FROM ({SQL["ag11_run_rollup"]}) r FULL JOIN ({SQL["ag11_run_timing"]}) t USING (video_id) FULL JOIN ({SQL["ag19_unit_counters"]}) u USING (video_id)
FULL JOIN ({SQL["ag18_placement_stats"]}) p USING (video_id) FULL JOIN ({SQL["ws3_floor_runs"]}) f USING (video_id) FULL JOIN ({SQL["ag6_source_rollup"]}) s USING (video_id)""")
def _(spark, d):
    """Report, timing, units, placement, decode and source blocks of every video in one row."""
    of = registry.QUERIES
    named = {"report": "ag11_run_rollup", "timing": "ag11_run_timing", "units": "ag19_unit_counters", "placement": "ag18_placement_stats", "decode": "ws3_floor_runs", "source": "ag6_source_rollup"}
    out = A.full_rollup({k: of[q](spark, d) for k, q in named.items()})
    return out.select(
        "video_id", "report.n_rows", "report.n_units", "report.flags_total", "report.flags_actionable", "timing.wall_ms", "timing.work_ms",
        "units.flagged", "units.retried", "units.repaired", "placement.fill_median", "placement.slot_silence", "decode.n_words", "decode.n_floor",
        "source.scanned",
    )


ENTRIES = """SELECT *, row_number() OVER (ORDER BY queued DESC, pos, video_id) AS place FROM (
  SELECT q.video_id, true AS queued, q.pos, coalesce(k.kind, 'missing') AS kind FROM (SELECT page_id % 300 AS video_id, min(page_id) AS pos FROM pages GROUP BY 1) q LEFT JOIN f_kinds k USING (video_id)
  UNION ALL SELECT video_id, false, NULL, kind FROM f_kinds WHERE video_id NOT IN (SELECT page_id % 300 FROM pages) AND kind NOT IN ('missing', 'fetched'))"""


@query("jn14_queue_entries", f"""SELECT e.video_id, queued, place, kind, r.n AS n_sentences, CASE WHEN e.video_id % 2 = 0 THEN i.source END AS one_liner, CASE WHEN e.video_id % 5 = 0 THEN i.n_chars END AS summary_chars
FROM ({ENTRIES}) e LEFT JOIN (SELECT video_id, count(*) AS n FROM f_sentences GROUP BY 1) r USING (video_id) LEFT JOIN documents i ON i.doc_id = e.video_id""")
def _(spark, d):
    queue = V.table(spark, d, "pages").groupBy((F.col("page_id") % 300).alias("video_id")).agg(F.min("page_id").alias("pos"))
    docs = V.table(spark, d, "documents").withColumnRenamed("doc_id", "video_id")
    entries, _ = J.queue_entries(
        queue, V.inventory(spark, d), V.sentences(spark, d).groupBy("video_id").agg(F.count("*").alias("n")),
        docs.where("video_id % 2 = 0").select("video_id", F.col("source").alias("one_liner")), docs.where("video_id % 5 = 0").select("video_id", F.col("n_chars").alias("chars")),
    )
    return entries.select("video_id", "queued", "place", "kind", F.col("rollup.n").alias("n_sentences"), "scout.one_liner", F.col("summary.chars").alias("summary_chars"))


@query("ws10_stitched_rows", """SELECT w.video_id, w.seq, n AS win_no FROM (SELECT video_id, seq, start_ms, unnest([0, 1]) AS n FROM f_words) w
  WHERE (n = 0 AND start_ms < 45000) OR (n = 1 AND start_ms >= 45000)""")
def _(spark, d):
    """Two windows of every video that overlap from 30 to 60 seconds, each with all of the words: cut at the middle."""
    w = V.words(spark, d).withColumn("win_no", F.explode(F.array(F.lit(0), F.lit(1))))
    w = w.withColumn("w_start", F.when(F.col("win_no") == 0, 0).otherwise(30_000)).withColumn("w_end", F.when(F.col("win_no") == 0, 60_000).otherwise(10**9))
    return W.stitch_windows(w).select("video_id", "seq", "win_no")
