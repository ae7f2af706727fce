"""Small inputs with known outputs."""

import pytest
from pyspark.sql import functions as F

from cadenza.functions import text as T
from cadenza.operators import grouping as G
from cadenza.operators import integrity as J
from cadenza.operators import intervals as I
from cadenza.operators import rollup as A
from cadenza.operators import alignment as L
from cadenza.operators import similarity as S
from cadenza.operators import spoken as P
from cadenza.operators import words as W
from cadenza.sources import sinks


def one(spark, column, **values):
    ddl = ", ".join(f"{k} {'bigint' if isinstance(v, int) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], ddl).select(column.alias("x")).first()["x"]


def words(spark, tokens, gap=0):
    rows, at = [], 0
    for i, w in enumerate(tokens):
        end = at + 100
        rows.append((1, i, w.strip("|"), at, end, w.endswith("|")))
        at = end + (1000 if w.endswith("|") else gap)
    return spark.createDataFrame(rows, "video_id bigint, seq bigint, word string, start_ms bigint, end_ms bigint, seg_end boolean")


def sentences(spark, rows):
    return spark.createDataFrame([(1, *r) for r in rows], "video_id bigint, id bigint, text string, start_ms bigint, end_ms bigint")


@pytest.mark.parametrize(
    ("tokens", "ends"),
    [
        (["Hello.", "There"], [True, False]),
        (["Dr.", "Smith"], [False, False]),
        (["J.", "Smith"], [False, False]),
        (["so...", "then"], [False, False]),
        (["so...", "Then"], [True, False]),
        (["end.", "then"], [False, False]),
        (["What?", "then"], [True, False]),
        (["(done.)", "Next"], [True, False]),
        (["last."], [True]),
    ],
)
def test_sentence_ends(spark, tokens, ends):
    assert [r["ends"] for r in W.sentence_ends(words(spark, tokens)).orderBy("seq").collect()] == ends


def test_segment_end_closes_before_lower_case(spark):
    assert W.sentence_ends(words(spark, ["tool.|", "it's"])).orderBy("seq").first()["ends"]


def test_collapse_runs(spark):
    out = W.collapse_runs(words(spark, ["no", "no", "no", "no", "yes", "yes"])).orderBy("seq").collect()
    assert [r["word"] for r in out] == ["no", "yes", "yes"]
    assert out[0]["end_ms"] == 400


def test_clamp_is_the_recurrence(spark):
    rows = [(1, i, "w", s, e, False) for i, (s, e) in enumerate([(0, 0), (5, 300), (100, 120), (None, None), (90, 95)])]
    df = spark.createDataFrame(rows, "video_id bigint, seq bigint, word string, start_ms bigint, end_ms bigint, seg_end boolean")
    last, want = 0, []
    for *_, s, e, _ in rows:
        s = max(s or 0, last)
        last = max(e or 0, s + 20)
        want.append((s, last))
    assert [(r["start_ms"], r["end_ms"]) for r in W.clamp_monotone(df).orderBy("seq").collect()] == want


def test_resegment_merges_short_and_cuts_long(spark):
    short = W.resegment(words(spark, ["Yes.", "Now", "we", "all", "go", "home."])).orderBy("id").collect()
    assert [r["text"] for r in short] == ["Yes. Now we all go home."]
    long = W.resegment(words(spark, [f"word{i}" + ("," if i == 40 else "") for i in range(80)], gap=150)).orderBy("id").collect()
    assert [r["id"] for r in long] == list(range(len(long))) and len(long) > 1
    assert any(r["text"].endswith("word40,") for r in long)
    assert " ".join(r["text"] for r in long).count("word") == 80


def test_units_split_at_gap_span_and_empty(spark):
    s = sentences(spark, [(0, "a", 0, 1000), (1, "b", 1500, 2500), (2, "c", 9000, 9500), (3, "", 9600, 9700), (4, "d", 9800, 9900)])
    assert sorted(tuple(r["ids"]) for r in G.build_units(s).collect()) == [(0, 1), (2,), (3,), (4,)]
    assert G.build_units(s, gap=0).count() == 5


def test_chunks_cover_once_and_absorb_the_tail(spark):
    s = sentences(spark, [(i, "x", i * 1000, i * 1000 + (100 if i == 75 else 900)) for i in range(200)])
    c = G.plan_chunks(s).orderBy("lo").collect()
    assert [i for r in c for i in range(r["lo"], r["hi"] + 1)] == list(range(200))
    assert c[0]["hi"] == 75 and all(r["hi"] - r["lo"] >= 39 for r in c)


def test_paragraphs(spark):
    s = sentences(spark, [(0, "a", 0, 10), (1, " ", 20, 30), (2, "b", 40, 50), (3, "c", 2000, 2100)])
    assert [r["text"] for r in G.paragraphs(s).orderBy("start_ms").collect()] == ["a b", "c"]


def test_widen_alternates(spark):
    s = sentences(spark, [(i, "x", i * 5000, i * 5000 + 5000) for i in range(10)])
    r = G.widen(s.where("id = 4"), s).first()
    assert (r["lo"], r["hi"]) == (2, 5)
    r = G.widen(s.where("id = 0"), s).first()
    assert (r["lo"], r["hi"]) == (0, 3)


def test_split_cues_keep_text_and_time(spark):
    s = sentences(spark, [(0, "one two three, four five six, " * 5, 0, 12000), (1, "short", 12000, 13000)])
    out = G.split_cues(s).orderBy("id", "part").collect()
    assert len(out) > 2 and out[0]["start_ms"] == 0 and out[-2]["end_ms"] == 12000
    assert " ".join(r["text"] for r in out[:-1]).split() == ("one two three, four five six, " * 5).split()


def test_intervals(spark):
    schema = "video_id bigint, start_ms bigint, end_ms bigint"
    a = spark.createDataFrame([(1, 0, 10_000), (1, 20_000, 30_000)], schema)
    b = spark.createDataFrame([(1, 2000, 3000), (1, 2500, 6000), (1, 9900, 21_000)], schema)
    assert sorted(map(tuple, I.subtract_intervals(a, b).collect())) == [(1, 0, 2000), (1, 6000, 9900), (1, 21_000, 30_000)]
    assert I.subtract_intervals(a, b, limit=9000).count() == 2
    m = I.merge_intervals(b, 3900, inclusive=False)
    assert sorted((r["start_ms"], r["end_ms"]) for r in m.collect()) == [(2000, 6000), (9900, 21_000)]
    assert I.merge_intervals(b, 3900).count() == 1


def test_uncovered_tail_and_empty_segment(spark):
    seg = spark.createDataFrame([(1, 0, 20_000), (2, 0, 5000)], "video_id bigint, start_ms bigint, end_ms bigint")
    w = spark.createDataFrame([(1, 1000, 2000), (1, 7000, 9500)], "video_id bigint, start_ms bigint, end_ms bigint")
    assert sorted(map(tuple, I.uncovered_spans(seg, w).collect())) == [(1, 2000, 7000), (1, 9500, 20_000), (2, 0, 5000)]


def test_splice_faults(spark):
    s = sentences(spark, [(i, "x", i, i + 1) for i in range(5)])
    win = spark.createDataFrame([(1, 0, 2), (1, 2, 3), (1, 4, 9)], "video_id bigint, lo bigint, hi bigint")
    new = spark.createDataFrame([(1, 0, 0, "n", 5, 6), (1, 2, 0, "n", 5, 6)], "video_id bigint, lo bigint, k bigint, text string, start_ms bigint, end_ms bigint")
    assert {(r["lo"], r["fault"]) for r in J.splice_faults(win, new, s).collect()} == {(2, "overlap"), (4, "out_of_range")}


def test_require_contiguous_raises(spark):
    with pytest.raises(Exception, match="not contiguous"):
        J.require_contiguous(sentences(spark, [(0, "a", 0, 1), (2, "b", 1, 2)])).collect()


@pytest.mark.parametrize(
    ("src", "tgt", "lost"),
    [
        ("It is not safe", "это безопасно", True),
        ("It is not safe", "это небезопасно", False),
        ("not only fast", "быстро", False),
        ("I don't know", "я знаю", True),
        ("useless, never mind", "бесполезный", False),
        ("all is well", "всё хорошо", False),
    ],
)
def test_negation(spark, src, tgt, lost):
    assert one(spark, T.negation_lost(F.col("a"), F.col("b")), a=src, b=tgt) is lost


@pytest.mark.parametrize(
    ("ru", "src", "reason"),
    [
        ("", "x", "empty"),
        ("hello there", "x", "no_cyrillic"),
        ("да hello there my friend", "yes hello there my friend", "english_echo"),
        ("очень длинный ответ на короткое", "ok", "runaway"),
        ("как ии, я не могу", "as you said before all that", "refusal"),
        ("запусти npm-install сейчас", "run npm-install now please", None),
        ("да", "yes", None),
    ],
)
def test_gate(spark, ru, src, reason):
    assert one(spark, T.translation_gate(F.col("a"), F.col("b")), a=ru, b=src) == reason


def test_small_functions(spark):
    assert one(spark, T.written_form(F.col("a")), a="x [[GPU|джи]] y [[bad]]") == "x GPU y [[bad]]"
    assert one(spark, T.spoken_form(F.col("a")), a="x [[GPU|джи]] y") == "x джи y"
    assert one(spark, T.video_id(F.col("a")), a="https://www.youtube.com/watch?v=abcdefghijk&t=1") == "abcdefghijk"
    assert one(spark, T.safe_filename(F.col("a")), a="con.txt") == "_con.txt"
    assert one(spark, T.safe_filename(F.col("a")), a="a/b?. ") == "a_b_"
    assert one(spark, T.clock(F.col("a")), a=3_723_000) == "1:02:03"
    assert one(spark, T.format_duration(F.col("a")), a=90) == "1.5 min"
    gaps = F.array(F.lit(100), F.lit(5000))
    assert one(spark, T.pause_markup(F.col("a"), gaps), a="A. B & C. D.") == 'A. B &amp; C. <break time="2000ms"/> D.'
    assert one(spark, T.pause_markup(F.col("a"), F.array(F.lit(1))), a="A.") is None


@pytest.mark.parametrize(
    ("n", "words"),
    [
        (0, "ноль"), (11, "одиннадцать"), (21, "двадцать один"), (342, "триста сорок два"), (1000, "одна тысяча"),
        (2002, "две тысячи два"), (5_000_000, "пять миллионов"), (121_000, "сто двадцать одна тысяча"),
    ],
)
def test_spell(n, words):
    assert P.spell(n) == words


@pytest.mark.parametrize(
    ("text", "spoken"),
    [
        ("10 000 рублей", "десять тысяч рублей"),
        ("1,999 штук", "одна тысяча девятьсот девяносто девять штук"),
        ("работает 24/7", "работает круглосуточно"),
        ("быстрее 2x", "быстрее в два раза"),
        ("5% и 1%", "пять процентов и один процент"),
        ("$20", "двадцать долларов"),
        ("2 ms", "две миллисекунды"),
        ("16 GB", "шестнадцать гигабайт"),
        ("3.5", "три целых пять"),
        ("10-20 раз", "от десять до двадцать раз"),
        ("на GPU", "на джи-пи-ю"),
        ("PS5", "пи-эс пять"),
        ("iPhones", "айфонс"),
        ("Dark Souls", "дарк соулс"),
        ("DeathLoop", "дитлуп"),
    ],
)
def test_normalize(spark, text, spoken):
    df = spark.createDataFrame([(1, 0, text)], "video_id bigint, id bigint, t string")
    once = P.normalize_spoken(df, "t")
    got = once.first()["spoken"]
    assert got == spoken
    assert P.normalize_spoken(once.select("video_id", "id", F.col("spoken").alias("t")), "t").first()["spoken"] == got


def test_resolve():
    assert P.resolve("HTTPS")[0] == "acronym" and P.resolve("GPUs") == ("acronym", "джи-пи-ю")
    assert P.resolve("brb") == ("letters", "би-ар-би") and P.resolve("It")[0] == "fallback"
    assert P.transliterate("gamer") == "геймер" and P.transliterate("nation") == "нейшн" and P.transliterate("sky") == "скай"
    words = {
        "takes": "тейкс", "league": "лиг", "unique": "уник", "agent": "эйджент", "age": "эйдж", "builder": "билдер", "fortnite": "фортнайт",
        "gaming": "гейминг", "call": "кол", "gallery": "галлери", "movie": "мови", "movies": "мовис", "need": "нид", "trees": "трис",
        "started": "стартед", "boxes": "боксес", "goes": "гос", "new": "нью", "show": "шоу", "power": "пауер", "knight": "найт", "city": "сити", "my": "май",
    }
    assert {w: P.transliterate(w) for w in words} == words


def test_stress(spark):
    for w, i, want in (("реддит", 1, "редд+ит"), ("р+еддит", 0, "р+еддит"), ("да", 4, "да"), ("ютуб", 0, "+ютуб")):
        assert one(spark, P.apply_stress(F.col("a"), F.col("b")), a=w, b=i) == want
    stress = spark.createDataFrame([("gamer", 0), ("gpu", 0)], "word string, stress int")
    df = spark.createDataFrame([(1, 0, "gamer GPU gaming")], "video_id bigint, id bigint, t string")
    assert P.normalize_spoken(df, "t", stress=stress).first()["spoken"] == "г+еймер джи-пи-ю гейминг"


def test_numbers_spelled_out(spark):
    for src, tgt, lost in (
        ("I have 2 cats", "у меня два кота", []), ("these 10", "этих десяти", []), ("the 5", "пятёрку", []), ("50 years", "пятидесятилетней", []),
        ("7 and 8", "семь", ["8"]), ("21000", "двадцать одна тысяча", []), ("0", "ноль", []), ("100", "сто", []), ("3 of 12345678901", "два", ["3"]), ("5", "none", ["5"]),
    ):
        assert one(spark, T.missing_numbers(F.col("a"), F.col("b")), a=src, b=tgt) == lost, (src, tgt)


def test_negation(spark):
    for src, tgt, lost in (
        ("I do not know", "я не знаю", False), ("I do not know", "я знаю", True), ("without it", "без него", False), ("It is not safe", "это безопасно", True),
        ("not only this", "это", False), ("I don’t", "да", True), ("nothing", "ничего", False),
    ):
        assert one(spark, T.negation_lost(F.col("a"), F.col("b")), a=src, b=tgt) is lost, (src, tgt)


def test_figures_of_long_lines_do_not_overflow(spark):
    line = F.repeat(F.col("a"), F.lit(30_000))
    assert one(spark, T.implausible_rate_centi(line, F.lit(1000).cast("bigint")), a="x") == 3_000_000
    assert one(spark, T.implausible_rate_centi(line, F.lit(10**9).cast("bigint")), a="x") is None
    assert one(spark, T.length_ratio_milli(F.col("a"), F.repeat(F.col("a"), F.lit(3_000_000))), a="x") == 3_000_000_000
    s = spark.createDataFrame([(1, 0, "x" * 300_000, 0, 1000)], "video_id bigint, id bigint, text string, start_ms bigint, end_ms bigint")
    assert W.claim_metrics(words(spark, ["a"]), s).first()["max_deci_cps"] == 3_000_000


def test_adjacent_duplicates(spark):
    echo = "this is a long line that will be said twice"
    s = sentences(spark, [(0, echo, 0, 1), (1, echo + "!", 1, 2), (2, "something else entirely, not alike at all", 2, 3), (3, echo, 3, 4)])
    assert sorted((r["id"], r["twin"]) for r in S.duplicate_adjacent(s).collect()) == [(0, 1), (1, 0)]
    run = sentences(spark, [(i, echo, i, i + 1) for i in range(3)])
    assert sorted((r["id"], r["twin"]) for r in S.duplicate_adjacent(run).collect()) == [(0, 1), (1, 2), (2, 1)]


def test_align(spark):
    r = L.align_words(words(spark, "a b c d".split()), words(spark, "a x c d e".split())).first()
    assert (r["n_equal"], r["n_sub"], r["n_ins"], r["n_del"]) == (3, 1, 1, 0)
    h = L.diff_hunks(words(spark, "a b c d".split()), words(spark, "a x c d".split())).collect()
    assert [(x["was"], x["now"], x["before"], x["after"]) for x in h] == [("b", "x", "a", "c d")]


def test_srt(spark):
    s = sentences(spark, [(0, "", 1000, 1000), (1, "b", 3_661_001, 3_662_000)])
    out = [r["block"] for r in sinks.srt_lines(s).orderBy("n").collect()]
    assert out == ["1\n00:00:01,000 --> 00:00:01,050\n…\n", "2\n01:01:01,001 --> 01:01:02,000\nb\n"]


def test_upsert_overwrites_with_null(spark):
    base = spark.createDataFrame([(1, 0, "a", 1), (1, 1, "b", 2)], "video_id bigint, id bigint, flag string, n bigint")
    patch = spark.createDataFrame([(1, 0, None), (1, 5, "z")], "video_id bigint, id bigint, flag string")
    live = spark.createDataFrame([(1, 0), (1, 5)], "video_id bigint, id bigint")
    assert sorted(map(tuple, J.upsert_segments(base, patch, live).collect())) == [(1, 0, None, 1), (1, 5, "z", None)]


def test_validate_scout(spark):
    rows = spark.createDataFrame([("a", "fine", "x" * 30), ("b", " ", "y")], "video_id string, one_liner string, paragraph string")
    good, bad = J.validate_scout(rows, {"one_liner": 10, "paragraph": 20})
    g = good.first()
    assert (g["video_id"], len(g["paragraph"]), g["warnings"]) == ("a", 20, ["paragraph"])
    assert [(r["video_id"], r["missing"]) for r in bad.collect()] == [("b", ["one_liner"])]


def test_ab_summary_takes_all_documents_and_whole_texts(spark, tmp_path):
    from difflib import SequenceMatcher

    from cadenza.plans import more  # noqa: F401
    from cadenza.plans.registry import QUERIES

    same = "abcd efgh " * 60
    texts = [same + "x" * 100, same + "y" * 300, same + "z" * 50, None, same, "ab", same + "w" * 700, ""]
    rows = [(i, t, len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, n_chars int").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["video"]: (r["worst_same"], r["worst_cross"]) for r in QUERIES["ag20_ab_summary"](spark, str(tmp_path)).collect()}
    ratio = lambda i, j: SequenceMatcher(None, texts[i] or "", texts[j] or "", autojunk=False).ratio()
    want = {}
    for v in (0, 1):
        pairs = [(4 * v + i, 4 * v + j) for i in range(4) for j in range(i + 1, 4)]
        want[v] = tuple(min(ratio(*sorted(p, key=lambda k: (k % 2, k))) for p in pairs if (sum(p) % 2 == 0) == s) for s in (True, False))
    assert {k: pytest.approx(v) for k, v in want.items()} == got


def test_spell_numbers_takes_long_ones_and_decimals(spark, tmp_path):
    from cadenza.plans import more  # noqa: F401
    from cadenza.plans.registry import QUERIES

    text = "card 123456789012, 3.5 and 2,25; 7. 1000000000 " + "9" * 5000
    spark.createDataFrame([(1, text), (2, None)], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["number"]: r["spoken"] for r in QUERIES["fn24_spell_numbers"](spark, str(tmp_path)).collect()}
    digits = "ноль один два три четыре пять шесть семь восемь девять".split()
    spelled = {n: " ".join(digits[int(c)] for c in n) for n in ("123456789012", "1000000000", "9" * 5000)}
    assert got == spelled | {"3.5": "три целых пять", "2,25": "два целых двадцать пять", "7": "семь"}


def test_verify_units(spark):
    units = spark.createDataFrame(
        [(1, i, [i, i + 1], r) for i, r in ((0, "one two"), (2, "one two"), (4, "one two"), (6, "one two"), (8, "?!"), (10, "one two"))],
        "video_id long, lead long, ids array<long>, ref string",
    )
    heard = spark.createDataFrame([(1, 0, "One, two!"), (1, 4, None), (1, 6, " "), (1, 8, "x"), (1, 10, "nothing alike")], "video_id long, lead long, hyp string")
    flags = {r["id"]: (r["flag"], r["hypothesis"]) for r in S.verify_units(units, heard).collect()}
    assert [flags[i][0] for i in range(0, 12, 2)] == [None, "missing_wav", "unreadable_wav", "empty_hyp", "empty_ref", "low_similarity"]
    assert all(flags[i + 1] == (flags[i][0], None) for i in range(0, 12, 2)) and flags[0][1] == "One, two!"
    assert {r["flag"] for r in S.verify_units(units, heard, enabled=False).collect()} == {None}


def test_stage_coverage(spark):
    timed = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "a")], "video_id long, stage string")
    measured = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, "c"), (4, "a")], "video_id long, stage string")
    got = {tuple(r) for r in A.stage_coverage(timed, measured).collect()}
    assert got == {(1, 0, 0, True), (2, 1, 1, False), (3, 1, 0, False), (4, 0, 1, False)}
    assert A.stage_coverage(timed.limit(0), measured.limit(0)).count() == 0


def test_run_timing(spark):
    stages = spark.createDataFrame(
        [(1, "a", 100, 90), (1, "b", 50, 50), (2, "a", 100, 120), (2, "b", 40, 30), (3, "a", 10, None)],
        "video_id long, stage string, wall_ms long, work_ms long",
    )
    lasts = spark.createDataFrame([(1, 300), (2, 0), (4, 5)], "video_id long, dur_ms long")
    got = sorted(map(tuple, A.run_timing(stages, lasts).collect()))
    assert got == [(1, 150, 140, True, 300, 500, 466), (2, 140, 130, False, 0, None, None), (3, 10, None, False, None, None, None)]


def test_rollup_takes_more_parts(spark):
    report = spark.createDataFrame(
        [(1, 0, 0, 1900, None, None, ["number_loss"])],
        "video_id long, id long, group_id long, combined_milli long, verify_flag string, translate_flag string, completeness_flags array<string>",
    )
    extra = spark.createDataFrame([(1, 7), (2, 8)], "video_id long, wall_ms long")
    rows = {r["video_id"]: r for r in A.run_rollup(report, extra).collect()}
    assert (rows[1]["n_rows"], rows[1]["wall_ms"], rows[2]["n_rows"], rows[2]["wall_ms"]) == (1, 7, None, 8)


def test_readings_agree_on_all_letters(spark):
    rows = [(1, 0, 1, "Straße"), (1, 0, 0, "Кот,"), (1, 20, 20, "日本"), (1, 40, 40, "--")]
    a = spark.createDataFrame(rows, "video_id long, lo long, seq long, word string")
    b = spark.createDataFrame([(1, 0, 0, "кот"), (1, 0, 1, "straße!"), (1, 20, 20, "日木"), (1, 40, 40, "--")], a.schema)
    assert sorted(map(tuple, S.readings_agree(a, b).collect())) == [(1, 0, True), (1, 20, False), (1, 40, False)]
