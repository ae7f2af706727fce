"""Phrase replacement against one alternation of all phrases, longest first."""

import random
import re

from cadenza.operators.phrases import replace_phrases
from cadenza.operators.spoken import normalize_spoken


def plain(text, phrases):
    table = {}
    for phrase, spoken in phrases:
        low = phrase.lower().replace("’", "'")
        if re.fullmatch(r"[a-z0-9](.*[a-z0-9])?", low, re.S):
            table[low] = min(spoken, table.get(low, spoken))
    names = "|".join(re.escape(k).replace("'", "['’]") for k in sorted(table, key=len, reverse=True))
    whole = re.compile(rf"(?<![A-Za-z0-9])({names})(?:['’]s)?(?!['’]?[A-Za-z0-9])", re.I | re.A)
    return whole.sub(lambda m: table[m[1].lower().replace("’", "'")], text or "")


def test_equal_to_an_alternation(spark):
    rng = random.Random(5)
    words = ["a", "b", "no", "man's", "man’s", "x86", "C", "ж", "s", "can't"]
    seps = [" ", " ", " ", "-", ". ", "'", "’", "'s ", "\n", "’s"]
    make = lambda n: "".join(rng.choice(words) + rng.choice(seps) for _ in range(n))
    phrases = [(make(rng.randint(1, 4)).strip(" \n.-'’"), f"<{i}>") for i in range(60)] + [("a a", "<aa>"), ("A  b", "<ab>"), ("!", "<no>"), ("C", "<c>"), ("c", "<c2>")]
    texts = [(1, i, make(rng.randint(0, 60))) for i in range(200)] + [(2, 0, None), (2, 1, ""), (2, 2, "a " * 3001), (2, 3, "no man’s"), (2, 4, "İA a ")]
    df = spark.createDataFrame(texts, "video_id long, id long, text string")
    got = {(r.video_id, r.id): r.replaced for r in replace_phrases(df, "text", spark.createDataFrame(phrases, "phrase string, spoken string")).collect()}
    assert got == {(v, i): plain(t, phrases) for v, i, t in texts}
    none = replace_phrases(df, "text", spark.createDataFrame([], "phrase string, spoken string"))
    assert {r.replaced for r in none.where("id = 3 and video_id = 2").collect()} == {"no man’s"}


def test_a_hundred_thousand_phrases(spark):
    phrases = spark.range(100_000).selectExpr("concat('name ', id % 1000, ' of ', id) AS phrase", "concat('[', id, ']') AS spoken")
    texts = spark.range(2000).selectExpr("1L AS video_id", "id", "concat('so Name ', id % 1000, ' of ', id, '’s and name 1 of 2') AS text")
    got = {r.id: r.replaced for r in replace_phrases(texts, "text", phrases).collect()}
    assert got == {i: f"so [{i}] and name 1 of 2" for i in range(2000)}


def test_before_all_else_is_said(spark):
    df = spark.createDataFrame([(1, 1, "Half life 2's end, 3 kg")], "video_id long, id long, text string")
    phrases = spark.createDataFrame([("half life 2", "халф лайф два"), ("half life", "халф лайф")], "phrase string, spoken string")
    row = normalize_spoken(df, "text", phrases=phrases).first()
    assert (row["spoken"].startswith("халф лайф два "), "три килограмма" in row["spoken"], set(row.asDict())) == (True, True, {"video_id", "id", "text", "spoken"})
