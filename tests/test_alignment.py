"""Matching blocks and word alignment against the plain method."""

import random
from collections import defaultdict
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators import alignment as L
from cadenza.operators import matching as M
from cadenza.operators import similarity as S

WORDS = "video_id bigint, seq bigint, word string, start_ms bigint, end_ms bigint, seg_end boolean"


def letters(r, n, of):
    return "".join(r.choice(of) for _ in range(n))


def edited(r, items, of, n):
    out = list(items)
    for _ in range(n):
        at = r.randrange(len(out) + 1)
        out[at : at + r.randrange(3)] = [r.choice(of) for _ in range(r.randrange(3))]
    return out


def pairs(seed, n=400):
    r = random.Random(seed)
    out = [("", ""), ("a", ""), ("", "b"), ("same", "same"), ("a" * 300, "a" * 299 + "b"), ("ab" * 80, "ac" * 70), ("日本語", "本語日"), ("\ud800x", "x\ud800")]
    for _ in range(n):
        of = r.choice(["a", "ab", "abc", "abcdefghij ", "etaoin shrdlu,."])
        x = letters(r, r.randrange(90), of)
        y = "".join(edited(r, x, of, r.randrange(8))) if r.random() < 0.5 else letters(r, r.randrange(90), of)
        k = r.randrange(len(y) + 1)
        out.append((x, y[k:] + y[:k] if r.random() < 0.3 else y))
    return out


@pytest.mark.parametrize("together", [True, False])
def test_matching_blocks_are_the_plain_ones(together):
    some = pairs(3)
    for part in [some] if together else [[p] for p in some[:120]]:
        got = M.matching_blocks([M.letters(x) for x, _ in part], [M.letters(y) for _, y in part])
        for (x, y), blocks in zip(part, got, strict=True):
            assert M.opcodes(blocks, len(x), len(y)) == SequenceMatcher(None, x, y, False).get_opcodes(), (x, y)


def test_longest_blocks():
    some = pairs(4)
    got = M.longest_blocks([M.letters(x) for x, _ in some], [M.letters(y) for _, y in some])
    assert got == [SequenceMatcher(None, x, y, False).find_longest_match(0, len(x), 0, len(y)).size for x, y in some]


def test_hashes_only_propose(monkeypatch):
    """With hashes that say nothing, blocks are still right."""
    monkeypatch.setattr(M, "PRIMES", (3, 5))
    test_matching_blocks_are_the_plain_ones(True)


def test_long_unlike_texts_in_little_time():
    r = random.Random(9)
    words = [letters(r, r.randrange(2, 9), "etaoinshrdlu") for _ in range(3000)]
    x, y = (" ".join(r.choice(words) for _ in range(4000)) for _ in range(2))
    blocks = M.matching_blocks([M.letters(x)], [M.letters(y)])[0]
    assert all(x[i : i + k] == y[j : j + k] for i, j, k in blocks)
    assert all(i + k <= p and j + k <= q for (i, j, k), (p, q, _) in zip(blocks, blocks[1:]))


def test_ratio_and_containment(spark):
    some = [p for p in pairs(5, 60) if "\ud800" not in p[0]] + [(None, "x"), (None, None)]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(some)], "i int, a string, b string")
    for r in rows.withColumns({"ratio": S.seq_ratio("a", "b"), "inside": S.containment("a", "b")}).collect():
        x, y = r["a"] or "", r["b"] or ""
        m = SequenceMatcher(None, x, y, False)
        assert r["ratio"] == m.ratio()
        assert r["inside"] == (m.find_longest_match(0, len(x), 0, len(y)).size / min(len(x), len(y)) if x and y else 0)
    assert rows.limit(0).select(S.seq_ratio("a", "b")).count() == 0


def words(spark, videos):
    rows = [(v, 10 * i, w, 100 * i, 100 * i + 90, False) for v, said in videos.items() for i, w in enumerate(said)]
    return spark.createDataFrame(rows, WORDS)


def readings(seed, vocabulary, n=200, videos=6):
    r = random.Random(seed)
    some = [letters(r, 6, "etaoinshrdlu") for _ in range(vocabulary)]
    a = {v: [r.choice(some) for _ in range(r.randrange(n))] for v in range(videos)}
    b = {v: edited(r, said, some, r.randrange(1, 12)) for v, said in a.items()}
    a |= {50: ["only", "here"], 51: ["...", "-"], 52: ["one", ",", "two"]}
    b |= {60: ["there"], 52: ["two", "one"], 53: ["?"]}
    return a, b


def plain(x, y):
    n = dict.fromkeys(("n_equal", "n_sub", "n_ins", "n_del"), 0)
    for op, i, j, k, m in SequenceMatcher(None, x, y, False).get_opcodes():
        if op == "equal":
            n["n_equal"] += j - i
        else:
            n["n_sub"] += min(j - i, m - k)
            n["n_del"] += max(0, j - i - m + k)
            n["n_ins"] += max(0, m - k - j + i)
    return n


@pytest.mark.parametrize(("vocabulary", "gram"), [(5000, 3), (4, 3), (4, 200)])
def test_align_words(spark, monkeypatch, vocabulary, gram):
    """Where all runs are unique or none is, the plain method's counts; else a whole alignment that agrees no less."""
    monkeypatch.setattr(L.anchors, "__defaults__", (gram,))
    a, b = readings(vocabulary, vocabulary)
    norm = lambda said: [w for w in said or [] if w.isalpha()]
    got = {r["video_id"]: r.asDict() for r in L.align_words(words(spark, a), words(spark, b)).collect()}
    assert set(got) == {v for v in a | b if norm(a.get(v)) or norm(b.get(v))}
    for v, r in got.items():
        x, y = norm(a.get(v)), norm(b.get(v))
        assert r["n_equal"] + r["n_sub"] + r["n_del"] == len(x) and r["n_equal"] + r["n_sub"] + r["n_ins"] == len(y)
        assert r["agreement_milli"] == 1000 * r["n_equal"] // max(len(x), len(y))
        if (vocabulary, gram) != (4, 3):
            assert {k: r[k] for k in plain(x, y)} == plain(x, y), v
        else:
            assert r["n_equal"] >= 0.8 * plain(x, y)["n_equal"]


def test_edits_rebuild_the_other_side(spark):
    a, b = readings(8, 40, 400, 4)
    x, y = L.numbered(words(spark, a)), L.numbered(words(spark, b))
    found = L.anchors(x, y)
    equal = defaultdict(dict)
    for r in found.collect():
        equal[r["video_id"]][r["pb"]] = r["pa"]
    rows = defaultdict(list)
    for r in L.edits(x, y, L.stretches(found), words=True).collect():
        rows[r["video_id"]].append(r)
    for v in a | b:
        left, right = a.get(v, []), b.get(v, [])
        built, used = [None] * len(right), []
        for pb, pa in equal[v].items():
            built[pb] = left[pa]
            used.append(pa)
        for r in rows[v]:
            used += range(r["a_from"], r["a_to"])
            if r["what"] == "equal":
                built[r["b_from"] : r["b_to"]] = left[r["a_from"] : r["a_to"]]
            else:
                assert r["was"] == " ".join(left[r["a_from"] : r["a_to"]])
                built[r["b_from"] : r["b_to"]] = r["now"].split() if r["now"] else []
        assert sorted(used) == list(range(len(left)))
        assert [w if w.isalpha() else "" for w in built] == [w if w.isalpha() else "" for w in right]


def test_anchors_rise_and_are_longest(spark):
    a = {1: [f"w{i}" for i in range(60)]}
    moved = a[1][40:50] + a[1][:20] + a[1][30:40] + a[1][20:30] + a[1][50:]
    got = sorted((r["pa"], r["pb"]) for r in L.anchors(L.numbered(words(spark, a)), L.numbered(words(spark, {1: moved}))).collect())
    assert all(p[1] < q[1] for p, q in zip(got, got[1:])) and all(a[1][p] == moved[q] for p, q in got)
    assert len(got) == 18 + 8 + 8  # of the two stretches that changed places, one; the moved start is left out


def test_hunks_with_their_surroundings(spark):
    a, b = readings(5, 5000, 150, 3)
    got = defaultdict(list)
    for r in L.diff_hunks(words(spark, a), words(spark, b), context=3).orderBy("video_id", "n").collect():
        got[r["video_id"]].append(r)
    for v in a | b:
        x, y = a.get(v, []), b.get(v, [])
        norm = lambda said: [w if w.isalpha() else "" for w in said]
        ops = [o for o in SequenceMatcher(None, norm(x), norm(y), False).get_opcodes() if o[0] != "equal"]
        want = [
            (n, (100 * min(i, len(x) - 1)) if x else None, " ".join(x[max(0, i - 3) : i]), " ".join(x[i:j]), " ".join(y[k:m]), " ".join(x[j : j + 3]))
            for n, (_, i, j, k, m) in enumerate(ops)
        ]
        assert [tuple(r)[1:] for r in got[v]] == want, v


def test_a_hunk_of_a_whole_transcript(spark):
    """Its words go along once, not with each of its places."""
    n = 60_000
    r = L.diff_hunks(words(spark, {1: [f"word{i}" for i in range(n)], 2: ["a"]}), words(spark, {2: ["a"]})).collect()
    assert [(x["video_id"], x["n"], x["at_ms"], x["before"], x["now"], x["after"], len(x["was"].split())) for x in r] == [(1, 0, 0, "", "", "", n)]


def test_no_rows(spark):
    none = words(spark, {}).limit(0)
    assert L.align_words(none, none).count() == 0 and L.diff_hunks(none, none).count() == 0
    assert np.array_equal(M.letters(None), M.letters("")) and M.matching_blocks([], []) == []
    assert L.compare_summary(L.align_words(none, none)).first()["n"] == 0
    assert L.compare_transcripts(words(spark, {1: ["a"]}), words(spark, {1: ["b"]})).select(F.sum("n_sub")).first()[0] == 1


def test_proposed_matches_are_compared(spark):
    """Thue-Morse words of 1,024 letters collide modulo 2^64 for every base; what has no match is mostly left out before sorting."""
    x = "".join("ab"[i.bit_count() % 2] for i in range(2048))
    y = x.translate(str.maketrans("ab", "ba"))
    blocks = M.matching_blocks([M.letters(x)], [M.letters(y)])[0]
    assert M.opcodes(blocks, len(x), len(y)) == SequenceMatcher(None, x, y, False).get_opcodes()
    rng = np.random.default_rng(7)
    ka, kb = rng.integers(0, 2**64, 5000, np.uint64), rng.integers(0, 2**64, 5000, np.uint64)
    ka[[3, 4000]] = kb[[9, 17]]
    in_a, in_b = M._met(ka, kb)
    assert {3, 4000} <= set(in_a.tolist()) and {9, 17} <= set(in_b.tolist()) and max(len(in_a), len(in_b)) < 2000


def test_stretches_in_one_go_are_those_of_the_anchors(spark):
    rng = random.Random(5)
    a = {v: [f"w{rng.randrange(60)}" for _ in range(300)] for v in range(4)}
    b = {v: x[150:230] + [w for w in x[:150] if rng.random() > 0.05] + x[230:] for v, x in a.items()}
    x, y = L.numbered(words(spark, a)), L.numbered(words(spark, b))
    rows = lambda d: sorted(tuple(r[c] for c in ("video_id", "pa", "pa_to", "pb", "pb_to")) for r in d.collect())
    assert rows(L.anchors(x, y, joined=True)) == rows(L.stretches(L.anchors(x, y))) != []


def test_words_are_not_shuffled_after_their_texts(spark, sf):
    from cadenza.sources import views as V

    plan = L.numbered(V.words(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(doc_id" in plan


@pytest.mark.parametrize("batch", [3, 10_000])
def test_hunks_of_long_stretches_over_batches(spark, batch):
    """The middle of a long stretch is left out, surroundings reach over several gaps and into other batches."""
    rng = random.Random(11)
    a = {v: [f"w{i}" for i in range(n)] for v, n in enumerate((0, 1, 5, 200, 333))}
    b = {v: [w for i, w in enumerate(x) if not (60 < i % 100 < 90 and rng.random() < 0.3)] + ["end"] * (v % 2) for v, x in a.items()}
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        rows = L.diff_hunks(words(spark, a), words(spark, b), context=6).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    want = []
    for v, x in a.items():
        ops = [o for o in SequenceMatcher(None, x, b[v], False).get_opcodes() if o[0] != "equal"]
        want += [
            (v, n, (100 * min(i, len(x) - 1)) if x else None, " ".join(x[max(0, i - 6) : i]), " ".join(x[i:j]), " ".join(b[v][k:m]), " ".join(x[j : j + 6]))
            for n, (_, i, j, k, m) in enumerate(ops)
        ]
    assert sorted(tuple(r) for r in rows) == want and len(want) > 20


def exchanges(spark, sf, query, monkeypatch):
    """How rows are dealt in a query whose texts go to more tasks than shuffles have, besides for sums of a task."""
    import re

    from __spark_entry__ import queries
    from cadenza.sources import views as V

    monkeypatch.setattr(V, "TASK_BYTES", 20_000)
    assert V.text_tasks(spark, sf) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = queries()[query](spark, sf)._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((\w+)#\w+, (\d+)\), (\w+)|Exchange (hash\w+\(.*)", plan)


def test_hunks_are_told_where_texts_were_dealt(spark, sf, monkeypatch):
    found = exchanges(spark, sf, "sm8_diff_hunks", monkeypatch)
    assert {x[2] for x in found} == {"REPARTITION_BY_NUM"} and len({x[1] for x in found}) == 1, found


@pytest.mark.parametrize("query", ["sm7_align_words", "ag23_compare_summary", "tk3_worst_pairs"])
def test_words_to_align_stay_where_texts_were_dealt(spark, sf, monkeypatch, query):
    """Words are not dealt again, however many tasks their texts went to; sums of a task are."""
    from __spark_entry__ import queries
    from cadenza.sources import views as V

    monkeypatch.setattr(V, "TASK_BYTES", 20_000)
    plan = queries()[query](spark, sf)._jdf.queryExecution().executedPlan().toString().split("\n")
    dealt = [(line, below) for line, below in zip(plan, plan[1:]) if "Exchange hashpartitioning" in line]
    assert dealt and all("REPARTITION_BY_NUM" in line or "HashAggregate" in below for line, below in dealt), dealt


def test_short_blocks_are_not_searched_for(monkeypatch):
    """Gaps without long blocks are asked once whether they have one, then for each short length."""
    asked = []
    keys = M._Pairs.keys
    monkeypatch.setattr(M._Pairs, "keys", lambda self, *a: asked.append(1) or keys(self, *a))
    r = random.Random(2)
    x, y = ("".join(r.choice("etaoin shrdlu") for _ in range(4000)) for _ in range(2))
    blocks = M.matching_blocks([M.letters(x)], [M.letters(y)])[0]
    assert M.opcodes(blocks, len(x), len(y)) == SequenceMatcher(None, x, y, False).get_opcodes()
    assert len(asked) <= 2 * (M.SHORT + 2)
    for short in (0, 1, 3, 50):
        monkeypatch.setattr(M, "SHORT", short)
        test_matching_blocks_are_the_plain_ones(True)
