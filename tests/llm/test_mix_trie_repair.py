"""Mixing, the conversation trie and conversation repair against plain versions, and on odd inputs."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from cadenza.llm import mixing, repair, trie

DOCS = "doc_id bigint, text string, source string, size string, h string, copies int, name double"
TURNS = "conv_id bigint, turn bigint, role string, text string, words string, seq int, h double, present boolean"


def docs(spark, rows):
    """Documents (doc_id, text, source) with columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*r, "x", "y", 7, 0.5) for r in rows], DOCS)


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, owed = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values())
    while owed > 1e-9:
        some = [s for s in names if target[s] < 2 * sizes[s] - 1e-9]
        if not some:
            break
        share, owed_next = owed / sum(weight[s] for s in some), 0.0
        for s in some:
            target[s] += share * weight[s]
            if target[s] > 2 * sizes[s]:
                owed_next += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
        owed = owed_next
    return target


def corpus(n=900):
    r = random.Random(4)
    rows = []
    for i in range(n):
        words = "w " * (r.randrange(1, 60) if r.random() < 0.95 else r.randrange(400, 900))
        rows.append((i if i % 50 else None, words, r.choice(["a", "a", "a", "B", "é", "𐀀", "￿", None])))
    return [*rows, (9001, None, "a"), (9002, "", "empty"), (9003, " \n", None), (5, "same row", "B"), (5, "same row", "B")]


@pytest.mark.parametrize(("large", "rows", "fan"), [(1000, 20_000, 256), (10, 20, 3), (1, 40, 2)])
def test_mix(spark, monkeypatch, large, rows, fan):
    for name, value in (("LARGE", large), ("ROWS", rows), ("FAN", fan)):
        monkeypatch.setattr(mixing, name, value)
    given = corpus()
    got = [r.asDict() for r in mixing.mix(docs(spark, given)).collect()]
    assert sorted((r["doc_id"] or -1, r["source"] or "~", r["size"]) for r in got) == sorted((i or -1, s or "~", n_words(t)) for i, t, s in given)
    sizes, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, t, s in given:
        sizes[s] += n_words(t)
        longest[s] = max(longest[s], n_words(t))
    want = plain_targets(sizes)
    for r in got:
        assert r["copies"] in (0, 1, 2) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9, abs=1e-6)
        taken[r["source"]] += r["copies"] * r["size"]
    for s, n in taken.items():
        assert abs(n - want[s]) <= (max(60, sizes[s] / 100) if large > 1 else longest[s]), (s, n, want[s])
    again = docs(spark, random.Random(1).sample(given, len(given))).repartition(5)
    key = lambda rows: sorted((r["h"], r["copies"]) for r in rows)
    assert key(r.asDict() for r in mixing.mix(again).collect()) == key(got)


def test_transfer_keeps_words_and_means():
    r = random.Random(7)
    for _ in range(300):
        s, t = r.randrange(1, 50), r.randrange(1, 50)
        m, n = r.random() * s, r.random() * t
        ends = [mixing.transfer(s, m, t, n, (k + 0.5) / 4000) for k in range(4000)]
        for a, b in ends:
            assert a + b == pytest.approx(m + n) and (a in (0, s) or b in (0, t)) and -1e-9 <= a <= s + 1e-9 and -1e-9 <= b <= t + 1e-9
        assert sum(a for a, _ in ends) / 4000 == pytest.approx(m, abs=0.02 * (s + t))


def test_copies_are_unbiased(spark):
    given = [(i, "w " * (1 + i % 7), "a") for i in range(60)] + [(100 + i, "w " * 50, "b") for i in range(12)]
    total = defaultdict(int)
    for seed in range(12):
        for r in mixing.mix(docs(spark, given), seed=seed).collect():
            total[r["source"], r["size"] > 3] += r["copies"]
            rate = {r["source"]: r["target"] / r["source_size"]} if seed == 0 else None
    assert rate is None
    want = plain_targets({"a": sum(1 + i % 7 for i in range(60)), "b": 600})
    sizes = {"a": sum(1 + i % 7 for i in range(60)), "b": 600}
    n_long = sum(1 + i % 7 > 3 for i in range(60))
    for key, n in ((("a", True), n_long), (("a", False), 60 - n_long), (("b", True), 12)):
        mean = want[key[0]] / sizes[key[0]]
        assert abs(total[key] / (12 * n) - mean) < 0.2, (key, total[key], mean)


def test_mixture_repeats_rows(spark):
    given = corpus(80)
    mixed = mixing.mixture(docs(spark, given)).collect()
    copies = {}
    for r in mixing.mix(docs(spark, given)).where("copies > 0").collect():
        copies[r["doc_id"], r["h"]] = copies.get((r["doc_id"], r["h"]), 0) + r["copies"]
    assert len(mixed) == sum(copies.values())
    assert {r["name"] for r in mixed} == {0.5} and max(r["copy"] for r in mixed) >= 1
    assert mixing.mix(docs(spark, []).limit(0)).count() == 0
    assert [r["copies"] for r in mixing.mix(docs(spark, [(1, None, None), (1, " ", "x")])).collect()] == [0, 0]


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", 3, 0.1, True) for r in rows], TURNS)


def talks(seed=2, n=90):
    """Conversations with shared beginnings, copies, null fields, repeated turns and very long ones."""
    r = random.Random(seed)
    texts = ["Hi there.", "What now?", "No", "", None, " \t", "And so on!", "x y z", "a\nb.", "Wort für Wort."]
    rows = []
    for c in range(n):
        if c % 9 == 4:
            continue
        size = 70 if c in (20, 21, 33) else r.randrange(1, 6)
        said = random.Random(c % 5)
        for k in range(size):
            role = said.choice(["user", "assistant", "system", None, "tool"]) if r.random() < 0.9 else "user"
            rows.append((c, k + (k > 2) if r.random() < 0.95 else None, role, said.choice(texts)))
        if c % 11 == 0:
            rows.append(rows[-1])
    return rows


def plain_trie(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = own.get(c - c % 20, [])[:h] + seq[h:]
    members = defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    kids = defaultdict(set)
    for p in members:
        if p:
            kids[p[:-1]].add(p)
    out = []
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in m if len(whole[c]) == len(p))))
        saved = sum((len(members[q]) - 1) * n_words(q[-1][1]) for q in below if q)
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), sum(not kids[q] for q in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def in_order(rows):
    return sorted(tuple(-1 if v is None else v for v in r) for r in rows)


@pytest.mark.parametrize(("limit", "piece"), [(20_000, 4096), (40, 2), (3, 7)])
def test_trie(spark, monkeypatch, limit, piece):
    monkeypatch.setattr(trie, "PIECE", piece)
    rows = talks()
    given = turns(spark, [*rows, (None, 1, "user", "lost")])
    nodes = trie.prefix_trie(trie.rebuilt(trie.sequences(given)), limit=limit)
    assert in_order(nodes.select(COLUMNS).collect()) == in_order(plain_trie(rows))
    shown = trie.with_texts(nodes, given).where("depth > 0")
    assert shown.where("role is null or text is null").count() == 0 and shown.count() == nodes.count() - 1


def test_trie_of_nothing_and_of_copies(spark):
    assert trie.prefix_trie(trie.rebuilt(trie.sequences(turns(spark, []).limit(0)))).count() == 0
    same = [(c, 0, "user", "hello") for c in range(0, 4000, 20)]  # each begins with its own first turns
    got = trie.prefix_trie(trie.rebuilt(trie.sequences(turns(spark, same)))).orderBy("depth").select(COLUMNS).collect()
    assert in_order(got) == in_order(plain_trie(same)) and [r["n_convs"] for r in got] == [200, 200]


def test_double_array_places_every_child():
    r = random.Random(3)
    seqs = sorted({tuple(r.randrange(1, 40) for _ in range(r.randrange(0, 5))) for _ in range(500)})
    built = trie.DoubleArray([list(s) for s in seqs])
    found = {}
    for s in {q[:d] for q in seqs for d in range(len(q) + 1)}:
        state = 1
        for code in s:
            state = built.step(state, code)
            assert state
        found[s] = state
    assert len(set(found.values())) == len(found) == len(built.order)
    assert not built.step(1, 41)


def plain_repair(symbols):
    """Least (cost, audit) over all edits with at most two insertions."""
    n, found = len(symbols) // 2, []

    def go(i, roles, cost, audit, inserted):
        if inserted < 2:
            for x in "ua":
                go(i, roles + x, cost + 5, audit + "I", inserted + 1)
        if i == n:
            if re.fullmatch("(s?(ua)+)?", roles):
                found.append((cost, audit))
            return
        role, fault = symbols[2 * i : 2 * i + 2]
        go(i + 1, roles, cost + 2, audit + "D", inserted)
        if fault in "-t":
            more = 5 * (fault == "t")
            go(i + 1, roles + role, cost + more, audit + "K", inserted)
            for x in "ua":
                go(i + 1, roles + x, cost + 1 + more, audit + "R", inserted)

    go(0, "", 0, "", 0)
    return min(found)


def test_auction_finds_the_cheapest_audit(monkeypatch):
    r = random.Random(1)
    cases = ["".join(r.choice("suaa-u") + r.choice("---btd") for _ in range(r.randrange(6))) for _ in range(120)]
    want = [plain_repair(c) for c in cases]
    assert [repair.solve(c) for c in cases] == want
    monkeypatch.setattr(repair, "BLOCK", 2)
    assert [repair.solve(c) for c in cases] == want


def test_auction_of_a_long_conversation(monkeypatch):
    r = random.Random(5)
    long = "".join(r.choice("suaa-u") + r.choice("---btd") for _ in range(1500))
    cost, audit = repair.solve(long)
    monkeypatch.setattr(repair, "BLOCK", 300)
    assert repair.solve(long) == (cost, audit) and len(audit) == 1500


def test_insertions_are_arcs_that_can_win(monkeypatch):
    monkeypatch.setattr(repair, "INSERT", 1)
    assert repair.solve("u-") == (1, "KI") and repair.solve("a-") == (1, "IK") and repair.solve("s-") == (2, "D")
    assert [x["role"] for x in repair._apply([("system", "S."), ("user", "U.")], "KKI")] == ["system", "user", "assistant"]


def sql(query, rows):
    db = duckdb.connect()
    db.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        db.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return db.sql(query)


def test_repair_equals_sql(spark):
    rows = [*talks(8, 130), (None, 2, "user", "who?"), (None, None, "assistant", "me."), (777, 13, None, None)]
    got = repair.repair_conversations(repair.damaged(turns(spark, rows)))
    assert {r["conv_id"] for r in got.collect()} == {r[0] for r in rows}
    lines = F.transform("repaired", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    got = got.withColumn("repaired_sha256", F.sha2(F.array_join(lines, "\n").cast("binary"), 256)).drop("repaired")
    want = sql(repair.OP13_SQL, rows)
    assert in_order(got.select(want.columns).collect()) == in_order(want.fetchall())


def test_trie_equals_sql(spark):
    rows = talks(9, 60)
    got = trie.prefix_trie(trie.rebuilt(trie.sequences(turns(spark, rows)))).select(COLUMNS)
    assert in_order(got.collect()) == in_order(sql(f"SELECT {', '.join(COLUMNS)} FROM ({trie.OP12_SQL})", rows).fetchall())


def test_repaired_turns_are_whole(spark):
    rows = talks(11, 60)
    for r in repair.repair_conversations(turns(spark, rows)).collect():
        roles = "".join(x["role"][0] for x in r["repaired"])
        assert re.fullmatch("(s?(ua)+)?", roles) and r["cost"] >= 0
    assert repair.repair_conversations(turns(spark, []).limit(0)).count() == 0
    gone = turns(spark, [(1, 1, "user", "x")]).withColumn("present", F.lit(False))
    row = repair.repair_conversations(gone).first()
    assert (row["conv_id"], row["cost"], row["audit"], row["repaired"]) == (1, 0, "", [])
