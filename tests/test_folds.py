"""Chunks and windows against plain folds, whatever the sizes of blocks and rounds."""

import random

import pytest

from cadenza.operators import grouping as G

SENTENCES = "video_id bigint, id bigint, start_ms bigint, end_ms bigint"


def videos(spark, seed, sizes):
    r, rows = random.Random(seed), []
    for v, n in enumerate(sizes):
        t, i = 0, 0
        for _ in range(n):
            i += r.choice([1, 1, 1, 3])  # ids need not be dense
            end = t + r.randrange(0, 4000)
            rows.append((v, i, t, end))
            t = end + r.choice([0, 100, 500, 500, 3000])
    return rows, spark.createDataFrame(rows, SENTENCES)


def by_video(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def plain_chunks(rows, target, slide, tail):
    n, reach, start, out = len(rows), int(target * slide), 0, []
    pause = [max(b[2] - a[3], 0) for a, b in zip(rows, rows[1:])]
    while start < n:
        stop = min(start + target, n) - 1
        if stop < n - 1 and reach:
            stop = max(range(max(start, stop - reach), min(n - 2, stop + reach) + 1), key=lambda i: (pause[i], -i))
        if n - 1 - stop < target * tail:
            stop = n - 1
        out.append((len(out), rows[start][1], rows[stop][1]))
        start = stop + 1
    return out


@pytest.mark.parametrize(("target", "slide", "tail"), [(80, 0.15, 0.5), (5, 0.6, 0.5), (3, 2.0, 0.0), (1, 0.0, 0.0), (7, 0.3, 2.0)])
def test_chunks(spark, monkeypatch, target, slide, tail):
    monkeypatch.setattr(G.chain_starts, "__defaults__", (6,))
    rows, s = videos(spark, target, [0, 1, 2, 5, 6, 7, 40, 160, 333])
    got = {}
    for r in G.plan_chunks(s, target, slide, tail).orderBy("video_id", "chunk").collect():
        got.setdefault(r["video_id"], []).append((r["chunk"], r["lo"], r["hi"]))
    assert got == {v: plain_chunks(x, target, slide, tail) for v, x in by_video(rows).items()}


@pytest.mark.parametrize("block", [1, 3, 10, 4096])
def test_chain_starts(spark, block):
    r = random.Random(block)
    rows = [(v, p, p + r.choice([1, 1, 2, 7, 40])) for v in range(4) for p in range((0, 1, 50, 300)[v])]
    want = set()
    for v in range(4):
        step = {p: n for w, p, n in rows if w == v}
        p = 0
        while p in step:
            want.add((v, p))
            p = step[p]
    got = [tuple(x) for x in G.chain_starts(spark.createDataFrame(rows, "video_id bigint, pos bigint, next bigint"), block).collect()]
    assert len(got) == len(want) and set(got) == want


def plain_window(rows, i, least):
    lo = hi = i
    left = True
    while rows[hi][3] - rows[lo][2] < least and (lo > 0 or hi < len(rows) - 1):
        if (left and lo > 0) or hi == len(rows) - 1:
            lo -= 1
        else:
            hi += 1
        left = not left
    return rows[lo][1], rows[hi][1]


@pytest.mark.parametrize(("least", "reach"), [(20_000, 8), (20_000, 1), (3000, 2), (10**9, 3), (0, 1)])
def test_widen(spark, least, reach):
    rows, s = videos(spark, 7, [1, 2, 9, 60, 90])
    r = random.Random(1)
    seeds = [(v, x[1]) for v, some in by_video(rows).items() for x in r.sample(some, 1 + len(some) // 4)] + [(3, 10**6), (77, 1)]
    got = {(x["video_id"], x["seed"]): (x["lo"], x["hi"]) for x in G.widen(spark.createDataFrame(seeds, "video_id bigint, id bigint"), s, least, reach).collect()}
    want = {}
    for v, some in by_video(rows).items():
        for i, x in enumerate(some):
            if (v, x[1]) in seeds:
                want[v, x[1]] = plain_window(some, i, least)
    assert got == want


def test_no_rows(spark):
    none = videos(spark, 1, [])[1]
    assert G.plan_chunks(none).count() == 0 and G.widen(none.select("video_id", "id"), none).count() == 0
