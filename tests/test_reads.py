"""What the queries read and shuffle: inputs once, rows compactly."""

import json
import re

import pytest

from cadenza.operators import words as W
from cadenza.sources import readers as R


def scans(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("RelationV2")


def put(root, video, name, content):
    (root / video).mkdir(parents=True, exist_ok=True)
    (root / video / name).write_text(json.dumps(content))


def test_sentences_are_read_once(spark, tmp_path):
    put(tmp_path, "v1", "sentences.json", [{"id": 1, "text": "b", "start": 2, "end": 3}, {"id": 0, "text": "a", "start": 0, "end": 1}])
    s = R.read_sentences(spark, str(tmp_path))
    assert scans(s) == 1
    assert sorted((r["id"], r["text"]) for r in s.collect()) == [(0, "a"), (1, "b")]


def test_drafts_are_read_once(spark, tmp_path):
    put(tmp_path, "v1", "draft.json", [{"id": 0, "text_ru": "a"}, {"text_ru": "b"}, {"text_ru": "c"}, {"id": 2}, {"id": 3, "text_ru": "d"}, {"id": 3, "text_ru": "e"}])
    d = R.draft_rows(spark, str(tmp_path))
    assert scans(d) == 1
    found = sorted((r["id"] if r["id"] is not None else -1, r["reason"] or "") for r in d.collect())
    assert found == [(-1, "no_id"), (-1, "no_id"), (0, ""), (2, "no_text"), (3, "duplicate_id"), (3, "duplicate_id")]


def test_readings_are_gathered_by_one_aggregation(spark):
    from cadenza.operators.similarity import readings_agree

    of = lambda *rows: spark.createDataFrame(rows, "video_id bigint, lo bigint, seq bigint, word string")
    a = of((1, 0, 1, "b."), (1, 0, 0, "A"), (1, 20, 20, "x"), (2, 0, 0, "-"), (3, 0, 0, "only"))
    b = of((1, 0, 0, "ab"), (1, 20, 20, "y"), (2, 0, 0, "!"), (4, 0, 0, "only"))
    got = readings_agree(a, b)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    rows = sorted((r["video_id"], r["lo"], r["agree"]) for r in got.collect())
    assert rows == [(1, 0, True), (1, 20, False), (2, 0, False), (3, 0, False), (4, 0, False)]


def dealt(df) -> list[str]:
    """What each exchange of the plan deals by."""
    return re.findall(r"Exchange hashpartitioning\((\w+)#", df._jdf.queryExecution().executedPlan().toString())


def test_runs_collapse_where_texts_were_dealt(spark, sf):
    from cadenza.operators.words import collapse_runs
    from cadenza.sources import views as V

    assert dealt(collapse_runs(V.words(spark, sf))) == ["doc_id"]


def test_speech_is_merged_where_texts_were_dealt(spark, sf):
    from cadenza.sources import views as V

    assert dealt(V.speech(spark, sf)) == ["doc_id"]


def test_many_folders_make_few_tasks(tmp_path, monkeypatch):
    """A file with a plain name is looked up and its folder not listed."""
    from pyarrow import fs

    from cadenza.sources.artifacts import ArtifactReader

    monkeypatch.setattr(fs, "FileSelector", lambda *a, **b: pytest.fail("listed"))
    for k in range(3):
        put(tmp_path, f"{k}", "a.json", k)
    put(tmp_path, "3", "b.json", 3)
    reader = ArtifactReader({"path": str(tmp_path), "name": "a.json"})
    reader.only = {str(k) for k in range(20_000)}
    tasks = reader.partitions()
    assert len(tasks) <= 100
    rows = [r for t in tasks for b in reader.read(t) for r in b.to_pylist()]
    assert sorted((r["video_id"], r["file"], r["value"]) for r in rows) == [("0", "a.json", "0"), ("1", "a.json", "1"), ("2", "a.json", "2")]


def test_a_rollup_reads_its_report_once_and_keeps_no_maps(spark, sf):
    from cadenza.operators import rollup as A
    from cadenza.sources import views as V

    plan = A.run_rollup(V.report(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and "ObjectHashAggregate" not in plan


def test_percentiles_by_rank_are_percentile(spark):
    from pyspark.sql import functions as F

    from cadenza.operators import rollup as A

    rows = [(v, (k * 7919) % 1009 if k % 5 else None) for v in range(40) for k in range(v)]
    df = spark.createDataFrame(rows, "video_id bigint, x bigint")
    new = A._ranked(df, F.col("x")).groupBy("video_id").agg(A._percentile(0.5).alias("a"), A._percentile(0.95).alias("b"))
    old = df.groupBy("video_id").agg(F.percentile("x", 0.5).alias("a"), F.percentile("x", 0.95).alias("b"))
    assert sorted(map(tuple, new.collect()), key=str) == sorted(map(tuple, old.collect()), key=str)


def test_an_upsert_deals_its_rows_once(spark):
    """Base and batch go to their buckets in one shuffle; a field given as null overwrites, others keep theirs."""
    from pyspark.sql import functions as F

    from cadenza.streaming.arrivals import _upserted

    base = spark.createDataFrame([("v", 1, "a", "x"), ("v", 2, "b", "y"), ("w", 1, "c", "z")], "video_id string, id bigint, text string, status string")
    batch = spark.createDataFrame([("v", 1, "n1", 1), ("v", 1, "n2", 2), ("v", 2, None, 3), ("u", 5, "m", 1)], "video_id string, id bigint, status string, at int")
    got = _upserted(base, batch, "at", F.lit(3).alias("bucket"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    rows = sorted((r["video_id"], r["id"], r["text"], r["status"]) for r in got.collect())
    assert rows == [("u", 5, None, "m"), ("v", 1, "a", "n2"), ("v", 2, "b", None), ("w", 1, "c", "z")]


def test_a_video_of_few_ids_costs_the_gate_few_calls():
    """Each call to the state store is a round trip."""
    from unittest.mock import MagicMock

    import pandas as pd

    from cadenza.streaming.arrivals import _Gate

    calls, held = [], {}

    def store(name):
        box = MagicMock()
        box.get.side_effect = lambda: calls.append("get") or held.get(name)
        box.exists.side_effect = lambda: calls.append("exists") or name in held
        box.update.side_effect = lambda v: calls.append("update") or held.update({name: v})
        box.clear.side_effect = lambda: calls.append("clear") or held.pop(name, None)
        box.containsKey.side_effect = lambda k: calls.append("containsKey") or k in held.get("of", {})
        box.getValue.side_effect = lambda k: calls.append("getValue") or held.get("of", {}).get(k)
        box.updateValue.side_effect = lambda k, v: calls.append("updateValue") or held.setdefault("of", {}).update({k: v})
        return box

    handle = MagicMock()
    handle.getMapState.side_effect = lambda name, *a: store(name)
    handle.getValueState.side_effect = lambda name, *a: store(name)
    handle.registerTimer.side_effect = lambda at: calls.append("registerTimer")
    handle.deleteTimer.side_effect = lambda at: calls.append("deleteTimer")
    handle.listTimers.side_effect = lambda: calls.append("listTimers") or iter([600])
    now = MagicMock()
    now.getCurrentProcessingTimeInMs.return_value = 0
    gate = _Gate(600)
    gate.init(handle)
    batch = lambda *rows: iter([pd.DataFrame(rows, columns=["video_id", "kind", "id"])])
    assert not list(gate.handleInputRows(("v",), batch(("v", "want", 0), ("v", "want", 62), ("v", "have", 0)), now))
    assert len(calls) <= 3
    told = list(gate.handleInputRows(("v",), batch(("v", "have", 62), ("v", "want", None)), now))
    assert len(calls) <= 6 and not held
    assert told[0].values.tolist() == [["v", "ready", 2, []]]


def test_sentences_are_cut_and_merged_where_texts_were_dealt(spark, sf):
    from cadenza.operators.words import resegment
    from cadenza.sources import views as V

    out = resegment(V.words(spark, sf))
    assert dealt(out) == ["doc_id"]
    ids: dict = {}
    for r in out.select("video_id", "id").collect():
        ids.setdefault(r["video_id"], []).append(r["id"])
    assert ids and all(sorted(i) == list(range(len(i))) for i in ids.values())


def test_stitching_sorts_no_words(spark):
    """Windows are joined by a hash of theirs: a task that sorts words holds as many as fit its memory."""
    rows = [(1, i, 100 * i, k, 0 if k == 0 else 3000, 6000 if k == 0 else 9000) for i in range(90) for k in (0, 1) if (100 * i < 6000 if k == 0 else 100 * i >= 3000)]
    words = spark.createDataFrame(rows, "video_id bigint, seq bigint, start_ms bigint, win_no bigint, w_start bigint, w_end bigint")
    out = W.stitch_windows(words)
    assert sorted((r["seq"], r["win_no"]) for r in out.collect()) == [(i, int(i >= 45)) for i in range(90)]
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = W.stitch_windows(words)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_texts_are_dealt_to_more_tasks_as_they_grow(spark, sf, monkeypatch):
    """A fixed number of tasks sorted more words each with every larger table, and spilled them."""
    from cadenza.sources import views as V

    assert V.texts(spark, sf).rdd.getNumPartitions() == 4
    monkeypatch.setattr(V, "TASK_BYTES", 1 << 10, raising=False)
    assert V.texts(spark, sf).rdd.getNumPartitions() > 40


def test_gate_leaves_its_timer(spark):
    """What arrives before the deadline sets no timer anew; one that fires too early is set for when the video is due."""
    from unittest.mock import MagicMock

    import pandas as pd

    from cadenza.streaming.arrivals import _Gate

    timers, held = [], {}
    handle, now, head = MagicMock(), MagicMock(), MagicMock()
    handle.registerTimer.side_effect = lambda at: timers.append(("set", at))
    handle.deleteTimer.side_effect = lambda at: timers.append(("gone", at))
    head.get.side_effect = lambda: held.get("head")
    head.update.side_effect = lambda v: held.update(head=v)
    head.clear.side_effect = lambda: held.pop("head", None)
    handle.getValueState.side_effect = lambda *a: head
    gate = _Gate(600)
    gate.init(handle)

    def at(ms, *rows):
        now.getCurrentProcessingTimeInMs.return_value = ms
        out = gate.handleInputRows(("v",), iter([pd.DataFrame(rows, columns=["video_id", "kind", "id"])]), now) if rows else gate.handleExpiredTimer(("v",), now, MagicMock())
        return [x for d in out for x in d.values.tolist()]

    assert at(0, ("v", "want", 0)) == at(100, ("v", "want", 5)) == at(200, ("v", "have", 0)) == [] and timers == [("set", 600)]
    assert at(650) == [] and timers == [("set", 600), ("set", 800)]
    gate.deadline_ms = 10
    assert at(700, ("v", "have", 1)) == [] and timers[2:] == [("gone", 800), ("set", 710)]
    assert at(720) == [["v", "pending", 2, [5]]] and not held
