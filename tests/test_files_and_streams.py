"""Readers and writers over small folders, and streams against their batch results."""

import json

import pytest
from pyspark.sql import functions as F

from cadenza.sources import readers as R
from cadenza.sources import sinks
from cadenza.streaming import arrivals


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content if isinstance(content, str) else json.dumps(content))


def test_readers(spark, tmp_path):
    put(tmp_path / "v1/words.json", [{"text": "Hi", "start": 0, "end": 0.5}, {"text": "all", "start": 1, "end": 2, "seg_end": True}])
    put(tmp_path / "v1/sentences.json", [{"id": 0, "text": "a", "start": 0, "end": 1.5}, {"id": 1, "text": "b", "start": 2, "end": 3}])
    put(tmp_path / "v2/sentences.json", '[{"id": 0, "te')
    put(tmp_path / "v1/draft.json", [{"id": 0, "text_ru": "да"}, {"id": 1, "text_ru": 5}, {"id": 2, "text_ru": "x", "src": 3}, {"id": 2, "text_ru": "y"}])
    w = R.read_words(spark, str(tmp_path)).orderBy("seq").collect()
    assert [(r["video_id"], r["word"], r["end_ms"], r["seg_end"]) for r in w] == [("v1", "Hi", 500, False), ("v1", "all", 2000, True)]
    s = R.read_sentences(spark, str(tmp_path)).orderBy("id").collect()
    assert [(r["video_id"], r["id"], r["end_ms"]) for r in s] == [("v1", 0, 1500), ("v1", 1, 3000)]
    good, bad = R.read_draft(spark, str(tmp_path))
    assert [(r["id"], r["text_ru"]) for r in good.collect()] == [(0, "да")]
    assert sorted((r["id"], r["reason"]) for r in bad.collect()) == [(1, "text_type"), (2, "duplicate_id"), (2, "duplicate_id")]
    put(tmp_path / "v3/sentences.json", [{"id": 1, "text": "a", "start": 0, "end": 1}])
    with pytest.raises(Exception, match="not contiguous"):
        R.read_sentences(spark, str(tmp_path)).collect()
    inv = {(r["video_id"], r["artifact"]) for r in R.read_inventory(spark, str(tmp_path)).collect()}
    assert ("v1", "words.json") in inv and ("v2", "sentences.json") in inv


def test_queue(spark, tmp_path):
    put(tmp_path / "q.txt", "﻿# playlist: Mine | https://x.org/list\nhttps://youtu.be/abcdefghijk\n\nhttps://youtu.be/abcdefghijk\nhttps://x.org/other\n")
    q = R.read_queue(spark, str(tmp_path / "q.txt")).collect()
    assert [(r["video_id"], r["pos"], r["n"]) for r in q] == [("abcdefghijk", 1, 2)]
    assert R.read_queue(spark, str(tmp_path / "q.txt"), "hash").count() == 2
    h = R.queue_header(R._lines(spark, str(tmp_path / "q.txt"))).first()
    assert (h["title"], h["url"]) == ("Mine", "https://x.org/list")


def test_stress_dict(spark, tmp_path):
    put(tmp_path / "d.txt", ";;; note\nREDDIT  R EH1 D IH0 T\nREDDIT(2)  R EH0 D IH1 T\nAGO  AH0 G OW1\n")
    assert {r["word"]: r["stress"] for r in R.read_stress_dict(spark, str(tmp_path / "d.txt")).collect()} == {"reddit": 0, "ago": 1}


def test_table_replaces_only_its_videos(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.createDataFrame([("a", 1), ("b", 2)], "video_id string, n int"), path)
    sinks.write_table(spark.createDataFrame([("a", 9)], "video_id string, n int"), path)
    assert sorted((r["video_id"], r["n"]) for r in spark.read.parquet(path).collect()) == [("a", 9), ("b", 2)]


def test_gate_waits_for_all_ids(spark, tmp_path):
    schema = "video_id string, kind string, id bigint"
    deadline = [10**9]

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))

    def run():
        """A new query that goes on from where the last one stopped."""
        stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
        told = arrivals.completeness_gate(stream, deadline[0]).writeStream.format("parquet").outputMode("append")
        told = told.option("checkpointLocation", str(tmp_path / "cp")).option("path", str(tmp_path / "out"))
        q = told.trigger(availableNow=True).start()
        done = q.awaitTermination(90)
        q.stop()
        assert done
        files = list((tmp_path / "out").glob("*.parquet"))
        return sorted((r["video_id"], r["state"], r["n_ids"], r["missing"]) for f in files for r in spark.read.parquet(str(f)).collect())

    spark.conf.set(*arrivals.STORE)
    # a stream with timers has a next batch for ever; here it ends with its data
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        far = 10**12
        arrive([("a", "want", 0), ("a", "want", far), ("a", "want", None), ("a", "have", 0), ("b", "want", 0), ("c", "have", -5)])
        assert run() == []
        arrive([("a", "have", far), ("a", "have", 7), ("b", "have", 0), ("c", "want", -5)])
        ready = [("a", "ready", 2, [])]
        assert run() == ready  # b and c have all they want, but more may be wanted
        deadline[0] = 1
        arrive([("b", "want", 200), ("b", "want", 200), ("b", "want", 64), ("c", "want", None)])
        ready.append(("c", "ready", 1, []))
        assert run() == ready
        arrive([("d", "want", None), ("a", "have", 1)])
        ready.insert(1, ("b", "pending", 3, [64, 200]))
        assert run() == ready
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
        spark.conf.unset(arrivals.STORE[0])


def rows_of(df):
    return sorted(map(tuple, df.select("video_id", "id", "a", "b").collect()))


def test_upsert_stream(spark, tmp_path):
    path = str(tmp_path / "t")
    write = arrivals.upsert_into(path)
    assert arrivals.snapshot(spark, path) is None
    schema = "video_id string, id bigint, a string, b string"
    write(spark.createDataFrame([("v", 0, "x", None), ("v", 1, "y", None)], schema), 0)
    patch = spark.createDataFrame([("v", 0, "z")], "video_id string, id bigint, b string")
    write(patch, 1)
    write(patch, 1)
    want = [("v", 0, "x", "z"), ("v", 1, "y", None)]
    assert rows_of(arrivals.snapshot(spark, path)) == want
    write(patch.limit(0), 2)
    assert rows_of(arrivals.snapshot(spark, path)) == want


def test_upsert_writes_what_the_batch_touches(spark, tmp_path):
    path = tmp_path / "t"
    write = arrivals.upsert_into(str(path), buckets=64)
    schema = "video_id string, id bigint, a string, b string"
    write(spark.createDataFrame([(f"v{k}", i, f"text {k} {i}", None) for k in range(300) for i in range(20)], schema), 0)
    size = lambda v: sum(f.stat().st_size for f in (path / f"data/version={v}").rglob("*.parquet"))
    write(spark.createDataFrame([("v7", 3, "new")], "video_id string, id bigint, b string"), 1)
    assert len(list((path / "data/version=1").glob("bucket=*"))) == 1 and size(1) < size(0) / 20
    got = arrivals.snapshot(spark, str(path))
    assert got.count() == 6000 and rows_of(got.where("b is not null")) == [("v7", 3, "text 7 3", "new")]


def test_upsert_survives_a_failed_commit_and_a_replay(spark, tmp_path):
    path = tmp_path / "t"
    write = arrivals.upsert_into(str(path), buckets=2)
    schema = "video_id string, id bigint, a string, b string"
    write(spark.createDataFrame([(f"v{k}", 0, "old", None) for k in range(8)], schema), 0)
    before = rows_of(arrivals.snapshot(spark, str(path)))
    patch = spark.createDataFrame([("v1", 0, "new"), ("v9", 1, "b")], "video_id string, id bigint, b string")
    write(patch, 1)
    after = rows_of(arrivals.snapshot(spark, str(path)))
    for f in (path / "commits/of=1").iterdir():
        f.unlink()  # the data of the batch stand, its manifest does not
    assert rows_of(arrivals.snapshot(spark, str(path))) == before
    put(path / "commits/of=1/part.json", '{"bucket": 0, "held": 1, "n": 2, "version": 1}\n{"buck')  # a torn one
    assert rows_of(arrivals.snapshot(spark, str(path))) == before
    write(patch, 1)
    assert rows_of(arrivals.snapshot(spark, str(path))) == after and ("v1", 0, "old", "new") in after
    write(spark.createDataFrame([("v1", 0, "newer")], "video_id string, id bigint, a string"), 2)
    write(patch, 1)  # a batch of the past does not undo later ones
    assert ("v1", 0, "newer", "new") in rows_of(arrivals.snapshot(spark, str(path)))


def test_runs_stream_drops_repeats(spark, tmp_path):
    rows = ['{"run_id": "r1", "started": "2026-01-01T00:00:00Z", "finished": "2026-01-01T00:01:00Z"}', "{torn", '{"run_id": "r1", "started": "2026-01-01T00:00:00Z"}']
    put(tmp_path / "in/runs.jsonl", "\n".join(rows))
    q = arrivals.run_ingest(R.read_runs(spark, str(tmp_path / "in"), streaming=True)).select("run_id", "seconds")
    q = q.writeStream.format("parquet").outputMode("append").option("checkpointLocation", str(tmp_path / "cp"))
    q = q.option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
    done = q.awaitTermination(90)
    q.stop()
    assert done
    got = [(r["run_id"], r["seconds"]) for f in (tmp_path / "out").glob("*.parquet") for r in spark.read.parquet(str(f)).collect()]
    assert got == [("r1", 60)]


def test_artifacts_push_filters_and_keep_torn_files(spark, tmp_path):
    from cadenza.sources.artifacts import artifacts

    put(tmp_path / "a/x.json", [{"n": 1}, {"n": "two"}, {"m": 3}, {"n": None}, 5])
    put(tmp_path / "b/x.json", '[{"n": 1}, {"n"')
    put(tmp_path / "video_id=c%3Ad/x.json", {"n": 4})
    put(tmp_path / "e/x.json", [])
    put(tmp_path / "f/x.json", "")
    put(tmp_path / "g/y.json", "{}")
    put(tmp_path / "a/_hidden/x.json", "{}")
    rows = R.read_artifact(spark, str(tmp_path), "x.json", "n int").collect()
    assert sorted((r["video_id"], -1 if r["seq"] is None else r["seq"], r["n"], r["_rejects"], r["_corrupt"]) for r in rows if r["video_id"] != "a") == [
        ("b", -1, None, None, '[{"n": 1}, {"n"'), ("c:d", 0, 4, [], None), ("f", -1, None, None, ""),
    ]
    assert [(r["n"], r["_rejects"]) for r in sorted((r for r in rows if r["video_id"] == "a"), key=lambda r: r["seq"])] == [
        (1, []), (None, ["n"]), (None, []), (None, []), (None, ["n"]),
    ]
    one = artifacts(spark, f"file:{tmp_path}").where("video_id in ('c:d', 'g', 'absent', '..', '../x')")
    assert sorted((r["video_id"], r["file"], r["value"]) for r in one.collect()) == [("c:d", "x.json", '{"n": 4}'), ("g", "y.json", "{}")]
    assert one.rdd.getNumPartitions() == 1
    assert "IN" not in one._jdf.queryExecution().executedPlan().toString()  # the filter went into the source
    assert artifacts(spark, str(tmp_path / "nothing")).count() == 0
    assert artifacts(spark, str(tmp_path)).where("video_id = 'a' and video_id = 'b'").count() == 0


def test_clean_chunks(spark, tmp_path):
    put(tmp_path / "v/0-1.json", [{"id": 0, "text": " a "}, {"id": 1, "text": ""}])
    put(tmp_path / "v/2-3.json", [{"id": 2, "text": None}, {"text": "x"}])
    put(tmp_path / "v/4-5.json", '[{"id"')
    put(tmp_path / "v/other-1.json", [])
    good, bad = R.read_clean_chunks(spark, str(tmp_path))
    assert sorted((r["chunk"], r["lo"], r["hi"], r["id"], r["text"]) for r in good.collect()) == [("0-1", 0, 1, 0, "a"), ("0-1", 0, 1, 1, "")]
    assert sorted((r["chunk"], r["reason"]) for r in bad.collect()) == [("2-3", "no_id"), ("2-3", "null_text"), ("4-5", "torn")]


def test_artifacts_are_written_by_tasks(spark, tmp_path):
    """One whole file for each video, names escaped, others left, nothing moved by the driver; many folders to a task."""
    from cadenza.sources import artifacts as S

    rows = spark.createDataFrame([(f"v/{i}:%", f'{{"n": {i}}}') for i in range(60)] + [("none", None)], "video_id string, value string")
    put(tmp_path / "video_id=none/other.json", "{}")
    S.write_artifacts(rows.withColumn("value", S.F.lit("old")), str(tmp_path), "x.json")
    S.write_artifacts(rows, f"file:{tmp_path}", "x.json")
    got = S.artifacts(spark, str(tmp_path), "x.json")
    assert sorted((r["video_id"], r["value"]) for r in got.collect()) == sorted((r["video_id"], r["value"] or "") for r in rows.collect())
    assert len(list(tmp_path.rglob("*"))) == 61 + 62  # folders, files; no hidden ones, no _temporary
    reader = S.ArtifactReader({"path": str(tmp_path)})
    names = [f"d{i}" for i in range(100_000)]
    reader.only = set(names)
    assert len(reader.partitions()) <= S.TASKS


def test_tables_have_few_files_and_keep_other_videos(spark, tmp_path, monkeypatch):
    """Videos share files; ids stay what they are, also as another type; a broken write leaves all as it was."""
    path = str(tmp_path / "t")
    table = lambda: sorted((r["video_id"], r["n"], r["id"]) for r in spark.read.parquet(path).collect())
    first = spark.range(3000).selectExpr("lpad(cast(id div 2 as string), 6, '0') as video_id", "id", "1 as n")
    sinks.write_table(first, path)
    want = sorted(tuple(r) for r in first.select("video_id", "n", "id").collect())
    assert table() == want and len(list((tmp_path / "t").glob("*.parquet"))) <= sinks.FILES and not list((tmp_path / "t").glob("_*"))
    again = first.where("id % 6 = 0").withColumn("n", F.lit(2))
    monkeypatch.setattr(sinks, "FILES", 7)  # the table has its own number
    with monkeypatch.context() as broken, pytest.raises(RuntimeError):
        broken.setattr(sinks._Place, "replace", lambda *_: (_ for _ in ()).throw(RuntimeError()))
        sinks.write_table(again, path)
    assert table() == want and not list((tmp_path / "t").glob("_*"))
    sinks.write_table(again, path)
    gone = {f"{v:06}" for v in range(0, 1500, 3)}
    assert table() == sorted([r for r in want if r[0] not in gone] + [(v, 2, 2 * int(v)) for v in gone])
    before = table()
    sinks.write_table(again.limit(0), path)
    assert table() == before
    numbers = str(tmp_path / "numbers")
    sinks.write_table(spark.sql("select 1L as video_id, 1 as n union all select null, 2 union all select 3, 3"), numbers)
    sinks.write_table(spark.sql("select 1 as video_id, 4 as n union all select null, 5"), numbers)
    assert sorted((r["video_id"] or 0, r["n"]) for r in spark.read.parquet(numbers).collect()) == [(0, 5), (1, 4), (3, 3)]
    sinks.write_table(spark.createDataFrame([], "video_id string, n int"), str(tmp_path / "none"))
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0
    (tmp_path / "other/video_id=1").mkdir(parents=True)
    with pytest.raises(ValueError):
        sinks.write_table(again, str(tmp_path / "other"))


def test_artifacts_are_compressed_by_their_name(spark, tmp_path):
    """Read as they were; a torn one is one row, as others are; rows that are dealt stay in their tasks."""
    import gzip

    from cadenza.sources import artifacts as S

    text = json.dumps([{"text": f"w{i}", "start": i / 10, "end": i / 10, "seg_end": False} for i in range(2000)])
    rows = spark.createDataFrame([("a", text), ("b", "[]"), ("c", text)], "video_id string, value string")
    S.write_artifacts(rows, str(tmp_path), "words.json.zst", dealt=True)
    files = sorted(tmp_path.rglob("words.json.zst"))
    assert len(files) == 3 and len(list(tmp_path.rglob("*"))) == 6 and files[0].stat().st_size < len(text) / 4
    (tmp_path / "video_id=c/words.json.zst").write_bytes(files[2].read_bytes()[:200])
    put(tmp_path / "video_id=d/other.json", "{}")
    (tmp_path / "video_id=d/words.json.gz").write_bytes(gzip.compress(b'[{"text": "x"}]'))
    got = {r["video_id"]: r["value"] for r in S.artifacts(spark, str(tmp_path), "words.json.*").collect()}
    assert got == {"a": text, "b": "[]", "c": "", "d": '[{"text": "x"}]'}
    read = R.read_words(spark, str(tmp_path), "words.json.zst")
    assert read.count() == 2000 and R.read_artifact(spark, str(tmp_path), "words.json.zst", R.WORDS).where("_corrupt is not null").count() == 1


def test_words_are_written_where_their_texts_were_dealt(spark, sf, monkeypatch, tmp_path):
    from cadenza.plans import files
    from cadenza.plans.registry import QUERIES
    from cadenza.sources import artifacts as S

    monkeypatch.setattr(files, "place", lambda _: str(tmp_path))
    written = []
    save = files.write_artifacts
    monkeypatch.setattr(files, "write_artifacts", lambda rows, root, name, *a, **k: (written.append((rows, name)), save(rows, root, name, *a, **k)))
    count = QUERIES["src1_read_words"](spark, sf).count()
    rows, name = written[0]
    assert count > 1000 and name == "words.json.zst" and rows._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert not list(tmp_path.rglob("words.json")) and S.artifacts(spark, str(tmp_path), name).count() > 100
