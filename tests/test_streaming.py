from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from agorameter import __main__ as cli
from agorameter.operators.messages import to_messages
from agorameter.plans import enrich, reports
from agorameter.schemas import DATASETS, POSTS
from agorameter.sinks.topics import write_topic_files
from agorameter.sources.topics import files_per_batch, stream_topic_files
from agorameter.streaming import incremental, jobs, late, latest, moods, trends


def send(spark, path, rows, topic="fb_posts"):
    df = spark.createDataFrame(rows, "uuid string, retrieving_time string, timestamp string, content string")
    write_topic_files(to_messages(df, F.lit(topic)).coalesce(1), path)


def posts(prefix, n, day=1):
    return [
        (f"{prefix}{i}", "2024-10-01T00:00:00", f"2024-09-{day:02}T0{i % 10}:00:00", f"good {i}")
        for i in range(n)
    ]


def table(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).collect())


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("topics", "out", "checkpoint"))

    def run():
        stream = enrich.enrich_posts(stream_topic_files(spark, source, "fb_posts", max_files=1))
        jobs.run_in_turn([lambda: jobs.start_table_sink(stream, out, checkpoint)])

    def batch():
        return enrich.enrich_posts(spark.read.parquet(f"{source}/topic=fb_posts"))

    send(spark, source, posts("a", 5))
    send(spark, source, posts("b", 5))
    run()
    first = table(spark, out)
    assert first == sorted(tuple(r) for r in batch().collect()) and len(first) == 10
    run()
    assert table(spark, out) == first, "a rerun adds nothing"
    send(spark, source, posts("c", 3))
    run()
    assert len(table(spark, out)) == 13
    assert table(spark, out) == sorted(tuple(r) for r in batch().collect())


def test_malformed_messages_flow_on(spark, tmp_path, messages):
    source = str(tmp_path / "topics")
    rows = messages(["{broken", '{"uuid":"a","content":"good"}']).select(
        F.lit(None).cast("binary").alias("key"), "value", F.lit("fb_posts").alias("topic")
    )
    write_topic_files(rows, source)
    stream = enrich.enrich_posts(stream_topic_files(spark, source, "fb_posts"))
    out = str(tmp_path / "out")
    jobs.run_in_turn([lambda: jobs.start_table_sink(stream, out, str(tmp_path / "c"))])
    found = {r.uuid: (r.sentiment_label, r.emotion_label) for r in spark.read.parquet(out).collect()}
    assert found[None] == ("neutral", "null")
    assert found["a"][0] in ("neutral", "positive")


def test_batch_folders_are_repeatable(spark, tmp_path):
    write = jobs.batch_folder_writer(str(tmp_path / "out"), ("uuid", "retrieving_time"))
    rows = [("a", "1", 1), ("a", "1", 1), ("a", "2", 1), (None, "1", 1), (None, "1", 1)]
    df = spark.createDataFrame(rows, "uuid string, retrieving_time string, n int")
    for _ in range(2):
        write(df, 7)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 4
    assert back.columns == ["uuid", "retrieving_time", "n", "batch_id"]
    assert back.filter("uuid IS NULL").count() == 2, "rows without a key are all kept"


def test_batch_sink(spark, tmp_path):
    source = str(tmp_path / "topics")
    send(spark, source, posts("a", 4))
    send(spark, source, posts("a", 4))
    stream = enrich.enrich_posts(stream_topic_files(spark, source, "fb_posts"))
    write = jobs.batch_folder_writer(str(tmp_path / "out"), POSTS.key)
    starter = lambda: jobs.start_batch_sink(stream, write, str(tmp_path / "c"))
    jobs.run_in_turn([starter])
    jobs.run_in_turn([starter])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_repeats_in_other_batches(spark, tmp_path):
    """The same record twice, two versions of one key, and records without a key."""
    source = str(tmp_path / "topics")
    for version in ("1", "1", "2", None, None):
        rows = [("a" if version else None, version)]
        df = spark.createDataFrame(rows, "uuid string, retrieving_time string")
        write_topic_files(to_messages(df, F.lit("fb_posts")), source)
    stream = enrich.enrich_posts(stream_topic_files(spark, source, "fb_posts", max_files=1))
    once = jobs.without_repeats(stream, POSTS.key)
    out = str(tmp_path / "out")
    jobs.run_in_turn([lambda: jobs.start_table_sink(once, out, str(tmp_path / "c"))])
    found = [r.retrieving_time for r in spark.read.parquet(out).collect()]
    assert sorted(found, key=str) == ["1", "2", None, None]


def test_a_dead_query_ends_those_that_run_together(spark, tmp_path):
    source = str(tmp_path / "topics")
    send(spark, source, posts("a", 2))

    def alive():
        stream = enrich.enrich_posts(stream_topic_files(spark, source, "fb_posts"))
        return jobs.start_table_sink(
            stream, str(tmp_path / "out"), str(tmp_path / "c1"), "1 second", name="alive"
        )

    def dead():
        stream = enrich.enrich_posts(stream_topic_files(spark, source, "fb_posts"))

        def fail(batch, batch_id):
            raise ValueError("no disk")

        return jobs.start_batch_sink(stream, fail, str(tmp_path / "c2"), "1 second")

    with pytest.raises(Exception, match="no disk"):
        jobs.run_together([alive, dead])
    assert not [q for q in spark.streams.active if q.name == "alive"]


def test_unreadable_times_are_an_output(spark):
    rows = [("2024-09-01T10:00:00",), ("soon",), (None,)]
    df = spark.createDataFrame(rows, "timestamp string")
    assert trends.unreadable_times(df).count() == 2


def test_a_checkpoint_is_required(spark, tmp_path):
    stream = spark.readStream.schema("a int").parquet(str(tmp_path))
    with pytest.raises(ValueError):
        jobs.start_table_sink(stream, str(tmp_path / "out"), "")


def test_interval_trigger(spark, tmp_path):
    source, out = str(tmp_path / "topics"), str(tmp_path / "out")
    send(spark, source, posts("a", 3))
    stream = enrich.enrich_posts(stream_topic_files(spark, source, "fb_posts"))
    query = jobs.start_table_sink(stream, out, str(tmp_path / "c"), "1 second", name="posts")
    try:
        query.processAllAvailable()
        assert spark.read.parquet(out).count() == 3
        assert query.name == "posts" and query.isActive
    finally:
        query.stop()


def test_queries_in_turn_and_together(spark, tmp_path):
    source = str(tmp_path / "topics")
    send(spark, source, posts("a", 2))
    send(spark, source, posts("b", 3), "fb_comments")

    def starter(run, name):
        stream = enrich.enrich(stream_topic_files(spark, source, name), DATASETS[name])
        return lambda: jobs.start_table_sink(
            stream, str(tmp_path / run / name), str(tmp_path / run / "c" / name)
        )

    for run in (jobs.run_in_turn, jobs.run_together):
        ended = run([starter(run.__name__, n) for n in ("fb_posts", "fb_comments")])
        assert not any(q.isActive for q in ended)
        counts = [
            spark.read.parquet(str(tmp_path / run.__name__ / n)).count()
            for n in ("fb_posts", "fb_comments")
        ]
        assert counts == [2, 3]


def test_trend_with_late_records(spark, tmp_path):
    """Days are written once the watermark has passed them; what comes later is left out."""
    source, out = str(tmp_path / "topics"), str(tmp_path / "out")
    send(spark, source, posts("a", 4, day=1))

    def run():
        scored = enrich.enrich_posts(stream_topic_files(spark, source, "fb_posts"))
        trend = trends.streaming_trend(scored, ["candidate"], delay="1 day")
        jobs.run_in_turn([lambda: jobs.start_table_sink(trend, out, str(tmp_path / "c"))])
        return {r.bucket.day: r.records for r in spark.read.parquet(out).collect()}

    assert run() == {}, "the day may still get records"
    send(spark, source, posts("late", 2, day=1))
    assert run() == {}
    send(spark, source, posts("b", 1, day=5))
    assert run() == {1: 6}
    send(spark, source, posts("too-late", 3, day=1))
    send(spark, source, posts("c", 1, day=9))
    assert run() == {1: 6, 5: 1}


def test_command_line(spark, tmp_path):
    """Nested files and table exports, through the topics, to enriched tables."""
    folder = {n: str(tmp_path / n) for n in (
        "posts", "fbc", "v", "c", "t", "raw-rejects", "out", "cp",
    )}
    raw = [
        {
            "channel": "ABC", "id_video": "v1", "title": "T", "fullText": "good news",
            "social": "youtube", "likes": 1, "views": 2, "timestamp": "2024-09-01T00:00:00",
            "comments": [{"cid": "c1", "text": "bad", "votes": 1}, {"cid": "c2", "text": "ok"}],
        },
        {"channel": "ABC", "id_video": "v2", "social": "youtube", "comments": []},
        {"channel": "FOX", "id_video": "v3", "fullText": "x", "social": "z", "comments": []},
    ]
    (tmp_path / "ABC.json").write_text(json.dumps(raw, indent=4))
    spark.sql("SELECT 'p1' uuid, timestamp '2024-09-01 00:00:00' timestamp, 'great' content").write.parquet(folder["posts"])
    spark.sql("SELECT 'k1' uuid, 'p1' post_id, 'hmm' content").write.parquet(folder["fbc"])

    cli.main(["flatten", "--raw", f"{tmp_path}/ABC.json", "--videos", folder["v"],
              "--video-comments", folder["c"], "--rejects", folder["raw-rejects"]])
    (failed,) = spark.read.parquet(folder["raw-rejects"]).collect()
    assert failed.reason == "extraction failed" and '"v2"' in failed.raw
    cli.main(["ingest", "--posts", folder["posts"], "--post-comments", folder["fbc"],
              "--videos", folder["v"], "--video-comments", folder["c"],
              "--form", "lines", "--topics", folder["t"]])
    datasets = [a for name in DATASETS for a in ("--dataset", name)]
    cli.main(["enrich", *datasets, "--topics", folder["t"], "--out", folder["out"],
              "--checkpoint", folder["cp"]])

    found = {n: spark.read.parquet(f"{folder['out']}/{n}") for n in DATASETS}
    assert {n: df.count() for n, df in found.items()} == {
        "fb_posts": 1, "fb_comments": 1, "yt_videos": 1, "yt_comments": 2,
    }
    for name, df in found.items():
        assert tuple(df.columns) == DATASETS[name].output_columns
    assert found["fb_posts"].first().timestamp == "2024-09-01T00:00:00"
    assert found["yt_videos"].first().comments == 2
    (reject,) = spark.read.parquet(f"{folder['t']}/topic=rejects").collect()
    assert json.loads(bytes(reject.value))["reject_reason"] == "unknown platform"


def flagged(spark, path, failing):
    """A stream of enriched posts some of which have no score."""
    stream = stream_topic_files(spark, path, "fb_posts", max_files=1)
    records = enrich.enrich_posts(stream).withColumn("score_error", F.col("uuid").startswith(failing))
    return jobs.with_call_counts(records)


@pytest.mark.parametrize("run", ["turn", "interval"])
def test_failed_model_calls_end_a_job(spark, tmp_path, run):
    """Judged on new records alone, for any sink, while it runs on or at its end."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("topics", "out", "c"))
    send(spark, source, posts("bad", 2) + posts("ok", 30))
    trigger = jobs.AVAILABLE_NOW if run == "turn" else "1 second"
    together = jobs.run_in_turn if run == "turn" else jobs.run_together

    def starter(sink="table"):
        records = flagged(spark, source, "bad")
        if sink == "table":
            return lambda: jobs.start_table_sink(records, out, checkpoint, trigger, run)
        write = jobs.batch_folder_writer(out + "2")
        return lambda: jobs.start_batch_sink(records, write, checkpoint + "2", trigger, run)

    if run == "turn":
        together([starter()], jobs.CallLimit(0.1))
        send(spark, source, posts("bad", 3) + posts("ok", 2))
        with pytest.raises(jobs.TooManyErrors, match="3 of 5"):
            together([starter()], jobs.CallLimit(0.1))
    with pytest.raises(jobs.TooManyErrors, match="bad|without a score"):
        together([starter("folders")], jobs.CallLimit(0.01, least=20))
    assert not [q for q in spark.streams.active if q.name == run]


def test_latest_versions(spark, tmp_path):
    """Repeats, a newer and an older version, rows without key, and a repeated batch."""
    path = str(tmp_path / "latest")
    write = latest.latest_writer(path, "k", "v", buckets=4)
    names = "k string, v string, n int"
    batches = [
        [("a", "2", 1), ("b", "5", 1), (None, "1", 1)],
        [("a", "2", 1), ("a", "1", 9), ("b", "6", 2), ("c", None, 1), ("c", None, 1)],
        [("b", "3", 7), ("c", "0", 2), (None, "1", 1), ("d", "1", 1)],
        [("e", "1", 1)],
    ]
    frames = [spark.createDataFrame(rows, names) for rows in batches]
    for n in (0, 1, 1, 2, 3, 3):
        write(frames[n], n)
    everything = frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])
    expected = sorted(map(tuple, reports.latest_snapshot(everything, "k", "v").collect()), key=str)
    assert sorted(map(tuple, latest.read_latest(spark, path).collect()), key=str) == expected
    assert expected == sorted(
        [("a", "2", 1), ("b", "6", 2), ("c", "0", 2), ("d", "1", 1), ("e", "1", 1)]
        + [(None, "1", 1)] * 2, key=str
    )
    assert latest.drop_replaced(spark, path) > 0 and latest.drop_replaced(spark, path) == 0
    assert sorted(map(tuple, latest.read_latest(spark, path).collect()), key=str) == expected


def test_latest_deletes_what_was_replaced(spark, tmp_path):
    """The table and the state that a repeat of the last batch reads are all that is left."""
    path = tmp_path / "latest"
    write = latest.latest_writer(str(path), "k", "v", buckets=2, keep_replaced=False)
    frames = [
        spark.createDataFrame([(f"k{i}", f"{n}{i}") for i in range(20)], "k string, v string") for n in range(5)
    ]
    for n in (0, 1, 1, 2, 3, 3, 4, 4):
        write(frames[n], n)
        assert latest.read_latest(spark, str(path)).exceptAll(frames[n]).count() == 0
        assert latest.read_latest(spark, str(path)).count() == 20
        held = {int(x.parent.name.split("=")[1]) for x in path.glob("data/_batch=*/_bucket=*")}
        assert held == {n} | {max(0, n - 1)}


def _shuffle_files(spark):
    """Names of the shuffle files that Spark holds, in local mode."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles().mkString("\n").split("\n")
    return {f for f in files if "/shuffle_" in f}


def _in_time(condition, seconds=20):
    end = time.time() + seconds
    while not condition() and time.time() < end:
        time.sleep(0.2)
    return condition()


def test_latest_rewrites_groups_of_buckets(spark, tmp_path):
    """A part of the table is shuffled at a time, and no shuffle file outlives its batch."""
    path, seen = str(tmp_path / "latest"), []
    changed = lambda rows, n: seen.append(sorted(map(tuple, rows.select("k", "v", "_sign").collect())))
    write = latest.latest_writer(path, "k", "v", buckets=16, changed=changed, keep_replaced=False)
    frames = [
        spark.createDataFrame([(f"k{i}", f"{max(1, n * (i % 2))}", "x" * 50) for i in range(400)], "k string, v string, t string")
        for n in range(3)
    ]
    before = _shuffle_files(spark)
    for n in (0, 1, 2, 2):
        write(frames[n], n)
        jobs_of = {f.name.split("-", 2)[2] for f in (tmp_path / "latest" / "data" / f"_batch={n}").glob("*/part-*")}
        assert len(jobs_of) == latest.ROUNDS
    assert _in_time(lambda: not _shuffle_files(spark) - before)
    table = latest.read_latest(spark, path)
    assert table.columns == ["k", "v", "t"]
    assert sorted(map(tuple, table.select("k", "v").collect())) == sorted((f"k{i}", "2" if i % 2 else "1") for i in range(400))
    odd = [f"k{i}" for i in range(1, 400, 2)]
    moved = sorted([(k, "1", -1) for k in odd] + [(k, "2", 1) for k in odd])
    assert seen == [sorted((f"k{i}", "1", 1) for i in range(400)), [], moved, moved]


def test_latest_of_a_hot_key(spark, tmp_path):
    """Most rows of a batch have one key, rows without key come too, and a report begins later."""
    path, seen = str(tmp_path / "latest"), []
    write = latest.latest_writer(path, "k", "v", buckets=16)
    names = "k string, v int, n int"
    first = spark.createDataFrame([("hot", i % 50, i) for i in range(500)] + [(f"k{i}", 1, i) for i in range(40)], names)
    write(first, 0)
    expected = {("hot", 49, 49), *((f"k{i}", 1, i) for i in range(40))}
    assert set(map(tuple, latest.read_latest(spark, path).collect())) == expected
    write = latest.latest_writer(path, "k", "v", changed=lambda rows, n: seen.extend(map(tuple, rows.collect())))
    second = spark.createDataFrame([("hot", 49, 49)] * 500 + [("k1", 2, 0), (None, 1, 1), (None, 1, 1)], names)
    write(second, 1)
    assert sorted(seen, key=str) == sorted([("k1", 2, 0, 1), ("k1", 1, 1, -1), (None, 1, 1, 1), (None, 1, 1, 1)], key=str)
    found = latest.read_latest(spark, path).collect()
    assert sorted(map(tuple, found), key=str) == sorted([*(expected - {("k1", 1, 1)}), ("k1", 2, 0), (None, 1, 1), (None, 1, 1)], key=str)
    write(second.limit(0), 2)
    assert len(seen) == 4 and latest.read_latest(spark, path).count() == len(found)


def test_topic_files_are_deleted_behind_their_reader(spark, tmp_path):
    """Files are written without a shuffle, and each goes once the batch after its own begins."""
    source, out = tmp_path / "topics", str(tmp_path / "out")
    rows = spark.range(0, 40, 1, 4).selectExpr("concat('a', id) AS uuid", "'good' AS content")
    write_topic_files(to_messages(rows, F.lit("fb_posts")), str(source), dealt=False)
    files = lambda: list(source.glob("*/part-*"))
    assert len(files()) == 4 and all(f.name.endswith(".zstd.parquet") for f in files())
    stream = enrich.enrich_posts(stream_topic_files(spark, str(source), "fb_posts", max_files=1, clean=True))
    jobs.run_in_turn([lambda: jobs.start_table_sink(stream, out, str(tmp_path / "c"))])
    assert spark.read.parquet(out).select("uuid").distinct().count() == 40
    assert _in_time(lambda: len(files()) <= 1)


@pytest.mark.parametrize("files, most", [(1, 1), (4, 1), (5, 2), (9, 3)])
def test_backlog_in_few_batches(spark, tmp_path, files, most):
    path = str(tmp_path / "in")
    for i in range(files):
        send(spark, path, posts(str(i), 1))
    assert files_per_batch(spark, path, "fb_posts", 4) == most


def test_latest_arrival_without_versions(spark, tmp_path):
    path = str(tmp_path / "latest")
    write = latest.latest_writer(path, "k", buckets=2)
    for n, value in enumerate("xyz"):
        write(spark.createDataFrame([("a", value), (value, value)], "k string, v string"), n)
    found = latest.read_latest(spark, path).select("k", "v").collect()
    assert sorted(map(tuple, found)) == [("a", "z"), ("x", "x"), ("y", "y"), ("z", "z")]
    empty = latest.read_latest(spark, str(tmp_path / "none"), StructType().add("k", "string"))
    assert empty.count() == 0


def test_enrich_latest_and_distinct(spark, tmp_path):
    source = str(tmp_path / "topics")
    for version, text in (("1", "good"), ("3", "great"), ("2", "bad"), ("3", "great")):
        rows = [("a", version, "2024-09-01T00:00:00", text)]
        send(spark, source, rows)
    for flag, extra in (("latest", ["--buckets", "2"]), ("distinct", [])):
        out, value = str(tmp_path / flag), ["1 day"] if flag == "distinct" else []
        cli.main(["enrich", "--dataset", "fb_posts", "--topics", source, "--out", out, "--max-files", "1",
                  "--checkpoint", f"{tmp_path}/c-{flag}", f"--{flag}", *value, *extra])
    (kept,) = latest.read_latest(spark, f"{tmp_path}/latest/fb_posts").collect()
    assert (kept.retrieving_time, kept.content) == ("3", "great")
    distinct = spark.read.parquet(f"{tmp_path}/distinct/fb_posts").collect()
    assert sorted(r.retrieving_time for r in distinct) == ["1", "2", "3"]
    with pytest.raises(SystemExit, match="--out"):
        cli.main(["enrich", "--dataset", "fb_posts", "--topics", source, "--search", "x",
                  "--checkpoint", str(tmp_path / "c"), "--latest"])


def test_files_that_vanish(spark, tmp_path):
    """A stream whose source files are gone goes on with those that are there."""
    source, out = str(tmp_path / "topics"), str(tmp_path / "out")

    def run():
        stream = enrich.enrich_posts(stream_topic_files(spark, source, "fb_posts"))
        jobs.run_in_turn([lambda: jobs.start_table_sink(stream, out, str(tmp_path / "c"))])
        return spark.read.parquet(out).count()

    send(spark, source, posts("a", 2))
    assert run() == 2
    for file in (tmp_path / "topics" / "topic=fb_posts").glob("*.parquet"):
        file.unlink()
    send(spark, source, posts("b", 3))
    assert run() == 5


def test_incremental_trend_equals_a_full_one(spark, tmp_path):
    """Versions that move a record to another day, label or name, a repeated batch, and folding."""
    names = "uuid string, retrieving_time string, timestamp string, candidate string, "
    names += "sentiment_label string, negative float, neutral float, positive float"
    table, path = str(tmp_path / "table"), str(tmp_path / "trend")
    write = latest.latest_writer(table, "uuid", "retrieving_time", 3, incremental.trend_changes(path, ["candidate"]))

    def row(i, version, day=1, name="x", label="neutral", score=0.1):
        return (f"{i}" if i else None, version, f"2024-09-0{day}T10:00:00", name, label, score, 0.3, 0.7)

    batches = [
        [row(i, "1", 1 + i % 3, score=0.1 * i) for i in range(12)],
        [row(1, "2", 5), row(2, "2", name="y"), row(3, "0", 9), row(4, "1", 2, score=0.4), row(0, "1")],
        [row(1, "3", 6, label="positive"), row(2, "3", name="x"), row(20, "1", 1), row(20, "2", 2)],
        [row(5, "9", None or 7, None)],
    ]
    frames = [spark.createDataFrame(rows, names) for rows in batches]
    everything = frames[0]
    for n, frame in enumerate(frames):
        everything = everything if n == 0 else everything.unionByName(frame)
        for _ in range(2 if n in (0, 2) else 1):
            write(frame, n)
        if n == 2:
            incremental.fold_changes(spark, path, table, ["candidate"])
        full = reports.sentiment_trend(reports.latest_snapshot(everything), ["candidate"])
        found = incremental.read_trend(spark, path, table, ["candidate"])
        rounded = [[tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*full.columns).collect()] for df in (full, found)]
        assert sorted(rounded[0], key=repr) == sorted(rounded[1], key=repr)


def test_comments_meet_posts(spark, tmp_path):
    """A post without comments, comments before their post, out of range, and without one."""
    source = str(tmp_path / "topics")
    scores = {"negative": 0.0, "neutral": 0.5, "positive": 1.0}
    posts_of = [("p1", "2024-09-01T00:00:00"), ("p2", "2024-09-02T00:00:00"), ("end", "2025-01-01T00:00:00")]
    comments_of = [
        ("p1", "2024-09-03T00:00:00"), ("p1", "2024-08-31T20:00:00"), ("p1", "2024-11-01T00:00:00"),
        ("nobody", "2024-09-02T00:00:00"), ("end", "2025-01-01T00:00:00"),
    ]

    def send_all(name, rows, key):
        schema = f"{key} string, timestamp string"
        for i, part in enumerate((rows[:-1], rows[-1:])):
            df = spark.createDataFrame(part, schema).withColumns({k: F.lit(v) for k, v in scores.items()})
            df.withColumn("sentiment_label", F.lit("positive")).coalesce(1).write.mode("append").parquet(f"{source}/{name}")
            assert i < 2

    send_all("posts", posts_of, "uuid")
    send_all("comments", comments_of, "post_id")

    def stream(name):
        schema = spark.read.parquet(f"{source}/{name}").schema
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{source}/{name}")

    for make, name in ((moods.streaming_comment_mood, "mood"), (moods.streaming_orphans, "orphans")):
        found = make(stream("posts"), stream("comments"))
        out = str(tmp_path / name)
        jobs.run_in_turn([lambda: jobs.start_table_sink(found, out, f"{out}-c")])
    mood = {r.uuid: r.comment_records for r in spark.read.parquet(str(tmp_path / "mood")).collect()}
    assert mood == {"p1": 2, "p2": 0}
    orphans = spark.read.parquet(str(tmp_path / "orphans")).collect()
    assert sorted((r.post_id, r.event_time.month) for r in orphans) == [("nobody", 9), ("p1", 11)]


def test_late_records_are_an_output(spark, tmp_path):
    """Windows and late records hold each record once: repeats, late ones, no key, no time."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    names = "uuid string, timestamp string, candidate string, negative float, neutral float, positive float"
    batches = [
        [("a", 1), ("b", 2), ("a", 1)],
        [("a", 1), ("c", 20), ("b", 2), (None, 3), ("x", None)],
        [("d", 2), ("e", 19), ("c", 20)],
        [("d", 2), ("f", 1), ("a", 1), ("g", 21), ("f", 1)],
        [("h", 28)],
        [("f", 1), ("e", 19), ("i", 3)],
    ]
    for rows in batches:
        made = [(k, d and f"2024-09-{d:02}T10:00:00", "x", 0.1, 0.2, 0.7) for k, d in rows]
        spark.createDataFrame(made, names).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(names).option("maxFilesPerTrigger", 1).parquet(source)
    rows = late.trend_and_arrivals(stream, ["uuid"], ["candidate"], delay="2 days")
    write = late.late_writer(out, ["uuid"])

    def twice(batch, batch_id):
        write(batch, batch_id)
        if batch_id in (1, 3):
            write(batch, batch_id)

    jobs.run_in_turn([lambda: jobs.start_batch_sink(rows, twice, str(tmp_path / "c"))])
    windows = {r.bucket.day: r.records for r in spark.read.parquet(f"{out}/trend").collect()}
    # The watermark that drops a record is that of the batch before: "d" is in time, its repeat not.
    assert windows == {1: 1, 2: 2, 19: 1, 20: 1, 21: 1}
    missed = [(r.uuid, r.reason) for r in late.read_late(spark, out, stream.schema).collect()]
    assert sorted(missed, key=str) == sorted(
        [("f", "late"), ("i", "late"), (None, "no key"), ("x", "no time")], key=str
    )


def test_late_writer_files_follow_days(spark, tmp_path):
    """Many tasks that hold all days do not write a file each for every day."""
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    source, out = str(tmp_path / "in"), tmp_path / "out"
    names = "uuid string, timestamp string, candidate string, negative float, neutral float, positive float"
    made = [(f"k{i}", f"2024-09-{1 + i % 5:02}T10:00:00", "x", 0.1, 0.2, 0.7) for i in range(800)]
    spark.createDataFrame(made, names).write.parquet(source)
    stream = spark.readStream.schema(names).parquet(source)
    rows = late.trend_and_arrivals(stream, ["uuid"], ["candidate"])
    write = late.late_writer(str(out), ["uuid"])
    try:
        jobs.run_in_turn([lambda: jobs.start_batch_sink(rows, write, str(tmp_path / "c"))])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert 5 <= len(list(out.glob("accepted/_batch=0/*/*.parquet"))) <= 5 * late.DAY_FILES
    assert late.read_late(spark, str(out), stream.schema).count() == 0
