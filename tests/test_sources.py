from __future__ import annotations

import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from agorameter import session
from agorameter.operators.messages import to_messages
from agorameter.schemas import FLAT_VIDEO, POSTS, RAW_VIDEO
from agorameter.sinks import files as file_sinks
from agorameter.sinks import topics as topic_sinks
from agorameter.sources import files, tables, topics
from agorameter.streaming import jobs


def test_json_array_files(spark, tmp_path):
    for channel, n in (("ABC", 2), ("FOX", 1)):
        records = [{"channel": channel, "id_video": f"{channel}{i}", "views": i} for i in range(n)]
        (tmp_path / f"{channel}_videos.json").write_text(json.dumps(records, indent=4))
    df = files.read_flat_videos(spark, f"{tmp_path}/*.json")
    assert df.columns == FLAT_VIDEO.names
    assert {(r.channel, r.id_video, r.views) for r in df.collect()} == {
        ("ABC", "ABC0", 0), ("ABC", "ABC1", 1), ("FOX", "FOX0", 0),
    }


def test_indented_arrays_are_read_in_parts(spark, tmp_path):
    """Many tasks share one file, and get what a reader of the whole file gets."""

    def video(i):
        comments = [
            {"cid": f"{i}-{j}", "text": "}, {\n    },\n ]", "votes": j, "author": "é😀"}
            for j in range(i % 4)
        ]
        return {"id_video": str(i), "title": "\n    },\n" * (i % 3), "likes": i, "comments": comments}

    for name, n in (("ABC", 300), ("FOX", 1), ("NBC", 0)):
        with open(tmp_path / f"{name}.json", "w") as file:
            json.dump([video(i) for i in range(n)], file, indent=4)
    (tmp_path / "NYT.json").write_text(json.dumps([{"views": "59", "likes": 1}], indent=4) + "\n")
    size = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(size, "2000")
    try:
        parts = files.read_raw_videos(spark, f"{tmp_path}/*.json", files.INDENTED)
        assert parts.rdd.getNumPartitions() > 20
        found = sorted(map(repr, parts.collect()))
    finally:
        spark.conf.unset(size)
    whole = files.read_raw_videos(spark, f"{tmp_path}/*.json", files.ARRAY)
    assert found == sorted(map(repr, whole.collect())) and len(found) == 302
    assert parts.schema.simpleString() == RAW_VIDEO.simpleString()


LAYOUTS = {
    "compact": {"separators": (",", ":")},
    "plain": {},
    "two": {"indent": 2},
    "tabs": {"indent": "\t"},
    "none": {"indent": 0},
    "crlf": {"indent": 4},
}


@pytest.mark.parametrize("size", ["400", "3000", "100000"])
def test_arrays_of_any_layout_are_read_in_parts(spark, tmp_path, size):
    """Parts far smaller than a record, and larger ones, give what a JSON library reads."""
    hard = ['}', '"}', '\\\\', '\\"}{[', ']}]', 'é😀}', "},\n {", '\\u007d', ""]

    def video(i):
        comments = [{"cid": f"{i}-{j}", "text": hard[(i + j) % 9] * (1 + i % 3), "votes": j} for j in range(i % 4)]
        return {"id_video": f"{i}{hard[i % 9]}", "title": hard[-i % 9], "views": i, "comments": comments}

    records = [video(i) for i in range(18)]
    records.append({"id_video": "large", "fullText": "x}" * 300, "comments": []})
    for name, layout in LAYOUTS.items():
        text = json.dumps(records, ensure_ascii=name == "plain", **layout)
        text = text.replace("\n", "\r\n") + "\r\n" if name == "crlf" else text
        (tmp_path / f"{name}.json").write_bytes(text.encode("utf-8-sig" if name == "two" else "utf-8"))
    (tmp_path / "empty.json").write_text("[ ]")
    (tmp_path / "blank.json").write_text(" \n")
    setting = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(setting, size)
    try:
        found = files.read_raw_videos(spark, f"{tmp_path}/*.json", files.SPLIT)
        assert size != "400" or found.rdd.getNumPartitions() > 50
        rows = [r.asDict(recursive=True) for r in found.collect()]
        assert files.read_json_rejects(spark, f"{tmp_path}/*.json", files.SPLIT).count() == 0
    finally:
        spark.conf.unset(setting)
    whole = [{n: r.get(n) for n in RAW_VIDEO.names} for r in records]
    for record in whole:
        names = RAW_VIDEO["comments"].dataType.elementType.names
        record["comments"] = [{n: c.get(n) for n in names} for c in record["comments"]]
    assert sorted(map(repr, rows)) == sorted(map(repr, whole * len(LAYOUTS)))


def test_rejects_of_split_arrays(spark, tmp_path):
    texts = {
        "lines": '{"id_video": "a"}\n{"id_video": "b"}',
        "comma": '[{"id_video": "c"} {"id_video": "d"}, {"id_video": "e"}]',
        "open": '[{"id_video": "f"}, {"id_video": ',
        "after": '[{"id_video": "g"}] more',
        "value": '[{"id_video": "h"}, 5, {"id_video": "i"}, 6]',
        "broken": '[{"id_video": "j"}, {"id_video": k}, {"id_video": "l"}]',
        "ended": '[{"id_video": "m"}',
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    good = files.read_flat_videos(spark, str(tmp_path), files.SPLIT, strict=False)
    assert {r.id_video for r in good.collect()} == set("cefghjlm")
    rejects = files.read_json_rejects(spark, str(tmp_path), files.SPLIT).collect()
    found = sorted((r.file.split("/")[-1][:-5], r.raw) for r in rejects)
    assert found == [
        ("after", "] more"), ("broken", '{"id_video": k}'), ("comma", '{"id_video": "d"}'),
        ("ended", ""), ("lines", '{"id_video": "a"'), ("open", ', {"id_video":'), ("value", ", 6]"),
        ("value", '5, {"id_video": "i"}'),
    ]
    with pytest.raises(Exception, match="not a record of form split"):
        files.read_flat_videos(spark, str(tmp_path), files.SPLIT).collect()
    marked = files.read_json_marked(spark, str(tmp_path), FLAT_VIDEO, files.SPLIT).collect()
    assert sorted(r.data.id_video for r in marked if r.reason is None) == sorted("cefghjlm")
    assert sorted(r.raw for r in marked if r.reason) == sorted(r.raw for r in rejects)


def test_other_arrays_are_not_taken_for_indented_ones(spark, tmp_path):
    (tmp_path / "ABC.json").write_text('[{"id_video": "a"}, {"id_video": "b"}]')
    with pytest.raises(Exception, match="not a record of form indented"):
        files.read_raw_videos(spark, str(tmp_path), files.INDENTED).collect()
    with pytest.raises(ValueError):
        files.read_raw_videos(spark, str(tmp_path), "pretty")


def test_raw_video_files(spark, tmp_path):
    video = {"id_video": "v", "comments": [{"cid": "c", "text": "t", "votes": 1}], "likes": 3}
    (tmp_path / "ABC.json").write_text(json.dumps([video, {"id_video": "w", "comments": []}]))
    rows = files.read_raw_videos(spark, str(tmp_path), files.ARRAY).orderBy("id_video").collect()
    assert rows[0].comments[0].cid == "c" and rows[0].comments[0].author is None
    assert rows[1].comments == []


def test_channel_from_file_name(spark, tmp_path):
    (tmp_path / "NYT_videos.json").write_text('[{"id_video": "v"}]')
    read = spark.read.schema("id_video string").option("multiLine", True).json(str(tmp_path))
    assert tuple(files.with_file_channel(read).first()) == ("v", "NYT")


def test_links(spark, tmp_path):
    path = str(tmp_path / "links")
    df = spark.createDataFrame([("https://a\t ",), (" https://b",)], "url string")
    file_sinks.write_links(df, path)
    assert {r.url for r in files.read_links(spark, path).collect()} == {"https://a", "https://b"}


def test_channel_files_keep_the_channel(spark, tmp_path):
    path = str(tmp_path / "videos")
    df = spark.createDataFrame([("ABC", "v1"), ("FOX", "v2")], "channel string, id_video string")
    file_sinks.write_channel_files(df, path)
    assert sorted(p.name for p in (tmp_path / "videos").glob("channel_code=*")) == [
        "channel_code=ABC", "channel_code=FOX",
    ]
    back = files.read_flat_videos(spark, path, files.LINES)
    assert back.columns == FLAT_VIDEO.names
    assert {(r.channel, r.id_video) for r in back.collect()} == {("ABC", "v1"), ("FOX", "v2")}


def test_topic_files(spark, tmp_path):
    path = str(tmp_path / "topics")
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("b", "z")], "topic string, uuid string")
    topic_sinks.write_topic_files(to_messages(df), path)
    assert topics.read_topic_files(spark, path).count() == 3
    only = topics.read_topic_files(spark, path, "b")
    assert {json.loads(bytes(r.value))["uuid"] for r in only.collect()} == {"y", "z"}
    assert only.schema.simpleString() == topics.ENVELOPE.simpleString()
    stream = topics.stream_topic_files(spark, path, "b", max_files=1)
    assert stream.isStreaming and stream.columns == ["key", "value"]


def test_topic_options():
    options = topics.topic_options("broker:9092", "t", min_partitions=64)
    assert options == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "minPartitions": "64",
    }
    assert "minPartitions" not in topics.topic_options("b", "t")


def test_jdbc_options():
    plain = tables.jdbc_options("jdbc:x", "Posts")
    assert plain == {"url": "jdbc:x", "dbtable": "Posts", "fetchsize": "10000"}
    split = tables.jdbc_options(
        "jdbc:x", "Posts", "timestamp", ("2024-09-01", "2025-01-20"), 32, user="u"
    )
    assert split["numPartitions"] == "32" and split["partitionColumn"] == "timestamp"
    assert split["user"] == "u"
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "Posts", partitions=4)


def test_hash_predicates_are_a_partition(spark):
    df = spark.sql("SELECT IF(id % 9 = 0, NULL, concat('k', id)) AS uuid, id FROM range(500)")
    parts = [df.filter(p).collect() for p in tables.hash_predicates("uuid", 7)]
    assert sorted(r.id for part in parts for r in part) == list(range(500))
    assert all(len(part) > 30 for part in parts)


@pytest.mark.parametrize("n", [1, 2, 7, 16, 100])
def test_key_ranges_are_a_partition(spark, n):
    df = spark.range(400).selectExpr("id", "CASE WHEN id > 5 THEN md5(string(id)) END AS uuid")
    df = df.unionByName(spark.sql("SELECT 1000L AS id, '~odd' AS uuid UNION ALL SELECT 1001L, ''"))
    parts = [df.filter(p).collect() for p in tables.prefix_ranges("uuid", n)]
    assert len(parts) == n
    assert sorted(r.id for part in parts for r in part) == [*range(400), 1000, 1001]


def test_mysql_reads_with_a_cursor():
    assert tables.jdbc_options("jdbc:mysql://h/d", "t")["url"].endswith("?useCursorFetch=true")
    assert tables.jdbc_options("jdbc:mysql://h/d?a=1", "t")["url"].endswith("&useCursorFetch=true")


def test_search_options(spark):
    options = jobs.search_options("http://node", 9200)
    assert options["es.batch.write.retry.count"] == "10"
    assert options["es.batch.write.retry.wait"] == "100ms"
    df = spark.createDataFrame(
        [("a", "1"), ("a", "2"), (None, None), (None, None)], "uuid string, retrieving_time string"
    )
    ids = [r.document_id for r in jobs.with_document_id(df, POSTS.key).collect()]
    again = [r.document_id for r in jobs.with_document_id(df, POSTS.key).collect()]
    assert ids == again and len(set(ids)) == 3 and None not in ids
    joined = spark.createDataFrame([("a|b", "c"), ("a", "b|c")], df.schema)
    assert jobs.with_document_id(joined, POSTS.key).select("document_id").distinct().count() == 2


@pytest.mark.parametrize(
    ("form", "body"),
    [
        ("lines", json.dumps([{"id_video": "a"}], indent=4)),
        ("lines", '{"id_video": "a"}\n{"id_video": '),
        ("indented", '[{"id_video": "a"}]'),
        ("indented", json.dumps([{"id_video": "a"}, {"id_video": "b"}], indent=4).replace("\n", "\r\n")),
        ("indented", '{"id_video": "a"}\n{"id_video": "b"}\n'),
        ("indented", json.dumps([{"id_video": "a"}, {"id_video": "b"}], indent=4)[:-20]),
        ("array", '{"id_video": "a"}\n{"id_video": "b"}\n'),
        ("array", '[{"id_video": "a"}, {"id_vid'),
    ],
)
def test_a_wrong_form_is_an_error_and_a_reject(spark, tmp_path, form, body):
    (tmp_path / "ABC.json").write_text(body, newline="")
    with pytest.raises(Exception, match=f"not a record of form {form}"):
        files.read_flat_videos(spark, str(tmp_path), form).count()
    rejects = files.read_json_rejects(spark, str(tmp_path), form).collect()
    assert rejects and all(r.file.endswith("ABC.json") and r.reason and r.raw for r in rejects)


def test_a_damaged_record_costs_only_itself(spark, tmp_path):
    records = [{"id_video": str(i), "views": 3_000_000_000} for i in range(5)]
    body = json.dumps(records, indent=4).replace('"id_video": "2"', '"id_video": "2')
    (tmp_path / "ABC_videos.json").write_text(body)
    kept = files.read_json_records(spark, str(tmp_path), FLAT_VIDEO, strict=False, long_counts=True)
    rows = files.with_file_channel(kept).collect()
    assert sorted(r.id_video for r in rows) == ["0", "1", "3", "4"]
    assert {(r.channel, r.views) for r in rows} == {("ABC", 3_000_000_000)}
    (reject,) = files.read_json_rejects(spark, str(tmp_path)).collect()
    assert reject.reason == "not JSON" and '"2' in reject.raw


def test_exported_table_and_union(spark, tmp_path):
    path = str(tmp_path / "posts")
    spark.range(3).withColumn("candidate", F.lit("x")).write.parquet(path)
    posts = tables.read_exported_table(spark, path)
    both = tables.union_inputs(posts, spark.range(2).withColumn("post_id", F.lit("p")))
    assert both.columns == ["id", "candidate", "post_id"]
    assert both.count() == 5 and both.filter("candidate IS NULL").count() == 2


def cluster(folder: str | None, master: str):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder if "checkpoint" in key else default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_shared_folder_reads_the_setting():
    spark = cluster("hdfs://shared/checkpoints/", "spark://host:7077")
    path = session.shared_folder(spark, "x")
    assert path.startswith("hdfs://shared/checkpoints/x-")
    assert path != session.shared_folder(spark, "x")


def test_a_cluster_has_to_name_its_shared_folder():
    with pytest.raises(ValueError):
        session.shared_folder(cluster(None, "spark://host:7077"), "x")
    assert session.shared_folder(cluster(None, "local[2]"), "x")


def test_spread_only_on_request(spark):
    df = spark.range(0, 100, 1, 1)
    assert session.spread(df) is df
    spark.conf.set(session.INPUT_PARTITIONS, "6")
    try:
        assert session.spread(df).rdd.getNumPartitions() == 6
    finally:
        spark.conf.unset(session.INPUT_PARTITIONS)


@pytest.mark.parametrize("kind", ["doc-{}", "{:x}", "{:08d}", "Ab{}cD", "o'{}\\\\x", "ä{}"])
def test_sampled_ranges_are_even(spark, kind):
    """Keys of any look, small samples, repeated keys and rows without one."""
    rows = [(kind.format(i * i % 9973 + i),) for i in range(4000)] + [(None,)] * 5 + [("zz",)] * 3
    df = spark.createDataFrame(rows, "uuid string").coalesce(2)
    parts = tables.sampled_ranges(df, "uuid", 8, sample=1500)
    sizes = [df.where(p).count() for p in parts]
    assert sum(sizes) == len(rows) and len(sizes) == 8
    assert max(sizes) <= 2 * len(rows) / 8
    assert tables.sampled_ranges(df.limit(0), "uuid", 8) == ["1 = 1"]
    assert tables.sampled_ranges(df, "uuid", 1) == ["1 = 1"]


def test_files_follow_bytes(spark, tmp_path):
    """A hot channel has several files, all others one, however many tasks there are."""
    path = str(tmp_path / "videos")
    df = spark.range(0, 30_000, 1, 40).selectExpr(
        "IF(id % 10 < 8, 'HOT', concat('C', id % 10)) AS channel", "repeat(sha(string(id)), 4) AS title"
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "400k")
    try:
        file_sinks.write_channel_files(df, path)
        topic_sinks.write_topic_files(
            to_messages(df.withColumn("topic", F.concat(F.lit("t"), "channel"))), str(tmp_path / "t")
        )
    finally:
        spark.conf.unset(setting)
    files_of = {p.name: list(p.glob("part-*")) for p in (tmp_path / "videos").glob("channel_code=*")}
    assert len(files_of) == 3 and 3 <= len(files_of["channel_code=HOT"]) <= 20
    assert all(len(v) <= 2 for k, v in files_of.items() if not k.endswith("HOT"))
    sizes = [f.stat().st_size for f in files_of["channel_code=HOT"]]
    assert max(sizes) <= 4 * sum(sizes) / len(sizes)
    assert len(list((tmp_path / "t").glob("*/part-*"))) <= 30
    assert files.read_flat_videos(spark, path, files.LINES).count() == 30_000
    file_sinks.write_channel_files(df, path, file_records=1000)
    assert len(list((tmp_path / "videos").glob("*/part-*"))) >= 30
