from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from agorameter.functions import text, time
from agorameter.plans.enrich import chunk_table

SLOW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def chunks_of(texts, values, size=500):
    rows = texts(values).select("id", text.chunk_text("text", size).alias("c")).orderBy("id")
    return [r.c for r in rows.collect()]


def test_chunk_lengths(texts):
    found = chunks_of(texts, ["", None, "a", "b" * 500, "c" * 501, "d" * 1000])
    assert [None if c is None else [len(x) for x in c] for c in found] == [
        [], None, [1], [500], [500, 1], [500, 500],
    ]


def test_chunks_keep_code_points_whole(texts):
    value = "x" * 499 + "😀" + "y"
    assert chunks_of(texts, [value]) == [["x" * 499 + "😀", "y"]]


def test_chunks_keep_line_ends(texts):
    value = "one\r\ntwo three\n\n"
    assert chunks_of(texts, [value], 4) == [[value[i : i + 4] for i in range(0, len(value), 4)]]


@SLOW
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40), max_size=30))
def test_chunks_are_the_text(spark, texts, values):
    values = values + ["ab" * 9]
    for value, chunks in zip(values, chunks_of(texts, values, 7)):
        assert "".join(chunks) == value
        assert all(len(c) == 7 for c in chunks[:-1])
        assert all(1 <= len(c) <= 7 for c in chunks)


def test_chunk_table(texts):
    rows = chunk_table(texts(["abcde", "", None, "xyz"]), "id", "text", 2).orderBy("id", "chunk_no")
    assert [tuple(r) for r in rows.collect()] == [
        (0, 0, "ab"), (0, 1, "cd"), (0, 2, "e"), (3, 0, "xy"), (3, 1, "z"),
    ]


def test_votes(texts):
    votes = ["7", "", None, "1.2K", " 12 ", "3000000000"]
    rows = texts(votes).orderBy("id").select(text.parse_votes("text").alias("v"))
    assert [r.v for r in rows.collect()] == [7, 0, 0, 0, 12, 3_000_000_000]


def test_transcript(spark):
    df = spark.createDataFrame(
        [(["Hello World", "AGAIN"],), ([],)], "t array<string>"
    ).select(F.transform("t", lambda x: F.struct(x.alias("text"))).alias("segments"))
    assert [r[0] for r in df.select(text.transcript("segments")).collect()] == [
        "hello world again",
        "",
    ]


def test_iso_strings(spark):
    df = spark.sql(
        """SELECT timestamp '2024-09-01 10:00:00' a, timestamp_ntz '2024-09-01 10:00:00.5' b,
                  CAST(NULL AS timestamp) c"""
    )
    row = df.select(time.iso_string("a"), time.iso_string("b"), time.iso_string("c")).first()
    assert tuple(row) == ("2024-09-01T10:00:00", "2024-09-01T10:00:00.500000", None)


def test_epoch_and_utc_strings(spark):
    row = spark.range(1).select(
        time.epoch_iso_string(F.lit(1725184800)), time.utc_string(F.timestamp_seconds(F.lit(0)))
    )
    assert tuple(row.first()) == ("2024-09-01T10:00:00", "1970-01-01T00:00:00Z")


def test_event_time(texts):
    values = ["2024-09-01T10:00:00", "2024-09-01T10:00:00.250000", "yesterday", None]
    rows = texts(values).orderBy("id").select(time.event_time("text").alias("t")).collect()
    assert [None if r.t is None else r.t.isoformat() for r in rows] == [*values[:2], None, None]


def test_watch_url_and_strip(texts):
    rows = texts([" \tk8c\n"]).select(text.strip_whitespace("text").alias("v"))
    assert rows.first().v == "k8c"
    assert rows.select(text.watch_url("v")).first()[0] == "https://www.youtube.com/watch?v=k8c"


def test_utc_string_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_seconds(1725184800) AS t, timestamp_ntz'2024-09-01 10:00:00' AS n")
        row = df.select(time.utc_string("t").alias("t"), time.utc_string("n").alias("n")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (row.t, row.n) == ("2024-09-01T10:00:00Z", "2024-09-01T10:00:00Z")
