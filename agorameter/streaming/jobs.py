"""Starting streaming queries.

Every writer needs a checkpoint folder on storage that all machines share and that
outlives them: it is what lets a query resume after a loss without repeating output.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from agorameter.schemas import WRITE_RETRIES, WRITE_RETRY_WAIT

#: How often queries that run together are looked at.
POLL_SECONDS = 0.5
#: Process what is there and stop, or a processing interval such as "1 minute".
AVAILABLE_NOW = "available now"


def _writer(df: DataFrame, checkpoint: str, trigger: str, name: str | None) -> DataStreamWriter:
    if not checkpoint:
        raise ValueError("a checkpoint folder is required")
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if trigger == AVAILABLE_NOW:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def start_table_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str = AVAILABLE_NOW,
    name: str | None = None,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append to a file table. The sink's commit log makes each batch appear exactly once."""
    writer = _writer(df, checkpoint, trigger, name).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path)


#: Helper column with the id of a search document; it is not stored as a field.
DOCUMENT_ID = "document_id"


def search_options(nodes: str, port: int) -> dict[str, str]:
    """Options of a search index writer with retries."""
    return {
        "es.nodes": nodes,
        "es.port": str(port),
        "es.batch.write.retry.count": str(WRITE_RETRIES),
        "es.batch.write.retry.wait": WRITE_RETRY_WAIT,
    }


def with_document_id(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Add a document id: a digest of the whole record, and of its key where it has one.

    A retry gives each record the same id. Versions of one key differ, so all are kept.
    """
    keyed = reduce(and_, [F.col(c).isNotNull() for c in key])
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    named = F.to_json(F.when(keyed, F.struct(*key)))
    return df.withColumn(DOCUMENT_ID, F.sha2(F.concat_ws("\n", named, record), 256))


def start_search_sink(
    df: DataFrame,
    index: str,
    checkpoint: str,
    options: dict[str, str],
    trigger: str = AVAILABLE_NOW,
    name: str | None = None,
    key: Sequence[str] = (),
) -> StreamingQuery:
    """Append to a search index; needs the search store's package on the classpath.

    With a key a repeated batch overwrites its documents instead of adding them again;
    different versions of a key stay apart.
    """
    if key:
        df = with_document_id(df, key)
        options = options | {"es.mapping.id": DOCUMENT_ID, "es.mapping.exclude": DOCUMENT_ID}
    return _writer(df, checkpoint, trigger, name).format("es").options(**options).start(index)


def start_topic_sink(
    df: DataFrame,
    servers: str,
    checkpoint: str,
    trigger: str = AVAILABLE_NOW,
    name: str | None = None,
) -> StreamingQuery:
    """Send each row of ``(key, value, topic)`` to its topic; needs the Kafka package."""
    messages = df.select("key", "value", "topic")
    return (
        _writer(messages, checkpoint, trigger, name)
        .format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .start()
    )


def start_batch_sink(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: str = AVAILABLE_NOW,
    name: str | None = None,
) -> StreamingQuery:
    """Hand each micro-batch to ``write(batch, batch_id)``, which has to be repeatable."""
    return _writer(df, checkpoint, trigger, name).foreachBatch(write).start()


def batch_folder_writer(
    path: str, key: Sequence[str] = (), fmt: str = "parquet"
) -> Callable[[DataFrame, int], None]:
    """A repeatable batch writer: batch n replaces the folder ``batch_id=n``.

    With ``key`` a batch keeps one row per key; across batches :func:`without_repeats` does.
    Rows without a key value, such as those of malformed messages, are all kept.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = _one_per_key(batch, key) if key else batch
        rows.write.format(fmt).mode("overwrite").save(f"{path}/batch_id={batch_id}")

    return write


def _one_per_key(batch: DataFrame, key: Sequence[str]) -> DataFrame:
    no_key = reduce(or_, [F.col(c).isNull() for c in key])
    salt = F.when(no_key, F.monotonically_increasing_id())
    return batch.withColumn("_salt", salt).dropDuplicates([*key, "_salt"]).drop("_salt")


def without_repeats(df: DataFrame, key: Sequence[str], delay: str = "1 day") -> DataFrame:
    """A stream in which each key comes once, also when it is repeated in a later batch.

    A repeat is dropped if it arrives within ``delay``, by processing time; that bounds the
    state to the keys of this time. Records without a key are all kept. With the version
    among the key columns, each version of a record is kept.
    """
    no_key = reduce(or_, [F.col(c).isNull() for c in key])
    marked = df.withColumns(
        {"_alone": F.when(no_key, F.uuid()), "_arrived": F.current_timestamp()}
    )
    kept = marked.withWatermark("_arrived", delay).dropDuplicatesWithinWatermark([*key, "_alone"])
    return kept.drop("_alone", "_arrived")


#: Name under which a stream counts its model calls, and the calls before which no share is judged.
CALLS = "calls"
LEAST_CALLS = 100


class TooManyErrors(RuntimeError):
    """More model calls than allowed have failed."""


def with_call_counts(records: DataFrame, flag: str = "score_error") -> DataFrame:
    """The stream, counting its records and those without a score in each batch's progress.

    The counts are taken while a batch runs: nothing is read again, whatever the sink is.
    """
    total, failed = F.count("*").alias("total"), F.count_if(F.col(flag)).alias("failed")
    return records.observe(CALLS, total, failed)


class CallLimit:
    """Ends a query of :func:`with_call_counts` whose new records fail too often.

    Judged are the records since the query was started, once there are ``least`` of them, or
    at its end.
    """

    def __init__(self, most: float, least: int = LEAST_CALLS):
        self.most, self.least = most, least
        self.seen: dict[str, tuple[int, int, int]] = {}

    def __call__(self, query: StreamingQuery, ended: bool = False) -> None:
        run = str(query.runId)
        last, total, failed = self.seen.get(run, (-1, 0, 0))
        for progress in query.recentProgress:
            counts = progress.observedMetrics.get(CALLS)
            if counts is not None and progress.batchId > last:
                last = progress.batchId
                total, failed = total + counts["total"], failed + counts["failed"]
        self.seen[run] = last, total, failed
        if (ended or total >= self.least) and failed > self.most * total:
            raise TooManyErrors(
                f"{query.name}: {failed} of {total} new records without a score, "
                f"more than {self.most:.0%}"
            )


Check = Callable[..., None]


def run_in_turn(
    starters: Iterable[Callable[[], StreamingQuery]], check: Check | None = None
) -> list[StreamingQuery]:
    """Start each query after the one before has ended; returns the ended queries.

    ``check(query)`` is called while a query runs and ``check(query, ended=True)`` after it; an
    error it raises stops the query.
    """
    ended = []
    for start in starters:
        query = start()
        try:
            while not query.awaitTermination(POLL_SECONDS):
                if check:
                    check(query)
            if check:
                check(query, ended=True)
        finally:
            if query.isActive:
                query.stop()
        ended.append(query)
    return ended


def run_together(
    starters: Iterable[Callable[[], StreamingQuery]], check: Check | None = None
) -> list[StreamingQuery]:
    """Start all queries and wait for all of them.

    When one fails, or ``check`` of one raises an error, the others are stopped and the error is
    raised, whichever it is.
    """
    queries = [start() for start in starters]
    try:
        while any(query.isActive for query in queries):
            for query in queries:
                if query.exception() is not None:
                    query.awaitTermination()  # raises the error of the query
                if check:
                    check(query)
            time.sleep(POLL_SECONDS)
        for query in queries:
            query.awaitTermination()
            if check:
                check(query, ended=True)
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
    return queries
