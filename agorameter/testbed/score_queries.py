"""Queries on chunks and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorameter.functions import scoring, text
from agorameter.plans import enrich
from agorameter.schemas import EMOTIONS, SENTIMENTS
from agorameter.testbed import inputs, sql
from agorameter.testbed.registry import register, rounded, shipped
from agorameter.testbed.wordlists import letter_scorer, scorer

_CHUNKS = sql.chunks("SELECT doc_id, text FROM documents", "doc_id", "text")


@register(f"SELECT doc_id, i AS chunk_no, chunk FROM ({_CHUNKS})")
def chunk_text(spark, folder):
    return enrich.chunk_table(inputs.documents(spark, folder), "doc_id", "text")


@register(
    """SELECT doc_id, CAST(ceil(length(text) / 500.0) AS INTEGER) AS chunks,
              CAST(length(text) - 500 * (ceil(length(text) / 500.0) - 1) AS INTEGER) AS last_length
       FROM documents"""
)
def chunk_counts(spark, folder):
    chunks = text.chunk_text("text")
    return inputs.documents(spark, folder).select(
        "doc_id",
        F.size(chunks).alias("chunks"),
        F.length(F.element_at(chunks, -1)).alias("last_length"),
    )


def _chunk_sql(kind: str, labels) -> str:
    rows = sql.chunk_probabilities("SELECT doc_id, text FROM documents", "doc_id", "text", kind)
    columns = ", ".join(f"round(p_{x}, 6) AS {x}" for x in labels)
    return f"SELECT doc_id, i AS chunk_no, {columns} FROM ({rows})"


def _chunk_scores(spark, folder, kind, labels):
    scores = scorer().chunk_scores(text.chunk_sql("text"), [kind])
    exploded = inputs.documents(spark, folder).select(
        "doc_id", F.posexplode(scores).alias("chunk_no", "p")
    )
    named = [F.col("p")[kind][i].alias(x) for i, x in enumerate(labels)]
    return rounded(exploded.select("doc_id", "chunk_no", *named), *labels)


@register(_chunk_sql("sentiment", SENTIMENTS))
def chunk_sentiment(spark, folder):
    return _chunk_scores(spark, folder, "sentiment", SENTIMENTS)


@register(_chunk_sql("emotion", EMOTIONS))
def chunk_emotion(spark, folder):
    return _chunk_scores(spark, folder, "emotion", EMOTIONS)


def _scored(df: DataFrame, keys: list[str], score) -> DataFrame:
    """Keys and the fields of a score struct."""
    return df.select(*keys, text.expand_once(score))


_DOCUMENTS = "SELECT doc_id, text FROM documents"
_TURNS = "SELECT conv_id || '-' || turn AS uuid, text FROM conversations"


@register(sql.rounded(sql.sentiment(_DOCUMENTS, "doc_id", "text")))
def sentiment_documents(spark, folder):
    df = inputs.documents(spark, folder)
    return rounded(_scored(df, ["doc_id"], scoring.sentiment("text", scorer())))


@register(sql.rounded(sql.sentiment(_TURNS, "uuid", "text")))
def sentiment_conversations(spark, folder):
    df = inputs.conversations(spark, folder).withColumn("uuid", F.concat_ws("-", "conv_id", "turn"))
    return rounded(_scored(df, ["uuid"], scoring.sentiment("text", scorer())))


@register(sql.emotion(_DOCUMENTS, "doc_id", "text"))
def emotion_documents(spark, folder):
    df = inputs.documents(spark, folder)
    return _scored(df, ["doc_id"], scoring.emotion("text", scorer()))


@register(sql.emotion(_TURNS, "uuid", "text"))
def emotion_conversations(spark, folder):
    df = inputs.conversations(spark, folder).withColumn("uuid", F.concat_ws("-", "conv_id", "turn"))
    return _scored(df, ["uuid"], scoring.emotion("text", scorer()))


_GAPS = """SELECT doc_id || '-text' AS id, text FROM documents
           UNION ALL SELECT doc_id || '-empty', '' FROM documents
           UNION ALL SELECT doc_id || '-none', NULL FROM documents"""


def _with_gaps(spark, folder) -> DataFrame:
    """Every document with its text, with an empty one, and with none."""
    variants = F.create_map(
        F.lit("text"), F.col("text"), F.lit("empty"), F.lit(""), F.lit("none"), F.lit(None)
    )
    rows = inputs.documents(spark, folder).select("doc_id", F.explode(variants))
    return rows.select(F.concat_ws("-", "doc_id", "key").alias("id"), F.col("value").alias("text"))


@register(sql.rounded(sql.sentiment(_GAPS, "id", "text")))
def sentiment_defaults(spark, folder):
    df = _with_gaps(spark, folder)
    return rounded(_scored(df, ["id"], scoring.sentiment("text", scorer())))


@register(sql.emotion(_GAPS, "id", "text"))
def emotion_defaults(spark, folder):
    return _scored(_with_gaps(spark, folder), ["id"], scoring.emotion("text", scorer()))


@register(
    f"""SELECT *, contains(text, '@') AS score_error
        FROM ({sql.rounded(sql.enriched(_DOCUMENTS, "doc_id", "text", lexicon=False))})"""
)
def model_scores(spark, folder):
    """Both kinds by a Python model, which refuses some texts."""
    shipped(spark)
    df = inputs.documents(spark, folder)
    score = scoring.score_text("text", letter_scorer(), errors=True)
    return rounded(_scored(df, ["doc_id", "text"], score))
