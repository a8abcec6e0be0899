"""From raw documents to packed sequences: five stages, each over all that the last one kept.

1. ``language_id``: documents in no learned language go (no letter, or no language likelier
   than ``LEAST_SCORE``).
2. ``ngram_join``: of each group of near-duplicates (five-word shingles, similarity 0.8) the
   document with the smallest id stays.
3. ``substring_dedup``: words in runs of 20 that an earlier document or place has are removed.
4. ``secret_scan``: secrets are replaced by a mark.
5. ``pack``: the texts as pieces of sequences of 2048 ids.

A missing text is in no language and goes in the first stage. Rows are told apart by id and
text: rows of one id with different texts, or without id, are documents of their own, and of
several near-duplicates one stays, with the smallest id that no other text has, if any. Extra
columns may have any names but that of the text; an empty table gives empty tables.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from agorameter.llm import language, ngram_join, packing, secrets, substrings  # noqa: E402
from agorameter.llm.common import cut, id_filter, maybe_among, prepare  # noqa: E402
from agorameter.llm.queries import word_vocabulary  # noqa: E402
from agorameter.session import remove_folder, shared_folder  # noqa: E402

#: Below this calibrated probability a text counts as none of the learned languages.
LEAST_SCORE = 0.3


def _as_documents(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of the documents, from the struct ``own``, with the new text and its size."""

    def column(name: str) -> Column:
        if name == "n_chars":
            return F.length("text").cast(docs.schema[name].dataType).alias(name)
        return F.col("text") if name == "text" else F.col(f"own.`{name}`").alias(name)

    return changed.select(*(column(c) for c in docs.columns))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language."""
    found = language.scored(language.fit(docs), spark)
    return docs.where((found["lang_pred"] != language.UNKNOWN) & (found["score"] >= LEAST_SCORE))


def _with_keys(docs: DataFrame) -> DataFrame:
    """``__key, text, own``: a number for each id, or for each text where an id has several.

    Rows without id, and those whose id has several rows, get numbers beyond all ids by id and
    digest of the text, from a table that is written once. ``own`` holds the columns.
    """
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("own"))
    repeated = cut(
        docs.groupBy(F.col("doc_id").alias("id")).count().where("count > 1 OR id IS NULL").select("id")
    )
    if repeated.isEmpty():
        return rows.select(F.col("doc_id").alias("__key"), "text", "own")
    beyond = docs.agg(F.max("doc_id")).first()[0] or 0
    among = F.col("doc_id").isNull() | maybe_among(id_filter(repeated, "id"), "doc_id")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    same = F.col("doc_id").eqNullSafe(F.col("id"))
    shared = docs.where(among).select("doc_id", digest.alias("__digest"))
    numbers = cut(
        shared.join(repeated, same, "left_semi")
        .distinct()
        .orderBy(F.col("doc_id").asc_nulls_last(), "__digest")
        .select(
            F.col("doc_id").alias("id"),
            F.col("__digest").alias("digest"),
            (F.monotonically_increasing_id() + (beyond + 1)).alias("number"),
        )
    )
    met = rows.where(among).join(
        numbers, same & (digest == F.col("digest")), "left"
    ).select(F.coalesce("number", "doc_id").alias("__key"), "text", "own")
    return rows.where(~among).select(F.col("doc_id").alias("__key"), "text", "own").unionByName(met)


def ngram_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    prepare(spark)
    rows = _with_keys(docs)
    found = ngram_join.jaccard_components(rows, key="__key", size=5, percent=80)
    groups = cut(
        found.groupBy("__key")
        .agg(F.count("*").alias("rows"), (F.min("component_id") == F.col("__key")).alias("first"))
        .where("rows > 1 OR NOT first")
        .select(F.col("__key").alias("key"), "first")
    )
    # Only rows whose key may be among these are shuffled.
    among = maybe_among(id_filter(groups, "key"), "__key")
    met = rows.where(among).join(groups, F.col("__key") == F.col("key"), "left")
    alone = met.where("key IS NULL").select("own.*")
    first = met.where("first").dropDuplicates(["__key"]).select("own.*")
    return rows.where(~among).select("own.*").unionByName(alone).unionByName(first)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words that earlier ones have."""
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select("doc_id", "text", F.struct(*others).alias("own"))
    return _as_documents(substrings.remove_repeats(rows, keep=["own", "text"]), docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced."""
    prepare(spark)
    own = F.struct(*(c for c in docs.columns if c != "text")).alias("own")
    rows = docs.select("doc_id", "text", "source", own)
    return _as_documents(secrets.redact(rows), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their sequences and places."""
    return packing.pack(docs, word_vocabulary())


STAGES = [
    ("language_id", language_id),
    ("ngram_join", ngram_dedup),
    ("substring_dedup", substring_dedup),
    ("secret_scan", secret_scan),
    ("pack", pack),
]
#: No SQL engine expresses the language classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    result = cut(STAGES[-1][1](spark, docs, sf_dir))
    remove_folder(spark, folder)
    return result
