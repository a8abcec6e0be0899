"""The registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agorameter.llm import (
    conversation_trie,
    divergence,
    embedding_dedup,
    exact_dedup,
    language,
    licenses,
    neighbours,
    ngram_join,
    packing,
    quality,
    secrets,
    sentencepiece,
    sql,
    substrings,
)
from agorameter.llm.common import cut, table

Query = Callable[[SparkSession, str], DataFrame]


def fold(parts: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``parts``."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of all documents, learned from those outside fold 1 of 3."""
    held_out = F.coalesce(fold(3) == 1, F.lit(False))
    docs = table(spark, folder, "documents").withColumn("held_out", held_out)
    model = language.fit(docs.where(fold(3) != 1))
    return language.predict(docs, model, keep=["doc_id", "held_out"])


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of documents; a document is a repository, its source the owner."""
    return secrets.span_digest(secrets.scan_secrets(table(spark, folder, "documents")))


def op3_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose three-word shingles are 90 per cent the same."""
    return ngram_join.jaccard_components(table(spark, folder, "documents"), size=3, percent=90)


def word_vocabulary() -> str:
    """The file of the lower-casing word vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_pack(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 2048 ids."""
    return packing.pack(table(spark, folder, "documents"), word_vocabulary())


def op5_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return neighbours.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of vectors with a cosine of 0.9 or more."""
    return embedding_dedup.deduplicate(table(spark, folder, "embeddings"))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of all documents, learned from the labels outside fold 0 of 5."""
    docs = table(spark, folder, "documents")
    vectors = cut(quality.with_statistics(docs, "doc_id", "text"))
    labels = table(spark, folder, "labels").where(fold(5) != 0)
    labelled = vectors.join(
        labels.select(F.col("doc_id").alias("key"), F.col("quality").alias("label")), "key"
    )
    scored = quality.predict(vectors, quality.fit(labelled)).withColumnRenamed("key", "doc_id")
    held_out = F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted")


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents in windows of 20 that also start earlier."""
    docs = table(spark, folder, "documents")
    return substrings.remove_repeats(docs, keep=["doc_id"], digest=True)


def op9_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Number, checksum and round trip of the ids of all documents."""
    import public_tokenizers

    pieces = sentencepiece.load_pieces(
        public_tokenizers.path("piece_bpe_32k.model"), merges=True
    )
    return sentencepiece.encode(table(spark, folder, "documents"), pieces, digest=True)


def sentencepiece_viterbi(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded by the best path through the lattice, decoded, and compared."""
    import public_tokenizers

    pieces = sentencepiece.load_pieces(
        public_tokenizers.path("piece_bpe_32k.model"), merges=False
    )
    docs = table(spark, folder, "documents").select("doc_id", "text")
    encoded = cut(sentencepiece.encode(docs, pieces))
    decoded = sentencepiece.decode(encoded, pieces).withColumnRenamed("text", "decoded")
    counted = encoded.select("doc_id", F.size("ids").alias("n_ids"))
    met = docs.join(counted, "doc_id").join(decoded, "doc_id")
    same = F.col("decoded").eqNullSafe(F.coalesce("text", F.lit("")))
    return met.select("doc_id", "n_ids", same.alias("round_trip"))


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and detections of all documents."""
    return licenses.summary(licenses.scan(table(spark, folder, "documents")))


def op11_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Differences between the sources of each language, and the terms they use most."""
    return divergence.audit(table(spark, folder, "documents"))


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, each begun by the first of its five."""
    return conversation_trie.trie(table(spark, folder, "conversations"))


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The row that stays of all documents with the same text but for white space."""
    return exact_dedup.groups(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_secret_scan,
        op3_ngram_join,
        op4_pack,
        op5_neighbours,
        op6_embedding_dedup,
        op7_quality,
        op8_substring_dedup,
        op9_sentencepiece,
        sentencepiece_viterbi,
        op10_license_scan,
        op11_divergence,
        op12_conversation_trie,
        op13_exact_dedup,
    )
}
SQL: dict[str, str] = {
    "op3_ngram_join": sql.JACCARD,
    "op6_embedding_dedup": sql.EMBEDDINGS,
    "op8_substring_dedup": sql.SUBSTRINGS,
    "op11_divergence": sql.DIVERGENCE,
    "op12_conversation_trie": sql.CONVERSATIONS,
    "op13_exact_dedup": sql.EXACT,
}
