"""Language identification: sparse multinomial regression on TF-IDF character n-grams.

N-grams of one to three characters of the lower-cased text, with everything but letters as one
space, are hashed into buckets. Document frequencies come from all training texts. The weights
are trained with follow-the-regularised-leader and elastic-net penalties on a bounded sample,
in shards whose weights are averaged, and the scores are calibrated by one temperature on
sampled texts that no shard has seen.

Nulls and edge cases: a null text, or one without a letter, is ``und`` with score 0; rows
without a language are predicted but never learned from; without any learned language all is
``und``; ties go to the language that sorts first; repeated rows count as often as they occur;
texts of any length are counted whole, in stretches of bounded size; an empty table gives no
row; extra columns are not read, and two named like the new ones are replaced.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agorameter.llm.common import cut, prepare

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """Parameters of the classifier.

    ``sample`` bounds the texts per language that weights and temperature are fitted on
    (in expectation, by a hash of the id); all languages are learned. ``weights`` bounds the
    weights of a task: with more languages than ``weights / buckets`` the n-grams share fewer
    buckets, ``fewest`` at least. Counts are taken over all training texts.
    """

    buckets: int = 1 << 15
    longest: int = 3
    sample: int = 1500
    weights: int = 1 << 23
    fewest: int = 1 << 12
    held_back: float = 0.2
    shards: int = 4
    passes: int = 3
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-3
    stretch: int = 1 << 20


#: Multipliers of the hash, one for each place in an n-gram; odd, otherwise of no meaning.
PLACES = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether a code point is a letter; made once per worker."""
    if not _LETTERS:
        flags = (chr(c).isalpha() for c in range(sys.maxunicode + 1))
        _LETTERS.append(np.fromiter(flags, dtype=bool, count=sys.maxunicode + 1))
    return _LETTERS[0]


def counts(text: str, settings: Settings) -> np.ndarray | None:
    """Occurrences of each bucket's n-grams; None for a text without a letter."""
    total = np.zeros(settings.buckets, dtype=np.int64)
    shift = np.uint32(32 - (settings.buckets.bit_length() - 1))
    found, kept = False, np.array([32], dtype=np.uint32)
    for start in range(0, len(text), settings.stretch):
        body = text[start : start + settings.stretch].lower().encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(body, dtype="<u4")
        codes = np.where(letters()[codes], codes, 32)
        found = found or bool((codes != 32).any())
        if start + settings.stretch >= len(text):
            codes = np.append(codes, 32)
        codes = np.concatenate((kept, codes)).astype(np.uint32)
        # One space for a run of others; a stretch starts with the last characters before it.
        same = np.zeros(len(codes), dtype=bool)
        same[1:] = (codes[1:] == 32) & (codes[:-1] == 32)
        same[: len(kept)] = False
        codes = codes[~same]
        old = len(kept) if start else 0
        hashed = np.zeros(len(codes), dtype=np.uint32)
        for place in range(settings.longest):
            size = len(codes) - place
            if size <= 0:
                break
            hashed = hashed[:size] + codes[place:] * np.uint32(PLACES[place])
            new = hashed[max(0, old - place) :]
            mixed = (new ^ (new >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * place)
            total += np.bincount(mixed >> shift, minlength=settings.buckets)
        kept = codes[-(settings.longest - 1) :] if settings.longest > 1 else codes[:0]
    return total if found else None


def features(text: str | None, idf: np.ndarray, settings: Settings):
    """Buckets and TF-IDF values of unit length; None without a letter."""
    occurrences = counts(text, settings) if text else None
    if occurrences is None:
        return None
    places = np.flatnonzero(occurrences)
    values = (1 + np.log(occurrences[places])) * idf[places]
    return places, values / max(np.sqrt(values @ values), 1e-12)


def train(rows: pd.DataFrame, classes: int, settings: Settings) -> np.ndarray:
    """Weights (bucket, class) of one shard: per-coordinate FTRL with elastic net."""
    z = np.zeros((settings.buckets, classes))
    n = np.zeros((settings.buckets, classes))

    def weights(z, n):
        shrunk = np.sign(z) * np.maximum(np.abs(z) - settings.l1, 0)
        return -shrunk / ((settings.beta + np.sqrt(n)) / settings.alpha + settings.l2)

    rows = rows.sort_values("order", kind="stable")
    data = [
        (y, np.frombuffer(i, "<i4"), np.frombuffer(v, "<f4").astype(float))
        for y, i, v in zip(rows["label"], rows["places"], rows["weights"], strict=True)
    ]
    for _ in range(settings.passes):
        for label, places, values in data:
            zs, ns = z[places], n[places]
            w = weights(zs, ns)
            p = softmax(values @ w)
            p[label] -= 1
            gradient = values[:, None] * p
            squares = ns + gradient**2
            z[places] = zs + gradient - (np.sqrt(squares) - np.sqrt(ns)) / settings.alpha * w
            n[places] = squares
    return weights(z, n)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by golden-section search.

    The targets are smoothed by one observation of each class, so the scores stay below
    certainty where no held-back text is wrong.
    """
    if not len(labels):
        return 1.0
    target = np.full(logits.shape, 1 / (len(labels) + logits.shape[1]))
    target[np.arange(len(labels)), labels] *= len(labels) + 1

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))
        return float(-(target * np.log(np.maximum(p, 1e-300))).sum(axis=1).mean())

    low, high, ratio = -4.0, 4.0, (np.sqrt(5) - 1) / 2
    while high - low > 1e-3:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass
class Model:
    """What a prediction needs: bounded by buckets and languages, not by the corpus."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float
    settings: Settings

    def predict(self, text: str | None) -> tuple[str, float]:
        found = features(text, self.idf, self.settings) if self.languages else None
        if found is None:
            return UNKNOWN, 0.0
        places, values = found
        p = softmax(values @ self.weights[places] / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def fitted(settings: Settings, languages: int) -> Settings:
    """The settings with as many buckets as the weights of so many languages leave."""
    buckets = settings.buckets
    while buckets > settings.fewest and buckets * languages > settings.weights:
        buckets //= 2
    return replace(settings, buckets=buckets)


def document_frequencies(texts: DataFrame, settings: Settings) -> tuple[np.ndarray, int]:
    """Documents per bucket over all texts, and documents with a letter.

    A task adds up its texts and emits one row per bucket it met.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(settings.buckets + 1, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = counts(text, settings) if text else None
                if found is not None:
                    total[:-1] += found > 0
                    total[-1] += 1
        places = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict(
            {"bucket": pa.array(places, pa.int64()), "n": pa.array(total[places])}
        )

    rows = (
        texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).toPandas()
    )
    total = np.zeros(settings.buckets + 1, dtype=np.int64)
    total[rows.iloc[:, 0].to_numpy()] = rows.iloc[:, 1].to_numpy()
    return total[:-1], int(total[-1])


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", settings=Settings()
) -> Model:
    """Learn from the texts with a language."""
    prepare(docs.sparkSession)
    rows = docs.where(F.col(lang).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")
    )
    sizes = {
        r["lang"]: r["n"]
        for r in rows.groupBy("lang")
        .agg(F.count("text").alias("n"))
        .collect()
        if r["n"]
    }
    languages = sorted(sizes)
    if not languages:
        return Model([], np.ones(settings.buckets), np.zeros((settings.buckets, 0)), 1.0, settings)
    settings = fitted(settings, len(languages))
    frequency, total = document_frequencies(rows.select("text"), settings)
    idf = np.log((1 + total) / (1 + frequency)) + 1
    labels = {name: i for i, name in enumerate(languages)}

    def represent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for name, body, order in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = features(body, idf, settings)
                if found is not None:
                    places, values = found
                    out.append(
                        (labels[name], order, places.astype("<i4").tobytes(), values.astype("<f4").tobytes())
                    )
            if out:
                columns = list(zip(*out, strict=True))
                types = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
                names = ("label", "order", "places", "weights")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
                )

    sampled = cut(
        rows.select("lang", "text", F.xxhash64("key", F.lit(17)).alias("order"))
        .where(_share("lang", sizes, settings.sample))
        .mapInArrow(represent, "label int, order long, places binary, weights binary")
    )
    # The driver gets a logit per held-back text and language, of both a bounded number.
    most = settings.weights / (settings.sample * len(languages) ** 2)
    held_share = int(1e6 * min(settings.held_back, most))
    back = F.pmod(F.xxhash64("order", F.lit(1)), F.lit(1_000_000)) < held_share
    shard = F.pmod(F.xxhash64("order", F.lit(2)), F.lit(settings.shards)).cast("int")

    def train_shard(part: pd.DataFrame) -> pd.DataFrame:
        learned = train(part, len(languages), settings)
        return pd.DataFrame({"weights": [learned.astype("<f8").tobytes()]})

    shards = (
        sampled.where(~back)
        .withColumn("shard", shard)
        .groupBy("shard")
        .applyInPandas(train_shard, "weights binary")
        .collect()
    )
    shape = (settings.buckets, len(languages))
    parts = [np.frombuffer(r["weights"], "<f8").reshape(shape) for r in shards]
    weights = np.mean(parts, axis=0) if parts else np.zeros(shape)
    # Averaging leaves small rests of single shards; the penalty's threshold removes them.
    weights[np.abs(weights) < settings.l1] = 0

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logits = [
                np.frombuffer(v, "<f4") @ weights[np.frombuffer(i, "<i4")]
                for i, v in zip(*(batch.column(c).to_pylist() for c in (1, 2)), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.tolist() for x in logits], pa.list_(pa.float64()))],
                names=("label", "logits"),
            )

    held = (
        sampled.where(back)
        .select("label", "places", "weights")
        .mapInArrow(score, "label int, logits array<double>")
        .toPandas()
    )
    t = temperature(
        np.array(held["logits"].tolist()).reshape(len(held), len(languages)),
        held["label"].to_numpy(dtype=np.int64),
    )
    return Model(languages, idf, weights, t, settings)


def _share(lang: str, sizes: dict[str, int], bound: int) -> Column:
    """Rows of each language by a hash of their order, about ``bound`` at most."""
    place = F.pmod(F.xxhash64("order", F.lit(3)), F.lit(1_000_000))
    shares = [F.lit(min(1_000_000, max(1, round(1e6 * bound / n)))) for n in sizes.values()]
    share = F.map_from_arrays(F.array(*map(F.lit, sizes)), F.array(*shares))
    return place < F.coalesce(F.element_at(share, F.col(lang)), F.lit(0))


def scored(model: Model, spark: SparkSession, text: str = "text") -> Column:
    """``struct<lang_pred, score>`` of a text column; the other columns stay where they are."""
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def run(texts):
        found = [shared.value.predict(x) for x in texts]
        labels, scores = zip(*found, strict=True) if found else ((), ())
        return pd.DataFrame({"lang_pred": labels, "score": scores}).astype({"score": "float64"})

    return run(F.col(text))


def predict(
    docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The rows with ``lang_pred`` and ``score``, the calibrated probability.

    ``keep`` names the columns to return, by default all; two that have the new names go.
    """
    prepare(docs.sparkSession)
    names = docs.columns if keep is None else keep
    columns = [c for c in names if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(x) for x in batch.column(0).to_pylist()]
            labels, scores = zip(*found, strict=True) if found else ((), ())
            new = [pa.array(labels, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *new], names=[*columns, "lang_pred", "score"]
            )

    read = docs.select(F.col(text).alias("__text"), *columns)
    schema = docs.select(*columns).schema.add("lang_pred", "string").add("score", "double")
    return read.mapInArrow(run, schema)
