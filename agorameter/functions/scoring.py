"""Sentiment and emotion of a text.

A text is cut into chunks, a scorer gives label probabilities per chunk, and the
chunks are folded into one result per row. The fold is one expression over the
row's own array: no grouping, no shuffle, and the same code in batch and stream.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import reduce
from operator import or_
from typing import Protocol

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agorameter.functions.text import chunk_sql
from agorameter.schemas import CHUNK_SIZE, EMOTIONS, SENTIMENTS

#: Vocabularies by kind of score.
LABELS = {"sentiment": SENTIMENTS, "emotion": EMOTIONS}

#: What a missing text or a failed model call gives.
DEFAULT_SENTIMENT = ("neutral", 0.0, 1.0, 0.0)
DEFAULT_EMOTION = "null"


class Scorer(Protocol):
    """Scores chunks of text.

    For an array of chunks, given as SQL expression, it gives an array of structs with one
    field per kind, each an array of probabilities in vocabulary order. NULL chunks give
    NULL; a NULL field marks a failed call.
    """

    def chunk_scores(self, chunks: str, kinds: Sequence[str]) -> Column: ...


class LexiconScorer:
    """Counts opinion words, in any case; runs as plain Spark expressions.

    A word of the text is a run of letters, so lexicon words have to be letters only.

    The weight of a label is 1 plus its word hits in the chunk (neutral has the fixed
    weight 2); its probability is the weight's share of the total.
    """

    NEUTRAL_WEIGHT = 2.0

    def __init__(
        self,
        sentiment: Mapping[str, Iterable[str]],
        emotion: Mapping[str, Iterable[str]] | None = None,
    ) -> None:
        self._words = {
            "sentiment": {k: tuple(w.lower() for w in v) for k, v in sentiment.items()},
            "emotion": {k: tuple(w.lower() for w in v) for k, v in (emotion or {}).items()},
        }
        for kind, words in self._words.items():
            unknown = set(words) - set(LABELS[kind])
            if unknown:
                raise ValueError(f"unknown {kind} labels: {sorted(unknown)}")
        if "neutral" in self._words["sentiment"]:
            raise ValueError("neutral has a fixed weight and takes no words")

    def _weight(self, kind: str, label: str) -> str:
        if (kind, label) == ("sentiment", "neutral"):
            return f"{self.NEUTRAL_WEIGHT}D"
        words = self._words[kind].get(label, ())
        return f"1D + size(filter(hits, w -> {_is_one_of('w', words)}))"

    def _probabilities(self, kind: str) -> str:
        weights = ", ".join(self._weight(kind, label) for label in LABELS[kind])
        total = "aggregate(weights, 0D, (sum, w) -> sum + w)"
        shares = "transform(weights, w -> w / total)"
        return _let("weights", f"array({weights})", _let("total", total, shares))

    def chunk_scores(self, chunks: str, kinds: Sequence[str]) -> Column:
        lexicon = sorted({w for k in kinds for ws in self._words[k].values() for w in ws})
        # Keep the few lexicon words of a chunk first: one set lookup per word, however
        # many labels there are. As SQL text this takes one call to the JVM; built column
        # by column it would take over a thousand.
        words = r"regexp_extract_all(lower(chunk), r'\p{L}+', 0)"
        hits = f"filter({words}, w -> {_is_one_of('w', lexicon)})"
        scores = ", ".join(f"'{k}', {self._probabilities(k)}" for k in kinds)
        per_chunk = _let("hits", hits, f"named_struct({scores})")
        return F.expr(f"transform({chunks}, chunk -> {per_chunk})")


def _is_one_of(name: str, words: Sequence[str]) -> str:
    """SQL condition; Spark turns more than a few words into a hash set."""
    if not words:
        return "false"
    escaped = [w.replace("\\", "\\\\").replace("'", "\\'") for w in words]
    return f"{name} IN ('" + "', '".join(escaped) + "')"


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` standing for a value that is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


#: A loaded model: texts in, one ``{label: probability}`` mapping per text out.
Predict = Callable[[Sequence[str]], Sequence[Mapping[str, float]]]


class ModelScorer:
    """Calls a Python model through one Arrow UDF for all requested kinds.

    ``loaders`` maps a kind to a function that loads its model. It runs once per Python
    worker process, when the first batch arrives, so no model travels with the plan. The
    chunks of all rows of a batch are scored together, ``batch_size`` at a time. When a
    call fails its rows are retried one by one, and only the failing rows get NULL
    probabilities.
    """

    def __init__(self, loaders: Mapping[str, Callable[[], Predict]], batch_size: int = 64) -> None:
        unknown = set(loaders) - set(LABELS)
        if unknown:
            raise ValueError(f"unknown kinds: {sorted(unknown)}")
        if batch_size < 1:
            raise ValueError("batch_size must be positive")
        self._loaders = dict(loaders)
        self._batch_size = batch_size
        # Names this scorer's models in the workers: functions lose their identity there.
        self._id = uuid.uuid4().hex

    def chunk_scores(self, chunks: str, kinds: Sequence[str]) -> Column:
        missing = [k for k in kinds if k not in self._loaders]
        if missing:
            raise ValueError(f"no model for {missing}")
        loaders = {k: self._loaders[k] for k in kinds}
        batch_size, scorer_id = self._batch_size, self._id

        def scored(lists: pa.Array) -> pa.Array:
            columns = [
                _chunk_probabilities(
                    lists, _loaded((scorer_id, kind), loader), LABELS[kind], batch_size
                )
                for kind, loader in loaders.items()
            ]
            chunk_structs = pa.StructArray.from_arrays(columns, list(loaders))
            nulls = lists.is_null() if lists.null_count else None
            return pa.ListArray.from_arrays(_offsets(lists), chunk_structs, mask=nulls)

        def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for lists in batches:
                yield pa.concat_arrays([scored(part) for part in _parts(lists)])

        element = T.StructType([T.StructField(k, T.ArrayType(T.DoubleType())) for k in kinds])
        # Non-deterministic keeps the optimizer from calling the model twice when a later
        # filter reads a score.
        udf = F.arrow_udf(score, T.ArrayType(element)).asNondeterministic()
        return udf(F.expr(chunks))


_MODELS: dict[tuple[str, str], Predict] = {}


def _loaded(key: tuple[str, str], loader: Callable[[], Predict]) -> Predict:
    if key not in _MODELS:
        # A worker is reused by later scorers: it holds the models of one at a time.
        for other in [k for k in _MODELS if k[0] != key[0]]:
            del _MODELS[other]
        _MODELS[key] = loader()
    return _MODELS[key]


#: Chunks that a worker holds as Python objects at a time; a row is not divided.
HELD_CHUNKS = 4096


def _parts(lists: pa.Array) -> Iterator[pa.Array]:
    """The rows in order, in slices of about :data:`HELD_CHUNKS` chunks."""
    start, chunks = 0, 0
    for row, size in enumerate(pc.fill_null(pc.list_value_length(lists), 0).to_pylist()):
        chunks += size
        if chunks >= HELD_CHUNKS:
            yield lists.slice(start, row + 1 - start)
            start, chunks = row + 1, 0
    if start < len(lists) or not start:
        yield lists.slice(start)


def _offsets(lists: pa.ListArray) -> pa.Array:
    """Row boundaries in the flattened chunks, starting at 0."""
    ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(lists), 0))
    return pa.concat_arrays([pa.array([0], pa.int32()), ends.cast(pa.int32())])


def _chunk_probabilities(
    lists: pa.ListArray, predict: Predict, labels: Sequence[str], batch_size: int
) -> pa.Array:
    """One list of probabilities per flattened chunk; NULL for the chunks of failed rows."""
    chunks = lists.flatten().to_pylist()
    bounds = _offsets(lists).to_pylist()
    scores = _predict_all(predict, chunks, labels, batch_size)
    for begin, end in zip(bounds, bounds[1:]):
        if None in scores[begin:end]:
            # The call may have failed because of another row's chunk: try this row alone.
            alone = _predict_all(predict, chunks[begin:end], labels, batch_size)
            scores[begin:end] = [None] * (end - begin) if None in alone else alone
    return pa.array(scores, pa.list_(pa.float64()))


def _predict_all(
    predict: Predict, chunks: Sequence[str], labels: Sequence[str], batch_size: int
) -> list[list[float] | None]:
    """Probabilities in label order per chunk; None for every chunk of a failed call."""
    scores: list[list[float] | None] = []
    for start in range(0, len(chunks), batch_size):
        batch = chunks[start : start + batch_size]
        try:
            results = predict(batch)
            if len(results) != len(batch) or any(set(r) - set(labels) for r in results):
                raise ValueError("the model gave an unknown label or a wrong number of results")
            scores += [[float(r.get(x, 0.0)) for x in labels] for r in results]
        except Exception:
            scores += [None] * len(batch)
    return scores


def score_text(
    text: str,
    scorer: Scorer,
    kinds: Sequence[str] = ("sentiment", "emotion"),
    chunk_size: int = CHUNK_SIZE,
    errors: bool = False,
) -> Column:
    """Struct with the sentiment label and means, and the emotion label.

    ``text`` is a column name or an SQL expression.

    * sentiment: mean probability over the chunks, every chunk counting the same, and
      the label with the highest mean;
    * emotion: the label with the highest sum over the chunks;
    * ties go to the first label in vocabulary order;
    * empty text has no chunk: all means are 0 and the first labels win;
    * NULL text or a failed call gives ``neutral`` (0, 1, 0) and the string ``null``.

    With ``errors`` the struct also has ``score_error``, true after a failed call.
    """
    kinds = tuple(kinds)
    if not kinds or set(kinds) - set(LABELS):
        raise ValueError(f"kinds have to be some of {list(LABELS)}")
    scores = scorer.chunk_scores(chunk_sql(text, chunk_size), kinds)
    zero = F.struct(
        F.lit(0).alias("chunks"),
        *[F.array_repeat(F.lit(0.0), F.lit(len(LABELS[k]))).alias(k) for k in kinds],
    )

    def add(sums: Column, chunk: Column) -> Column:
        return F.struct(
            (sums["chunks"] + 1).alias("chunks"),
            *[F.zip_with(sums[k], chunk[k], lambda a, b: a + b).alias(k) for k in kinds],
        )

    def finish(sums: Column) -> Column:
        fields = []
        if "sentiment" in kinds:
            fields += _sentiment_fields(sums["sentiment"], sums["chunks"])
        if "emotion" in kinds:
            label = F.coalesce(first_highest(sums["emotion"], EMOTIONS), F.lit(DEFAULT_EMOTION))
            fields.append(label.alias("emotion_label"))
        if errors:
            failed = reduce(or_, [sums[k].isNull() for k in kinds])
            fields.append(failed.alias("score_error"))
        return F.struct(*fields)

    defaults = []
    if "sentiment" in kinds:
        label, *means = DEFAULT_SENTIMENT
        defaults.append(F.lit(label).alias("sentiment_label"))
        defaults += [F.lit(m).cast("float").alias(x) for x, m in zip(SENTIMENTS, means)]
    if "emotion" in kinds:
        defaults.append(F.lit(DEFAULT_EMOTION).alias("emotion_label"))
    if errors:
        defaults.append(F.lit(False).alias("score_error"))
    # A NULL array folds to NULL, so the default is the NULL-text case.
    return F.coalesce(F.aggregate(scores, zero, add, finish), F.struct(*defaults))


def sentiment(text: str, scorer: Scorer, chunk_size: int = CHUNK_SIZE) -> Column:
    """Struct ``sentiment_label, negative, neutral, positive``."""
    return score_text(text, scorer, ("sentiment",), chunk_size)


def emotion(text: str, scorer: Scorer, chunk_size: int = CHUNK_SIZE) -> Column:
    """Struct ``emotion_label``."""
    return score_text(text, scorer, ("emotion",), chunk_size)


def _sentiment_fields(sums: Column, chunks: Column) -> list[Column]:
    default_label, *default_means = DEFAULT_SENTIMENT
    divisor = F.greatest(chunks, F.lit(1))
    means = F.transform(sums, lambda s: s / divisor)
    label = F.coalesce(first_highest(means, SENTIMENTS), F.lit(default_label))
    # Labels are decided in double precision; only the output is narrowed.
    return [label.alias("sentiment_label")] + [
        F.coalesce(sums[i] / divisor, F.lit(default)).cast("float").alias(name)
        for i, (name, default) in enumerate(zip(SENTIMENTS, default_means))
    ]


def first_highest(values: Column, labels: Sequence[str]) -> Column:
    """Label of the highest value in an array; the first one wins a tie. NULL for NULL."""
    names = F.split(F.lit(",".join(labels)), ",")
    return F.get(names, (F.array_position(values, F.array_max(values)) - 1).cast("int"))
