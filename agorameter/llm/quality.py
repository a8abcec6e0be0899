"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text becomes a fixed vector of transformed statistics. The sums that give the class means
and covariances are taken over all labelled rows by one aggregation. The covariances are shrunk
towards a multiple of the identity, factored once, and every text is scored by the difference
of its two log densities.

Nulls and edge cases: a null text counts as empty, an empty text has statistics like any other;
rows without a label are scored only; a class without rows leaves the share of the other as
the score (0.5 without any label); repeated ids and labels count as often as they occur.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorameter.llm.common import prepare

#: Classes of bytes: 0 other, 1 lower, 2 upper, 3 digit, 4 white space, 5 common punctuation,
#: 6 symbol, 7 non-ASCII.
CLASSES = np.zeros(256, dtype=np.int64)
CLASSES[list(range(97, 123))] = 1
CLASSES[list(range(65, 91))] = 2
CLASSES[list(range(48, 58))] = 3
CLASSES[[9, 10, 11, 12, 13, 32]] = 4
CLASSES[list(b".,;:'\"!?-()")] = 5
SYMBOLS = frozenset(b"#$%&*+/<=>@[\\]^_`{|}~")
CLASSES[list(SYMBOLS)] = 6
CLASSES[128:] = 7

STATISTICS = (
    "words",
    "word_length",
    "upper",
    "digits",
    "punctuation",
    "symbols",
    "non_ascii",
    "symbol_words",
    "repeated_words",
    "top_word",
    "repeated_lines",
    "line_words",
    "short_words",
    "exclamations",
    "byte_entropy",
    "capital_starts",
)


def _odds(part: float, whole: float) -> float:
    """A share on the logit scale, finite at 0 and 1."""
    share = (part + 0.5) / (whole + 1)
    return math.log(share / (1 - share))


def statistics(text: str | None) -> list[float]:
    """The vector of a text, in the order of STATISTICS: logs of sizes and logits of shares."""
    data = (text or "").encode("utf-8", "surrogatepass")
    by_byte = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    kinds = np.bincount(CLASSES, weights=by_byte, minlength=8)
    size = max(1, len(data))
    words = data.split()
    seen: dict[bytes, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    n = len(words)
    lines = [line for line in data.split(b"\n") if line]
    shares = by_byte[by_byte > 0] / size
    letters = kinds[1] + kinds[2] + kinds[7]
    return [
        math.log1p(n),
        math.log1p(letters / max(1, n)),
        _odds(kinds[2], letters),
        _odds(kinds[3], size),
        _odds(kinds[5], size),
        _odds(kinds[6], size),
        _odds(kinds[7], size),
        _odds(sum(c for w, c in seen.items() if w[-1] in SYMBOLS), n),
        _odds(n - len(seen), n),
        _odds(max(seen.values(), default=0), n),
        _odds(len(lines) - len(set(lines)), len(lines)),
        math.log1p(n / max(1, len(lines))),
        _odds(sum(c for w, c in seen.items() if len(w) <= 3), n),
        _odds(by_byte[33], size),
        float(-(shares * np.log(shares)).sum()),
        _odds(sum(c for w, c in seen.items() if 65 <= w[0] <= 90), n),
    ]


def with_statistics(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row ``(key, x)`` per row, ``x`` the vector of its text."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [statistics(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(vectors, pa.list_(pa.float64()))], names=("key", "x")
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, x array<double>")


@dataclass
class Model:
    """Means, Cholesky factors and log priors of the two classes, on standardised statistics."""

    center: np.ndarray
    scale: np.ndarray
    means: dict[int, np.ndarray]
    factors: dict[int, np.ndarray]
    priors: dict[int, float]
    power: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of ``x``."""
        if len(self.priors) < 2:
            return np.full(len(x), {0: 0.0, 1: 1.0}[next(iter(self.priors))] if self.priors else 0.5)
        z = (x - self.center) / self.scale
        log = {}
        for c, factor in self.factors.items():
            # The factor is lower triangular; solving it gives the Mahalanobis distance.
            distance = (np.linalg.solve(factor, (z - self.means[c]).T) ** 2).sum(axis=0)
            log[c] = -0.5 * distance - np.log(np.diag(factor)).sum()
        odds = self.power * (log[1] - log[0]) + self.priors[1] - self.priors[0]
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit(labelled: DataFrame, shrinkage: float = 0.05, power: float = 0.25) -> Model:
    """Learn from rows ``(x, label)`` with label 0 or 1, all of them.

    The covariance of a class is ``(1 - shrinkage) S + shrinkage tr(S)/d I``. ``power`` tempers
    the density ratio, as the statistics of a text are not a Gaussian and so over-confident.
    """
    d = len(STATISTICS)
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    x = [F.col("x")[i] for i in range(d)]
    rows = (
        labelled.where(F.col("label").isin(0, 1))
        .groupBy("label")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*(F.sum(v) for v in x)).alias("sums"),
            F.array(*(F.sum(x[i] * x[j]) for i, j in pairs)).alias("products"),
        )
        .collect()
    )
    count = {r["label"]: r["n"] for r in rows}
    sums = {r["label"]: np.array(r["sums"]) for r in rows}
    products = {}
    for r in rows:
        full = np.zeros((d, d))
        for (i, j), value in zip(pairs, r["products"], strict=True):
            full[i, j] = full[j, i] = value
        products[r["label"]] = full
    total = max(1, sum(count.values()))
    center = sum(sums.values(), np.zeros(d)) / total
    spread = np.diag(sum(products.values(), np.zeros((d, d)))) / total - center**2
    scale = np.sqrt(np.maximum(spread, 1e-6))
    means, factors = {}, {}
    for c, n in count.items():
        mean = sums[c] / n
        covariance = (products[c] / n - np.outer(mean, mean)) / np.outer(scale, scale)
        target = max(np.trace(covariance) / d, 1e-3) * np.eye(d)
        factors[c] = np.linalg.cholesky((1 - shrinkage) * covariance + shrinkage * target)
        means[c] = (mean - center) / scale
    priors = {c: math.log(n / total) for c, n in count.items()}
    return Model(center, scale, means, factors, priors, power)


def predict(vectors: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of :func:`with_statistics` with ``score`` and ``predicted`` instead of ``x``."""
    names = [c for c in vectors.columns if c != "x"]
    schema = vectors.select(*names).schema.add("score", "double").add("predicted", "integer")
    d = len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
            scores = model.score(x.reshape(batch.num_rows, d))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(scores),
                    pa.array((scores >= threshold).astype(np.int32)),
                ],
                names=[*names, "score", "predicted"],
            )

    return vectors.select(*names, "x").mapInArrow(run, schema)
