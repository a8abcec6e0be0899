"""A lexicon of words that occur in the given texts, and a small deterministic model."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial

from agorameter.functions.scoring import LABELS, LexiconScorer, ModelScorer, Predict

SENTIMENT = {
    "negative": ("the", "non", "nicht", "des", "los"),
    "positive": ("and", "that", "est", "und", "por"),
}
EMOTION = {
    "anger": ("of", "der"),
    "anticipation": ("to", "die"),
    "disgust": ("in", "la"),
    "fear": ("is", "le"),
    "joy": ("it", "de"),
    "love": ("for", "en"),
    "optimism": ("was", "que"),
    "pessimism": ("on", "un"),
    "sadness": ("with", "et"),
    "surprise": ("be", "zu"),
    "trust": ("by", "el"),
}
#: Letters whose frequency is the weight of a label in the stand-in model.
LETTERS = {"sentiment": "eai", "emotion": "abcdefghijk"}
#: The stand-in model refuses texts with this character.
REFUSED = "@"


def scorer() -> LexiconScorer:
    return LexiconScorer(SENTIMENT, EMOTION)


def _letter_model(kind: str) -> Predict:
    labels, letters = LABELS[kind], LETTERS[kind]

    def predict(chunks: Sequence[str]) -> list[Mapping[str, float]]:
        results = []
        for chunk in chunks:
            if REFUSED in chunk:
                raise ValueError("refused text")
            weights = [1.0 + chunk.count(x) for x in letters]
            total = sum(weights)
            results.append({label: w / total for label, w in zip(labels, weights)})
        return results

    return predict


def letter_scorer(batch_size: int = 64) -> ModelScorer:
    """A model behind the Arrow UDF, simple enough to be written in SQL too."""
    loaders: dict[str, Callable[[], Predict]] = {k: partial(_letter_model, k) for k in LABELS}
    return ModelScorer(loaders, batch_size)
