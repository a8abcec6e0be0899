"""Loaders for pre-trained tweet classifiers, for use with ``ModelScorer``.

The model library is optional. It is imported in the Python worker when the first
batch arrives. A missing library fails the job: defaults would hide it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from agorameter.functions.scoring import ModelScorer, Predict


def tweet_classifier(task: str) -> Callable[[], Predict]:
    """Loader of the public ``tweetnlp`` classifier for ``sentiment`` or ``emotion``."""

    def load() -> Predict:
        try:
            import tweetnlp
        except ImportError as error:
            raise ImportError("install tweetnlp on the executors to use its models") from error
        model = tweetnlp.load_model(task)

        def predict(chunks: Sequence[str]) -> list[Mapping[str, float]]:
            results = model.predict(list(chunks), return_probability=True, batch_size=len(chunks))
            return [r["probability"] for r in results]

        return predict

    return load


def tweet_scorer(batch_size: int = 64) -> ModelScorer:
    loaders = {kind: tweet_classifier(kind) for kind in ("sentiment", "emotion")}
    return ModelScorer(loaders, batch_size)
