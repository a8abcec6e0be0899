"""A small English opinion lexicon, the default where no model is at hand."""

from __future__ import annotations

from agorameter.functions.scoring import LexiconScorer

SENTIMENT_WORDS = {
    "negative": (
        "awful", "bad", "corrupt", "crisis", "dangerous", "disaster", "fail", "fraud",
        "hate", "liar", "lies", "lose", "shame", "terrible", "weak", "worse", "worst", "wrong",
    ),
    "positive": (
        "amazing", "best", "better", "brave", "excellent", "fair", "good", "great",
        "honest", "hope", "love", "proud", "respect", "strong", "support", "thanks", "win",
        "wonderful",
    ),
}

EMOTION_WORDS = {
    "anger": ("angry", "furious", "hate", "outrage", "rage", "mad"),
    "anticipation": ("await", "expect", "soon", "tomorrow", "upcoming", "waiting"),
    "disgust": ("disgusting", "gross", "nasty", "pathetic", "sick", "vile"),
    "fear": ("afraid", "danger", "fear", "scared", "terrified", "threat"),
    "joy": ("celebrate", "enjoy", "fun", "glad", "happy", "joy"),
    "love": ("adore", "beloved", "darling", "heart", "love", "loving"),
    "optimism": ("bright", "confident", "future", "hope", "hopeful", "improve"),
    "pessimism": ("doomed", "gloomy", "hopeless", "never", "pointless", "worse"),
    "sadness": ("cry", "grief", "lonely", "miss", "sad", "sorry"),
    "surprise": ("shocked", "sudden", "surprise", "unbelievable", "unexpected", "wow"),
    "trust": ("believe", "faith", "honest", "loyal", "reliable", "trust"),
}


def default_scorer() -> LexiconScorer:
    return LexiconScorer(SENTIMENT_WORDS, EMOTION_WORDS)
