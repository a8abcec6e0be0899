from __future__ import annotations

import re
from functools import partial

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from agorameter.functions import scoring
from agorameter.functions.lexicon import default_scorer
from agorameter.functions.scoring import LexiconScorer, ModelScorer, score_text
from agorameter.functions.text import expand_once
from agorameter.schemas import EMOTIONS, SENTIMENTS
from tests.conftest import plan_of

LEXICON = LexiconScorer(
    {"negative": ["bad", "it's"], "positive": ["good"]}, {"joy": ["good"], "fear": ["bad"]}
)


def scored(df, scorer, **options):
    rows = df.select("id", expand_once(score_text("text", scorer, **options))).orderBy("id")
    return rows.collect()


def by_hand(text, size=500):
    """Sentiment of the lexicon above, chunk by chunk."""
    if text is None:
        return ("neutral", 0.0, 1.0, 0.0)
    chunks = [text[i : i + size] for i in range(0, len(text), size)]
    sums = [0.0, 0.0, 0.0]
    for chunk in chunks:
        words = re.findall(r"[^\W\d_]+", chunk.lower())
        weights = [1.0 + words.count("bad"), 2.0, 1.0 + words.count("good")]
        sums = [s + w / sum(weights) for s, w in zip(sums, weights)]
    means = [s / max(len(chunks), 1) for s in sums]
    return (SENTIMENTS[means.index(max(means))], *means)


def test_lexicon_against_brute_force(texts):
    values = [
        None, "", "plain", "BAD bad good", "good, good! good", "bad " * 200 + "good " * 300,
        "goodness badly", "good" * 200, "é bad\ngood\tbad 😀 good",
    ]
    for row, value in zip(scored(texts(values), LEXICON), values):
        label, *means = by_hand(value)
        assert row.sentiment_label == label, value
        assert [row.negative, row.neutral, row.positive] == pytest.approx(means, abs=1e-6)


def test_missing_and_empty_text(texts):
    missing, empty = scored(texts([None, ""]), LEXICON)
    assert tuple(missing)[1:] == ("neutral", 0.0, 1.0, 0.0, "null")
    assert tuple(empty)[1:] == ("negative", 0.0, 0.0, 0.0, "anger")


def test_ties_go_to_the_first_label(texts):
    # Two hits each: negative 3, neutral 2, positive 3.
    row = scored(texts(["bad bad good good"]), LEXICON)[0]
    assert row.sentiment_label == "negative"
    assert row.emotion_label == "fear"
    assert scored(texts(["nothing here"]), LEXICON)[0].emotion_label == "anger"


def test_every_chunk_counts_the_same(texts):
    value = "x" * 499 + " " + "good"
    row = scored(texts([value]), LEXICON)[0]
    assert row.positive == pytest.approx((1 / 4 + 2 / 5) / 2)


def test_output_types(texts):
    df = texts(["good"]).select(scoring.sentiment("text", LEXICON).alias("s"))
    assert df.schema["s"].dataType.simpleString() == (
        "struct<sentiment_label:string,negative:float,neutral:float,positive:float>"
    )
    df = texts(["good"]).select(scoring.emotion("text", LEXICON).alias("s"))
    assert df.schema["s"].dataType.simpleString() == "struct<emotion_label:string>"


def test_words_with_quotes_and_backslashes(texts):
    odd = LexiconScorer({"negative": ["it's", "a\\b"], "positive": []})
    row = texts(["it's"]).select(expand_once(scoring.sentiment("text", odd))).first()
    assert row.sentiment_label == "neutral"


def test_lexicon_rejects_unknown_labels():
    with pytest.raises(ValueError):
        LexiconScorer({"happy": ["x"]})
    with pytest.raises(ValueError):
        LexiconScorer({"neutral": ["x"]})


def test_lexicon_words_in_any_case(texts):
    upper = LexiconScorer({"positive": ["GOOD"]})
    row = texts(["Good"]).select(expand_once(scoring.sentiment("text", upper))).first()
    # Weights 1, 2, 2.
    assert row.positive == pytest.approx(0.4)


def test_unknown_kinds():
    with pytest.raises(ValueError):
        score_text("text", LEXICON, kinds=("mood",))


def test_default_lexicon(texts):
    values = ["What a terrible, shameful disaster. Wrong!", "great and honest"]
    rows = scored(texts(values), default_scorer())
    assert [r.sentiment_label for r in rows] == ["negative", "positive"]


def test_means_add_up(texts):
    for row in scored(texts(["good bad " * 400, "x"]), LEXICON):
        assert row.negative + row.neutral + row.positive == pytest.approx(1.0, abs=1e-5)


# --- model ----------------------------------------------------------------------------------


def _model(kind, chunks):
    labels = SENTIMENTS if kind == "sentiment" else EMOTIONS
    results = []
    for chunk in chunks:
        if "boom" in chunk or (kind == "emotion" and "numb" in chunk):
            raise RuntimeError("model failure")
        if "odd" in chunk:
            results.append({"confused": 1.0})
        elif "partial" in chunk:
            results.append({labels[-1]: 0.7})
        else:
            results.append({x: (i + 1.0) / 10 for i, x in enumerate(labels)})
    return results


def load(kind):
    return partial(_model, kind)


def model(batch_size=64):
    return ModelScorer({k: partial(load, k) for k in ("sentiment", "emotion")}, batch_size)


@pytest.mark.parametrize("batch_size", [1, 2, 64])
def test_model_failures_stay_in_their_row(texts, batch_size):
    values = ["fine", "boom", None, "", "numb", "odd", "partial", "y" * 600 + "boom", "fine too"]
    rows = scored(texts(values).coalesce(1), model(batch_size), errors=True)
    assert [(r.sentiment_label, r.emotion_label, r.score_error) for r in rows] == [
        ("positive", "trust", False),
        ("neutral", "null", True),
        ("neutral", "null", False),
        ("negative", "anger", False),
        ("positive", "null", True),
        ("neutral", "null", True),
        ("positive", "trust", False),
        ("neutral", "null", True),
        ("positive", "trust", False),
    ]
    assert (rows[1].negative, rows[1].neutral, rows[1].positive) == (0.0, 1.0, 0.0)
    assert (rows[6].negative, rows[6].positive) == (0.0, pytest.approx(0.7))


def test_model_holds_few_chunks_at_a_time():
    """A batch is scored in slices of rows, which together are the batch."""
    lists = pa.array([["a"] * 3000, None, [], ["b"] * 2000, ["c"], ["d"] * 9000, None, ["x"]])
    for whole in (lists, lists.slice(3), lists.slice(0, 0)):
        parts = list(scoring._parts(whole))
        assert pa.concat_arrays(parts).equals(whole)
        assert all(len(p.flatten()) - len(p[-1].as_py() or ()) < scoring.HELD_CHUNKS for p in parts if len(p))
    assert len(list(scoring._parts(lists))) == 3


def test_model_means(texts):
    row = scored(texts(["z" * 1200]), model())[0]
    assert [row.negative, row.neutral, row.positive] == pytest.approx([0.1, 0.2, 0.3])


def test_model_runs_once_per_row_even_behind_a_filter(texts):
    df = texts(["fine", "boom"]).select("id", expand_once(score_text("text", model())))
    kept = df.filter("sentiment_label = 'positive' AND negative < 0.5")
    assert plan_of(kept).count("ArrowEvalPython") == 1
    assert [r.id for r in kept.collect()] == [0]


def test_lexicon_runs_once_behind_a_filter(texts):
    df = texts(["good"]).select("id", expand_once(score_text("text", LEXICON)))
    plan = plan_of(df.filter("sentiment_label = 'positive' OR emotion_label = 'joy'"))
    assert plan.count("regexp_extract_all(text") == 1
    assert "EvalPython" not in plan and "Exchange" not in plan


def test_model_needs_a_loader_for_every_kind():
    with pytest.raises(ValueError):
        ModelScorer({"mood": load})
    with pytest.raises(ValueError):
        ModelScorer({"sentiment": load}, batch_size=0)
    with pytest.raises(ValueError):
        ModelScorer({"sentiment": load}).chunk_scores("chunks", ["emotion"])


def test_sql_expression_as_text(spark):
    df = spark.sql("SELECT 'good' AS title, 'good good' AS body")
    score = scoring.sentiment("concat_ws(' ', title, body)", LEXICON)
    assert df.select(expand_once(score)).first().positive == pytest.approx(4 / 7)


def test_first_highest(spark):
    row = spark.range(1).select(
        scoring.first_highest(F.array(F.lit(0.2), F.lit(0.4), F.lit(0.4)), SENTIMENTS),
        scoring.first_highest(F.lit(None).cast("array<double>"), SENTIMENTS),
    )
    assert tuple(row.first()) == ("neutral", None)
