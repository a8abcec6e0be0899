"""Time the enrichment of posts against plain row-at-a-time Python functions.

usage: python tools/row_udf.py [folder]

The plain way has one ``udf`` for sentiment and one for emotion, both called per row and
both cutting the text again. Both ways read the same messages and use the same lexicon.
"""

from __future__ import annotations

import json
import re
import sys
import time
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from agorameter.operators.messages import parse_messages  # noqa: E402
from agorameter.plans.enrich import enrich_posts  # noqa: E402
from agorameter.schemas import EMOTIONS, POSTS, SENTIMENTS  # noqa: E402
from agorameter.session import build_session  # noqa: E402
from agorameter.testbed import inputs  # noqa: E402
from agorameter.testbed.registry import shipped  # noqa: E402
from agorameter.testbed.wordlists import EMOTION, SENTIMENT, letter_scorer, scorer  # noqa: E402

WORD = re.compile(r"[^\W\d_]+")


def sums(text, words, labels, fixed):
    totals = dict.fromkeys(labels, 0.0)
    for piece in re.findall(r"(?s).{1,500}", text):
        found = WORD.findall(piece.lower())
        weights = {
            x: fixed.get(x) or 1.0 + sum(w in words[x] for w in found) for x in labels
        }
        whole = sum(weights.values())
        for label, weight in weights.items():
            totals[label] += weight / whole
    return totals


def sentiment(text):
    totals = sums(text, SENTIMENT, SENTIMENTS, {"neutral": 2.0})
    n = max(1, -(-len(text) // 500))
    return max(totals, key=totals.get), *[totals[x] / n for x in SENTIMENTS]


def emotion(text):
    totals = sums(text, EMOTION, EMOTIONS, {})
    return max(totals, key=totals.get)


def row_wise(messages):
    schema = "sentiment_label string, negative float, neutral float, positive float"
    parsed = parse_messages(messages, POSTS.message)
    return parsed.select(
        *POSTS.columns,
        F.udf(sentiment, schema)("content").alias("s"),
        F.udf(emotion, "string")("content").alias("emotion_label"),
    ).select(*POSTS.columns, "s.*", "emotion_label")


def best_time(make, runs=4):
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(min(times[1:]), 3)


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(
        "row udf",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    shipped(spark)
    ours = enrich_posts(inputs.post_messages(spark, folder), scorer())
    plain = row_wise(inputs.post_messages(spark, folder))
    same = ours.select("uuid", "sentiment_label", "emotion_label").exceptAll(
        plain.select("uuid", "sentiment_label", "emotion_label")
    )
    print(
        json.dumps(
            {
                "rows": ours.count(),
                "label differences": same.count(),
                "expressions": best_time(
                    lambda: enrich_posts(inputs.post_messages(spark, folder), scorer())
                ),
                "arrow model": best_time(
                    lambda: enrich_posts(inputs.post_messages(spark, folder), letter_scorer())
                ),
                "row-at-a-time functions": best_time(
                    lambda: row_wise(inputs.post_messages(spark, folder))
                ),
                "messages only": best_time(
                    lambda: parse_messages(inputs.post_messages(spark, folder), POSTS.message)
                ),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
