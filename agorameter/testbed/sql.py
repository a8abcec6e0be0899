"""SQL text of the stand-in inputs and of the scoring, for the SQL twins of the queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from agorameter.schemas import EMOTIONS, SENTIMENTS
from agorameter.testbed.inputs import COUNTERS
from agorameter.testbed.wordlists import EMOTION, LETTERS, REFUSED, SENTIMENT

ISO = "%Y-%m-%dT%H:%M:%S"
START = "TIMESTAMP '2024-09-01'"


def seconds_after(base: str, seconds: str) -> str:
    return f"({base} + to_seconds({seconds}))"


def iso(moment: str) -> str:
    return f"strftime({moment}, '{ISO}')"


def _reactions(size: str) -> str:
    return ", ".join(f'CAST({size} % {d} AS INTEGER) AS "{name}"' for name, d in COUNTERS.items())


POST_TIME = seconds_after(START, "(doc_id * 86399) % 12096000")
COMMENT_TIME = seconds_after(START, "conv_id * 3600 + turn * 60")
VIDEO_SECONDS = "(doc_id * 7001) % 12096000"

POSTS = f"""
SELECT 'doc-' || doc_id AS uuid,
       {iso(seconds_after(START, "14000000 + doc_id % 86400"))} AS retrieving_time,
       {iso(POST_TIME)} AS timestamp, source AS candidate, text AS content,
       {_reactions("n_chars")}
FROM documents"""

POST_COMMENTS = f"""
SELECT conv_id || '-' || turn AS uuid, 'doc-' || (conv_id * 15) AS post_id,
       CAST(NULL AS VARCHAR) AS retrieving_time, {iso(COMMENT_TIME)} AS timestamp,
       role AS account, text AS content, 'src' || (conv_id % 20) AS candidate,
       {_reactions("length(text)")}
FROM conversations"""

CHANNELS = """
SELECT n_name AS channel, r_name AS channel_bias, 'S' || n_nationkey AS state
FROM nation JOIN region ON n_regionkey = r_regionkey"""

VIDEOS = f"""
SELECT {iso(seconds_after(START, VIDEO_SECONDS))} AS timestamp, channel, channel_bias, state,
       string_split(text, chr(10))[1] AS title,
       'https://www.youtube.com/watch?v=' || doc_id AS url_video,
       CAST(doc_id AS VARCHAR) AS id_video,
       CAST(n_chars * 37 % 1000000 AS INTEGER) AS views,
       CAST(n_chars % 1000 AS INTEGER) AS video_likes,
       CAST(len(string_split(text, chr(10))) - 1 AS INTEGER) AS comments,
       text AS fullText
FROM documents LEFT JOIN ({CHANNELS}) ON channel = 'NATION_' || (doc_id % 25)"""

VIDEO_COMMENTS = f"""
SELECT id_video, timestamp, channel, channel_bias, state, url_video, title, video_likes, views,
       doc_id || '-' || n AS comment_id,
       {iso(seconds_after(START, VIDEO_SECONDS + " + n * 60"))} AS comment_published_at,
       source AS comment_author, line AS comment_text,
       CAST(length(line) % 50 AS INTEGER) AS comment_votes
FROM ({VIDEOS}) v
JOIN (SELECT doc_id, source, unnest(string_split(text, chr(10))[2:]) AS line,
             unnest(range(1, len(string_split(text, chr(10))))) AS n FROM documents) l
  ON v.id_video = CAST(l.doc_id AS VARCHAR)"""

EVENT_TAGS = """
SELECT event_id, ts, value,
       CASE WHEN event_type IN ('click', 'error', 'purchase') THEN 'facebook'
            WHEN event_type = 'signup' THEN 'youtube' WHEN value >= 20 THEN 'youtube'
            WHEN value >= 10 THEN 'elsewhere' END AS social,
       CASE event_type WHEN 'click' THEN 'Posts'
            WHEN 'error' THEN 'Comments_with_candidate_column'
            WHEN 'purchase' THEN 'Stories' END AS section,
       CASE WHEN event_type = 'signup' THEN props END AS fullText
FROM events"""

EVENT_ROUTES = f"""
SELECT *, CASE WHEN social = 'facebook' AND section = 'Posts' THEN 'fb_posts'
               WHEN social = 'facebook' AND section = 'Comments_with_candidate_column'
                 THEN 'fb_comments'
               WHEN social = 'youtube' AND fullText IS NULL THEN 'yt_comments'
               WHEN social = 'youtube' THEN 'yt_videos' END AS topic
FROM ({EVENT_TAGS})"""

ROUTE_COUNTS = f"""
SELECT topic, count(*) AS records FROM ({EVENT_ROUTES}) WHERE topic IS NOT NULL GROUP BY topic"""


def chunks(source: str, key: str, text: str) -> str:
    """Rows ``key, i, chunk``: 500 code points each."""
    return f"""
SELECT {key}, CAST(i AS INTEGER) AS i, substring({text}, i * 500 + 1, 500) AS chunk
FROM (SELECT {key}, {text},
             unnest(range(CAST(ceil(length({text}) / 500.0) AS BIGINT))) AS i
      FROM ({source}))"""


def _share(label: str, labels: Sequence[str]) -> str:
    return f"w_{label} / ({' + '.join('w_' + x for x in labels)})"


def _lexicon_weight(words: Sequence[str]) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"CAST(1 + len(list_filter(words, lambda w: w IN ({listed}))) AS DOUBLE)"


def _weights(lexicon: bool, kind: str, labels: Sequence[str]) -> dict[str, str]:
    if not lexicon:
        return {
            x: f"CAST(1 + length(chunk) - length(replace(chunk, '{c}', '')) AS DOUBLE)"
            for x, c in zip(labels, LETTERS[kind])
        }
    words: Mapping[str, Sequence[str]] = SENTIMENT if kind == "sentiment" else EMOTION
    return {
        x: "CAST(2 AS DOUBLE)" if x == "neutral" else _lexicon_weight(words[x]) for x in labels
    }


def chunk_probabilities(
    source: str, key: str, text: str, kind: str, lexicon: bool = True
) -> str:
    """Rows ``key, i`` and one ``p_<label>`` per label."""
    labels = SENTIMENTS if kind == "sentiment" else EMOTIONS
    weights = ", ".join(f"{w} AS w_{x}" for x, w in _weights(lexicon, kind, labels).items())
    shares = ", ".join(f"{_share(x, labels)} AS p_{x}" for x in labels)
    return f"""
SELECT {key}, i, {shares} FROM (
  SELECT {key}, i, {weights} FROM (
    SELECT {key}, i, chunk, regexp_split_to_array(lower(chunk), '[^\\p{{L}}]+') AS words
    FROM ({chunks(source, key, text)})))"""


def _first_highest(labels: Sequence[str]) -> str:
    best = f"greatest({', '.join('s_' + x for x in labels)})"
    cases = " ".join(f"WHEN s_{x} = {best} THEN '{x}'" for x in labels)
    return f"CASE {cases} END"


def sentiment(source: str, key: str, text: str, lexicon: bool = True) -> str:
    """Rows ``key, sentiment_label, negative, neutral, positive`` for every row of source.

    Without ``lexicon`` the letter model scores, which refuses texts with a certain sign.
    """
    sums = ", ".join(f"sum(p_{x} ORDER BY i) / count(*) AS s_{x}" for x in SENTIMENTS)
    failed = f"t IS NULL{'' if lexicon else f' OR contains(t, {REFUSED!r})'}"
    means = ", ".join(
        f"CAST(CAST(CASE WHEN failed THEN {d} ELSE s_{x} END AS FLOAT) AS DOUBLE) AS {x}"
        for x, d in zip(SENTIMENTS, (0, 1, 0))
    )
    zeros = ", ".join(f"coalesce(s_{x}, 0) AS s_{x}" for x in SENTIMENTS)
    return f"""
SELECT {key}, CASE WHEN failed THEN 'neutral' ELSE {_first_highest(SENTIMENTS)} END
         AS sentiment_label, {means}
FROM (SELECT b.{key}, {failed} AS failed, {zeros}
      FROM (SELECT {key}, {text} AS t FROM ({source})) b
      LEFT JOIN (SELECT {key}, {sums}
                 FROM ({chunk_probabilities(source, key, text, "sentiment", lexicon)})
                 GROUP BY {key}) s ON b.{key} = s.{key})"""


def emotion(source: str, key: str, text: str, lexicon: bool = True) -> str:
    """Rows ``key, emotion_label`` for every row of source."""
    sums = ", ".join(f"sum(p_{x} ORDER BY i) AS s_{x}" for x in EMOTIONS)
    failed = f"t IS NULL{'' if lexicon else f' OR contains(t, {REFUSED!r})'}"
    zeros = ", ".join(f"coalesce(s_{x}, 0) AS s_{x}" for x in EMOTIONS)
    return f"""
SELECT {key}, CASE WHEN failed THEN 'null' ELSE {_first_highest(EMOTIONS)} END AS emotion_label
FROM (SELECT b.{key}, {failed} AS failed, {zeros}
      FROM (SELECT {key}, {text} AS t FROM ({source})) b
      LEFT JOIN (SELECT {key}, {sums}
                 FROM ({chunk_probabilities(source, key, text, "emotion", lexicon)})
                 GROUP BY {key}) s ON b.{key} = s.{key})"""


def rounded(source: str) -> str:
    """The rows of source with the means in six decimals."""
    means = ", ".join(f"round({x}, 6) AS {x}" for x in SENTIMENTS)
    return f"SELECT * REPLACE ({means}) FROM ({source})"


def enriched(
    source: str, key: str, text: str, with_emotion: bool = True, lexicon: bool = True
) -> str:
    """All columns of source with the scores; ``key`` has to be unique."""
    scores = sentiment(source, key, text, lexicon)
    result = f"SELECT * FROM ({source}) JOIN ({scores}) USING ({key})"
    if with_emotion:
        result += f" JOIN ({emotion(source, key, text, lexicon)}) USING ({key})"
    return result


ENRICHED_POSTS = enriched(POSTS, "uuid", "content")
ENRICHED_POST_COMMENTS = enriched(POST_COMMENTS, "uuid", "content")
ENRICHED_VIDEOS = (
    f"SELECT * EXCLUDE (fullText) FROM ({enriched(VIDEOS, 'id_video', 'fullText', False)})"
)
ENRICHED_VIDEO_COMMENTS = enriched(VIDEO_COMMENTS, "comment_id", "comment_text")
