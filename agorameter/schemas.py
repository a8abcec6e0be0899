"""Record layouts and fixed vocabularies.

The values in this module are part of the data contract: producers, topics and
downstream tables agree on these names, orders and types.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "binary": T.BinaryType()}


def layout(fields: str, **more: T.DataType) -> T.StructType:
    """Nullable fields from ``"name type, name type"``, then those given by keyword."""
    pairs = [field.split() for field in fields.split(",")]
    simple = [T.StructField(name, _TYPES[kind]) for name, kind in pairs]
    return T.StructType(simple + [T.StructField(name, kind) for name, kind in more.items()])


# Label vocabularies. Order matters, ties go to the first label.
SENTIMENTS = ("negative", "neutral", "positive")
EMOTIONS = (
    "anger",
    "anticipation",
    "disgust",
    "fear",
    "joy",
    "love",
    "optimism",
    "pessimism",
    "sadness",
    "surprise",
    "trust",
)
REACTIONS = ("like", "love", "care", "haha", "wow", "angry", "sad")

# Envelope tags.
FACEBOOK = "facebook"
YOUTUBE = "youtube"
POSTS_SECTION = "Posts"
COMMENTS_SECTION = "Comments_with_candidate_column"

# Channel codes of the video files, and the watch address.
CHANNELS = ("ABC", "CBS", "FOX", "GMA", "NBC", "NYT", "TYT", "USA", "WPO", "WSJ")
WATCH_URL = "https://www.youtube.com/watch?v="

# Text handling and collection settings.
CHUNK_SIZE = 500
TILE_DAYS = 10
KEYWORDS = "Harris|Trump|Elections"
WRITE_RETRIES = 10
WRITE_RETRY_WAIT = "100ms"

# Message layouts. All fields are nullable.
POST_MESSAGE = layout(
    "uuid string, retrieving_time string, timestamp string, candidate string, content string, "
    "like int, love int, care int, haha int, wow int, angry int, sad int"
)
POST_COMMENT_MESSAGE = layout(
    "uuid string, account string, post_id string, retrieving_time string, timestamp string, "
    "content string, candidate string, "
    "like int, love int, care int, haha int, wow int, angry int, sad int"
)
VIDEO_MESSAGE = layout(
    "fullText string, url_video string, title string, views int, video_likes int, "
    "id_video string, channel string, channel_bias string, state string, "
    "video_timestamp string, comments int"
)
VIDEO_COMMENT_MESSAGE = layout(
    "url_video string, title string, views int, video_likes int, id_video string, "
    "channel string, channel_bias string, state string, video_timestamp string, "
    "comment_cid string, comment_published_at string, comment_author string, "
    "comment_text string, comment_votes int"
)

# File layouts.
RAW_VIDEO = layout(
    "channel string, channel_bias string, state string, url_video string, id_video string, "
    "title string, timestamp string, likes int, views int, fullText string, social string",
    comments=T.ArrayType(
        layout("cid string, published_at string, author string, text string, votes int")
    ),
)
FLAT_VIDEO = layout(
    "channel string, channel_bias string, state string, url_video string, id_video string, "
    "title string, video_timestamp string, fullText string, video_likes int, views int, "
    "comments int, social string"
)
FLAT_VIDEO_COMMENT = layout(
    "channel string, channel_bias string, state string, url_video string, id_video string, "
    "title string, video_timestamp string, video_likes int, views int, social string, "
    "comment_cid string, comment_published_at string, comment_author string, "
    "comment_text string, comment_votes int"
)

# Output layouts.
SENTIMENT_COLUMNS = ("sentiment_label", "negative", "neutral", "positive")
POST_COLUMNS = (
    "uuid", "retrieving_time", "timestamp", "candidate", "content",
    "like", "love", "care", "haha", "wow", "angry", "sad",
)
POST_COMMENT_COLUMNS = (
    "uuid", "post_id", "retrieving_time", "timestamp", "account", "content", "candidate",
    "like", "love", "care", "haha", "wow", "angry", "sad",
)
VIDEO_COLUMNS = (
    "timestamp", "channel", "channel_bias", "state", "title", "url_video", "id_video",
    "views", "video_likes", "comments",
)
VIDEO_COMMENT_COLUMNS = (
    "id_video", "timestamp", "channel", "channel_bias", "state", "url_video", "title",
    "video_likes", "views", "comment_id", "comment_published_at", "comment_author",
    "comment_text", "comment_votes",
)


@dataclass(frozen=True)
class Dataset:
    """One message kind: how it is read, which text is scored, and what comes out."""

    name: str
    message: T.StructType
    text: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    event_time: str
    renames: tuple[tuple[str, str], ...] = ()
    emotion: bool = True

    @property
    def output_columns(self) -> tuple[str, ...]:
        scores = SENTIMENT_COLUMNS + (("emotion_label",) if self.emotion else ())
        return self.columns + scores


POSTS = Dataset(
    name="fb_posts",
    message=POST_MESSAGE,
    text="content",
    columns=POST_COLUMNS,
    key=("uuid", "retrieving_time"),
    event_time="timestamp",
)
POST_COMMENTS = Dataset(
    name="fb_comments",
    message=POST_COMMENT_MESSAGE,
    text="content",
    columns=POST_COMMENT_COLUMNS,
    key=("uuid",),
    event_time="timestamp",
)
VIDEOS = Dataset(
    name="yt_videos",
    message=VIDEO_MESSAGE,
    text="fullText",
    columns=VIDEO_COLUMNS,
    key=("id_video",),
    event_time="timestamp",
    renames=(("video_timestamp", "timestamp"),),
    emotion=False,
)
VIDEO_COMMENTS = Dataset(
    name="yt_comments",
    message=VIDEO_COMMENT_MESSAGE,
    text="comment_text",
    columns=VIDEO_COMMENT_COLUMNS,
    key=("comment_id",),
    event_time="timestamp",
    renames=(("video_timestamp", "timestamp"), ("comment_cid", "comment_id")),
)
DATASETS = {d.name: d for d in (POSTS, POST_COMMENTS, VIDEOS, VIDEO_COMMENTS)}


def with_long_counts(schema: T.StructType) -> T.StructType:
    """The same layout with 64-bit counters, for counts beyond 2^31-1."""
    return T.StructType(
        [
            T.StructField(f.name, T.LongType(), f.nullable)
            if isinstance(f.dataType, T.IntegerType)
            else f
            for f in schema.fields
        ]
    )
