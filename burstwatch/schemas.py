"""Explicit schemas of every table the library reads or writes (never inferred)."""

from pyspark.sql import types as T

# One landed page of comment threads, as the comment API returns it.
_AUTHOR = T.StructType([T.StructField("value", T.StringType())])
_INNER_SNIPPET = T.StructType([
    T.StructField("authorChannelId", _AUTHOR),
    T.StructField("textOriginal", T.StringType()),
    T.StructField("publishedAt", T.StringType()),
])
_ITEM = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("snippet", T.StructType([
        T.StructField("topLevelComment", T.StructType([
            T.StructField("snippet", _INNER_SNIPPET),
        ])),
    ])),
])
COMMENT_PAGE = T.StructType([
    T.StructField("nextPageToken", T.StringType()),
    T.StructField("items", T.ArrayType(_ITEM)),
])

COMMENTS = T.StructType([
    T.StructField("comment_id", T.StringType(), False),
    T.StructField("video_id", T.StringType(), False),
    T.StructField("author_id", T.StringType(), True),
    T.StructField("text", T.StringType(), False),
    T.StructField("sentiment", T.DoubleType(), False),
    T.StructField("published_at", T.TimestampType(), False),
    T.StructField("fetched_at", T.TimestampType(), False),
])

MEASURES = ["total_comments", "unique_authors", "avg_length", "avg_sentiment",
            "sentiment_variance", "avg_gap", "gap_variance"]

WINDOW_METRICS = T.StructType([
    T.StructField("video_id", T.StringType(), False),
    T.StructField("window_start", T.TimestampType(), False),
    T.StructField("total_comments", T.LongType(), False),
    T.StructField("unique_authors", T.LongType(), False),
    T.StructField("avg_length", T.DoubleType(), False),
    T.StructField("avg_sentiment", T.DoubleType(), False),
    T.StructField("sentiment_variance", T.DoubleType(), False),
    T.StructField("avg_gap", T.DoubleType(), False),
    T.StructField("gap_variance", T.DoubleType(), False),
    T.StructField("coordination_score", T.DoubleType(), True),
])

Z_COLUMNS = ["count_z", "author_z", "length_z", "sentiment_z",
             "concentration_z", "sentiment_var_z", "gap_z", "gap_var_z"]

ALERTS = T.StructType([
    T.StructField("video_id", T.StringType(), False),
    T.StructField("window_start", T.TimestampType(), False),
    T.StructField("pattern", T.StringType(), False),
    T.StructField("coordination_score", T.DoubleType(), True),
    *[T.StructField(z, T.DoubleType(), True) for z in Z_COLUMNS],
    T.StructField("similarity", T.DoubleType(), True),
    T.StructField("keywords", T.ArrayType(T.StringType()), True),
    T.StructField("evidence_kind", T.StringType(), True),
])

# Items and pages that cannot become comments, with the reason and the raw time
# (or the raw page).
QUARANTINE = T.StructType([T.StructField(c, T.StringType()) for c in (
    "video_id", "comment_id", "author_id", "text", "published_raw", "reason")])
