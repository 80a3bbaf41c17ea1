"""Per-window measures of a comment stream.

Plan (scale notes): comments are never gathered per video. One partial
aggregation combines them to a row per (video, window, second, author); its one
exchange feeds both branches, authors (counted as rows) and seconds, so the
comments are scanned and shuffled once. Gaps need an order: the seconds are
ordered inside (video, window), at most ``window_seconds`` rows per group
whatever the data volume. The gap that crosses a window edge is added on the
small window table, ordered per video.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burstwatch.functions.timefn import window_label
from burstwatch.params import DEFAULT, Params

_VIDEO_SCOPE = "video"
_WINDOW_SCOPE = "window"


def _timed(comments: DataFrame, window_seconds: int) -> DataFrame:
    sec = F.unix_seconds(F.col("published_at"))
    return comments.select(
        "video_id", "author_id", "comment_id", "sentiment",
        F.length(F.col("text")).alias("text_len"),
        sec.alias("_sec"),
    ).withColumn("_w", window_label(F.col("_sec"), window_seconds))


def combined(timed: DataFrame) -> DataFrame:
    """Counts and sums per (video, window, second, author)."""
    return timed.groupBy("video_id", "_w", "_sec", "author_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count("text_len").alias("_n_len"), F.sum("text_len").alias("_len"),
        F.count("sentiment").alias("_n_s"), F.sum("sentiment").alias("_s"),
        F.sum(F.col("sentiment") * F.col("sentiment")).alias("_s2"))


SUMS = ("_n", "_n_len", "_len", "_n_s", "_s", "_s2")


def _author_counts(combined: DataFrame) -> DataFrame:
    # the condition holds for every row; it reads all columns, so that this
    # branch and the seconds share one aggregation and its exchange
    any_row = F.when(F.xxhash64(*SUMS) >= F.lit(-(1 << 63)), 1)
    each = combined.groupBy("video_id", "_w", "author_id").agg(F.count(any_row).alias("_rows"))
    return each.groupBy("video_id", "_w").agg(
        F.count(F.when(F.col("_rows") > 0, F.col("author_id"))).alias("unique_authors"))


def _sums(combined: DataFrame, part_seconds: int | None = None) -> DataFrame:
    """Per (video, window): counts and sums, first and last second, and the sums
    of gaps between consecutive distinct seconds (equal seconds add a zero gap).

    With ``part_seconds`` the seconds of a long window are put in order part by part, and
    the gaps between parts follow from the parts' first and last seconds."""
    per_sec = combined.groupBy("video_id", "_w", "_sec").agg(*[F.sum(c).alias(c) for c in SUMS])
    d = F.col("_d")
    if part_seconds is not None:
        parts = parts_of(per_sec.withColumn("_part", F.floor(F.col("_sec") / part_seconds)), ["video_id", "_w", "_part"])
        return sums_of_parts(parts)
    ws = Window.partitionBy("video_id", "_w").orderBy("_sec")
    return per_sec.withColumn("_d", F.col("_sec") - F.lag("_sec").over(ws)).groupBy("video_id", "_w").agg(
        F.sum("_n").alias("total_comments"),
        (F.sum("_len") / F.sum("_n_len")).alias("_avg_len"),
        (F.sum("_s") / F.sum("_n_s")).alias("_avg_sent"),
        (F.sum("_s2") / F.sum("_n_s")).alias("_avg_sent_sq"),
        F.min("_sec").alias("_first"),
        F.max("_sec").alias("_last"),
        F.coalesce(F.sum("_d"), F.lit(0)).alias("_sg"),
        F.coalesce(F.sum(d * d), F.lit(0)).alias("_sg2"),
    )


def parts_of(per_sec: DataFrame, keys: list[str]) -> DataFrame:
    """Per part (``keys``): sums, first and last second (_a, _b), the sums of the gaps
    between its seconds and of their squares (_g, _g2)."""
    d, ws = F.col("_d"), Window.partitionBy(*keys).orderBy("_sec")
    return per_sec.withColumn("_d", F.col("_sec") - F.lag("_sec").over(ws)).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in SUMS], F.min("_sec").alias("_a"), F.max("_sec").alias("_b"),
        F.coalesce(F.sum("_d"), F.lit(0)).alias("_g"), F.coalesce(F.sum(d * d), F.lit(0)).alias("_g2"))


def sums_of_parts(parts: DataFrame) -> DataFrame:
    """The sums per (video, window) of its parts (``parts_of``, in order of ``_part``)."""
    d = F.col("_d")
    over = F.col("_a") - F.lag("_b").over(Window.partitionBy("video_id", "_w").orderBy("_part"))
    return parts.withColumn("_d", F.coalesce(over, F.lit(0))).groupBy("video_id", "_w").agg(
        F.sum("_n").alias("total_comments"),
        (F.sum("_len") / F.sum("_n_len")).alias("_avg_len"),
        (F.sum("_s") / F.sum("_n_s")).alias("_avg_sent"),
        (F.sum("_s2") / F.sum("_n_s")).alias("_avg_sent_sq"),
        F.min("_a").alias("_first"), F.max("_b").alias("_last"),
        F.sum(F.col("_g") + d).alias("_sg"), F.sum(F.col("_g2") + d * d).alias("_sg2"))


#: Seconds of a long interval that are ordered together.
PART_SECONDS = 21_600


def sums_of(combined: DataFrame, part_seconds: int | None = None) -> DataFrame:
    """Sums, authors and gaps per (video, window) of ``combined`` rows."""
    authors = _author_counts(combined).select(F.col("video_id").alias("_v"), F.col("_w").alias("_aw"), "unique_authors")
    return _sums(combined, part_seconds).join(authors, F.col("video_id").eqNullSafe(F.col("_v")) & (F.col("_w") == F.col("_aw"))) \
        .drop("_v", "_aw")


def _windows(timed: DataFrame, part_seconds: int | None = None) -> DataFrame:
    return sums_of(combined(timed), part_seconds)


def finish_measures(df: DataFrame, prev_last: Column | None) -> DataFrame:
    """Turn sums into the seven measures. ``prev_last`` is the last second of
    the previous non-empty window of the video (video scope) or None."""
    total = F.col("total_comments")
    if prev_last is None:
        k = total - 1
        sg, sg2 = F.col("_sg"), F.col("_sg2")
    else:
        edge = F.col("_first") - prev_last
        k = total - 1 + F.when(prev_last.isNotNull(), 1).otherwise(0)
        sg = F.col("_sg") + F.coalesce(edge, F.lit(0))
        sg2 = F.col("_sg2") + F.coalesce(edge * edge, F.lit(0))
    mean_gap = sg.cast("double") / k
    mean_gap_sq = sg2.cast("double") / k
    zero = F.lit(0.0)
    return df.select(
        "video_id",
        "window_start",
        "_last",
        total.alias("total_comments"),
        F.col("unique_authors").cast("long").alias("unique_authors"),
        F.coalesce(F.col("_avg_len"), zero).alias("avg_length"),
        F.coalesce(F.col("_avg_sent"), zero).alias("avg_sentiment"),
        F.greatest(zero, F.coalesce(F.col("_avg_sent_sq") - F.col("_avg_sent") * F.col("_avg_sent"), zero))
        .alias("sentiment_variance"),
        F.when(k > 0, mean_gap).otherwise(zero).alias("avg_gap"),
        F.when(k > 0, F.greatest(zero, mean_gap_sq - mean_gap * mean_gap)).otherwise(zero)
        .alias("gap_variance"),
    )


def window_table(comments: DataFrame, params: Params = DEFAULT,
                 gap_scope: str = _VIDEO_SCOPE) -> DataFrame:
    """``window_metrics`` with ``last_sec``, the last comment second of each window."""
    if gap_scope not in (_VIDEO_SCOPE, _WINDOW_SCOPE):
        raise ValueError(f"gap_scope must be 'video' or 'window', not {gap_scope!r}")
    timed = _timed(comments, params.window_seconds)
    joined = _windows(timed).withColumn("window_start", F.timestamp_seconds(F.col("_w")))
    if gap_scope == _WINDOW_SCOPE:
        return finish_measures(joined, None).withColumnRenamed("_last", "last_sec")
    wv = Window.partitionBy("video_id").orderBy("window_start")
    return finish_measures(joined.withColumn("_prev_last", F.lag("_last").over(wv)),
                   F.col("_prev_last")).withColumnRenamed("_last", "last_sec")


def window_metrics(comments: DataFrame, params: Params = DEFAULT,
                   gap_scope: str = _VIDEO_SCOPE) -> DataFrame:
    """(video_id, window_start, 7 measures) per non-empty tumbling window.

    ``gap_scope="video"``: the first gap of a window reaches back to the last
    comment before it (replay semantics). ``"window"``: gaps stay inside."""
    return window_table(comments, params, gap_scope).drop("last_sec")


def with_gaps(comments: DataFrame, gap_scope: str = _VIDEO_SCOPE,
              params: Params = DEFAULT) -> DataFrame:
    """Every comment with ``gap``: seconds since the previous comment of the
    same video (or of the same window for ``gap_scope="window"``); null for
    the first. Among comments of one second the smallest ``comment_id`` takes
    the gap from the previous second and the others get 0.

    Only distinct seconds are put in order, per (video, window), with the least id of
    each; comments meet them by (video, second), a join that a hot video, window or
    second does not gather in one task. For the video scope the first second of a
    window takes its gap from the window table (last seconds only)."""
    if gap_scope not in (_VIDEO_SCOPE, _WINDOW_SCOPE):
        raise ValueError(f"gap_scope must be 'video' or 'window', not {gap_scope!r}")
    sec = F.unix_seconds(F.col("published_at"))
    # the limit of one row a second applies before the shuffle
    least = Window.partitionBy("video_id", "_s").orderBy("_first_id")
    seconds = comments.select("video_id", sec.alias("_s"), F.col("comment_id").alias("_first_id")) \
        .withColumn("_n", F.row_number().over(least)).where(F.col("_n") <= 1).drop("_n") \
        .withColumn("_w", window_label(F.col("_s"), params.window_seconds))
    before = F.lag("_s").over(Window.partitionBy("video_id", "_w").orderBy("_s"))
    ordered = seconds.withColumn("_prev", before)
    if gap_scope == _VIDEO_SCOPE:
        edges = seconds.groupBy("video_id", "_w").agg(F.max("_s").alias("_last")).select(
            F.col("video_id").alias("_ev"), F.col("_w").alias("_ew"),
            F.lag("_last").over(Window.partitionBy("video_id").orderBy("_w")).alias("_prev_last"))
        ordered = ordered.join(edges, F.col("video_id").eqNullSafe(F.col("_ev")) & F.col("_w").eqNullSafe(F.col("_ew"))) \
            .withColumn("_prev", F.coalesce("_prev", "_prev_last"))
    found = ordered.select(F.col("video_id").alias("_v"), "_s", "_first_id", "_prev")
    out = comments.withColumn("_sec", sec).join(
        found, F.col("video_id").eqNullSafe(F.col("_v")) & F.col("_sec").eqNullSafe(F.col("_s")))
    is_first = F.col("comment_id").eqNullSafe(F.col("_first_id"))
    return out.withColumn("gap", F.when(is_first, F.col("_sec") - F.col("_prev")).otherwise(F.lit(0).cast("long"))) \
        .drop("_sec", "_v", "_s", "_first_id", "_prev")


def window_metrics_between(comments: DataFrame, start, end, videos=None) -> DataFrame:
    """Measures of one closed interval [start, end] per video, gaps inside the
    interval only; a zero row for requested videos without comments. The seconds of a
    long interval are ordered in parts of PART_SECONDS.

    ``start``/``end``: anything ``F.lit(...).cast('timestamp')`` accepts.
    ``videos``: a list of ids, a DataFrame with ``video_id``, or None for all
    videos that have comments at all."""
    spark = comments.sparkSession
    lo = F.lit(start).cast("timestamp")
    hi = F.lit(end).cast("timestamp")
    inside = comments.filter(F.col("published_at").between(lo, hi))
    timed = inside.select(
        "video_id", "author_id", "comment_id", "sentiment",
        F.length(F.col("text")).alias("text_len"),
        F.unix_seconds(F.col("published_at")).alias("_sec"),
    ).withColumn("_w", F.unix_seconds(lo))
    found = _windows(timed, PART_SECONDS).withColumn("window_start", F.timestamp_seconds(F.col("_w")))
    metrics = finish_measures(found, None).drop("_last")
    if videos is None:
        wanted = comments.select("video_id").distinct()
    elif isinstance(videos, DataFrame):
        wanted = videos.select("video_id").distinct()
    else:
        wanted = spark.createDataFrame([(v,) for v in videos], "video_id string")
    zero_d, zero_l = F.lit(0.0), F.lit(0).cast("long")
    out = wanted.join(metrics.drop("window_start"), "video_id", "left")
    return out.select(
        "video_id",
        lo.alias("window_start"),
        F.coalesce("total_comments", zero_l).alias("total_comments"),
        F.coalesce("unique_authors", zero_l).alias("unique_authors"),
        *[F.coalesce(c, zero_d).alias(c) for c in
          ("avg_length", "avg_sentiment", "sentiment_variance", "avg_gap", "gap_variance")],
    )
