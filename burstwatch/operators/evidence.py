"""Evidence behind alerts: the comments of alert windows, their timeline and
repeat authors. All alerts are handled in one job: one equi-join of the
comments with the alert keys, then per-window ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstwatch.functions.timefn import window_label
from burstwatch.operators.joins import MAX_BROADCAST_BYTES, null_safe_join, sized_broadcast
from burstwatch.operators.text import first_n
from burstwatch.params import DEFAULT, Params

KEYS = ["video_id", "window_start"]


def alert_comments(comments: DataFrame, alerts: DataFrame, params: Params = DEFAULT,
                   max_broadcast_bytes: int | None = MAX_BROADCAST_BYTES) -> DataFrame:
    """Comments of every alert window [start, start + window_seconds).

    Comments are labelled with their window and equi-joined on
    (video_id, window_start). With ``max_broadcast_bytes`` the alert keys are
    measured and broadcast when under the bound (pass a materialised
    ``alerts``); ``None`` leaves the strategy to the planner."""
    keys = alerts.select(*KEYS).distinct()
    if max_broadcast_bytes is not None:
        keys = sized_broadcast(keys, max_broadcast_bytes)
    sec = F.unix_seconds(F.col("published_at"))
    labelled = comments.withColumn(
        "window_start", F.timestamp_seconds(window_label(sec, params.window_seconds)))
    return labelled.join(keys, KEYS)


def interval_comments(comments: DataFrame, start, end, videos=None) -> DataFrame:
    """Comments of any closed interval [start, end], with the interval's start as
    ``window_start``: evidence operators take them like those of an alert window.
    ``videos``: a DataFrame with ``video_id``, or None for all."""
    lo, hi = (F.lit(x).cast("timestamp") for x in (start, end))
    inside = comments.filter(F.col("published_at").between(lo, hi)).withColumn("window_start", lo)
    return inside if videos is None else inside.join(videos.select("video_id").distinct(), "video_id", "left_semi")


def window_timeline(window_comments: DataFrame, params: Params = DEFAULT,
                    limit: int | None = None) -> DataFrame:
    """First ``limit`` comments (default ``timeline_limit``) of each window by
    time, then comment id: (keys, rank, comment_id, published_at, author_id,
    text, author_short, text_short)."""
    p = params
    n = p.timeline_limit if limit is None else limit
    first = first_n(window_comments, KEYS, ["published_at", "comment_id"], n)
    return first.select(
        *KEYS, "rank", "comment_id", "published_at", "author_id", "text",
        F.substring(F.col("author_id"), 1, p.author_display).alias("author_short"),
        F.substring(F.col("text"), 1, p.timeline_display).alias("text_short"))


def repeat_authors(window_comments: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Authors with more than one comment in a window, top ``spammer_limit``
    by count (ties by author id), with their first ``spammer_samples`` texts
    in time order. Null authors form one group, as in SQL GROUP BY."""
    p = params
    by_author = [*KEYS, "author_id"]
    counts = (window_comments.groupBy(*by_author)
              .agg(F.count(F.lit(1)).alias("comment_count"))
              .filter(F.col("comment_count") > 1))
    top = first_n(counts, KEYS, [F.desc("comment_count"), F.asc_nulls_last("author_id")],
                  p.spammer_limit)
    top_keys = top.select(*by_author)
    samples = (first_n(null_safe_join(window_comments, top_keys, by_author, "left_semi"),
                       by_author, ["published_at", "comment_id"], p.spammer_samples)
               .groupBy(*by_author)
               .agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))),
                                lambda s: s.getField("text")).alias("samples")))
    return (null_safe_join(top, samples, by_author, "left")
            .select(*KEYS, "rank", "author_id", "comment_count", "samples",
                    F.substring(F.col("author_id"), 1, p.author_display).alias("author_short"),
                    F.transform("samples", lambda t: F.substring(t, 1, p.sample_display))
                    .alias("samples_short")))


def alert_evidence(window_comments: DataFrame, alerts: DataFrame,
                   params: Params = DEFAULT) -> DataFrame:
    """Evidence rows per alert window: repeat authors when the window is a
    spam window (concentration_z above the spam threshold), else the
    timeline. One flat table: (keys, evidence_kind, rank, sample_no,
    author_id, comment_count, published_at, text)."""
    p = params
    kind = (alerts.select(*KEYS, F.when(F.col("concentration_z") > p.spam_concentration_z,
                                        F.lit("repeat_authors"))
                          .otherwise(F.lit("timeline")).alias("evidence_kind"))
            .distinct())
    spam_keys = kind.filter(F.col("evidence_kind") == "repeat_authors").select(*KEYS)
    line_keys = kind.filter(F.col("evidence_kind") == "timeline").select(*KEYS)
    spam = repeat_authors(window_comments.join(spam_keys, KEYS, "left_semi"), p)
    spam_rows = spam.select(
        *KEYS, F.lit("repeat_authors").alias("evidence_kind"), "rank",
        F.posexplode_outer("samples").alias("sample_no", "text"),
        "author_id", "comment_count")
    spam_rows = spam_rows.select(
        *KEYS, "evidence_kind", "rank", (F.col("sample_no") + 1).alias("sample_no"),
        "author_id", "comment_count", F.lit(None).cast("timestamp").alias("published_at"),
        "text")
    timeline = window_timeline(window_comments.join(line_keys, KEYS, "left_semi"), p)
    line_rows = timeline.select(
        *KEYS, F.lit("timeline").alias("evidence_kind"), "rank",
        F.lit(None).cast("int").alias("sample_no"), "author_id",
        F.lit(None).cast("long").alias("comment_count"), "published_at", "text")
    return spam_rows.unionByName(line_rows)
