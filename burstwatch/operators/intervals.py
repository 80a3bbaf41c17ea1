"""Many closed time intervals at once, overlapping and of any length.

An interval goes to the level of the least bin width that is not below its length
(widths double from level to level), so it touches two bins of it at most. A comment
belongs to one bin of each level in use: the join is an equi-join on (video, level,
bin), and an exact filter on the seconds follows. No range-only join is made, and
neither side grows with the length of an interval.

Before that, comments are gathered in segments: the time of a video cut where an
interval begins, after it ends, and at the edges of bins of SEGMENT_SECONDS. An
interval holds a segment wholly or not at all, so what overlaps multiply is what is
kept of each segment (its first comments, its sums), not its comments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burstwatch.operators.joins import sized_broadcast
from burstwatch.operators.text import first_n
from burstwatch.operators.windows import combined, finish_measures, parts_of, sums_of_parts, SUMS
from burstwatch.params import DEFAULT, Params
from burstwatch.session import cut_lineage

#: Width of the bins of level 0 in seconds.
BIN_SECONDS = 64
#: Longest segment.
SEGMENT_SECONDS = 4_096
#: Levels up to widths beyond any time that a timestamp holds.
LEVELS = 48


def _level(length: Column) -> Column:
    """The least level whose bins are at least as wide as ``length`` seconds."""
    level = F.lit(LEVELS)
    for k in range(LEVELS - 1, -1, -1):
        level = F.when(length <= BIN_SECONDS << k, k).otherwise(level)
    return level


def _bin(sec: Column, level: Column) -> Column:
    # a shift rounds down below zero too
    return F.call_function("shiftright", F.floor(sec / BIN_SECONDS).cast("long"), level.cast("int"))


def _binned(intervals: DataFrame) -> DataFrame:
    """(interval_id, _v, _lo, _hi, _level, _bin): a row for each bin of an interval; none
    if it ends before it starts."""
    lo, hi = F.unix_seconds("start_at"), F.unix_seconds("end_at")
    cut = intervals.select("interval_id", F.col("video_id").alias("_v"), lo.alias("_lo"), hi.alias("_hi")).where("_lo <= _hi") \
        .withColumn("_level", _level(F.col("_hi") - F.col("_lo") + 1))
    return cut.withColumn("_bin", F.explode(F.sequence(_bin(F.col("_lo"), F.col("_level")), _bin(F.col("_hi"), F.col("_level")))))


def with_segment(rows: DataFrame, intervals: DataFrame, sec: Column) -> DataFrame:
    """``rows`` with ``_segment``, the second in which the segment of ``sec`` begins; rows
    without a second are in no interval and go."""
    def bin_of(c):
        return F.floor(c / SEGMENT_SECONDS).cast("long")

    lo, hi = F.unix_seconds("start_at"), F.unix_seconds("end_at")
    edges = intervals.where(lo <= hi).select(F.col("video_id").alias("_ev"), F.explode(F.array(lo, hi + 1)).alias("_edge"))
    edges = cut_lineage(edges.groupBy("_ev", bin_of(F.col("_edge")).alias("_eb")).agg(F.collect_set("_edge").alias("_edges")))
    out = rows.withColumn("_sec_at", sec).where("_sec_at IS NOT NULL").withColumn("_bin_at", bin_of(F.col("_sec_at")))
    out = out.join(sized_broadcast(edges), F.col("video_id").eqNullSafe(F.col("_ev")) & (F.col("_bin_at") == F.col("_eb")), "left")
    last = F.array_max(F.filter("_edges", lambda e: e <= F.col("_sec_at")))
    # greatest leaves nulls out
    return out.withColumn("_segment", F.greatest(F.col("_bin_at") * SEGMENT_SECONDS, last)) \
        .drop("_ev", "_eb", "_edges", "_sec_at", "_bin_at")


def interval_join(rows: DataFrame, intervals: DataFrame, sec: Column, before: Column | None = None) -> DataFrame:
    """Each row of ``rows`` (with ``video_id``) once for each interval (``interval_id``,
    ``video_id``, ``start_at``, ``end_at``; the ids unique) of its video that holds the second
    ``sec``, both ends included. Null videos match each other. With ``before``
    (a second or null) only intervals that begin after it."""
    bins = cut_lineage(_binned(intervals))
    levels = [r[0] for r in bins.select("_level").distinct().collect()]  # LEVELS + 1 at most
    if not levels:
        levels = [0]
    each = rows.withColumn("_sec_at", sec).withColumn("_before", F.lit(None).cast("long") if before is None else before).withColumn("_row_level", F.explode(F.array(*[F.lit(k) for k in sorted(levels)]))) \
        .withColumn("_row_bin", _bin(F.col("_sec_at"), F.col("_row_level")))
    met = each.join(sized_broadcast(bins), F.col("video_id").eqNullSafe(F.col("_v")) & (F.col("_row_level") == F.col("_level"))
                    & (F.col("_row_bin") == F.col("_bin")) & F.col("_sec_at").between(F.col("_lo"), F.col("_hi"))
                    & (F.col("_before").isNull() | (F.col("_before") < F.col("_lo"))))
    return met.drop("_v", "_lo", "_hi", "_level", "_bin", "_row_level", "_row_bin", "_sec_at", "_before")


def comments_of_intervals(comments: DataFrame, intervals: DataFrame) -> DataFrame:
    """The comments of every interval, with ``interval_id``."""
    return interval_join(comments, intervals, F.unix_seconds("published_at"))


def interval_timeline(comments: DataFrame, intervals: DataFrame, params: Params = DEFAULT,
                      limit: int | None = None) -> DataFrame:
    """First ``limit`` comments (default ``timeline_limit``) of each interval by time, then
    id: (interval_id, rank, video_id, comment_id, published_at, author_id, text)."""
    n = params.timeline_limit if limit is None else limit
    order = ["published_at", "comment_id"]
    # the first of an interval are among the first of its segments
    kept = first_n(with_segment(comments, intervals, F.unix_seconds("published_at")), ["video_id", "_segment"], order, n) \
        .drop("rank", "_segment")
    first = first_n(comments_of_intervals(cut_lineage(kept), intervals), ["interval_id"], order, n)
    return first.select("interval_id", "rank", "video_id", "comment_id", "published_at", "author_id", "text")


def interval_metrics(comments: DataFrame, intervals: DataFrame) -> DataFrame:
    """The seven measures of every interval, gaps inside it only: (interval_id, video_id,
    start_at, end_at, measures); zeros for an interval without comments.

    Sums and gaps are made per segment, and the intervals put together those of theirs.
    An author counts where an interval meets it first: in a segment that it holds while
    the one of the author before that is none of its own. Such segments are counted by
    (segment, segment before) before they meet the intervals."""
    timed = comments.select("video_id", "author_id", "sentiment", F.length("text").alias("text_len"),
                            F.unix_seconds("published_at").alias("_sec"))
    timed = with_segment(timed, intervals, F.col("_sec")).withColumnRenamed("_segment", "_w")
    each = cut_lineage(combined(timed))
    parts = cut_lineage(parts_of(each.groupBy("video_id", "_w", "_sec").agg(*[F.sum(c).alias(c) for c in SUMS]), ["video_id", "_w"]))
    met = interval_join(parts, intervals, F.col("_w")).drop("video_id").withColumnRenamed("_w", "_part") \
        .withColumnRenamed("interval_id", "video_id").withColumn("_w", F.lit(0).cast("long"))
    authors = each.where("author_id IS NOT NULL").select("video_id", "author_id", "_w").distinct()
    before = F.lag("_w").over(Window.partitionBy("video_id", "author_id").orderBy("_w"))
    firsts = cut_lineage(authors.withColumn("_prev", before).groupBy("video_id", "_w", "_prev").agg(F.count(F.lit(1)).alias("_authors")))
    unique = interval_join(firsts, intervals, F.col("_w"), F.col("_prev")).groupBy(F.col("interval_id").alias("_i")) \
        .agg(F.sum("_authors").alias("_unique"))
    found = sums_of_parts(met).join(unique, F.col("video_id") == F.col("_i"), "left") \
        .withColumn("unique_authors", F.coalesce("_unique", F.lit(0))).drop("_i", "_unique")
    measures = finish_measures(found.withColumn("window_start", F.timestamp_seconds("_w")), None) \
        .drop("_last", "window_start").withColumnRenamed("video_id", "interval_id")
    names = [c for c in measures.columns if c != "interval_id"]
    out = intervals.select("interval_id", "video_id", "start_at", "end_at").join(measures, "interval_id", "left")
    return out.select("interval_id", "video_id", "start_at", "end_at",
                      *[F.coalesce(F.col(c), F.lit(0).cast(measures.schema[c].dataType)).alias(c) for c in names])
