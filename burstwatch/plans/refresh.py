"""Windows again after late comments: only those that the comments change.

A late comment changes the measures of its window, the first gap of the next one, and,
through the history, the scores of the ``max_windows`` windows of its video after those. All
others stay as they are stored. Comments are read for the windows whose measures change
and the window before each (for its last second); histories come from the window table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from burstwatch.functions.timefn import window_label
from burstwatch.operators.baseline import coordination_score, rolling_baseline
from burstwatch.operators.joins import null_safe_join, sized_broadcast
from burstwatch.operators.patterns import detect_patterns, explode_alerts
from burstwatch.operators.windows import window_metrics
from burstwatch.params import DEFAULT, Params
from burstwatch.schemas import COMMENTS, MEASURES
from burstwatch.session import cut_lineage, scratch_tables
from burstwatch.sources.tables import (
    COMMENT_COLUMNS, WINDOW_KEYS, read_window_metrics, table_exists, write_alerts, write_window_metrics,
)


def touched_windows(late: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """(video_id, window_start) of the windows that hold the comments."""
    start = F.timestamp_seconds(window_label(F.unix_seconds("published_at"), params.window_seconds))
    return late.select("video_id", start.alias("window_start")).distinct()


def affected_windows(stored: DataFrame, touched: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Windows of the touched videos, stored or new, as far as they matter, with flags:
    ``measure`` (its measures change), ``before`` (the window before such a one),
    ``score`` (its scores change); the rest are histories."""
    videos = sized_broadcast(cut_lineage(touched.select("video_id").distinct()))
    known = null_safe_join(stored.select(*WINDOW_KEYS), videos, ["video_id"], "left_semi")
    every = known.withColumn("t", F.lit(0)).unionByName(touched.withColumn("t", F.lit(1))) \
        .groupBy(*WINDOW_KEYS).agg(F.max("t").alias("t"))
    order = Window.partitionBy("video_id").orderBy("window_start")
    n = params.max_windows
    marked = every.withColumn("measure", (F.col("t") == 1) | (F.coalesce(F.lag("t").over(order), F.lit(0)) == 1)) \
        .withColumn("before", F.coalesce(F.lead("measure").over(order), F.lit(False))) \
        .withColumn("score", F.max(F.col("measure").cast("int")).over(order.rowsBetween(-n, 0)) == 1)
    # of the others only the histories of those
    reach = F.max(F.col("score").cast("int")).over(order.rowsBetween(0, n)) == 1
    return marked.withColumn("reach", reach).where(F.col("reach") | F.col("before")).drop("t", "reach")


def comments_of_windows(spark: SparkSession, path: str, windows: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Stored comments of the given windows (stored, few enough for their dates to be
    listed); only the dates that they touch are read."""
    last = F.timestamp_seconds(F.unix_seconds("window_start") + params.window_seconds - 1)
    dates = [r[0] for r in windows.select(F.explode(F.sequence(F.to_date("window_start"), F.to_date(last)))).distinct().collect()]
    schema = COMMENTS.fromJson(COMMENTS.jsonValue()).add("published_date", "date")
    some = spark.read.schema(schema).parquet(path).where(F.col("published_date").isin(dates)).select(*COMMENT_COLUMNS)
    start = F.timestamp_seconds(window_label(F.unix_seconds("published_at"), params.window_seconds))
    return null_safe_join(some.withColumn("window_start", start), sized_broadcast(windows.select(*WINDOW_KEYS)), WINDOW_KEYS) \
        .drop("window_start")


def refreshed(spark: SparkSession, comments_path: str, stored: DataFrame, late: DataFrame,
              params: Params = DEFAULT) -> DataFrame:
    """The windows that ``late`` (comments that the table at ``comments_path`` has by now)
    changes, scored anew, with their z columns; null scores during warm-up."""
    some = cut_lineage(affected_windows(stored, touched_windows(late, params), params))
    read = cut_lineage(some.where("measure OR before"))
    # of the windows before only the last second is right: they are not kept
    found = window_metrics(comments_of_windows(spark, comments_path, read, params), params)
    new = null_safe_join(found, some.where("measure").select(*WINDOW_KEYS), WINDOW_KEYS)
    old = null_safe_join(stored, some.where("NOT measure").select(*WINDOW_KEYS), WINDOW_KEYS)
    table = new.select(*WINDOW_KEYS, *MEASURES).unionByName(old.select(*WINDOW_KEYS, *MEASURES))
    scored = coordination_score(rolling_baseline(table, params), params)
    return null_safe_join(scored, some.where("score").select(*WINDOW_KEYS), WINDOW_KEYS)


def refresh_windows(spark: SparkSession, comments_path: str, windows_path: str, late: DataFrame,
                    params: Params = DEFAULT, alerts_path: str | None = None) -> None:
    """Bring the window table (a replay's, score 0.0 during warm-up) and, with
    ``alerts_path``, the alerts up to date with ``late`` comments, which the comment table
    already has. The result is that of a whole replay; a second run changes nothing. Only
    the dates of changed windows are written. Without late comments nothing is done."""
    if not table_exists(spark, windows_path) or late.isEmpty():
        return
    with scratch_tables(spark):
        rows = cut_lineage(refreshed(spark, comments_path, read_window_metrics(spark, windows_path), late, params))
        zero = rows.withColumn("coordination_score", F.coalesce("coordination_score", F.lit(0.0)))
        write_window_metrics(spark, windows_path, zero)
        if alerts_path:
            write_alerts(explode_alerts(detect_patterns(rows, params), params), alerts_path, rows.select(*WINDOW_KEYS))
