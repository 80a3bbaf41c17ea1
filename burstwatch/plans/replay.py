"""Historical replay: comments -> window metrics -> baseline -> score -> alerts.

One job for all videos. The only exchanges over comment-sized data are the
partial aggregations in ``window_metrics``; everything after runs on the
window table, which grows with time span x videos, not with comment volume."""

from __future__ import annotations

from pyspark.sql import DataFrame

from burstwatch.operators.baseline import coordination_score, rolling_baseline
from burstwatch.operators.patterns import detect_patterns
from burstwatch.operators.windows import window_metrics
from burstwatch.params import DEFAULT, Params
from burstwatch.schemas import ALERTS, MEASURES, Z_COLUMNS

WINDOW_TABLE_COLUMNS = ["video_id", "window_start", *MEASURES, "coordination_score"]


def scored_windows(comments: DataFrame, params: Params = DEFAULT,
                   gap_scope: str = "video", warmup_score: float | None = None) -> DataFrame:
    """Window measures, eight z columns and the coordination score."""
    metrics = window_metrics(comments, params, gap_scope=gap_scope)
    return coordination_score(rolling_baseline(metrics, params), params,
                               warmup_score=warmup_score)


def replay(comments: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The ``window_metrics`` table as replay writes it: score 0.0 during warm-up."""
    return scored_windows(comments, params, warmup_score=0.0).select(*WINDOW_TABLE_COLUMNS)


def replay_alerts(comments: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Alert windows of a replay (warm-up windows never alert)."""
    scored = scored_windows(comments, params)
    return detect_patterns(scored, params)


def alert_context(comments: DataFrame, params: Params = DEFAULT,
                  max_broadcast_bytes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Alert windows and the comments of those windows, both materialised in
    the shared checkpoint folder: evidence, timeline and text checks all
    start from these files instead of re-reading the comment table per
    branch. The alert keys are measured and broadcast under the byte bound."""
    from burstwatch.operators.evidence import alert_comments
    from burstwatch.operators.joins import MAX_BROADCAST_BYTES
    from burstwatch.session import cut_lineage

    alerts = cut_lineage(replay_alerts(comments, params))
    bound = MAX_BROADCAST_BYTES if max_broadcast_bytes is None else max_broadcast_bytes
    window_comments = cut_lineage(alert_comments(comments, alerts, params, bound))
    return alerts, window_comments


def alert_table(alerts: DataFrame, window_texts: DataFrame, params: Params = DEFAULT,
                embed=None, sampled: bool = False) -> DataFrame:
    """The alerts table (``schemas.ALERTS``): one row per (window, pattern)
    with the true score and z values, the templated-text similarity of the window's first
    comments, keywords when templated, and which evidence the window gets.

    ``alerts``: output of ``detect_patterns``; ``window_texts``: (video_id,
    window_start, comment_id, published_at, text) of the alert windows (with
    ``sampled`` only their first comments)."""
    from burstwatch.operators.patterns import explode_alerts
    from burstwatch.operators.text import templated_windows

    keys = ["video_id", "window_start"]
    tw = templated_windows(window_texts, params, embed=embed, sampled=sampled).select(*keys, "similarity", "keywords")
    return (explode_alerts(alerts, params).join(tw, keys, "left")
            .select(*[f.name for f in ALERTS.fields]))


__all__ = ["alert_table", "alert_context", "replay", "replay_alerts", "scored_windows", "WINDOW_TABLE_COLUMNS", "Z_COLUMNS"]
