"""Named abnormal patterns over scored windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstwatch.params import DEFAULT, Params
from burstwatch.schemas import Z_COLUMNS

# Pattern codes and the alert text each one prints.
PATTERN_MESSAGES = {
    "automated_timing": "Automated Timing: Inter-comment gaps show unnatural statistical consistency.",
    "coordinated_sentiment": "Coordinated Sentiment: A sudden, uniform shift in tone with unusually low variance.",
    "volume_anomaly": "Volume Anomaly: A massive comment spike generated by a disproportionately small number of authors.",
    "high_frequency_spam": "High-Frequency Spam: Individual accounts are posting multiple times within this window.",
}

FLAG_COLUMNS = ["automated_timing", "coordinated_sentiment", "volume_anomaly",
                "high_frequency_spam"]


def pattern_flags(df: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Adds one boolean per pattern (null during warm-up)."""
    p = params
    return df.select(
        "*",
        (F.col("gap_var_z") < p.timing_gap_var_z).alias("automated_timing"),
        ((F.abs(F.col("sentiment_z")) > p.sentiment_abs_z)
         & (F.col("sentiment_var_z") < p.sentiment_var_z)).alias("coordinated_sentiment"),
        ((F.col("count_z") > p.volume_count_z)
         & (F.col("author_z") < p.volume_author_z)).alias("volume_anomaly"),
        (F.col("concentration_z") > p.spam_concentration_z).alias("high_frequency_spam"),
    )


def detect_patterns(scored: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Windows past warm-up with at least ``volume_guard`` comments where any
    pattern fires; adds the four flags and ``patterns`` (array of codes)."""
    guarded = scored.filter((F.col("total_comments") >= params.volume_guard)
                            & F.col("count_z").isNotNull())
    flagged = pattern_flags(guarded, params)
    names = F.array_compact(F.array(*[F.when(F.col(c), F.lit(c)) for c in FLAG_COLUMNS]))
    return flagged.withColumn("patterns", names).filter(F.size("patterns") > 0)


def explode_alerts(alerts: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """One row per (video, window, pattern) with its message, the z values behind it
    and the kind of evidence the window gets."""
    msg = F.create_map(*[x for k, v in PATTERN_MESSAGES.items() for x in (F.lit(k), F.lit(v))])
    kind = F.when(F.col("concentration_z") > params.spam_concentration_z,
                  F.lit("repeat_authors")).otherwise(F.lit("timeline"))
    return (alerts.select("video_id", "window_start", "coordination_score", *Z_COLUMNS,
                          kind.alias("evidence_kind"), F.explode("patterns").alias("pattern"))
            .withColumn("message", msg[F.col("pattern")]))
