"""Rolling robust baseline and the coordination score.

Each window is compared with the previous ``max_windows`` non-empty windows of
its video (the current one excluded). The measures travel as one struct, so the
history is a single window operator over the small window table, partitioned by
video and ordered by window start. The stream keeps the same struct as state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burstwatch.functions.stats import dampen, robust_z_sql
from burstwatch.params import DEFAULT, Params
from burstwatch.schemas import MEASURES

# (z column, signal name in the history struct, MAD floor key)
SIGNALS = [
    ("count_z", "count", "count"),
    ("author_z", "author", "author"),
    ("length_z", "length", "length"),
    ("sentiment_z", "sentiment", "sentiment"),
    ("concentration_z", "concentration", "concentration"),
    ("sentiment_var_z", "sentiment_var", "sentiment_var"),
    ("gap_z", "gap", "gap"),
    ("gap_var_z", "gap_var", "gap_var"),
]


# signal name -> SQL over a window's measures (``{m}`` prefixes their names)
SIGNAL_SQL = {
    "count": "CAST({m}total_comments AS DOUBLE)",
    "author": "CAST(greatest({m}unique_authors, 1) AS DOUBLE)",
    "length": "{m}avg_length",
    "sentiment": "{m}avg_sentiment",
    "concentration": "{m}total_comments / greatest({m}unique_authors, 1)",
    "sentiment_var": "{m}sentiment_variance",
    "gap": "{m}avg_gap",
    "gap_var": "{m}gap_variance",
}


def z_columns(history: str, params: Params = DEFAULT) -> list[Column]:
    """The eight z columns of a window's measures against ``history``, a column with
    an array of the measures of earlier windows; null while it is shorter than
    ``warmup``."""
    p, out = params, []
    for z_name, field, floor_key in SIGNALS:
        earlier = SIGNAL_SQL[field].format(m=f"s_{field}.")
        z = robust_z_sql(SIGNAL_SQL[field].format(m=""), f"transform({history}, s_{field} -> {earlier})",
                         p.mad_floors[floor_key], p.mad_constant, p.z_cap, p.min_history, tag=field)
        out.append(F.expr(f"CASE WHEN size({history}) >= {int(p.warmup)} THEN {z} END").alias(z_name))
    return out


def rolling_baseline(metrics: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Adds the eight robust z columns; null while a video has fewer than
    ``warmup`` earlier windows."""
    frame = (Window.partitionBy("video_id").orderBy("window_start")
             .rowsBetween(-params.max_windows, -1))
    df = metrics.withColumn("_hist", F.collect_list(F.struct(*MEASURES)).over(frame))
    return df.select(*metrics.columns, *z_columns("_hist", params))


def coordination_score(df: DataFrame, params: Params = DEFAULT,
                       warmup_score: float | None = None) -> DataFrame:
    """Adds ``coordination_score`` from the z columns: weighted dampened
    signals, the gap-variance signal boosted when strongly negative, rounded.
    Null during warm-up, or ``warmup_score`` when given (replay writes 0.0)."""
    w = params.weights

    def d(c):
        return dampen(F.col(c), params.noise_floor, params.dampen_factor)

    gz = F.col("gap_var_z")
    gap_signal = d("gap_var_z") * F.when(gz < params.robotic_threshold,
                                         F.lit(params.robotic_multiplier)).otherwise(F.lit(1.0))
    raw = (d("concentration_z") * w["concentration"]
           + gap_signal * w["gap_variance"]
           + d("sentiment_var_z") * w["sentiment_var"]
           + d("count_z") * w["count"])
    score = F.round(raw, params.score_decimals)
    if warmup_score is not None:
        score = F.coalesce(score, F.lit(float(warmup_score)))
    return df.withColumn("coordination_score", score)
