"""Structured Streaming pipeline."""

from burstwatch.streaming.pipeline import (  # noqa: F401
    BaselineProcessor, closing_comments, initial_state, stream_baseline, stream_comments,
    stream_ingest, stream_pipeline, stream_sink, stream_window_metrics, stream_window_sums,
    window_edge,
)
