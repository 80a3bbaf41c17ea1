"""Compositions of operators into end-to-end jobs."""

from burstwatch.plans.replay import (  # noqa: F401
    alert_context, alert_table, replay, replay_alerts, scored_windows,
)
from burstwatch.plans.ingest import ingest_comments  # noqa: F401
