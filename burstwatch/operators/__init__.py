"""DataFrame operators."""

from burstwatch.operators.windows import (  # noqa: F401
    window_metrics, window_metrics_between, with_gaps,
)
from burstwatch.operators.baseline import coordination_score, rolling_baseline  # noqa: F401
from burstwatch.operators.patterns import (  # noqa: F401
    PATTERN_MESSAGES, detect_patterns, explode_alerts, pattern_flags,
)
