"""Column-level functions (all native Spark expressions, no Python UDFs)."""

from burstwatch.functions.stats import (  # noqa: F401
    array_median, dampen, robust_z, robust_z_sql,
)
from burstwatch.functions.timefn import (  # noqa: F401
    epoch_seconds, normalize_timestamp, window_label,
)
from burstwatch.functions.sentiment import sentiment_score  # noqa: F401
