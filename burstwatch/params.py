"""Tunable parameters of the detector, in one frozen dataclass.

Defaults are the fixed values the detector is specified with; every op takes
a ``Params`` so a caller can change window length, history size or thresholds
without touching code.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace


# Fixed values (must equal the specified detector for identical results).
# MAD floors per signal, in signal order:
#   count 2.0, author 2.0, length 10.0, sentiment 0.1,
#   concentration 0.15, sentiment_var 0.05, gap 5.0, gap_var 10.0
_MAD_FLOORS = {
    "count": 2.0,
    "author": 2.0,
    "length": 10.0,
    "sentiment": 0.1,
    "concentration": 0.15,
    "sentiment_var": 0.05,
    "gap": 5.0,
    "gap_var": 10.0,
}

# Score weights: concentration 0.40, gap_variance 0.30, sentiment_var 0.20, count 0.10.
_WEIGHTS = {
    "concentration": 0.40,
    "gap_variance": 0.30,
    "sentiment_var": 0.20,
    "count": 0.10,
}


@dataclass(frozen=True)
class Params:
    window_seconds: int = 600
    max_windows: int = 20
    warmup: int = 10
    min_history: int = 3
    noise_floor: float = 1.2
    dampen_factor: float = 0.1
    robotic_multiplier: float = 1.5
    robotic_threshold: float = -2.0
    mad_constant: float = 1.4826
    z_cap: float = 20.0
    score_decimals: int = 4
    mad_floors: dict = field(default_factory=lambda: dict(_MAD_FLOORS))
    weights: dict = field(default_factory=lambda: dict(_WEIGHTS))
    # alert rules
    volume_guard: int = 5
    timing_gap_var_z: float = -1.5
    sentiment_abs_z: float = 2.0
    sentiment_var_z: float = -1.0
    volume_count_z: float = 2.0
    volume_author_z: float = 1.0
    spam_concentration_z: float = 2.5
    # evidence
    similarity_sample: int = 50
    similarity_threshold: float = 0.40
    timeline_limit: int = 10
    spammer_limit: int = 5
    spammer_samples: int = 3
    top_keywords: int = 3
    keyword_max_df: float = 0.95
    author_display: int = 8
    sample_display: int = 70
    timeline_display: int = 80
    # sentiment model output mapping
    positive_label: str = "POSITIVE"

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

    def __hash__(self):  # by value, as equality is (dict fields as sorted pairs)
        return hash(tuple(tuple(sorted(v.items())) if isinstance(v, dict) else v
                          for v in (getattr(self, f.name) for f in fields(self))))


DEFAULT = Params()
# The driver tables are too sparse for 10-minute windows (one window passes the
# volume guard at sf0.01), so queries over them use 6-hour windows.
SIX_HOURS = Params(window_seconds=6 * 3600)
