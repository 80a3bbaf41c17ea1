"""burstwatch: coordinated-activity detection on comment streams, on Spark."""

from burstwatch.params import DEFAULT, SIX_HOURS, Params  # noqa: F401
