"""Time helpers. All window arithmetic runs on epoch seconds (bigint), which is
independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T



def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_seconds(df: DataFrame, col: str) -> Column:
    """Whole epoch seconds of a TIMESTAMP (an instant) or TIMESTAMP_NTZ
    (read as UTC wall clock) column."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        micros = F.timestamp_diff("MICROSECOND", _epoch_ntz(), F.col(col))
        return F.floor(micros / F.lit(1_000_000)).cast("long")
    return F.unix_seconds(F.col(col))


def window_label(sec: Column, length_seconds: int) -> Column:
    """Epoch-aligned tumbling window start in epoch seconds."""
    return sec - F.pmod(sec, F.lit(int(length_seconds)))


# Steps from the forms of ISO 8601 to ``YYYY-MM-DDTHH:MM:SS`` with a zone of hours and
# minutes: basic date, basic times, hours alone, date alone, decimal comma, zones.
_DAY = r"^(\d{4}-\d{2}-\d{2})"
_END = r"(:\d{2}(?:\.\d+)?)"
_ISO_STEPS = [
    (r"^(\d{4})(\d{2})(\d{2})(?!\d)", "$1-$2-$3"),
    (_DAY + r".(\d{2})(\d{2})(\d{2})(?!\d)", "$1T$2:$3:$4"),
    (_DAY + r".(\d{2}):?(\d{2})(?=$|[Zz+-])", "$1T$2:$3:00"),
    (_DAY + r".(\d{2})(?=$|[Zz+-])", "$1T$2:00:00"),
    (_DAY + "$", "$1T00:00:00"),
    (r"(\d),(\d)", "$1.$2"),
    (_END + r"([+-]\d{2})(\d{2})$", "$1$2:$3"),
    (_END + r"([+-]\d{2})$", "$1$2:00"),
]


def normalize_timestamp(s: Column) -> Column:
    """ISO-8601 text (extended or basic; ``Z``, an offset of hours or of hours and
    minutes, or none) or ``YYYY-MM-DD HH:MM:SS`` to a UTC instant cut to the second;
    null when unparseable (callers quarantine). Text without an offset is read as
    UTC, whatever the session zone."""
    txt = F.trim(s)
    # the form that the comment API gives, and the plain one, need none of the steps
    usual = txt.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}Z?$")
    at_once = F.concat(F.substring(txt, 1, 19), F.lit("Z")).try_cast("timestamp")
    return F.when(usual, at_once).otherwise(_any_form(txt))


def _any_form(txt: Column) -> Column:
    for pattern, to in _ISO_STEPS:
        txt = F.regexp_replace(txt, pattern, to)
    has_zone = txt.rlike(_END + r"([Zz]|[+-]\d{2}:\d{2})$")
    utc_txt = F.when(has_zone, txt).otherwise(F.concat(txt, F.lit("Z")))
    return F.date_trunc("second", utc_txt.try_cast("timestamp"))
