"""Join helpers with an explicit size check before broadcasting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of a key table we are willing to ship to every executor; a larger one
# goes to a shuffle join (AQE splits skewed partitions).
MAX_BROADCAST_BYTES = 32 << 20
# What a row costs in a hashed relation besides its strings.
ROW_BYTES = 64


def sized_broadcast(small: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``small`` only after measuring it (rows and string bytes); above
    the bound it is left to a shuffle join. Measure a materialised frame:
    measuring runs its plan."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in small.schema.fields
             if isinstance(f.dataType, T.StringType)]
    row = sum(texts, F.lit(ROW_BYTES)).cast("long")
    size = small.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]
    return F.broadcast(small) if size <= max_bytes else small


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null keys match each other."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]
    out = left.join(r, cond, how)
    return out.drop(*[f"_r_{k}" for k in keys]) if how not in ("left_semi", "left_anti") else out
