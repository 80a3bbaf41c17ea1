"""Helpers to run Arrow kernels in tasks.

A kernel is a module function ``kernel(batches, *args)`` that yields record
batches. It is imported by name inside the worker, so tables that it keeps in
its module (vocabularies, memo tables) live as long as the worker does."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from burstwatch.session import ship_package

#: Text bytes that a kernel handles at once (one longer text is handled alone).
SLICE_BYTES = 2_000_000


def give_back() -> None:
    """Return memory that the worker has freed to the system: workers live on, and an
    executor has to hold all of them."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def _lazy(module: str, name: str, args: tuple):
    def run(*data):
        import importlib

        return getattr(importlib.import_module(module), name)(*data, *args)

    return run


def _lazy_batches(module: str, name: str, args: tuple):
    def run(batches):
        import importlib

        from burstwatch.llm.tasks import give_back

        yield from getattr(importlib.import_module(module), name)(batches, *args)
        give_back()

    return run


#: Rows of an Arrow batch, where the session has Spark's default (10,000): batches are
#: counted in rows, and so many whole texts are more than a worker should hold.
BATCH_ROWS = 1_000


def _ready(spark: SparkSession) -> None:
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, BATCH_ROWS)


def arrow_map(df: DataFrame, kernel, schema, *args) -> DataFrame:
    """``df.mapInArrow`` of a module-level kernel."""
    _ready(df.sparkSession)
    return df.mapInArrow(_lazy_batches(kernel.__module__, kernel.__name__, args), schema)


def arrow_groups(df: DataFrame, keys: list[str], kernel, schema, *args) -> DataFrame:
    """``applyInArrow`` of a module-level kernel(table) per group of ``keys``."""
    _ready(df.sparkSession)
    run = _lazy(kernel.__module__, kernel.__name__, args)
    return df.groupBy(*keys).applyInArrow(lambda table: run(table), schema)


def task_id() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def slices(batches, column: str | int, limit: int = SLICE_BYTES):
    """Rows of the batches in runs of at most ``limit`` bytes of ``column`` (-1: the
    last one), at least one row each."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        texts = batch.column(batch.num_columns - 1 if column == -1 else column)
        size = pc.fill_null(pc.binary_length(texts), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < n:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def record_batch(columns: dict, **types) -> pa.RecordBatch:
    """A record batch of columns with the given Arrow types."""
    return pa.record_batch([pa.array(v, type=types[k]) if k in types else pa.array(v)
                            for k, v in columns.items()], names=list(columns))


def input_partitions(spark: SparkSession) -> int:
    """Tasks for a shuffle whose rows a kernel handles: the session's setting."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def keep_kernel(batches, module: str, name: str, args: tuple):
    """Rows whose text (last column) ``module.name(texts, *args)`` marks True."""
    import importlib

    keep = getattr(importlib.import_module(module), name)
    for b in slices(batches, -1):
        yield b.filter(pa.array(keep(b.column(b.num_columns - 1).to_pylist(), *args), pa.bool_()))


def free_name(columns: list[str], base: str) -> str:
    """``base``, with underscores in front until no column is called so."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def text_last(docs: DataFrame, text_col: str) -> tuple[DataFrame, str]:
    """``docs`` with its text as the last column, under a name that no other has."""
    from pyspark.sql import functions as F

    name = free_name(docs.columns, "_text")
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != text_col],
                       F.col(f"`{text_col}`").cast("string").alias(name)), name


def as_before(moved: DataFrame, name: str, docs: DataFrame, text_col: str) -> DataFrame:
    """The columns of ``docs`` in their order, the text from ``name``."""
    from pyspark.sql import functions as F

    return moved.select(*[F.col(f"`{name}`").alias(text_col) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def keep_rows(docs: DataFrame, text_col: str, keep, *args) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that the module function
    ``keep(texts, *args)`` marks True."""
    moved, name = text_last(docs, text_col)
    kept = arrow_map(moved, keep_kernel, moved.schema, keep.__module__, keep.__name__, args)
    return as_before(kept, name, docs, text_col)
