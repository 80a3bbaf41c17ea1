"""Comment and window tables: delta reads, insert-or-ignore, upsert, sinks.

Storage is parquet partitioned by date (``published_date`` for comments,
``window_date`` for window metrics), so time-bounded reads and rewrites
touch only the partitions they need."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from burstwatch.operators.joins import null_safe_join, sized_broadcast
from burstwatch.operators.text import first_n
from burstwatch.schemas import ALERTS, COMMENTS, QUARANTINE, WINDOW_METRICS
from burstwatch.session import cut_lineage, remove_path, scratch_tables
from burstwatch.sources.key_index import InsertLog, KeyIndex

COMMENT_COLUMNS = [f.name for f in COMMENTS.fields]
WINDOW_COLUMNS = [f.name for f in WINDOW_METRICS.fields]
WINDOW_KEYS = ["video_id", "window_start"]
QUARANTINE_COLUMNS = [f.name for f in QUARANTINE.fields]


def high_water_marks(comments: DataFrame) -> DataFrame:
    """Newest comment per video: (video_id, mark_id, mark_at). Ties on time go
    to the larger comment id. The newest time is one hash aggregation; ids are
    compared only among the comments of that time."""
    newest = cut_lineage(comments.groupBy("video_id").agg(F.max("published_at").alias("mark_at")))
    m = sized_broadcast(newest.withColumnRenamed("video_id", "_v"))
    ties = comments.join(m, F.col("video_id").eqNullSafe(F.col("_v")) & (F.col("published_at") == F.col("mark_at")))
    return ties.groupBy("video_id", "mark_at").agg(F.max("comment_id").alias("mark_id")) \
        .select("video_id", "mark_id", "mark_at")


def delta_since(items: DataFrame, marks: DataFrame) -> DataFrame:
    """Items newer than their video's mark, ordered by (published_at,
    comment_id); all items of videos without a mark. ``items`` may be a stream.
    The marks (one row per video) are broadcast when small; beyond that both
    sides are shuffled from storage, where AQE splits a hot video."""
    m = sized_broadcast(cut_lineage(marks.select(F.col("video_id").alias("_v"), "mark_id", "mark_at")))  # null is a video too
    newer = ((F.col("published_at") > F.col("mark_at"))
             | ((F.col("published_at") == F.col("mark_at")) & (F.col("comment_id") > F.col("mark_id"))))
    return (items.join(m, F.col("video_id").eqNullSafe(F.col("_v")), "left")
            .filter(F.col("mark_at").isNull() | newer)
            .drop("_v", "mark_id", "mark_at"))


def dedupe_batch(batch: DataFrame) -> DataFrame:
    """One row per comment_id: the earliest fetch wins (then the earliest
    publication, then text). The limit of one row per id applies before the
    shuffle, so a comment repeated many times never lands in one task."""
    order = [c for c in ("fetched_at", "published_at", "text") if c in batch.columns]
    return first_n(batch, ["comment_id"], order, 1).drop("rank")


def append_ignore_duplicates(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of ``batch`` to append: first of each comment_id in the batch and
    absent from all of ``existing`` (of which only the ids are read)."""
    return dedupe_batch(batch).join(existing.select("comment_id"), "comment_id", "left_anti") \
        .select(*batch.columns)


def insert_ignore_duplicates(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """The comments table after the insert: existing rows plus new ones."""
    return existing.unionByName(append_ignore_duplicates(existing, batch).select(*existing.columns))


def upsert_window_metrics(existing: DataFrame, updates: DataFrame, order_by: str | None = None) -> DataFrame:
    """Window table after an upsert on (video_id, window_start): updates
    replace all measures and the score; missing measures become 0, a missing
    score stays null. Of several updates of one key the last by ``order_by``
    wins (without it, the one of the most comments, then of the largest
    values)."""
    zero = F.lit(0.0)
    last = [F.desc(order_by)] if order_by else [F.desc_nulls_last(c) for c in WINDOW_COLUMNS[2:]]
    upd = first_n(updates, WINDOW_KEYS, last, 1).select(
        "video_id", "window_start",
        *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("total_comments", "unique_authors")],
        *[F.coalesce(F.col(c), zero).alias(c) for c in
          ("avg_length", "avg_sentiment", "sentiment_variance", "avg_gap", "gap_variance")],
        F.col("coordination_score").cast("double").alias("coordination_score"))
    kept = existing.select(*WINDOW_COLUMNS).join(upd.select(*WINDOW_KEYS), WINDOW_KEYS, "left_anti")
    return kept.unionByName(upd)


# ------------------------------------------------------------------ storage

def read_comments(spark: SparkSession, path: str, video_id: str | None = None,
                  start=None, end=None) -> DataFrame:
    """Scan stored comments, optionally one video and a closed time range;
    the date bounds prune partitions, the rest is pushed to parquet."""
    schema = T.StructType([*COMMENTS.fields, T.StructField("published_date", T.DateType())])
    df = spark.read.schema(schema).parquet(path)
    if video_id is not None:
        df = df.filter(F.col("video_id") == video_id)
    if start is not None:
        lo = F.lit(start).cast("timestamp")
        df = df.filter((F.col("published_at") >= lo) & (F.col("published_date") >= F.to_date(lo)))
    if end is not None:
        hi = F.lit(end).cast("timestamp")
        df = df.filter((F.col("published_at") <= hi) & (F.col("published_date") <= F.to_date(hi)))
    return df.select(*COMMENT_COLUMNS)


def write_comments(comments: DataFrame, path: str) -> None:
    """Append comments, partitioned by publication date."""
    (comments.select(*COMMENT_COLUMNS)
     .withColumn("published_date", F.to_date("published_at"))
     .write.mode("append").partitionBy("published_date").parquet(path))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``, asked of the file system itself, so
    that an unreadable table is an error and never taken for a missing one."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def index_root(path: str) -> str:
    """Where the key index of the table at ``path`` lies."""
    return f"{path.rstrip('/')}-keys"


def comment_log(spark: SparkSession, path: str, **sizes) -> InsertLog:
    """Inserts into the comments table at ``path`` by its id index. A table that has rows
    and no index yet is indexed once. From then on rows are to be added through it."""
    index = KeyIndex(spark, index_root(path), **sizes)
    if not index.exists() and table_exists(spark, path):
        index.build(read_comments(spark, path).select("comment_id"))

    def same_dates(rows: DataFrame) -> DataFrame:
        dates = [r[0] for r in rows.select(F.to_date("published_at")).distinct().collect()]  # bounded by days
        if not table_exists(spark, path):
            return rows.limit(0).select("comment_id")
        schema = T.StructType([*COMMENTS.fields, T.StructField("published_date", T.DateType())])
        return spark.read.schema(schema).parquet(path).where(F.col("published_date").isin(dates)) \
            .select(F.col("comment_id").alias("_stored"))

    return InsertLog(index, COMMENTS, "comment_id", lambda rows, token: write_comments(rows, path), same_dates)


def store_comments(spark: SparkSession, path: str, batch: DataFrame, prepare=None,
                   keep_rows: bool = True, follow=None) -> DataFrame | None:
    """Insert-or-ignore ``batch`` into the stored table; returns the rows added (None
    without ``keep_rows``). ``prepare`` (rows -> rows) runs on the new rows only, e.g. to
    score them; ``follow``: see ``InsertLog``. The ids that are read are those of the batch's own index buckets."""
    log = comment_log(spark, path)
    log.follow = follow
    log.recover()
    return log.insert(cut_lineage(dedupe_batch(batch)), prepare, keep_rows)


def _replace_rows(spark: SparkSession, path: str, rows: DataFrame, schema: T.StructType, merge,
                  touched: DataFrame | None = None) -> None:
    """Rewrite the dates of a table that ``rows`` (stored, with ``window_date``) or
    ``touched`` (window keys) have, as ``merge(existing rows of those dates, rows)``."""
    days = rows.select("window_date")
    if touched is not None:
        days = days.union(touched.select(F.to_date("window_start")))
    if days.isEmpty():
        return
    plain = rows.drop("window_date")
    if table_exists(spark, path):
        dates = [r[0] for r in days.distinct().collect()]  # bounded by days
        full = T.StructType([*schema.fields, T.StructField("window_date", T.DateType())])
        existing = spark.read.schema(full).parquet(path).filter(F.col("window_date").isin(dates)).drop("window_date")
        # stored first: the files that are replaced must not be in its lineage
        plain = cut_lineage(merge(existing, plain))
        gone = set(dates) - {r[0] for r in plain.select(F.to_date("window_start")).distinct().collect()}
        for day in gone:  # dates without any rows left are not overwritten by a write
            remove_path(spark, f"{path.rstrip('/')}/window_date={day}")
    (plain.withColumn("window_date", F.to_date("window_start")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("window_date").parquet(path))


def write_window_metrics(spark: SparkSession, path: str, updates: DataFrame) -> None:
    """Upsert window metrics into a date-partitioned parquet table. Only the
    dates the updates touch are read and rewritten."""
    empty = spark.createDataFrame([], WINDOW_METRICS)
    with scratch_tables(spark):
        rows = cut_lineage(upsert_window_metrics(empty, updates).withColumn("window_date", F.to_date("window_start")))
        _replace_rows(spark, path, rows, WINDOW_METRICS, upsert_window_metrics)


def write_alerts(alerts: DataFrame, path: str, windows: DataFrame | None = None) -> None:
    """Write alerts (``schemas.ALERTS``; missing columns are null) into a table
    partitioned by window date. The alerts of a window replace those stored for
    it, so a re-run changes nothing. ``windows`` (keys): further windows whose stored
    alerts go, those that have been looked at and have none any more."""
    spark = alerts.sparkSession
    with scratch_tables(spark):
        rows = cut_lineage(alerts.select(
            *[(F.col(f.name) if f.name in alerts.columns else F.lit(None)).cast(f.dataType).alias(f.name)
              for f in ALERTS.fields]).withColumn("window_date", F.to_date("window_start")))
        looked = rows.select(*WINDOW_KEYS) if windows is None else rows.select(*WINDOW_KEYS).union(windows.select(*WINDOW_KEYS))
        keys = cut_lineage(looked.distinct())
        _replace_rows(spark, path, rows, ALERTS, lambda old, new: null_safe_join(
            old, keys, WINDOW_KEYS, "left_anti").unionByName(new), keys)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The stored alerts; none if nothing was ever written."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], ALERTS)
    return spark.read.schema(ALERTS).parquet(path).select(*[f.name for f in ALERTS.fields])


def read_window_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The stored window table."""
    return spark.read.schema(WINDOW_METRICS).parquet(path).select(*WINDOW_COLUMNS)


def store_quarantine(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Append quarantined rows that are not stored yet, by an index of the whole rows."""
    def keyed(df: DataFrame) -> DataFrame:
        # absent and empty fields differ; lengths keep fields apart
        each = [F.concat(F.coalesce(F.length(c).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(F.col(c), F.lit("")))
                for c in QUARANTINE_COLUMNS]
        return df.withColumn("row_key", F.sha2(F.concat(*each), 256))

    index = KeyIndex(spark, index_root(path))
    if not index.exists() and table_exists(spark, path):
        index.build(keyed(read_quarantine(spark, path)).select("row_key"))
    schema = T.StructType([*QUARANTINE.fields, T.StructField("row_key", T.StringType())])

    def append(new: DataFrame, token: str) -> None:
        new.drop("row_key").write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={token}")

    with scratch_tables(spark):
        log = InsertLog(index, schema, "row_key", append, None)
        log.recover()
        log.insert(cut_lineage(keyed(rows.select(*QUARANTINE_COLUMNS).distinct())), keep_rows=False)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """What is quarantined; nothing if nothing ever was."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], QUARANTINE)
    return spark.read.schema(QUARANTINE).parquet(path).select(*QUARANTINE_COLUMNS)
