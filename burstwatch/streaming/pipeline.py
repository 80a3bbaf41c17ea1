"""Structured Streaming: the live side of the detector.

comments stream -> watermark + dedup by comment_id -> event-time tumbling
window sums (append mode) -> per-video stateful baseline
(``transformWithStateInPandas``) -> z scores and score in Spark expressions
(the same code as batch) -> sink.

The stateful step holds, per video, only the last comment second and the
measures of the last ``max_windows`` windows: state is bounded by design.
History is replayed in batch and handed over as ``initialState``; the stream
then takes newer data only (pages land newest first, so a stream that
replayed history would drop older pages as late)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from burstwatch.functions.timefn import window_label
from burstwatch.operators.baseline import coordination_score, z_columns
from burstwatch.operators.patterns import detect_patterns, explode_alerts
from burstwatch.operators.windows import finish_measures, window_table
from burstwatch.params import DEFAULT, Params
from burstwatch.plans.ingest import ingest_comments
from burstwatch.schemas import COMMENTS, MEASURES, WINDOW_METRICS
from burstwatch.session import cut_lineage, ensure_checkpoint_dir, scratch_tables, ship_package
from burstwatch.sources.tables import write_alerts, write_window_metrics

WINDOW_SUMS = T.StructType([
    T.StructField("video_id", T.StringType()),
    T.StructField("w_sec", T.LongType()),
    T.StructField("total_comments", T.LongType()),
    T.StructField("unique_authors", T.LongType()),
    T.StructField("sum_len", T.DoubleType()),
    T.StructField("sum_s", T.DoubleType()),
    T.StructField("sum_s2", T.DoubleType()),
    T.StructField("first_sec", T.LongType()),
    T.StructField("last_sec_w", T.LongType()),
    T.StructField("sum_gap", T.LongType()),
    T.StructField("sum_gap2", T.LongType()),
])

_MEASURES = T.StructType([T.StructField(f.name, f.dataType) for f in WINDOW_METRICS.fields if f.name in MEASURES])
COUNTS = [f.name for f in _MEASURES.fields if isinstance(f.dataType, T.LongType)]
_HISTORY_ROW = T.StructType([T.StructField("w_sec", T.LongType()), *_MEASURES.fields])
_LAST = T.StructType([T.StructField("last_sec", T.LongType())])

BASELINE_OUT = T.StructType(
    [T.StructField("video_id", T.StringType()), T.StructField("w_sec", T.LongType()),
     *_MEASURES.fields, T.StructField("hist", T.ArrayType(_MEASURES))])


# ------------------------------------------------------------- window sums

def stream_window_sums(comments: DataFrame, params: Params = DEFAULT,
                       watermark: str = "10 minutes") -> DataFrame:
    """Closed tumbling windows of a comment stream as sums (append mode).
    Duplicated comment ids within the watermark are dropped; comments later
    than the watermark are dropped (batch replay still counts them).

    countDistinct and lag are not allowed in streams, and one set of all a
    window's authors would grow with the window's volume. So two chained
    streaming aggregations: first per (video, window, author), whose state is
    spread over tasks by author, then per (video, window), where authors are
    counted as rows. Gaps come from the window's sorted distinct seconds: each
    author row carries its own second set, exploded before the second
    aggregation, so the window keeps at most ``window_seconds`` seconds."""
    L = params.window_seconds
    c = (comments.withWatermark("published_at", watermark)
         .dropDuplicatesWithinWatermark(["comment_id"])
         .withColumn("_sec", F.unix_seconds("published_at")))
    per_author = c.groupBy("video_id", F.window("published_at", f"{L} seconds").alias("_win"),
                           "author_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.length("text")).alias("_len"),
        F.sum("sentiment").alias("_s"),
        F.sum(F.col("sentiment") * F.col("sentiment")).alias("_s2"),
        F.collect_set("_sec").alias("_secs"))
    # one row per (author, second); the author's sums ride on its first row
    rows = per_author.select("video_id", "_win", "author_id", "_n", "_len", "_s", "_s2",
                             F.posexplode("_secs").alias("_pos", "_sec"))
    first = F.col("_pos") == 0

    def on_first(c):
        return F.when(first, F.col(c))

    agg = rows.groupBy("video_id", F.window(F.window_time("_win"), f"{L} seconds").alias("_w2")).agg(
        F.sum(on_first("_n")).alias("total_comments"),
        F.count(F.when(first & F.col("author_id").isNotNull(), F.lit(1))).alias("unique_authors"),
        F.sum(on_first("_len")).cast("double").alias("sum_len"),
        F.sum(on_first("_s")).alias("sum_s"),
        F.sum(on_first("_s2")).alias("sum_s2"),
        F.array_sort(F.collect_set("_sec")).alias("_secs"))
    secs = F.col("_secs")
    n = F.size(secs)
    diffs = F.zip_with(F.slice(secs, 2, n), F.slice(secs, 1, n - 1), lambda a, b: a - b)
    return agg.select(
        "video_id", F.unix_seconds(F.col("_w2.start")).alias("w_sec"), "total_comments",
        "unique_authors", "sum_len", "sum_s", "sum_s2",
        F.get(secs, 0).alias("first_sec"), F.element_at(secs, -1).alias("last_sec_w"),
        (F.element_at(secs, -1) - F.get(secs, 0)).alias("sum_gap"),
        F.aggregate(diffs, F.lit(0).cast("long"), lambda acc, d: acc + d * d).alias("sum_gap2"))


# ------------------------------------------------------------- stateful baseline

def _measures(row, prev_last):
    """The seven measures of one window, as batch computes them."""
    total = int(row["total_comments"])
    authors = int(row["unique_authors"])
    first, sg, sg2 = int(row["first_sec"]), int(row["sum_gap"]), int(row["sum_gap2"])
    k = total - 1
    if prev_last is not None:
        edge = first - prev_last
        k, sg, sg2 = k + 1, sg + edge, sg2 + edge * edge
    avg_s = row["sum_s"] / total
    avg_gap = sg / k if k > 0 else 0.0
    return {
        "total_comments": total,
        "unique_authors": authors,
        "avg_length": row["sum_len"] / total,
        "avg_sentiment": avg_s,
        "sentiment_variance": max(0.0, row["sum_s2"] / total - avg_s * avg_s),
        "avg_gap": avg_gap,
        "gap_variance": max(0.0, sg2 / k - avg_gap * avg_gap) if k > 0 else 0.0,
    }


class BaselineProcessor(StatefulProcessor):
    """Per video: last comment second and the measures of the last ``max_windows`` windows."""

    def __init__(self, max_windows: int = DEFAULT.max_windows):
        self.max_windows = max_windows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.history = handle.getListState("history", _HISTORY_ROW)
        self.last = handle.getValueState("last", _LAST)

    def _load(self):
        hist = list(self.history.get()) if self.history.exists() else []
        last = self.last.get()[0] if self.last.exists() else None
        return hist, last

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = [f for f in rows if len(f)]
        if not frames:
            return
        batch = pd.concat(frames, ignore_index=True)
        if "w_sec" not in batch.columns:
            raise ValueError(f"unexpected input columns {list(batch.columns)}")
        batch = batch.sort_values("w_sec")
        hist, last = self._load()
        out = []
        for row in batch.to_dict("records"):
            m = _measures(row, last)
            earlier = [dict(zip(MEASURES, h[1:])) for h in hist]
            out.append({"video_id": key[0], "w_sec": int(row["w_sec"]), **m, "hist": earlier})
            hist = (hist + [(int(row["w_sec"]), *(m[x] for x in MEASURES))])[-self.max_windows:]
            last = int(row["last_sec_w"])
        self.history.put([tuple(h) for h in hist])
        self.last.update((last,))
        yield pd.DataFrame(out, columns=BASELINE_OUT.fieldNames())

    def handleInitialState(self, key, initialState, timerValues) -> None:
        hist, last = self._load()
        rows = initialState.sort_values("w_sec").to_dict("records")
        hist = (hist + [(int(r["w_sec"]), *(int(r[m]) if m in COUNTS else float(r[m]) for m in MEASURES))
                        for r in rows])
        hist = sorted(hist, key=lambda h: h[0])[-self.max_windows:]
        last = max([int(r["last_sec"]) for r in rows] + ([last] if last is not None else []))
        self.history.put([tuple(h) for h in hist])
        self.last.update((last,))

    def close(self) -> None:
        pass


#: Windows that seed a baseline.
SEED = T.StructType([T.StructField("video_id", T.StringType()), *_HISTORY_ROW.fields, *_LAST.fields])


def initial_state(history_comments: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Last ``max_windows`` windows per video from a batch replay, with their
    measures and last comment seconds."""
    newest = Window.partitionBy("video_id").orderBy(F.desc("window_start"))
    return (window_table(history_comments, params).withColumn("_rn", F.row_number().over(newest))
            .filter(F.col("_rn") <= params.max_windows)
            .select("video_id", F.unix_seconds("window_start").alias("w_sec"), *MEASURES, "last_sec"))


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ROCKSDB_COUNT = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"


def use_rocksdb_state(spark: SparkSession) -> None:
    """transformWithState keeps several state variables per key, which only
    the RocksDB state store supports; switch to it unless another provider
    was chosen explicitly. Its rows are not counted, unless that was chosen: the count
    is a metric only and reads the store once for each row that is put."""
    key = "spark.sql.streaming.stateStore.providerClass"
    current = spark.conf.get(key, None)
    if current is None or current.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(key, ROCKSDB_PROVIDER)
    if spark.conf.get(ROCKSDB_COUNT, None) is None:
        spark.conf.set(ROCKSDB_COUNT, "false")


def stream_baseline(window_sums: DataFrame, params: Params = DEFAULT,
                    init: DataFrame | None = None) -> DataFrame:
    """Scored windows from a stream of window sums: measures, eight z
    columns and the coordination score (null during warm-up)."""
    use_rocksdb_state(window_sums.sparkSession)
    ship_package(window_sums.sparkSession)
    based = window_sums.groupBy("video_id").transformWithStateInPandas(
        statefulProcessor=BaselineProcessor(params.max_windows),
        outputStructType=BASELINE_OUT, outputMode="Append", timeMode="None",
        initialState=None if init is None else init.groupBy("video_id"))
    scored = based.select("video_id", F.timestamp_seconds("w_sec").alias("window_start"),
                          *MEASURES, *z_columns("hist", params))
    return coordination_score(scored, params)


def stream_comments(spark: SparkSession, path: str, schema: T.StructType,
                    fmt: str = "parquet", **options) -> DataFrame:
    """A file stream of the table at ``path``: a file, or a folder of part files. The
    path is given as a pattern that only it matches: the file source takes a plain
    path for a folder."""
    path = path.rstrip("/")
    path = f"{path[:-1]}[{path[-1]}]"
    reader = spark.readStream.schema(schema).format(fmt)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


#: Video of closing rows; they never leave an open window.
CLOSING = "__closing__"


def closing_comments(spark: SparkSession, root: str, at) -> DataFrame:
    """A stream of one comment at time ``at`` of a video of its own, landed under
    ``root``. In union with a finite stream that is read in one micro-batch
    (``availableNow``) it moves the watermark past every window that ends a watermark
    delay before ``at``, so that the last windows are closed as well."""
    row = spark.range(1).select(
        F.lit(CLOSING).alias("comment_id"), F.lit(CLOSING).alias("video_id"),
        F.lit(None).cast("string").alias("author_id"), F.lit("").alias("text"), F.lit(0.0).alias("sentiment"),
        F.lit(at).cast("timestamp").alias("published_at"), F.lit(at).cast("timestamp").alias("fetched_at"))
    row.write.mode("append").parquet(root)
    return closing_stream(spark, root)


def closing_stream(spark: SparkSession, root: str) -> DataFrame:
    """The stream of the closing rows that have been landed under ``root``."""
    return stream_comments(spark, root, COMMENTS)


def _start(frame: DataFrame, each, checkpoint: str | None, trigger: dict | None):
    ckpt = checkpoint or f"{ensure_checkpoint_dir(frame.sparkSession)}/stream-{uuid.uuid4().hex}"
    w = frame.writeStream.foreachBatch(each).option("checkpointLocation", ckpt)
    return w.trigger(**(trigger or {"processingTime": "10 minutes"})).start()


def stream_sink(scored: DataFrame, table_path: str, checkpoint: str | None = None,
                trigger: dict | None = None, alerts_path: str | None = None, params: Params = DEFAULT):
    """Upsert every micro-batch of scored windows into the window table and, with
    ``alerts_path``, write the alerts of its windows with their z values (all
    idempotent: a replayed batch rewrites the same rows). Returns the started query."""

    def upsert(batch: DataFrame, batch_id: int) -> None:
        with scratch_tables(batch.sparkSession):
            rows = cut_lineage(batch)
            if not rows.isEmpty():
                write_window_metrics(rows.sparkSession, table_path, rows)
                if alerts_path:
                    write_alerts(explode_alerts(detect_patterns(rows, params), params), alerts_path)

    return _start(scored, upsert, checkpoint, trigger)


def stream_ingest(pages: DataFrame, table_path: str, checkpoint: str | None = None,
                  trigger: dict | None = None, scorer=None, params: Params = DEFAULT, fetched_at=None,
                  follow=None):
    """The live comment store: every micro-batch of landed pages is parsed, scored and
    inserted or ignored, what cannot be parsed is quarantined. Late comments are
    stored like others. ``follow`` (rows, token) gets the new rows of each insert, before
    it counts as done. Returns the started query."""

    def ingest(batch: DataFrame, batch_id: int) -> None:
        ingest_comments(batch.sparkSession, batch, table_path, scorer, params, fetched_at,
                        keep_rows=False, follow=follow)

    return _start(pages, ingest, checkpoint, trigger)


def window_edge(at, params: Params = DEFAULT) -> Column:
    """The start of the window that holds the time ``at`` (a value or a column)."""
    return F.timestamp_seconds(window_label(F.unix_seconds(F.lit(at).cast("timestamp")), params.window_seconds))


def stream_pipeline(comments_stream: DataFrame, params: Params = DEFAULT,
                    history_comments: DataFrame | None = None,
                    watermark: str = "10 minutes", handoff_at=None) -> DataFrame:
    """Comments stream -> scored windows, seeded with the batch history.

    With a history, ``handoff_at`` (a time) says where it ends. It is moved down to a
    window edge: the history counts before it, the stream from it on, so the open
    window comes from the stream alone and the stream must hold all its comments."""
    if history_comments is None:
        return stream_baseline(stream_window_sums(comments_stream, params, watermark), params)
    if handoff_at is None:
        raise ValueError("a history needs handoff_at, the time from which the stream has all comments")
    edge = window_edge(handoff_at, params)
    init = initial_state(history_comments.filter(F.col("published_at") < edge), params)
    live = comments_stream.filter(F.col("published_at") >= edge)
    return stream_baseline(stream_window_sums(live, params, watermark), params, init)


def stream_window_metrics(comments_stream: DataFrame, params: Params = DEFAULT,
                          watermark: str = "10 minutes") -> DataFrame:
    """The seven measures of every closed tumbling window of a comment stream
    (append mode), with gaps inside the window only, as the live path
    measures them; equal to ``window_metrics(gap_scope="window")`` on the
    windows the watermark has closed."""
    n = F.col("total_comments")
    s = stream_window_sums(comments_stream, params, watermark).select(
        "video_id", F.timestamp_seconds("w_sec").alias("window_start"), "total_comments", "unique_authors",
        F.col("last_sec_w").alias("_last"), (F.col("sum_len") / n).alias("_avg_len"),
        (F.col("sum_s") / n).alias("_avg_sent"), (F.col("sum_s2") / n).alias("_avg_sent_sq"),
        F.col("sum_gap").alias("_sg"), F.col("sum_gap2").alias("_sg2"))
    return finish_measures(s, None).drop("_last")
