"""

Queries run over the driver's tables through the adapters in
``burstwatch.sources.adapters`` (events play the comment stream, 6-hour
windows). Double columns are shown at single precision on both sides.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle_queries as OQ  # noqa: E402
from burstwatch.operators import (  # noqa: E402
    detect_patterns, explode_alerts, window_metrics,
)
from burstwatch.params import SIX_HOURS  # noqa: E402
from burstwatch.plans import alert_context, alert_table, replay, scored_windows  # noqa: E402
from burstwatch.schemas import MEASURES, Z_COLUMNS  # noqa: E402
from burstwatch.sources import (  # noqa: E402
    labels_as_predictions, load_comments, load_table, with_document_text,
)
from burstwatch.operators.evidence import (  # noqa: E402
    alert_comments, alert_evidence, repeat_authors, window_timeline,
)
from burstwatch.operators.text import (  # noqa: E402
    first_n, mean_pairwise_cosine, templated_windows, text_similarity, top_keywords,
)
from burstwatch.operators.sentiment import with_sentiment  # noqa: E402
from burstwatch.functions.sentiment import sentiment_score  # noqa: E402
from burstwatch.session import cut_lineage  # noqa: E402
from burstwatch.operators import window_metrics_between, with_gaps  # noqa: E402
from burstwatch.functions.timefn import normalize_timestamp  # noqa: E402
from burstwatch.sources import (  # noqa: E402
    comment_pages, delta_since, high_water_marks, insert_ignore_duplicates,
    pages_from_json, parse_comments, upsert_window_metrics,
)

SMOKE_DIR = "/root/testdata/sf0.001"
P = SIX_HOURS
DOUBLE_MEASURES = OQ.DOUBLE_MEASURES


def _prepare(spark: SparkSession) -> None:
    # timestamps are shown and collected in UTC
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _shown(df: DataFrame, cols) -> DataFrame:
    """Doubles at single precision (below 1e-9: 0): the precision at which sums made
    in different orders agree. The oracle shows its values the same way."""
    def single(c):
        return F.when(F.abs(c) < 1e-9, F.lit(0.0)).otherwise(F.col(c).cast("float").cast("double")).alias(c)

    cols = set(cols)
    return df.select(*[single(c) if c in cols else F.col(c) for c in df.columns])


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _q_window_metrics(spark, sf_dir):
    _prepare(spark)
    m = window_metrics(load_comments(spark, sf_dir), P)
    return _shown(m, DOUBLE_MEASURES)


def _q_window_metrics_live(spark, sf_dir):
    _prepare(spark)
    m = window_metrics(load_comments(spark, sf_dir), P, gap_scope="window")
    return _shown(m, DOUBLE_MEASURES)


def _q_rolling_baseline(spark, sf_dir):
    _prepare(spark)
    s = scored_windows(load_comments(spark, sf_dir), P)
    s = s.select("video_id", "window_start", *MEASURES, *Z_COLUMNS)
    return _shown(_shown(s, DOUBLE_MEASURES), Z_COLUMNS)


def _q_coordination_score(spark, sf_dir):
    _prepare(spark)
    s = scored_windows(load_comments(spark, sf_dir), P)
    s = s.select("video_id", "window_start", "total_comments", *Z_COLUMNS, "coordination_score")
    return _shown(s, Z_COLUMNS)


def _q_replay(spark, sf_dir):
    _prepare(spark)
    return _shown(replay(load_comments(spark, sf_dir), P), DOUBLE_MEASURES)


def _q_detect_patterns(spark, sf_dir):
    _prepare(spark)
    a = detect_patterns(scored_windows(load_comments(spark, sf_dir), P), P)
    return a.select("video_id", "window_start", "total_comments", "coordination_score",
                    "automated_timing", "coordinated_sentiment", "volume_anomaly",
                    "high_frequency_spam")


def _q_explode_alerts(spark, sf_dir):
    _prepare(spark)
    a = detect_patterns(scored_windows(load_comments(spark, sf_dir), P), P)
    return _shown(explode_alerts(a, P), Z_COLUMNS)


def _alerts_and_comments(spark, sf_dir):
    """Alert windows (materialised in the checkpoint folder: they are reused
    and counted before broadcasting) and the comments of those windows."""
    return alert_context(load_comments(spark, sf_dir), P)


def _q_alert_comments(spark, sf_dir):
    _prepare(spark)
    _, ac = _alerts_and_comments(spark, sf_dir)
    ac = ac.select("video_id", "window_start", "comment_id", "author_id", "text",
                   "published_at", "sentiment")
    return _shown(ac, ["sentiment"])


def _q_window_timeline(spark, sf_dir):
    _prepare(spark)
    _, ac = _alerts_and_comments(spark, sf_dir)
    return window_timeline(ac, P)


def _q_repeat_authors(spark, sf_dir):
    _prepare(spark)
    _, ac = _alerts_and_comments(spark, sf_dir)
    ra = repeat_authors(ac, P)
    return ra.select("video_id", "window_start", "rank", "author_id", "comment_count",
                     F.array_join("samples", "\x1e").alias("samples"), "author_short",
                     F.array_join("samples_short", "\x1e").alias("samples_short"))


def _q_alert_evidence(spark, sf_dir):
    _prepare(spark)
    alerts, ac = _alerts_and_comments(spark, sf_dir)
    return alert_evidence(ac, alerts, P)


def _q_mean_pairwise_cosine(spark, sf_dir):
    emb = load_table(spark, sf_dir, "embeddings")
    return mean_pairwise_cosine(emb, ["label"], "embedding")


def _q_text_similarity(spark, sf_dir):
    conv = load_table(spark, sf_dir, "conversations")
    return text_similarity(conv, ["conv_id"], "turn", "text")


def _q_top_keywords(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents", _tasks(spark))
    top = top_keywords(docs, ["source"], "doc_id", "text", P.top_keywords,
                       max_df=P.keyword_max_df)
    return _shown(top.select("source", "rank", "term", "score"), ["score"])


def _q_templated_windows(spark, sf_dir):
    _prepare(spark)
    _, ac = _alerts_and_comments(spark, sf_dir)
    docs = load_table(spark, sf_dir, "documents")
    keys = ["video_id", "window_start"]
    # the check reads only the first comments of each window: take them
    # before fetching their texts
    sample = first_n(ac.select(*keys, "comment_id", "published_at", "text"), keys,
                     ["published_at", "comment_id"], P.similarity_sample).drop("rank")
    tw = templated_windows(with_document_text(sample, docs), P, sampled=True)
    return tw.select("video_id", "window_start", "n_items", "similarity", "templated",
                     F.array_join("keywords", ",").alias("keywords"))


def _q_alert_table(spark, sf_dir):
    """The alerts table: pattern rows with score, similarity, keywords and
    evidence kind (comment texts from ``documents``)."""
    _prepare(spark)
    alerts, ac = _alerts_and_comments(spark, sf_dir)
    docs = load_table(spark, sf_dir, "documents")
    keys = ["video_id", "window_start"]
    sample = first_n(ac.select(*keys, "comment_id", "published_at", "text"), keys,
                     ["published_at", "comment_id"], P.similarity_sample).drop("rank")
    table = alert_table(alerts, with_document_text(sample, docs), P, sampled=True)
    return _shown(table.withColumn("keywords", F.array_join("keywords", ",")), Z_COLUMNS)


def _q_write_alerts(spark, sf_dir):
    """The alerts table written to storage (partitioned by window date) and
    read back."""
    from burstwatch.sources import read_alerts, write_alerts

    _prepare(spark)
    alerts, ac = _alerts_and_comments(spark, sf_dir)
    docs = load_table(spark, sf_dir, "documents")
    keys = ["video_id", "window_start"]
    sample = first_n(ac.select(*keys, "comment_id", "published_at", "text"), keys,
                     ["published_at", "comment_id"], P.similarity_sample).drop("rank")
    table = alert_table(alerts, with_document_text(sample, docs), P, sampled=True)
    path = f"{_table_root(spark, 'alerts')}/table"
    write_alerts(table, path)
    write_alerts(read_alerts(spark, path), path)  # a re-run changes nothing
    stored = read_alerts(spark, path)
    return _shown(stored.withColumn("keywords", F.array_join("keywords", ",")), Z_COLUMNS)


def _q_sentiment_score(spark, sf_dir):
    pred = labels_as_predictions(load_table(spark, sf_dir, "labels"))
    return pred.withColumn("sentiment", sentiment_score(F.col("label"), F.col("score"),
                                                        P.positive_label))


def _q_with_sentiment(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents", _tasks(spark)).select("doc_id", "text")
    out = with_sentiment(docs, "text", params=P, keep_prediction=True)
    return _shown(out.select("doc_id", "label", "score", "sentiment"), ["score", "sentiment"])


def _length_model():
    """A stand-in batch model, whose answers depend on the text's length alone."""
    def predict(texts):
        return [{"label": "NEGATIVE" if len(t) % 2 else "POSITIVE", "score": 0.5 + len(t) % 50 / 100} for t in texts]

    return predict


def _q_model_sentiment(spark, sf_dir):
    """Sentiment by a batch model, in batches of texts of about one length."""
    from burstwatch.operators.sentiment import model_scorer

    docs = load_table(spark, sf_dir, "documents", _tasks(spark)).select("doc_id", "text")
    out = with_sentiment(docs, "text", model_scorer(_length_model), P, length_batches=True)
    return _shown(out.select("doc_id", "sentiment"), ["sentiment"])


def _q_with_embedding(spark, sf_dir):
    """Embeddings by a native column function (letter counts; a model takes its place
    through ``model_embedder``), one column per component."""
    from burstwatch.operators.text import with_embedding

    def letter_counts(text):
        t = F.lower(F.coalesce(text, F.lit("")))
        return F.array(*[(F.length(t) - F.length(F.replace(t, F.lit(c), F.lit("")))).cast("float")
                         for c in OQ.EMBEDDED_LETTERS])

    rows = with_embedding(load_table(spark, sf_dir, "conversations"), letter_counts)
    return rows.select("conv_id", "turn", *[F.col("embedding")[i].cast("double").alias(f"e{i}")
                                            for i in range(len(OQ.EMBEDDED_LETTERS))])


def _q_with_gaps(spark, sf_dir):
    _prepare(spark)
    g = with_gaps(load_comments(spark, sf_dir), params=P)
    return g.select("comment_id", "video_id", "published_at", "gap")


def _q_window_metrics_between(spark, sf_dir):
    _prepare(spark)
    c = load_comments(spark, sf_dir)
    videos = c.select("video_id").union(spark.createDataFrame([(OQ.QUIET_VIDEO,)], "video_id string"))
    m = window_metrics_between(c, OQ.BETWEEN[0], OQ.BETWEEN[1], videos=videos)
    return _shown(m, DOUBLE_MEASURES)


def _q_parse_comments(spark, sf_dir):
    _prepare(spark)
    pages = comment_pages(load_comments(spark, sf_dir))
    parsed = parse_comments(pages_from_json(pages), fetched_at="2024-02-01 00:00:00")
    return parsed.select("comment_id", "video_id", "author_id", "text", "published_at")


def _q_normalize_timestamp(spark, sf_dir):
    _prepare(spark)
    ev = load_table(spark, sf_dir, "events")
    variant = F.pmod(F.col("event_id"), F.lit(7)).cast("int")
    later = F.col("ts") + F.expr("INTERVAL 2 HOURS")
    raw = (F.when(variant == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
           .when(variant == 1, F.date_format(later, "yyyy-MM-dd'T'HH:mm:ss.SSS'+02:00'"))
           .when(variant == 2, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
           .when(variant == 4, F.date_format(later, "yyyy-MM-dd'T'HH:mm:ss'+02'"))
           .when(variant == 5, F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"))
           .when(variant == 6, F.date_format("ts", "yyyyMMdd"))
           .otherwise(F.concat(F.lit("not a time "), F.col("props"))))
    return ev.select("event_id", variant.alias("variant"),
                     normalize_timestamp(raw).alias("published_at"))


def _split(spark, sf_dir):
    c = load_comments(spark, sf_dir)
    old = c.filter(F.col("published_at") < F.lit(OQ.SPLIT_OLD_BEFORE).cast("timestamp"))
    new = c.filter(F.col("published_at") >= F.lit(OQ.SPLIT_NEW_FROM).cast("timestamp"))
    return c, old, new


def _q_high_water_marks(spark, sf_dir):
    _prepare(spark)
    return high_water_marks(load_comments(spark, sf_dir))


def _q_delta_since(spark, sf_dir):
    _prepare(spark)
    c, old, _ = _split(spark, sf_dir)
    return delta_since(c, high_water_marks(old)).select("comment_id", "video_id", "published_at")


def _q_append_ignore_duplicates(spark, sf_dir):
    _prepare(spark)
    _, old, new = _split(spark, sf_dir)
    lo, hi = (F.lit(x).cast("timestamp") for x in OQ.REFETCH)
    refetched = (new.filter(F.col("published_at").between(lo, hi))
                 .withColumn("fetched_at", F.col("fetched_at") + F.expr("INTERVAL 1 DAY")))
    table = insert_ignore_duplicates(old, new.unionByName(refetched))
    return _shown(table, ["sentiment"])


def _q_upsert_window_metrics(spark, sf_dir):
    _prepare(spark)
    _, old, new = _split(spark, sf_dir)
    table = upsert_window_metrics(replay(old, P), replay(new, P))
    return _shown(table, DOUBLE_MEASURES)


WATERMARK = f"{OQ.STREAM_WATERMARK_SECONDS} seconds"
#: After all events and their windows.
CLOSING_AT = "2100-01-01 00:00:00"


def _event_stream(spark, sf_dir, root):
    """The events table (a file or a folder of part files) as a comment stream that
    closes all its windows."""
    from burstwatch.sources.adapters import comments_from_events
    from burstwatch.streaming import closing_comments, stream_comments

    schema = load_table(spark, sf_dir, "events").schema
    events = comments_from_events(stream_comments(spark, f"{sf_dir}/events.parquet", schema))
    return events.unionByName(closing_comments(spark, f"{root}/closing", CLOSING_AT))


def _q_stream_replay(spark, sf_dir):
    """The live path over the whole events table as a file stream: stream
    windows -> stateful baseline -> upsert sink; returns the sink table."""
    from burstwatch.sources import read_window_metrics
    from burstwatch.streaming import stream_pipeline, stream_sink

    _prepare(spark)
    root = _table_root(spark, "stream-replay")
    scored = stream_pipeline(_event_stream(spark, sf_dir, root), P, watermark=WATERMARK)
    stream_sink(scored, f"{root}/table", f"{root}/checkpoint", trigger={"availableNow": True}).awaitTermination()
    return _shown(read_window_metrics(spark, f"{root}/table"), DOUBLE_MEASURES)


def _q_stream_alerts(spark, sf_dir):
    """Alerts that the live path writes for its windows, with their z values."""
    from burstwatch.sources import read_alerts
    from burstwatch.streaming import stream_pipeline, stream_sink

    _prepare(spark)
    root = _table_root(spark, "stream-alerts")
    scored = stream_pipeline(_event_stream(spark, sf_dir, root), P, watermark=WATERMARK)
    stream_sink(scored, f"{root}/table", f"{root}/checkpoint", {"availableNow": True}, f"{root}/alerts", P).awaitTermination()
    return _shown(read_alerts(spark, f"{root}/alerts").drop("similarity", "keywords"), Z_COLUMNS)


def _q_robust_z(spark, sf_dir):
    """Robust z of window volume against the previous <= max_windows windows
    (no warm-up gate)."""
    from pyspark.sql import Window

    from burstwatch.functions.stats import robust_z

    _prepare(spark)
    m = window_metrics(load_comments(spark, sf_dir), P)
    frame = Window.partitionBy("video_id").orderBy("window_start").rowsBetween(-P.max_windows, -1)
    h = m.withColumn("_h", F.collect_list(F.col("total_comments").cast("double")).over(frame))
    z = robust_z("total_comments", "_h", P.mad_floors["count"], P)
    out = h.select("video_id", "window_start", "total_comments",
                   F.size("_h").cast("long").alias("history_size"), z.alias("count_z"))
    return _shown(out, ["count_z"])


def _table_root(spark, name):
    """A fresh folder under the shared checkpoint directory for tables a query writes."""
    import uuid

    from burstwatch.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _q_stream_window_metrics(spark, sf_dir):
    """Live window measures from the events table read as a file stream,
    written by a parquet sink in append mode; returns the sink table."""
    from burstwatch.streaming import stream_window_metrics

    _prepare(spark)
    root = _table_root(spark, "stream-window-metrics")
    m = stream_window_metrics(_event_stream(spark, sf_dir, root), P, watermark=WATERMARK)
    q = (m.writeStream.format("parquet").outputMode("append")
         .option("path", f"{root}/table").option("checkpointLocation", f"{root}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return _shown(spark.read.schema(m.schema).parquet(f"{root}/table"), DOUBLE_MEASURES)


def _q_ingest_comments(spark, sf_dir):
    """Pages built from events -> parse -> sentiment -> insert-or-ignore into a
    stored table, twice (the second fetch adds nothing); returns the table."""
    from burstwatch.plans import ingest_comments
    from burstwatch.sources import read_comments

    _prepare(spark)
    pages = pages_from_json(comment_pages(load_comments(spark, sf_dir)))
    path = f"{_table_root(spark, 'ingest')}/comments"
    ingest_comments(spark, pages, path, params=P, fetched_at=OQ.INGEST_FETCHED_AT)
    ingest_comments(spark, pages, path, params=P, fetched_at="2024-02-02 00:00:00")
    table = read_comments(spark, path)
    return _shown(table.select("comment_id", "video_id", "author_id", "text", "sentiment",
                               "published_at", "fetched_at"), ["sentiment"])


def _q_read_comment_pages(spark, sf_dir):
    """Pages built from events, landed as JSON Lines files per video, read
    back and parsed."""
    from burstwatch.sources import land_comment_pages, read_comment_pages

    _prepare(spark)
    root = f"{_table_root(spark, 'pages')}/landed"
    land_comment_pages(comment_pages(load_comments(spark, sf_dir)), root)
    parsed = parse_comments(read_comment_pages(spark, root, multi_line=False),
                            fetched_at="2024-02-01 00:00:00")
    return parsed.select("comment_id", "video_id", "author_id", "text", "published_at")


def _q_read_comments(spark, sf_dir):
    """Comments stored partitioned by date, scanned for one video and a
    closed time range (date partitions pruned, the rest pushed down)."""
    from burstwatch.sources import read_comments, write_comments

    _prepare(spark)
    path = f"{_table_root(spark, 'comments')}/table"
    write_comments(load_comments(spark, sf_dir), path)
    got = read_comments(spark, path, video_id=OQ.SCAN_VIDEO, start=OQ.BETWEEN[0], end=OQ.BETWEEN[1])
    return _shown(got.select("comment_id", "video_id", "author_id", "text", "sentiment",
                             "published_at"), ["sentiment"])


def _q_stream_pages_window_metrics(spark, sf_dir):
    """The live path from landed pages: pages (built from events) land as
    JSON Lines files, are read as a file stream, parsed, scored for
    sentiment and cut into closed windows; returns the sink table."""
    from burstwatch.operators.sentiment import with_sentiment
    from burstwatch.sources import land_comment_pages, stream_comment_pages
    from burstwatch.streaming import closing_comments, stream_window_metrics

    _prepare(spark)
    root = _table_root(spark, "stream-pages")
    land_comment_pages(comment_pages(load_comments(spark, sf_dir)), f"{root}/landed")
    pages = stream_comment_pages(spark, f"{root}/landed", multi_line=False)
    comments = with_sentiment(parse_comments(pages, fetched_at="2024-02-01 00:00:00"), params=P)
    comments = comments.unionByName(closing_comments(spark, f"{root}/closing", CLOSING_AT))
    m = stream_window_metrics(comments, P, watermark=WATERMARK)
    q = (m.writeStream.format("parquet").outputMode("append")
         .option("path", f"{root}/table").option("checkpointLocation", f"{root}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return _shown(spark.read.schema(m.schema).parquet(f"{root}/table"), DOUBLE_MEASURES)


def _q_stream_ingest(spark, sf_dir):
    """Landed pages as a stream into the comment store; the pages land twice."""
    from burstwatch.sources import land_comment_pages, read_comments, stream_comment_pages
    from burstwatch.streaming import stream_ingest

    _prepare(spark)
    root = _table_root(spark, "stream-ingest")
    for _ in range(2):
        land_comment_pages(comment_pages(load_comments(spark, sf_dir)), f"{root}/landed")
    pages = stream_comment_pages(spark, f"{root}/landed", multi_line=False)
    stream_ingest(pages, f"{root}/comments", f"{root}/checkpoint", {"availableNow": True}, params=P,
                  fetched_at=OQ.INGEST_FETCHED_AT).awaitTermination()
    table = read_comments(spark, f"{root}/comments")
    return _shown(table.select("comment_id", "video_id", "author_id", "text", "sentiment",
                               "published_at", "fetched_at"), ["sentiment"])


def _q_live_pipeline(spark, sf_dir):
    """Backfill and live detection from landed pages as one plan; the live pages
    overlap the history. Returns the window table."""
    from burstwatch.plans.live import live_pipeline
    from burstwatch.sources import (
        land_comment_pages, read_comment_pages, read_window_metrics, stream_comment_pages,
    )

    _prepare(spark)
    root = _table_root(spark, "live")
    _, old, new = _split(spark, sf_dir)
    land_comment_pages(comment_pages(old), f"{root}/history")
    land_comment_pages(comment_pages(new), f"{root}/landed")
    started = live_pipeline(spark, read_comment_pages(spark, f"{root}/history", multi_line=False),
                            stream_comment_pages(spark, f"{root}/landed", multi_line=False), f"{root}/tables", P,
                            WATERMARK, fetched_at=OQ.INGEST_FETCHED_AT, closing_at=CLOSING_AT,
                            trigger={"availableNow": True})
    for q in started:
        q.awaitTermination()
    return _shown(read_window_metrics(spark, f"{root}/tables/windows"), DOUBLE_MEASURES)


def _q_quarantined_items(spark, sf_dir):
    """Every event as a page of one item, some of them broken, through the ingest;
    returns the stored quarantine."""
    from burstwatch.plans.ingest import ingest_comments, quarantine_path
    from burstwatch.sources import read_quarantine

    _prepare(spark)
    c = load_comments(spark, sf_dir)
    kind = F.pmod(F.col("comment_id").cast("long"), F.lit(5))
    at = F.when(kind == 1, F.lit("soon")).otherwise(F.lit("2024-01-01T00:00:00Z"))
    item = F.struct(F.when(kind != 2, F.col("comment_id")).alias("id"), F.struct(F.struct(F.struct(
        F.struct(F.col("author_id").alias("value")).alias("authorChannelId"), F.col("text").alias("textOriginal"),
        at.alias("publishedAt")).alias("snippet")).alias("topLevelComment")).alias("snippet"))
    page = F.when(kind == 3, F.concat(F.lit("broken "), F.col("comment_id"))).otherwise(
        F.to_json(F.struct(F.array(item).alias("items"))))
    path = f"{_table_root(spark, 'quarantine')}/comments"
    pages = pages_from_json(c.select("video_id", page.alias("page_json")))
    for _ in range(2):  # the second fetch adds nothing
        ingest_comments(spark, pages, path, params=P, fetched_at=OQ.INGEST_FETCHED_AT)
    return read_quarantine(spark, quarantine_path(path))


def _q_stream_handoff(spark, sf_dir):
    """Backfill, then live: comments before the hand-off are replayed in batch and
    seed the per-video stream state (last 20 windows and the last comment second);
    the file stream takes the comments from then on. The hand-off is inside a
    window and moves down to its edge."""
    from burstwatch.sources import read_window_metrics
    from burstwatch.streaming import stream_pipeline, stream_sink

    _prepare(spark)
    root = _table_root(spark, "stream-handoff")
    scored = stream_pipeline(_event_stream(spark, sf_dir, root), P, history_comments=load_comments(spark, sf_dir),
                             watermark=WATERMARK, handoff_at=OQ.HANDOFF_AT)
    stream_sink(scored, f"{root}/table", f"{root}/checkpoint", trigger={"availableNow": True}).awaitTermination()
    return _shown(read_window_metrics(spark, f"{root}/table"), DOUBLE_MEASURES)


def _intervals(comments):
    """An interval for each (video, hour) with comments, of 1 to 72 hours and some seconds."""
    hour = F.floor(F.unix_seconds("published_at") / 3600).cast("long")
    hours = comments.select("video_id", hour.alias("h")).distinct()
    end = F.col("h") * 3600 + 3600 * (1 + F.col("h") % OQ.INTERVAL_HOURS) + OQ.INTERVAL_EXTRA
    return hours.select(F.concat_ws("-", "video_id", F.col("h").cast("string")).alias("interval_id"), "video_id",
                        F.timestamp_seconds(F.col("h") * 3600).alias("start_at"), F.timestamp_seconds(end).alias("end_at"))


def _q_interval_metrics(spark, sf_dir):
    """Measures of thousands of overlapping closed intervals in one plan."""
    from burstwatch.operators.intervals import interval_metrics

    _prepare(spark)
    c = load_comments(spark, sf_dir)
    return _shown(interval_metrics(c, _intervals(c)), DOUBLE_MEASURES)


def _q_interval_timeline(spark, sf_dir):
    """The first comments of thousands of overlapping closed intervals in one plan."""
    from burstwatch.operators.intervals import interval_timeline

    _prepare(spark)
    c = load_comments(spark, sf_dir)
    return interval_timeline(c, _intervals(c), P)


def _q_indexed_inserts(spark, sf_dir):
    """The comments in overlapping batches through the key index (small buckets and runs,
    so that they move and grow), one batch killed between table and index."""
    from burstwatch.sources.tables import comment_log, read_comments

    _prepare(spark)
    path = f"{_table_root(spark, 'indexed')}/comments"
    c = load_comments(spark, sf_dir)
    part = F.pmod(F.xxhash64("comment_id"), F.lit(4))

    def batch(k):
        return cut_lineage(c.where((part == k) | (part == (k + 1) % 4)))

    def log():
        return comment_log(spark, path, buckets=4, max_runs=2, keys_per_bucket=500)

    for k in range(3):
        one = log()
        one.recover()
        if k == 1:
            one.follow = _killed
            try:
                one.insert(batch(k), keep_rows=False)
            except RuntimeError:
                continue
        one.insert(batch(k), keep_rows=False)
    rows = read_comments(spark, path)
    return _shown(rows.select("comment_id", "video_id", "author_id", "text", "sentiment", "published_at"), ["sentiment"])


def _killed(rows, token):
    raise RuntimeError("killed")


def _q_live_restart(spark, sf_dir):
    """The live plan started three times on one root: the history and first pages, more
    pages that overlap them, the rest and the end. Returns the window table."""
    from burstwatch.plans.live import live_pipeline
    from burstwatch.sources import (
        land_comment_pages, read_comment_pages, read_window_metrics, stream_comment_pages,
    )

    _prepare(spark)
    root = _table_root(spark, "live-restart")
    c, old, new = _split(spark, sf_dir)
    land_comment_pages(comment_pages(old), f"{root}/history")
    history = read_comment_pages(spark, f"{root}/history", multi_line=False)
    at = F.col("published_at")
    halves = [new.where(at < F.lit(OQ.RESTART_AT).cast("timestamp")), new.where(at >= F.lit(OQ.RESTART_FROM).cast("timestamp"))]
    for k, pages in enumerate(halves):
        land_comment_pages(comment_pages(pages), f"{root}/landed")
        for q in live_pipeline(spark, history if k == 0 else None,
                               stream_comment_pages(spark, f"{root}/landed", multi_line=False), f"{root}/tables", P, WATERMARK,
                               fetched_at=OQ.INGEST_FETCHED_AT, closing_at=CLOSING_AT if k else None,
                               trigger={"availableNow": True}):
            q.awaitTermination()
    return _shown(read_window_metrics(spark, f"{root}/tables/windows"), DOUBLE_MEASURES)


def _q_stream_rounds(spark, sf_dir):
    """Three rounds of landed pages that overlap each other, newest first, the last two
    ending at the stop; a page of one video never lands, one of another lands last.
    Returns the comment store, each video's mark flagged."""
    from burstwatch.sources.adapters import round_pages
    from burstwatch.sources.chains import stream_page_rounds
    from burstwatch.sources.tables import read_comments
    from burstwatch.streaming.rounds import round_marks, stream_rounds

    _prepare(spark)
    root = _table_root(spark, "rounds")
    c, at, late = load_comments(spark, sf_dir), F.col("published_at"), None
    for k, (lo, hi) in enumerate(OQ.ROUNDS):
        own = c.where((at >= F.lit(lo).cast("timestamp")) & (at < F.lit(hi).cast("timestamp")))
        pages = cut_lineage(round_pages(own, k + 1, OQ.ROUND_PAGE_SIZE, more=k > 0))
        if k == 1:
            hole = (F.col("page") == 1) & F.col("video_id").isin(OQ.HOLE_FOR_GOOD, OQ.HOLE_FOR_A_WHILE)
            late = pages.where(hole & (F.col("video_id") == OQ.HOLE_FOR_A_WHILE))
            pages = pages.where(~hole)
        pages.select("line").coalesce(1).write.mode("append").text(f"{root}/landed")
    late.select("line").coalesce(1).write.mode("append").text(f"{root}/landed")
    stream_rounds(stream_page_rounds(spark, f"{root}/landed", max_files_per_trigger=1), root, trigger={"availableNow": True},
                  params=P, fetched_at=OQ.INGEST_FETCHED_AT).awaitTermination()
    marks = round_marks(spark, root).select(F.col("video_id").alias("_v"), "mark_id")
    rows = read_comments(spark, f"{root}/comments").join(marks, F.col("video_id") == F.col("_v"), "left")
    return rows.select("comment_id", "video_id", "author_id", "text", "published_at",
                       F.coalesce(F.col("comment_id") == F.col("mark_id"), F.lit(False)).alias("is_mark"))


def _q_late_refresh(spark, sf_dir):
    """A replay without some comments, which are then stored late; the windows that they
    change are computed again. Returns the window table, equal to a whole replay."""
    from burstwatch.plans.refresh import refresh_windows
    from burstwatch.sources import read_comments, read_window_metrics, store_comments, write_window_metrics

    _prepare(spark)
    root = _table_root(spark, "refresh")
    c, at = load_comments(spark, sf_dir), F.col("published_at")

    def within(lo, hi):
        return (at >= F.lit(lo).cast("timestamp")) & (at < F.lit(hi).cast("timestamp"))

    late = within(*OQ.LATE_HOUR) | (within(*OQ.LATE_DAYS) & (F.col("video_id") == OQ.LATE_VIDEO))
    store_comments(spark, f"{root}/comments", c.where(~late), keep_rows=False)
    write_window_metrics(spark, f"{root}/windows", replay(read_comments(spark, f"{root}/comments"), P))
    added = store_comments(spark, f"{root}/comments", c.where(late))
    refresh_windows(spark, f"{root}/comments", f"{root}/windows", added, P)
    return _shown(read_window_metrics(spark, f"{root}/windows"), DOUBLE_MEASURES)


def _q_poll_windows(spark, sf_dir):
    """History, then three polls of pages that overlap: windows between the polls, which
    are aligned to nothing, held against the windows before. Returns the window table."""
    from datetime import datetime, timezone

    from burstwatch.sources import read_window_metrics, stream_comment_pages
    from burstwatch.streaming.polling import poll_pipeline

    _prepare(spark)
    root = _table_root(spark, "polls")
    c = load_comments(spark, sf_dir)
    at, ends = F.col("published_at"), [F.lit(x).cast("timestamp") for x in OQ.POLLS_AT]
    history = pages_from_json(comment_pages(c.where(at <= ends[0])))
    for k in range(1, len(ends)):  # what lands before a start is one poll; each has an hour of the poll before
        pages = comment_pages(c.where((at > ends[k - 1] - F.expr("INTERVAL 1 HOUR")) & (at <= ends[k])))
        pages.select(F.concat(F.lit('{"video_id":"'), "video_id", F.lit('",'), F.expr("substring(page_json, 2)")).alias("value")) \
            .write.mode("append").text(f"{root}/landed")
        poll_pipeline(spark, history if k == 1 else None, stream_comment_pages(spark, f"{root}/landed", multi_line=False),
                      f"{root}/tables", P, fetched_at=OQ.INGEST_FETCHED_AT, trigger={"availableNow": True},
                      now=lambda poll: datetime.fromisoformat(OQ.POLLS_AT[poll + 1]).replace(tzinfo=timezone.utc)).awaitTermination()
    return _shown(read_window_metrics(spark, f"{root}/tables/windows"), DOUBLE_MEASURES)


_QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], Callable[[], str] | None]] = {
    "window_metrics": (_q_window_metrics, OQ.q_window_metrics),
    "window_metrics_live_gaps": (_q_window_metrics_live, OQ.q_window_metrics_live),
    "rolling_baseline": (_q_rolling_baseline, OQ.q_rolling_baseline),
    "coordination_score": (_q_coordination_score, OQ.q_coordination_score),
    "detect_patterns": (_q_detect_patterns, OQ.q_detect_patterns),
    "explode_alerts": (_q_explode_alerts, OQ.q_explode_alerts),
    "replay": (_q_replay, OQ.q_replay),
    "alert_comments": (_q_alert_comments, OQ.q_alert_comments),
    "window_timeline": (_q_window_timeline, OQ.q_window_timeline),
    "repeat_authors": (_q_repeat_authors, OQ.q_repeat_authors),
    "alert_evidence": (_q_alert_evidence, OQ.q_alert_evidence),
    "mean_pairwise_cosine": (_q_mean_pairwise_cosine, OQ.q_mean_pairwise_cosine),
    "text_similarity": (_q_text_similarity, OQ.q_text_similarity),
    "top_keywords": (_q_top_keywords, OQ.q_top_keywords),
    "templated_windows": (_q_templated_windows, OQ.q_templated_windows),
    "alert_table": (_q_alert_table, OQ.q_alert_table),
    "sentiment_score": (_q_sentiment_score, OQ.q_sentiment_score),
    "with_sentiment": (_q_with_sentiment, OQ.q_with_sentiment),
    "with_embedding": (_q_with_embedding, OQ.q_with_embedding),
    "model_sentiment": (_q_model_sentiment, OQ.q_model_sentiment),
    "with_gaps": (_q_with_gaps, OQ.q_with_gaps),
    "window_metrics_between": (_q_window_metrics_between, OQ.q_window_metrics_between),
    "parse_comments": (_q_parse_comments, OQ.q_parse_comments),
    "normalize_timestamp": (_q_normalize_timestamp, OQ.q_normalize_timestamp),
    "high_water_marks": (_q_high_water_marks, OQ.q_high_water_marks),
    "delta_since": (_q_delta_since, OQ.q_delta_since),
    "append_ignore_duplicates": (_q_append_ignore_duplicates, OQ.q_append_ignore_duplicates),
    "upsert_window_metrics": (_q_upsert_window_metrics, OQ.q_upsert_window_metrics),
    "stream_replay": (_q_stream_replay, OQ.q_stream_replay),
    "robust_z": (_q_robust_z, OQ.q_robust_z),
    "stream_window_metrics": (_q_stream_window_metrics, OQ.q_stream_window_metrics),
    "ingest_comments": (_q_ingest_comments, OQ.q_ingest_comments),
    "read_comment_pages": (_q_read_comment_pages, OQ.q_parse_comments),
    "read_comments": (_q_read_comments, OQ.q_read_comments),
    "stream_pages_window_metrics": (_q_stream_pages_window_metrics,
                                    OQ.q_stream_pages_window_metrics),
    "write_alerts": (_q_write_alerts, OQ.q_alert_table),
    "stream_handoff": (_q_stream_handoff, OQ.q_stream_handoff),
    "stream_alerts": (_q_stream_alerts, OQ.q_stream_alerts),
    "stream_ingest": (_q_stream_ingest, OQ.q_ingest_comments),
    "live_pipeline": (_q_live_pipeline, OQ.q_live_pipeline),
    "quarantined_items": (_q_quarantined_items, OQ.q_quarantined_items),
    "interval_metrics": (_q_interval_metrics, OQ.q_interval_metrics),
    "interval_timeline": (_q_interval_timeline, OQ.q_interval_timeline),
    "indexed_inserts": (_q_indexed_inserts, OQ.q_indexed_inserts),
    "live_restart": (_q_live_restart, OQ.q_live_pipeline),
    "poll_windows": (_q_poll_windows, OQ.q_poll_windows),
    "stream_rounds": (_q_stream_rounds, OQ.q_stream_rounds),
    "late_refresh": (_q_late_refresh, OQ.q_replay),
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: historical replay (window table with scores) on sf0.001."""
    return _q_replay(spark, SMOKE_DIR)


def _llm():
    """The queries of the training-data operators, or None where that subpackage, or a
    module that it needs, cannot be imported: the other queries do not depend on it."""
    import warnings

    try:
        from burstwatch.llm import queries as llm
    except ImportError as e:
        if not (e.name or "").startswith(("burstwatch.llm", "corpus_pipeline")):
            warnings.warn(f"the training-data operators are left out: {e}", stacklevel=2)
        return None
    return llm


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    llm = _llm()
    return {k: fn for k, (fn, _) in _QUERIES.items()} | (llm.QUERIES if llm else {})


def oracle_sql() -> dict[str, str]:
    """Oracle texts, built only when asked for: queries() never depends on them."""
    llm = _llm()
    return {k: sql() for k, (_, sql) in _QUERIES.items() if sql is not None} | (llm.ORACLES if llm else {})
