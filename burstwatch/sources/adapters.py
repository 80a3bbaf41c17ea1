"""Adapters from the driver's tables to the library's data model.

``events`` plays the comment stream: one event is one comment, the event type
is the video, the user is the author and ``value`` carries the sentiment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from burstwatch.functions.timefn import epoch_seconds
from burstwatch.operators.joins import sized_broadcast
from burstwatch.session import cut_lineage


def load_table(spark: SparkSession, sf_dir: str, name: str, partitions: int | None = None) -> DataFrame:
    """A table; with ``partitions``, dealt anew to so many tasks (for heavy work per
    row on a table of few files)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df if partitions is None else df.repartition(partitions)


def comments_from_events(events: DataFrame) -> DataFrame:
    """Comments table (see ``schemas.COMMENTS``) from ``events``."""
    sec = epoch_seconds(events, "ts")
    published = F.timestamp_seconds(sec)
    return events.select(
        F.col("event_id").cast("string").alias("comment_id"),
        F.col("event_type").alias("video_id"),
        F.col("user_id").cast("string").alias("author_id"),
        F.coalesce(F.col("props"), F.lit("")).alias("text"),
        F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("value") / 100 - 1)).alias("sentiment"),
        published.alias("published_at"),
        published.alias("fetched_at"),
    )


def load_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comments_from_events(load_table(spark, sf_dir, "events"))


def with_document_text(comments: DataFrame, documents: DataFrame) -> DataFrame:
    """Swap each comment's text for a document's text: document
    ``comment_id % count(documents)``. The count is a scalar subquery, so this is
    one equi-join of the (usually pre-filtered) comments with the documents."""
    n_docs = documents.select(F.count(F.lit(1))).scalar()
    keyed = comments.withColumn(
        "_doc_key", F.pmod(F.col("comment_id").cast("long"), n_docs))
    docs = documents.select(F.col("doc_id").alias("_doc_key"),
                            F.coalesce(F.col("text"), F.lit("")).alias("_doc_text"))
    return (keyed.join(docs, "_doc_key", "left")
            .withColumn("text", F.coalesce(F.col("_doc_text"), F.lit("")))
            .drop("_doc_key", "_doc_text"))


def labels_as_predictions(labels: DataFrame) -> DataFrame:
    """``labels`` as a sentiment classifier's output: (doc_id, label, score)."""
    return labels.select(
        "doc_id",
        F.when(F.col("quality") == 1, F.lit("POSITIVE")).otherwise(F.lit("NEGATIVE")).alias("label"),
        (F.lit(0.5) + F.pmod(F.col("doc_id"), F.lit(50)) / 100.0).alias("score"),
    )


def _item():
    """A comment as the comment API gives it."""
    return F.struct(
        F.col("comment_id").alias("id"),
        F.struct(F.struct(F.struct(
            F.struct(F.col("author_id").alias("value")).alias("authorChannelId"),
            F.col("text").alias("textOriginal"),
            F.date_format(F.col("published_at"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
        ).alias("snippet")).alias("topLevelComment")).alias("snippet"))


def round_pages(comments: DataFrame, number: int, page_size: int, more: bool) -> DataFrame:
    """Comments of the driver's events as one round: per video pages of ``page_size``
    items, newest first, each naming the token of the next; with ``more`` the last page
    names one too, as it does when the fetch ended at the stop. (video_id, page, line)."""
    newest = Window.partitionBy("video_id").orderBy(F.desc("published_at"), F.desc("comment_id"))
    n = comments.withColumn("_rn", F.row_number().over(newest) - 1).withColumn("page", F.floor(F.col("_rn") / page_size).cast("int"))
    pages = n.groupBy("video_id", "page").agg(F.sort_array(F.collect_list(F.struct("_rn", _item().alias("it")))).alias("_items"))
    last = F.max("page").over(Window.partitionBy("video_id"))
    token = F.concat(F.lit("p"), F.col("page").cast("string"))
    following = F.concat(F.lit("p"), (F.col("page") + 1).cast("string"))
    line = F.to_json(F.struct(
        "video_id", F.lit(number).alias("round"), F.when(F.col("page") > 0, token).alias("pageToken"),
        (following if more else F.when(F.col("page") < last, following)).alias("nextPageToken"),
        F.transform("_items", lambda s: s.getField("it")).alias("items")))
    return pages.select("video_id", "page", line.alias("line"))


def comment_pages(comments: DataFrame, page_size: int = 100) -> DataFrame:
    """Comments of the driver's events laid out as API pages, newest first within
    a page: one JSON string per (video_id, page). The pages of a (video, hour) are
    hash buckets of about ``page_size`` items."""
    sec = F.unix_seconds(F.col("published_at"))
    c = comments.withColumn("_hour", sec - F.pmod(sec, F.lit(3600)))
    counts = cut_lineage(c.groupBy("video_id", "_hour").agg(F.count(F.lit(1)).alias("_n")))
    buckets = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(page_size)))
    bucketed = c.join(sized_broadcast(counts), ["video_id", "_hour"]).withColumn(
        "_page", F.pmod(F.xxhash64("comment_id"), buckets.cast("long")))
    item = _item()
    pages = bucketed.groupBy("video_id", "_hour", "_page").agg(
        F.sort_array(F.collect_list(F.struct(F.col("published_at"), F.col("comment_id"),
                                             item.alias("it"))), asc=False).alias("_items"))
    return pages.select(
        "video_id",
        F.concat_ws("-", F.col("_hour").cast("string"), F.col("_page").cast("string")).alias("page_id"),
        F.to_json(F.struct(F.lit(None).cast("string").alias("nextPageToken"),
                           F.transform("_items", lambda s: s.getField("it")).alias("items")))
        .alias("page_json"))


def land_comment_pages(pages: DataFrame, root: str) -> None:
    """Write pages (``comment_pages`` output) as JSON Lines under
    ``<root>/video_id=<id>/``, the layout ``read_comment_pages`` reads."""
    pages.select("video_id", "page_json").write.mode("append").partitionBy("video_id").text(root)
