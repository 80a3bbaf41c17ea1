"""Chains of comment pages: which landed pages belong together, and whether all are there.

A round fetches a video's pages newest first: the first page has no token, each page
names the token of the next. The fetch ends with a page that names none, or where the
newest comment of the last round shows up (the stop). Pages land one by one and in any
order, so a round can be there with a hole in it; its items are not to be taken, and
its newest comment not to be the next stop, before the hole is filled.

Pages are linked by pointer jumping: each page points at the page before it, and every
pass doubles the distance, so a chain of n pages takes log2(n) joins of page keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burstwatch.operators.joins import null_safe_join
from burstwatch.schemas import COMMENT_PAGE
from burstwatch.session import cut_lineage

#: A landed page of a round: ``pageToken`` is what it was fetched with.
ROUND_PAGE = T.StructType([T.StructField("video_id", T.StringType()), T.StructField("round", T.LongType()),
                           T.StructField("pageToken", T.StringType()), *COMMENT_PAGE.fields])
#: The newest comment that a video's last complete round has seen.
ROUND_MARK = T.StructType([T.StructField("video_id", T.StringType()), T.StructField("mark_id", T.StringType()),
                           T.StructField("mark_round", T.LongType())])
_CHAIN = ["video_id", "round"]
_FIRST = ""


def read_page_rounds(spark: SparkSession, root: str) -> DataFrame:
    """Landed pages of rounds (JSON Lines of ``ROUND_PAGE``)."""
    return spark.read.schema(ROUND_PAGE).json(root)


def stream_page_rounds(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of ``read_page_rounds``."""
    reader = spark.readStream.schema(ROUND_PAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(root)


def page_positions(pages: DataFrame) -> DataFrame:
    """(video_id, round, token, next, position): each page once, with its place in the
    chain from the first page on (0); null if the pages before it are not all there. The
    token of the first page is ''. A page that landed twice is one page."""
    keys = pages.select(*_CHAIN, F.coalesce("pageToken", F.lit(_FIRST)).alias("token"), F.col("nextPageToken").alias("next")) \
        .groupBy(*_CHAIN, "token").agg(F.min("next").alias("next"))
    keys = cut_lineage(keys)
    before = keys.where("next IS NOT NULL").groupBy(*_CHAIN, F.col("next").alias("token")).agg(F.min("token").alias("up"))
    is_first = F.col("token") == _FIRST
    at = cut_lineage(null_safe_join(keys, before, [*_CHAIN, "token"], "left").select(
        *_CHAIN, "token", "next", F.when(is_first, F.lit(_FIRST)).otherwise(F.col("up")).alias("up"),
        F.when(is_first, 0).otherwise(1).cast("long").alias("steps")))
    # pages of a ring never come to the first page: the passes are bounded by the longest chain
    longest = keys.groupBy(*_CHAIN).count().agg(F.max("count")).first()[0] or 1
    for _ in range(max(1, longest - 1).bit_length()):
        over = at.select(*_CHAIN, F.col("token").alias("up"), F.col("up").alias("up2"), F.col("steps").alias("steps2"))
        at = cut_lineage(null_safe_join(at, over, [*_CHAIN, "up"], "left").select(
            *_CHAIN, "token", "next", F.col("up2").alias("up"), (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps")))
    return at.select(*_CHAIN, "token", "next", F.when(F.col("up") == _FIRST, F.col("steps")).alias("position"))


def assemble(pages: DataFrame, marks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chains of ``pages`` (``ROUND_PAGE``) and their items, both stored.

    Chains: (video_id, round, pages, complete, missing, newest_id): ``missing`` is the token
    of the page that an incomplete chain lacks. Items: (video_id, round, position, idx,
    item) of complete chains, newest first, up to the stop and without it; all of
    them if the video has no mark or its comment does not show up."""
    positions = page_positions(pages)
    token = F.coalesce("pageToken", F.lit(_FIRST))
    placed = null_safe_join(pages.withColumn("token", token).dropDuplicates([*_CHAIN, "token"]).drop("nextPageToken"),
                            positions.where("position IS NOT NULL"), [*_CHAIN, "token"])
    stops = marks.select("video_id", "mark_id")
    each = cut_lineage(null_safe_join(
        placed.select(*_CHAIN, "position", F.posexplode("items").alias("idx", "item")), stops, ["video_id"], "left"))
    found = each.where(F.col("item.id") == F.col("mark_id")).groupBy(*_CHAIN).agg(
        F.min(F.struct("position", "idx")).alias("stop"))
    ends = positions.where("position IS NOT NULL").groupBy(*_CHAIN).agg(
        F.count(F.lit(1)).alias("pages"), F.max(F.struct("position", "next")).alias("last"))
    newest = each.groupBy(*_CHAIN).agg(F.min_by("item.id", F.struct("position", "idx")).alias("newest_id"))
    # a round whose first page is not there has no end yet
    every = positions.select(*_CHAIN).distinct()
    known = null_safe_join(null_safe_join(null_safe_join(every, ends, _CHAIN, "left"), found, _CHAIN, "left"),
                           newest, _CHAIN, "left")
    complete = F.col("pages").isNotNull() & (F.col("last.next").isNull() | F.col("stop").isNotNull())
    chains = cut_lineage(known.select(*_CHAIN, F.coalesce("pages", F.lit(0)).alias("pages"), complete.alias("complete"),
                                      F.when(~complete, F.coalesce(F.col("last.next"), F.lit(_FIRST))).alias("missing"),
                                      "newest_id", "stop"))
    taken = null_safe_join(each, chains.where("complete").select(*_CHAIN, "stop"), _CHAIN)
    items = taken.where(F.col("stop").isNull() | (F.struct("position", "idx") < F.col("stop")))
    return chains.drop("stop"), cut_lineage(items.select(*_CHAIN, "position", "idx", "item"))


def moved_marks(marks: DataFrame, chains: DataFrame) -> DataFrame:
    """Marks after complete chains: the newest comment of a video's last complete round.
    Rounds that are incomplete, have no items or come before the mark's move nothing."""
    new = chains.where("complete AND newest_id IS NOT NULL").select(
        "video_id", F.col("newest_id").alias("mark_id"), F.col("round").alias("mark_round"))
    last = marks.select(*ROUND_MARK.names).unionByName(new).groupBy("video_id").agg(
        F.max(F.struct("mark_round", "mark_id")).alias("m"))
    return last.select("video_id", "m.mark_id", "m.mark_round")
