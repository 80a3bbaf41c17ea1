"""The delta read as a stream: marks are state per video and move with each round.

What a micro-batch leaves is kept by its number: ``marks/<n>``, the newest comment of
each video's last complete round, and ``waiting/<n>``, the pages of rounds that have a
hole. A micro-batch that is run again after a kill starts from the same two tables and
writes the same ones; the comment store takes each comment once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstwatch.params import DEFAULT, Params
from burstwatch.plans.ingest import ingest_comments
from burstwatch.session import cut_lineage, remove_path, scratch_tables
from burstwatch.sources.chains import ROUND_MARK, ROUND_PAGE, assemble, moved_marks
from burstwatch.sources.key_index import folder_names
from burstwatch.streaming.pipeline import _start


def _versions(spark: SparkSession, root: str, kind: str) -> list[int]:
    return sorted(int(n) for n in folder_names(spark, f"{root}/{kind}", done=True))


def _state(spark: SparkSession, root: str, kind: str, schema, number: int) -> DataFrame:
    """The table that the micro-batch before ``number`` has left (none: empty)."""
    if number - 1 not in _versions(spark, root, kind):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/{kind}/{number - 1}")


def round_marks(spark: SparkSession, root: str) -> DataFrame:
    """The marks after the last micro-batch."""
    last = max(_versions(spark, root, "marks"), default=-1)
    return _state(spark, root, "marks", ROUND_MARK, last + 1)


def waiting_pages(spark: SparkSession, root: str) -> DataFrame:
    """Pages of rounds that have a hole, after the last micro-batch."""
    last = max(_versions(spark, root, "waiting"), default=-1)
    return _state(spark, root, "waiting", ROUND_PAGE, last + 1)


def take_rounds(spark: SparkSession, pages: DataFrame, marks: DataFrame, deliver) -> tuple[DataFrame, DataFrame]:
    """Complete rounds among ``pages`` (stored), oldest first: ``deliver`` gets their new
    items as pages, each round up to the marks that the rounds before it left. Returns
    (marks, pages that wait). Rounds are few: as many polls as a micro-batch holds."""
    numbers = [r[0] for r in pages.select("round").distinct().orderBy("round").collect()]
    waiting = []
    for number in numbers:
        own = pages.where(F.col("round").eqNullSafe(F.lit(number)))
        chains, items = assemble(own, marks)
        if not items.isEmpty():
            deliver(items.select("video_id", F.array("item").alias("items")))
        marks = cut_lineage(moved_marks(marks, chains))
        open_chains = chains.where("NOT complete").select(F.col("video_id").alias("_v")).distinct()
        waiting.append(own.join(open_chains, F.col("video_id").eqNullSafe(F.col("_v")), "left_semi"))
    left = spark.createDataFrame([], ROUND_PAGE)
    for own in waiting:
        left = left.union(own.select(*ROUND_PAGE.names))
    return marks, left


def stream_rounds(pages: DataFrame, root: str, checkpoint: str | None = None, trigger: dict | None = None, scorer=None,
                  params: Params = DEFAULT, fetched_at=None):
    """Landed pages of rounds (``stream_page_rounds``) into the comment store at
    ``<root>/comments``. Only rounds without a hole are taken, up to the newest comment of
    the video's round before; a hole holds back the video's mark until its page lands.
    Returns the started query."""

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with scratch_tables(spark):
            here = cut_lineage(_state(spark, root, "waiting", ROUND_PAGE, number).union(batch.select(*ROUND_PAGE.names)))

            def deliver(some: DataFrame) -> None:
                ingest_comments(spark, some, f"{root}/comments", scorer, params, fetched_at, keep_rows=False)

            marks, left = take_rounds(spark, here, _state(spark, root, "marks", ROUND_MARK, number), deliver)
            left.write.mode("overwrite").parquet(f"{root}/waiting/{number}")
            marks.select(*ROUND_MARK.names).write.mode("overwrite").parquet(f"{root}/marks/{number}")
        for kind in ("marks", "waiting"):
            for old in _versions(spark, root, kind):
                if old < number - 1:
                    remove_path(spark, f"{root}/{kind}/{old}")

    return _start(pages, take, checkpoint or f"{root}/checkpoints/rounds", trigger)
