"""Live windows between two polls.

Every micro-batch of landed pages is a poll. Its window is the closed interval from the
poll before to this one, the same for all videos and aligned to nothing; a comment of
the very second of a poll is in both windows. The measures are taken from the comment
store, so comments that were fetched late but published inside count; a video without
comments in the interval has no window and its baseline stays as it is.

All that a poll decides is kept by the number of its micro-batch: its interval under
``polls/``, the baseline after it under ``baseline/``. A micro-batch that is run again
after a kill reads the same interval and the baseline of the poll before, and writes the
same rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstwatch.operators.baseline import coordination_score, z_columns
from burstwatch.operators.patterns import detect_patterns, explode_alerts
from burstwatch.operators.text import first_n
from burstwatch.operators.windows import window_metrics_between
from burstwatch.params import DEFAULT, Params
from burstwatch.plans.ingest import ingest_comments
from burstwatch.plans.replay import replay, replay_alerts
from burstwatch.schemas import COMMENTS, MEASURES
from burstwatch.session import cut_lineage, remove_path, scratch_tables
from burstwatch.sources.key_index import folder_names
from burstwatch.sources.tables import read_comments, table_exists, write_alerts, write_window_metrics
from burstwatch.streaming.pipeline import SEED, _start, initial_state

_POLL = "start_sec long, end_sec long"
_HISTORY = [f.name for f in SEED.fields if f.name != "last_sec"]


def _seconds(at: datetime) -> int:
    return int(at.timestamp())


def scored_interval(comments: DataFrame, baseline: DataFrame, start_sec: int, end_sec: int,
                    params: Params = DEFAULT) -> DataFrame:
    """Scored windows of the closed interval, one for each video that has comments in it:
    measures, eight z columns against ``baseline`` (video_id, w_sec, measures: at most
    ``max_windows`` rows a video), and the score (null during warm-up)."""
    lo, hi = (datetime.fromtimestamp(s, timezone.utc) for s in (start_sec, end_sec))
    inside = comments.where(F.unix_seconds("published_at").between(start_sec, end_sec))
    found = window_metrics_between(inside, lo, hi).where("total_comments > 0")
    earlier = baseline.groupBy("video_id").agg(F.collect_list(F.struct(*MEASURES)).alias("hist"))
    both = found.join(earlier.withColumnRenamed("video_id", "_v"), F.col("video_id").eqNullSafe(F.col("_v")), "left") \
        .withColumn("hist", F.coalesce("hist", F.array().cast(earlier.schema["hist"].dataType)))
    return coordination_score(both.select("video_id", "window_start", *MEASURES, *z_columns("hist", params)), params)


def advanced(baseline: DataFrame, scored: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The baseline with the windows of a poll: the last ``max_windows`` of each video."""
    new = scored.select("video_id", F.unix_seconds("window_start").alias("w_sec"), *MEASURES)
    return first_n(baseline.select(*_HISTORY).unionByName(new.select(*_HISTORY)), ["video_id"],
                   [F.desc("w_sec")], params.max_windows).select(*_HISTORY)


class Polls:
    """Intervals and baselines of the polls under ``root``."""

    def __init__(self, spark: SparkSession, root: str, params: Params):
        self.spark, self.root, self.params = spark, root, params

    def _done(self, kind: str, name) -> bool:
        return str(name) in folder_names(self.spark, f"{self.root}/{kind}", done=True)

    def interval(self, poll: int, now: Callable[[int], datetime]) -> tuple[int, int]:
        """(start, end) of a poll in seconds; decided once."""
        path = f"{self.root}/polls/{poll}"
        if not self._done("polls", poll):
            start = self._read(poll - 1)[1]
            end = max(start, _seconds(now(poll)))
            self.spark.createDataFrame([(start, end)], _POLL).coalesce(1).write.mode("overwrite").parquet(path)
        return self._read(poll)

    def _read(self, poll: int) -> tuple[int, int]:
        r = self.spark.read.schema(_POLL).parquet(f"{self.root}/polls/{poll}").first()
        return r.start_sec, r.end_sec

    def baseline(self, poll: int) -> DataFrame:
        return self.spark.read.schema(SEED).parquet(f"{self.root}/baseline/{poll}")

    def begin(self, comments: DataFrame, at: datetime) -> None:
        """The baseline of the history, and the end of what comes before the first poll."""
        if not self._done("polls", -1):
            initial_state(comments, self.params).write.mode("overwrite").parquet(f"{self.root}/baseline/-1")
            self.spark.createDataFrame([(_seconds(at), _seconds(at))], _POLL).coalesce(1) \
                .write.mode("overwrite").parquet(f"{self.root}/polls/-1")

    def advance(self, poll: int, scored: DataFrame) -> None:
        after = advanced(self.baseline(poll - 1), scored, self.params)
        after.withColumn("last_sec", F.lit(None).cast("long")).write.mode("overwrite").parquet(f"{self.root}/baseline/{poll}")
        for old in folder_names(self.spark, f"{self.root}/baseline"):
            if int(old) < poll - 1:
                remove_path(self.spark, f"{self.root}/baseline/{old}")


def _now(poll: int) -> datetime:
    return datetime.now(timezone.utc)


def poll_pipeline(spark: SparkSession, history_pages: DataFrame | None, live_pages: DataFrame, root: str,
                  params: Params = DEFAULT, scorer=None, fetched_at=None, trigger: dict | None = None,
                  now: Callable[[int], datetime] = _now):
    """Backfill ``history_pages`` (None: no history), then take every micro-batch of
    ``live_pages`` as a poll; tables as in ``live_pipeline``: ``comments``, ``windows``,
    ``alerts``. ``now`` (number of the poll -> time; -1 is the start) is the clock.
    Called again on the same ``root`` it goes on after the last poll. Returns the
    started query.

    A poll reads the dates of the store that its interval touches, and of each video at
    most ``max_windows`` windows."""
    path, polls = f"{root}/comments", Polls(spark, root, params)

    def stored(start=None, end=None) -> DataFrame:
        if not table_exists(spark, path):
            return spark.createDataFrame([], COMMENTS)
        return read_comments(spark, path, start=start, end=end)

    if "-1" not in folder_names(spark, f"{root}/polls", done=True):
        if history_pages is not None:
            ingest_comments(spark, history_pages, path, scorer, params, fetched_at, keep_rows=False)
        write_window_metrics(spark, f"{root}/windows", replay(stored(), params))
        write_alerts(explode_alerts(replay_alerts(stored(), params), params), f"{root}/alerts")
        polls.begin(stored(), now(-1))

    def poll(batch: DataFrame, number: int) -> None:
        start, end = polls.interval(number, now)
        ingest_comments(spark, batch, path, scorer, params, fetched_at, keep_rows=False)
        lo, hi = (datetime.fromtimestamp(s, timezone.utc) for s in (start, end))
        with scratch_tables(spark):
            scored = cut_lineage(scored_interval(stored(lo, hi), polls.baseline(number - 1), start, end, params))
            if not scored.isEmpty():
                write_window_metrics(spark, f"{root}/windows", scored)
                write_alerts(explode_alerts(detect_patterns(scored, params), params), f"{root}/alerts")
            polls.advance(number, scored)

    return _start(live_pages, poll, f"{root}/checkpoints/polls", trigger)
