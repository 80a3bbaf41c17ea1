"""The live plan over restarts, and windows between polls."""

import json
from datetime import timedelta, timezone

import pytest
from conftest import T0, comments_df
from pyspark.sql import functions as F

from burstwatch.operators import window_metrics_between
from burstwatch.params import DEFAULT
from burstwatch.plans import live as L
from burstwatch.plans import replay
from burstwatch.plans.live import live_pipeline
from burstwatch.sources import pages_from_json, read_comments, read_window_metrics, stream_comment_pages
from burstwatch.streaming.polling import poll_pipeline

P = DEFAULT.with_(warmup=3)
END = "2030-01-01 00:00:00"


def rows(lo, hi, videos=("v1", "v2")):
    return [(f"{v}-{i}", v, f"a{i % 5}", f"text {i % 7} good", 0.0, 137 * i) for v in videos for i in range(lo, hi)]


def page(some):
    return [{"video_id": v, "items": [
        {"id": c, "snippet": {"topLevelComment": {"snippet": {"authorChannelId": {"value": a}, "textOriginal": t, "publishedAt":
         (T0 + timedelta(seconds=s)).strftime("%Y-%m-%dT%H:%M:%SZ")}}}} for c, w, a, t, _, s in some if w == v]}
        for v in sorted({r[1] for r in some})]


def land(root, name, some):
    root.mkdir(exist_ok=True)
    (root / name).write_text("\n".join(json.dumps(p) for p in page(some)))


def held(spark, some):
    data = [(p["video_id"], json.dumps({"items": p["items"]})) for p in page(some)]
    return pages_from_json(spark.createDataFrame(data, "video_id string, page_json string"))


def start(spark, tmp_path, history, closing=None):
    queries = live_pipeline(spark, history, stream_comment_pages(spark, str(tmp_path / "landed"), multi_line=False),
                            str(tmp_path / "root"), P, "1 hour", fetched_at="2024-02-01 00:00:00", closing_at=closing,
                            trigger={"availableNow": True})
    for q in queries:
        q.awaitTermination()


def windows(df):
    return sorted((r.video_id, r.window_start, r.total_comments, r.unique_authors, round(r.avg_length, 6), round(r.avg_gap, 6),
                   round(r.gap_variance, 3), r.coordination_score and round(r.coordination_score, 3)) for r in df.collect())


def whole(spark, tmp_path):
    """A replay of the store; in its warm-up the live score is null, the replayed one 0."""
    return windows(replay(read_comments(spark, str(tmp_path / "root/comments")), P))


def same(live, full):
    assert [r[:7] for r in live] == [r[:7] for r in full]
    assert all(a[7] == b[7] or (a[7] is None and b[7] == 0) for a, b in zip(live, full))


def test_restarts_equal_a_replay(spark, tmp_path):
    """Two starts, the second with overlapping pages; the first dies between store and
    feed. A video that was quiet for years keeps only its own window open."""
    old = [("q-1", "quiet", "a", "long ago", 0.0, -5 * 365 * 86400)]
    history = held(spark, old + rows(0, 60))
    land(tmp_path / "landed", "p1.json", rows(50, 90))
    follow, calls = L.feed_writer, []

    def dying(*args):
        write = follow(*args)

        def run(some, token):
            calls.append(token)
            if len(calls) == 1:
                raise RuntimeError("killed")
            write(some, token)

        return run

    L.feed_writer = dying
    try:
        with pytest.raises(Exception):
            start(spark, tmp_path, history)
        plan = L.backfill(spark, None, str(tmp_path / "root"), P)
        assert plan.carried.count() < 15 and plan.carried.where("video_id = 'quiet'").count() == 1
        start(spark, tmp_path, history)
    finally:
        L.feed_writer = follow
    land(tmp_path / "landed", "p2.json", rows(85, 130) + rows(100, 130, ("new",)))
    start(spark, tmp_path, None, END)
    got = read_window_metrics(spark, str(tmp_path / "root/windows"))
    assert read_comments(spark, str(tmp_path / "root/comments")).count() == 1 + 2 * 130 + 30
    same(windows(got), whole(spark, tmp_path))
    with pytest.raises(ValueError):
        live_pipeline(spark, None, None, str(tmp_path / "root"), closing_at=END)


def test_start_without_history(spark, tmp_path):
    land(tmp_path / "landed", "p1.json", rows(0, 70))
    start(spark, tmp_path, None, END)
    same(windows(read_window_metrics(spark, str(tmp_path / "root/windows"))), whole(spark, tmp_path))


@pytest.mark.parametrize("with_history", [True, False])
def test_windows_between_polls(spark, tmp_path, with_history):
    """Unaligned closed intervals, equal to the batch measures of the same intervals; a
    quiet poll leaves nothing; a poll that dies is the same poll when it runs again."""
    root = str(tmp_path / "root")
    bounds = [8000, 9111, 9111 + 137, 9500, 13000]  # a comment at 9179 + 137k; one poll of one second's width of gaps
    at = {k - 1: T0 + timedelta(seconds=s) for k, s in enumerate(bounds)}
    landed = tmp_path / "landed"
    history = held(spark, rows(0, 58)) if with_history else None
    for k in range(1, len(bounds)):
        new = [r for r in rows(0, 200) if bounds[k - 1] - 300 <= r[5] <= bounds[k] and (k != 3 or r[1] == "v1")]
        land(landed, f"p{k}.json", new)
    died = []

    def now(poll):
        if poll == 2 and not died:
            died.append(poll)
            raise RuntimeError("killed")
        return at[poll].astimezone(timezone.utc)

    for attempt in range(2):
        pages = stream_comment_pages(spark, str(landed), max_files_per_trigger=1, multi_line=False)
        q = poll_pipeline(spark, history, pages, root, P, fetched_at="2024-02-01 00:00:00", trigger={"availableNow": True}, now=now)
        if attempt == 0:
            with pytest.raises(Exception):
                q.awaitTermination()
        else:
            q.awaitTermination()
    stored = read_comments(spark, f"{root}/comments")
    got = read_window_metrics(spark, f"{root}/windows")
    if with_history:
        before = replay(stored.where(F.col("published_at") <= F.lit(T0 + timedelta(seconds=137 * 57))), P)
        keys = ["video_id", "window_start"]
        assert got.join(before.select(*keys), keys, "left_semi").count() == before.count()
        got = got.join(before.select(*keys), keys, "left_anti")
    want = []
    for k, (a, b) in enumerate(zip(bounds, bounds[1:]), 1):
        lo, hi = T0 + timedelta(seconds=a), T0 + timedelta(seconds=b)
        # v2's comments of the third interval land with the fourth poll: too late for both
        landed_by_then = stored.where("video_id = 'v1'") if k == 3 else stored
        want += [r[:7] for r in windows(window_metrics_between(landed_by_then, lo, hi).where("total_comments > 0")
                                        .withColumn("coordination_score", F.lit(None).cast("double")))]
    assert want and [r[:7] for r in windows(got)] == sorted(want)
    scores = [r.coordination_score for r in got.collect()]
    assert sum(s is not None for s in scores) == (7 if with_history else 1)


def test_polls_of_the_query_land_in_many_files(spark, tmp_path, monkeypatch):
    """Each poll's pages are written by as many tasks as made them; three polls remain."""
    import __spark_entry__ as entry

    key, root = "spark.sql.adaptive.coalescePartitions.enabled", tmp_path / "root"
    monkeypatch.setattr(entry, "_table_root", lambda *_: str(root))
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        assert entry.queries()["poll_windows"](spark, "/root/testdata/sf0.001").count() > 0
    finally:
        spark.conf.set(key, before)
    assert len(list((root / "landed").glob("part-*"))) > 3
    assert {p.name for p in (root / "tables/polls").iterdir()} == {"-1", "0", "1", "2"}
