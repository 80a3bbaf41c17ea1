"""Physical-plan properties the design relies on at scale (read from explain)."""

from pyspark.sql import functions as F

from burstwatch.params import SIX_HOURS
from burstwatch.plans import alert_context, replay
from burstwatch.sources import load_comments, load_table
from burstwatch.operators.text import first_n, top_keywords

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_video_filter_on_replay_output_reaches_the_scan(spark):
    out = replay(load_comments(spark, SF), SIX_HOURS).filter(F.col("video_id") == "click")
    plan = _formatted(out)
    # pushed through the per-video windows and aggregations to every scan
    scans = [ln for ln in plan.splitlines() if ln.strip().startswith("PushedFilters:")]
    assert scans and all("EqualTo(event_type,click)" in ln for ln in scans)


def test_keyword_scan_is_pruned_to_used_columns(spark):
    docs = load_table(spark, SF, "documents")
    plan = _formatted(top_keywords(docs, ["source"], "doc_id", "text", 3))
    for line in plan.splitlines():
        if line.strip().startswith("ReadSchema:"):
            assert "lang" not in line and "n_chars" not in line


def test_alert_keys_are_broadcast_after_a_size_check(spark):
    alerts, _ = alert_context(load_comments(spark, SF), SIX_HOURS)
    from burstwatch.operators.evidence import alert_comments

    joined = alert_comments(load_comments(spark, SF), alerts, SIX_HOURS, max_broadcast_bytes=10_000)
    assert "BroadcastHashJoin" in _plan(joined)
    # above the bound the planner is left to choose (no forced broadcast hint)
    big = alert_comments(load_comments(spark, SF), alerts, SIX_HOURS, max_broadcast_bytes=-1)
    assert "broadcast" not in big._jdf.queryExecution().logical().toString().lower()


def test_first_n_limits_each_group_before_the_shuffle(spark):
    c = load_comments(spark, SF)
    out = first_n(c, ["video_id"], ["published_at", "comment_id"], 3)
    plan = _formatted(out)
    # a partial WindowGroupLimit runs below the exchange: a hot video ships
    # at most n rows per input task
    assert plan.count("WindowGroupLimit") >= 2
    assert out.count() == 3 * c.select("video_id").distinct().count()


def test_read_comments_prunes_dates_and_pushes_video(spark, tmp_path):
    from burstwatch.sources import read_comments, write_comments

    path = str(tmp_path / "comments")
    write_comments(load_comments(spark, SF), path)
    df = read_comments(spark, path, video_id="click", start="2024-01-10 00:00:00",
                       end="2024-01-12 00:00:00")
    plan = _formatted(df)
    parts = [ln for ln in plan.splitlines() if ln.strip().startswith("PartitionFilters:")]
    pushed = [ln for ln in plan.splitlines() if ln.strip().startswith("PushedFilters:")]
    assert parts and "published_date" in parts[0]
    assert pushed and "EqualTo(video_id,click)" in pushed[0]
    assert df.count() > 0


def test_window_metrics_scan_the_comments_once(spark):
    from burstwatch.operators import window_metrics, with_gaps

    plan = _formatted(window_metrics(load_comments(spark, SF), SIX_HOURS))
    tree = plan.split("\n\n")[0]
    assert "SortAggregate" not in tree
    out = window_metrics(load_comments(spark, SF), SIX_HOURS)
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in final.split("== Initial Plan ==")[0]
    gaps = with_gaps(load_comments(spark, SF), params=SIX_HOURS)
    gaps.collect()
    ran = gaps._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # the comments, and once their seconds, whose exchange is used again for the window edges
    assert "SortAggregate" not in ran and ran.count("FileScan parquet") <= 2


def test_marks_are_one_hash_aggregation_of_the_comments(spark):
    from burstwatch.sources import delta_since, high_water_marks

    c = load_comments(spark, SF)
    marks = high_water_marks(c)
    tree = _formatted(marks).split("\n\n")[0]
    assert "BroadcastHashJoin" in tree
    delta = _formatted(delta_since(c, marks)).split("\n\n")[0]
    assert "BroadcastHashJoin" in delta and "SortMergeJoin" not in delta
