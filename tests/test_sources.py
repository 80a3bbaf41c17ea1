"""Pages, parsing, timestamps, dedup, upsert and the parquet sinks."""

import json
import tempfile
from pathlib import Path

from pyspark.sql import functions as F

from burstwatch.sources import (
    append_ignore_duplicates, dedupe_batch, delta_since, high_water_marks,
    insert_ignore_duplicates, parse_comments, quarantined_items, read_comment_pages,
    read_comments, store_comments, upsert_window_metrics, write_window_metrics,
)
from burstwatch.plans import replay
from conftest import comments_df


def _item(cid, author, text, published, snippet=True):
    if not snippet:
        return {"id": cid}
    sn = {"textOriginal": text, "publishedAt": published}
    if author is not None:
        sn["authorChannelId"] = {"value": author}
    return {"id": cid, "snippet": {"topLevelComment": {"snippet": sn}}}


def test_dirty_pages(spark):
    root = Path(tempfile.mkdtemp(prefix="pages-", dir="/tmp"))
    (root / "video_id=vidA").mkdir()
    page = {"nextPageToken": "p2", "items": [
        _item("c1", "auth1", "hello", "2024-01-01T00:00:05Z"),
        _item("c2", None, "no author", "2024-01-01T00:00:06.9Z"),
        _item("c3", "auth3", None, "2024-01-01T02:00:07+02:00"),
        _item("c4", "auth4", "x", "yesterday-ish"),
        _item("c5", None, None, None, snippet=False),
        {"snippet": {"topLevelComment": {"snippet": {"textOriginal": "no id",
                                                    "publishedAt": "2024-01-01 00:00:09"}}}},
    ]}
    (root / "video_id=vidA" / "p1.json").write_text(json.dumps(page, indent=2))
    pages = read_comment_pages(spark, str(root))
    got = {r.comment_id: r for r in parse_comments(pages, fetched_at="2024-02-01 00:00:00").collect()}
    assert set(got) == {"c1", "c2", "c3"}
    assert got["c2"].author_id is None and got["c3"].text == ""
    assert got["c2"].published_at.isoformat().startswith("2024-01-01T00:00:06")
    assert got["c3"].published_at.isoformat().startswith("2024-01-01T00:00:07")
    assert all(r.video_id == "vidA" for r in got.values())
    bad = {(r.comment_id, r.reason, r.published_raw) for r in quarantined_items(pages).collect()}
    assert bad == {("c4", "bad_published_at", "yesterday-ish"), (None, "missing_id", "2024-01-01 00:00:09")}


def test_dedupe_and_insert_twice_is_once(spark):
    rows = [("c1", "v", "a", "first", 0.1, 10), ("c2", "v", "b", "x", 0.2, 20)]
    existing = comments_df(spark, rows[:1])
    batch = comments_df(spark, rows + [("c2", "v", "b", "x", 0.2, 20)])
    batch = batch.unionByName(batch.filter("comment_id = 'c2'")
                              .withColumn("fetched_at", F.col("fetched_at") + F.expr("INTERVAL 1 DAY"))
                              .withColumn("text", F.lit("refetched")))
    assert dedupe_batch(batch).count() == 2
    new = append_ignore_duplicates(existing, batch).collect()
    assert [(r.comment_id, r.text) for r in new] == [("c2", "x")]
    once = insert_ignore_duplicates(existing, batch)
    twice = insert_ignore_duplicates(once, batch)
    assert sorted(r.comment_id for r in twice.collect()) == ["c1", "c2"]


def test_marks_and_delta(spark):
    c = comments_df(spark, [("c1", "v", "a", "", 0.0, 10), ("c2", "v", "a", "", 0.0, 10),
                            ("c3", "v", "a", "", 0.0, 5), ("c9", "w", "a", "", 0.0, 1)])
    marks = high_water_marks(c.filter("comment_id != 'c9'"))
    m = marks.collect()
    assert [(r.video_id, r.mark_id) for r in m] == [("v", "c2")]
    items = comments_df(spark, [("c2", "v", "a", "", 0.0, 10), ("c4", "v", "a", "", 0.0, 10),
                                ("c5", "v", "a", "", 0.0, 11), ("c1", "v", "a", "", 0.0, 10),
                                ("c9", "w", "a", "", 0.0, 1)])
    assert sorted(r.comment_id for r in delta_since(items, marks).collect()) == ["c4", "c5", "c9"]


def test_upsert_twice_is_once(spark):
    rows = [(f"c{i}", "v", f"a{i % 3}", "t", 0.1 * (i % 5), 37 * i) for i in range(400)]
    c = comments_df(spark, rows)
    old = replay(c.filter("published_at < '2024-01-01 01:30:00'"))
    new = replay(c.filter("published_at >= '2024-01-01 01:00:00'"))
    once = upsert_window_metrics(old, new)
    twice = upsert_window_metrics(once, new)
    assert sorted(once.collect()) == sorted(twice.collect())
    keys = [(r.video_id, r.window_start) for r in once.collect()]
    assert len(keys) == len(set(keys)) == replay(c).count()


def test_parquet_sinks_roundtrip(spark):
    root = tempfile.mkdtemp(prefix="tables-", dir="/tmp")
    rows = [(f"c{i}", "v", f"a{i % 4}", "t", 0.0, 61 * i) for i in range(300)]
    c = comments_df(spark, rows)
    added = store_comments(spark, f"{root}/comments", c.filter("comment_id < 'c2'"))
    assert added.count() > 0
    store_comments(spark, f"{root}/comments", c)           # overlaps: ignored
    stored = read_comments(spark, f"{root}/comments")
    assert stored.count() == 300
    part = read_comments(spark, f"{root}/comments", video_id="v",
                         start="2024-01-01 00:00:00", end="2024-01-01 01:00:00")
    assert part.count() == len([r for r in rows if r[5] <= 3600])
    write_window_metrics(spark, f"{root}/windows", replay(c.filter("published_at < '2024-01-01 02:00:00'")))
    write_window_metrics(spark, f"{root}/windows", replay(c))
    table = spark.read.parquet(f"{root}/windows").drop("window_date")
    assert sorted(table.collect()) == sorted(replay(c).collect())


def test_ingest_pages_twice_stores_once(spark, tmp_path):
    """Parse -> sentiment -> insert-or-ignore: blank text scores 0.0, a null
    author is kept, a bad item is left out, and a re-fetch adds nothing."""
    from burstwatch.plans import ingest_comments

    root = tmp_path / "landed"
    (root / "video_id=vidB").mkdir(parents=True)
    page = {"nextPageToken": None, "items": [
        _item("d1", "auth1", "great video, love it", "2024-01-01T00:00:05Z"),
        _item("d2", None, "   \t", "2024-01-01T00:00:06Z"),
        _item("d3", "auth3", "terrible", "2024-01-01T00:01:00Z"),
        _item("d4", "auth4", "x", "not a time"),
    ]}
    (root / "video_id=vidB" / "p1.json").write_text(json.dumps(page))
    table = str(tmp_path / "comments")
    pages = read_comment_pages(spark, str(root))
    added = ingest_comments(spark, pages, table, fetched_at="2024-02-01 00:00:00")
    assert added.count() == 3
    again = ingest_comments(spark, read_comment_pages(spark, str(root)), table,
                            fetched_at="2024-02-02 00:00:00")
    assert again.count() == 0
    got = {r.comment_id: r for r in read_comments(spark, table).collect()}
    assert set(got) == {"d1", "d2", "d3"}
    assert got["d2"].author_id is None and got["d2"].sentiment == 0.0
    assert got["d1"].sentiment > 0 > got["d3"].sentiment
    assert all(r.fetched_at.isoformat().startswith("2024-02-01") for r in got.values())


def test_one_id_at_two_times_is_one_row(spark):
    """The primary key is the id alone, whatever the time."""
    old = comments_df(spark, [("x", "v", "a", "first", 0.1, 0)])
    new = comments_df(spark, [("x", "v", "a", "again", 0.1, 4 * 86400), ("y", "v", "a", "", 0.0, 5)])
    assert sorted((r.comment_id, r.text) for r in insert_ignore_duplicates(old, new).collect()) == [
        ("x", "first"), ("y", "")]


def test_an_unreadable_table_raises_and_loses_nothing(spark, tmp_path):
    import pytest

    path = str(tmp_path / "windows")
    rows = [(f"c{i}", "v", f"a{i}", "t", 0.0, 700 * i) for i in range(5)]
    c = comments_df(spark, rows)
    write_window_metrics(spark, path, replay(c))
    part = next(Path(path).glob("window_date=*/part-*.parquet"))
    kept = part.read_bytes()
    part.write_bytes(b"PAR1 no footer")
    crc = part.with_name(f".{part.name}.crc")
    if crc.exists():
        crc.unlink()
    with pytest.raises(Exception):
        write_window_metrics(spark, path, replay(comments_df(spark, [("n", "w", "a", "t", 0.0, 10)])))
    part.write_bytes(kept)
    assert spark.read.parquet(path).count() == 5
    store_comments(spark, str(tmp_path / "comments"), c)
    # inserts read the index of the ids, and nothing else of the table
    for bad in (tmp_path / "comments-keys").glob("*/*/part-*.parquet"):
        bad.write_bytes(b"PAR1 no footer")
        crc = bad.with_name(f".{bad.name}.crc")
        if crc.exists():
            crc.unlink()
    with pytest.raises(Exception):
        store_comments(spark, str(tmp_path / "comments"), c)
    assert read_comments(spark, str(tmp_path / "comments")).count() == c.count()


def test_two_updates_of_one_key_are_one_row(spark):
    c = comments_df(spark, [("c1", "v", "a", "t", 0.0, 1), ("c2", "v", "b", "t", 0.0, 2)])
    whole, part = replay(c), replay(c.filter("comment_id = 'c1'"))
    both = part.unionByName(whole).withColumn("seq", F.monotonically_increasing_id())
    assert [r.total_comments for r in upsert_window_metrics(whole.limit(0), both).collect()] == [2]
    last = upsert_window_metrics(whole.limit(0), whole.withColumn("seq", F.lit(1)).unionByName(
        part.withColumn("seq", F.lit(2))), order_by="seq")
    assert [r.total_comments for r in last.collect()] == [1]


def test_broken_pages_are_quarantined_once(spark, tmp_path):
    from burstwatch.plans import ingest_comments
    from burstwatch.plans.ingest import quarantine_path
    from burstwatch.sources import pages_from_json, read_quarantine

    root = tmp_path / "landed" / "video_id=vidC"
    root.mkdir(parents=True)
    (root / "p1.json").write_text("{ this is no page")
    (root / "p2.json").write_text(json.dumps({"items": [_item("e1", "a", "fine", "20240105T100000Z"),
                                                        _item("e2", "a", "x", "late")]}))
    for _ in range(2):
        ingest_comments(spark, read_comment_pages(spark, str(tmp_path / "landed")), str(tmp_path / "t"))
    got = {(r.video_id, r.comment_id, r.published_raw, r.reason) for r in
           read_quarantine(spark, quarantine_path(str(tmp_path / "t"))).collect()}
    assert got == {("vidC", None, None, "bad_page"), ("vidC", "e2", "late", "bad_published_at")}
    assert read_quarantine(spark, quarantine_path(str(tmp_path / "t"))).count() == 2
    assert [r.comment_id for r in read_comments(spark, str(tmp_path / "t")).collect()] == ["e1"]
    held = spark.createDataFrame([("v", "nope"), ("v", json.dumps({"items": []}))], "video_id string, page_json string")
    assert [(r.text, r.reason) for r in quarantined_items(pages_from_json(held)).collect()] == [("nope", "bad_page")]


def test_iso_times_as_python_reads_them(spark):
    from datetime import datetime, timezone

    from burstwatch.functions.timefn import normalize_timestamp

    texts = ["2024-01-05T10:00:00+02", "20240105T100000Z", "20240105T100000+0230", "2024-01-05T10:00:00,25Z",
             "2024-01-05", "20240105", "2024-01-05T10", "2024-01-05T10:30-05:00", "2024-01-05 10:00:00.999",
             "20240105T1030", "2024-01-05T10:00:00-0330"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.unix_seconds(
        normalize_timestamp(F.col("t"))).alias("s")).collect()
    for r in got:
        d = datetime.fromisoformat(r.t)
        want = d if d.tzinfo else d.replace(tzinfo=timezone.utc)
        assert r.s == int(want.timestamp()), r.t
    bad = spark.createDataFrame([("soon",), ("2024-13-40T00:00:00Z",), ("",), (None,)], "t string")
    assert bad.select(normalize_timestamp(F.col("t")).alias("s")).where("s IS NOT NULL").count() == 0


def test_blank_means_what_python_strips(spark):
    from burstwatch.operators.sentiment import with_sentiment

    texts = ["\xa0\u3000", "\x1c \t\n", "", None, "\u2028\u205f\x85", "good\xa0", "\u200b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r.i: r.label for r in with_sentiment(df, keep_prediction=True).collect()}
    assert {i for i, label in got.items() if label is None} == {
        i for i, t in enumerate(texts) if not (t or "").strip()}


def test_alerts_written_twice_are_stored_once_with_z_values(spark, tmp_path):
    from burstwatch.operators import detect_patterns, explode_alerts
    from burstwatch.params import SIX_HOURS
    from burstwatch.plans import scored_windows
    from burstwatch.sources import load_comments, read_alerts, write_alerts

    a = explode_alerts(detect_patterns(scored_windows(load_comments(spark, "/root/testdata/sf0.01"), SIX_HOURS),
                                       SIX_HOURS), SIX_HOURS)
    path = str(tmp_path / "alerts")
    assert read_alerts(spark, path).count() == 0
    write_alerts(a, path)
    write_alerts(a.limit(4), path)
    write_alerts(a, path)
    stored = read_alerts(spark, path)
    assert stored.count() == a.count() > 0 and stored.where("gap_var_z IS NULL").count() == 0


def test_evidence_of_any_interval(spark):
    from burstwatch.operators.evidence import interval_comments, repeat_authors, window_timeline

    c = comments_df(spark, [(f"c{i}", "v", f"a{i % 2}", f"t{i}", 0.0, 10 * i) for i in range(30)])
    some = interval_comments(c, "2024-01-01 00:00:15", "2024-01-01 00:02:00")
    assert sorted(r.comment_id for r in some.collect()) == sorted(f"c{i}" for i in range(2, 13))
    assert [r.comment_id for r in window_timeline(some).orderBy("rank").collect()][:2] == ["c2", "c3"]
    assert {(r.author_id, r.comment_count) for r in repeat_authors(some).collect()} == {("a0", 6), ("a1", 5)}
