"""Many closed intervals against plain loops."""

import random

import pytest
from conftest import T0, at
from pyspark.sql import functions as F

from burstwatch.operators import window_metrics_between
from burstwatch.operators.intervals import comments_of_intervals, interval_metrics, interval_timeline
from burstwatch.schemas import COMMENTS
from pyspark.sql import types as T

ROWS = [(f"c{i}", "v1" if i % 3 else "v2", f"a{i % 4}" if i % 5 else None, "x" * (i % 9), (i % 7) / 7, s)
        for i, s in enumerate([-10**9, -65, -64, -1, 0, 0, 1, 63, 64, 65, 127, 128, 4095, 4096, *range(5000, 5300, 7), 10**6, 10**9])]


def comments(spark):
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in COMMENTS.fields])
    rows = [(c, v, a, t, s, at(x), at(x)) for c, v, a, t, s, x in ROWS]
    return spark.createDataFrame(rows + [("n", None, "a", "no video", 0.5, at(64), at(64))], nullable)


def some_intervals():
    r = random.Random(4)
    out = [("all", "v1", -10**9, 10**9), ("one", "v1", 64, 64), ("none", "v1", 300, 4000), ("back", "v1", 100, 50),
           ("null", None, 0, 100), ("other", "v9", 0, 10**6), ("edge", "v2", -64, 63)]
    for k in range(300):
        lo = r.choice([r.randint(-70, 200), r.randint(4000, 5400), r.randint(-10**6, 10**6)])
        out.append((f"i{k}", r.choice(["v1", "v2"]), lo, lo + r.choice([0, 1, 63, 64, 65, 300, 5000, 10**6])))
    return out


def frame(spark, intervals):
    return spark.createDataFrame([(i, v, at(a), at(b)) for i, v, a, b in intervals],
                                 "interval_id string, video_id string, start_at timestamp, end_at timestamp")


def test_evidence_and_measures_of_each_interval(spark):
    c, intervals = comments(spark), some_intervals()
    every = [*ROWS, ("n", None, "a", "no video", 0.5, 64)]
    want = {i: sorted((x[5], x[0]) for x in every if x[1] == v and a <= x[5] <= b) for i, v, a, b in intervals}
    met = comments_of_intervals(c, frame(spark, intervals))
    got: dict = {i: [] for i in want}
    for r in met.select("interval_id", "comment_id", F.unix_seconds("published_at").alias("s")).collect():
        got[r.interval_id].append((r.s - int(T0.timestamp()), r.comment_id))
    assert {k: sorted(v) for k, v in got.items()} == want
    first = {}
    for r in interval_timeline(c, frame(spark, intervals), limit=3).collect():
        first.setdefault(r.interval_id, {})[r["rank"]] = r.comment_id
    assert {k: [v[n + 1] for n in range(len(v))] for k, v in first.items()} == {k: [x for _, x in v[:3]] for k, v in want.items() if v}
    measured = {r.interval_id: r for r in interval_metrics(c, frame(spark, intervals)).collect()}
    assert len(measured) == len(intervals) and {k: r.total_comments for k, r in measured.items()} == {k: len(v) for k, v in want.items()}
    for i, v, a, b in intervals[:3] + intervals[6:18]:
        one = window_metrics_between(c.where(F.col("video_id") == v), at(a), at(b), videos=[v]).first()
        for x in ("total_comments", "unique_authors", "avg_length", "avg_sentiment", "avg_gap"):
            assert getattr(measured[i], x) == pytest.approx(getattr(one, x)), (i, x)
        assert measured[i].gap_variance == pytest.approx(one.gap_variance, rel=1e-6, abs=1e-3)


def test_the_join_is_an_equi_join(spark):
    plan = comments_of_intervals(comments(spark), frame(spark, some_intervals()))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_intervals(spark):
    none = frame(spark, some_intervals()).limit(0)
    assert interval_metrics(comments(spark), none).count() == 0 and comments_of_intervals(comments(spark), none).count() == 0


def test_overlaps_multiply_segments_not_comments(spark, monkeypatch):
    from burstwatch.operators import intervals as I

    rows = [(f"c{i:04}", "v1", f"a{i % 30}", "x", 0.5, at(i // 2), at(i // 2)) for i in range(4_000)]
    c = spark.createDataFrame(rows, COMMENTS)
    many = frame(spark, [(f"i{k}", "v1", 10 * k, 3_000) for k in range(20)])
    met, join = [], I.interval_join

    def counted(rows, *args):
        met.append(rows.count())
        return join(rows, *args)

    monkeypatch.setattr(I, "interval_join", counted)
    first = I.interval_timeline(c, many, limit=3).collect()
    assert len(first) == 60 and {r.comment_id for r in first if r.interval_id == "i2"} == {"c0040", "c0041", "c0042"}
    measured = {r.interval_id: r for r in I.interval_metrics(c, many).collect()}
    assert all(measured[f"i{k}"].total_comments == 4_000 - 20 * k and measured[f"i{k}"].unique_authors == 30 for k in range(20))
    assert len(met) == 3 and max(met) <= 100  # 20 segments


def test_an_author_counts_once_in_each_interval(spark):
    r = random.Random(7)
    rows = [(f"c{i}", "v1", r.choice([None, "a", "b", "c", "d"]), "x", 0.5, at(s), at(s))
            for i, s in enumerate(r.randint(0, 40_000) for _ in range(300))]
    c = spark.createDataFrame(rows, T.StructType([T.StructField(f.name, f.dataType) for f in COMMENTS.fields]))
    spans = [(f"i{k}", "v1", lo, lo + r.randint(0, 9_000)) for k, lo in enumerate(r.randint(0, 40_000) for _ in range(60))]
    got = {x.interval_id: x.unique_authors for x in interval_metrics(c, frame(spark, spans)).collect()}
    assert got == {i: len({x[2] for x in rows if at(a) <= x[5] <= at(b)} - {None}) for i, _, a, b in spans}
