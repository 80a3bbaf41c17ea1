"""Windows refreshed after late comments equal a whole replay; what is read and written."""

import random
from pathlib import Path

from conftest import comments_df
from pyspark.sql import functions as F

from burstwatch.operators import detect_patterns, explode_alerts
from burstwatch.params import DEFAULT
from burstwatch.plans import replay, replay_alerts, scored_windows
from burstwatch.plans.refresh import affected_windows, refresh_windows, refreshed, touched_windows
from burstwatch.sources import read_alerts, read_comments, read_window_metrics, store_comments, write_alerts, write_window_metrics

P = DEFAULT.with_(warmup=3, max_windows=4)


def rows(seed, n=700, days=20):
    r = random.Random(seed)
    out = []
    for i in range(n):
        burst = r.random() < 0.3
        s = 86400 * r.randint(0, days) + (600 * 7 + r.randint(0, 500) if burst else r.randint(0, 86399))
        out.append((f"c{i}", r.choice(["v1", "v2", "v3"]), f"a{r.randint(0, 3 if burst else 60)}", "t" * r.randint(0, 9), r.uniform(-1, 1), s))
    return out


def table(df):
    cols = ["video_id", "window_start", "total_comments", "unique_authors"]
    return sorted((*[r[c] for c in cols], round(r.avg_gap, 6), round(r.gap_variance, 2), round(r.avg_sentiment, 9),
                   round(r.coordination_score, 3)) for r in df.collect())


def test_equal_to_a_whole_replay(spark, tmp_path):
    every = rows(1)
    late = {i for i in range(0, 700, 90)} | {i for i, x in enumerate(every) if x[1] == "v2" and 86400 * 5 <= x[5] < 86400 * 5 + 6000}
    late |= {i for i, x in enumerate(every) if x[1] == "v3" and 86400 * 9 <= x[5] < 86400 * 11}  # whole windows
    late |= {max(range(700), key=lambda i: every[i][5]), min(range(700), key=lambda i: every[i][5])}
    c, w, a = (str(tmp_path / x) for x in ("c", "w", "a"))
    store_comments(spark, c, comments_df(spark, [x for i, x in enumerate(every) if i not in late]), keep_rows=False)
    first = read_comments(spark, c)
    write_window_metrics(spark, w, replay(first, P))
    write_alerts(explode_alerts(replay_alerts(first, P), P), a)
    added = store_comments(spark, c, comments_df(spark, [every[i] for i in sorted(late)] + every[:3]))
    for _ in range(2):  # again: nothing changes
        refresh_windows(spark, c, w, added, P, a)
        now = read_comments(spark, c)
        assert now.count() == 700
        assert table(read_window_metrics(spark, w)) == table(replay(now, P))
        keys = ["video_id", "window_start", "pattern", "coordination_score"]
        want = explode_alerts(detect_patterns(scored_windows(now, P), P), P).select(*keys)
        assert sorted(map(tuple, read_alerts(spark, a).select(*keys).collect())) == sorted(map(tuple, want.collect()))


def test_only_what_changes_is_touched(spark, tmp_path):
    c, w = str(tmp_path / "c"), str(tmp_path / "w")
    every = [(f"c{i}", v, "a", "t", 0.0, 86400 * (i // 4) + 3000 * (i % 4)) for v in ("v1", "v2") for i in range(120)]
    every = [(f"{x[1]}{x[0]}", *x[1:]) for x in every]
    store_comments(spark, c, comments_df(spark, every), keep_rows=False)
    write_window_metrics(spark, w, replay(read_comments(spark, c), P))
    before = {p.name: {f.name for f in p.glob("part-*")} for p in Path(w).glob("window_date=*")}
    added = store_comments(spark, c, comments_df(spark, [("late", "v1", "b", "t", 0.5, 86400 * 10 + 3100)]))
    some = affected_windows(read_window_metrics(spark, w), touched_windows(added, P), P)
    flags = {k: some.where(k).count() for k in ("measure", "before", "score")}
    assert flags == {"measure": 2, "before": 2, "score": 6} and some.where("video_id <> 'v1'").count() == 0
    assert refreshed(spark, c, read_window_metrics(spark, w), added, P).count() == 6
    refresh_windows(spark, c, w, added, P)
    after = {p.name: {f.name for f in p.glob("part-*")} for p in Path(w).glob("window_date=*")}
    changed = {d for d in after if after[d] != before.get(d)}
    assert changed == {"window_date=2024-01-11", "window_date=2024-01-12"}
    assert table(read_window_metrics(spark, w)) == table(replay(read_comments(spark, c), P))


def test_nothing_late(spark, tmp_path):
    c = comments_df(spark, [("c", "v", "a", "t", 0.0, 1)])
    refresh_windows(spark, str(tmp_path / "c"), str(tmp_path / "none"), c)
    write_window_metrics(spark, str(tmp_path / "w"), replay(c))
    refresh_windows(spark, str(tmp_path / "c"), str(tmp_path / "w"), c.limit(0))
    assert read_window_metrics(spark, str(tmp_path / "w")).count() == 1 == c.where(F.lit(True)).count()
