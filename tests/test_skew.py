"""A hot video: one key holding a third of all comments."""

import random
from collections import defaultdict

import pytest

from burstwatch.operators import window_metrics
from burstwatch.params import DEFAULT
from conftest import T0, comments_df

L = DEFAULT.window_seconds


def _fixture(seed: int = 7):
    rnd = random.Random(seed)
    rows, cid = [], 0
    # one hot video with a third of the rows, many cold videos with the rest
    for _ in range(3000):
        rows.append((f"c{cid:06d}", "hot", f"a{rnd.randrange(40)}", "x" * rnd.randrange(1, 30),
                     rnd.uniform(-1, 1), rnd.randrange(0, 40 * L)))
        cid += 1
    for _ in range(6000):
        rows.append((f"c{cid:06d}", f"v{rnd.randrange(60)}", f"a{rnd.randrange(500)}", "y" * rnd.randrange(1, 30),
                     rnd.uniform(-1, 1), rnd.randrange(0, 40 * L)))
        cid += 1
    return rows


def _brute_force(rows):
    """Video-scope gaps by a plain sort of each video's comments."""
    by_video = defaultdict(list)
    for cid, vid, aid, txt, sent, sec in rows:
        by_video[vid].append((sec, cid, aid, len(txt), sent))
    out = {}
    for vid, items in by_video.items():
        items.sort()
        prev = None
        wins = defaultdict(lambda: {"n": 0, "authors": set(), "gaps": []})
        for sec, cid, aid, ln, sent in items:
            w = wins[sec - sec % L]
            w["n"] += 1
            w["authors"].add(aid)
            if prev is not None:
                w["gaps"].append(sec - prev)
            prev = sec
        for start, w in wins.items():
            g = w["gaps"]
            mean = sum(g) / len(g) if g else 0.0
            var = max(0.0, sum(x * x for x in g) / len(g) - mean * mean) if g else 0.0
            out[(vid, start)] = (w["n"], len(w["authors"]), mean, var)
    return out


def test_hot_video_window_metrics_match_brute_force(spark):
    rows = _fixture()
    got = window_metrics(comments_df(spark, rows), DEFAULT).collect()
    want = _brute_force(rows)
    assert len(got) == len(want)
    for r in got:
        key = (r.video_id, int(r.window_start.timestamp() - T0.timestamp()))
        n, authors, mean, var = want[key]
        assert (r.total_comments, r.unique_authors) == (n, authors)
        assert r.avg_gap == pytest.approx(mean, rel=1e-9, abs=1e-9)
        assert r.gap_variance == pytest.approx(var, rel=1e-6, abs=1e-6)


def test_comment_level_order_is_split_by_window_not_by_video(spark):
    """The only analytic window over a whole video runs on the window table
    (lag of each window's last second); comment-level ordering is
    partitioned by (video, window), so a hot video is spread over tasks."""
    plan = window_metrics(comments_df(spark, _fixture()), DEFAULT)._jdf.queryExecution() \
        .executedPlan().toString()
    windows = [ln for ln in plan.splitlines() if "windowspecdefinition" in ln]
    assert any("lag(_sec" in ln for ln in windows) and any("lag(_last" in ln for ln in windows)
    for ln in windows:
        if "lag(_sec" in ln:
            assert "windowspecdefinition(video_id#" in ln and "_w#" in ln.split("windowspecdefinition(")[1]
        if "lag(_last" in ln:
            spec = ln.split("windowspecdefinition(")[1]
            assert spec.startswith("video_id#") and "_sec" not in spec


def test_hot_group_mean_cosine_matches_all_pairs(spark):
    """Closed form (no pair join) on one group holding most of the vectors."""
    import numpy as np

    from burstwatch.operators.text import mean_pairwise_cosine

    rng = np.random.default_rng(3)
    sizes = {"hot": 1500, "a": 2, "b": 7, "c": 1}
    rows, mats = [], {}
    for g, n in sizes.items():
        m = rng.normal(size=(n, 16)) + 0.3
        mats[g] = m
        rows += [(g, [float(x) for x in v]) for v in m]
    out = {r.g: r.similarity for r in mean_pairwise_cosine(
        spark.createDataFrame(rows, "g string, v array<double>"), ["g"], "v", None).collect()}
    for g, m in mats.items():
        n = len(m)
        if n < 2:
            assert out[g] == 0.0
            continue
        u = m / np.linalg.norm(m, axis=1, keepdims=True)
        cos = u @ u.T
        want = (cos.sum() - np.trace(cos)) / (n * (n - 1))
        assert out[g] == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_gaps_of_one_hot_video_are_split(spark):
    """A video of a whole year: no task of the ordered seconds holds much more than its
    share, and gaps equal those of a plain walk."""
    from pyspark.sql import functions as F

    from burstwatch.operators import window_metrics_between, with_gaps
    from burstwatch.schemas import COMMENTS

    year = spark.range(40_000).select(
        F.col("id").cast("string").alias("comment_id"), F.lit("v").alias("video_id"), F.lit("a").alias("author_id"),
        F.lit("t").alias("text"), F.lit(0.0).alias("sentiment"),
        F.timestamp_seconds(F.pmod(F.col("id") * 7919, F.lit(365 * 864)) * 100).alias("published_at"),
        F.lit("2024-01-01").cast("timestamp").alias("fetched_at")).select(*COMMENTS.names)
    rows = sorted((r.s, r.comment_id) for r in year.select(F.unix_seconds("published_at").alias("s"), "comment_id").collect())
    want = {c: (s - rows[k - 1][0] if k else None) for k, (s, c) in enumerate(rows)}
    got = {r.comment_id: r.gap for r in with_gaps(year).collect()}
    assert got == want
    m = window_metrics_between(year, "1970-01-01", "1971-01-01").first()
    gaps = [g for g in want.values() if g is not None]
    mean = sum(gaps) / len(gaps)
    assert m.total_comments == 40_000 and abs(m.avg_gap - mean) < 1e-9
    assert abs(m.gap_variance - (sum(g * g for g in gaps) / len(gaps) - mean * mean)) < 1e-3
    plan = window_metrics_between(year, "1970-01-01", "1971-01-01")._jdf.queryExecution().optimizedPlan().toString()
    assert "_part" in plan  # seconds are ordered per part of the interval


def test_model_batches_hold_texts_of_about_one_length(spark):
    from pyspark.sql import functions as F

    from burstwatch.operators.sentiment import by_length, model_scorer, with_sentiment

    df = spark.range(4_000).select("id", F.expr("repeat('x', CAST(pmod(id * 7919, 997) AS int))").alias("text")).repartition(4)

    def padding(some):
        lengths = [len(r.text) for r in some.collect()]
        batches = [lengths[k:k + 32] for k in range(0, len(lengths), 32)]
        return sum(max(b) * len(b) - sum(b) for b in batches) / sum(lengths)

    assert padding(by_length(df, partitions=4)) < 0.05 < 0.5 < padding(df)

    def make():
        return lambda texts: [{"label": "POSITIVE", "score": (len(t) % 50) / 100 + 0.5} for t in texts]

    one, two = (with_sentiment(df, scorer=model_scorer(make), length_batches=b).select("id", "sentiment") for b in (False, True))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
