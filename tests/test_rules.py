"""Hand-worked checks of the baseline, score and alert rules."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from burstwatch.functions.stats import dampen, robust_z
from burstwatch.operators import detect_patterns, rolling_baseline, window_metrics
from burstwatch.params import DEFAULT
from burstwatch.plans import scored_windows

L = DEFAULT.window_seconds


def _ref_z(value, series, floor):
    if len(series) < 3:
        return 0
    med = statistics.median(series)
    mad = statistics.median([abs(x - med) for x in series]) * 1.4826
    mad = max(mad, floor)
    return max(-20.0, min(20.0, (value - med) / mad))


@pytest.mark.parametrize("value,series,floor", [
    (5.0, [1.0, 2.0, 3.0, 4.0], 0.1),          # even count median
    (100.0, [1.0, 1.0, 1.0, 1.0, 1.0], 2.0),   # MAD 0 -> floor, cap at 20
    (-100.0, [1.0, 1.0, 1.0], 2.0),            # cap at -20
    (3.0, [1.0, 2.0], 0.1),                    # fewer than 3 -> 0
    (0.3, [0.1, 0.5, 0.2, 0.9, 0.4], 0.05),
])
def test_robust_z_matches_definition(spark, value, series, floor):
    df = spark.createDataFrame([(value, series)], "v double, h array<double>")
    got = df.select(robust_z("v", "h", floor).alias("z")).first().z
    assert got == pytest.approx(_ref_z(value, series, floor), abs=1e-12)


def test_dampen_at_noise_floor_is_not_above(spark):
    df = spark.createDataFrame([(1.2,), (-1.3,), (0.5,)], "z double")
    got = [r.d for r in df.select(dampen(F.col("z")).alias("d")).collect()]
    assert got == pytest.approx([0.12, 1.3, 0.05])


def _windows(spec):
    """spec: list of (n_comments, n_authors, spacing_s, sentiment_fn, text) per window."""
    rows, cid = [], 0
    for i, (n, authors, spacing, sent, text) in enumerate(spec):
        for j in range(n):
            rows.append((f"c{cid:05d}", "v1", f"a{j % authors}", text, sent(i, j), i * L + j * spacing))
            cid += 1
    return rows


def test_warmup_ten_windows_then_scores(make_comments):
    rows = _windows([(3, 3, 60, lambda i, j: 0.1 * j, "x") for _ in range(11)])
    s = scored_windows(make_comments(rows)).orderBy("window_start").collect()
    assert len(s) == 11
    assert all(r.count_z is None and r.coordination_score is None for r in s[:10])
    assert s[10].count_z is not None and s[10].coordination_score is not None


def test_sparse_history_counts_non_empty_windows_only(make_comments):
    rows, cid = [], 0
    for k in range(12):
        for j in range(3):
            rows.append((f"c{cid}", "v1", f"a{j}", "x", 0.0, (3 * k) * L + j * 30))
            cid += 1
    s = scored_windows(make_comments(rows)).orderBy("window_start").collect()
    assert len(s) == 12                        # no gap filling
    assert [r.count_z is not None for r in s] == [False] * 10 + [True] * 2


def test_quiet_then_flood_fires_volume_and_spam(make_comments):
    spec = [(6, 6, 90, lambda i, j: 0.0, "hi") for _ in range(20)] + [(40, 6, 15, lambda i, j: 0.0, "hi")]
    alerts = detect_patterns(scored_windows(make_comments(_windows(spec)))).collect()
    assert len(alerts) == 1
    a = alerts[0]
    assert a.volume_anomaly and a.high_frequency_spam
    assert a.count_z == pytest.approx(17.0) and a.author_z == 0.0


def test_metronome_fires_timing_with_robotic_boost(make_comments):
    irregular = [0, 37, 81, 150, 211, 300, 377, 540]
    rows, cid = [], 0
    for i in range(20):
        offs = [(o * (i + 3)) % 540 for o in irregular[:-1]] + [540]
        for j, o in enumerate(sorted(set(offs))):
            rows.append((f"c{cid:04d}", "v1", f"a{j}", "t", 0.0, i * L + o))
            cid += 1
    for j in range(8):
        rows.append((f"c{cid:04d}", "v1", f"a{j}", "t", 0.0, 20 * L + 60 * j))
        cid += 1
    s = scored_windows(make_comments(rows)).orderBy("window_start").collect()
    last = s[-1]
    assert last.avg_gap == pytest.approx(60.0) and last.gap_variance == 0.0
    assert last.gap_var_z < -2.0
    alerts = detect_patterns(scored_windows(make_comments(rows))).collect()
    final = [a for a in alerts if a.window_start == last.window_start]
    assert len(final) == 1 and final[0].automated_timing

    def d(z):
        return abs(z) if abs(z) > 1.2 else abs(z) * 0.1

    expected = round(d(last.concentration_z) * 0.4 + d(last.gap_var_z) * 1.5 * 0.3
                     + d(last.sentiment_var_z) * 0.2 + d(last.count_z) * 0.1, 4)
    assert last.coordination_score == pytest.approx(expected, abs=1e-4)


def test_scripted_sentiment_fires_coordinated_sentiment(make_comments):
    mixed = [-0.8, 0.6, -0.2, 0.4, 0.1, -0.5]
    spec = [(6, 6, 60, lambda i, j: mixed[(i + j) % 6] + 0.01 * i, f"comment {i}") for i in range(20)]
    spec.append((6, 6, 60, lambda i, j: 0.9, "buy now the best product ever"))
    alerts = detect_patterns(scored_windows(make_comments(_windows(spec)))).collect()
    assert len(alerts) == 1 and alerts[0].coordinated_sentiment


def test_volume_guard_at_four_and_five(make_comments):
    # 20 windows of 1 comment, then a window of 4 / of 5 comments by one author
    for n, expect in ((4, 0), (5, 1)):
        spec = [(1, 1, 60, lambda i, j: 0.0, "x") for _ in range(20)] + [(n, 1, 10, lambda i, j: 0.0, "x")]
        alerts = detect_patterns(scored_windows(make_comments(_windows(spec)))).collect()
        assert len(alerts) == expect


def test_multiplier_threshold_is_strict(spark):
    from burstwatch.operators import coordination_score
    df = spark.createDataFrame(
        [(-2.0, 0.0, 0.0, 0.0), (-2.0001, 0.0, 0.0, 0.0)],
        "gap_var_z double, concentration_z double, sentiment_var_z double, count_z double")
    got = [r.coordination_score for r in coordination_score(df).collect()]
    assert got == [round(2.0 * 0.3, 4), round(2.0001 * 1.5 * 0.3, 4)]


def test_edges_half_open_windows_and_zero_gaps(make_comments):
    rows = [
        ("e1", "v1", "a", "x", 0.5, 0),          # first second of window 0
        ("e2", "v1", "b", "x", 0.5, L - 1),      # last second of window 0
        ("e3", "v1", "a", "x", 0.5, L - 1),      # same second -> gap 0
        ("e4", "v1", "c", "x", 0.5, L),          # first second of window 1
        ("e5", "v2", None, "", 0.0, 10),         # one comment, null author
    ]
    m = {(r.video_id, r.window_start.timestamp()): r
         for r in window_metrics(make_comments(rows)).collect()}
    w0 = m[("v1", 1704067200.0)]
    assert w0.total_comments == 3 and w0.unique_authors == 2
    assert w0.avg_gap == pytest.approx((L - 1) / 2)     # gaps: L-1, 0 (first has none)
    assert w0.gap_variance == pytest.approx(((L - 1) / 2) ** 2)
    w1 = m[("v1", 1704067200.0 + L)]
    assert w1.total_comments == 1 and w1.avg_gap == 1.0 and w1.gap_variance == 0.0
    v2 = m[("v2", 1704067200.0)]
    assert v2.unique_authors == 0 and v2.avg_gap == 0.0 and v2.sentiment_variance == 0.0
    assert v2.avg_length == 0.0


def test_window_scope_gaps_stay_inside(make_comments):
    rows = [("a", "v", "x", "t", 0.0, 0), ("b", "v", "x", "t", 0.0, 100), ("c", "v", "x", "t", 0.0, L + 50)]
    m = window_metrics(make_comments(rows), gap_scope="window").orderBy("window_start").collect()
    assert m[0].avg_gap == 100.0 and m[1].avg_gap == 0.0
    m = window_metrics(make_comments(rows), gap_scope="video").orderBy("window_start").collect()
    assert m[1].avg_gap == float(L + 50 - 100)


def test_input_order_does_not_matter(make_comments):
    spec = [(5, 3, 37, lambda i, j: math.sin(i + j), f"t{i}") for i in range(15)]
    rows = _windows(spec)
    def canon(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                      for r in df.collect())

    a = canon(rolling_baseline(window_metrics(make_comments(rows))))
    b = canon(rolling_baseline(window_metrics(make_comments(rows[::-1]))))
    assert a == b
