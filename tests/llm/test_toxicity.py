"""The fitted gradient against differences, accuracy on labels left out, and edges."""

import numpy as np

from burstwatch.llm import toxicity as X

SF = "/root/testdata/sf0.1"


def loss(m, row, col, val, grades, penalty):
    n = len(grades)
    z = np.bincount(row, weights=val * m.weights[col], minlength=n)
    p = 1 / (1 + np.exp(-(z[:, None] - m.thresholds)))
    p = np.concatenate([np.ones((n, 1)), p, np.zeros((n, 1))], axis=1)
    return -np.log(p[np.arange(n), grades] - p[np.arange(n), grades + 1]).mean() + penalty / 2 * (m.weights ** 2).sum()


def test_fit_is_a_minimum_with_ordered_thresholds():
    rng = np.random.default_rng(3)
    n, k = 400, 5
    x = rng.random((n, k)) * (rng.random((n, k)) < 0.4)
    z = x @ np.array([4, -3, 2, 0, 1.0])
    grades = (z + rng.logistic(size=n) > 1).astype(int) + (z + rng.logistic(size=n) > 3)
    row, col = np.nonzero(x)
    m = X.fit(row, col, x[row, col], grades, {str(i): i for i in range(k)}, penalty=0.01, steps=4000)
    assert m.thresholds[0] < m.thresholds[1]
    best = loss(m, row, col, x[row, col], grades, 0.01)
    for i in range(k):
        for step in (-0.05, 0.05):
            w = m.weights.copy()
            w[i] += step
            assert loss(X.Model(m.features, w, m.thresholds), row, col, x[row, col], grades, 0.01) >= best - 1e-6
    for i in range(2):
        for step in (-0.05, 0.05):
            t = m.thresholds.copy()
            t[i] += step
            assert loss(X.Model(m.features, m.weights, t), row, col, x[row, col], grades, 0.01) >= best - 1e-6


def test_labels_left_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = X.learn(docs, labels.where("doc_id % 4 != 1"))
    left = {r.doc_id: r.toxic for r in labels.where("doc_id % 4 = 1").collect()}
    rows = [r for r in X.severity(docs, model).collect() if r.doc_id in left]
    hit = [r.toxic for r in rows if left[r.doc_id] == 1]
    false = [r.toxic for r in rows if left[r.doc_id] == 0]
    assert len(hit) > 50 and np.mean(hit) > 0.97 and np.mean(false) < 0.003
    assert all(0 <= r.expected_severity <= 2 and r.grade in (0, 1, 2) for r in rows)
    rows = [(1, None), (2, ""), (None, "scum idiot moron"), (3, "stupid scum " * 200_000), (3, "the and"), (3, "the and")]
    edge = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, toxic string")
    out = X.severity(edge, model).collect()
    assert len(out) == len(rows) and sorted(str(r.doc_id) for r in out if r.toxic) == ["3", "None"]
    kept = X.keep_clean(edge, model)
    assert kept.columns == edge.columns and kept.count() == 4
    assert X.severity(edge.limit(0), model).count() == 0
    empty = X.learn(docs, labels.limit(0))
    assert not any(r.toxic for r in X.severity(edge, empty).collect())
    assert X.learn(docs.limit(0), labels).features == {}
