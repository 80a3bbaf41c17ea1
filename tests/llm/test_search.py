"""Searches against brute force: recall of the graph, equality of the pivot index."""

import numpy as np
import pytest

from burstwatch.llm import ann_graph as G
from burstwatch.llm.ann_graph import nearest
from burstwatch.llm.topk_pivots import top_products

SF = "/root/testdata/sf0.1"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0) for i, v in rows], "vec_id long, embedding array<float>, rank string, score int").repartition(4)


def ok(v, zero=True):
    return v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and (zero or any(v))


def brute(rows, queries, k, score, zero):
    rows = {(i, tuple(v)) for i, v in rows if i is not None and ok(v, zero)}
    want = {}
    for q, x in {r for r in rows if r[0] in queries}:
        best = {}
        for i, v in rows:
            if i != q and len(v) == len(x):
                s = score(x, v)
                best[i] = max(s, best.get(i, s))
        want[q] = [(i, s) for s, i in sorted((-s, i) for i, s in best.items())[:k]]
    return {q: [(i, -s) for i, s in hits] for q, hits in want.items()}


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def dot(q, x):
    return int((np.floor(256 * np.array(q, float)) * np.floor(256 * np.array(x, float))).sum())


def rows_with_edges():
    g = np.random.default_rng(4)
    rows = [(i, [float(np.float32(c)) for c in g.normal(size=6) * g.choice([0.1, 1, 5])]) for i in range(300)]
    one = [0.5, 0.25, -1.0, 0.0, 2.0, 1.0]
    rows += [(1000 + i, one) for i in range(150)]                      # copies of one vector
    rows += [(2000, None), (2001, []), (2002, [0.0] * 6), (2003, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
             (2004, [float("nan")] + [1.0] * 5), (2005, [float("inf")] + [1.0] * 5), (None, [1.0] * 6),
             (3000, [1.0, 2.0, 3.0]), (3001, [3.0, 2.0, 1.0]), (10, rows[10][1]), (20, rows[20][1])]
    return rows


@pytest.mark.parametrize("pivots", [1, 5, 32])
def test_top_products_equal_brute_force(spark, pivots):
    rows = rows_with_edges()
    queries = {i for i, _ in rows if i is not None and i % 10 == 0}
    x = table(spark, rows)
    assert got(top_products(x, x.where("vec_id % 10 = 0"), 5, pivots)) == brute(rows, queries, 5, dot, True)


def test_few_rows_and_none(spark):
    x = table(spark, [(0, [1.0, 0.0]), (50, [0.5, 0.5]), (7, [0.0, 1.0])])
    assert [len(v) for v in got(top_products(x, x.where("vec_id % 50 = 0"))).values()] == [2, 2]
    assert [len(v) for v in got(nearest(x, x.where("vec_id % 50 = 0"))).values()] == [2, 2]
    none = x.where("vec_id < 0")
    assert top_products(none, none).count() == 0 and nearest(none, none).count() == 0
    one = x.where("vec_id = 0")
    assert top_products(one, one).count() == 0 and nearest(one, one).count() == 0


def test_nearest_with_edges(spark):
    rows = rows_with_edges()
    queries = {i for i, _ in rows if i is not None and i % 10 == 0}
    x = table(spark, rows)

    def cos(q, v):
        return float(G.cosine(np.array(q, float), np.array([v], float))[0])

    want = brute(rows, queries, 5, cos, False)
    for shard_rows in (100, 8192):
        found = got(nearest(x, x.where("vec_id % 10 = 0"), 5, shard_rows=shard_rows))
        assert set(found) == set(want)
        hit = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
        assert hit >= 0.98 * sum(map(len, want.values()))
        assert all(abs(s - dict(want[q]).get(i, s)) < 1e-15 for q in found for i, s in found[q])
        assert found[1000] == want[1000]  # the copies, smallest ids first


def test_recall(spark):
    x = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in x.collect()]
    m = np.array([v for _, v in rows], float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    ids = np.array([i for i, _ in rows])
    found = got(nearest(x, x.where("vec_id % 50 = 0"), 5, shard_rows=1000))
    hit = 0
    for q, hits in found.items():
        s = m @ m[ids == q][0]
        s[ids == q] = -2
        hit += len({i for i, _ in hits} & set(ids[np.argsort(-s)[:5]].tolist()))
    assert len(found) == 40 and hit >= 0.95 * 5 * len(found)


def test_flat_arrays_round_trip():
    u = G._unit(np.random.default_rng(0).normal(size=(500, 8)))
    g = G.Graph.build(u)
    h = G.Graph.from_flat(*[g.flat()[i] for i in (0, 1, 2, 3)])
    assert all(g.search(q, 20) == h.search(q, 20) for q in u[:20])


def test_repeated_ids_do_not_hide_others(spark):
    r = np.random.default_rng(3)
    rows = [(0, [1.0, 0.0, 0.0, 0.0])] + [(5, [1.0, 1e-3 * i, 0.0, 0.0]) for i in range(400)]
    rows += [(10 + i, r.normal(size=4).tolist()) for i in range(20)]
    x = table(spark, rows)

    def cos(q, v):
        return float(G.cosine(np.array(q, float), np.array([v], float))[0])

    stored = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in rows]
    found = got(nearest(x, x.where("vec_id = 0"), 5))
    assert [i for i, _ in found[0]] == [i for i, _ in brute(stored, {0}, 5, cos, False)[0]]

    def dot(q, v):
        return sum(int(np.floor(256 * a)) * int(np.floor(256 * b)) for a, b in zip(q, v))

    assert got(top_products(x, x.where("vec_id = 0"), 5)) == brute(stored, {0}, 5, dot, True)


def test_huge_components_do_not_overflow(spark):
    rows = [(0, [1.0, 2.0]), (1, [1e100, 1.0]), (2, [-1e100, 3.0]), (3, [5e7, 5e7]), (4, [1.0, 1.0]), (5, [2e4, -2e4])]
    x = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = got(top_products(x, x.where("vec_id = 0"), 5))
    assert [i for i, _ in found[0]] == [1, 3, 4, 5, 2]
    assert found[0][0][1] == 2 ** 63 - 1 and found[0][4][1] == 1 - 2 ** 63 and found[0][1][1] == 256 * 256 * 150_000_000
