"""Exact top-k inner products by a pivot-distance index.

Vectors become integers, w = floor(256 x). With one more coordinate that gives all
of them the same length R, the largest inner product with a query is the smallest
distance to it. The index keys each vector by its nearest pivot and its distance
from that pivot; sorted by these it is cut into annuli (runs of at most
ANNULUS_ROWS vectors of one pivot). For a query, an annulus from ``lo`` to ``hi`` around
a pivot at distance d holds nothing nearer than max(d - hi, lo - d, 0). The
annulus of the lowest bound is scored first; its k-th score then stops the
expansion: only annuli whose bound is below that distance are scored."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from burstwatch.llm.tasks import arrow_map, input_partitions, record_batch, task_id
from burstwatch.session import cut_lineage, ship_package

PIVOTS = 32
ANNULUS_ROWS = 1_024
#: Queries that meet an annulus together.
QUERY_BLOCK = 4_096
SCALE = 256
#: Slack of the bounds against rounding, relative and absolute (distances of integers).
SLACK = (1e-9, 1e-6)


def integers(v) -> np.ndarray:
    return np.floor(np.array(v, np.float64) * SCALE)


def distances(w: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances [rows, pivots] of rows with their further coordinate."""
    full = np.concatenate([w, extra[:, None]], axis=1)
    return np.stack([np.sqrt(((full - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def products(q: np.ndarray, w: np.ndarray):
    """Integer inner products [queries, rows]; exact."""
    most = w.shape[1] * np.abs(q).max(initial=0) * np.abs(w).max(initial=0)
    if most < 2 ** 53:
        return (q @ w.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in q], object) @ np.array([[int(x) for x in r] for r in w], object).T
    return np.clip(exact, 1 - 2 ** 63, 2 ** 63 - 1).astype(np.int64)


# ------------------------------------------------------------------ kernels

def _pivots(model, dim: int):
    """(R squared, pivots with their further coordinate) of a dimension."""
    return model.value[dim]


def key_kernel(batches, model):
    """Nearest pivot and its distance of each vector."""
    for b in batches:
        for at in range(0, b.num_rows, 2_048):
            part = b.slice(at, 2_048)
            v, ids = part.column("v").to_pylist(), part.column("vec_id")
            dims = np.array([len(x) for x in v])
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                w = integers([v[i] for i in mine])
                r2, pivots = _pivots(model, int(dim))
                d = distances(w, np.sqrt(np.maximum(0, r2 - (w * w).sum(axis=1))), pivots)
                near = d.argmin(axis=1)
                yield record_batch({"vec_id": ids.take(pa.array(mine)), "dim": [int(dim)] * len(mine), "pivot": near,
                                    "d": d[np.arange(len(mine)), near], "w": [x.astype("<f8").tobytes() for x in w]},
                                   dim=pa.int32(), pivot=pa.int32(), d=pa.float64(), w=pa.binary())


def annulus_kernel(batches):
    """Runs of sorted vectors of one pivot."""
    part, made, held = task_id(), 0, []

    def row():
        nonlocal made
        made += 1
        return {"annulus": (part << 32) + made, "dim": held[0][1], "pivot": held[0][2], "lo": held[0][3], "hi": held[-1][3],
                "ids": np.array([h[0] for h in held], "<i8").tobytes(), "ws": b"".join(h[4] for h in held)}

    def out(rows):
        return record_batch({k: [r[k] for r in rows] for k in rows[0]}, annulus=pa.int64(), dim=pa.int32(),
                            pivot=pa.int32(), ids=pa.binary(), ws=pa.binary())

    for b in batches:
        rows = []
        for item in zip(*(b.column(c).to_pylist() for c in ("vec_id", "dim", "pivot", "d", "w"))):
            if held and item[0] == held[-1][0] and item[4] == held[-1][4]:
                continue  # a repeated row
            if held and (len(held) >= ANNULUS_ROWS or item[1:3] != held[-1][1:3]):
                rows.append(row())
                held = []
            held.append(item)
        if rows:
            yield out(rows)
    if held:
        yield out([row()])


def query_kernel(batches, model):
    """Distance of each query to each pivot."""
    for b in batches:
        for at in range(0, b.num_rows, 1_024):
            part = b.slice(at, 1_024)
            rows = []
            for qid, v in zip(part.column("vec_id").to_pylist(), part.column("v").to_pylist()):
                w = integers([v])
                r2, pivots = _pivots(model, len(v))
                d = distances(w, np.zeros(1), pivots)[0]
                far = float((w * w).sum() + r2)  # squared distance of a vector of inner product 0
                rows += [(qid, len(v), p, x, far) for p, x in enumerate(d.tolist())]
            yield record_batch(dict(zip(("query_id", "dim", "pivot", "dq", "far"), map(list, zip(*rows)))),
                               query_id=pa.int64(), dim=pa.int32(), pivot=pa.int32())


def score_group(queries: pa.Table, annuli: pa.Table, k: int) -> pa.Table:
    """The k best of an annulus for each query that meets it, not below the query's floor."""
    out: list[tuple] = []
    if queries.num_rows and annuli.num_rows:
        ids = np.frombuffer(annuli.column("ids")[0].as_py(), "<i8")
        w = np.frombuffer(annuli.column("ws")[0].as_py(), "<f8").reshape(len(ids), -1)
        repeats = len(np.unique(ids)) < len(ids)
        qids = queries.column("query_id").to_pylist()
        floors = queries.column("floor").to_pylist()
        for at in range(0, len(qids), 512):
            q = integers(queries.column("v").slice(at, 512).to_pylist())
            for qid, floor, scores in zip(qids[at:at + 512], floors[at:at + 512], products(q, w)):
                ok = ids != qid
                if floor is not None:
                    ok &= scores >= floor
                mine = np.flatnonzero(ok)
                if repeats:  # the best row of each id
                    mine = mine[np.lexsort((-scores[mine], ids[mine]))]
                    mine = mine[np.flatnonzero(np.diff(ids[mine], prepend=ids[mine][:1] - 1))]
                if len(mine) > 4 * k:
                    top = scores[mine]
                    mine = mine[top >= np.partition(top, -2 * k)[-2 * k]]
                best: dict[int, int] = {}
                for s, i in sorted(zip((-scores[mine]).tolist(), ids[mine].tolist())):
                    if len(best) < k:
                        best.setdefault(i, -s)
                out += [(qid, i, s) for i, s in best.items()]
    return pa.table({"query_id": pa.array([o[0] for o in out], pa.int64()), "vec_id": pa.array([o[1] for o in out], pa.int64()),
                     "score": pa.array([o[2] for o in out], pa.int64())})


# ------------------------------------------------------------------ the operator

def vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the rows that take part: an id, and a non-empty vector of finite components."""
    v = F.col("v")
    return table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(
        F.col("vec_id").isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))


def _model(x: DataFrame, pivots: int) -> dict:
    """Per dimension: the largest squared length, and pivots (rows of the smallest hashes)."""
    def scaled(c):  # as a double: from 2^53 on it is whole as it is
        return F.when(F.abs(c) < 2.0 ** 44, F.floor(c * SCALE).cast("double")).otherwise(c * SCALE)

    squares = F.aggregate("v", F.lit(0.0), lambda a, c: a + scaled(c) * scaled(c))
    longest = {r["dim"]: r["r2"] for r in x.groupBy(F.size("v").alias("dim")).agg(F.max(squares).alias("r2")).collect()}
    first = Window.partitionBy("dim").orderBy(F.xxhash64("v"))
    picked = x.select("v", F.size("v").alias("dim")).withColumn("n", F.row_number().over(first)).where(F.col("n") <= pivots)
    found: dict[int, list] = {}
    for r in picked.collect():
        found.setdefault(r["dim"], []).append(r["v"])
    out = {}
    for dim, rows in found.items():
        w = np.unique(integers(rows), axis=0)
        extra = np.sqrt(np.maximum(0, longest[dim] - (w * w).sum(axis=1)))
        out[dim] = (longest[dim], np.concatenate([w, extra[:, None]], axis=1))
    return out


_HITS = "query_id long, vec_id long, score long"


def top_products(table: DataFrame, queries: DataFrame, k: int = 5, pivots: int = PIVOTS,
                 id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per query (rows of ``queries``, with ids as in ``table``): the ``k`` rows of ``table``, other
    than itself, of largest integer inner product: query_id, rank, vec_id, score. Exact.

    Ties go to the smaller id. Vectors that are null, empty or hold null or non-finite
    components take no part, nor do rows without an id; vectors of another dimension
    than the query's are no candidates; rows of one id are one candidate with its best
    score. Components count up to 1e100 in size; a score beyond 2^63 - 1 either way is that number.
    An empty table or no queries give no rows. The pivots (bounded by ``pivots``) are broadcast."""
    spark = table.sparkSession
    ship_package(spark)
    x = vectors(table, id_col, vector_col)
    model = spark.sparkContext.broadcast(_model(x, pivots))
    keyed = arrow_map(x, key_kernel, "vec_id long, dim int, pivot int, d double, w binary", model)
    by = ["dim", "pivot", "d", "vec_id"]
    ordered = keyed.repartitionByRange(input_partitions(spark), *by).sortWithinPartitions(*by)
    annuli = cut_lineage(arrow_map(ordered, annulus_kernel, "annulus long, dim int, pivot int, lo double, hi double, "
                                   "ids binary, ws binary"))
    q = cut_lineage(vectors(queries, id_col, vector_col).dropDuplicates(["vec_id"]))
    blocks = max(1, math.ceil(q.count() / QUERY_BLOCK))
    asked = q.select(F.col("vec_id").alias("query_id"), "v", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"))
    # bounds of queries against annuli of their dimension: longs and doubles only
    bounds = arrow_map(q, query_kernel, "query_id long, dim int, pivot int, dq double, far double", model).join(
        annuli.select("annulus", "dim", "pivot", "lo", "hi"), ["dim", "pivot"]).select(
        "query_id", "annulus", "far", F.greatest(F.lit(0.0), F.col("dq") - F.col("hi"), F.col("lo") - F.col("dq")).alias("bound"))
    bounds = cut_lineage(bounds)

    def scored(pairs: DataFrame) -> DataFrame:
        left = pairs.join(asked, "query_id").select("annulus", "block", "query_id", "v", "floor")
        right = annuli.select("annulus", "ids", "ws", F.explode(
            F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")).alias("block"))
        return left.groupBy("annulus", "block").cogroup(right.groupBy("annulus", "block")).applyInArrow(
            _scorer(k), _HITS)

    first = bounds.groupBy("query_id").agg(F.min(F.struct("bound", "annulus")).alias("m")).select(
        "query_id", F.col("m.annulus").alias("annulus"), F.lit(None).cast("long").alias("floor"))
    seeds = scored(first).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor")) \
        .where(F.col("n") >= k).select("query_id", "floor")
    reach = F.sqrt(F.greatest(F.lit(0.0), F.col("far") - 2 * F.col("floor")))
    near = bounds.join(cut_lineage(seeds), "query_id", "left").where(
        F.col("floor").isNull() | (F.col("bound") <= reach * (1 + SLACK[0]) + SLACK[1])).select("query_id", "annulus", "floor")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = scored(near).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def _scorer(k: int):
    def run(left, right):
        from burstwatch.llm.topk_pivots import score_group

        return score_group(left, right, k)

    return run
