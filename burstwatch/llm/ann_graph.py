"""Approximate nearest neighbours by a navigable small-world graph per shard.

Vectors are dealt to shards by a hash of their id. A shard's graph is built in
one task over its distinct vectors and kept as flat neighbour arrays (one block of
fixed width per layer). The queries, in blocks, are run through every shard's
graph by a beam search; the found vectors are scored exactly in double precision
and the shards' results merged. Equal vectors are one vertex with its smallest ids,
so copies cannot fill the neighbour lists."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from burstwatch.llm.tasks import arrow_groups, arrow_map, input_partitions, record_batch
from burstwatch.session import cut_lineage

#: Neighbours kept per vertex (twice as many in the ground layer), and beam widths.
LINKS = 12
BUILD_BEAM = 60
SEARCH_BEAM = 200
#: Vectors of a shard at most, on average.
SHARD_ROWS = 8_192
#: Queries that a task runs through one shard.
QUERY_BLOCK = 4_096


def _unit(x: np.ndarray) -> np.ndarray:
    return (x / np.sqrt((x * x).sum(axis=1, keepdims=True))).astype(np.float32)


def cosine(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines of one vector with rows, in double precision. Products and sums by
    element, so that equal rows get equal scores."""
    return (x * q).sum(axis=1) / (np.sqrt((q * q).sum()) * np.sqrt((x * x).sum(axis=1)))


class Graph:
    """Layers of a shard: unit vectors, the layer count of each vertex, and per layer
    an array [vertices of it, width] of neighbours (-1: none)."""

    def __init__(self, unit: np.ndarray, tops: np.ndarray, links: list[np.ndarray], entry: int):
        self.unit, self.tops, self.links, self.entry = unit, tops, links, entry

    @classmethod
    def build(cls, unit: np.ndarray, seed: int = 7) -> Graph:
        n = len(unit)
        draw = np.random.default_rng(seed).random(n)
        tops = np.minimum(8, (-np.log(np.maximum(draw, 1e-12)) / math.log(LINKS)).astype(int))
        # every layer has a row for each vertex while building; upper ones are thin and cut after it
        links = [np.full((n, 2 * LINKS if k == 0 else LINKS), -1, np.int32) for k in range(int(tops.max(initial=0)) + 1)]
        g = cls(unit, tops, links, 0)
        for v in range(1, n):
            g._insert(v)
        return g

    def _insert(self, v: int) -> None:
        q, start, top = self.unit[v], [self.entry], int(self.tops[v])
        high = int(self.tops[self.entry])
        for layer in range(high, top, -1):
            start = [self._beam(q, start, 1, layer)[0][1]]
        for layer in range(min(top, high), -1, -1):
            near = self._beam(q, start, BUILD_BEAM, layer)
            chosen = self._spread(near, LINKS)
            row = self.links[layer]
            row[v, :len(chosen)] = chosen
            for u in chosen:
                self._link(u, v, layer)
            start = [x for _, x in near]
        if top > high:
            self.entry = v

    def _link(self, u: int, v: int, layer: int) -> None:
        row = self.links[layer][u]
        free = np.flatnonzero(row < 0)
        if len(free):
            row[free[0]] = v
            return
        others = np.append(row, v)
        d = 1 - self.unit[others] @ self.unit[u]
        order = np.argsort(d, kind="stable")
        kept = self._spread([(float(d[i]), int(others[i])) for i in order], len(row))
        row[:] = -1
        row[:len(kept)] = kept

    def _spread(self, near: list[tuple[float, int]], most: int) -> list[int]:
        """Of vertices by distance, those nearer to the centre than to any one chosen
        before; what is free then goes to the nearest others."""
        ids = np.array([x for _, x in near])
        between = 1 - self.unit[ids] @ self.unit[ids].T
        chosen: list[int] = []
        for i, (d, _) in enumerate(near):
            if not chosen or d < between[i, chosen].min():
                chosen.append(i)
                if len(chosen) == most:
                    break
        if len(chosen) < most:
            taken = set(chosen)
            chosen += [i for i in range(len(near)) if i not in taken][:most - len(chosen)]
        return [int(ids[i]) for i in chosen]

    def _beam(self, q: np.ndarray, start: list[int], width: int, layer: int) -> list[tuple[float, int]]:
        """The nearest vertices of a layer that a beam of ``width`` finds, by distance."""
        from heapq import heappop, heappush, heapreplace

        links, unit = self.links[layer], self.unit
        seen = set(start)
        ds = (1 - unit[start] @ q).tolist()
        todo = sorted(zip(ds, start))
        best = [(-d, x) for d, x in todo]
        best.sort()
        while len(best) > width:
            best.pop(0)
        while todo:
            d, x = heappop(todo)
            if len(best) >= width and d > -best[0][0]:
                break
            new = [y for y in links[x].tolist() if y >= 0 and y not in seen]
            if not new:
                continue
            seen.update(new)
            for dy, y in zip((1 - unit[new] @ q).tolist(), new):
                if len(best) < width:
                    heappush(best, (-dy, y))
                    heappush(todo, (dy, y))
                elif dy < -best[0][0]:
                    heapreplace(best, (-dy, y))
                    heappush(todo, (dy, y))
        return sorted((-d, x) for d, x in best)

    def search(self, q: np.ndarray, width: int) -> list[int]:
        if not len(self.unit):
            return []
        start = [self.entry]
        for layer in range(len(self.links) - 1, 0, -1):
            start = [self._beam(q, start, 1, layer)[0][1]]
        return [x for _, x in self._beam(q, start, width, 0)]

    def flat(self) -> tuple[bytes, bytes, int, list[bytes]]:
        """Layer counts, widths and neighbour arrays as bytes (upper layers: only their vertices)."""
        layers = []
        for k, row in enumerate(self.links):
            own = np.flatnonzero(self.tops >= k).astype("<i4")
            layers.append(own.tobytes() + row[own].astype("<i4").tobytes())
        return self.tops.astype("u1").tobytes(), self.unit.astype("<f4").tobytes(), self.entry, layers

    @classmethod
    def from_flat(cls, tops: bytes, unit: bytes, entry: int, layers: list[bytes]) -> Graph:
        t = np.frombuffer(tops, "u1").astype(int)
        u = np.frombuffer(unit, "<f4").reshape(len(t), -1) if len(t) else np.zeros((0, 0), np.float32)
        links = []
        for k, raw in enumerate(layers):
            n = int((t >= k).sum())
            own = np.frombuffer(raw, "<i4", n)
            row = np.full((len(t), 2 * LINKS if k == 0 else LINKS), -1, np.int32)
            row[own] = np.frombuffer(raw, "<i4", offset=4 * n).reshape(n, -1)
            links.append(row)
        return cls(u, t, links, entry)


# ------------------------------------------------------------------ kernels

_SHARD = ("shard int, dim int, vectors binary, ids binary, offsets binary, tops binary, unit binary, entry int, "
          "layers array<binary>")


def build_kernel(table: pa.Table, keep: int) -> pa.Table:
    """The graph of one shard (and dimension)."""
    x = np.array(table.column("v").to_pylist(), np.float64)
    ids = table.column("vec_id").to_numpy()
    kinds, of = np.unique(x, axis=0, return_inverse=True)
    order = np.lexsort((ids, of.ravel()))
    firsts = np.searchsorted(of.ravel()[order], np.arange(len(kinds) + 1))
    # the smallest ids of each vector are all that can be among its nearest
    own = [np.unique(ids[order[a:z]])[:keep] for a, z in zip(firsts, firsts[1:])]
    tops, unit, entry, layers = Graph.build(_unit(kinds)).flat()
    offsets = np.cumsum([0, *map(len, own)])
    return pa.table({"shard": pa.array(table.column("shard").to_pylist()[:1], pa.int32()),
                     "dim": pa.array([x.shape[1]], pa.int32()),
                     "vectors": pa.array([kinds.astype("<f8").tobytes()]), "ids": pa.array([np.concatenate(own).astype("<i8").tobytes()]),
                     "offsets": pa.array([offsets.astype("<i8").tobytes()]), "tops": pa.array([tops]),
                     "unit": pa.array([unit]), "entry": pa.array([entry], pa.int32()),
                     "layers": pa.array([layers], pa.list_(pa.binary()))})


def block_kernel(table: pa.Table) -> pa.Table:
    """One row of packed queries per block."""
    x = np.array(table.column("v").to_pylist(), np.float64)
    return pa.table({"qdim": pa.array([x.shape[1]], pa.int32()), "block": pa.array(table.column("block").to_pylist()[:1], pa.int64()),
                     "qids": pa.array([table.column("vec_id").to_numpy().astype("<i8").tobytes()]),
                     "queries": pa.array([x.astype("<f8").tobytes()])})


def search_kernel(batches, k: int, beam: int):
    """The k nearest (by exact score, then id) that each query finds in a shard."""
    for b in batches:
        for i in range(b.num_rows):
            r = {c: b.column(c)[i].as_py() for c in b.schema.names}
            g = Graph.from_flat(r["tops"], r["unit"], r["entry"], r["layers"])
            x = np.frombuffer(r["vectors"], "<f8").reshape(-1, r["dim"])
            ids, offsets = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["offsets"], "<i8")
            qids = np.frombuffer(r["qids"], "<i8")
            q = np.frombuffer(r["queries"], "<f8").reshape(len(qids), -1)
            out: list[tuple] = []
            for qid, v, u in zip(qids.tolist(), q, _unit(q)):
                width = max(beam, k + 1)
                while True:
                    found = np.array(g.search(u, width))
                    scores = cosine(v, x[found])
                    best: dict[int, float] = {}
                    for j in np.argsort(-scores, kind="stable"):
                        if len(best) >= k and scores[j] < kth:
                            break
                        for y in ids[offsets[found[j]]:offsets[found[j] + 1]].tolist():
                            if y != qid and y not in best:
                                best[y] = kth = scores[j]
                    if len(best) >= k or width >= len(x):
                        break
                    width *= 4  # vectors of few ids fill the beam
                hits = sorted(best.items(), key=lambda h: (-h[1], h[0]))
                out += [(qid, y, s) for y, s in hits[:k]]
            yield record_batch({"query_id": [o[0] for o in out], "vec_id": [o[1] for o in out], "score": [o[2] for o in out]},
                               query_id=pa.int64(), vec_id=pa.int64(), score=pa.float64())


# ------------------------------------------------------------------ the operator

def vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the rows that take part: an id, and a vector of finite components
    that is neither empty nor zero."""
    v = F.col("v")
    return table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(
        F.col("vec_id").isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(v, lambda x: x != 0))


def build_index(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                shard_rows: int = SHARD_ROWS, k: int = 5) -> DataFrame:
    """One row per shard with its graph and vectors, stored. Every row is indexed."""
    x = vectors(table, id_col, vector_col)
    shards = max(1, -(-table.count() // shard_rows))
    dealt = x.select("vec_id", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"))
    # building is heavy for its bytes: a shard a task, not as many as fit by size
    spread = dealt.repartition(max(shards, input_partitions(table.sparkSession)), "shard", "dim")
    return cut_lineage(arrow_groups(spread, ["shard", "dim"], build_kernel, _SHARD, k + 1))


def nearest(table: DataFrame, queries: DataFrame, k: int = 5, beam: int = SEARCH_BEAM,
            shard_rows: int = SHARD_ROWS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per query (rows of ``queries``, with ids as in ``table``): its ``k`` nearest rows of
    ``table`` by cosine, other than itself, that are found: query_id, rank, vec_id, score.

    Ties go to the smaller id. Vectors that are null, empty, zero or hold null or
    non-finite components take no part, nor do rows without an id; vectors of another
    dimension than the query's are no candidates; repeated rows are one candidate.
    Queries meet shards in blocks: each (block, shard) is a task's row."""
    index = build_index(table, id_col, vector_col, shard_rows, k)
    q = vectors(queries, id_col, vector_col).dropDuplicates(["vec_id"])
    n = max(1, -(-queries.count() // QUERY_BLOCK))
    blocks = cut_lineage(arrow_groups(
        q.select("vec_id", "v", F.size("v").alias("qdim"), F.pmod(F.xxhash64("vec_id"), F.lit(n)).alias("block")),
        ["qdim", "block"], block_kernel, "qdim int, block long, qids binary, queries binary"))
    # each shard is sent to every block of queries of its dimension
    met = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))).join(
        blocks.withColumnRenamed("block", "qblock"), (F.col("dim") == F.col("qdim")) & (F.col("block") == F.col("qblock")))
    spread = met.repartition(input_partitions(table.sparkSession), "shard", "block", "dim")
    hits = arrow_map(spread.drop("qdim", "qblock", "block", "shard"), search_kernel, "query_id long, vec_id long, score double", k, beam)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
