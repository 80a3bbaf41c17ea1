"""Packing of token sequences by minimum bin slack.

A document's tokens are cut into whole windows and a remainder. Only how many
remainders there are of each length matters: a plan of windows is made on these
counts. The longest length opens a window, a bitset subset-sum over the other
lengths (with their counts) finds the multiset that comes closest to the room
left, the bitsets are followed back to its counts, and the window is repeated as
often as the counts allow. Slack that stays is filled by cutting one more
remainder, whose rest is counted again; what is left in the end is cut into
windows of powers of two, which need no padding.

The plan says which ranks of a length go where, so each document is placed on its
own: its rank is its number among equal lengths in its input partition plus a
prefix sum over partitions. Nothing is gathered but the counts (one per length)."""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from burstwatch.llm.tasks import arrow_map, record_batch, slices, task_id
from burstwatch.llm.vocab import encoder
from burstwatch.session import cut_lineage

#: Cut remainders whose pieces may be broadcast to the second look at their texts.
BROADCAST_CUTS = 20_000


# ------------------------------------------------------------------ the plan

def closest_multiset(counts: list[tuple[int, int]], room: int) -> dict[int, int]:
    """Of (length, count) pairs, the multiset whose sum is the largest up to ``room``.
    Bit s of a bitset says that the sum s can be reached."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length, n in counts:
        n, copies = min(n, room // length) if length else 0, 1
        while n:  # 1, 2, 4, ... copies at a time
            k = min(copies, n)
            steps.append((length, k, reach))
            reach |= (reach << (length * k)) & mask
            n -= k
            copies *= 2
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, {}
    for length, k, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + k
            at -= length * k
    return chosen


class Plan:
    """Where the remainders go: for each length, runs of ranks."""

    def __init__(self, counts: dict[int, int], window: int):
        self.window = window
        self.windows = 0   # made so far
        self.padding = 0
        self.cuts = 0
        self.left = {k: n for k, n in counts.items() if n}
        self.entered = dict(self.left)             # ranks given out per length
        self.used: dict[int, int] = {}             # ranks placed per length
        self.runs: dict[int, tuple[list[int], list[tuple]]] = {}
        while self.left:
            total = sum(k * n for k, n in self.left.items()) if len(self.left) < 64 else window
            self._fill(window if total >= window else 1 << (total.bit_length() - 1))
        for gone in ("left", "entered", "used"):
            delattr(self, gone)

    def _fill(self, room: int) -> None:
        """One window of ``room`` tokens, as often as the counts allow."""
        first = max((k for k in self.left if k <= room), default=None)
        chosen: dict[int, int] = {}
        if first is not None:
            rest = sorted(((k, n - (k == first)) for k, n in self.left.items()), reverse=True)
            chosen = closest_multiset([(k, n) for k, n in rest if n and k <= room], room - first)
            chosen[first] = chosen.get(first, 0) + 1
        slack = room - sum(k * n for k, n in chosen.items())
        cut = None
        if slack:  # every length that is left over is longer than the slack
            cut = min(k for k, n in self.left.items() if n > chosen.get(k, 0) and k > slack)
        need = dict(chosen)
        if cut:
            need[cut] = need.get(cut, 0) + 1
        times = min(self.left[k] // n for k, n in need.items())
        if room < self.window:
            times = 1
        offset = 0
        for k in sorted(chosen, reverse=True):
            self._run(k, times * chosen[k], ("place", self.windows, chosen[k], offset))
            offset += k * chosen[k]
        if cut:
            rest = cut - slack
            self._run(cut, times, ("cut", self.windows, offset, slack, rest, self.entered.get(rest, 0)))
            self.entered[rest] = self.entered.get(rest, 0) + times
            self.left[rest] = self.left.get(rest, 0) + times
            self.cuts += times
        self.windows += times

    def _run(self, length: int, n: int, what: tuple) -> None:
        starts, runs = self.runs.setdefault(length, ([], []))
        starts.append(self.used.get(length, 0))
        runs.append(what)
        self.used[length] = self.used.get(length, 0) + n
        self.left[length] -= n
        if not self.left[length]:
            del self.left[length]

    def pieces(self, length: int, rank: int) -> list[tuple[int, int, int]]:
        """(length, window, offset) of the pieces of a remainder, in order."""
        out = []
        while True:
            starts, runs = self.runs[length]
            i = bisect_right(starts, rank) - 1
            what, rank = runs[i], rank - starts[i]
            if what[0] == "place":
                _, window, copies, offset = what
                out.append((length, window + rank // copies, offset + rank % copies * length))
                return out
            _, window, offset, size, rest, base = what
            out.append((size, window + rank, offset))
            length, rank = rest, base + rank


# ------------------------------------------------------------------ kernels

def measure_kernel(batches, vocab: tuple, end_id: int, window: int):
    """Sizes and checksums of documents; number of each among the remainders of its
    length, and among the whole windows, of this partition."""
    ids_of, part = encoder(*vocab), task_id()
    seen, whole = np.zeros(window, np.int64), 0
    end = np.array([end_id], "<u4")
    for b in slices(batches, "text"):
        rows = {k: [] for k in ("n_tokens", "crc", "crcs", "rest", "number", "before")}
        for text in b.column("text").to_pylist():
            raw = np.concatenate([ids_of(text).astype("<u4"), end]).tobytes()
            n = len(raw) // 4
            rest, full = n % window, n // window
            rows["n_tokens"].append(n)
            rows["crc"].append(zlib.crc32(raw))
            rows["crcs"].append([zlib.crc32(raw[at:at + 4 * window]) for at in range(0, len(raw), 4 * window)])
            rows["rest"].append(rest)
            rows["number"].append(int(seen[rest]))
            rows["before"].append(whole)
            seen[rest] += 1
            whole += full
        yield record_batch({"doc_id": b.column("doc_id"), "part": [part] * b.num_rows} | rows,
                           part=pa.int32(), n_tokens=pa.int64(), crc=pa.int64(), crcs=pa.list_(pa.int64()),
                           rest=pa.int32(), number=pa.int64(), before=pa.int64())


def place_kernel(batches, plan):
    p = plan.value
    names = ("doc_id", "crc", "n_tokens", "start", "length", "ids_crc32", "sequence_id", "offset")
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            b, rows = batch.slice(at, 4096), []
            for doc, crc, n, crcs, rest, rank, first in zip(*(b.column(c).to_pylist() for c in (
                    "doc_id", "crc", "n_tokens", "crcs", "rest", "rank", "first"))):
                full = n // p.window
                rows += [(doc, crc, n, i * p.window, p.window, crcs[i], p.windows + first + i, 0) for i in range(full)]
                if rest:
                    start, pieces = full * p.window, p.pieces(rest, rank)
                    for length, window, offset in pieces:
                        rows.append((doc, crc, n, start, length, crcs[-1] if len(pieces) == 1 else None, window, offset))
                        start += length
            yield pa.record_batch([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))], names=names)


def checksum_kernel(batches, vocab: tuple, end_id: int):
    """Checksums of given pieces of documents."""
    ids_of, end = encoder(*vocab), np.array([end_id], "<u4")
    for b in slices(batches, "text"):
        rows = []
        for doc, text, pieces in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "pieces"))):
            raw = np.concatenate([ids_of(text).astype("<u4"), end]).tobytes()
            crc = zlib.crc32(raw)
            rows += [(doc, crc, x["start"], x["length"], zlib.crc32(raw[4 * x["start"]:4 * (x["start"] + x["length"])]))
                     for x in pieces if x["crc"] == crc and x["n_tokens"] * 4 == len(raw)]
        names = ("doc_id", "crc", "start", "length", "piece_crc32")
        yield pa.record_batch([pa.array([r[i] for r in rows], pa.int64()) for i in range(5)], names=names)


# ------------------------------------------------------------------ the operator

def pack_sequences(docs: DataFrame, vocab: tuple, end_id: int = 1, window: int = 2048,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset. Each token (a document's identifiers, then ``end_id``) lies in
    one piece; sequences are full, but for at most a few of powers of two.

    Null and empty texts are one ``end_id``; null ids and repeated rows are packed
    each on their own; an empty table gives no pieces. The texts are tokenised once
    into a small table in the checkpoint folder; texts whose remainder was cut are
    read again for the checksums of the cut pieces."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    measured = cut_lineage(arrow_map(rows, measure_kernel, "doc_id long, part int, n_tokens long, crc long, "
                                     "crcs array<long>, rest int, number long, before long", vocab, end_id, window))
    by = measured.groupBy("part", "rest").agg(F.count(F.lit(1)).alias("n"), F.sum(F.expr(f"n_tokens div {window}")).alias("full"))
    by = cut_lineage(by)
    counts = {r.rest: r.n for r in by.where("rest > 0").groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(counts, window)  # one count per length below the window
    base = F.coalesce(F.sum("n").over(Window.partitionBy("rest").orderBy("part")
                                      .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = by.select("part", "rest", base.alias("base"))
    # one row per input partition
    whole = by.groupBy("part").agg(F.sum("full").alias("full")).select("part", F.coalesce(
        F.sum("full").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base_full"))
    placed = measured.join(ranks, ["part", "rest"]).join(F.broadcast(whole), "part").select(
        "doc_id", "crc", "n_tokens", "crcs", "rest", (F.col("base") + F.col("number")).alias("rank"),
        (F.col("base_full") + F.col("before")).alias("first"))
    pieces = arrow_map(placed, place_kernel, "doc_id long, crc long, n_tokens long, start long, length long, "
                       "ids_crc32 long, sequence_id long, offset long", docs.sparkSession.sparkContext.broadcast(plan))
    if plan.cuts:
        pieces = cut_lineage(pieces)
        pieces = pieces.where("ids_crc32 IS NOT NULL").unionByName(_with_checksums(
            pieces.where("ids_crc32 IS NULL"), rows, plan.cuts <= BROADCAST_CUTS, vocab, end_id))
    return pieces.select("doc_id", "start", "length", "ids_crc32", F.col("n_tokens").alias("doc_tokens"),
                         "sequence_id", "offset")


def _with_checksums(pieces: DataFrame, rows: DataFrame, few: bool, vocab: tuple, end_id: int) -> DataFrame:
    """Pieces of cut remainders with their checksums, from the texts. Repeated rows
    share them: a piece is known by its document's id, checksum and place."""
    wanted = pieces.select("doc_id", "crc", "n_tokens", "start", "length").distinct().groupBy("doc_id").agg(
        F.collect_list(F.struct("crc", "n_tokens", "start", "length")).alias("pieces")) \
        .withColumnRenamed("doc_id", "_id")
    wanted = F.broadcast(wanted) if few else wanted
    texts = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id"))).select("doc_id", "text", "pieces")
    sums = arrow_map(texts, checksum_kernel, "doc_id long, crc long, start long, length long, piece_crc32 long",
                     vocab, end_id).distinct().select(*[F.col(c).alias(f"_{c}") for c in ("doc_id", "crc", "start", "length")],
                                                      "piece_crc32")
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    for c in ("crc", "start", "length"):
        same = same & (F.col(c) == F.col(f"_{c}"))
    return pieces.join(F.broadcast(sums) if few else sums, same).withColumn("ids_crc32", F.col("piece_crc32")) \
        .select(*pieces.columns)
