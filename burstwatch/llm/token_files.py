"""Token files: identifiers of whole documents, coded by a static range
asymmetric numeral system.

One frequency table, counted over all documents and scaled to 2^20 slots, is
shared by independent blocks of whole documents. The tokens of a block are dealt
round-robin to lanes of at most LANE_TOKENS tokens; each lane has its own 64-bit
state and 32-bit words, so lanes of many blocks are coded together, step by
step, as arrays. A block stores, per lane, a checkpoint (final state and number
of words) from which that lane can be decoded alone, and the CRC-32 of its
identifiers.

Files: ``<root>/frequencies`` (id, slots) and ``<root>/blocks/part=<p>`` with rows
(block, first_token, doc_ids, doc_tokens, n_tokens, checkpoints, words, crc32);
ascending (part, block) is ascending doc_id."""

from __future__ import annotations

import functools
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from burstwatch.llm.tasks import arrow_map, input_partitions, record_batch, slices, task_id
from burstwatch.llm.vocab import encoder
from burstwatch.session import ensure_checkpoint_dir, remove_path

LANE_TOKENS = 512
BLOCK_TOKENS = 32_768
#: Tokens whose blocks are coded together in a task.
GROUP_TOKENS = 1_000_000
#: Slots of the frequency table (2^BITS): twenty times the identifiers of a vocabulary,
#: so that rare ones, which have a slot each, take little from the others. States are at
#: least LOW, which leaves at most one word to be written for a token.
BITS = 20
LOW = 1 << 32


# ------------------------------------------------------------------ the coder

def scaled(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Slots (summing to 2^BITS, at least 1 each) of the identifiers that occur: those
    whose share is below a slot get one, the others what is left in proportion, by largest
    remainders (ties: the smaller identifier). More identifiers than slots are an error."""
    if len(ids) > 1 << BITS:
        raise ValueError("more distinct identifiers than slots")
    counts = np.asarray(counts, np.float64)
    slots, large = np.ones(len(ids), np.int64), np.ones(len(ids), bool)
    while large.any():
        rest = (1 << BITS) - int((~large).sum())
        share = counts * (rest / counts[large].sum())
        small = large & (share < 1)
        if not small.any():
            floor = np.floor(share[large]).astype(np.int64)
            where = np.flatnonzero(large)
            order = np.lexsort((ids[where], floor - share[large]))
            floor[order[:rest - int(floor.sum())]] += 1
            slots[where] = floor
            break
        large &= ~small
    return slots


class Coder:
    """Codes blocks with one table of (identifier, slots). The symbol after the last
    has all slots: coding it changes no state, so short lanes are filled with it."""

    def __init__(self, ids: np.ndarray, slots: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, slots = ids[order], slots[order].astype(np.uint64)
        self.freq = np.append(slots, np.uint64(1 << BITS))
        self.base = np.append(np.concatenate(([0], np.cumsum(slots)[:-1])), 0).astype(np.uint64) \
            if len(slots) else np.zeros(1, np.uint64)
        self.symbol = np.repeat(np.arange(len(slots), dtype=np.int32), slots.astype(np.int64))
        self.index = np.full(int(self.ids.max(initial=-1)) + 1, -1, np.int64)
        self.index[self.ids] = np.arange(len(self.ids))

    @staticmethod
    def _lanes(n: int) -> tuple[int, int]:
        m = max(1, -(-n // LANE_TOKENS))
        return m, -(-n // m)

    def encode(self, blocks: list[np.ndarray]) -> list[tuple[bytes, bytes]]:
        """(checkpoints, words) of each block."""
        shapes = [self._lanes(len(b)) for b in blocks]
        width, steps = sum(m for m, _ in shapes), max((s for _, s in shapes), default=0)
        grid = np.full((steps, width), len(self.ids), np.int32)
        at = 0
        for b, (m, s) in zip(blocks, shapes):
            cells = np.full(m * s, len(self.ids), np.int32)
            cells[:len(b)] = self.index[b]
            grid[:s, at:at + m] = cells.reshape(s, m)
            at += m
        x = np.full(width, LOW, np.uint64)
        out = np.zeros((steps, width), np.uint32)
        full = np.zeros((steps, width), bool)
        word, bits, top = np.uint64(32), np.uint64(BITS), np.uint64(64 - BITS)
        for s in range(steps - 1, -1, -1):
            f, c = self.freq[grid[s]], self.base[grid[s]]
            emit = (x >> top) >= f
            out[s], full[s] = x & np.uint64(0xFFFFFFFF), emit
            x = np.where(emit, x >> word, x)
            q = x // f
            x = (q << bits) + (x - q * f) + c
        words, kept = np.ascontiguousarray(out.T), np.ascontiguousarray(full.T)
        made, at = [], 0
        for m, _ in shapes:
            k, w = kept[at:at + m], words[at:at + m]
            check = x[at:at + m].astype("<u8").tobytes() + k.sum(axis=1).astype("<u4").tobytes()
            made.append((check, w[k].astype("<u4").tobytes()))
            at += m
        return made

    def decode(self, coded: list[tuple[int, bytes, bytes]]) -> list[np.ndarray]:
        """Identifiers of blocks given as (n_tokens, checkpoints, words)."""
        shapes = [self._lanes(n) for n, _, _ in coded]
        steps = max((s for _, s in shapes), default=0)
        if not coded:
            return []
        x = np.concatenate([np.frombuffer(c, "<u8", len(c) // 12) for _, c, _ in coded]).astype(np.uint64)
        lengths = np.concatenate([np.frombuffer(c, "<u4", offset=len(c) // 12 * 8) for _, c, _ in coded]).astype(np.int64)
        words = np.concatenate([np.frombuffer(w, "<u4") for _, _, w in coded] + [np.zeros(1, "<u4")]).astype(np.uint64)
        at = np.cumsum(lengths) - lengths
        ends = np.concatenate([np.where(np.arange(m) < n - m * (s - 1), s, s - 1)
                               for (n, _, _), (m, s) in zip(coded, shapes)])  # steps of each lane
        grid = np.zeros((steps, len(x)), np.int32)
        word, bits, low = np.uint64(32), np.uint64(BITS), np.uint64(LOW)
        mask = np.uint64((1 << BITS) - 1)
        even = int(ends.min(initial=0))
        for s in range(steps):
            slot = x & mask
            sym = self.symbol[slot]
            new = self.freq[sym] * (x >> bits) + slot - self.base[sym]
            if s >= even:  # lanes that have ended keep their state
                live = ends > s
                new = np.where(live, new, x)
            need = new < low
            x = np.where(need, (new << word) | words[np.minimum(at, len(words) - 1)], new)
            at += need
            grid[s] = sym
        made, col = [], 0
        for (n, _, _), (m, s) in zip(coded, shapes):
            made.append(self.ids[grid[:s, col:col + m].reshape(-1)[:n]].astype(np.uint32))
            col += m
        return made


@functools.lru_cache(maxsize=2)
def _coder(ids: bytes, slots: bytes) -> Coder:
    return Coder(np.frombuffer(ids, "<i8"), np.frombuffer(slots, "<i8"))


# ------------------------------------------------------------------ kernels

def blocks_kernel(batches, vocab: tuple, end_id: int, block_tokens: int):
    """Blocks of whole documents, in the order of the rows."""
    ids_of = encoder(*vocab)
    part, block, offset = task_id(), 0, 0
    docs, sizes, held, total, rows = [], [], [], 0, []

    def row():
        ids = np.concatenate(held).astype("<u4")
        return (part, block, offset, docs, sizes, total, ids)

    def batch(rows):
        wide = any(r[6].max(initial=0) >= 1 << 16 for r in rows)
        return record_batch({"part": [r[0] for r in rows], "block": [r[1] for r in rows],
                             "offset": [r[2] for r in rows], "doc_ids": [r[3] for r in rows],
                             "doc_tokens": [r[4] for r in rows], "n_tokens": [r[5] for r in rows],
                             "wide": [wide] * len(rows),
                             "ids": [r[6].astype("<u4" if wide else "<u2").tobytes() for r in rows]},
                            part=pa.int32(), block=pa.int64(), offset=pa.int64(), doc_ids=pa.list_(pa.int64()),
                            doc_tokens=pa.list_(pa.int64()), n_tokens=pa.int64(), ids=pa.binary())

    end = np.array([end_id], np.uint32)
    for b in slices(batches, "text"):
        for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            ids = ids_of(text)
            docs.append(doc)
            sizes.append(len(ids) + 1)
            held += [ids, end]
            total += len(ids) + 1
            if total >= block_tokens:
                rows.append(row())
                block, offset = block + 1, offset + total
                docs, sizes, held, total = [], [], [], 0
                if len(rows) >= 16:
                    yield batch(rows)
                    rows = []
    if docs:
        rows.append(row())
    if rows:
        yield batch(rows)


def _ids(row_ids, wide) -> np.ndarray:
    return np.frombuffer(row_ids, "<u4" if wide else "<u2")


def counts_kernel(batches):
    counts = np.zeros(0, np.int64)
    for b in batches:
        for ids, wide in zip(b.column("ids").to_pylist(), b.column("wide").to_pylist()):
            c = np.bincount(_ids(ids, wide))
            if len(c) > len(counts):
                c[:len(counts)] += counts
                counts = c
            else:
                counts[:len(c)] += c
    seen = np.flatnonzero(counts)
    yield record_batch({"id": seen, "n": counts[seen]}, id=pa.int64(), n=pa.int64())


def _groups(batches, sizes: str):
    """Runs of rows of about GROUP_TOKENS tokens."""
    for b in batches:
        n = np.cumsum(b.column(sizes).to_numpy())
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(n, (n[at - 1] if at else 0) + GROUP_TOKENS, side="right")))
            yield b.slice(at, to - at)
            at = to


def encode_kernel(batches, table):
    coder = _coder(*table.value)
    for b in _groups(batches, "n_tokens"):
        ids = [_ids(i, w) for i, w in zip(b.column("ids").to_pylist(), b.column("wide").to_pylist())]
        coded = coder.encode(ids)
        keep = {c: b.column(c) for c in ("part", "block", "first_token", "doc_ids", "doc_tokens", "n_tokens")}
        yield record_batch(keep | {"checkpoints": [c for c, _ in coded], "words": [w for _, w in coded],
                                   "crc32": [zlib.crc32(i.astype("<u4").tobytes()) for i in ids]},
                           checkpoints=pa.binary(), words=pa.binary(), crc32=pa.int64())


def decode_kernel(batches, table, with_ids: bool):
    coder = _coder(*table.value)
    for b in _groups(batches, "n_tokens"):
        sizes = b.column("n_tokens").to_pylist()
        blocks = coder.decode(list(zip(sizes, b.column("checkpoints").to_pylist(), b.column("words").to_pylist())))
        out: dict[str, list] = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
        texts = []
        for ids, crc, first, docs, lens in zip(blocks, *(b.column(c).to_pylist() for c in (
                "crc32", "first_token", "doc_ids", "doc_tokens"))):
            raw = ids.astype("<u4").tobytes()
            if zlib.crc32(raw) != crc:
                raise ValueError(f"checksum of the block at token {first} does not hold")
            at = 0
            for doc, n in zip(docs, lens):
                out["doc_id"].append(doc)
                out["start"].append(first + at)
                out["n_tokens"].append(n)
                out["ids_crc32"].append(zlib.crc32(raw[4 * at:4 * (at + n)]))
                if with_ids:
                    texts.append(ids[at:at + n].astype(np.int64))
                at += n
        extra = {"ids": texts} if with_ids else {}
        yield record_batch(out | extra, doc_id=pa.int64(), start=pa.int64(), n_tokens=pa.int64(),
                           ids_crc32=pa.int64(), ids=pa.list_(pa.int64()))


# ------------------------------------------------------------------ the operator

def write_token_files(docs: DataFrame, root: str, vocab: tuple, end_id: int = 0,
                      block_tokens: int = BLOCK_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the identifiers of all documents (each followed by ``end_id``) under
    ``root``, in ascending id order (null ids first; repeated ids by text).

    ``vocab`` is (rank file, pattern, end-of-text string). Null and empty texts are
    one ``end_id``. The texts are range-partitioned once; the counts and the coding
    read the block table stored under ``root``. The frequency table (bounded by the
    vocabulary) and the tokens per partition are all that the driver or a
    broadcast holds. An empty table makes files without rows."""
    spark = docs.sparkSession
    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
               .repartitionByRange(input_partitions(spark), "doc_id", F.xxhash64("text"))
               .sortWithinPartitions("doc_id", F.xxhash64("text")))
    plain = arrow_map(ordered, blocks_kernel, "part int, block long, offset long, doc_ids array<long>, "
                      "doc_tokens array<long>, n_tokens long, wide boolean, ids binary", vocab, end_id, block_tokens)
    plain.write.option("compression", "zstd").parquet(f"{root}/plain")
    plain = spark.read.schema(plain.schema).parquet(f"{root}/plain")
    counts = arrow_map(plain.select("ids", "wide"), counts_kernel, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    rows = sorted((r.id, r.n) for r in counts.collect())  # one row per identifier of the vocabulary
    ids = np.array([r[0] for r in rows], np.int64)
    slots = scaled(ids, np.array([r[1] for r in rows], np.int64)) if rows else ids
    spark.createDataFrame([(int(i), int(s)) for i, s in zip(ids, slots)], "id long, slots long") \
        .coalesce(1).write.parquet(f"{root}/frequencies")
    table = spark.sparkContext.broadcast((ids.astype("<i8").tobytes(), slots.astype("<i8").tobytes()))
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = plain.groupBy("part").agg(F.sum("n_tokens").alias("tokens")).select(
        "part", F.coalesce(before, F.lit(0)).alias("base"))  # one row per partition
    placed = plain.join(F.broadcast(parts), "part").withColumn("first_token", F.col("base") + F.col("offset"))
    coded = arrow_map(placed.drop("base", "offset"), encode_kernel,
                      "part int, block long, first_token long, doc_ids array<long>, doc_tokens array<long>, "
                      "n_tokens long, checkpoints binary, words binary, crc32 long", table)
    (coded.sortWithinPartitions("part", "block").write.partitionBy("part")
     .option("compression", "uncompressed").parquet(f"{root}/blocks"))
    remove_path(spark, f"{root}/plain")


_BLOCKS = ("block long, first_token long, doc_ids array<long>, doc_tokens array<long>, n_tokens long, "
           "checkpoints binary, words binary, crc32 long, part int")


def read_token_files(spark: SparkSession, root: str, with_ids: bool = False) -> DataFrame:
    """Decode the files under ``root``: one row per document with doc_id, start,
    n_tokens and ids_crc32, and ``ids`` if asked for. Checksums are verified."""
    freq = spark.read.schema("id long, slots long").parquet(f"{root}/frequencies").collect()
    table = spark.sparkContext.broadcast((np.array([r.id for r in freq], "<i8").tobytes(),
                                          np.array([r.slots for r in freq], "<i8").tobytes()))
    blocks = spark.read.schema(_BLOCKS).parquet(f"{root}/blocks").drop("part", "block")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return arrow_map(blocks, decode_kernel, schema, table, with_ids)


def fresh_root(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
