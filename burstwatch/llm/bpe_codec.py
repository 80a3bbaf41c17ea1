"""Byte-level BPE by a global shuffle of distinct words.

Texts fall into pre-tokens (words) by the vocabulary's pattern. A chunk of texts
lists its distinct words, each with its positions; the words are dealt by hash to
buckets over the whole input, and in a bucket each distinct word is merged once.
The identifiers go back beside the positions, a chunk's rows meet again, and the
positions put each text's identifiers in order. Decoding looks identifiers up in
the table of token bytes. A word that stands in every chunk adds one entry per
chunk, so no bucket grows with a hot word."""

from __future__ import annotations

import functools
import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from burstwatch.llm.tasks import arrow_groups, arrow_map, input_partitions, record_batch, slices, task_id
from burstwatch.llm.vocab import ranks

#: Text bytes of a chunk (one longer text is a chunk by itself).
CHUNK_BYTES = 28_000_000
#: Entries of the words that a worker keeps (their merges are made once a bucket).
MEMO_WORDS = 400_000


@functools.lru_cache(maxsize=2)
def pre_tokens(pattern: str):
    import regex

    return regex.compile(pattern).findall


class Merger(dict):
    """word bytes -> identifiers, by lowest-rank merges."""

    def __init__(self, path: str):
        self.ranks = ranks(path)

    def merged(self, word: bytes) -> list[int]:
        rank = self.ranks
        whole = rank.get(word)
        if whole is not None:
            return [whole]
        parts = [word[i:i + 1] for i in range(len(word))]
        if len(parts) > 200:
            return self._long(parts)
        none = len(rank)
        pairs = [rank.get(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs:
            least = min(pairs)
            if least == none:
                break
            i = pairs.index(least)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank.get(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = rank.get(parts[i - 1] + parts[i], none)
        return [rank[p] for p in parts]

    def _long(self, parts: list) -> list[int]:
        """The same for long words, with a heap over linked parts."""
        from heapq import heapify, heappop, heappush

        rank, n = self.ranks, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[p], i, p) for i in range(n - 1) if (p := parts[i] + parts[i + 1]) in rank]
        heapify(heap)
        while heap:
            _, i, pair = heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or parts[i] + parts[j] != pair:
                continue
            parts[i], parts[j] = pair, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b < n and (p := parts[a] + parts[b]) in rank:
                    heappush(heap, (rank[p], a, p))
        return [rank[p] for p in parts if p is not None]

    def __missing__(self, word: bytes) -> list[int]:
        ids = self.merged(word)
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = ids
        return ids


@functools.lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    return Merger(path)


@functools.lru_cache(maxsize=2)
def token_tables(path: str) -> tuple[list[bytes], list[str]]:
    """Identifier -> bytes, and identifier -> decimal text."""
    table = ranks(path)
    out = [b""] * (max(table.values()) + 1)
    for token, i in table.items():
        out[i] = token
    return out, [str(i) for i in range(len(out))]


# ------------------------------------------------------------------ packed numbers

def pack(*columns: np.ndarray) -> bytes:
    """Unsigned numbers, each column by planes of its bytes (as many as its largest needs)."""
    out = []
    for c in columns:
        raw = np.ascontiguousarray(c, "<u4")
        width = max(1, (int(raw.max(initial=0)).bit_length() + 7) // 8)
        planes = raw.view(np.uint8).reshape(-1, 4)[:, :width].T
        out += [bytes([width]), len(c).to_bytes(4, "little"), planes.tobytes()]
    return b"".join(out)


def unpack(raw: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(raw):
        width, n = raw[at], int.from_bytes(raw[at + 1:at + 5], "little")
        planes = np.frombuffer(raw, np.uint8, width * n, at + 5).reshape(width, n)
        full = np.zeros((n, 4), np.uint8)
        full[:, :width] = planes.T
        out.append(full.reshape(-1).view("<u4").copy() if n else np.zeros(0, np.uint32))
        at += 5 + width * n
    return out


def low_bits(total: int, n: np.ndarray) -> np.ndarray:
    """Bits of a gap that are stored plainly for words that stand n times in a chunk of
    ``total`` words: some fewer than the mean gap has, as the rest compresses well."""
    return np.maximum(0, np.frexp(total / np.maximum(1, n))[1] - 4)


def pack_gaps(gaps: np.ndarray, bits: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(low bits of the gaps, rest of each gap). ``bits``, per gap, never rises, so the
    gaps that have a certain bit come first and each bit is one packed row."""
    rows = [np.packbits((gaps[:np.searchsorted(-bits, -j, side="left")] >> j).astype(np.uint8) & 1)
            for j in range(int(bits.max(initial=0)))]
    return b"".join(r.tobytes() for r in rows), gaps >> bits


def unpack_gaps(raw: bytes, rest: np.ndarray, bits: np.ndarray) -> np.ndarray:
    gaps, data, at = rest.astype(np.int64) << bits, np.frombuffer(raw, np.uint8), 0
    for j in range(int(bits.max(initial=0))):
        n = int(np.searchsorted(-bits, -j, side="left"))
        size = (n + 7) // 8
        gaps[:n] |= np.unpackbits(data[at:at + size], count=n).astype(np.int64) << j
        at += size
    return gaps


# ------------------------------------------------------------------ kernels

def _zip(raw: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(raw)


def _unzip(raw: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(raw)


def _chunk_rows(chunk: int, docs: list, texts: list[str | None], findall, buckets: int):
    """(chunk, bucket, words, places, docs) rows of a chunk. A negative bucket (any) has
    the documents and their numbers of words; others the words of that bucket (their
    sizes and bytes) and, apart, how often and where they stand."""
    seen: dict[str, int] = {}
    of, sizes = [], []
    for t in texts:
        found = findall(t) if t else []
        sizes.append(len(found))
        of.append(np.fromiter((seen.setdefault(w, len(seen)) for w in found), np.uint32, len(found)))
    place = np.concatenate(of) if of else np.zeros(0, np.uint32)
    yield chunk, -1 - chunk % (1 << 20), _zip(pack(np.array(sizes, np.uint32))), b"", docs
    order = np.argsort(place, kind="stable")
    counts = np.bincount(place, minlength=len(seen))
    firsts = np.cumsum(counts) - counts
    gaps = np.diff(order, prepend=0)
    if len(order):
        gaps[firsts] = order[firsts]
    words = [w.encode("utf-8", "surrogatepass") for w in seen]
    bits = low_bits(len(place), counts)
    dealt: list[list[int]] = [[] for _ in range(buckets)]
    for i, w in enumerate(words):
        dealt[zlib.crc32(w) % buckets].append(i)
    for bucket, mine in enumerate(dealt):
        if not mine:
            continue
        # rare words first, then by their bytes
        mine = np.array(sorted(mine, key=lambda i: (-bits[i], words[i])))
        n = counts[mine]
        # the positions of word i are gaps[firsts[i]:firsts[i] + counts[i]]
        at = np.repeat(firsts[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        low, rest = pack_gaps(gaps[at], np.repeat(bits[mine], n))
        own = [words[i] for i in mine]
        head = pack(np.fromiter(map(len, own), np.uint32, len(own)))
        numbers = _zip(pack(n, rest))
        yield (chunk, bucket, _zip(len(head).to_bytes(4, "little") + head + b"".join(own)),
               len(place).to_bytes(4, "little") + len(numbers).to_bytes(4, "little") + numbers + low, [])


def places(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(how often each word stands, the gaps between its places) of a row."""
    total, size = int.from_bytes(raw[:4], "little"), int.from_bytes(raw[4:8], "little")
    n, rest = unpack(_unzip(raw[8:8 + size]))
    return n.astype(np.int64), unpack_gaps(raw[8 + size:], rest, np.repeat(low_bits(total, n), n))


def _batches(rows, of: int = 64):
    held = []
    for r in rows:
        held.append(r)
        if len(held) >= of:
            yield _rows(held)
            held = []
    if held:
        yield _rows(held)


def _rows(held):
    return record_batch({"chunk": [r[0] for r in held], "bucket": [r[1] for r in held], "data": [r[2] for r in held],
                         "places": [r[3] for r in held], "doc_ids": [r[4] for r in held]},
                        chunk=pa.int64(), bucket=pa.int32(), data=pa.binary(), places=pa.binary(),
                        doc_ids=pa.list_(pa.int64()))


def explode_kernel(batches, pattern: str, buckets: int):
    findall, chunk = pre_tokens(pattern), task_id() << 32

    def rows():
        nonlocal chunk
        docs, texts, size = [], [], 0
        for b in slices(batches, "text", CHUNK_BYTES):
            n = b.column("text").nbytes
            if texts and size + n > CHUNK_BYTES:
                yield from _chunk_rows(chunk, docs, texts, findall, buckets)
                chunk, docs, texts, size = chunk + 1, [], [], 0
            docs += b.column("doc_id").to_pylist()
            texts += b.column("text").to_pylist()
            size += n
        if docs:
            yield from _chunk_rows(chunk, docs, texts, findall, buckets)

    yield from _batches(rows())


def encode_kernel(batches, path: str):
    """Words of a bucket -> their identifiers; places and documents pass."""
    m = merger(path)

    def rows():
        for b in batches:
            for at in range(b.num_rows):  # a row at a time: rows are large
                chunk, bucket, data, where, docs = (b.column(c)[at].as_py() for c in ("chunk", "bucket", "data", "places", "doc_ids"))
                if bucket < 0:
                    yield chunk, bucket, data, where, docs
                    continue
                raw = _unzip(data)
                head = int.from_bytes(raw[:4], "little")
                ends = (np.cumsum(unpack(raw[4:4 + head])[0].astype(np.int64)) + 4 + head).tolist()
                ids = [m[raw[a:e]] for a, e in zip([4 + head, *ends[:-1]], ends)]
                flat = np.fromiter((i for x in ids for i in x), np.uint32)
                yield chunk, bucket, _zip(pack(np.fromiter(map(len, ids), np.uint32, len(ids)), flat)), where, []

    yield from _batches(rows())


def chunk_ids(rows: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(identifiers of a whole chunk in order, where each word's begin) from the
    (identifiers, places) of its buckets."""
    parts = [(*unpack(_unzip(data)), *places(where)) for data, where in rows]
    lens = np.zeros(sum(int(n.sum()) for _, _, n, _ in parts), np.int64)
    spots = []
    for sizes, _, n, gaps in parts:
        # places: running sums of the gaps, anew for each word
        sums = np.cumsum(gaps)
        firsts = np.cumsum(n) - n
        at = sums - np.repeat(np.where(firsts > 0, sums[firsts - 1], 0), n)
        lens[at] = np.repeat(sizes.astype(np.int64), n)
        spots.append(at)
    begins = np.cumsum(lens) - lens
    out = np.zeros(int(lens.sum()), np.uint32)
    for (sizes, flat, n, _), at in zip(parts, spots):
        own = sizes.astype(np.int64)
        size = np.repeat(own, n)
        inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        src = np.repeat(np.cumsum(own) - own, n)
        out[np.repeat(begins[at], size) + inner] = flat[np.repeat(src, size) + inner]
    return out, begins


def _chunk(table: pa.Table) -> tuple[list, np.ndarray, np.ndarray]:
    """(documents, identifiers, ends of the documents) of the rows of one chunk."""
    docs, sizes, rows = [], np.zeros(0, np.int64), []
    for bucket, data, where, ids in zip(*(table.column(c).to_pylist() for c in ("bucket", "data", "places", "doc_ids"))):
        if bucket < 0:
            docs, sizes = ids, unpack(_unzip(data))[0].astype(np.int64)
        else:
            rows.append((data, where))
    ids, begins = chunk_ids(rows)
    return docs, ids, np.append(begins, len(ids))[np.cumsum(sizes)]


def reassemble_kernel(table: pa.Table) -> pa.Table:
    docs, ids, ends = _chunk(table)
    return pa.table({"doc_id": pa.array(docs, pa.int64()),
                     "ids": pa.array([x.astype(np.int64) for x in np.split(ids, ends[:-1])], pa.list_(pa.int64()))})


def digest_kernel(table: pa.Table, path: str) -> pa.Table:
    docs, ids, ends = _chunk(table)
    to_bytes, to_text = token_tables(path)
    n, sums, decoded, at = [], [], [], 0
    for e in ends.tolist():
        mine = ids[at:e].tolist()
        n.append(e - at)
        sums.append(hashlib.sha256(" ".join([to_text[i] for i in mine]).encode()).hexdigest())
        decoded.append(hashlib.sha256(b"".join([to_bytes[i] for i in mine])).hexdigest())
        at = e
    return pa.table({"doc_id": pa.array(docs, pa.int64()), "n_tokens": pa.array(n, pa.int64()),
                     "ids_sha256": pa.array(sums, pa.string()), "decoded_sha256": pa.array(decoded, pa.string())})


def decode_kernel(batches, path: str):
    to_bytes, _ = token_tables(path)
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            yield record_batch({"doc_id": part.column("doc_id"),
                                "bytes": [None if x is None else b"".join([to_bytes[i] for i in x])
                                          for x in part.column("ids").to_pylist()]}, bytes=pa.binary())


# ------------------------------------------------------------------ the operator

_ROWS = "chunk long, bucket int, data binary, places binary, doc_ids array<long>"


def _coded(docs: DataFrame, path: str, pattern: str, id_col: str, text_col: str) -> DataFrame:
    n = input_partitions(docs.sparkSession)
    buckets = 2 * n  # of words: more than partitions, so that these fill evenly
    rows = docs.selectExpr(f"CAST(`{id_col}` AS LONG) AS doc_id", f"CAST(`{text_col}` AS STRING) AS text")
    words = arrow_map(rows, explode_kernel, _ROWS, pattern, buckets)
    return arrow_map(words.repartition(n, "bucket"), encode_kernel, _ROWS, path)


def bpe_encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id and ids (array<long>), as the rank file's library gives
    them without special tokens.

    Null and empty texts have no ids; null ids and repeated rows come back as they
    are; an empty table gives no rows. A chunk (bounded; a longer text alone) is the
    most that a task holds."""
    return arrow_groups(_coded(docs, path, pattern, id_col, text_col), ["chunk"], reassemble_kernel,
                        "doc_id long, ids array<long>")


def bpe_decode(ids: DataFrame, path: str) -> DataFrame:
    """Per row of (doc_id, ids): doc_id and the decoded bytes; null ids give null."""
    return arrow_map(ids.select("doc_id", "ids"), decode_kernel, "doc_id long, bytes binary", path)


def bpe_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``bpe_encode`` and ``bpe_decode`` with digests in place of the long columns: doc_id,
    n_tokens, ids_sha256, decoded_sha256."""
    return arrow_groups(_coded(docs, path, pattern, id_col, text_col), ["chunk"], digest_kernel,
                        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", path)
