"""The plan against brute force, and pieces against the tokens of whole documents."""

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from burstwatch.llm.packing import Plan, closest_multiset, pack_sequences
from burstwatch.llm.parameters import VOCAB

TOK = Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def test_closest_multiset_is_the_best():
    r = random.Random(1)
    for _ in range(200):
        items = [r.randint(1, 30) for _ in range(r.randint(0, 8))]
        room = r.randint(1, 60)
        counts = sorted({k: items.count(k) for k in items}.items(), reverse=True)
        got = closest_multiset(counts, room)
        best = max(sum(s) for n in range(len(items) + 1) for s in itertools.combinations(items, n) if sum(s) <= room)
        assert sum(k * n for k, n in got.items()) == best
        assert all(items.count(k) >= n for k, n in got.items())


@pytest.mark.parametrize("counts", [
    {}, {1: 1}, {2047: 1}, {1500: 100_000}, {1025: 7, 1024: 3}, {3: 5, 700: 10, 2000: 4},
    {k: k % 7 + 1 for k in range(1, 2048)}, {k: 10 ** 6 if k == 333 else 1 for k in range(1, 2048, 5)}])
def test_plan_fills_windows(counts):
    plan = Plan(counts, 2048)
    assert sum(len(s) for s, _ in plan.runs.values()) < 40_000
    if sum(counts.values()) > 200_000:
        return
    filled = defaultdict(list)
    for k, n in counts.items():
        for rank in range(n):
            pieces = plan.pieces(k, rank)
            assert sum(p[0] for p in pieces) == k
            for size, window, offset in pieces:
                filled[window].append((offset, size))
    assert sorted(filled) == list(range(plan.windows))
    sizes = []
    for spans in filled.values():
        at = 0
        for offset, size in sorted(spans):
            assert offset == at and size > 0
            at += size
        sizes.append(at)
    assert all(s == 2048 or s & (s - 1) == 0 for s in sizes)
    assert sum(s < 2048 for s in sizes) <= 11


def check(docs, pieces):
    want = defaultdict(list)
    for r in docs:
        want[r.doc_id].append(np.array([*TOK.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4"))
    got, windows = defaultdict(list), defaultdict(list)
    for p in pieces:
        got[p.doc_id].append(p)
        windows[p.sequence_id].append((p.offset, p.length))
    assert set(got) == set(want)
    for doc, texts in want.items():
        assert sum(p.length for p in got[doc]) == sum(map(len, texts))
        if len(texts) == 1:
            at = 0
            for p in sorted(got[doc], key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(texts[0])
                assert p.ids_crc32 == zlib.crc32(texts[0][at:at + p.length].tobytes())
                at += p.length
    short = 0
    for spans in windows.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)
        short += at < 2048
    assert short <= 11


def test_pieces(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(docs.collect(), pack_sequences(docs, VOCAB).collect())


def test_edges(spark):
    long = "the quick brown " * 100_000
    rows = [(1, None), (2, ""), (None, "null id"), (3, "same"), (3, "same"), (4, long), (5, "<|endoftext|> x")] \
        + [(10 + i, "word " * 1500) for i in range(9)]
    docs = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, length int").repartition(3)
    got = pack_sequences(docs, VOCAB).collect()
    check(docs.collect(), got)
    assert len([p for p in got if p.doc_id == 3]) >= 2
    assert pack_sequences(docs.limit(0), VOCAB).count() == 0
    only = pack_sequences(docs.where("doc_id = 1"), VOCAB).collect()
    assert [(p.start, p.length, p.doc_tokens, p.offset) for p in only] == [(0, 1, 1, 0)]
