"""Against tiktoken, and the round trip."""

import hashlib
import random

import public_tokenizers as P
import regex
import tiktoken

from burstwatch.llm.bpe_codec import Merger, bpe_decode, bpe_digests, bpe_encode
from burstwatch.llm.vocab import ranks

PATH = P.path("byte_bpe_50k.tiktoken")
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks(PATH), special_tokens={})


def test_merges_of_single_words():
    m, r = Merger(PATH), random.Random(5)
    for _ in range(3000):
        w = "".join(r.choice("abcdeinorst éß日🙂'!0") for _ in range(r.randint(1, 30)))
        for x in regex.findall(P.PATTERN, w):
            assert m[x.encode()] == ENC.encode_ordinary(x)
    long = "abcde" * 400
    assert m[long.encode()] == ENC.encode_ordinary(long)


def test_texts_and_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.doc_id: ENC.encode_ordinary(r.text) for r in docs.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = bpe_encode(docs, PATH, P.PATTERN)
    assert {r.doc_id: r.ids for r in ids.collect()} == want
    assert {r.doc_id: bytes(r.bytes).decode() for r in bpe_decode(ids, PATH).collect()} == texts
    for r in bpe_digests(docs, PATH, P.PATTERN).collect():
        assert r.n_tokens == len(want[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want[r.doc_id])).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "a\n\n b <|endoftext|>"), (3, "same text"), (3, "same text"),
            (4, "word " * 700_000 + "x" * 5000), (5, " \t\n  "), (6, "日本語🙂\x00")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, ids int")
    got = sorted(((r.doc_id, r.n_tokens, r.decoded_sha256) for r in bpe_digests(docs, PATH, P.PATTERN).collect()), key=str)
    assert got == sorted(((i, len(ENC.encode_ordinary(t or "")), hashlib.sha256((t or "").encode()).hexdigest())
                          for i, t in rows), key=str)
    assert bpe_digests(docs.limit(0), PATH, P.PATTERN).count() == 0
    assert bpe_encode(docs.where("doc_id = 1"), PATH, P.PATTERN).first().ids == []
