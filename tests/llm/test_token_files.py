"""The coder's round trip, and files against the tokens of the library."""

import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from burstwatch.llm.parameters import VOCAB
from burstwatch.llm.token_files import Coder, fresh_root, read_token_files, scaled, write_token_files
from burstwatch.llm.vocab import encoder

TOK = Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def coder_of(data):
    ids, n = np.unique(data, return_counts=True)
    return Coder(ids.astype(np.int64), scaled(ids.astype(np.int64), n))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 70_000), min_size=1, max_size=1500), min_size=1, max_size=6))
def test_blocks_round_trip(blocks):
    blocks = [np.array(b, np.uint32) for b in blocks]
    c = coder_of(np.concatenate(blocks))
    coded = c.encode(blocks)
    back = c.decode([(len(b), *x) for b, x in zip(blocks, coded)])
    assert all(a.tolist() == b.tolist() for a, b in zip(blocks, back))


def test_size_is_near_the_entropy():
    g = np.random.default_rng(0)
    data = np.minimum(g.zipf(1.3, 300_000), 50_000).astype(np.uint32)
    _, n = np.unique(data, return_counts=True)
    bits = -(n * np.log2(n / n.sum())).sum()
    size = sum(len(a) + len(b) for a, b in coder_of(data).encode([data]))
    assert size * 8 < 1.06 * bits  # checkpoints included


def test_slots_cover_every_identifier():
    s = scaled(np.arange(60_000), np.append(np.full(59_999, 1), 10 ** 9))
    assert s.sum() == 1 << 20 and s.min() >= 1
    assert scaled(np.array([9]), np.array([3])).tolist() == [1 << 20]
    assert scaled(np.arange(3), np.array([1, 1, 1])).tolist() == [349526, 349525, 349525]
    assert len(scaled(np.zeros(0, np.int64), np.zeros(0))) == 0
    with pytest.raises(ValueError):
        scaled(np.arange((1 << 20) + 1), np.ones((1 << 20) + 1))


def test_the_whole_vocabulary_stays_near_its_entropy():
    """Every identifier of the vocabulary occurs, by a Zipf law with a thick tail."""
    ids = np.arange(50_257)
    counts = np.maximum(1, np.floor(10 ** 10 / (ids + 3.0)))
    share = counts / counts.sum()
    bits = -(share * np.log2(share)).sum()
    assert -(share * np.log2(scaled(ids, counts) / 2.0 ** 20)).sum() < 1.02 * bits


def test_identifiers_are_those_of_the_library():
    ids = encoder(*VOCAB)
    for t in ("", "a<|endoftext|>b", "  x\n\n y ", "it's 12三🙂\x00", "<|endoftext|>"):
        assert ids(t).tolist() == TOK.encode(t, add_special_tokens=False).ids


def rows_of(docs):
    """Expected rows in ascending id order; null ids first."""
    texts = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for doc, t in texts:
        ids = np.array([*TOK.encode(t, add_special_tokens=False).ids, 0], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), ids.tolist()))
        start += len(ids)
    return out


def test_files(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    root = fresh_root(spark, "test-token-files")
    write_token_files(docs, root, VOCAB, block_tokens=3000)
    got = read_token_files(spark, root, with_ids=True).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32, r.ids) for r in got] == rows_of(docs)
    blocks = spark.read.parquet(f"{root}/blocks").orderBy("part", "block").collect()
    assert len(blocks) > 10
    order = [d for b in blocks for d in b.doc_ids]
    assert order == sorted(order)


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "null id"), (4, "x " * 200_000), (5, "<|endoftext|>"), (6, "same"), (6, "same")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, start int").repartition(3)
    root = fresh_root(spark, "test-token-files")
    write_token_files(docs, root, VOCAB)
    got = read_token_files(spark, root).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == [r[:4] for r in rows_of(docs)]
    root = fresh_root(spark, "test-token-files")
    write_token_files(docs.limit(0), root, VOCAB)
    assert read_token_files(spark, root).count() == 0


def test_a_damaged_block_is_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(20)
    root = fresh_root(spark, "test-token-files")
    write_token_files(docs, root, VOCAB)
    from pyspark.sql import functions as F

    bad = spark.read.parquet(f"{root}/blocks").withColumn("crc32", F.col("crc32") + 1)
    bad.write.partitionBy("part").parquet(f"{root}-bad/blocks")
    spark.read.parquet(f"{root}/frequencies").write.parquet(f"{root}-bad/frequencies")
    with pytest.raises(Exception, match="checksum"):
        read_token_files(spark, f"{root}-bad").collect()
