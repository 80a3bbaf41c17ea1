"""Counts against the sentencepiece library."""

import random

import public_tokenizers as P
import sentencepiece

from burstwatch.llm.token_count import MergeCounter, token_counts

MODEL = P.path("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_any_text_counts_as_the_library_says():
    c, r = MergeCounter(MODEL), random.Random(1)
    alphabet = " \t\n▁.,:;!?'\"()[]{}<s></s><0x0A>²³éßñ日本語한글🙂‍́\x00\x7fabcdefgtheing0123456789-_=+/\\|~`@#$%^&*"
    for _ in range(5000):
        t = "".join(r.choice(alphabet) for _ in range(r.randint(0, 40)))
        assert c.count(t) == len(SP.encode(t)), repr(t)
    for t in ("", " ", "   ", "<s> </s> <unk> <0x0A>", "m². x².y", "a" * 3000, "▁▁▁a", "😀" * 50):
        assert c.count(t) == len(SP.encode(t)), repr(t)


def test_parts_of_a_long_text(monkeypatch):
    from burstwatch.llm import token_count

    c = MergeCounter(MODEL)
    text = "  the quick  brown\nfox, jumps.   " * 300
    want = c.count(text)
    assert want == len(SP.encode(text))
    for size in (7, 64, 1000):
        monkeypatch.setattr(token_count, "PART_CHARS", size)
        assert c.count(text) == want


def test_rows(spark):
    rows = [(1, None), (2, ""), (None, "null id"), (3, "twice"), (3, "twice"), (4, "word " * 300_000), (5, "é日"), (6, "x" * 9_000)]
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, n_tokens int")
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, MODEL).collect()), key=str)
    want = [(i, len((t or "").encode()), len(SP.encode(t or "")), len(SP.encode(t or "")) > 4096) for i, t in rows]
    assert got == sorted(want, key=str)
    assert token_counts(docs.limit(0), MODEL).count() == 0


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.n_tokens == len(SP.encode(texts[r.doc_id])) for r in token_counts(docs, MODEL).collect())
