"""Collocations against counts of all n-grams."""

import re
from collections import Counter

import pytest

from burstwatch.llm import collocations as C
from burstwatch.llm.collocations import collocations


def brute(rows, m=3, least=10, cover=50, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = (text or "").encode().lower().decode()
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, m + 1):
                f.setdefault(lang, Counter()).update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= cover * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, b in cand.items()):
                continue
            score, _, l, r = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                 for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


TEXTS = [
    ("en", "New York City is big. " * 12 + "New York, New York! new\tyork city; york new"),
    ("en", "a a a a a a a a a a a a a a a b"), (None, "x y " * 15 + "x\x0by z\x1c w"), ("und", "x y z " * 11),
    ("fr", "É é É é Ünï cödé " * 10), ("fr", None), ("", ""), (None, None), ("de", " \t\n.,;"),
    ("en", "one two three four five " * 30), ("en", "big city big city \x00 \x00 q " * 20),
]


@pytest.mark.parametrize("m,least,cover,top,words,block", [
    (3, 10, 50, 2000, 3_000_000, 4_000_000), (2, 5, 50, 2000, 7, 20), (3, 3, 101, 4, 50, 1), (4, 6, 80, 2000, 1000, 100), (5, 2, 50, 2000, 20, 64)])
def test_equals_all_ngrams(spark, m, least, cover, top, words, block):
    df = spark.createDataFrame([(t, l, 1, 2, "a") for l, t in TEXTS], "text string, lang string, n long, w1 int, level string").repartition(3)
    got = collocations(df, max_words=m, least=least, cover_percent=cover, top=top, chunk_words=words, block_bytes=block)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(TEXTS, m, least, cover, top)
    assert want and sorted(map(tuple, got.collect())) == want


def test_empty_table(spark):
    assert collocations(spark.createDataFrame([], "text string, lang string")).count() == 0


def test_a_long_text_without_piece_ends(spark):
    text = "alpha beta gamma delta " * 60_000
    df = spark.createDataFrame([(text, "en"), ("alpha beta", "en")], "text string, lang string")
    got = {r.phrase: (r.a, r.n) for r in collocations(df, block_bytes=10_000).collect()}
    assert got["alpha beta gamma"] == (60_000, 240_002) and got["delta alpha beta"] == (59_999, 240_002)


def test_ratio_is_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    rows = [(10**13 + 7, 3 * 10**13 + 1, 10**14 + 9), (10**15 - 1, 10**15, 10**15 + 3), (10, 10, 10)]
    got = spark.createDataFrame(rows, "a long, l long, r long").select(C._ratio(F.col("a"), F.col("l"), F.col("r"))).collect()
    assert [r[0] for r in got] == [1_000_000 * a * a // (l * r) for a, l, r in rows]


def test_keys_beyond_64_bits():
    """Prefixes are numbered anew where a packed window would not fit."""
    import numpy as np
    import pyarrow as pa

    words = [f"w{i % 5000}".encode() for i in range(20_000)]
    run = pa.array(words, pa.binary()).dictionary_encode()
    out = C._windows("en", [run], np.array([20_000]), 6)
    got = Counter({(r["head"], r["tail"]): r["n"] for r in out.to_pylist()})
    plain = [w.decode() for w in words]
    assert got == Counter((" ".join(plain[i:i + 2]), " ".join(plain[i + 2:i + 6])) for i in range(20_000))
