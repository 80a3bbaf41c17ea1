"""The source audit against plain loops over all kept terms."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from burstwatch.llm import source_audit as A
from burstwatch.llm.source_audit import source_audit


def brute(rows, least_docs=3, top=200):
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").encode().lower().decode())
        n[lang, source].update(terms)
        docs[lang].update(set(terms))
    kept = {l: [t for t, d in docs[l].items() if d >= least_docs] for l, _ in groups}
    total = {l: sum((n[g] for g in groups if g[0] == l), Counter()) for l, _ in groups}

    def share(counts, terms):
        size = sum(counts[t] for t in terms)
        return {t: 1 + 10**9 * (counts[t] + 1) // (size + len(terms)) for t in terms}

    def f(p, q):
        return (p - q) * (p - q) // q

    out = []
    for l, s in groups:
        p, q = share(n[l, s], kept[l]), share(total[l], kept[l])
        pairs = [(-sum(f(p[t], o[t]) for t in kept[l]), x.encode()) for m, x in groups if m == l and x != s
                 for o in [share(n[l, x], kept[l])]]
        terms = [(-f(p[t], q[t]), t.encode()) for t in kept[l] if n[l, s][t] and p[t] > q[t]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [(l, s, part, i.decode(), -v, k) for k, (v, i) in enumerate(items, 1)]
    return sorted(out)


def rows_of_chance(seed):
    rnd = random.Random(seed)
    words = [f"w{a}{b}" for a in "abcdefgh" for b in "abcdefgh"] + ["Äpfel", "ñu", "日本", "A", "z"]
    rows = [(rnd.choice(["en", "de", None]), rnd.choice(["s1", "s2", "s3", None]),
             " ".join(rnd.choices(words, [1 / (i + 1) for i in range(len(words))], k=rnd.randint(0, 60)))) for _ in range(60)]
    return rows + [("fr", "only", "alone alone Alone"), ("fr", "none", None), ("es", "", ""), ("es", "b", "x-y_z[q]`{A}1B"), ("en", "quiet", "123 ..")]


@pytest.mark.parametrize("seed,least,top,held", [(1, 3, 200, 400_000), (2, 1, 5, 3), (3, 2, 1, 50)])
def test_equals_plain_loops(spark, seed, least, top, held):
    rows = rows_of_chance(seed)
    df = spark.createDataFrame([(t, s, l, 1, "x", 2) for l, s, t in rows],
                               "text string, source string, lang string, n long, item string, value int").repartition(3)
    got = source_audit(df, least_docs=least, top=top, held=held)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, least, top)


def test_ties_are_expanded_in_byte_order(spark):
    words = [f"t{c}" for c in "zyxwvutsrqponmlkjihgfedcba"] + ["é", "zz", "ÿ"]
    rows = [("en", "a", " ".join(words))] * 4 + [("en", "b", "other words here")] * 4
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert sorted(map(tuple, source_audit(df, top=7).collect())) == brute(rows, top=7)


def test_empty_table(spark):
    assert source_audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_shares_are_exact_beyond_64_bits(spark):
    rows = [(3 * 10**15, 10**16 + 1, 10**6), (0, 0, 0), (5, 7, 2)]
    got = spark.createDataFrame(rows, "c long, n long, v long").select(A._share(F.col("c"), F.col("n"), F.col("v"))).collect()
    assert [r[0] for r in got] == [1 + 10**9 * (c + 1) // max(1, n + v) for c, n, v in rows]


@pytest.mark.parametrize("held", [0, 20, 10**6])
def test_a_term_is_handed_on_once_for_all_sources(held):
    """The shuffle carries a row per (lang, term) of a task, not one per source too."""
    rows = rows_of_chance(4) + [(None, None, "w\xa0x \x00 \u65e5\u672cz")]
    table = pa.table([pa.array([r[i] or "" if i < 2 else r[i] for r in rows], pa.string()) for i in range(3)],
                     names=["lang", "source", "text"])
    batches = [b.slice(1) if i == 1 else b for i, b in enumerate(table.to_batches(max_chunksize=25))]
    rows.pop(25)  # the row that the slice leaves out
    got = [r for b in A.term_counts_kernel(batches, held) for r in b.to_pylist()]
    n, docs = Counter(), Counter()
    for r in got:
        assert len({f["source"] for f in r["found"]}) == len(r["found"])
        for f in r["found"]:
            n[r["lang"], f["source"], r["term"]] += f["n"]
            docs[r["lang"], f["source"], r["term"]] += f["docs"]
    want, want_docs = Counter(), Counter()
    for lang, source, text in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").encode().lower().decode())
        want.update((lang or "", source or "", t) for t in terms)
        want_docs.update((lang or "", source or "", t) for t in set(terms))
    assert n == want and docs == want_docs
    if held == 10**6:
        assert len(got) == len({(lang, term) for lang, _, term in want})


def test_rows_without_a_term_hand_on_nothing():
    batch = pa.record_batch([pa.array(["en", "en"]), pa.array(["a", "b"]), pa.array([None, "1 - 2"], pa.string())],
                            names=["lang", "source", "text"])
    assert [*A.term_counts_kernel([batch, batch.slice(0, 0)], 0)] == []
