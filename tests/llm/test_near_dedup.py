"""Classes against an exact all-pairs join on the fixture; sketches; components."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from burstwatch.llm import near_dedup as N

SF = "/root/testdata/sf0.001"


def plain_set(text, k):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def plain_classes(rows, k, percent):
    """(doc, n, component) by an inverted index over all shingles."""
    sets = [plain_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    at = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            at[g].append(i)
    for i, s in enumerate(sets):
        both = defaultdict(int)
        for g in s:
            for j in at[g]:
                if j < i:
                    both[j] += 1
        for j, c in both.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def got(df):
    out = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str)


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_classes_of_the_fixture(spark, k, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain_classes(rows, k, percent)
    assert len({c for _, _, c in want}) < len(want)
    assert got(N.near_duplicates(docs, k, percent)) == want
    kept = N.keep_one(docs, k, percent)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, _, c in want}


def test_chains_large_groups_and_common_passages(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    rows, base = [], [word() for _ in range(120)]
    for i in range(150):  # a chain: each differs from the one before by a few words
        base = base[:]
        base[r.randrange(120)] = word()
        rows.append((1000 - i, " ".join(base)))
    one = [word() for _ in range(200)]
    for i in range(200):  # many near copies of one text
        t = one[:]
        for _ in range(r.randint(0, 14)):
            t[r.randrange(200)] = word()
        rows.append((2000 + i, " ".join(t)))
    passage = [word() for _ in range(60)]
    rows += [(3000 + i, " ".join([word() for _ in range(20)] + passage + [word() for _ in range(10)])) for i in range(150)]
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for k, percent in ((3, 85), (5, 80)):
        assert got(N.near_duplicates(docs, k, percent)) == plain_classes(rows, k, percent)


def test_edges(spark):
    long = "alpha beta " * 200_000
    rows = [(5, None), (6, ""), (7, " \n\t"), (8, "One two"), (9, "one  TWO"), (10, "one two three"), (None, "one two"),
            (None, "lonely words here and there"), (11, long), (12, long + "gamma"), (13, "x"), (13, "x"), (14, "\xa0x"), (15, "É"), (16, "é")]
    docs = spark.createDataFrame([(i, t, 0, "c") for i, t in rows], "doc_id long, text string, node int, component_id string")
    out = N.near_duplicates(docs)
    assert sorted(((x.doc_id, x.n_shingles, x.component_id) for x in out.collect()), key=str) == plain_classes(rows, 3, 85)
    assert {x.doc_id: x.kept for x in out.where("doc_id IS NOT NULL").collect()}[9] is False
    assert N.near_duplicates(docs.limit(0)).count() == 0
    assert N.near_duplicates(docs.where("doc_id = 5")).first().component_id == 5
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 9 OR doc_id = 12").count() == 1


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + j) for j in range(1, 50)] + [(200, 201), (201, 200)]
    got = {r.node: r.root for r in N.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + j: 100 for j in range(50)}, 200: 200, 201: 200}


def test_sketch_coordinates_are_filled_and_estimate():
    g = np.random.default_rng(1)
    for n in (1, 2, 17, 500):
        a = np.unique(g.integers(0, 2 ** 63, n).astype(np.uint64))
        assert (N.sketch(a, 64) != np.iinfo(np.uint64).max).all()
    a = g.integers(0, 2 ** 63, 900).astype(np.uint64)
    b = np.concatenate([a[:800], g.integers(0, 2 ** 63, 100).astype(np.uint64)])
    assert abs((N.sketch(a, 2048) == N.sketch(b, 2048)).mean() - 0.8) < 0.04
    assert N.rows_per_band(0.85) == 8 and (1 - 0.85 ** 8) ** N.BANDS < N.MISS


def test_one_row_of_a_group_stays_by_row(spark):
    """Ids and texts repeat, are null, and one id stands in two groups."""
    a, b, c = "alpha beta gamma delta epsilon", "one two three four five six", "sieben acht neun zehn elf"
    rows = [(3, b, 1), (7, a, 2), (7, b, 3), (None, c, 4), (None, c, 5), (9, "x y z u v w q", 6), (9, "x y z u v w q", 7),
            (11, None, 8), (11, None, 9), (12, c + " ", 10), (13, "nur eins hier steht etwas", 11), (None, "nur eins hier steht etwas", 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id int").repartition(3)
    kept = sorted(tuple(r) for r in N.keep_one(docs).collect() if r.doc_id != 9 and r.doc_id != 11)
    assert kept == [(3, b, 1), (7, a, 2), (12, c + " ", 10), (13, "nur eins hier steht etwas", 11)]
    assert N.keep_one(docs).where("doc_id = 9").count() == 1 and N.keep_one(docs).where("doc_id = 11").count() == 2
    none = docs.where("doc_id IS NULL")
    assert sorted(r.text for r in N.keep_one(none).collect()) == sorted([c, "nur eins hier steht etwas"])
    assert N.keep_one(docs.limit(0)).count() == 0


def test_many_rows_without_ids_meet_only_their_own(spark):
    rows = [(None, f"w{i} a{i} b{i} c{i} d{i} e{i} f{i} " + "common words " * 3) for i in range(400)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert N.near_duplicates(docs).count() == 800 and N.keep_one(docs).count() == 400
