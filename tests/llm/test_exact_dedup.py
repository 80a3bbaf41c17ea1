"""Exact duplicates against a dictionary of normalised texts."""

import hashlib
import re

import pytest

from burstwatch.llm import exact_dedup as D
from burstwatch.llm.exact_dedup import exact_duplicates


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, t or ""))
    out = []
    for plain, own in groups.items():
        order = sorted(own, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))
        keep, sha = order[0], hashlib.sha256(plain.encode()).hexdigest()
        for k, (i, t) in enumerate(order):
            out.append((i, keep[0], len(own), k == 0, sha))
    return sorted(out, key=repr)


ROWS = ([(i, f"text {i % 40}" + " " * (i % 7)) for i in range(300)]
        + [(1000 + i, "hot  copy of a text" + "\t" * (i % 3)) for i in range(400)]
        + [(2000, None), (2001, ""), (2002, " \t\r\n\x0b\x0c"), (2003, " "), (2004, "Ünï"), (2005, "Ü nï"), (2006, "Ünï")]
        + [(None, "no id"), (None, "no id"), (None, "noid "), (3000, "only"), (-5, "neg ative"), (-9, "nega tive"), (7, "negative  ")]
        + [(4000, "same row")] * 5 + [(4000, "another")] * 2
        + [(-2**63, "edge"), (2**63 - 1, "ed ge"), (5000, "x" * 2_000_000), (5001, "x" * 1_000_000 + " " + "x" * 1_000_000)])


@pytest.mark.parametrize("digest_bytes,hot_rows,bound", [(32, 1000, None), (32, 5, None), (1, 1000, None), (1, 5, 0), (0, 5, 0), (32, 5, 0)])
def test_equals_a_dictionary(spark, monkeypatch, digest_bytes, hot_rows, bound):
    if bound is not None:  # no text table is small enough to be filtered by a broadcast
        monkeypatch.setattr(D, "sized_broadcast", lambda df: df)
    monkeypatch.setattr(D, "COPIES", 2)
    df = spark.createDataFrame([(i, t, 1, "b", "k") for i, t in ROWS],
                               "doc_id long, text string, n_chars int, digest string, keep_id string").repartition(5)
    got = exact_duplicates(df, digest_bytes=digest_bytes, hot_rows=hot_rows)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(ROWS)


def test_empty_table(spark):
    assert exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_all_rows_are_one_text(spark):
    df = spark.range(5000).selectExpr("CAST(NULL AS long) AS doc_id", "'a b' AS text").repartition(16)
    got = exact_duplicates(df).groupBy("group_size").agg({"kept": "count"}).collect()
    assert [tuple(r) for r in got] == [(5000, 5000)]
    assert exact_duplicates(df).where("kept").count() == 1
