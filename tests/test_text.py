"""Similarity, keywords, templated windows, sentiment."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from burstwatch.functions.text import english_stop_words
from burstwatch.operators.text import (
    mean_pairwise_cosine, templated_windows, text_similarity, top_keywords,
)
from burstwatch.operators.sentiment import model_scorer, with_sentiment
from conftest import at


def test_mean_pairwise_cosine_matches_pairs(spark):
    vecs = [("g", [1.0, 0.0]), ("g", [0.0, 1.0]), ("g", [1.0, 1.0]), ("h", [1.0, 2.0])]
    out = {r.g: r for r in mean_pairwise_cosine(
        spark.createDataFrame(vecs, "g string, v array<double>"), ["g"], "v", None).collect()}
    pairs = [0.0, 1 / math.sqrt(2), 1 / math.sqrt(2)]
    assert out["g"].similarity == pytest.approx(sum(pairs) / 3)
    assert out["h"].similarity == 0.0 and out["h"].n_items == 1


def _tfidf_reference(texts, stops, top_n=3, max_df=0.95):
    import re
    docs = [[t for t in re.findall(r"[^\W]{2,}", x.lower()) if t not in stops] for x in texts]
    n = len(docs)
    df = Counter(t for d in docs for t in set(d))
    vocab = {t for t, c in df.items() if c <= max_df * n}
    score = Counter()
    for d in docs:
        tf = Counter(t for t in d if t in vocab)
        w = {t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in tf.items()}
        norm = math.sqrt(sum(v * v for v in w.values()))
        for t, v in w.items():
            score[t] += v / norm
    return [t for t, _ in sorted(score.items(), key=lambda kv: (-kv[1], kv[0]))[:top_n]]


def test_top_keywords_matches_reference_definition(spark):
    texts = ["Cats chase mice and cats sleep", "Dogs chase cats", "Mice eat cheese daily",
             "the cheese is old cheese", "Dogs sleep all day long"]
    df = spark.createDataFrame([("g", i, t) for i, t in enumerate(texts)], "g string, d int, t string")
    got = [r.term for r in top_keywords(df, ["g"], "d", "t").orderBy("rank").collect()]
    assert got == _tfidf_reference(texts, set(english_stop_words()))


def test_scripted_texts_are_templated_without_keywords(spark):
    rows = [("v", at(0), f"c{i}", at(i), "buy now best product ever") for i in range(12)]
    df = spark.createDataFrame(rows, "video_id string, window_start timestamp, comment_id string, "
                                     "published_at timestamp, text string")
    r = templated_windows(df).first()
    assert r.similarity > 0.40 and r.templated and r.keywords == []


def test_similarity_of_single_text_is_zero(spark):
    df = spark.createDataFrame([("g", 1, "only one")], "g string, d int, t string")
    assert text_similarity(df, ["g"], "d", "t").first().similarity == 0.0


def test_blank_text_gets_zero_and_scorer_hook(spark):
    df = spark.createDataFrame([(1, "  \t\n"), (2, "great great product"), (3, "awful")],
                               "id int, text string")
    got = {r.id: r.sentiment for r in with_sentiment(df).collect()}
    assert got[1] == 0.0 and got[2] > 0 and got[3] < 0

    def make():
        def predict(texts):
            return [{"label": "POSITIVE", "score": 0.9} for _ in texts]
        return predict

    got = {r.id: r.sentiment for r in with_sentiment(df, scorer=model_scorer(make)).collect()}
    assert got[1] == 0.0 and got[2] == pytest.approx(0.8) and got[3] == pytest.approx(0.8)


def test_with_embedding_feeds_dense_similarity(spark):
    from burstwatch.operators.text import model_embedder, with_embedding

    def letter_counts_model():
        """Stub sentence embedder: counts of the letters a, b, c."""
        import numpy as np

        def predict(texts):
            return np.array([[t.count("a"), t.count("b"), t.count("c")] for t in texts],
                            dtype=np.float32)

        return predict

    rows = [("g", 1, "aa"), ("g", 2, "bb"), ("g", 3, "ab"), ("h", 4, "abc")]
    df = spark.createDataFrame(rows, "g string, id int, text string")
    embed = model_embedder(letter_counts_model, batch_size=2)
    emb = {r.id: r.embedding for r in with_embedding(df, embed).collect()}
    assert emb[3] == [1.0, 1.0, 0.0] and emb[4] == [1.0, 1.0, 1.0]
    sim = {r.g: r.similarity for r in text_similarity(df, ["g"], "id", "text", None,
                                                      embed=embed).collect()}
    assert sim["g"] == pytest.approx((0 + 2 / math.sqrt(2)) / 3)
    assert sim["h"] == 0.0


def test_null_group_and_one_term_in_every_document(spark):
    """A null group is a group like others, and a term of every document is cut by
    max_df, alone or in a hot group."""
    from burstwatch.operators.text import text_similarity, top_keywords

    rows = [(None, 1, "red apple"), (None, 2, "red apple"), ("g", 3, "red apple"), ("g", 4, "red apple")]
    rows += [("hot", 10 + i, f"common word{i % 7} word{i % 7}") for i in range(200)]
    df = spark.createDataFrame(rows, "k string, doc int, text string")
    sim = {r.k: r.similarity for r in text_similarity(df, ["k"], "doc", "text").collect()}
    assert sim[None] == sim["g"] == 1.0
    top = {}
    for r in top_keywords(df, ["k"], "doc", "text", 3, max_df=1.0).collect():
        top.setdefault(r.k, {})[r["rank"]] = (r.term, round(r.score, 9))
    assert top[None] == top["g"] and len(top[None]) == 2
    cut = [r.term for r in top_keywords(df, ["k"], "doc", "text", 9, max_df=0.95).where("k = 'hot'").collect()]
    assert sorted(cut) == [f"word{i}" for i in range(7)]


def test_each_text_is_counted_and_sorted_once(spark):
    from pyspark.sql import functions as F

    from burstwatch.operators.sentiment import with_sentiment
    from burstwatch.operators.text import term_counts

    rows = [(1, "g", "good Good bad, goodness"), (2, "g", " 　\t"), (3, "g", None), (4, "g", "awful-best worst bad_")]
    docs = spark.createDataFrame(rows, "doc_id long, k string, text string")
    out = with_sentiment(docs, keep_prediction=True)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 2 and "regexp_replace(" not in plan
    got = {r.doc_id: (r.label, r.score, r.sentiment) for r in out.collect()}
    assert got == {1: ("POSITIVE", 3 / 5, pytest.approx(0.2)), 2: (None, None, 0.0), 3: (None, None, 0.0),
                   4: ("NEGATIVE", 3 / 5, pytest.approx(-0.2))}
    terms = term_counts(docs, ["k"], "doc_id", "text")
    assert "array_sort(" not in terms._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.term, r.tf) for r in terms.where(F.col("_doc") == 1).collect()} == {("good", 2), ("bad", 1), ("goodness", 1)}
