"""Text similarity and keywords per group, as aggregations (no pair joins).

Mean pairwise cosine of n unit vectors u_i is
    (||sum u_i||^2 - sum ||u_i||^2) / (n (n - 1)),
so a group needs only a per-coordinate sum: a partial aggregation on
(group, coordinate), linear in n and spread over tasks for a hot group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burstwatch.functions.text import english_stop_words, tokens
from burstwatch.operators.joins import null_safe_join, sized_broadcast
from burstwatch.params import DEFAULT, Params
from burstwatch.session import cut_lineage


def _group_sizes(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def _mean_from_sums(sums: DataFrame, sizes: DataFrame, keys: list[str],
                    decimals: int | None) -> DataFrame:
    """sums: keys, _ss (||sum u||^2), _q (sum ||u||^2). sizes: keys, _n."""
    out = null_safe_join(sizes, sums, keys, "left")
    n = F.col("_n")
    mean = (F.coalesce(F.col("_ss"), F.lit(0.0)) - F.coalesce(F.col("_q"), F.lit(0.0))) / (n * (n - 1))
    sim = F.when(n < 2, F.lit(0.0)).otherwise(mean)
    if decimals is not None:
        sim = F.round(sim, decimals)
    return out.select(*keys, n.alias("n_items"), sim.alias("similarity"))


def mean_pairwise_cosine(df: DataFrame, group_cols: Sequence[str], vector_col: str,
                         decimals: int | None = 4) -> DataFrame:
    """Mean cosine similarity over all unordered pairs of vectors in each group
    (0.0 for fewer than two; a zero vector is 0-similar to everything)."""
    keys = list(group_cols)
    vec = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    items = df.select(*keys, vec.alias("_v")).withColumn(
        "_norm", F.sqrt(F.aggregate("_v", F.lit(0.0), lambda acc, x: acc + x * x)))
    units = items.filter(F.col("_norm") > 0).select(
        *keys, F.posexplode(F.transform("_v", lambda x: x / F.col("_norm"))).alias("_pos", "_u"))
    per_coord = units.groupBy(*keys, "_pos").agg(F.sum("_u").alias("_s"),
                                                 F.sum(F.col("_u") * F.col("_u")).alias("_uu"))
    sums = per_coord.groupBy(*keys).agg(F.sum(F.col("_s") * F.col("_s")).alias("_ss"),
                                        F.sum("_uu").alias("_q"))
    return _mean_from_sums(sums, _group_sizes(df, keys), keys, decimals)


# Of the sorted tokens ``sorted_tokens``: (term, occurrences) by the places where a term
# begins and the distance to the next one, and the length of the vector of counts.
# Each step is bound to a lambda variable, so nothing is computed per reference.
_COUNTS = """get(transform(array(sorted_tokens), t ->
  get(transform(array(filter(sequence(0, size(t)), i -> i < size(t) AND (i = 0 OR t[i] <> t[i - 1]))), b ->
    transform(b, (s, k) -> struct(t[s] AS term, CAST(coalesce(get(b, k + 1), size(t)) - s AS BIGINT) AS tf))), 0)), 0)"""
_WITH_NORM = f"""get(transform(array({_COUNTS}), c ->
  struct(c AS counts, sqrt(aggregate(c, CAST(0 AS DOUBLE), (n, x) -> n + CAST(x.tf * x.tf AS DOUBLE))) AS norm)), 0)"""


def term_counts(df: DataFrame, keys: Sequence[str], doc_col: str, text_col: str) -> DataFrame:
    """(keys, _doc, term, tf, _norm) over whole texts: a row is a document, so its
    terms are counted inside it, without a shuffle; _norm is the length of its
    count vector."""
    per_doc = (df.select(*keys, F.col(doc_col).alias("_doc"), F.sort_array(tokens(F.col(text_col))).alias("sorted_tokens"))
               .select(*keys, "_doc", F.expr(_WITH_NORM).alias("_c")))
    return per_doc.select(*keys, "_doc", F.col("_c.norm").alias("_norm"), F.explode("_c.counts").alias("_x")) \
        .select(*keys, "_doc", F.col("_x.term").alias("term"), F.col("_x.tf").alias("tf"), "_norm")


def text_similarity(df: DataFrame, group_cols: Sequence[str], doc_col: str, text_col: str,
                    decimals: int | None = 4, embed=None) -> DataFrame:
    """Mean pairwise cosine of the texts of each group.

    Default embedding: bag of words (term counts). ``embed`` may be a function
    Column(text) -> Column(array<float>) (e.g. a model behind
    ``predict_batch_udf``); the dense path is then used."""
    keys = list(group_cols)
    if embed is not None:
        return mean_pairwise_cosine(df.select(*keys, embed(F.col(text_col)).alias("_e")),
                                    keys, "_e", decimals)
    return _similarity_from_tf(term_counts(df, keys, doc_col, text_col), _group_sizes(df, keys),
                               keys, decimals)


def _similarity_from_tf(tf: DataFrame, sizes: DataFrame, keys: list[str],
                        decimals: int | None) -> DataFrame:
    units = tf.select(*keys, "term", (F.col("tf") / F.col("_norm")).alias("_u"))
    per_term = units.groupBy(*keys, "term").agg(F.sum("_u").alias("_s"),
                                                F.sum(F.col("_u") * F.col("_u")).alias("_uu"))
    sums = per_term.groupBy(*keys).agg(F.sum(F.col("_s") * F.col("_s")).alias("_ss"),
                                       F.sum("_uu").alias("_q"))
    return _mean_from_sums(sums, sizes, keys, decimals)


def keyword_scores(df: DataFrame, group_cols: Sequence[str], doc_col: str, text_col: str,
                   stop_words: Sequence[str] | None = None, max_df: float = 0.95) -> DataFrame:
    """TF-IDF keyword score per (group, term): the sum over the group's
    documents of L2-normalised tf * idf, idf = ln((1 + n) / (1 + df)) + 1.
    Stop words and terms in more than ``max_df`` of the documents are
    dropped; groups of fewer than two documents get no terms."""
    keys = list(group_cols)
    return _keyword_scores_from_tf(term_counts(df, keys, doc_col, text_col),
                                   _group_sizes(df, keys), keys, stop_words, max_df)


def _keyword_scores_from_tf(tf: DataFrame, sizes: DataFrame, keys: list[str],
                            stop_words: Sequence[str] | None, max_df: float) -> DataFrame:
    stops = list(english_stop_words() if stop_words is None else stop_words)
    sizes = sized_broadcast(cut_lineage(sizes.filter(F.col("_n") >= 2)))
    if stops:
        tf = tf.filter(~F.col("term").isin(stops))
    tf = cut_lineage(tf.drop("_norm"))  # read for the frequencies and for the weights
    dfreq = tf.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("_df"))
    vocab = (null_safe_join(dfreq, sizes, keys)
             .filter(F.col("_df") <= F.lit(max_df) * F.col("_n"))
             .select(*keys, "term",
                     (F.log((1 + F.col("_n")) / (1 + F.col("_df"))) + 1).alias("_idf")))
    # both sides come from storage, so a frequent term of a large group is split
    w = null_safe_join(tf, cut_lineage(vocab), [*keys, "term"]).select(
        *keys, "_doc", "term", (F.col("tf") * F.col("_idf")).alias("_w"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(*keys, "_doc")))
    return (w.withColumn("_norm", norm)
            .groupBy(*keys, "term").agg(F.sum(F.col("_w") / F.col("_norm")).alias("score")))


def top_keywords(df: DataFrame, group_cols: Sequence[str], doc_col: str, text_col: str,
                 top_n: int = 3, stop_words: Sequence[str] | None = None,
                 max_df: float = 0.95) -> DataFrame:
    """Top ``top_n`` TF-IDF keywords per group: (keys, rank, term, score).
    Ties are broken by term."""
    keys = list(group_cols)
    return _top(keyword_scores(df, keys, doc_col, text_col, stop_words, max_df), keys, top_n)


def _top(scores: DataFrame, keys: list[str], top_n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "term"))
    return scores.withColumn("rank", rank).filter(F.col("rank") <= top_n)


def keyword_lists(top: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """(keys, keywords array<string>) in rank order, from ``top_keywords``."""
    keys = list(group_cols)
    return top.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))),
                    lambda s: s.getField("term")).alias("keywords"))


def first_n(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[Column | str],
            n: int) -> DataFrame:
    """First n rows per group by the given order (``rank`` column added).
    ``row_number() <= n`` lets Spark place a partial per-group limit before
    the shuffle, so a hot group ships at most n rows per input task."""
    rank = F.row_number().over(Window.partitionBy(*partition_cols).orderBy(*order_cols))
    return df.withColumn("rank", rank).filter(F.col("rank") <= n)


def templated_windows(window_texts: DataFrame, params: Params = DEFAULT,
                      embed=None, sampled: bool = False) -> DataFrame:
    """Per alert window: similarity of its first ``similarity_sample`` comments;
    when above ``similarity_threshold``, the top keywords of those texts.

    ``window_texts``: (video_id, window_start, comment_id, published_at, text)
    for the comments of the alert windows; with ``sampled`` only the first ones."""
    p = params
    keys = ["video_id", "window_start"]
    # at most similarity_sample rows per window, stored once
    first = window_texts if sampled else first_n(window_texts, keys, ["published_at", "comment_id"],
                                                 p.similarity_sample)
    sample = cut_lineage(first)
    sizes = _group_sizes(sample, keys)
    tf = term_counts(sample, keys, "comment_id", "text")
    sim = _similarity_from_tf(tf, sizes, keys, 4) if embed is None else \
        text_similarity(sample, keys, "comment_id", "text", decimals=4, embed=embed)
    hot = sim.filter(F.col("similarity") > p.similarity_threshold).select(*keys)
    scores = _keyword_scores_from_tf(null_safe_join(tf, hot, keys, "left_semi"),
                                     null_safe_join(sizes, hot, keys, "left_semi"), keys, None,
                                     p.keyword_max_df)
    kw = keyword_lists(_top(scores, keys, p.top_keywords), keys)
    return (null_safe_join(sim, kw, keys, "left")
            .select(*keys, "n_items", "similarity",
                    (F.col("similarity") > p.similarity_threshold).alias("templated"),
                    F.when(F.col("similarity") > p.similarity_threshold,
                           F.coalesce(F.col("keywords"), F.array().cast("array<string>")))
                    .alias("keywords")))


def model_embedder(make_predict_fn, batch_size: int = 32):
    """Wrap a batch sentence-embedding model as a column function for
    ``with_embedding`` / ``text_similarity(embed=...)``. ``make_predict_fn()``
    is called once per Python worker and returns
    ``predict(texts: np.ndarray) -> np.ndarray`` of shape (n, dim). Texts
    travel to the model in Arrow batches of ``batch_size``."""
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql import types as T

    udf = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.FloatType()),
                            batch_size=batch_size, input_tensor_shapes=None)

    def embed(text: Column) -> Column:
        from pyspark.sql import SparkSession

        from burstwatch.session import ship_package

        ship_package(SparkSession.getActiveSession())
        return udf(F.coalesce(text, F.lit("")))

    return embed


def with_embedding(df: DataFrame, embed, text_col: str = "text",
                   out_col: str = "embedding") -> DataFrame:
    """Adds an ``array<float>`` embedding of each text. ``embed`` is a column
    function, e.g. ``model_embedder(...)``; without a model, similarity ops
    use bag-of-words vectors instead (``text_similarity``)."""
    return df.withColumn(out_col, embed(F.col(text_col)))
