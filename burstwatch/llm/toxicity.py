"""Toxicity by cumulative-link ordinal regression on sparse text features.

Severity grades of labelled documents: 0 not toxic; 1 toxic; 2 toxic with more
distinct features than the median toxic document. Features are the words
and word beginnings whose presence speaks for the toxic label (a likelihood-ratio
test over a bounded labelled sample); a text's value of one is log(1 +
occurrences). One weight per feature is shared by the ordered thresholds: P(grade >= k) = sigmoid(w.x - theta_k).
The expected severity is the sum of these probabilities."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstwatch.llm.tasks import arrow_map, keep_rows, record_batch, slices
from burstwatch.session import cut_lineage, scratch_tables

GRADES = 3
#: Labelled documents that the model is fitted on (those of the smallest id hashes).
SAMPLE_DOCS = 30_000
#: Features of the model at most. One needs a likelihood ratio (twice its log) of
#: EVIDENCE, and of twice the log of the number of candidates, as so many are tried.
FEATURES = 4_096
EVIDENCE = 10.0
#: Documents that a feature must occur in.
MIN_DOCS = 3
PENALTY = 0.00005
#: A document is toxic from P(grade >= 1) = 0.5, or from the lower value (LEAST_CUT at least) that this
#: share of the sample's documents without the label stays below.
CLEAN_SHARE = 0.9995
LEAST_CUT = 0.12
CHARS = 1_000_000
#: Letters of the word beginnings that are features beside whole words.
BEGINNINGS = (3, 4, 5)
#: Words whose features a worker keeps.
MEMO_WORDS = 100_000
#: Words that a task counts before it passes the counts on.
HELD_WORDS = 150_000

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def parts(word: str) -> list[str]:
    """The features of a word: itself, and its beginnings marked by a hyphen."""
    return [word, *(word[:n] + "-" for n in BEGINNINGS if len(word) > n)]


class _Known(dict):
    """word -> places of its features in the model."""

    def __init__(self, features: dict[str, int]):
        self.features = features

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(self.features[p] for p in parts(word) if p in self.features)
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = found
        return found


@dataclass
class Model:
    features: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray = field(default_factory=lambda: np.full(GRADES - 1, np.inf))
    cut: float = 0.5

    def sparse(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, feature, value) of the texts."""
        row, col, val = [], [], []
        known = self._known = getattr(self, "_known", None) or _Known(self.features)
        for i, t in enumerate(texts):
            for c, n in Counter(chain.from_iterable(map(known.__getitem__, words(t)))).items():
                row.append(i)
                col.append(c)
                val.append(math.log1p(n))
        return np.array(row, np.int64), np.array(col, np.int64), np.array(val, np.float64)

    def at_least(self, texts: list[str | None]) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ... of each text."""
        row, col, val = self.sparse(texts)
        z = np.bincount(row, weights=val * self.weights[col], minlength=len(texts)) if len(row) else np.zeros(len(texts))
        return _sigmoid(z[:, None] - self.thresholds[None, :])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit(row, col, val, grades: np.ndarray, features: dict[str, int], penalty: float = PENALTY,
        steps: int = 1000) -> Model:
    """Maximum likelihood with a squared penalty, by gradient steps with adaptive scale.
    Thresholds stay in order: each is the one before plus a positive gap."""
    n, k = len(grades), len(features)
    params = np.zeros(k + GRADES - 1)  # weights, first threshold, log gaps
    share = np.clip([(grades >= g).mean() for g in range(1, GRADES)], 1e-4, 1 - 1e-4)
    params[k] = -np.log(share[0] / (1 - share[0]))
    m, v = np.zeros_like(params), np.zeros_like(params)

    def thresholds(p):
        return np.concatenate(([p[k]], p[k] + np.cumsum(np.exp(p[k + 1:]))))

    for t in range(1, steps + 1):
        theta = thresholds(params)
        z = np.bincount(row, weights=val * params[col], minlength=n) if len(row) else np.zeros(n)
        above = np.concatenate([np.ones((n, 1)), _sigmoid(z[:, None] - theta), np.zeros((n, 1))], axis=1)
        p = np.maximum(above[np.arange(n), grades] - above[np.arange(n), grades + 1], 1e-12)
        slope = above * (1 - above)  # of P(grade >= g) by z
        dz = (slope[np.arange(n), grades] - slope[np.arange(n), grades + 1]) / p
        grad = np.zeros_like(params)
        if len(row):
            grad[:k] = -np.bincount(col, weights=val * dz[row], minlength=k) / n + penalty * params[:k]
        dtheta = np.zeros(GRADES - 1)
        for g in range(1, GRADES):
            dtheta[g - 1] = (-(slope[:, g] / p)[grades == g].sum() + (slope[:, g] / p)[grades == g - 1].sum()) / n
        # P falls by theta where it rises by z; the loss is the negative log likelihood
        grad[k] = -dtheta.sum()
        for g in range(1, GRADES - 1):
            grad[k + g] = -dtheta[g:].sum() * np.exp(params[k + g])
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad ** 2
        params -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-10)
    return Model(features, params[:k], thresholds(params))


# ------------------------------------------------------------------ learning

def vocabulary_kernel(batches):
    """(word, toxic documents, other documents) of a task's sample."""
    seen: dict[str, list[int]] = {}
    for b in slices(batches, "text", CHARS):
        for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
            for w in {p for w in set(words(text)) for p in parts(w)}:
                seen.setdefault(w, [0, 0])[0 if toxic else 1] += 1
        if len(seen) > HELD_WORDS:
            yield _vocabulary(seen)
            seen = {}
    if seen:
        yield _vocabulary(seen)


def _vocabulary(seen):
    return record_batch({"word": list(seen), "toxic": [n[0] for n in seen.values()], "other": [n[1] for n in seen.values()]},
                        word=pa.string(), toxic=pa.int64(), other=pa.int64())


def features_kernel(batches, features):
    """Feature places and values of a task's sample documents."""
    model = Model(features.value, np.zeros(len(features.value)))
    for b in slices(batches, "text", CHARS):
        texts = b.column("text").to_pylist()
        row, col, val = model.sparse(texts)
        ends = np.searchsorted(row, np.arange(len(texts) + 1))
        yield record_batch({"toxic": b.column("toxic"),
                            "cols": [col[a:z] for a, z in zip(ends, ends[1:])],
                            "vals": [val[a:z] for a, z in zip(ends, ends[1:])]},
                           cols=pa.list_(pa.int64()), vals=pa.list_(pa.float64()))


def _evidence(toxic: float, other: float):
    """Twice the log likelihood ratio that a word goes with the label (columns
    ``toxic`` and ``other``; documents of either kind in the sample)."""
    n, base = F.col("toxic") + F.col("other"), toxic / max(1.0, toxic + other)

    def part(k, p):
        return F.when(k > 0, k * F.log((k / n) / F.lit(p))).otherwise(F.lit(0.0))

    return 2 * (part(F.col("toxic"), max(base, 1e-12)) + part(F.col("other"), max(1 - base, 1e-12)))


def learn(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, features: int = FEATURES,
          id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic") -> Model:
    """Fit on at most ``sample_docs`` labelled documents (one label per id; null
    labels and ids are left out). The sample's ids and the chosen words are all that
    is broadcast; both are bounded by the parameters. Without labels of both kinds
    the model finds nothing toxic."""
    spark = docs.sparkSession
    picked = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(toxic_col).cast("int").alias("toxic"))
              .dropna().groupBy("id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("id"), "id").limit(sample_docs))
    picked = spark.createDataFrame(picked.toArrow(), picked.schema).where("toxic IS NOT NULL")
    sample = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")) \
        .join(F.broadcast(picked), "id").where("text IS NOT NULL").select("text", (F.col("toxic") > 0).alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return Model({}, np.zeros(0))
    found = arrow_map(sample, vocabulary_kernel, "word string, toxic long, other long").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).where(F.col("toxic") + F.col("other") >= MIN_DOCS)
    base = sizes[True] / sizes[False]
    with scratch_tables(spark):
        found = cut_lineage(found)
        need = max(EVIDENCE, 2 * math.log(max(1, found.count())))
        rows = found.where(F.col("toxic") > F.lit(base) * F.col("other")) \
            .withColumn("e", _evidence(sizes[True], sizes[False])).where(F.col("e") >= need) \
            .orderBy(F.desc("e"), "word").limit(features).collect()
    names = {r.word: i for i, r in enumerate(rows)}
    got = arrow_map(sample, features_kernel, "toxic boolean, cols array<long>, vals array<double>",
                    spark.sparkContext.broadcast(names)).collect()
    cols = [np.array(r.cols, np.int64) for r in got]
    toxic = np.array([r.toxic for r in got])
    marks = np.array([len(c) for c in cols])
    grades = np.where(toxic, 1 + (marks > np.median(marks[toxic])), 0)
    row = np.repeat(np.arange(len(got)), [len(c) for c in cols])
    col = np.concatenate([*cols, np.zeros(0, np.int64)])
    val = np.concatenate([*(np.array(r.vals, np.float64) for r in got), np.zeros(0)])
    model = fit(row, col, val, grades, names)
    z = np.bincount(row, weights=val * model.weights[col], minlength=len(got))
    usual = np.quantile(_sigmoid(z - model.thresholds[0])[grades == 0], CLEAN_SHARE)
    none = _sigmoid(-model.thresholds[0])  # of a text without features
    model.cut = float(min(0.5, max(usual, 2 * none, LEAST_CUT) + 1e-6))
    return model


# ------------------------------------------------------------------ the operator

def score_kernel(batches, model):
    for b in slices(batches, "text", CHARS):
        p = model.value.at_least(b.column("text").to_pylist())
        each = -np.diff(np.concatenate([np.ones((len(p), 1)), p, np.zeros((len(p), 1))], axis=1), axis=1)
        yield record_batch({"doc_id": b.column("doc_id"), "expected_severity": p.sum(axis=1),
                            "grade": each.argmax(axis=1), "p_toxic": p[:, 0], "toxic": p[:, 0] >= model.value.cut},
                           grade=pa.int32())


def not_toxic(texts: list[str | None], model) -> list[bool]:
    return (model.value.at_least(texts)[:, 0] < model.value.cut).tolist()


def severity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, expected_severity (0 to 2), grade (most likely; the lower of
    equals), p_toxic = P(grade >= 1), toxic.

    One narrow pass over whole texts. Null and empty texts get the model's
    intercepts; repeated rows and null ids come back as they are."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(rows, score_kernel, "doc_id long, expected_severity double, grade int, p_toxic double, toxic boolean",
                     docs.sparkSession.sparkContext.broadcast(model))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not toxic, with their columns."""
    return keep_rows(docs, text_col, not_toxic, docs.sparkSession.sparkContext.broadcast(model))
