"""Registered queries of the training-data operators: thin, with production
parameters, over whole tables. ORACLES has those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from burstwatch.llm import language_id, toxicity
from burstwatch.llm.ann_graph import nearest
from burstwatch.llm.bpe_codec import bpe_digests
from burstwatch.llm.collocations import collocations
from burstwatch.llm.exact_dedup import exact_duplicates
from burstwatch.llm.near_dedup import near_duplicates
from burstwatch.llm.packing import pack_sequences
from burstwatch.llm.parameters import FILE_END, PACK_END, PIECES, QUERY_STEP, TOKEN_LIMIT, TOP, VOCAB, WINDOW
from burstwatch.llm.secret_scan import secret_scan
from burstwatch.llm.source_audit import source_audit
from burstwatch.llm.token_count import token_counts
from burstwatch.llm.token_files import fresh_root, read_token_files, write_token_files
from burstwatch.llm.topk_pivots import top_products


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"),
                        PIECES, limit=TOKEN_LIMIT)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.learn(docs, _table(spark, sf_dir, "labels")))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_sequences(_table(spark, sf_dir, "documents"), VOCAB, end_id=PACK_END, window=WINDOW)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_root(spark, "token-files")
    write_token_files(_table(spark, sf_dir, "documents"), root, VOCAB, end_id=FILE_END)
    return read_token_files(spark, root)


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=3, percent=85)


def op6_ann_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _table(spark, sf_dir, "embeddings")
    return nearest(x, x.where(f"vec_id % {QUERY_STEP} = 0"), k=TOP)


def op7_topk_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _table(spark, sf_dir, "embeddings")
    return top_products(x, x.where(f"vec_id % {QUERY_STEP} = 0"), k=TOP)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(_table(spark, sf_dir, "documents"))


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(_table(spark, sf_dir, "documents"), VOCAB[0], VOCAB[1])


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.learn(docs))


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit(_table(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_toxicity": op2_toxicity,
    "op3_packing": op3_packing,
    "op4_token_files": op4_token_files,
    "op5_near_dedup": op5_near_dedup,
    "op6_ann_graph": op6_ann_graph,
    "op7_topk_pivots": op7_topk_pivots,
    "op8_secret_scan": op8_secret_scan,
    "op9_bpe_codec": op9_bpe_codec,
    "op10_language_id": op10_language_id,
    "op11_source_audit": op11_source_audit,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_collocations": op13_collocations,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {
    "op7_topk_pivots": f"""
WITH x AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS DOUBLE)) AS w
           FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_inner_product(q.w, x.w) AS BIGINT) AS score
      FROM x AS q JOIN x ON q.vec_id <> x.vec_id WHERE q.vec_id % {QUERY_STEP} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {TOP}""",
    "op11_source_audit": r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found,
                  row_number() OVER () AS doc FROM documents),
w AS (SELECT lang, source, doc, translate(unnest(found), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS c FROM w GROUP BY ALL HAVING count(DISTINCT doc) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
gt AS (SELECT g.lang, g.source, kept.term, CAST(coalesce(n.c, 0) AS HUGEINT) AS c, kept.c AS lang_c
       FROM g JOIN kept USING (lang) LEFT JOIN (SELECT lang, source, term, count(*) AS c FROM w GROUP BY ALL) AS n USING (lang, source, term)),
p AS (SELECT *, 1 + (1000000000 * (c + 1)) // (sum(c) OVER (PARTITION BY lang, source) + count(*) OVER (PARTITION BY lang, source)) AS p,
             1 + (1000000000 * (lang_c + 1)) // (sum(lang_c) OVER (PARTITION BY lang, source) + count(*) OVER (PARTITION BY lang, source)) AS lang_p FROM gt),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // y.p), 0) AS value
          FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN p AS x ON x.lang = a.lang AND x.source = a.source
          LEFT JOIN p AS y ON y.lang = a.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
u AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
      UNION ALL SELECT lang, source, 'term', term, ((p - lang_p) * (p - lang_p)) // lang_p FROM p WHERE c > 0 AND p > lang_p),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM r WHERE part = 'pair' OR rank <= 200""",
    "op12_exact_dedup": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain FROM documents),
k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY plain ORDER BY length(text) DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY plain) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256 FROM k""",
    "op13_collocations": r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, row_number() OVER () AS line, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
s AS (SELECT lang, line, unnest(w) AS w1, unnest(range(len(w))) AS i FROM w),
x AS (SELECT lang, w1, lead(w1) OVER (PARTITION BY line ORDER BY i) AS w2, lead(w1, 2) OVER (PARTITION BY line ORDER BY i) AS w3 FROM s),
f1 AS (SELECT lang, w1 AS p, CAST(count(*) AS HUGEINT) AS f FROM x GROUP BY ALL),
f2 AS (SELECT lang, w1 || ' ' || w2 AS p, w1, w2, CAST(count(*) AS HUGEINT) AS f FROM x WHERE w2 IS NOT NULL GROUP BY ALL HAVING f >= 10),
f3 AS (SELECT lang, w1 || ' ' || w2 || ' ' || w3 AS p, w1, w1 || ' ' || w2 AS w12, w2 || ' ' || w3 AS w23, w3,
              CAST(count(*) AS HUGEINT) AS f FROM x WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3 HAVING f >= 10),
n AS (SELECT lang, sum(f) AS n FROM f1 GROUP BY ALL),
cuts AS (SELECT c.lang, c.p, c.f AS a, 1 AS k, l.f AS l, r.f AS r FROM f2 AS c
         JOIN f1 AS l ON l.lang = c.lang AND l.p = c.w1 JOIN f1 AS r ON r.lang = c.lang AND r.p = c.w2
         UNION ALL SELECT c.lang, c.p, c.f, 1, l.f, r.f FROM f3 AS c
         JOIN f1 AS l ON l.lang = c.lang AND l.p = c.w1 JOIN f2 AS r ON r.lang = c.lang AND r.p = c.w23
         UNION ALL SELECT c.lang, c.p, c.f, 2, l.f, r.f FROM f3 AS c
         JOIN f2 AS l ON l.lang = c.lang AND l.p = c.w12 JOIN f1 AS r ON r.lang = c.lang AND r.p = c.w3),
scored AS (SELECT *, (1000000 * a * a) // (l * r) AS score FROM cuts),
low AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS nth FROM scored),
most AS (SELECT lang, p, max(f) AS most FROM (SELECT lang, w12 AS p, f FROM f3 UNION ALL SELECT lang, w23, f FROM f3) GROUP BY ALL),
kept AS (SELECT low.lang, low.p AS phrase, a, l, r, score FROM low LEFT JOIN most ON most.lang = low.lang AND most.p = low.p
         WHERE nth = 1 AND (most IS NULL OR 100 * most < 50 * a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000""",
}

if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
