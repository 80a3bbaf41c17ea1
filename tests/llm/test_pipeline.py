"""Each stage on its own input against a plain version, and the whole run."""

import corpus_pipeline as C
from burstwatch.llm import language_id, toxicity
from burstwatch.llm.secret_scan import find_spans, redacted

from test_near_dedup import plain_classes
from test_packing import check

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert docs.columns == list(C.COLUMNS)
    assert [n for n, _ in C.STAGES] == ["language_id", "toxicity", "near_dedup", "secret_scan", "packing"]

    # language: rejected texts go, clean ones stay
    extra = spark.createDataFrame([(-1, None, "en", "s", 0), (-2, "1234 !!", "en", "s", 7)], docs.schema)
    kept = C.keep_known_languages(spark, docs.union(extra), SF)
    models = language_id.learn(docs)
    said = models.decide([r.text for r in docs.collect()])[3]
    assert rows(kept) == rows(docs) and not said.any()

    # toxicity: exactly the rows that the model calls toxic go
    model = toxicity.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = [tuple(r) for r in docs.collect() if model.at_least([r.text])[0, 0] < model.cut]
    assert rows(C.drop_toxic(spark, docs, SF)) == sorted(want, key=str)

    # near-duplicates: one of each class
    classes = plain_classes([(r.doc_id, r.text) for r in docs.collect()], 5, 80)
    one = C.drop_near_duplicates(spark, docs, SF)
    assert {r.doc_id for r in one.collect()} == {c for _, _, c in classes} and one.columns == docs.columns

    # secrets: no span is left, all rows stay
    secret = spark.createDataFrame([(-1, "é password: hunter22 and AKIA" + "Q" * 16, "en", "s", 9)], docs.schema)
    some = docs.union(secret)
    hidden = C.hide_secrets(spark, some, SF)
    assert hidden.count() == some.count()
    texts = {r.doc_id: r.text for r in some.collect()}
    assert any(find_spans(t) for t in texts.values())
    for r in hidden.collect():
        assert r.text == redacted(texts[r.doc_id]) and r.n_chars == len(r.text)

    check(docs.collect(), C.pack(spark, docs, SF).collect())


def test_run(spark):
    out = C.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    ids = {r.doc_id for r in out.collect()}
    assert ids and ids < {r.doc_id for r in docs.collect()}


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_filters_keep_columns_of_any_name(spark):
    from pyspark.sql import functions as F

    from burstwatch.llm.near_dedup import keep_one
    from burstwatch.llm.secret_scan import redact_secrets

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    odd = docs.withColumns({c: F.col("doc_id") for c in ("_text", "_TEXT_", "_gone", "node", "shingles", "kept", "toxic", "rejected")})
    models, model = language_id.learn(docs), toxicity.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    for out in (language_id.keep_accepted(odd, models), toxicity.keep_clean(odd, model), keep_one(odd), redact_secrets(odd)):
        assert out.columns == odd.columns
        got = out.collect()
        assert got and all(r._text == r.doc_id == r._gone for r in got)
    assert toxicity.severity(odd, model).count() == language_id.identify(odd, models).count() == 40


def test_small_tables_of_the_models_start_no_other_workers(spark, monkeypatch):
    """Rows or pandas frames would be read by Python workers of a second kind, which each
    executor keeps beside those of the kernels; Arrow tables stay in the JVM."""
    import pyarrow as pa

    from burstwatch.llm import language_id, toxicity

    given, make = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **k: given.append(data) or make(self, data, *a, **k))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert language_id.learn(docs).langs
    toxicity.learn(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    assert given and all(isinstance(x, pa.Table) for x in given)
