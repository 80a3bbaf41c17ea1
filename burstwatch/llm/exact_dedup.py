"""Exact duplicates, combined in three steps that a hot text cannot overload.

1. Each task combines the equal texts that it reads (the partial aggregation).
2. What is left is merged by (digest, salt, text): a digest of many rows has about the
   square root of their number of salts, any other has one.
3. The winners of the salts are merged by (digest, text).

The whole text is a key at each step, so two texts are one group only if they are
equal; the digest deals them out. Texts that nobody else's digest equals need no step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstwatch.llm.tasks import input_partitions
from burstwatch.operators.joins import null_safe_join, sized_broadcast
from burstwatch.session import cut_lineage

#: Characters that do not count: the class that is deleted.
BLANKS = r"[\x20\x09-\x0D]+"
#: Rows from which a digest is salted, and the most digests that are: above one row in
#: HOT_DIGESTS there are fewer than that many.
HOT_ROWS, HOT_DIGESTS = 1_000, 10_000
#: Copies of one and the same row that a task writes out.
COPIES = 10_000

_LONGS, _HALF = "100000000000000000000", "9223372036854775808"


def _rank(length: Column, doc_id: Column) -> Column:
    """One number that grows with the length and falls with the id (no id: last)."""
    after = F.when(doc_id.isNotNull(), F.lit(_HALF).cast("decimal(20,0)") - doc_id.cast("decimal(19,0)")).otherwise(F.lit(0))
    return (length.cast("decimal(10,0)") * F.lit(_LONGS).cast("decimal(21,0)") + after.cast("decimal(21,0)")).cast("decimal(38,0)")


def _unrank(rank: Column) -> tuple[Column, Column]:
    """Length and id of a rank."""
    unit = F.lit(_LONGS).cast("decimal(21,0)")
    after = rank % unit
    half = F.lit(_HALF).cast("decimal(20,0)")
    return F.call_function("div", rank, unit), F.when(after > 0, (half - after.cast("decimal(20,0)")).cast("long"))


def _written_out(rows: DataFrame) -> DataFrame:
    """``rows`` (copies, is_best, ...) once for each copy; of the best ones the first
    copy is kept. Many copies are first cut into runs that other tasks write out."""
    def out(part: DataFrame) -> DataFrame:
        return part.select("*", F.explode(F.sequence("first", "last")).alias("copy")) \
            .withColumn("kept", F.col("is_best") & (F.col("copy") == 1))

    one = F.lit(1).cast("long")
    few = rows.where(F.col("copies") <= COPIES).withColumn("first", one).withColumn("last", F.col("copies"))
    many = rows.where(F.col("copies") > COPIES) \
        .withColumn("first", F.explode(F.sequence(one, "copies", F.lit(COPIES).cast("long")))) \
        .withColumn("last", F.least(F.col("first") + (COPIES - 1), F.col("copies"))) \
        .repartition(input_partitions(rows.sparkSession), "digest", "first")
    return out(few).union(out(many))


def _answer(rows: DataFrame) -> DataFrame:
    """Documents with their class (best, size) to the result's columns."""
    length, keep_id = _unrank(F.col("best"))
    mine = rows.withColumn("_id", keep_id).withColumn(
        "is_best", (F.col("n_chars") == length) & F.col("doc_id").eqNullSafe(F.col("_id")))
    return _written_out(mine).select(
        "doc_id", F.col("_id").alias("keep_id"), F.col("size").alias("group_size"), "kept",
        F.lower(F.hex("sha")).alias("text_sha256"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     digest_bytes: int = 32, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per document: (doc_id, keep_id, group_size, kept, text_sha256).

    Texts are equal if they are the same without blanks (spaces, tabs and line ends). The
    one of most characters in its original form stays, then the one of the smallest id.
    ``digest_bytes`` of the digest deal out the texts (fewer make collisions, which are
    told apart by the texts themselves); digests of more than ``hot_rows`` rows, and of
    more than one row in HOT_DIGESTS, are salted.

    A null text is empty, and all empty texts are one group. Ids are integers; a row
    without one ranks last in its group and may stay, its keep_id is null then. Of
    repeated rows that all would stay exactly one is kept. A text is one value, however
    long; an empty table gives no rows. Only the two columns are read."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    plain = F.regexp_replace(text, BLANKS, "")
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.length(text).alias("n_chars"), plain.alias("plain")) \
        .withColumn("sha", F.unhex(F.sha2(F.col("plain"), 256))) \
        .withColumn("digest", F.substring("sha", 1, digest_bytes))
    # what repeats whole is one row with its number of copies
    rows = cut_lineage(base.groupBy("digest", "sha", "doc_id", "n_chars").agg(F.count(F.lit(1)).alias("copies")))
    sizes = cut_lineage(rows.groupBy("digest").agg(F.sum("copies").alias("n")).where("n > 1"))
    total = rows.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    hot = F.broadcast(sizes.where(F.col("n") > max(hot_rows, total // HOT_DIGESTS)).select(
        "digest", F.ceil(F.sqrt(F.col("n").cast("double"))).cast("long").alias("salts")))

    texts = base
    repeated = sizes.select("digest")
    if (known := sized_broadcast(repeated)) is not repeated:
        texts = base.join(known, "digest", "left_semi")  # small enough: texts of one row are not shuffled
    salted = texts.join(hot, "digest", "left").withColumn(
        "salt", F.when(F.col("salts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("doc_id", "n_chars"), F.col("salts"))))
    merged = salted.groupBy("digest", "salt", "plain").agg(
        F.max(_rank(F.col("n_chars"), F.col("doc_id"))).alias("best"), F.count(F.lit(1)).alias("size"),
        F.max(F.col("salts").isNotNull()).alias("hot"))
    # of a digest without salts only the class is needed from here on
    winners = cut_lineage(merged.select("digest", "hot", F.when(F.col("hot"), F.col("plain")).alias("plain"), "best", "size"))
    across = winners.where("hot").groupBy("digest", "plain").agg(F.max("best").alias("best"), F.sum("size").alias("size"))
    classes = winners.where("NOT hot").select("digest", "best", "size").union(across.select("digest", "best", "size"))
    by_digest = cut_lineage(classes.groupBy("digest").agg(
        F.count(F.lit(1)).alias("texts"), F.max("best").alias("best"), F.sum("size").alias("size")))

    plain_classes = by_digest.where("texts = 1").select("digest", "best", "size")
    collided = cut_lineage(by_digest.where("texts > 1").select("digest"))
    # hot digests are few: their many rows meet them without a shuffle
    alone = _rank(F.col("n_chars"), F.col("doc_id"))
    near = rows.join(F.broadcast(plain_classes.join(hot, "digest", "left_semi")), "digest")
    far = rows.join(hot, "digest", "left_anti")
    some_collide = not collided.isEmpty()
    if some_collide:
        far = far.join(collided, "digest", "left_anti")
    far = far.join(sized_broadcast(plain_classes), "digest", "left") \
        .withColumn("best", F.coalesce("best", alone)).withColumn("size", F.coalesce("size", F.lit(1).cast("long")))
    answer = _answer(near.select(*far.columns).union(far))
    if some_collide:
        # different texts of one digest: each row is held against the texts of its digest
        theirs = base.join(collided, "digest", "left_semi")
        of_text = theirs.groupBy("digest", "plain", "sha", "doc_id", "n_chars").agg(F.count(F.lit(1)).alias("copies"))
        best = theirs.groupBy("digest", "plain").agg(
            F.max(_rank(F.col("n_chars"), F.col("doc_id"))).alias("best"), F.count(F.lit(1)).alias("size"))
        answer = answer.union(_answer(null_safe_join(of_text, best, ["digest", "plain"])))
    return answer
