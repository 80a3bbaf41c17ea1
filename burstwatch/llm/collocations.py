"""Phrase collocations by top-order marginalisation.

Each word of a piece starts one window: itself and the words after it in lead columns,
padded with nulls at the end of the piece. Only these longest windows are counted.
ROLLUP then sums them over successively shorter prefixes, which gives the count of
every phrase of fewer words (and of all words), as each occurrence of a phrase is the
prefix of exactly one window."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burstwatch.llm.tasks import arrow_map
from burstwatch.operators.joins import sized_broadcast
from burstwatch.session import cut_lineage

#: Words that a task counts at once.
CHUNK_WORDS = 3_000_000
#: Bytes of a text that are split into words at once; a piece is never cut.
BLOCK_BYTES = 4_000_000

_PIECE_END, _BLANK = b".,;:!?\n\x0b\x0c\r", b"\t"
#: Ends of pieces become a line feed, a tab becomes a space.
_TABLE = bytes.maketrans(_PIECE_END + _BLANK, b"\n" * len(_PIECE_END) + b" ")


def blocks(text: bytes, limit: int = BLOCK_BYTES):
    """A text in runs of whole pieces of about ``limit`` bytes."""
    at = 0
    while at < len(text):
        end = len(text) if len(text) - at <= limit else text.find(b"\n", at + limit)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end + 1


def _windows(lang: str, runs: list, lengths: list, m: int) -> pa.RecordBatch:
    """Distinct padded windows of a chunk's words, with their counts."""
    words = pa.chunked_array(runs).unify_dictionaries()
    ids = np.concatenate([c.indices.to_numpy() for c in words.chunks])
    vocabulary = words.chunk(0).dictionary
    pad, n = len(vocabulary), len(ids)
    left = np.repeat(np.cumsum(lengths).astype(np.int32), lengths) - np.arange(n, dtype=np.int32)  # in the piece
    lead = [ids]
    for k in range(1, m):
        moved = np.full(n, pad, ids.dtype)
        moved[:n - k] = ids[k:] if k < n else ids[:0]
        moved[left <= k] = pad
        lead.append(moved)
    del left
    key, top = lead[0].astype(np.int64), pad + 1
    for column in lead[1:]:
        if top > (1 << 62) // (pad + 1):  # beyond 64 bits: number the prefixes anew
            key = np.unique(key, return_inverse=True)[1]
            top = int(key.max()) + 1
        key, top = key * (pad + 1), top * (pad + 1)
        key += column
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    padded = pa.concat_arrays([vocabulary, pa.array([None], pa.binary())])
    columns = [padded.take(pa.array(c[first])) for c in lead]

    def joined(some: list) -> pa.Array:
        if not some:
            return pa.array([""] * len(first), pa.string())
        out = pc.fill_null(some[0], b"")
        for more in some[1:]:  # pads are at the end: after one there are only pads
            out = pc.if_else(pc.is_valid(more), pc.binary_join_element_wise(out, pc.fill_null(more, b""), b" "), out)
        return out.cast(pa.string())

    # two strings a window take a third less of the shuffle than one for each word
    return pa.record_batch([pa.array([lang] * len(first), pa.string()), joined(columns[:2]), joined(columns[2:]),
                            pa.array(counts, pa.int64())], names=["lang", "head", "tail", "n"])


def windows_kernel(batches, m: int, chunk_words: int = CHUNK_WORDS, block_bytes: int = BLOCK_BYTES):
    """(lang, text) rows to (lang, head, tail, n): counts of the windows of a chunk, their
    first two words and the rest joined by spaces."""
    runs: dict[str, tuple[list, list]] = {}
    held = 0

    def flush():
        for lang, (words, lengths) in runs.items():
            out = _windows(lang, words, np.concatenate(lengths), m)
            for at in range(0, out.num_rows, 100_000):
                yield out.slice(at, 100_000)
        runs.clear()

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())):
            for block in blocks((text.as_py() or b"").lower().translate(_TABLE), block_bytes):
                words, lengths = [], []
                for piece in block.split(b"\n"):
                    if own := piece.split():
                        words += own
                        lengths.append(len(own))
                if not words:
                    continue
                into = runs.setdefault(lang, ([], []))
                into[0].append(words)
                into[1].append(np.array(lengths))
                held += len(words)
                if held >= chunk_words:
                    _encode(runs)
                    yield from flush()
                    held = 0
        _encode(runs)
    yield from flush()


def _encode(runs: dict) -> None:
    """Word lists of a batch as dictionary codes, which hold each word's bytes once."""
    for words, _ in runs.values():
        fresh = [w for w in words if isinstance(w, list)]
        if fresh:
            words[:] = [w for w in words if not isinstance(w, list)]
            words.append(pa.array([w for own in fresh for w in own], pa.binary()).dictionary_encode())


def _foldable(counted: DataFrame, columns: list[str], least: int) -> DataFrame:
    """Windows whose words stay only as far as the prefix occurs ``least`` times: the
    rest of a window is in no phrase that does, and only its shorter prefixes are asked
    for. ``counted`` is dealt by language and head, so all windows of a prefix are here."""
    m = len(columns)
    out = counted.withColumn("w1", F.substring_index("head", " ", 1)).withColumn(
        "w2", F.when(F.instr("head", " ") > 0, F.substring_index("head", " ", -1)))
    rest = F.split("tail", " ")
    for k in range(3, m + 1):
        out = out.withColumn(f"w{k}", F.when(F.col("tail") != "", F.get(rest, k - 3)))
    kept = F.lit(True)
    for k in range(2, m + 1):
        prefix = Window.partitionBy("lang", "head", *columns[2:k])
        total = F.col("n") if k == m else F.sum("n").over(prefix)
        out = out.withColumn(f"_k{k}", total >= least)
    for k in range(2, m + 1):
        kept = kept & F.col(f"_k{k}")
        out = out.withColumn(f"_w{k}", F.when(kept, F.col(columns[k - 1])))
    return out.select("lang", "w1", *[F.col(f"_w{k}").alias(f"w{k}") for k in range(2, m + 1)], "n")


def _ratio(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact up to counts of 10^16."""
    wide = [c.cast("decimal(20,0)") for c in (a, left, right)]
    return F.call_function("div", wide[0] * wide[0] * F.lit(1_000_000).cast("decimal(7,0)"), wide[1] * wide[2])


def _same(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], value: str) -> DataFrame:
    """``left`` with ``value``: the count in ``right`` of the phrase that its columns name."""
    r = right.select(F.col("lang").alias("_lang"), *[F.col(c).alias(f"_{c}") for _, c in on], F.col("n").alias(value))
    cond = F.col("lang") == F.col("_lang")
    for mine, theirs in on:
        cond = cond & (F.col(mine) == F.col(f"_{theirs}"))
    return left.join(r, cond).drop("_lang", *[f"_{c}" for _, c in on])


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 3,
                 least: int = 10, cover_percent: int = 50, top: int = 2_000,
                 chunk_words: int = CHUNK_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The best ``top`` phrases of 2 to ``max_words`` words per language: (lang, rank,
    phrase, a, l, r, n, score).

    A-Z are lower-cased; pieces end at ``.,;:!?`` and line ends, words at spaces and
    tabs. ``a``, ``l`` and ``r`` count the phrase and the two parts of its lowest-scoring
    cut (ties: the earliest), ``n`` all words of the language, score is
    floor(1000000*a*a/(l*r)). A phrase stands for ``least`` occurrences or more, and
    goes if a longer one that holds it reaches ``cover_percent`` of its count.

    A null text is empty and a null language ``und``; texts without words and an empty
    table give no rows; a repeated row counts again. A very long text is counted block by
    block of whole pieces, a single piece is held whole. Only the two columns are read.

    Windows are counted inside a task, then dealt by language and first two words."""
    if max_words < 2:
        raise ValueError("phrases have two words at least")
    columns = [f"w{k + 1}" for k in range(max_words)]
    read = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    found = arrow_map(read, windows_kernel, "lang string, head string, tail string, n long",
                      max_words, chunk_words, block_bytes)
    counted = found.repartition("lang", "head").groupBy("lang", "head", "tail").agg(F.sum("n").alias("n"))
    folded = _foldable(counted, columns, least)
    level = F.col("level")
    # of each prefix length the prefixes that are not padded; Spark filters before it shuffles
    real = (level == (1 << max_words) - 1)
    for k in range(1, max_words + 1):
        real = real | ((level == (1 << (max_words - k)) - 1) & F.col(columns[k - 1]).isNotNull())
    sums = cut_lineage(folded.rollup("lang", *columns).agg(F.sum("n").alias("n"), F.grouping_id().alias("level")).where(real)
                       .where(F.col("lang").isNotNull()))

    def counts(k: int) -> DataFrame:
        """Phrases of k words (0: the languages) with their counts."""
        return sums.where(F.col("level") == (1 << (max_words - k)) - 1).select("lang", *columns[:k], "n")

    # phrases that cannot be part of a candidate were folded; single words are cut here
    parts = {k: sized_broadcast(counts(k).where(F.col("n") >= least)) for k in range(1, max_words)}
    scored = {}
    for size in range(2, max_words + 1):
        own = counts(size).where(F.col("n") >= least).withColumnRenamed("n", "a")
        cuts = []
        for k in range(1, size):
            own = _same(own, parts[k], [(c, c) for c in columns[:k]], f"_l{k}")
            own = _same(own, parts[size - k], list(zip(columns[k:size], columns)), f"_r{k}")
            left, right = F.col(f"_l{k}"), F.col(f"_r{k}")
            cuts.append(F.struct(_ratio(F.col("a"), left, right).alias("score"), F.lit(k).alias("k"),
                                 left.alias("l"), right.alias("r")))
        low = F.least(*cuts) if len(cuts) > 1 else cuts[0]
        scored[size] = own.withColumn("_cut", low).select("lang", *columns[:size], "a", "_cut.l", "_cut.r", "_cut.score")
    kept = []
    for size, rows in scored.items():
        inside = None
        for longer in range(size + 1, max_words + 1):
            for at in range(longer - size + 1):
                part = counts(longer).where(F.col("n") >= least).select(
                    F.col("lang").alias("_lang"), *[F.col(columns[at + j]).alias(f"_w{j + 1}") for j in range(size)], "n")
                inside = part if inside is None else inside.union(part)
        if inside is not None:
            keys = ["_lang", *[f"_w{j + 1}" for j in range(size)]]
            most = inside.groupBy(*keys).agg(F.max("n").alias("_most"))
            cond = F.col("lang") == F.col("_lang")
            for j in range(size):
                cond = cond & (F.col(columns[j]) == F.col(f"_w{j + 1}"))
            rows = rows.join(most, cond, "left").where(
                F.col("_most").isNull() | (100 * F.col("_most") < cover_percent * F.col("a"))).drop(*keys, "_most")
        kept.append(rows.select("lang", F.concat_ws(" ", *columns[:size]).alias("phrase"), "a", "l", "r", "score"))
    every = kept[0]
    for more in kept[1:]:
        every = every.union(more)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    total = counts(0).select(F.col("lang").alias("_lang"), F.col("n"))
    return ranked.join(sized_broadcast(total), F.col("lang") == F.col("_lang")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
