"""Divergence of sources from their language, by ranks of count cells.

All terms of a (lang, source) group that have the same count there and the same count
in the language have the same smoothed probabilities, so the divergence is evaluated
once per cell (group count, lang count). Cells of one value are merged, cumulative
multiplicities say which values reach the report, and only those are expanded into
their terms. A term of a language is one row with all its sources. Pairs of sources go the same way: joint cells (count here, count there)
of the terms that both have; all others follow from each source's own cells and zero."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burstwatch.llm.tasks import arrow_map, slices
from burstwatch.operators.joins import sized_broadcast
from burstwatch.session import cut_lineage

#: Occurrences of terms that a task collects before it counts them and hands them on.
HELD_TERMS = 4_000_000
#: Counted terms of an Arrow batch.
BATCH_TERMS = 20_000
SCALE = 1_000_000_000

#: A-Z become lower case; of the other ASCII only a-z stay, the rest are spaces. Bytes
#: from 0x80 on, which make up all other letters, are terms' too.
_TABLE = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or 65 <= c <= 90 or 97 <= c <= 122 else 32
               for c in range(256))


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts in one array, and the number of terms of each text."""
    whole = pc.fill_null(texts.cast(pa.large_binary()), b"")
    ends = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset:whole.offset + len(whole) + 1]
    data = whole.buffers()[2]
    data = data[int(ends[0]):int(ends[-1])].to_pybytes() if data else b""
    chars = np.frombuffer(data.translate(_TABLE), np.uint8)
    inside = chars != 32
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = ends[:-1] - ends[0]
    at = at[at < len(chars)]
    first[at] = inside[at]
    per_text = np.diff(np.searchsorted(np.flatnonzero(first), ends - ends[0]))
    letters = chars[inside]
    offsets = np.append(np.flatnonzero(first[inside]), len(letters)).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [
        None, pa.py_buffer(offsets), pa.py_buffer(letters)]), per_text


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ascending, and their counts; ``values`` are sorted in place.
    (``np.unique`` hashes, which is slower on so many distinct values.)"""
    values.sort()
    first = np.flatnonzero(np.diff(values, prepend=values[:1] - 1))
    return values[first], np.diff(first, append=len(values))


def _counted(langs: pa.Array, sources: pa.Array, terms: pa.Array, per_text: np.ndarray):
    """Batches (lang, term, found) with found the (source, n, docs) of the term."""
    langs, sources, terms = (x.dictionary_encode() for x in (langs, sources, terms))
    lang, source, term = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in (langs, sources, terms))
    places = len(sources.dictionary)
    groups, group = np.unique(lang * places + source, return_inverse=True)
    # numbers for (term, lang, source); both counts have the same ones, in the same order
    keys = np.repeat(group, per_text)
    keys += term * len(groups)
    keys, n = _distinct(keys)
    rows = np.repeat(np.arange(len(per_text)), per_text)
    rows *= len(terms.dictionary)
    rows += term
    row, term = np.divmod(_distinct(rows)[0], len(terms.dictionary))
    docs = _distinct(term * len(groups) + group[row])[1]
    term, group = np.divmod(keys, len(groups))
    lang, source = np.divmod(groups[group], places)
    first = np.flatnonzero(np.diff(term * len(langs.dictionary) + lang, prepend=-1))
    found = pa.StructArray.from_arrays(
        [sources.dictionary.take(pa.array(source)), pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
        names=["source", "n", "docs"])
    counts = pa.record_batch(
        [langs.dictionary.take(pa.array(lang[first])),
         terms.dictionary.take(pa.array(term[first])).cast(pa.large_string()).cast(pa.string()),
         pa.ListArray.from_arrays(pa.array(np.append(first, len(keys)), pa.int32()), found)],
        names=["lang", "term", "found"])
    for at in range(0, counts.num_rows, BATCH_TERMS):
        yield counts.slice(at, BATCH_TERMS)


def term_counts_kernel(batches, held: int = HELD_TERMS):
    """(lang, source, text) rows to (lang, term, found): the sources that have the term,
    how often and in how many rows."""
    parts, size = [], 0

    def flush():
        if parts:
            langs, sources, terms, per_text = zip(*parts)
            yield from _counted(pa.concat_arrays(langs), pa.concat_arrays(sources), pa.concat_arrays(terms),
                                np.concatenate(per_text))
        parts.clear()

    for b in slices(batches, 2):
        terms, per_text = _split(b.column(2))
        if not len(terms):
            continue
        at = np.flatnonzero(per_text)
        # copies: a slice would hold its whole batch, with the texts
        langs, sources = (b.column(i).cast(pa.string()).take(pa.array(at)) for i in (0, 1))
        parts.append((langs, sources, terms, per_text[at]))
        size += len(terms)
        if size > held:
            yield from flush()
            size = 0
    yield from flush()


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 * (count + 1) / (total + kept)), exact."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", top, F.greatest(total + kept, F.lit(1)).cast("decimal(20,0)"))


def _gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares are at most 10^9 + 1, so the square fits a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Equi-join that keeps the keys once."""
    return left.join(right, keys)


def _pairs(groups: DataFrame, by_term: DataFrame, cells: DataFrame) -> DataFrame:
    """(lang, source, item, value): every ordered pair of sources of a language."""
    wide = "decimal(38,0)"
    zero = _share(F.lit(0).cast("long"), F.col("total"), F.col("kept"))
    side = groups.select("lang", "source", "total", "kept", zero.alias("zero"))
    here = side.select("lang", "source", F.col("total").alias("n_here"), F.col("zero").alias("z_here"), "kept")
    there = side.select("lang", F.col("source").alias("item"), F.col("total").alias("n_there"),
                        F.col("zero").alias("z_there"))
    pairs = cut_lineage(here.join(sized_broadcast(there), "lang").where("source <> item"))
    nothing = _gap(F.col("z_here"), F.col("z_there"))
    base = pairs.select("lang", "source", "item",
                        F.when(F.col("kept") > 0, nothing.cast(wide) * F.col("kept").cast("decimal(19,0)"))
                        .otherwise(F.lit(0)).cast(wide).alias("value"))

    def share(count: str, total: str) -> Column:
        return _share(F.col(count), F.col(total), F.col("kept"))

    def weighed(each: Column) -> Column:
        return (each.cast("decimal(19,0)") * F.col("cells").cast("decimal(18,0)")).cast(wide).alias("value")

    cells = cut_lineage(cells.groupBy("lang", "source", "n").agg(F.sum("cells").alias("cells")))
    own = _joined(pairs, cells, ["lang", "source"]).select(
        "lang", "source", "item", weighed(_gap(share("n", "n_here"), F.col("z_there")) - nothing))
    other = _joined(pairs, cells.withColumnRenamed("source", "item"), ["lang", "item"]).select(
        "lang", "source", "item", weighed(_gap(F.col("z_here"), share("n", "n_there")) - nothing))
    # terms of both sources, once for the two directions
    joint = by_term.where(F.size("found") > 1) \
        .select("lang", "found", F.inline("found").alias("s1", "n1")) \
        .select("lang", "s1", "n1", F.inline("found").alias("s2", "n2")) \
        .where("s1 < s2").groupBy("lang", "s1", "s2", "n1", "n2").agg(F.count(F.lit(1)).alias("cells"))
    directions = F.array(F.struct(F.col("s1").alias("source"), F.col("s2").alias("item"),
                                  F.col("n1").alias("x"), F.col("n2").alias("y")),
                         F.struct(F.col("s2").alias("source"), F.col("s1").alias("item"),
                                  F.col("n2").alias("x"), F.col("n1").alias("y")))
    both = joint.select("lang", "cells", F.inline(directions))
    p, q = share("x", "n_here"), share("y", "n_there")
    shared = _joined(both, sized_broadcast(pairs), ["lang", "source", "item"]).select(
        "lang", "source", "item",
        weighed(_gap(p, q) - _gap(p, F.col("z_there")) - _gap(F.col("z_here"), q) + nothing))
    return base.union(own).union(other).union(shared).groupBy("lang", "source", "item") \
        .agg(F.sum("value").cast("long").alias("value"))


def _term_ranks(groups: DataFrame, by_term: DataFrame, cells: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value) of the terms that the ranks up to ``top`` hold."""
    group = ["lang", "source"]
    p = _share(F.col("n"), F.col("total"), F.col("kept"))
    q = _share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    valued = cut_lineage(_joined(cells, sized_broadcast(groups), group).select(
        *group, "n", "lang_n", "cells", p.alias("p"), q.alias("q")).where("p > q")
        .select(*group, "n", "lang_n", "cells", _gap(F.col("p"), F.col("q")).alias("value")))
    merged = valued.groupBy(*group, "value").agg(F.sum("cells").alias("cells"))
    falling = Window.partitionBy(*group).orderBy(F.desc("value"))
    # each value has a term at least: no more than ``top`` values can matter
    first = merged.withColumn("at", F.row_number().over(falling)).where(F.col("at") <= top)
    before = F.sum("cells").over(falling.rowsBetween(Window.unboundedPreceding, -1))
    reached = first.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < top) \
        .select(*group, "value")
    chosen = cut_lineage(valued.join(reached, [*group, "value"]).select(*group, "n", "lang_n", "value"))
    terms = by_term.select("lang", "term", "lang_n", F.inline("found"))
    return _joined(terms, sized_broadcast(chosen), [*group, "n", "lang_n"]) \
        .select(*group, F.col("term").alias("item"), "value")


def source_audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                 least_docs: int = 3, top: int = 200, held: int = HELD_TERMS) -> DataFrame:
    """How far each source's terms lie from those of its language's other sources and of
    the language: (lang, source, part, item, value, rank).

    Terms are runs of letters of ASCII and of all characters beyond it, A-Z lower-cased;
    a language keeps those of ``least_docs`` of its documents. With a term's count in a
    group or language, its total over kept terms and their number V, the share is
    1 + floor(10^9 * (count + 1) / (total + V)), the divergence of p from q
    floor((p - q)^2 / q), all exact. Part ``pair`` sums it over the kept terms for each
    other source, all ranks. Part ``term`` has the kept terms of the group whose share
    is above the language's, ranks to ``top``. Ranks: value descending, then item by its
    UTF-8 bytes.

    Nulls are read as ''. A group without any term counts too; an empty table gives no
    rows; a repeated row counts again (as a document of its own). A long text is split
    into terms whole. Only the three columns are read."""
    read = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n)
                         for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    found = arrow_map(read, term_counts_kernel,
                      "lang string, term string, found array<struct<source:string,n:long,docs:long>>", held)
    # dealt by (lang, term) once: sums by source, and all sources of a term, stay in their task
    by_source = found.repartition("lang", "term").select("lang", "term", F.inline("found")) \
        .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = cut_lineage(by_source.groupBy("lang", "term").agg(
        F.collect_list(F.struct("source", "n")).alias("found"), F.sum("n").alias("lang_n"), F.sum("docs").alias("_docs"))
        .where(F.col("_docs") >= least_docs).drop("_docs"))
    cells = cut_lineage(by_term.select("lang", "lang_n", F.inline("found"))
                        .groupBy("lang", "source", "n", "lang_n").agg(F.count(F.lit(1)).alias("cells")))
    none = F.lit(0).cast("long")
    groups = cut_lineage(
        read.select("lang", "source").distinct()
        .join(by_term.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total")), "lang", "left")
        .join(cells.groupBy("lang", "source").agg(F.sum(F.col("n") * F.col("cells")).alias("total")), ["lang", "source"], "left")
        .select("lang", "source", *[F.coalesce(c, none).alias(c) for c in ("kept", "lang_total", "total")]))
    ranks = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                           F.row_number().over(ranks).alias("rank"))

    return ranked(_pairs(groups, by_term, cells), "pair").union(
        ranked(_term_ranks(groups, by_term, cells, top), "term").where(F.col("rank") <= top))
