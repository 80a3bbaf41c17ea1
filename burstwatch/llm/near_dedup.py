"""Near-duplicate classes by fast similarity sketching.

A document's set is its distinct word shingles, as 64-bit hashes. Its sketch has a
fixed number of coordinates: in round after round every shingle is hashed to a
bin with a value, and a bin keeps the smallest value of the first round that
reached it; after as many rounds as bins, round i fills bin i from every shingle, so
that each coordinate is filled. Equal coordinates estimate the Jaccard similarity
with the concentration of that many independent samples.

Documents of equal sets are one node. Bands of coordinates give candidates; links
are confirmed on the full sets. Within a bucket not all pairs are made: all members
are held against one pivot, and linked ones become one component. Buckets of one
component are done. In the others, members that share a rare shingle are held against
each other; apart from these, a member of too many rare shingles cannot be linked and
leaves. What stays meets the next pivot (the member of the fewest rare shingles) as
long as that links something, and in the end each other across components. Components are found by alternating
large-star and small-star steps on tables; nothing is gathered."""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstwatch.llm.tasks import arrow_map, free_name, record_batch, slices
from burstwatch.session import cut_lineage, scratch_tables

BANDS = 40
#: Odds at which a pair of just the threshold may share no band.
MISS = 1e-5
#: Open members that a shingle may have to be rare: their pairs are made one by one.
RARE = 32
#: Rows (two longs each) that may be broadcast.
BROADCAST_ROWS = 250_000
#: Hashes of a sketch's rounds made at a time.
ROUND_HASHES = 1_500

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 (public domain): a bijection of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _series(n: int, seed: int) -> np.ndarray:
    """n pseudo-random 64-bit numbers."""
    return mix((np.arange(1, n + 1, dtype=_U) + _U(seed << 40)) * _U(0x9E3779B97F4A7C15))


@functools.lru_cache(maxsize=8)
def _factors(n: int) -> np.ndarray:
    return _series(n, 1) | _U(1)


@functools.lru_cache(maxsize=8)
def _rounds(n: int) -> np.ndarray:
    return _series(n, 2)


@functools.lru_cache(maxsize=2)
def _bytes() -> tuple[np.ndarray, np.ndarray]:
    """Lower case of A-Z, and whether a byte is white space (0x20, 0x09-0x0D)."""
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    space = np.zeros(256, bool)
    space[[32, 9, 10, 11, 12, 13]] = True
    return low, space


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    raw = [t.encode("utf-8") if t else b"" for t in texts]
    low, space = _bytes()
    data = low[np.frombuffer(b" ".join(raw) + b" ", np.uint8)]
    gap = space[data]
    ends = np.cumsum([len(r) + 1 for r in raw])
    inside = np.flatnonzero(~gap)
    first = np.flatnonzero(np.diff(inside, prepend=-2) > 1)  # of each word, among the bytes inside words
    if not len(first):
        return [np.zeros(0, _U)] * len(texts)
    sizes = np.diff(np.append(first, len(inside)))
    at = np.arange(len(inside)) - np.repeat(first, sizes)
    top = 1 << max(10, int(sizes.max() - 1).bit_length())
    words = mix(np.add.reduceat((data[inside].astype(_U) + _U(1)) * _factors(top)[at], first) + sizes.astype(_U))
    cuts = np.searchsorted(inside[first], np.concatenate(([0], ends)))  # words before each text
    factors = _factors(1024) if k <= 1024 else _factors(k)
    n = len(words)
    rolled = np.zeros(max(0, n - k + 1), _U)
    for j in range(k):
        rolled += words[j:n - k + 1 + j] * factors[j]
    rolled = mix(rolled + _U(k))
    out = []
    for a, b in zip(cuts, cuts[1:]):
        if b - a >= k:
            out.append(np.unique(rolled[a:b - k + 1]))
        elif b > a:
            out.append(mix((words[a:b] * factors[:b - a]).sum(dtype=_U, keepdims=True) + _U(b - a)))
        else:
            out.append(np.zeros(0, _U))
    return out


def sketch(shingles: np.ndarray, t: int) -> np.ndarray:
    """The t coordinates of a non-empty set."""
    out = np.full(t, np.iinfo(_U).max, _U)
    seeds, n, done = _rounds(2 * t), len(shingles), 0
    low, half = _U(0xFFFFFFFF), _U(32)
    while done < 2 * t:
        take = max(1, min(ROUND_HASHES // n, 2 * t - done))
        if done < t:
            take = min(take, t - done)
        h = mix(shingles[None, :] ^ seeds[done:done + take, None])
        value = (np.arange(done, done + take, dtype=_U)[:, None] << half) | (h & low)
        if done < t:
            np.minimum.at(out, (((h >> half) * _U(t)) >> half).astype(np.int64).ravel(), value.ravel())
        else:
            mine = slice(done - t, done - t + take)
            out[mine] = np.minimum(out[mine], value.min(axis=1))
        done += take
        if out.max() != np.iinfo(_U).max:
            break
    return out


def rows_per_band(similarity: float, bands: int = BANDS, miss: float = MISS) -> int:
    """The most coordinates a band may have for the odds of a missed pair."""
    r = 1
    while (1 - similarity ** (r + 1)) ** bands <= miss:
        r += 1
    return r


def band_keys(sketches: np.ndarray, bands: int) -> np.ndarray:
    """[documents, bands] keys of the bands of [documents, coordinates]."""
    n, t = sketches.shape
    parts = sketches.reshape(n, bands, t // bands)
    keys = (parts * _series(t // bands, 3)[None, None, :]).sum(axis=2, dtype=_U)
    return mix(keys + _series(bands, 4)[None, :]).view(np.int64)


def _node(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.astype("<u8").tobytes(), digest_size=8).digest(), "little", signed=True)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


# ------------------------------------------------------------------ kernels

def sketch_kernel(batches, k: int, bands: int, rows: int):
    for b in slices(batches, "text"):
        sets = shingle_sets(b.column("text").to_pylist(), k)
        full = [i for i, s in enumerate(sets) if len(s)]
        keys: list = [None] * len(sets)
        if full:
            made = band_keys(np.stack([sketch(sets[i], bands * rows) for i in full]), bands)
            for i, key in zip(full, made):
                keys[i] = key
        yield record_batch({"doc_id": b.column("doc_id"), "text_key": b.column("text_key"), "n_shingles": [len(s) for s in sets],
                            "node": [_node(s) if len(s) else None for s in sets], "bands": keys},
                           n_shingles=pa.int64(), node=pa.int64(), bands=pa.list_(pa.int64()))


def sets_kernel(batches, k: int):
    """The sets of the wanted nodes (a row's text may be of another node)."""
    for b in slices(batches, "text"):
        sets = shingle_sets(b.column("text").to_pylist(), k)
        keep = [(w, s) for w, s in zip(b.column("wanted").to_pylist(), sets) if len(s) and _node(s) == w]
        yield record_batch({"node": [w for w, _ in keep], "shingles": [s.astype("<u8").tobytes() for _, s in keep]},
                           node=pa.int64(), shingles=pa.binary())


def shingle_kernel(batches):
    """(node, shingle) of sets."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            b = batch.slice(at, 512)
            sets = [np.frombuffer(x, "<i8") for x in b.column("shingles").to_pylist()]
            yield record_batch({"node": np.repeat(b.column("node").to_numpy(), [len(x) for x in sets]),
                                "shingle": np.concatenate(sets)}, node=pa.int64(), shingle=pa.int64())


def confirm_kernel(batches, percent: int):
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            b = batch.slice(at, 1024)
            sa, sb = (b.column(c).to_pylist() for c in ("sa", "sb"))
            ok = pa.array([linked(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), percent) for x, y in zip(sa, sb)], pa.bool_())
            yield b.select(["a", "b"]).filter(ok)


# ------------------------------------------------------------------ components

def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of the edges (a, b): root is the least node of the
    component. Large-star and small-star steps until all edges are stars."""
    edges = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # stored, so that the join below can split a node of many edges
        least = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m")))
        # large star: larger neighbours go to the least neighbour (an edge (u, v), u > v, goes by v)
        large = edges.join(least, F.col("v") == F.col("x")).select("u", F.col("m").alias("v"))
        large = cut_lineage(large.where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), "m")
        # small star: smaller neighbours and the node itself go to the least one
        small = large.join(least, F.col("u") == F.col("x")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(small.union(least.select(F.col("x").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether each larger end has one edge and is no smaller end."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("n"), F.lit(0).alias("low")).union(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("n"), F.lit(1).alias("low")))
    return ends.groupBy("x").agg(F.sum("n").alias("n"), F.max("low").alias("low")).where("n > 1 OR (n = 1 AND low = 1)").isEmpty()


# ------------------------------------------------------------------ the operator

def _few(df: DataFrame) -> DataFrame:
    """A broadcast of ``df``, a stored table of a few longs a row, if it is small enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b, na, nb) whose sets are linked."""
    fit = pairs.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b")
    fit = fit.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    fit = fit.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    return cut_lineage(arrow_map(fit, confirm_kernel, "a long, b long", percent))


def _most(n, common, other, percent: int):
    """Whether a set of ``n`` shingles, of which at most ``common`` are in another set of size
    ``other``, can be linked with it."""
    both = F.least(common, other)
    return 100 * both >= percent * (n + other - both)


def _open(left: DataFrame, roots: DataFrame | None, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, int]:
    """Members (key, node, n, root, rare) of buckets of several components that may have a
    link without a rare shingle in common; the pairs of open members of different
    components that do have one; and the component of most members.

    ``rare`` counts the shingles of a member that at most RARE open members have. Two
    members that share none of them have at most n - rare shingles in common, too few for
    some to be linked with any set of a size as in their bucket: these leave it."""
    known = left.select("key", "node", "n")
    known = known.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")) if roots is not None \
        else known.withColumn("root", F.col("node"))
    known = cut_lineage(_several(known))
    nodes = cut_lineage(known.select("node", "n", "root").distinct())
    top = nodes.groupBy("root").count().orderBy(F.desc("count"), "root").first()
    largest = top["root"] if top else 0
    each = cut_lineage(arrow_map(sets.join(nodes, "node", "left_semi"), shingle_kernel, "node long, shingle long"))
    seldom = cut_lineage(each.groupBy("shingle").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") <= RARE))
    rows = cut_lineage(each.join(seldom, "shingle"))
    some = rows.where("c > 1").join(nodes, "node").select("shingle", *[F.col(c).alias(f"{c}2") for c in ("node", "n", "root")])
    one = some.where(F.col("root2") != largest).toDF("shingle", "node1", "n1", "root1")
    # of two different components, one is not the largest
    pairs = one.join(some, "shingle").where("root1 <> root2 AND (root2 = {0} OR node1 < node2)".format(largest)).select(
        F.col("node1").alias("a"), F.col("node2").alias("b"), F.col("n1").alias("na"), F.col("n2").alias("nb")).distinct()
    sizes = known.groupBy("key").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    fit = known.join(cut_lineage(rows.groupBy("node").agg(F.count(F.lit(1)).alias("rare"))), "node", "left") \
        .withColumn("rare", F.coalesce("rare", F.lit(0))).join(cut_lineage(sizes), "key")
    common = F.col("n") - F.col("rare")
    best = F.greatest("lo", F.least("hi", common))  # the size that comes closest to what is common
    fit = fit.where(_most(F.col("n"), common, best, percent)).select("key", "node", "n", "root", "rare")
    return cut_lineage(_several(fit)), cut_lineage(pairs), largest


def _several(members: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one root."""
    keys = members.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
    return members.join(cut_lineage(keys), "key", "left_semi")


def _links(nodes: DataFrame, rows: DataFrame, k: int, percent: int) -> DataFrame | None:
    """(node, root) of the nodes that are linked with another one, stored; None if there
    are none. ``nodes``: node, rep, n, bands; ``rows``: doc_id, text."""
    with scratch_tables(rows.sparkSession):  # buckets, sets and pairs go when the links are known
        roots = _linked(nodes, rows, k, percent)
        return None if roots is None else cut_lineage(roots, keep=True)


def _linked(nodes: DataFrame, rows: DataFrame, k: int, percent: int) -> DataFrame | None:
    keyed = nodes.select("node", "n", F.explode("bands").alias("key"))
    # a bucket's first pivot is its least node
    shared = cut_lineage(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("node", "n")).alias("p"))
                         .where("c > 1").select("key", F.col("p.node").alias("a"), F.col("p.n").alias("na")))
    left = cut_lineage(keyed.join(shared, "key"))
    members = cut_lineage(left.select(F.col("node").alias("wanted")).distinct()
                          .join(nodes.select(F.col("node").alias("wanted"), "rep", "rep_key"), "wanted"))
    # a node whose rows all lack an id is found by its text
    by_id = rows.where("doc_id IS NOT NULL").join(_few(members.where("rep IS NOT NULL")), F.col("doc_id") == F.col("rep"))
    by_text = rows.where("doc_id IS NULL").join(_few(members.where("rep IS NULL")), F.col("text_key") == F.col("rep_key"))
    texts = by_id.select("wanted", "text").union(by_text.select("wanted", "text"))
    sets = cut_lineage(arrow_map(texts, sets_kernel, "node long, shingles binary", k).dropDuplicates(["node"]))
    roots, last = None, False
    pairs = left.where("node <> a").select("a", F.col("node").alias("b"), "na", F.col("n").alias("nb"))
    while True:
        found = _confirmed(pairs.distinct(), sets, percent)
        new = not found.isEmpty()
        if new:
            roots = cut_lineage(components(found if roots is None else found.union(roots.toDF("a", "b"))))
        if last:
            return roots
        # the pivot has met all others of its bucket
        left, shared_rare, largest = _open(left.where("node <> a"), roots, sets, percent)
        if left.isEmpty() or not new:
            last = True  # what is left meets across components
            one = left.where(F.col("root") != largest).select("key", *[F.col(c).alias(f"{c}1") for c in ("node", "n", "root", "rare")])
            two = left.select("key", *[F.col(c).alias(f"{c}2") for c in ("node", "n", "root", "rare")])
            able = _most(F.col("n1"), F.col("n1") - F.col("rare1"), F.col("n2"), percent) \
                & _most(F.col("n2"), F.col("n2") - F.col("rare2"), F.col("n1"), percent)
            met = one.join(two, (one["key"] == two["key"]) & (F.col("root1") != F.col("root2"))
                           & ((F.col("root2") == largest) | (F.col("node1") < F.col("node2"))) & able).select(
                F.col("node1").alias("a"), F.col("node2").alias("b"), F.col("n1").alias("na"), F.col("n2").alias("nb"))
        else:
            # the next pivot is the member of the fewest rare shingles
            pivot = cut_lineage(left.groupBy("key").agg(F.min(F.struct("rare", "node", "n", "root")).alias("p"))
                                .select("key", F.col("p.node").alias("a"), F.col("p.n").alias("na"), F.col("p.root").alias("ra")))
            left = left.join(pivot, "key")
            met = left.where("root <> ra").select("a", F.col("node").alias("b"), "na", F.col("n").alias("nb"))
        pairs = met.union(shared_rare)


def _text_key(text):
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def _classes(docs: DataFrame, shingle_words: int, percent: int, bands: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: doc_id, text_key, n_shingles, node, group (one of its component's nodes)
    and component_id; without words the last three are null."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                       _text_key(F.col(f"`{text_col}`")).alias("text_key"))
    per = rows_per_band(percent / 100, bands)
    sketches = cut_lineage(arrow_map(rows, sketch_kernel, "doc_id long, text_key binary, n_shingles long, node long, "
                                     "bands array<long>", shingle_words, bands, per))
    nodes = cut_lineage(sketches.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.first("text_key").alias("rep_key"), F.first("n_shingles").alias("n"),
        F.first("bands").alias("bands")))
    roots = _links(nodes, rows, shingle_words, percent)
    of = nodes.select("node", F.col("node").alias("group"), F.col("rep").alias("component_id"))
    if roots is not None:
        least = cut_lineage(roots.join(of, "node").groupBy("root").agg(F.min("component_id").alias("least")))
        linked_nodes = roots.join(least, "root").select("node", "root", "least")
        of = cut_lineage(of.join(linked_nodes, "node", "left").select(
            "node", F.coalesce("root", "group").alias("group"), F.coalesce("least", "component_id").alias("component_id")))
    return sketches.select("doc_id", "text_key", "n_shingles", "node").join(of, "node", "left")


def near_duplicates(docs: DataFrame, shingle_words: int = 3, percent: int = 85, bands: int = BANDS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * intersection >= ``percent`` * union of their
    sets; component_id is the least doc_id reachable. Texts without words (null,
    empty) have no shingles and are linked with nothing. A row without an id takes
    part by its text and has the component of the others; alone it has a null
    component and is kept. Repeated rows are one document. An empty table gives no
    rows. A text is split into shingles whole, however long."""
    return _classes(docs, shingle_words, percent, bands, id_col, text_col).select(
        "doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, shingle_words: int = 5, percent: int = 80, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row of each group of near-duplicates: that of the least id (rows without an id
    come last, rows of one id by their text's digest), all columns as they are.

    It is decided by row, not by id: of two rows of one id with different texts each
    stays or goes with its own group. Of rows that repeat id and text one stays. Rows
    without words (null, empty) all stay; an empty table gives no rows."""
    with_group = cut_lineage(_classes(docs, shingle_words, percent, BANDS, id_col, text_col).where("node IS NOT NULL")
                             .select("doc_id", "text_key", "group"))
    first = with_group.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_key")).alias("m"))
    marked = cut_lineage(with_group.join(first, "group").select(
        "doc_id", "text_key", (F.col("doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("text_key") == F.col("m.text_key"))).alias("stays")))
    key, of_text = free_name(docs.columns, "_id"), free_name(docs.columns, "_text_key")

    def named(rows: DataFrame) -> DataFrame:
        return cut_lineage(rows.select(F.col("doc_id").alias(key), F.col("text_key").alias(of_text)))

    gone = named(marked.where("NOT stays").distinct())
    again = named(marked.where("stays").groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("c")).where("c > 1"))
    keyed = docs.withColumn(f"{key}_row", F.col(f"`{id_col}`").cast("long")).withColumn(f"{of_text}_row", _text_key(F.col(f"`{text_col}`")))
    same = F.col(f"{key}_row").eqNullSafe(F.col(key)) & (F.col(f"{of_text}_row") == F.col(of_text))
    out = keyed.join(_few(gone), same, "left_anti")
    if not again.isEmpty():
        one = out.join(_few(again), same, "left_semi").dropDuplicates([f"{key}_row", f"{of_text}_row"])
        out = out.join(_few(again), same, "left_anti").union(one)
    return out.drop(f"{key}_row", f"{of_text}_row")
