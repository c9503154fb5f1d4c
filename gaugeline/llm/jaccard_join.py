"""Self-join of documents on the Jaccard similarity of their word n-grams: a MinHash LSH forest, then exact counts."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import U, chunks, grams, mix, signed, words
from .components import components
from .shared import materialize, repeats_ids, with_keys

#: Trees of the forest, minima of a signature in each, and bytes that are kept of a minimum.
TREES, DEPTH, WIDTH = 32, 8, 2
#: How many levels above the depth that would do for all trees one tree's prefixes may end.
HIGHER = 2
#: Classes and shingles that are compared with one another in one block.
BLOCK, BLOCK_SHINGLES = 1_000, 1_000_000


def prefix_depth(threshold: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which a pair at the threshold meets in some tree with probability ``recall``.

    A prefix of d minima agrees with probability s^d; prefixes are shortened from the full depth until the
    chance over all trees is enough.
    """
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < recall:
        depth -= 1
    return depth


def plan_prefixes(pairs: dict[tuple[int, int], int], threshold: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> list[int]:
    """The length of the prefixes that match in each tree, from ``pairs``: candidates by tree and length.

    All trees begin at the full depth. The prefixes of one tree at a time are shortened by one, where a candidate more adds
    the most recall, until a pair at the threshold meets in some tree with probability ``recall``. Trees in which frequent passages
    gather many sets keep long prefixes.
    """
    def miss(d: int) -> float:
        return math.log1p(-(threshold ** d)) if threshold < 1 else -math.inf

    least = max(1, prefix_depth(threshold, recall, trees, depth) - HIGHER)
    depths = [depth] * trees
    while recall < 1 and sum(miss(d) for d in depths) > math.log1p(-recall) and max(depths) > least:
        def gain(t: int) -> float:
            d = depths[t]
            return (miss(d) - miss(d - 1)) / (1 + pairs.get((t, d - 1), 0) - pairs.get((t, d), 0))
        tree = max((t for t in range(trees) if depths[t] > least), key=gain)
        depths[tree] -= 1
    return depths if recall < 1 else [least] * trees


def shingle_sets(data: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text and their numbers; a text of fewer words has one shingle of all."""
    found = words(data, lengths)
    counts = found.per_doc(len(lengths))
    begins = np.concatenate(([0], np.cumsum(counts)))
    few = np.flatnonzero((counts > 0) & (counts < n))
    at = np.arange(len(found.hash))
    full = np.flatnonzero(at + n <= begins[found.doc + 1])
    long = grams(found.hash, n)[full] if len(full) else np.zeros(0, U)
    # The k-th last word of a short text tells how many words it has.
    short = [mix(np.bitwise_xor.reduce(mix(found.hash[begins[d]:begins[d + 1]] * U(2 * 7919 + 1) + np.arange(counts[d], dtype=U)))[None] + U(counts[d]))[0] for d in few]
    hashes = np.concatenate((long, np.array(short, U)))
    doc = np.concatenate((found.doc[full], few))
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[new], np.bincount(doc[new], minlength=len(lengths))


def sketch(hashes: np.ndarray, counts: np.ndarray, trees: int, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of each set, and its signatures: for each tree the leading bits of ``depth`` mixed minima (sets x trees x depth)."""
    rows = np.flatnonzero(counts)
    starts = (np.cumsum(counts) - counts)[rows]
    one, two = np.zeros(len(counts), U), np.zeros(len(counts), U)
    signatures = np.zeros((len(counts), trees * depth), f">u{WIDTH}")
    if len(rows):
        one[rows] = mix(np.add.reduceat(mix(hashes), starts) + counts[rows].astype(U))
        two[rows] = mix(np.add.reduceat(mix(hashes ^ U(0x5BD1E995)), starts))
        factors = mix(np.arange(1, trees * depth + 1, dtype=U) * U(0xC2B2AE3D27D4EB4F)) | U(1)
        for i, factor in enumerate(factors):
            signatures[rows, i] = mix(np.minimum.reduceat(hashes * factor, starts)) >> U(64 - 8 * WIDTH)
    return one, two, signatures


def count_links(hashes: np.ndarray, counts: np.ndarray, side: np.ndarray, threshold: float,
                met: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Of sets: how many others are at least ``threshold`` similar, and the least set (by place) linked through such pairs.

    ``side`` is 0 or 1; if both occur, only pairs of different sides count. ``met``, a matrix, tells which pairs count at all. Common shingles are
    counted exactly as products of 0/1 matrices, some thousand shingles at a time; single ones are left out.
    """
    n = len(counts)
    owner = np.repeat(np.arange(n), counts)
    order = np.argsort(hashes, kind="stable")
    ordered, owner = hashes[order], owner[order]
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    owner, column = owner[shared], np.cumsum(new[shared]) - 1
    both = np.zeros((n, n), np.float32)
    step = max(1, 4_000_000 // max(n, 1))
    edges = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + step, step))
    for low, high in zip(edges[:-1], edges[1:]):
        if high > low:
            part = np.zeros((n, column[high - 1] - column[low] + 1), np.float32)
            part[owner[low:high], column[low:high] - column[low]] = 1
            both += part @ part.T
    union = counts[:, None] + counts[None, :] - both
    similar = (both >= threshold * union - 1e-6) & (union > 0)
    np.fill_diagonal(similar, False)
    if side.any() and not side.all():
        similar &= side[:, None] != side[None, :]
    if met is not None:
        similar &= met
    root = np.arange(n)
    while True:
        least = np.where(similar, root[None, :], n).min(axis=1, initial=n)
        now = np.minimum(root, least)
        now = now[now]
        if (now == root).all():
            return similar.sum(axis=1), root
        root = now


def near_duplicates(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, class_id, n_links, group_id``.

    A class is the documents with the same set of ``n``-word shingles, named by its least id. ``n_links`` is the number of
    other classes whose sets have a Jaccard similarity of at least ``threshold``, ``group_id`` the least id that is reached
    over such links.

    Each class has a signature of minima in each tree of a forest; classes with a common prefix share a node of that tree's trie.
    Candidate pairs are counted by tree and length of prefix, and the prefixes are shortened, tree by tree and where it costs least, until a pair
    at the ``threshold`` meets with probability ``recall`` (``plan_prefixes``). Classes that meet in a node are tied to the least of them, not
    pair by pair; the connected sets of ties hold all candidate pairs. Pairs are counted exactly: all those of a set, in blocks
    if it is large, unless its nodes have fewer pairs than that. Then those of each node are, in blocks if it is
    large, and a pair that shares several nodes counts in the first. Only counts and one tie per class leave a block.

    A text of fewer than ``n`` words has one shingle; null, empty and blank texts have none, are one class and link to nothing.
    Rows equal in id and text are one document and get the same result; null ids come first. An empty table gives an empty result.
    """
    keyed, restore = with_keys(docs, id_col, text_col)
    return restore(_near_duplicates(keyed, n, threshold, recall), "class_id", "group_id").select(id_col, "class_id", "n_links", "group_id")


def first_copies(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are the first of their group, with all columns.

    Of rows equal in id and text one stays. With null or repeated ids, rows are found again by id and a hash of the text.
    """
    keyed, restore = with_keys(docs, id_col, text_col)
    first = _near_duplicates(keyed, n, threshold, recall).filter("key = group_id").select("key")
    if not repeats_ids(docs, id_col):
        return docs.join(restore(first), id_col, "left_semi")
    texts = restore(keyed.join(first, "key", "left_semi")).dropDuplicates([id_col, "text"]).select(
        F.col(id_col).alias("_id"), F.xxhash64("text").alias("_hash"))
    found = docs.dropDuplicates([id_col, text_col])
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.xxhash64(F.col(text_col)) == F.col("_hash"))
    return found.join(texts, same, "left_semi")


def _near_duplicates(keyed: DataFrame, n: int, threshold: float, recall: float) -> DataFrame:
    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, lengths in chunks(batch.column(1)):
                hashes, counts = shingle_sets(data, lengths, n)
                one, two, signatures = sketch(hashes, counts, TREES, DEPTH)
                offsets = np.arange(end - row + 1, dtype=np.int32) * (TREES * DEPTH * WIDTH)
                values = pa.Array.from_buffers(pa.binary(), end - row, [None, pa.py_buffer(offsets), pa.py_buffer(signatures.tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), pa.array(signed(one)), pa.array(signed(two)),
                                                  pa.array(counts, pa.int32()), values], ["key", "one", "two", "size", "signatures"])

    sketched = materialize(keyed.mapInArrow(sketches, "key long, one long, two long, size int, signatures binary"), "sketches")
    classes = materialize(sketched.groupBy("one", "two").agg(F.min("key").alias("class_id"), F.first("size").alias("size"),
                                                            F.first("signatures").alias("signatures")), "classes")
    shared = _shared_nodes(classes, threshold, recall)
    sets = materialize(components(shared.filter("class_id <> hub"), "class_id", "hub").withColumnRenamed("node", "class_id"), "sets")

    def blocks(rows: str, shingles: str) -> Column:
        return F.greatest(F.ceil(F.col(rows) / BLOCK), F.ceil(F.col(shingles) / BLOCK_SHINGLES)).cast("int")

    members = sets.join(classes.select("class_id", "size"), "class_id").groupBy("root").agg(F.count("*").alias("n"), F.sum("size").alias("shingles"))
    inside = shared.filter("class_id = hub").join(sets, "class_id").groupBy("root").agg(F.sum(F.col("n") * F.col("n")).alias("pairs"))
    sizes = materialize(members.join(inside, "root").select("root", blocks("n", "shingles").alias("blocks"),
                                                            (F.col("pairs") < F.col("n") * F.col("n")).alias("fewer")), "sizes")
    large = F.col("fewer") & (F.col("blocks") > 1)
    placed = sets.join(sizes.filter(~large), "root").select(
        "root", F.lit(-1).alias("tree"), F.col("class_id").alias("key"), "blocks", F.lit(None).cast("array<long>").alias("nodes"))
    if sizes.filter(large).limit(1).count():
        own = shared.join(sets.join(sizes.filter(large).select("root"), "root", "left_semi").select("class_id"), "class_id", "left_semi")
        listed = own.groupBy("class_id").agg(F.array_sort(F.collect_list(F.struct("tree", "node")))["node"].alias("nodes"))
        placed = placed.unionAll(own.join(listed, "class_id").select(
            F.col("node").alias("root"), "tree", F.col("class_id").alias("key"), blocks("n", "shingles").alias("blocks"), "nodes"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    texts = keyed.join(placed.hint("shuffle_hash"), "key")
    # Block pairs (i, j), i <= j: each class goes to all pairs with its block.
    pairs = texts.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pairs = pairs.select("root", "tree", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "key", "text", "blocks",
                         (F.col("block") > F.col("other")).cast("int").alias("side"), "nodes")
    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.repartition(parts, "root", "tree", "i", "j").sortWithinPartitions("root", "tree", "i", "j", "key")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            ids = np.stack([batch.column(c).to_numpy() for c in range(4)])
            cuts = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1
            if held and tuple(ids[:, 0]) != tuple(held[-1].column(c)[-1].as_py() for c in range(4)):
                yield _verified(held, n, threshold)
                held = []
            low = 0
            for cut in [*cuts, batch.num_rows]:
                held.append(batch.slice(low, cut - low))
                if cut < batch.num_rows:
                    yield _verified(held, n, threshold)
                    held = []
                low = cut
        if held:
            yield _verified(held, n, threshold)

    verified = materialize(dealt.mapInArrow(verify, "key long, links long, root long, whole boolean"), "verified")
    whole = verified.filter("whole").select("key", "links", F.col("root").alias("group_id"))
    counted = verified.filter("NOT whole").groupBy("key").agg(F.sum("links").alias("links"))
    if verified.filter("NOT whole").limit(1).count():
        joined = components(verified.filter("NOT whole"), "key", "root")
        whole = whole.unionAll(counted.join(joined.withColumnRenamed("node", "key"), "key", "left")
                               .select("key", "links", F.coalesce("root", "key").alias("group_id")))
    links = classes.select("one", "two", "class_id").join(whole.withColumnRenamed("key", "class_id"), "class_id", "left")
    return sketched.select("key", "one", "two").join(links, ["one", "two"]).select(
        "key", "class_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("group_id", "class_id").alias("group_id"))


def _shared_nodes(classes: DataFrame, threshold: float, recall: float) -> DataFrame:
    """``class_id, tree, node, hub, n, shingles``: each class in each node that it shares, with the node's least class, number and size of classes."""
    step, least = DEPTH * WIDTH, max(1, prefix_depth(threshold, recall) - HIGHER)
    paths = classes.filter("size > 0").select("class_id", "size", "signatures", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    paths = paths.select("class_id", "size", "tree", F.expr(f"substring(signatures, tree * {step} + 1, {step})").alias("path"))
    top = F.xxhash64("tree", F.expr(f"substring(path, 1, {least * WIDTH})"))  # the highest nodes that prefixes may end at
    tops = paths.groupBy(top.alias("top")).count().filter("count > 1").select("top")
    met = materialize(paths.withColumn("top", top).join(tops, "top", "left_semi").drop("top"), "paths")

    levels = met.select("tree", "path", F.explode(F.sequence(F.lit(least), F.lit(DEPTH))).alias("depth"))
    counts = levels.groupBy("tree", "depth", F.expr(f"substring(path, 1, depth * {WIDTH})").alias("prefix")).count()
    found = counts.groupBy("tree", "depth").agg(F.sum(F.expr("count * (count - 1) div 2")).alias("pairs")).collect()  # a row per tree and length
    depths = plan_prefixes({(r.tree, r.depth): r.pairs for r in found}, threshold, recall)

    bytes_of = F.element_at(F.array(*(F.lit(d * WIDTH) for d in depths)), F.col("tree") + 1)
    nodes = met.select("class_id", "size", "tree", F.xxhash64("tree", F.substring("path", F.lit(1), bytes_of)).alias("node"))
    hubs = nodes.groupBy("node").agg(F.min("class_id").alias("hub"), F.count("*").alias("n"), F.sum("size").alias("shingles")).filter("n > 1")
    return materialize(nodes.drop("size").join(hubs, "node"), "nodes")


def meet_here(nodes: pa.Array, here: int) -> np.ndarray:
    """Which pairs of lists have ``here`` as their first common entry (rows x rows); entries are in one order in all lists."""
    rows = np.repeat(np.arange(len(nodes)), np.asarray(nodes.value_lengths()))
    values = nodes.flatten().to_numpy()
    first = np.searchsorted(rows, np.arange(len(nodes)))
    places = np.arange(len(values)) - first[rows]
    stop = np.full(len(nodes), 0)
    stop[rows[values == here]] = places[values == here]
    out = np.ones((len(nodes), len(nodes)), bool)
    before = places < stop[rows]
    for value in np.unique(values[before]):
        those = rows[before & (values == value)]
        if len(those) > 1:
            out[np.ix_(those, those)] = False
    return out


def _verified(held: list[pa.RecordBatch], n: int, threshold: float) -> pa.RecordBatch:
    """The links inside one block, or between the two blocks of a pair; of a node, those of pairs that share none before it."""
    table = pa.Table.from_batches(held).combine_chunks()
    key, side = table.column("key").to_numpy(), table.column("side").to_numpy()
    root, tree, i, j = (table.column(c)[0].as_py() for c in ("root", "tree", "i", "j"))
    links, least = np.zeros(len(key), np.int64), np.arange(len(key))
    if i == j or (side.any() and not side.all()):  # else the other block is empty
        met = None if tree < 0 else meet_here(table.column("nodes").combine_chunks(), root)
        if met is not None:
            np.fill_diagonal(met, False)
        if met is None or met.any():
            sets = [shingle_sets(data, lengths, n) for _, _, data, lengths in chunks(table.column("text"))]
            links, least = count_links(np.concatenate([s[0] for s in sets]), np.concatenate([s[1] for s in sets]), side, threshold, met)
    first = np.full(len(key), np.iinfo(np.int64).max)
    np.minimum.at(first, least, key)
    whole = np.full(len(key), tree < 0 and table.column("blocks")[0].as_py() == 1)
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(links, pa.int64()), pa.array(first[least]), pa.array(whole)], ["key", "links", "root", "whole"])
