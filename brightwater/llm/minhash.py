"""MinHash near-dedup: an inverted join of signature coordinates, confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brightwater.llm import text as T
from brightwater.llm.components import components
from brightwater.llm.embeddings import spanning_roots
from brightwater.session import written

BLOCK = 256


def match_threshold(coordinates: int, similarity: float, miss: float) -> int:
    """The most matches to ask for such that a pair of that similarity falls short with probability ``miss`` at most."""
    total, m = 0.0, 0
    while True:
        total += comb(coordinates, m) * similarity**m * (1 - similarity) ** (coordinates - m)
        if total > miss:
            return m
        m += 1


def shingle_sets(raw: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """Of each row the sorted distinct hashes of its word shingles; with fewer words one of them all."""
    starts, ends, first = T.word_spans(raw, bounds)
    words = T.hash_spans(raw, starts, ends)
    grams = T.gram_hashes(words, size)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            out.append(T.gram_hashes(words[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


class MinHash:
    """The least value of each of ``coordinates`` hash functions over a set."""

    def __init__(self, coordinates: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.factors = rng.integers(0, 2**63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shifts = rng.integers(0, 2**63, coordinates, dtype=np.uint64)

    def signatures(self, sets: list[np.ndarray]) -> np.ndarray:
        """A row of tokens for each non-empty set; a token names its coordinate as well as the value."""
        values = np.concatenate(sets)
        starts = np.cumsum([0, *map(len, sets[:-1])])
        out = np.empty((len(sets), len(self.factors)), dtype=np.uint64)
        for c, (factor, shift) in enumerate(zip(self.factors, self.shifts, strict=True)):
            out[:, c] = T.mix(np.minimum.reduceat(values * factor + shift, starts) ^ shift)
        return out


def _long_lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(T.signed(flat)))


def signature_table(documents: DataFrame, id_col: str, text_col: str, size: int, hashes: MinHash) -> DataFrame:
    """``id, n_shingles, f1, f2, sig`` of each row: size, 128-bit fingerprint and signature of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = T.text_bytes(batch.column(1), lower=True)
            for first, last in T.row_slices(bounds):
                sets = shingle_sets(raw[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first], size)
                full = [i for i, s in enumerate(sets) if len(s)]
                sig = [np.zeros(0, dtype=np.uint64)] * len(sets)
                f1, f2 = np.zeros(len(sets), dtype=np.uint64), np.zeros(len(sets), dtype=np.uint64)
                if full:
                    some = [sets[i] for i in full]
                    for i, row in zip(full, hashes.signatures(some), strict=True):
                        sig[i] = row
                    starts, values = np.cumsum([0, *map(len, some[:-1])]), np.concatenate(some)
                    f1[full] = np.add.reduceat(T.mix(values), starts)
                    f2[full] = np.add.reduceat(T.mix(values ^ np.uint64(0x5851F42D4C957F2D)), starts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(list(map(len, sets)), type=pa.int64()), pa.array(T.signed(f1)), pa.array(T.signed(f2)), _long_lists(sig)],
                    names=["id", "n_shingles", "f1", "f2", "sig"],
                )

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, n_shingles long, f1 long, f2 long, sig array<long>"
    )


def _set_table(texts: DataFrame, size: int) -> DataFrame:
    """``node, shingles`` of texts given as ``node, f1, f2, text``; rows of another set are dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = T.text_bytes(batch.column(2), lower=True)
            mark = batch.column(1).to_numpy()
            for first, last in T.row_slices(bounds):
                sets = shingle_sets(raw[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first], size)
                own = [i for i, s in enumerate(sets) if T.signed(np.array([T.mix(s).sum(dtype=np.uint64)]))[0] == mark[first + i]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first).take(pa.array(own, type=pa.int64())), _long_lists([sets[i] for i in own])], names=["node", "shingles"]
                )

    kind = texts.schema["node"].dataType.simpleString()
    return texts.select("node", "f1", "text").mapInArrow(run, f"node {kind}, shingles array<long>")


def _with(pairs: DataFrame, table: DataFrame, value: str) -> DataFrame:
    """Pairs with a value of both sides, as ``x`` and ``y``."""
    one = table.select(F.col("node").alias("a"), F.col(value).alias("x"))
    other = table.select(F.col("node").alias("b"), F.col(value).alias("y"))
    return pairs.join(one, "a").join(other, "b")


def _confirmed(pairs: DataFrame, sigs: DataFrame, sets: DataFrame, threshold: int, percent: int) -> DataFrame:
    """The pairs that share enough coordinates and then enough of their full sets."""
    counted = _with(pairs, sigs, "sig").where(F.size(F.array_intersect("x", "y")) >= threshold).select("a", "b")
    likely = written(counted, "likely-pairs")
    both = F.size(F.array_intersect("x", "y"))
    return _with(likely, sets, "shingles").where(100 * both >= percent * (F.size("x") + F.size("y") - both)).select("a", "b")


def _placed(postings: DataFrame, found: DataFrame | None) -> DataFrame:
    """Postings with each node's component so far, in lists that hold several components."""
    if found is None:
        placed = postings.withColumn("comp", F.col("node"))
    else:
        placed = postings.join(found.withColumnRenamed("id", "node"), "node", "left")
        placed = placed.withColumn("comp", F.coalesce("component_id", "node")).drop("component_id")
    placed = written(placed, "placed")
    mixed = placed.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("token")
    return written(placed.join(written(mixed, "mixed-lists"), "token"), "mixed-postings")


def _joined(found: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components of the links so far, given as components, and new ones."""
    links = links if found is None else links.unionByName(found.select(F.col("id").alias("a"), F.col("component_id").alias("b")))
    return written(components(links), "components")


def _largest(placed: DataFrame, key: str) -> DataFrame:
    """``key, most``: the component with the most nodes in each list or family that has several."""
    counts = placed.groupBy(key, "comp").agg(F.count("*").alias("n"))
    largest = counts.groupBy(key).agg(F.max(F.struct("n", "comp")).alias("m"), F.count("*").alias("k")).where("k > 1")
    return written(largest.select(key, F.col("m.comp").alias("most")), "largest")


def _shared(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of one list with each of another."""
    values = np.concatenate([*one, *other])
    owner = np.repeat(np.arange(len(one) + len(other)), list(map(len, [*one, *other])))
    _, number, count = np.unique(values, return_inverse=True, return_counts=True)
    keep = count[number] > 1  # what one set alone holds is in no intersection
    number, owner = number[keep], owner[keep]
    number = np.unique(number, return_inverse=True)[1]
    total = np.zeros((len(one), len(other)), dtype=np.int64)
    width = int(number.max()) + 1 if len(number) else 0
    for first in range(0, width, 8192):
        here = (number >= first) & (number < first + 8192)
        part = np.zeros((len(one) + len(other), 8192), dtype=np.float32)
        part[owner[here], number[here] - first] = 1
        total += (part[: len(one)] @ part[len(one) :].T).astype(np.int64)
    return total


def _family_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links inside families that join components: ``a, b`` of one spanning forest for each pair of blocks.

    ``members`` has ``family, node, comp``. The nodes outside a family's largest component, its strays, are
    compared with all its nodes, block against block on full sets; a task has two blocks of about
    ``BLOCK`` nodes, and returns one edge per node in place of the pairs. Sets are copied once for each block they meet.
    """
    split = written(members.join(_largest(members, "family"), "family"), "families")
    stray = F.col("comp") != F.col("most")
    sizes = split.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.ceil(F.count_if(stray) / BLOCK).alias("stray_blocks"))
    split = split.join(written(sizes, "family-sizes"), "family").join(sets, "node")
    columns = ["family", "node", "comp", "shingles"]

    def block(count: str):
        return F.pmod(F.xxhash64("node"), F.col(count))

    def every(count: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    left = split.where(stray).select(*columns, block("stray_blocks").alias("i"), every("blocks").alias("j"))
    right = split.select(*columns, block("blocks").alias("j"), every("stray_blocks").alias("i")).toDF(*columns, "j", "i")  # columns of its own
    kind = members.schema["node"].dataType.simpleString()

    def compare(one: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(one) and len(other):
            a, b = list(one["shingles"]), list(other["shingles"])
            both = _shared(a, b)
            sizes_a, sizes_b = (np.array(list(map(len, x)), dtype=np.int64) for x in (a, b))
            near = 100 * both >= percent * (sizes_a[:, None] + sizes_b[None, :] - both)
            near &= one["comp"].to_numpy()[:, None] != other["comp"].to_numpy()[None, :]
            i, j = np.nonzero(near)
            root = spanning_roots(len(a) + len(b), i, j + len(a))
            names = [*one["node"], *other["node"]]
            found = [(names[k], names[root[k]]) for k in np.flatnonzero(root != np.arange(len(root)))]
        return pd.DataFrame(found, columns=["a", "b"])

    keys = ["family", "i", "j"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, f"a {kind}, b {kind}")


def _ordered(one: str, other: str) -> list:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def _linked(postings: DataFrame, sigs: DataFrame, sets: DataFrame, threshold: int, percent: int) -> DataFrame:
    """Components of the nodes (``id, component_id``), from their postings (``node, token, weight``)."""
    # The node whose tokens are the most common is the likeliest centre of its lists.
    placed = _placed(postings, None)
    best = F.max(F.struct("weight", F.xxhash64("node").alias("h"), F.col("node").alias("hub")))
    hubs = written(placed.groupBy("token").agg(best.alias("m")).select("token", "m.hub"), "hubs")
    pairs = placed.join(hubs, "token").where("node <> hub").select(*_ordered("node", "hub")).distinct()
    found = _joined(None, _confirmed(written(pairs, "hub-pairs"), sigs, sets, threshold, percent))
    placed = _placed(postings, found)
    if placed.isEmpty():
        return found
    # Lists with one hub are one family; a node is in the family of each of its lists.
    members = placed.join(hubs, "token").select(F.col("hub").alias("family"), "node", "comp").distinct()
    return _joined(found, _family_links(written(members, "members"), sets, percent))


def near_components(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 80,
    coordinates: int = 64,
    miss: float = 1e-5,
) -> DataFrame:
    """Components of texts whose shingle sets have a Jaccard similarity of ``percent``/100 or more.

    One row per input row: ``id_col, n_shingles, component_id, kept``. Texts
    are lower-cased (A-Z) and taken whole; a text of fewer than ``size`` words is
    one shingle, one without words has none and is linked with nothing. The
    component is named by its smallest id; that row is kept. Rows that repeat an id are one
    document with several texts. A row without id is linked with nothing, has no
    component and is kept. Other columns are not read; an empty table gives no rows.

    Texts with equal sets are one node. Each node posts its signature's
    tokens (coordinate and value). A pair must match in ``match_threshold``
    coordinates, so it meets in the prefix: tokens that nobody shares count
    first, then the rarest, and a node with fewer shared tokens than the threshold posts nothing.
    In each list nodes first meet its hub, the node with the most common tokens; links join them to
    components, and only pairs of different components need be looked at, then all of them: the lists of
    one hub form a family, whose nodes are compared block against block on full sets. Pairs of nodes other than with
    a hub are never rows. A hub pair's collisions are counted on the signatures, and it is confirmed on
    the full sets. Links within a component are not listed; none that joins two components is lost, but for the
    signature's error: a pair exactly at the threshold is overlooked with probability ``miss`` at most.
    """
    threshold = match_threshold(coordinates, percent / 100, miss)
    hashes = MinHash(coordinates)
    table = written(signature_table(documents, id_col, text_col, size, hashes), "signatures")
    key = ["n_shingles", "f1", "f2"]
    nodes = written(table.where("n_shingles > 0 AND id IS NOT NULL").groupBy(*key).agg(F.min("id").alias("node")), "nodes")
    # Two sets of one id are one node with two rows here.
    firsts = table.join(nodes.select(F.col("node").alias("id"), *key), ["id", *key]).dropDuplicates(["id", *key])
    firsts = written(firsts.select("id", "sig"), "node-signatures")
    tokens = firsts.select(F.col("id").alias("node"), F.explode("sig").alias("token"))
    shared = written(tokens.groupBy("token").agg(F.count("*").alias("c")).where("c > 1"), "shared-tokens")
    by_node = Window.partitionBy("node")
    ranked = tokens.join(shared, "token").withColumns(
        {
            "rank": F.row_number().over(by_node.orderBy("c", "token")),
            "s": F.count("*").over(by_node),
            "weight": F.sum("c").over(by_node),
        }
    )
    postings = written(ranked.where(F.col("rank") <= F.col("s") - threshold + 1).select("node", "token", "weight"), "postings")
    active = written(postings.select("node").distinct(), "active")
    sigs = written(firsts.join(active, F.col("id") == F.col("node")).select("node", "sig"), "active-signatures")
    wanted = active.join(nodes, "node").select("node", "f1", "f2")
    texts = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sets = written(_set_table(texts.join(wanted, F.col("id") == F.col("node")), size), "sets")

    found = _linked(postings, sigs, sets, threshold, percent)
    found = _joined(found, _repeats(table, nodes)).withColumnRenamed("id", "node")  # several sets of one id are one node
    known = table.join(nodes, key, "left").select("id", "n_shingles", "node").join(found, "node", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "node", "id"))
    return known.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept")
    )


def _repeats(table: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links between the nodes of an id's several sets."""
    key = ["n_shingles", "f1", "f2"]
    ids = table.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 AND id IS NOT NULL").select("id")
    own = table.select("id", *key).join(ids, "id").join(nodes, key)
    return own.select(F.col("id").alias("a"), F.col("node").alias("b")).where("a <> b")
