"""Embedding near-dedup: tiles of PCA-ordered vectors, compared leading dimensions first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwater.llm.components import components
from brightwater.session import written

TILE = 1024
ROTATED_WIDTHS = 16
FEW = 0.05
ROUNDING = 1e-12


def _moments(units: DataFrame, width: int) -> np.ndarray:
    """Sum of ``v vᵀ`` over all unit vectors of one width: a part from each partition, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            v = unit_rows(batch.column(0), width)
            total += v.T @ v
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])

    parts = units.select("vector").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    table = parts.toArrow().to_pydict()
    full = np.zeros((width, width))
    full[table["i"], table["j"]] = full[table["j"], table["i"]] = table["v"]
    return full


def unit_rows(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of one width in double precision, scaled to length 1."""
    v = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    v = v / np.abs(v).max(axis=1, keepdims=True) if len(v) else v  # squares neither overflow nor vanish
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def principal_axes(moments: np.ndarray) -> np.ndarray:
    """An orthogonal matrix whose columns are the axes by falling share of the squares."""
    _, axes = np.linalg.eigh(moments)
    return axes[:, ::-1]


def linked_pairs(a: np.ndarray, b: np.ndarray, threshold: float, first: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and b whose product reaches the threshold; rows have length 1.

    Products grow over blocks of leading dimensions that double in size. What the other
    dimensions can add is at most the product of the rows' remaining norms; when no pair
    can reach the threshold the tile is done, and when few can, only those are carried on.
    """
    width = a.shape[1]
    total, at, step = np.zeros((len(a), len(b))), 0, first
    while at < width:
        end = min(at + step, width)
        total += a[:, at:end] @ b[:, at:end].T
        at, step = end, step * 2
        rest_a, rest_b = (np.sqrt((x[:, at:] ** 2).sum(axis=1)) for x in (a, b))
        alive = total + rest_a[:, None] * rest_b[None, :] >= threshold - ROUNDING
        count = int(alive.sum())
        if not count:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        if at < width and count <= FEW * alive.size:
            i, j = np.nonzero(alive)
            sums = total[i, j]
            while at < width and len(i):
                end = min(at + step, width)
                sums = sums + np.einsum("ij,ij->i", a[i, at:end], b[j, at:end])
                at, step = end, step * 2
                rest = np.sqrt((a[i, at:] ** 2).sum(axis=1) * (b[j, at:] ** 2).sum(axis=1))
                keep = sums + rest >= threshold - ROUNDING
                i, j, sums = i[keep], j[keep], sums[keep]
            keep = sums >= threshold
            return i[keep], j[keep]
    return np.nonzero(total >= threshold)


def spanning_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each of n vertices reaches over the edges i-j."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _tiles(nodes: DataFrame, axes: dict[int, np.ndarray]) -> DataFrame:
    """``label, width, tile, tiles, m``: one row for each tile of about ``TILE`` vectors, with node, copies and unit vector.

    Vectors whose width has axes are rotated to them, the others keep their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["label", "width", "tile", "tiles", "node", "copies"]
        for batch in batches:
            vectors, widths = batch.column("vector"), batch.column("width").to_numpy()
            rows = [b""] * len(widths)
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width)
                units = unit_rows(vectors.take(pa.array(at)), width)
                units = units @ axes[width] if width in axes else units
                for k, unit in zip(at, units):
                    rows[k] = unit.tobytes()
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(rows, pa.binary())], names=[*names, "row"])

    sizes = written(nodes.groupBy("label", "width").agg(F.ceil(F.count("*") / TILE).alias("tiles")), "label-sizes")
    placed = nodes.join(sizes, ["label", "width"]).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")))
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}
    schema = f"label {kinds['label']}, width int, tile long, tiles long, node {kinds['node']}, copies long, row binary"
    rotated = placed.select("label", "width", "tile", "tiles", "node", "copies", "vector").mapInArrow(run, schema)
    one = F.struct("node", "copies", "row")
    return rotated.groupBy("label", "width", "tile", "tiles").agg(F.collect_list(one).alias("m"))


def _compared(tiles: DataFrame, threshold: float) -> DataFrame:
    """``node, links, root``: of each tile pair a node's links in it and the first node they lead to."""
    fields = dict(tiles.select("m").schema["m"].dataType.elementType.jsonValue().items())["fields"]
    node_kind = next(f["type"] for f in fields if f["name"] == "node")
    left = tiles.select("label", "width", F.explode(F.sequence("tile", F.col("tiles") - 1)).alias("j"), F.col("tile").alias("i"), "m")
    right = tiles.select("label", "width", F.col("tile").alias("j"), F.explode(F.sequence(F.lit(0).cast("long"), "tile")).alias("i"), "m")

    def unpack(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        m = frame["m"].iloc[0]
        rows = np.frombuffer(b"".join(x["row"] for x in m)).reshape(len(m), -1)
        return np.array([x["node"] for x in m]), np.array([x["copies"] for x in m], dtype=np.int64), rows

    def compare(one: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"node": [], "links": [], "root": []})
        if not len(one) or not len(other):
            return empty
        same = one["i"].iloc[0] == one["j"].iloc[0]
        ids, copies, a = unpack(one)
        other_ids, other_copies, b = (ids, copies, a) if same else unpack(other)
        i, j = linked_pairs(a, b, threshold)
        if same:
            keep = i < j
            i, j = i[keep], j[keep]
        if not len(i):
            return empty
        n = len(ids)
        all_ids = ids if same else np.concatenate([ids, other_ids])
        shift = 0 if same else n
        links = np.bincount(i, weights=other_copies[j], minlength=len(all_ids)) + np.bincount(j + shift, weights=copies[i], minlength=len(all_ids))
        root = spanning_roots(len(all_ids), i, j + shift)
        hit = np.flatnonzero(links)
        return pd.DataFrame({"node": all_ids[hit], "links": links[hit].astype(np.int64), "root": all_ids[root[hit]]})

    keys = ["label", "width", "i", "j"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, f"node {node_kind}, links long, root {node_kind}")


def near_vectors(
    embeddings: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.93,
) -> DataFrame:
    """Links between vectors of one label with a cosine of ``threshold`` (above 0) or more.

    One row per input row: ``id_col, n_links`` (other rows linked directly),
    ``component_id`` (smallest id reachable), ``kept`` (it is its own). Rows
    with a null id, label or vector, an empty or zero vector, or a null or non-finite
    component link with nothing; a row without id has no component and is kept. Vectors of different widths
    have no cosine. Ids are integers; rows that
    repeat an id count as vectors of their own and share a component through equal vectors only.
    Other columns are not read; an empty table gives no rows.

    Equal vectors of a label are one node with a number of copies. Nodes are dealt to tiles of about
    ``TILE`` by a hash; each pair of tiles of a label is one task's work: it returns link counts and,
    in place of the pairs, one edge per node towards the first node that the links lead to. Axes come from the
    sums of squares over all nodes of a width, so leading dimensions decide most pairs; widths beyond the commonest
    ``ROTATED_WIDTHS`` are compared as exactly along the axes they come with.
    """
    vector = F.col(vector_col)
    usable = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (F.size(vector) > 0)
    usable = usable & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(vector, lambda x: x != 0)
    rows = embeddings.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vector.alias("vector"), F.coalesce(usable, F.lit(False)).alias("usable"))
    good = rows.where("usable")
    nodes = good.groupBy("label", "vector").agg(F.min("id").alias("node"), F.count("*").cast("long").alias("copies"))
    nodes = written(nodes.withColumn("width", F.size("vector")), "vectors")
    common = nodes.groupBy("width").count().orderBy(F.desc("count"), "width").limit(ROTATED_WIDTHS).collect()
    axes = {r["width"]: principal_axes(_moments(nodes.where(F.col("width") == r["width"]), r["width"])) for r in common}
    found = _compared(written(_tiles(nodes, axes), "tiles"), threshold)
    found = written(found, "tile-links")
    counts = written(found.groupBy("node").agg(F.sum("links").alias("links")), "link-counts")
    joined = written(components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))), "components")
    of = nodes.join(counts, "node", "left").join(joined.withColumnRenamed("id", "node"), "node", "left")
    of = of.select(
        F.col("label").alias("n_label"),
        F.col("vector").alias("n_vector"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "node").alias("component_id"),
    )
    of = written(of, "vector-links")
    linked = good.join(of, (F.col("label") == F.col("n_label")) & (F.col("vector") == F.col("n_vector")))
    linked = linked.select("id", "n_links", "component_id")
    alone = rows.where("NOT usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    return linked.unionByName(alone).select(F.col("id").alias(id_col), "n_links", "component_id", kept.alias("kept"))
