"""Merkle manifest: leaves appended to aligned blocks in a stream, with witnesses that grow as siblings complete."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightwater.session import written

ARITY = 16
BLOCK_LEVELS = 2
STEP = "struct<left:string,right:string>"
_ROW_BITS = 33  # of monotonically_increasing_id; the partition stands above


def digest_of(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Witnesses:
    """One aligned block while nodes are appended to it, left to right.

    ``open`` holds at each level the finished subtrees that still wait for siblings. A run of
    ``arity`` nodes shares one partial witness, kept in ``paths``; whenever a subtree's
    last sibling completes, the witnesses of all runs below it are extended by one step
    (the digests left and right of it).
    """

    def __init__(self, arity: int, levels: int):
        self.arity, self.levels = arity, levels
        self.open: list[list[tuple[str, range]]] = [[] for _ in range(levels + 1)]
        self.seen = [0] * (levels + 1)
        self.paths: list[list[tuple[str, str]]] = []

    def append(self, digest: str, level: int = 0, runs: range = range(0)) -> None:
        self.open[level].append((digest, runs))
        self.seen[level] += 1
        if level < self.levels and len(self.open[level]) == self.arity:
            self._complete(level)

    def _complete(self, level: int) -> None:
        group, self.open[level] = self.open[level], []
        digests = [d for d, _ in group]
        if level == 0:
            runs = range(len(self.paths), len(self.paths) + 1)
            self.paths.append([])
        else:
            runs = range(group[0][1].start, group[-1][1].stop)
            for i, (_, below) in enumerate(group):
                step = ("".join(digests[:i]), "".join(digests[i + 1 :]))
                for run in below:
                    self.paths[run].append(step)
        self.append(digest_of(digests), level + 1, runs)

    def finish(self, whole: bool) -> str:
        """The block's root. A block that is a whole tree ends where one node is left, another at its full height."""
        for level in range(self.levels):
            if whole and self.seen[level] == 1:
                return self.open[level][0][0]
            if self.open[level]:
                self._complete(level)
        return self.open[self.levels][0][0]


def _append(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """Blocks of ``nodes`` (``tree, pos, size, digest, item``): a row for each run of siblings.

    ``size`` is the number of nodes in the tree. A run has its nodes' digests and items,
    its witness up to the block's root, and that root.
    """
    span = arity**levels
    kind = nodes.schema["item"].dataType.simpleString()
    placed = nodes.withColumn("block", F.expr(f"pos div {span}")).select("tree", "block", "pos", "size", "digest", "item")
    placed = placed.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")

    def block_runs(part: pa.Table) -> pa.RecordBatch:
        tree, block, size = (part.column(i)[0].as_py() for i in (0, 1, 3))
        digests = part.column(4).to_pylist()
        witnesses = Witnesses(arity, levels)
        for digest in digests:
            witnesses.append(digest)
        root = witnesses.finish(size <= span)
        paths = witnesses.paths or [[]]
        cuts = pa.array([*range(0, len(digests), arity), len(digests)], type=pa.int32())
        steps = list(chain.from_iterable(paths))
        ends = [0]
        for path in paths:
            ends.append(ends[-1] + len(path))
        step_array = pa.StructArray.from_arrays(
            [pa.array([s[0] for s in steps], type=pa.string()), pa.array([s[1] for s in steps], type=pa.string())], names=["left", "right"]
        )
        n = len(paths)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([tree] * n, type=pa.string()),
                pa.array([block] * n, type=pa.int64()),
                pa.array(range(n), type=pa.int32()),
                pa.array([size] * n, type=pa.int64()),
                pa.array([size > 1] * n),
                pa.ListArray.from_arrays(cuts, pa.array(digests, type=pa.string())),
                pa.ListArray.from_arrays(cuts, part.column(5).combine_chunks()),
                pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), step_array),
                pa.array([root] * n, type=pa.string()),
            ],
            names=["tree", "block", "run", "size", "closed", "digests", "items", "path", "root"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            keys = list(zip(table.column(0).to_pylist(), table.column(1).to_pylist(), strict=True))
            first = 0
            for i in range(1, len(keys)):
                if keys[i] != keys[i - 1]:
                    yield block_runs(table.slice(first, i - first))
                    first = i
            rest = table.slice(first)
        if rest is not None:
            yield block_runs(rest)

    return placed.mapInArrow(
        run,
        "tree string, block long, run int, size long, closed boolean, digests array<string>, "
        f"items array<{kind}>, path array<{STEP}>, root string",
    )


def _grown(nodes: DataFrame, arity: int, levels: int) -> list[DataFrame]:
    """Run tables, lowest first: block roots of trees that have several are appended as nodes of the next."""
    span, layers = arity**levels, []
    while True:
        runs = written(_append(nodes, arity, levels), "runs")
        layers.append(runs)
        nodes = runs.where(f"run = 0 AND size > {span}").select(
            "tree", F.col("block").alias("pos"), F.expr(f"(size + {span - 1}) div {span}").alias("size"), F.col("root").alias("digest"), F.col("block").alias("item")
        )
        if nodes.isEmpty():
            return layers


def _ended(runs: DataFrame, span: int) -> DataFrame:
    """Trees whose root this layer holds: ``tree, root``."""
    return runs.where(f"run = 0 AND size <= {span}").select("tree", "root")


def _witnessed(runs: DataFrame, above: DataFrame, arity: int, levels: int) -> DataFrame:
    """Every node of a layer with its whole witness, given those of the blocks: ``tree, pos, digest, item, steps, subroot``."""
    above = above.select(F.col("tree").alias("t"), F.col("block").alias("b"), F.col("steps").alias("upper"), "subroot")
    met = runs.join(above, (F.col("tree") == F.col("t")) & (F.col("block") == F.col("b")))
    nodes = met.select("*", F.posexplode(F.arrays_zip("digests", "items")).alias("i", "node"))
    own = F.struct(
        F.array_join(F.slice("digests", F.lit(1), F.col("i")), "").alias("left"),
        F.array_join(F.slice("digests", F.col("i") + 2, F.lit(arity)), "").alias("right"),
    )
    own = F.when(F.col("closed"), F.array(own)).otherwise(F.array().cast(f"array<{STEP}>"))
    return nodes.select(
        "tree",
        (F.col("block") * arity**levels + F.col("run") * arity + F.col("i")).alias("pos"),
        F.col("node.digests").alias("digest"),
        F.col("node.items").alias("item"),
        F.concat(own, "path", "upper").alias("steps"),
        "subroot",
    )


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows of ``tree, ...`` with ``pos`` (from 0, by ``order`` within the tree) and ``size``.

    The rows are ranged on tree and order, and number themselves within the range; ranges are counted, and
    a window over those counts (a row for each tree and range) says where each begins. No tree is gathered.
    """
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    ranged = written(ranged.withColumn("at", F.monotonically_increasing_id()), "ordered").withColumn("part", F.shiftright("at", _ROW_BITS))
    counts = written(ranged.groupBy("tree", "part").agg(F.count("*").alias("n"), F.min("at").alias("lo")), "ranges")
    by_tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(by_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(F.col("tree").alias("t"), F.col("part").alias("p"), (before - F.col("lo")).alias("shift"), F.sum("n").over(by_tree).alias("size"))
    starts = written(starts, "starts")
    met = ranged.join(starts, (F.col("tree") == F.col("t")) & (F.col("part") == F.col("p")))
    return met.withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "t", "p", "shift")


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 of the values: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def folded(digest: Column, steps: Column) -> Column:
    """The root that a leaf digest and its witness give."""
    return F.aggregate(steps, digest, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def proof_digest(steps: Column) -> Column:
    """SHA-256 of all siblings of a witness, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(
    documents: DataFrame,
    fields: list[str],
    id_col: str = "doc_id",
    tree_col: str = "source",
    carry: dict[str, Column] | None = None,
    arity: int = ARITY,
    levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """Each row's place in a two-storey Merkle tree, with its witness.

    One row per input row: ``id_col, leaf, subroot, root, steps`` and the columns of
    ``carry``, which are computed from the row beside its leaf. ``steps`` lists, from the leaf up, the digests ``left``
    and ``right`` of the node at each level. Leaves of one ``tree_col`` ascend by id (a null id first, rows that
    repeat an id by their digest); every ``arity`` consecutive nodes become one until one is left,
    a lone leaf itself. Those subroots, by tree (null first, then bytewise), make
    the root likewise. A null field is ``-``, an empty text ``0:``. An empty table gives no rows;
    other columns are not read.

    Texts are read once, and only their digests move. Aligned blocks of ``arity ** levels`` nodes are appended in
    sorted streams by separate tasks; the block roots are nodes of the next round, so a tree of n leaves takes
    log(n) rounds, and no source meets in one task. Witnesses are kept once for each run of
    siblings and extended downwards by joins on the block.
    """
    span = arity**levels
    key = F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit(""))
    extra = {name: value for name, value in (carry or {}).items()}
    leaves = documents.select(
        key.alias("tree"),
        F.col(id_col).alias("id"),
        leaf_digest([F.col(f) for f in fields]).alias("digest"),
        F.struct(F.col(id_col).alias("id"), *(v.alias(f"c_{n}") for n, v in extra.items())).alias("item"),
    )
    leaves = written(leaves, "leaves")
    layers = _grown(numbered(leaves, ["id", "digest"]).drop("id"), arity, levels)
    subroots = _ended(layers[0], span)
    for runs in layers[1:]:
        subroots = subroots.unionByName(_ended(runs, span))
    top = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("root").alias("digest"), F.col("tree").alias("item"))
    upper = _grown(numbered(written(top, "subroots"), ["key"]).drop("key"), arity, levels)

    none = F.array().cast(f"array<{STEP}>")
    crown = _ended(upper[-1], span).select("root")
    above = _ended(upper[-1], span).select("tree", F.lit(0).cast("long").alias("block"), none.alias("steps"), F.lit("").alias("subroot"))
    for runs in reversed(upper):
        nodes = _witnessed(runs, above, arity, levels)
        above = nodes.select("tree", F.col("pos").alias("block"), "steps", "subroot")
    tops = written(nodes.select(F.col("item").alias("tree"), F.lit(0).cast("long").alias("block"), "steps", F.col("digest").alias("subroot")), "tops")

    above = None
    for runs in reversed(layers):
        here = tops.join(_ended(runs, span).select("tree"), "tree", "left_semi")
        above = written(here if above is None else here.unionByName(above), "witnesses")
        nodes = _witnessed(runs, above, arity, levels)
        above = nodes.select("tree", F.col("pos").alias("block"), "steps", "subroot")
    found = crown.first()
    root = F.lit(found["root"] if found else None).cast("string")
    return nodes.select(
        F.col("item.id").alias(id_col), F.col("digest").alias("leaf"), "subroot", root.alias("root"), "steps", *(F.col(f"item.c_{n}").alias(n) for n in extra)
    )
