"""Quality classifier: random Fourier features, ridge by normal equations, isotonic calibration."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwater.llm import text as T
from brightwater.session import written

# Byte classes whose shares describe a text.
CLASSES = ["lower", "upper", "digit", "space", "newline", "stop", "comma", "mark", "symbol", "bar", "other"]
STATISTICS = [
    *(f"share_{c}" for c in CLASSES),
    "log_words",
    "word_length",
    "long_words",
    "distinct_words",
    "distinct_lines",
    "line_length",
    "upper_starts",
    "symbol_ends",
]
BLOCK_WORDS = 512

# Bytes counted and rows scored at once: they bound a task's memory, not what is read.
COUNTED_BYTES = 1 << 18
SCORED_ROWS = 1024


def _classes() -> np.ndarray:
    table = np.full(256, CLASSES.index("symbol"), dtype=np.int64)
    table[128:] = CLASSES.index("other")
    for name, chars in {
        "lower": "abcdefghijklmnopqrstuvwxyz",
        "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "digit": "0123456789",
        "space": " \t\v\f\r",
        "newline": "\n",
        "stop": ".",
        "comma": ",;:'\"()-",
        "mark": "!?",
        "bar": "|<>{}[]",
    }.items():
        table[[ord(c) for c in chars]] = CLASSES.index(name)
    table[:9] = table[14:32] = table[127] = CLASSES.index("symbol")
    return table


_CLASS = _classes()


def _distinct(owner: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """How many different values each owner has."""
    if not len(value):
        return np.zeros(n)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return np.bincount(owner[new], minlength=n).astype(float)


def _sums(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Counts that add up over the pieces of a text, a row for each piece."""
    rows, k = len(bounds) - 1, len(CLASSES)
    owner = np.repeat(np.arange(rows), np.diff(bounds))
    shares = np.bincount(owner * k + _CLASS[raw], minlength=rows * k).reshape(rows, k).astype(float)
    starts, ends, first = T.word_spans(raw, bounds)
    words = np.diff(first).astype(float)
    of = np.repeat(np.arange(rows), np.diff(first))
    block = of * 4096 + np.minimum((np.arange(len(of)) - first[of]) // BLOCK_WORDS, 4095)
    block = np.unique(block, return_inverse=True)[1] if len(of) else block
    different = _distinct(block, T.hash_spans(raw, starts, ends), int(block.max()) + 1 if len(block) else 0)
    owner_of_block = np.zeros(len(different), dtype=np.int64)
    owner_of_block[block] = of
    lengths = ends - starts
    head, tail = _CLASS[raw[starts]], _CLASS[raw[ends - 1]] if len(ends) else np.zeros(0, dtype=np.int64)
    odd = (CLASSES.index("symbol"), CLASSES.index("mark"), CLASSES.index("bar"))
    breaks = np.flatnonzero(raw == 10)
    edges = np.union1d(bounds, breaks + 1) if len(raw) else np.zeros(1, dtype=np.int64)
    line_starts, line_ends = edges[:-1], edges[1:]
    line_of = np.searchsorted(bounds, line_starts, side="right") - 1
    lines = np.bincount(line_of, minlength=rows).astype(float) if len(line_of) else np.zeros(rows)
    new_lines = _distinct(line_of, T.hash_spans(raw, line_starts, line_ends), rows)
    sums = lambda mask: np.bincount(of, weights=mask.astype(float), minlength=rows)
    return np.column_stack(
        [
            shares,
            words,
            sums(lengths),
            sums(lengths >= 16),
            np.bincount(owner_of_block, weights=different, minlength=rows),
            lines,
            new_lines,
            sums(head == CLASSES.index("upper")),
            sums(np.isin(tail, odd)),
        ]
    )


def _pieces(raw: np.ndarray) -> np.ndarray:
    """Where a long text is cut for counting: at the last space of each slice, if it has one."""
    cuts = [0]
    while len(raw) - cuts[-1] > T.SLICE_BYTES:
        part = raw[cuts[-1] : cuts[-1] + T.SLICE_BYTES]
        spaces = np.flatnonzero((part == 32) | (part == 10))
        cuts.append(cuts[-1] + (int(spaces[-1]) + 1 if len(spaces) else len(part)))
    return np.array([*cuts, len(raw)], dtype=np.int64)


def text_statistics(column: pa.Array) -> np.ndarray:
    """The statistics named in ``STATISTICS`` of each whole text; an empty text has zeros."""
    raw, bounds = T.text_bytes(column)
    parts = []
    for first, last in T.row_slices(bounds, min(COUNTED_BYTES, T.SLICE_BYTES)):
        part = raw[bounds[first] : bounds[last]]
        if len(part) > T.SLICE_BYTES:
            cuts = _pieces(part)
            parts.append(sum(_sums(part[a:b], np.array([0, b - a])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)))
        else:
            parts.append(_sums(part, bounds[first : last + 1] - bounds[first]))
    k = len(CLASSES)
    if not parts:
        return np.zeros((0, len(STATISTICS)))
    s = np.concatenate(parts)
    size = np.maximum(s[:, :k].sum(axis=1), 1)
    words, lines = np.maximum(s[:, k], 1), np.maximum(s[:, k + 4], 1)
    return np.column_stack(
        [
            s[:, :k] / size[:, None],
            np.log1p(s[:, k]),
            np.log1p(s[:, k + 1] / words),
            s[:, k + 2] / words,
            s[:, k + 3] / words,
            s[:, k + 5] / lines,
            np.log1p(size / lines) * (s[:, k] > 0),
            s[:, k + 6] / words,
            s[:, k + 7] / words,
        ]
    )


def statistics_table(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, x``: the statistics of every text, one row per row of the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = text_statistics(batch.column(1))
            flat = pa.array(x.ravel())
            size = x.shape[1]
            offsets = pa.array(np.arange(0, len(flat) + 1, size, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, flat)], names=["id", "x"])

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, x array<double>")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class QualityModel:
    """A fitted classifier: plain arrays, so it pickles into any task."""

    def __init__(self, mean, scale, weights, shift, ridge, knots, values):
        self.mean, self.scale, self.weights, self.shift = mean, scale, weights, shift
        self.ridge, self.knots, self.values = ridge, knots, values

    def features(self, x: np.ndarray) -> np.ndarray:
        return fourier((x - self.mean) / self.scale, self.weights, self.shift)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.features(x) @ self.ridge, self.knots, self.values)


def fourier(x: np.ndarray, weights: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised rows, with a constant first column."""
    z = np.cos(np.clip(x, -8, 8) @ weights + shift) * np.sqrt(2.0 / len(shift))
    return np.column_stack([np.ones(len(x)), z])


def _collected(frame: DataFrame) -> pa.Table:
    """Sums whose number of rows is fixed by parameters."""
    return frame.toArrow()


def _gram(train: DataFrame, mean, scale, weights, shift) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By fold the sums over all rows of ``z zᵀ`` and ``z y``: a part from each partition, added up by Spark."""
    size = len(shift) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x = _matrix(batch.column(0), len(mean))
            y, fold = (batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (1, 2))
            z = np.column_stack([fourier((x - mean) / scale, weights, shift), y])
            for f in np.unique(fold).astype(int):
                part = z[fold == f]
                sums[f] = sums.get(f, 0) + part.T @ part
        for f, total in sums.items():
            keep = np.triu_indices(size + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keep[0]), f, dtype=np.int32)), *(pa.array(i.astype(np.int32)) for i in keep), pa.array(total[keep])],
                names=["fold", "i", "j", "v"],
            )

    parts = train.select("x", "y", "fold").mapInArrow(run, "fold int, i int, j int, v double")
    table = _collected(parts.groupBy("fold", "i", "j").agg(F.sum("v").alias("v"))).to_pydict()
    out = {}
    for fold in set(table["fold"]):
        pick = np.array(table["fold"]) == fold
        full = np.zeros((size + 1, size + 1))
        i, j = np.array(table["i"])[pick], np.array(table["j"])[pick]
        full[i, j] = full[j, i] = np.array(table["v"])[pick]
        out[fold] = (full[:size, :size], full[:size, size])
    return out


def _solve(gram: np.ndarray, target: np.ndarray, penalty: float) -> np.ndarray:
    ridge = np.eye(len(gram)) * penalty
    ridge[0, 0] = 1e-9
    return np.linalg.solve(gram + ridge, target)


def isotonic(total: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the closest non-decreasing means, by weight."""
    blocks: list[list[float]] = []
    for t, c in zip(total, count, strict=True):
        blocks.append([t, c, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            t2, c2, n2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + t2, blocks[-1][1] + c2, blocks[-1][2] + n2]
    return np.concatenate([np.full(n, t / c) for t, c, n in blocks]) if blocks else np.zeros(0)


def fit_quality(
    statistics: DataFrame,
    labels: DataFrame,
    features: int = 256,
    width: float = 0.25,
    penalty: float = 1e-2,
    bins: int = 2000,
    seed: int = 7,
) -> QualityModel:
    """Fit on ``labels`` (``id, y, fold`` with y 0 or 1 and fold 0 or 1).

    Statistics are standardised by the training rows' means and deviations and
    sent through ``features`` cosines that approximate the kernel
    exp(-width² |a-b|² / 2). Normal equations are summed in each partition and
    added up by Spark; the driver solves one system of ``features`` unknowns.
    Each fold is scored by the other fold's weights; those scores, counted in
    ``bins`` bins, are made monotone. The final weights use both folds.

    Rows with a null id, label or fold teach nothing; an id with several
    labels teaches once for each. Without any label, or with one class only,
    every score is that class's share (0.5 without labels). What reaches the
    driver is bounded by ``features`` and ``bins``, not by the labels.
    """
    known = labels.where("id IS NOT NULL AND y IS NOT NULL AND fold IS NOT NULL")
    train = written(statistics.join(known, "id"), "train")
    size = len(STATISTICS)
    moments = [f(F.col("x")[i]).alias(f"{n}{i}") for i in range(size) for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    row = train.agg(F.count("*").alias("n"), F.avg("y").alias("share"), *moments).first()
    rng = np.random.default_rng(seed)
    weights, shift = rng.normal(scale=width, size=(size, features)), rng.uniform(0, 2 * np.pi, features)
    if not row["n"] or row["share"] in (0.0, 1.0):
        share = 0.5 if not row["n"] else row["share"]
        return QualityModel(np.zeros(size), np.ones(size), weights, shift, np.zeros(features + 1), np.array([0.0]), np.array([share]))
    mean = np.array([row[f"m{i}"] for i in range(size)])
    scale = np.maximum(np.array([row[f"s{i}"] for i in range(size)]), 1e-3)
    grams = _gram(train, mean, scale, weights, shift)
    gram, target = sum(g for g, _ in grams.values()), sum(t for _, t in grams.values())
    ridge = _solve(gram, target, penalty)
    by_fold = {f: _solve(*grams[1 - f], penalty) if 1 - f in grams else ridge for f in grams}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0), size)
            y, fold = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            z = fourier((x - mean) / scale, weights, shift)
            raw = np.where(fold == 0, z @ by_fold.get(0, ridge), z @ by_fold.get(1, ridge))
            bin_of = np.clip(((raw + 0.5) / 2 * bins).astype(np.int64), 0, bins - 1)
            n, t = np.bincount(bin_of, minlength=bins), np.bincount(bin_of, weights=y, minlength=bins)
            hit = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(n[hit].astype(float)), pa.array(t[hit])], names=["bin", "n", "t"])

    counted = train.select("x", "y", "fold").mapInArrow(run, "bin long, n double, t double")
    table = _collected(counted.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).orderBy("bin")).to_pydict()
    level = isotonic(np.array(table["t"]), np.array(table["n"]))
    knots = (np.array(table["bin"]) + 0.5) / bins * 2 - 0.5
    return QualityModel(mean, scale, weights, shift, ridge, knots, np.clip(level, 0, 1))


def score_quality(statistics: DataFrame, model: QualityModel) -> DataFrame:
    """``id, score`` of every row of a statistics table; 0 to 1."""
    size = len(STATISTICS)

    def run(model: QualityModel, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(_matrix(batch.column(1), size))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["id", "score"])

    kind = statistics.schema["id"].dataType.simpleString()
    return statistics.select("id", "x").mapInArrow(functools.partial(run, model), f"id {kind}, score double")


def _training(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """``id, y, fold`` of the rows that may teach."""
    rest = F.crc32(F.col(id_col).cast("string")) % 3
    train = labels.where(rest != 1).where(F.col(label_col).isin(0, 1))
    return train.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"), (rest / 2).cast("int").alias("fold"))


def quality(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    **options,
) -> DataFrame:
    """Score every whole text: ``id, held_out, score, predicted``, one row per input row.

    Ids with crc32(id as text) mod 3 = 1 are held out of the fit; the others
    form the folds 0 and 1 by remainders 0 and 2. A null id is held out. Null
    and empty texts have zero statistics and a score like any other. Labels
    other than 0 and 1 and null labels are left out of the fit. Repeated rows
    get repeated results; other columns of both tables are not read. Runs the
    fit at once; texts are read once, their statistics kept in the shared folder.
    """
    statistics = written(statistics_table(documents, id_col, text_col), "statistics")
    model = fit_quality(statistics, _training(labels, id_col, label_col), **options)
    held = F.coalesce(F.crc32(F.col("id").cast("string")) % 3 == 1, F.lit(True))
    return score_quality(statistics, model).select(
        F.col("id").alias(id_col), held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def quality_filter(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The documents whose score is 0.5 or more, with their own columns.

    The model is that of ``quality``; labels meet the statistics, so no text
    is shuffled. Every row is scored by its own text, without a join, so repeated and
    null ids keep what their texts deserve.
    """
    model = fit_quality(statistics_table(documents, id_col, text_col), _training(labels, id_col, label_col))

    def score(texts: pa.Array) -> pa.Array:
        parts = (text_statistics(texts.slice(at, SCORED_ROWS)) for at in range(0, len(texts), SCORED_ROWS))
        return pa.array(np.concatenate([np.zeros(0), *map(model.scores, parts)]))

    return documents.where(F.arrow_udf(score, "double")(F.col(text_col)) >= 0.5)
