"""Document fingerprints: quartile codes of hashed byte triplets and the length, compared by a bounded score."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brightwater.llm import text as T
from brightwater.session import written

BUCKETS = 256
FACTOR = 2_654_435_761  # multiplicative hash: the top byte of triplet * FACTOR modulo 2**32
LENGTH_STEPS, LENGTH_WEIGHT = 16, 4
LIMIT = BUCKETS
_NIBBLES = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)


def length_ladder(top: int = 1 << 44) -> list[int]:
    """Lengths at which the length code rises: each an eighth above the last, in whole numbers."""
    steps = [1]
    while steps[-1] < top:
        steps.append(steps[-1] + max(1, steps[-1] // 8))
    return steps


_LADDER = np.array(length_ladder(), dtype=np.int64)


def bucket_counts(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of each row how many of its byte triplets fall into each bucket."""
    rows = len(bounds) - 1
    total = np.zeros((rows, BUCKETS), dtype=np.int64)
    for first, last in T.row_slices(bounds):
        for a in range(int(bounds[first]), max(int(bounds[last]) - 2, 0), T.SLICE_BYTES):  # a long row alone, piece by piece
            b = min(a + T.SLICE_BYTES, int(bounds[last]) - 2)
            x = raw[a : b + 2].astype(np.uint32)
            bucket = ((x[:-2] | x[1:-1] << np.uint32(8) | x[2:] << np.uint32(16)) * np.uint32(FACTOR)) >> np.uint32(24)
            cut = np.clip(bounds[first : last + 1] - a, 0, b - a)
            owner = np.repeat(np.arange(last - first), np.diff(cut))
            inside = np.arange(b - a) + a + 2 < bounds[first + 1 : last + 1][owner]  # not over the row's end
            part = np.bincount(owner[inside] * BUCKETS + bucket[inside], minlength=(last - first) * BUCKETS)
            total[first:last] += part.reshape(last - first, BUCKETS)
    return total


def digests(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows of small numbers: length code, two quartile ratios, and a code of 0 to 3 for each bucket."""
    counts = bucket_counts(raw, bounds)
    ordered = np.sort(counts, axis=1)
    quartiles = [ordered[:, BUCKETS * k // 4 - 1] for k in (1, 2, 3)]
    codes = sum((counts > q[:, None]).astype(np.int16) for q in quartiles)
    upper = np.maximum(quartiles[2], 1)
    ratios = [15 * q // upper for q in quartiles[:2]]
    length = np.searchsorted(_LADDER, np.diff(bounds), side="right")
    return np.column_stack([length, *ratios, codes]).astype(np.int16)


def written_out(rows: np.ndarray) -> list[str]:
    """Fingerprints as text: three hex digits of length, one of each ratio, one for two buckets."""
    nibbles = np.column_stack([rows[:, 0] >> 8, rows[:, 0] >> 4 & 15, rows[:, 0] & 15, rows[:, 1], rows[:, 2], rows[:, 3::2] << 2 | rows[:, 4::2]])
    return [line.tobytes().decode() for line in _NIBBLES[nibbles]]


def read_back(fingerprints: list[str]) -> np.ndarray:
    """The inverse of ``written_out``."""
    nibbles = np.array([[int(c, 16) for c in f] for f in fingerprints], dtype=np.int16).reshape(len(fingerprints), -1)
    codes = np.empty((len(nibbles), BUCKETS), dtype=np.int16)
    codes[:, 0::2], codes[:, 1::2] = nibbles[:, 5:] >> 2, nibbles[:, 5:] & 3
    return np.column_stack([nibbles[:, 0] << 8 | nibbles[:, 1] << 4 | nibbles[:, 2], nibbles[:, 3:5], codes])


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """1 for equal digests, down to 0 where the difference reaches ``LIMIT``.

    The difference sums the steps between bucket codes and ratios, and ``LENGTH_WEIGHT`` for each step of
    length up to ``LENGTH_STEPS``.
    """
    apart = np.abs(one - other).astype(np.int64)
    score = apart[:, 1:].sum(axis=1) + LENGTH_WEIGHT * np.minimum(apart[:, 0], LENGTH_STEPS)
    return (LIMIT - np.minimum(score, LIMIT)) / LIMIT


def _of(texts: list[str]) -> np.ndarray:
    return digests(*T.text_bytes(pa.array(texts, type=pa.large_string())))


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_chars, fingerprint`` of each whole text; null counts as empty, equal texts have equal fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = written_out(digests(*T.text_bytes(batch.column(1)))) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(marks, type=pa.string())], names=[id_col, "n_chars", "fingerprint"])

    kind = documents.schema[id_col].dataType.simpleString()
    size = F.coalesce(F.char_length(text_col), F.lit(0)).cast("long")
    return documents.select(id_col, text_col, size).mapInArrow(run, f"`{id_col}` {kind}, n_chars long, fingerprint string")


Edit = Callable[[str, str], str]
_FOUND = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(ids: pa.Array, texts: list[str], after: list[str], own: np.ndarray, next_own: np.ndarray, edit: Edit) -> list[pa.Array]:
    """The result columns of rows whose following texts are given."""
    edited = [edit(a, b) for a, b in zip(texts, after, strict=True)]
    other = _of(edited)
    return [
        ids,
        pa.array([len(t) for t in texts], type=pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], type=pa.string()),
        pa.array(written_out(own), type=pa.string()),
        pa.array(written_out(other), type=pa.string()),
        pa.array(likeness(own, other)),
        pa.array(likeness(own, next_own)),
    ]


def compare_with_next(documents: DataFrame, edit: Edit, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against an edit of itself and against the next document.

    One row per input row: ``id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. ``edit(text, next_text)`` gives the edited text. Documents follow each other by id, a
    null id first, rows that repeat an id by a hash of their text; after the last comes the first, so a lone document
    follows itself. A null text is empty. An empty table gives no rows; other columns are not read.

    Texts are shuffled once, into ranges of ids, and each range is read in order by one task that
    holds a batch. A range's first and last documents are written beside its results and meet those of
    the neighbouring ranges in a join on the range's number.
    """
    kind = documents.schema[id_col].dataType.simpleString()
    text = F.coalesce(text_col, F.lit(""))
    rows = documents.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("n"))
    order = ["id", "h", "n"]  # the row number only parts rows that are alike, so that ranges can split them

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def edge(ids: pa.Array, text: str, at: int) -> pa.RecordBatch:
            nulls = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())]
            return pa.RecordBatch.from_arrays([ids, *nulls, pa.array([at], type=pa.int32()), pa.array([part], type=pa.int32()), pa.array([text])], names=names)

        held = None  # the last row so far: its id, text and digest
        for whole in batches:
            _, sizes = T.text_bytes(whole.column(1))
            for first, last in T.row_slices(sizes):
                ids, texts = whole.column(0).slice(first, last - first), whole.column(1).slice(first, last - first).to_pylist()
                own = _of(texts)
                if held is None:
                    yield edge(ids.slice(0, 1), texts[0], 1)
                else:
                    ids, texts, own = pa.concat_arrays([held[0], ids]), [held[1], *texts], np.concatenate([held[2], own])
                if len(texts) > 1:
                    found = _compared(ids.slice(0, len(texts) - 1), texts[:-1], texts[1:], own[:-1], own[1:], edit)
                    n = len(texts) - 1
                    yield pa.RecordBatch.from_arrays([*found, pa.array([0] * n, type=pa.int32()), pa.array([part] * n, type=pa.int32()), pa.nulls(n, pa.string())], names=names)
                held = ids.slice(len(texts) - 1), texts[-1], own[-1:]
        if held is not None:
            yield edge(held[0], held[1], 2)

    names = ["id", *(f.split()[0] for f in _FOUND.split(", ")), "edge", "part", "text"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    found = written(ranged.mapInArrow(stream, f"id {kind}, {_FOUND}, edge int, part int, text string"), "in-order")

    # One number for each range that has rows, whatever the corpus.
    parts = found.where("edge = 1").select("part")
    everything = Window.orderBy("part")
    following = parts.select(
        "part", F.coalesce(F.lead("part").over(everything), F.min("part").over(everything)).alias("next_part")
    )
    firsts = found.where("edge = 1").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    lasts = found.where("edge = 2").select("id", "text", "part")
    met = lasts.join(following, "part").join(firsts, "next_part").select("id", "text", "next_text")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, after = (batch.column(i).to_pylist() for i in (1, 2))
            if texts:
                yield pa.RecordBatch.from_arrays(_compared(batch.column(0), texts, after, _of(texts), _of(after), edit), names=names[:7])

    done = found.where("edge = 0").select(*names[:7]).unionByName(met.mapInArrow(finish, f"id {kind}, {_FOUND}"))
    return done.withColumnRenamed("id", id_col)
