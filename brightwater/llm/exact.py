"""Exact dedup: composable polynomial fingerprints, then a chunk by chunk comparison."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwater.llm import text as T
from brightwater.session import written

PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_732_050_807, 1_414_213_562)
CHUNK_BYTES = 1 << 16
COPIES_PER_SALT = 512


class Fingerprints:
    """Polynomials of a text's bytes at two bases, each modulo a prime below 2**31.

    ``H(x) = sum((x[i] + 1) * base**i)``, so ``H(xy) = H(x) + base**len(x) * H(y)``:
    hashes of chunks, made in any order or place, combine to that of the text.
    """

    def __init__(self, primes: tuple[int, int] = PRIMES, bases: tuple[int, int] = BASES, chunk: int = CHUNK_BYTES):
        self.primes, self.bases, self.chunk = primes, bases, chunk
        self.powers = []
        for p, b in zip(primes, bases, strict=True):
            table, filled = np.ones(chunk, dtype=np.uint64), 1
            while filled < chunk:  # doubles the table: base**(i+k) = base**i * base**k
                more = min(filled, chunk - filled)
                table[filled : filled + more] = table[:more] * np.uint64(pow(b, filled, p)) % np.uint64(p)
                filled += more
            self.powers.append(table)

    def chunks(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Of each chunk of each row: the row, the chunk's number and its two hashes."""
        counts = -(-np.diff(bounds) // self.chunk)
        owner = np.repeat(np.arange(len(counts)), counts)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = bounds[owner] + number * self.chunk
        hashes = []
        for p, table in zip(self.primes, self.powers, strict=True):
            if not len(starts):
                hashes.append(np.zeros(0, dtype=np.uint64))
                continue
            sizes = np.diff(np.append(starts, len(raw)))
            place = np.arange(len(raw)) - np.repeat(starts, sizes)
            hashes.append(np.add.reduceat((raw.astype(np.uint64) + np.uint64(1)) * table[place], starts) % np.uint64(p))
        return owner, number, hashes

    def combine(self, rows: int, owner: np.ndarray, number: np.ndarray, hashes: list[np.ndarray]) -> list[np.ndarray]:
        """Of each row the hash of its chunks put together, each shifted by the length before it."""
        out = []
        for p, b, h in zip(self.primes, self.bases, hashes, strict=True):
            step = pow(b, self.chunk, p)
            shifts = np.array([pow(step, int(k), p) for k in range(int(number.max()) + 1 if len(number) else 0)], dtype=np.uint64)
            total = np.zeros(rows, dtype=np.uint64)
            np.add.at(total, owner, h * shifts[number] % np.uint64(p) if len(h) else h)
            out.append(total % np.uint64(p))
        return out

    def join(self, left: tuple[int, ...], left_length: int, right: tuple[int, ...]) -> tuple[int, ...]:
        """The hashes of two texts put together, from theirs."""
        return tuple((x + pow(b, left_length, p) * y) % p for p, b, x, y in zip(self.primes, self.bases, left, right, strict=True))

    def rows(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The two hashes of each row in one long."""
        parts = []
        for first, last in T.row_slices(bounds):
            cut = bounds[first : last + 1] - bounds[first]
            part = raw[bounds[first] : bounds[last]]
            if len(part) > T.SLICE_BYTES:  # one long text: hash it piece by piece
                step = T.SLICE_BYTES // self.chunk * self.chunk or self.chunk
                pieces = [self.chunks(part[i : i + step], np.array([0, min(step, len(part) - i)])) for i in range(0, len(part), step)]
                number = np.concatenate([n + i * step // self.chunk for i, (_, n, _) in enumerate(pieces)])
                hashes = [np.concatenate([h[k] for _, _, h in pieces]) for k in range(2)]
                high, low = self.combine(1, np.zeros(len(number), dtype=np.int64), number, hashes)
            else:
                high, low = self.combine(last - first, *self.chunks(part, cut))
            parts.append((high << np.uint64(31) | low).astype(np.int64))
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def fingerprints(documents: DataFrame, id_col: str, text_col: str, hashes: Fingerprints) -> DataFrame:
    """``id, fp, n_bytes, text_sha256`` of each whole text with A-Z lower-cased; null is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = T.text_bytes(batch.column(1), lower=True)
            view = memoryview(raw)
            digests = [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(hashes.rows(raw, bounds)), pa.array(np.diff(bounds)), pa.array(digests, type=pa.string())],
                names=["id", "fp", "n_bytes", "text_sha256"],
            )

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, fp long, n_bytes long, text_sha256 string"
    )


def _chunk_table(texts: DataFrame, hashes: Fingerprints) -> DataFrame:
    """Chunks of the candidates' texts; a row whose text has not the fingerprint it was joined on is dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = T.text_bytes(batch.column(at), lower=True)
            fp, size = (batch.column(batch.schema.names.index(n)).to_numpy() for n in ("fp", "n_bytes"))
            same = np.flatnonzero((hashes.rows(raw, bounds) == fp) & (np.diff(bounds) == size))
            row, number, data, held = [], [], [], 0
            for i in same.tolist():
                for k, start in enumerate(range(int(bounds[i]), int(bounds[i + 1]), CHUNK_BYTES)):
                    row.append(i)
                    number.append(k)
                    data.append(raw[start : min(start + CHUNK_BYTES, int(bounds[i + 1]))].tobytes())
                    held += len(data[-1])
                    if held >= T.SLICE_BYTES:
                        yield chunk_batch(batch, row, number, data)
                        row, number, data, held = [], [], [], 0
            yield chunk_batch(batch, row, number, data)

    def chunk_batch(batch: pa.RecordBatch, row: list, number: list, data: list) -> pa.RecordBatch:
        kept = batch.select(names).take(pa.array(row, type=pa.int64()))
        return pa.RecordBatch.from_arrays([*kept.columns, pa.array(number, type=pa.int64()), pa.array(data, type=pa.binary())], names=[*names, "chunk", "data"])

    at, names = texts.columns.index("text"), [c for c in texts.columns if c != "text"]
    return texts.mapInArrow(run, texts.drop("text").schema.add("chunk", "long").add("data", "binary"))


def _compared(documents: DataFrame, candidates: DataFrame, id_col: str, text_col: str, hashes: Fingerprints) -> DataFrame:
    """``id, fp, n_bytes, rep, same``: whether each candidate's text is its group's representative's.

    Candidates meet the representative chunk by chunk in a sorted join. A
    group is cut into salts of about ``COPIES_PER_SALT`` members, each with a copy of
    the representative's chunks, so no key has more rows than that.
    """
    key = ["fp", "n_bytes"]
    groups = written(candidates.groupBy(*key).agg(F.max("id").alias("rep"), F.count("*").alias("n")).where("n > 1"), "groups")
    named = candidates.join(groups, key)
    texts = documents.select(F.col(id_col).alias("text_id"), F.col(text_col).alias("text"))
    wanted = texts.join(named, F.col("text_id").eqNullSafe(F.col("id"))).drop("text_id")
    chunks = written(_chunk_table(wanted, hashes), "chunks")
    salts = F.ceil(F.col("n") / COPIES_PER_SALT)
    mine = chunks.where("NOT id <=> rep").withColumn("salt", F.pmod(F.xxhash64("id"), salts))
    reps = chunks.where("id <=> rep").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
    reps = reps.select(*key, "salt", "chunk", F.col("data").alias("rep_data"))
    met = mine.join(reps, [*key, "salt", "chunk"], "left")
    same = F.coalesce(F.col("data") == F.col("rep_data"), F.lit(False))
    checked = met.groupBy("id", *key, "rep").agg(F.min(same).alias("same"))
    # An empty text has no chunk, and equal lengths make it equal; a group's representative is itself.
    trivial = named.where("n_bytes = 0 OR id <=> rep").select("id", *key, "rep", F.lit(True).alias("same"))
    return checked.unionByName(trivial)


def exact_dedup(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    hashes: Fingerprints | None = None,
) -> DataFrame:
    """Groups of texts that are identical after lower-casing A-Z.

    One row per input row: ``id_col, keep_id, group_size, kept, fp, n_bytes,
    text_sha256``. Of equal texts the row with the largest id stays; a null id
    counts as smallest, a null text as empty. Rows that repeat an id with an equal
    text share one result: all name that id and are marked as kept if it stays, and each counts
    in ``group_size``. Other columns are not read; an empty table gives no rows.

    Texts are read twice: once for fingerprints, kept in the shared folder,
    and once for those that share one. Group tables are written before rows meet
    them, so that the adaptive skew join can split a hot group. Equal fingerprints are no proof: such
    texts are compared chunk by chunk with the group's largest id, and those
    that differ form groups again, until none is left.
    """
    hashes = hashes or Fingerprints()
    key = ["fp", "n_bytes"]
    prints = written(fingerprints(documents, id_col, text_col, hashes), "fingerprints")
    groups = written(prints.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key), "groups")
    candidates = written(prints.join(groups, key).select("id", *key).distinct(), "candidates")
    classes = None
    while True:
        compared = written(_compared(documents, candidates, id_col, text_col, hashes), "compared")
        found = compared.where("same").select("id", *key, F.col("rep").alias("keep_id"))
        classes = found if classes is None else classes.unionByName(found)
        rest = compared.where("NOT same")
        if rest.isEmpty():
            break
        candidates = written(rest.select("id", *key), "candidates")
    c = classes.select(F.col("id").alias("c_id"), F.col("fp").alias("c_fp"), F.col("n_bytes").alias("c_bytes"), "keep_id", F.lit(True).alias("grouped"))
    on = F.col("id").eqNullSafe(F.col("c_id")) & (F.col("fp") == F.col("c_fp")) & (F.col("n_bytes") == F.col("c_bytes"))
    rows = prints.join(c, on, "left").select(
        "id", *key, "text_sha256", F.when(F.col("grouped"), F.col("keep_id")).otherwise(F.col("id")).alias("keep_id")
    )
    rows = written(rows, "classes")
    sizes = rows.groupBy(*key, F.col("keep_id").alias("s_id")).agg(F.count("*").alias("group_size")).where("group_size > 1")
    sizes = written(sizes, "sizes")
    sizes = sizes.withColumnsRenamed({"fp": "s_fp", "n_bytes": "s_bytes"})
    on = F.col("keep_id").eqNullSafe(F.col("s_id")) & (F.col("fp") == F.col("s_fp")) & (F.col("n_bytes") == F.col("s_bytes"))
    return rows.join(sizes, on, "left").select(
        F.col("id").alias(id_col),
        "keep_id",
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "fp",
        "n_bytes",
        "text_sha256",
    )
