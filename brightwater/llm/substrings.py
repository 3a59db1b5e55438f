"""Substring dedup: repeated word windows found by an FM-index per shard."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwater.llm import text as T
from brightwater.llm.fmindex import FMIndex
from brightwater.session import written

GRAM = 8
SHARD_WORDS = 1_000_000
HOT_CLASSES = 256
FEW = 128
LEAST_ID = -(1 << 63)
_SHIFT = np.uint64(0xD6E8FEB86659FD93)


def span_hashes(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each span of word hashes, mixed with its length."""
    up, down = T._powers(len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(T.mix(words ^ _SHIFT) * up[: len(words)], out=sums[1:])
    return T.mix((sums[starts + sizes] - sums[starts]) * down[starts] + sizes.astype(np.uint64))


def segments(words: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Row, start, number of windows, anchor and content of each run of windows that share their least gram.

    A window's anchor is the least hash among its grams of ``GRAM`` words,
    so equal windows have equal anchors wherever they stand. ``first`` has each row's first word.
    """
    size = min(GRAM, window)
    counts = np.diff(first)
    row = np.repeat(np.arange(len(counts)), counts)
    n = len(words) - window + 1
    if n <= 0:
        nothing = np.zeros(0, dtype=np.int64)
        return nothing, nothing, nothing, nothing.astype(np.uint64), nothing.astype(np.uint64)
    grams = T.gram_hashes(words, size)
    least, place, span = grams.copy(), np.arange(len(grams)), window - size + 1
    reach = 1
    while reach < span:  # the least of 2, 4, 8, ... grams from each place on, the leftmost of equals
        step = min(reach, span - reach)
        better = least[step:] < least[: len(least) - step]
        place = np.where(better, place[step:], place[: len(place) - step])
        least = np.where(better, least[step:], least[: len(least) - step])
        reach += step
    start = np.flatnonzero(np.arange(window, window + n) <= first[row[:n] + 1])
    if not len(start):
        return segments(words[:0], np.zeros(1, dtype=np.int64), window)
    new = np.ones(len(start), dtype=bool)
    new[1:] = (place[start[1:]] != place[start[:-1]]) | (row[start[1:]] != row[start[:-1]])
    head = np.flatnonzero(new)
    runs = np.diff(np.append(head, len(start)))
    begin = start[head]
    content = span_hashes(words, begin, runs + window - 1)
    return row[begin], begin - first[row[begin]], runs, least[begin], content


def _rows_of_words(batch: pa.RecordBatch, text_at: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, word hashes and each row's first word, slice by slice."""
    raw, bounds = T.text_bytes(batch.column(text_at))
    for a, b in T.row_slices(bounds):
        part = raw[bounds[a] : bounds[b]]
        starts, ends, first = T.word_spans(part, bounds[a : b + 1] - bounds[a])
        yield a, T.hash_spans(part, starts, ends), first


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few documents, as each has many requests or words."""
    for batch in batches:
        for first in range(0, batch.num_rows, FEW):
            yield batch.slice(first, FEW)


SEGMENT = "anchor long, content long, id long, start long, n long"


def _segment_table(documents: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for a, words, first in _rows_of_words(batch, 1):
                row, start, n, anchor, content = segments(words, first, window)
                columns = [T.signed(anchor), T.signed(content), ids[a + row], start, n]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["anchor", "content", "id", "start", "n"])

    return documents.mapInArrow(run, SEGMENT)


def _repeated(sorted_segments: DataFrame) -> DataFrame:
    """Segments of partitions sorted by anchor whose anchor may occur twice; ``again`` where their content stood before.

    The first and the last anchor of a partition may go on in another one
    and are kept in any case.
    """
    names = ["anchor", "content", "id", "start", "n"]

    def judged(rows: np.ndarray, opening: bool, closing: bool) -> pa.RecordBatch:
        anchor, content = rows[0], rows[1]
        new = np.ones(len(anchor), dtype=bool)
        new[1:] = anchor[1:] != anchor[:-1]
        group = np.cumsum(new) - 1
        keep = np.bincount(group)[group] > 1 if len(group) else new
        if opening and len(group):
            keep |= group == 0
        if closing and len(group):
            keep |= group == group[-1]
        head = new.copy()
        head[1:] |= content[1:] != content[:-1]
        lead = np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))
        again = (rows[2] != rows[2][lead]) | (rows[3] != rows[3][lead])
        return pa.RecordBatch.from_arrays([*(pa.array(c[keep]) for c in rows), pa.array(again[keep])], names=[*names, "again"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, opening = np.zeros((5, 0), dtype=np.int64), True
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.concatenate([held, np.vstack([c.to_numpy(zero_copy_only=False) for c in batch.columns])], axis=1)
            last = int(np.searchsorted(rows[0], rows[0, -1]))  # the batch's last anchor may go on
            if last:
                yield judged(rows[:, :last], opening, False)
                opening = False
            held = rows[:, last:]
        if held.shape[1]:
            yield judged(held, opening, True)

    return sorted_segments.mapInArrow(run, f"{SEGMENT}, again boolean")


REQUEST = "struct<start:long,n:long,content:long,anchor:long,hot:boolean>"


def _document_table(documents: DataFrame) -> DataFrame:
    """``id, real_id, n_words, all_sha256, packed, requests``: documents touched by a request keep their text, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            touched = batch.column(3).to_pylist()
            texts = batch.column(2).to_pylist()
            n_words, digests, packed = [], [], []
            for text, asked in zip(texts, touched, strict=True):
                words = (text or "").encode().split()
                n_words.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                packed.append(pa.compress(text.encode(), codec="zstd", asbytes=True) if asked and text else None)
            size = pa.array([len((t or "").encode()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), pa.array(digests, pa.string()), pa.array(packed, pa.binary()), size, batch.column(4)],
                names=["id", "real_id", "n_words", "all_sha256", "packed", "size", "requests"],
            )

    kind = documents.schema["real_id"].dataType.simpleString()
    return documents.select("id", "real_id", "text", "touched", "requests").mapInArrow(
        run, f"id long, real_id {kind}, n_words long, all_sha256 string, packed binary, size long, requests array<{REQUEST}>"
    )


def _unpacked(packed: bytes | None, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, size, codec="zstd", asbytes=True), dtype=np.uint8) if packed else np.zeros(0, dtype=np.uint8)


def _own(words: np.ndarray, asked: list[dict], window: int) -> list[dict]:
    """The requests that fit this text; others belong to another row with the id."""
    fit = [r for r in asked if r["start"] + r["n"] + window - 1 <= len(words)]
    if not fit:
        return []
    starts, sizes = (np.array([r[k] for r in fit], dtype=np.int64) for k in ("start", "n"))
    same = T.signed(span_hashes(words, starts, sizes + window - 1)) == np.array([r["content"] for r in fit], dtype=np.int64)
    return [r for r, s in zip(fit, same.tolist(), strict=True) if s]


def _word_table(documents: DataFrame, window: int) -> DataFrame:
    """``route, hot, id, start, n, content, words``: the words of each requested segment; a hot anchor's windows singly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            rows = []
            for one in batch.to_pylist():
                raw = _unpacked(one["packed"], one["size"])
                starts, ends, _ = T.word_spans(raw, np.array([0, len(raw)]))
                words = T.hash_spans(raw, starts, ends)
                for r in _own(words, one["requests"], window):
                    s, n = r["start"], r["n"]
                    if r["hot"]:
                        at = np.arange(s, s + n)
                        hashes = T.signed(span_hashes(words, at, np.full(n, window))).tolist()
                        rows += [(h, True, one["id"], int(a), 1, h, None) for a, h in zip(at, hashes, strict=True)]
                    else:
                        rows.append((r["anchor"], False, one["id"], s, n, r["content"], words[s : s + n + window - 1].tobytes()))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["route", "hot", "id", "start", "n", "content", "words"]
            )

    asked = documents.where("size(requests) > 0").select("id", "packed", "size", "requests")
    return asked.mapInArrow(run, "route long, hot boolean, id long, start long, n long, content long, words binary")


CUT = "id long, start long, n long, content long, mask long"


def _searched(words: DataFrame, window: int) -> DataFrame:
    """One FM-index for each partition's segments; the windows of each that stand earlier in another, as bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, pieces = [], []
        for batch in batches:
            parts.append(np.vstack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]))
            pieces += [np.frombuffer(w, dtype=np.uint64) for w in batch.column(4).to_pylist()]
        if not pieces:
            return
        ids, starts, n, content = np.concatenate(parts, axis=1)
        sizes = np.array(list(map(len, pieces)), dtype=np.int64)
        heads = np.cumsum(sizes + 1) - sizes
        total = int(sizes.sum()) + len(sizes) + 1
        text = np.zeros(total, dtype=np.int64)
        filled = np.ones(total, dtype=bool)
        filled[heads - 1] = filled[-1] = False
        text[filled] = np.unique(np.concatenate(pieces), return_inverse=True)[1] + 1
        index = FMIndex(text, window + 1)
        segment = np.repeat(np.arange(len(n)), n)
        offset = np.arange(len(segment)) - np.repeat(np.cumsum(n) - n, n)
        low, high = index.search(text, heads[segment] + offset, window, least=2)
        many = np.flatnonzero(high - low > 1)
        order = many[np.lexsort((starts[segment[many]] + offset[many], ids[segment[many]], low[many]))]
        where = np.column_stack([low[order], ids[segment[order]], starts[segment[order]] + offset[order]])
        same = np.zeros(len(order), dtype=bool)
        same[1:] = where[1:, 0] == where[:-1, 0]
        lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(order)))) if len(order) else order
        later = (where != where[lead]).any(axis=1) if len(order) else same  # equal places are one window, seen through two rows
        cut = order[later]
        mask = np.zeros(len(n), dtype=np.int64)
        np.bitwise_or.at(mask, segment[cut], np.int64(1) << offset[cut])
        hit = np.flatnonzero(mask)
        yield pa.RecordBatch.from_arrays([pa.array(x[hit]) for x in (ids, starts, n, content, mask)], names=["id", "start", "n", "content", "mask"])

    return words.select("id", "start", "n", "content", "words").mapInArrow(run, CUT)


def _without(documents: DataFrame, window: int) -> DataFrame:
    """``real_id, n_words, n_removed, kept_words`` and digest of documents with their ``cuts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            ids, n_words, digests, packed, sizes, cuts = (batch.column(i) for i in range(6))
            removed, kept = [], digests.to_pylist()
            for i, (asked, blob, size) in enumerate(zip(cuts.to_pylist(), packed.to_pylist(), sizes.to_pylist(), strict=True)):
                gone = 0
                if asked and blob:
                    raw = _unpacked(blob, size)
                    starts, ends, _ = T.word_spans(raw, np.array([0, len(raw)]))
                    change = np.zeros(len(starts) + 1, dtype=np.int64)
                    for r in _own(T.hash_spans(raw, starts, ends), asked, window):
                        at = np.array([r["start"] + k for k in range(r["n"]) if r["mask"] >> k & 1])
                        np.add.at(change, at, 1)
                        np.add.at(change, at + window, -1)
                    drop = np.cumsum(change[:-1]) > 0
                    gone = int(drop.sum())
                    if gone:
                        words = raw.tobytes().split()
                        kept[i] = hashlib.sha256(b" ".join([w for w, d in zip(words, drop.tolist(), strict=True) if not d])).hexdigest()
                removed.append(gone)
            yield pa.RecordBatch.from_arrays([ids, n_words, pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["real_id", "n_words", "n_removed", "kept_sha256"])

    kind = documents.schema["real_id"].dataType.simpleString()
    columns = ["real_id", "n_words", "all_sha256", "packed", "size", "cuts"]
    return documents.select(*columns).mapInArrow(run, f"real_id {kind}, n_words long, n_removed long, kept_sha256 string")


def repeated_windows(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> tuple[DataFrame, DataFrame]:
    """Where whole texts repeat ``window`` words of an earlier place, and the documents to cut.

    The first frame has ``id, start, n, content, mask``: bit k of the mask says that the
    window at word ``start + k`` stands earlier (smaller id, or same id and
    smaller start). The second is the document table that ``remove_repeats`` takes.

    Windows are routed by their least gram (``segments``), so all copies of
    a window meet in one shard and each document is streamed against the shards of its own
    grams only. Segments are sorted over range partitions, which split any
    group; of equal segments all but the first are cut at once, and grams that stand once are
    dropped. What is left, different segments around one gram, goes to shards of
    about ``SHARD_WORDS`` words: each builds an FM-index, searches every window
    backwards and reports those with an earlier occurrence. A gram with more than ``HOT_CLASSES``
    different segments is no one shard's work: its windows are compared by hash in a
    combined aggregate. A null id counts as the least, a null text has no words.
    """
    if window > 62 + GRAM:
        raise ValueError("a segment's windows must fit into 63 bits")
    rows = documents.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST_ID)).alias("id"), F.col(id_col).alias("real_id"), F.col(text_col).alias("text")
    )
    order = ["anchor", "content", "id", "start"]
    ranged = _segment_table(rows.select("id", "text"), window).repartitionByRange(*order).sortWithinPartitions(*order)
    found = written(_repeated(ranged), "segments")
    place = F.struct("id", "start")
    classes = found.where("NOT again").groupBy("anchor", "content").agg(F.min(place).alias("f"), F.max("n").alias("n"))
    classes = written(classes.select("anchor", "content", "f.id", "f.start", "n"), "classes")
    all_bits = F.expr("shiftleft(1L, CAST(n AS INT)) - 1L AS mask")
    again = found.where("again").select("anchor", "content", "id", "start", "n")
    heads = found.where("NOT again").select("anchor", "content", "id", "start", "n")
    c = classes.select("anchor", "content", F.col("id").alias("f_id"), F.col("start").alias("f_start"))
    other = heads.join(c, ["anchor", "content"]).where("id <> f_id OR start <> f_start").drop("f_id", "f_start")
    copies = again.unionByName(other).select("id", "start", "n", "content", all_bits)
    copies = written(copies, "copies")
    mixed = written(classes.groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1"), "mixed-anchors")
    asked = classes.join(mixed, "anchor").withColumn("hot", F.col("k") > HOT_CLASSES)
    asked = written(asked.select("id", "start", "n", "content", "anchor", "hot"), "requests")
    total = asked.agg(F.sum(F.col("n") + window - 1)).first()[0] or 0
    request = F.struct("start", "n", "content", "anchor", "hot").cast(REQUEST)
    touched = asked.select("id", request.alias("r")).unionByName(copies.select("id", F.lit(None).cast(REQUEST).alias("r")))
    touched = touched.groupBy(F.col("id").alias("t_id")).agg(F.collect_list("r").alias("requests"))
    joined = rows.join(touched, F.col("id") == F.col("t_id"), "left").withColumn("touched", F.col("t_id").isNotNull())
    table = written(_document_table(joined), "documents")
    words = written(_word_table(table, window), "segment-words")
    shards = max(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // SHARD_WORDS)
    cuts = _searched(words.where("NOT hot").repartition(shards, "route"), window)
    single = words.where("hot").select("route", "id", "start", "content")
    firsts = written(single.groupBy("route").agg(F.min(place).alias("f"), F.count("*").alias("k")).where("k > 1").select("route", "f"), "hot-windows")
    hot = single.join(firsts, "route").where("id <> f.id OR start <> f.start")
    hot = hot.select("id", "start", F.lit(1).cast("long").alias("n"), "content", F.lit(1).cast("long").alias("mask"))
    return copies.unionByName(cuts).unionByName(hot), table


def remove_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """Every word that a repeated window covers removed: ``id_col, n_words, n_removed, kept_sha256``.

    Windows are judged on the input. One row per input row; a text of fewer than ``window`` words keeps
    all. Rows that repeat an id share their places: of a window at the same place neither
    stands earlier. Other columns are not read; an empty table gives no rows.
    """
    cuts, table = repeated_windows(documents, id_col, text_col, window)
    by_id = cuts.groupBy(F.col("id").alias("c_id")).agg(F.collect_list(F.struct("start", "n", "content", "mask")).alias("cuts"))
    cut = table.join(by_id, F.col("id") == F.col("c_id"), "left")
    return _without(cut, window).withColumnRenamed("real_id", id_col)
