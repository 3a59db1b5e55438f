"""Byte-level BPE: encoding by a segment tree of pair ranks, and decoding."""

from __future__ import annotations

import base64
import functools
import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

# White space as the vocabulary's own library understands \s (fixed values).
WHITE_SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CACHED_PIECES, CACHED_CHARS, MANY = 200_000, 64, 10_000
BATCH_BYTES = 2 << 20
_NONE = 1 << 62
_POSITION = (1 << 40) - 1


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a rank file (base64 and number on each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """Ids of one piece: merge the pair of lowest rank, leftmost first, until no pair has a rank.

    The tree's leaves are byte positions. A leaf holds rank and position of
    the pair that begins there, a parent the smaller of its two children, so the root is the
    leftmost pair of lowest rank. A merge changes the leaves of the merged
    pair, of its right half and of its left neighbour, each in log(n) steps.
    """
    n = len(piece)
    if n == 1:
        return [ranks[piece]]
    size = 1 << (n - 1).bit_length()
    tree = [_NONE] * (2 * size)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    get = ranks.get
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            tree[size + i] = rank << 40 | i
    for node in range(size - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if a < b else b

    def put(i: int, value: int) -> None:
        node = size + i
        tree[node] = value
        while node > 1:
            other = tree[node ^ 1]
            if other < value:
                value = other
            node >>= 1
            if tree[node] == value:
                break
            tree[node] = value

    def pair(i: int) -> int:
        j = after[i]
        if j >= n or (end := after[j]) - i > longest:
            return _NONE
        rank = get(piece[i:end])
        return _NONE if rank is None else rank << 40 | i

    while tree[1] != _NONE:
        i = tree[1] & _POSITION
        j = after[i]
        end = after[i] = after[j]
        if end < n:
            before[end] = i
        put(j, _NONE)
        put(i, pair(i))
        if before[i] >= 0:
            put(before[i], pair(before[i]))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


def _category(initial: str, limit: int) -> str:
    """The characters below ``limit`` of one general category, as the inside of a character class."""
    ranges, first = [], None
    for code in range(limit + 1):
        if code < limit and unicodedata.category(chr(code))[0] == initial:
            first = code if first is None else first
        elif first is not None:
            ranges.append(f"\\U{first:08x}-\\U{code - 1:08x}")
            first = None
    return "".join(ranges)


@functools.cache
def _splitter_below(pattern: str, limit: int):
    for name, inside in ((r"\p{L}", _category("L", limit)), (r"\p{N}", _category("N", limit))):
        pattern = _written_out(pattern, name, inside, f"[{inside}]")
    pattern = _written_out(pattern, r"\s", WHITE_SPACE, f"[{WHITE_SPACE}]")
    return re.compile(pattern.replace(r"\S", f"[^{WHITE_SPACE}]")).findall


@functools.cache
def splitter(pattern: str) -> Callable[[str], list[str]]:
    """The pattern's matches in a text, with its Unicode classes written out for the standard library's engine.

    A text without characters beyond the basic plane (or ASCII) is split by classes without them, which that engine
    looks up in one table and else range by range.
    """
    narrow, basic, full = (_splitter_below(pattern, limit) for limit in (1 << 7, 1 << 16, sys.maxunicode + 1))

    def split(text: str) -> list[str]:
        if text.isascii():
            return narrow(text)
        return basic(text) if len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text) else full(text)

    return split


def _written_out(pattern: str, name: str, inside: str, outside: str) -> str:
    """Replace a class name, by ``inside`` where it stands between brackets."""
    out, depth = [], 0
    for part in re.split(r"(\\p\{\w\}|\\.|\[|\])", pattern):
        depth += (part == "[") - (part == "]")
        out.append((inside if depth else outside) if part == name else part)
    return "".join(out)


class PairTable:
    """Rank of the token that two tokens make, for arrays of pairs: an open-addressed table."""

    BITS = 20

    def __init__(self, ranks: dict[bytes, int]):
        pairs = [
            (left << 32 | right, rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None
        ]
        while 1 << self.BITS < 4 * len(pairs):
            self.BITS += 1
        self.highest = max(ranks.values())
        self.keys = np.full(1 << self.BITS, -1, dtype=np.int64)
        self.ranks = np.zeros(1 << self.BITS, dtype=np.int64)
        keys, values = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == -1
            self.keys[slots[free]] = keys[free]
            own = self.keys[slots] == keys
            self.ranks[slots[own]] = values[own]
            keys, values, slots = keys[~own], values[~own], (slots[~own] + 1) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        slots, out = self._slots(keys), np.full(len(keys), _NONE, dtype=np.int64)
        rest = np.arange(len(keys))
        while len(rest):
            found = self.keys[slots]
            hit = found == keys[rest]
            out[rest[hit]] = self.ranks[slots[hit]]
            go = ~hit & (found != -1)
            rest, slots = rest[go], (slots[go] + 1) & (len(self.keys) - 1)
        return out


def merge_many(pieces: list[bytes], leaves: int, single: np.ndarray, pairs: PairTable) -> list[tuple[int, ...]]:
    """As ``merge``, for many pieces of 2 to ``leaves`` bytes at once."""
    flat, ends = merged_rows(pieces, leaves, single, pairs)
    return [tuple(flat[a:b].tolist()) for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def merged_rows(pieces: list[bytes], leaves: int, single: np.ndarray, pairs: PairTable) -> tuple[np.ndarray, list[int]]:
    """Ids of the pieces one after the other, and where each piece's end. A row of the arrays is one piece's tree.

    A tree's value is rank and place in one number, of 32 bits where the ranks leave room.
    """
    n = len(pieces)
    kind = np.int32 if pairs.highest < 1 << 22 else np.int64
    most = np.iinfo(kind).max
    sizes = np.fromiter(map(len, pieces), dtype=kind, count=n)
    raw = np.frombuffer(b"".join(p.ljust(leaves, b"\0") for p in pieces), dtype=np.uint8).reshape(n, leaves)
    token = single.astype(kind)[raw]
    place = np.arange(leaves, dtype=kind)
    after = np.broadcast_to(place + 1, (n, leaves)).copy()
    before = np.broadcast_to(place - 1, (n, leaves)).copy()
    tree = np.full((n, 2 * leaves), most, dtype=kind)
    rank = pairs(token[:, :-1].ravel(), token[:, 1:].ravel()).reshape(n, leaves - 1)
    real = (place[1:] < sizes[:, None]) & (rank != _NONE)
    tree[:, leaves : 2 * leaves - 1] = np.where(real, (np.where(real, rank, 0) << 8).astype(kind) | place[:-1], most)
    width = leaves
    while width > 1:
        width //= 2
        tree[:, width : 2 * width] = np.minimum(tree[:, 2 * width : 4 * width : 2], tree[:, 2 * width + 1 : 4 * width : 2])

    def put(rows: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
        node = at + leaves
        tree[rows, node] = value
        for _ in range(leaves.bit_length() - 1):
            value = np.minimum(value, tree[rows, node ^ 1])
            node = node >> 1
            tree[rows, node] = value

    def pair(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        right = after[rows, at]
        out = np.full(len(rows), most, dtype=kind)
        ok = np.flatnonzero(right < sizes[rows])
        found = pairs(token[rows[ok], at[ok]], token[rows[ok], right[ok]])
        known = found != _NONE
        ok, found = ok[known], found[known]
        out[ok] = (found << 8).astype(kind) | at[ok]
        return out

    rows = np.arange(n)
    while True:
        rows = rows[tree[rows, 1] != most]
        if not len(rows):
            break
        best = tree[rows, 1]
        at = best & 255
        right = after[rows, at]
        end = after[rows, right]
        token[rows, at] = best >> 8
        after[rows, at] = end
        inner = end < sizes[rows]
        before[rows[inner], end[inner]] = at[inner]
        put(rows, right, np.full(len(rows), most, dtype=kind))
        put(rows, at, pair(rows, at))
        left = before[rows, at]
        has = left >= 0
        put(rows[has], left[has], pair(rows[has], left[has]))
    live = np.zeros((n, leaves), dtype=bool)
    at = np.zeros(n, dtype=kind)
    rows = np.arange(n)
    while len(rows):
        live[rows, at] = True
        at = after[rows, at]
        keep = at < sizes[rows]
        rows, at = rows[keep], at[keep]
    return token[live].astype(np.int32), np.cumsum(live.sum(axis=1)).tolist()


class Encoder:
    """Splits texts by the pattern and encodes each match; remembers short pieces, up to a fixed number.

    The ids of a piece are kept as the bytes of 32-bit numbers, so that a text's ids are those of its pieces joined.
    """

    LEAVES = (8, 16, 32, 64)

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if missing := [i for i in range(256) if bytes([i]) not in ranks]:
            raise ValueError(f"no rank for single bytes {missing[:5]}")
        self.ranks, self.longest = ranks, max(map(len, ranks))
        self.single = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        self.pairs, self.split = PairTable(ranks), splitter(pattern)
        self.known: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of pieces not seen before."""
        names = list(pieces)
        raws = [piece.encode() for piece in names]
        whole = list(map(self.ranks.get, raws))
        found = {name: rank.to_bytes(4, sys.byteorder) for name, rank in zip(names, whole, strict=True) if rank is not None}
        rest = np.array([rank is None for rank in whole], dtype=bool)
        sizes = np.fromiter(map(len, raws), dtype=np.int64, count=len(raws))
        group = np.where(rest, np.searchsorted(self.LEAVES, sizes), -1)
        for i in np.flatnonzero(group == len(self.LEAVES)).tolist():
            found[names[i]] = np.array(merge(raws[i], self.ranks, self.longest), dtype=np.int32).tobytes()
        for k, leaves in enumerate(self.LEAVES):
            own = np.flatnonzero(group == k).tolist()
            for first in range(0, len(own), MANY):
                part = own[first : first + MANY]
                flat, ends = merged_rows([raws[i] for i in part], leaves, self.single, self.pairs)
                data, start = flat.tobytes(), 0
                for i, end in zip(part, ends, strict=True):
                    found[names[i]] = data[4 * start : 4 * end]
                    start = end
        return found

    def encode_bytes(self, texts: list[str | None]) -> list[bytes]:
        """Of each text its ids as the bytes of 32-bit numbers."""
        split = [self.split(text) if text else [] for text in texts]
        pieces = set(chain.from_iterable(split))
        if len(self.known) > CACHED_PIECES:
            self.known = {p: self.known[p] for p in pieces & self.known.keys()}
        new = self.learn(pieces.difference(self.known))
        self.known.update(new)
        out = [b"".join(map(self.known.__getitem__, row)) for row in split]
        for piece in new:
            if len(piece) > CACHED_CHARS:
                del self.known[piece]
        return out

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        return [np.frombuffer(row, dtype=np.int32).tolist() for row in self.encode_bytes(texts)]


def _int_lists(rows: list[bytes]) -> pa.Array:
    offsets = np.cumsum([0, *(len(row) // 4 for row in rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), dtype=np.int32)))


def _small(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a column has a few megabytes in each; a longer row stands alone."""
    for batch in batches:
        sizes = batch.column(column).value_lengths() if pa.types.is_list(batch.column(column).type) else pc.binary_length(batch.column(column))
        total = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False))
        first = 0
        while first < len(total):
            base = total[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(total, base + BATCH_BYTES, side="right")))
            yield batch.slice(first, last - first)
            first = last


def encode(
    frame: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text_col: str = "text",
    ids_col: str = "ids",
) -> DataFrame:
    """The frame's columns with the token ids of each whole text; null and empty texts have no ids.

    The result equals that of the vocabulary's library without special tokens:
    a match that is itself a token is that token, any other is merged. The
    rank table is shipped once by broadcast; its size is the vocabulary's. An existing
    column ``ids_col`` is replaced; repeated rows are encoded each.
    """
    table = frame.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(table.value, pattern)
        for batch in _small(batches, at):
            ids = _int_lists(encoder.encode_bytes(batch.column(at).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], schema=pa.schema([*batch.schema, pa.field(ids_col, ids.type)]))

    frame = frame.drop(ids_col) if ids_col != text_col else frame
    at = frame.columns.index(text_col)
    return frame.mapInArrow(run, StructType([*frame.schema, StructField(ids_col, ArrayType(IntegerType()))]))


def decode(frame: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """The frame's columns with the bytes that the ids stand for; null ids give no bytes. Unknown ids fail."""
    table = frame.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = [b""] * (max(table.value.values()) + 1)
        known = np.zeros(len(listed), dtype=bool)
        for token, rank in table.value.items():
            listed[rank], known[rank] = token, True
        tokens = pa.array(listed, type=pa.large_binary())
        for batch in _small(batches, at):
            column = batch.column(at).fill_null([])
            flat = column.flatten().to_numpy(zero_copy_only=False)
            if len(flat) and (flat.min() < 0 or flat.max() >= len(tokens) or not known[flat].all()):
                raise ValueError("ids outside the vocabulary")
            ends = np.cumsum([0, *column.value_lengths().to_numpy(zero_copy_only=False)])
            # The gathered tokens lie one after the other, so a row's bytes go from its first token's to its last's.
            gathered = tokens.take(pa.array(flat, type=pa.int64()))
            _, places, data = gathered.buffers()
            at_token = np.frombuffer(places, dtype=np.int64)[: len(flat) + 1] if len(flat) else np.zeros(1, dtype=np.int64)
            rows = pa.py_buffer(at_token[ends].astype(np.int64))
            out = pa.Array.from_buffers(pa.large_binary(), len(column), [None, rows, data]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, out], schema=pa.schema([*batch.schema, pa.field(bytes_col, out.type)]))

    frame = frame.drop(bytes_col)
    at = frame.columns.index(ids_col)
    return frame.mapInArrow(run, StructType([*frame.schema, StructField(bytes_col, BinaryType())]))


@functools.cache
def multilingual() -> tuple[dict[bytes, int], str]:
    """Ranks and pattern of the public multilingual byte-level vocabulary."""
    import public_tokenizers

    return load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


def digests(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text encoded and decoded: number of ids, SHA-256 of the ids and of the decoded bytes."""
    ranks, pattern = multilingual()
    coded = decode(encode(documents.select(id_col, text_col), ranks, pattern, text_col).drop(text_col), ranks)
    return coded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
