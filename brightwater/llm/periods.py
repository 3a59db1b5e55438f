"""Periodic runs of words: a Re-Pair grammar, runs at each nonterminal's boundary, translated to the text and merged."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwater.llm import text as T

MIN_WORDS = 12
CANDIDATES = 1 << 18
_PRIMES, _BASES = (2_147_483_647, 2_147_483_629), (1_103_515_245, 1_664_525_013)


class Grammar:
    """Re-Pair over the word ids of many documents at once; ids of different documents differ.

    Every round replaces a document's most frequent pair of neighbours by a new symbol, and with it all pairs
    that no neighbouring pair exceeds (by count, then number), until no pair
    stands twice without overlap. ``left, right, at, size`` describe the rules (``at`` is the word position of the first
    occurrence); ``symbols, places`` are the sequence that is left.
    """

    def __init__(self, ids: np.ndarray, doc: np.ndarray, terminals: int):
        self.terminals = terminals
        left, right, at, size = [], [], [], []
        lengths = np.ones(terminals, dtype=np.int64)
        symbols, places = ids.astype(np.int64), np.arange(len(ids))
        alive = np.zeros(len(ids), dtype=bool)  # pairs that may stand twice, by their first position
        alive[:-1] = doc[1:] == doc[:-1]
        while True:
            total = len(lengths)
            i = np.flatnonzero(alive)
            codes, pair = np.unique(symbols[i] * total + symbols[i + 1], return_inverse=True)
            # Stretches of one pair, as in aaaa: every other one counts.
            begins = np.ones(len(i), dtype=bool)
            begins[1:] = (i[1:] != i[:-1] + 1) | (pair[1:] != pair[:-1])
            stretch = np.cumsum(begins) - 1
            first = np.flatnonzero(begins)
            usable = (np.arange(len(i)) - first[stretch]) % 2 == 0
            count = np.bincount(pair[usable], minlength=len(codes))
            live = count[pair] >= 2
            weight = np.where(live, count[pair] << 32 | pair, -1)[first]
            ends = np.append(first[1:], len(i)) - 1
            touches = i[first[1:]] == i[ends[:-1]] + 1 if len(first) > 1 else np.zeros(0, dtype=bool)
            best = weight >= 0
            best[1:] &= ~touches | (weight[1:] > weight[:-1])
            best[:-1] &= ~touches | (weight[:-1] > weight[1:])
            chosen = best[stretch] & usable
            often = np.bincount(pair[chosen], minlength=len(codes)) >= 2
            chosen &= often[pair]
            if not chosen.any():
                break
            number = np.cumsum(often) - 1 + total
            here, own = i[chosen], pair[chosen]
            left.append(codes[often] // total)
            right.append(codes[often] % total)
            begin = np.empty(len(codes), dtype=np.int64)
            begin[own[::-1]] = places[here[::-1]]
            at.append(begin[often])
            lengths = np.concatenate([lengths, lengths[left[-1]] + lengths[right[-1]]])
            # A pair stays possible if it was live; one with a new symbol becomes so.
            alive[i[~live]] = False
            inside = np.zeros(len(symbols), dtype=bool)
            inside[here] = True
            joined = alive.copy()
            joined[here] = (here + 2 < len(doc)) & (doc[np.minimum(here + 2, len(doc) - 1)] == doc[here])
            follows = here[here > 0]
            joined[follows - 1] = doc[follows - 1] == doc[follows]
            symbols[here] = number[own]
            keep = np.ones(len(symbols), dtype=bool)
            keep[here + 1] = False
            symbols, places, doc, alive = symbols[keep], places[keep], doc[keep], joined[keep]
        self.symbols, self.places, self.doc = symbols, places, doc
        empty = [np.zeros(0, dtype=np.int64)]
        self.left, self.right, self.at = (np.concatenate(x or empty) for x in (left, right, at))
        self.lengths = lengths

    def boundaries(self, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``owner, low, middle, high``: each rule's boundary once, at its first occurrence (owner: the rule's number), and those
        between the symbols that are left, each document's in a balanced binary tree (owner -1)."""
        rules = np.arange(len(self.at))
        low = self.at
        high = low + self.lengths[self.terminals :]
        middle = low + self.lengths[self.left]
        rows = np.searchsorted(self.doc, np.arange(len(first)))  # of each document the first symbol; one more than documents
        inner = np.arange(len(self.doc)) - rows[self.doc]
        node = np.flatnonzero(inner > 0)
        step = inner[node] & -inner[node]
        end = np.minimum(inner[node] + step, (rows[1:] - rows[:-1])[self.doc[node]]) + rows[self.doc[node]]
        places = np.append(self.places, first[-1])
        stop = np.where(end == rows[self.doc[node] + 1], first[self.doc[node] + 1], places[end])
        return (
            np.concatenate([rules, np.full(len(node), -1)]),
            np.concatenate([low, places[node - step]]),
            np.concatenate([middle, places[node]]),
            np.concatenate([high, stop]),
        )

    def translate(self, owner: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
        """Runs of rules (relative to the rule) at every place where the text derives the rule: start, end, period."""
        order = np.argsort(owner, kind="stable")
        owner, start, end, period = owner[order], start[order], end[order], period[order]
        rules = len(self.left)
        begins = np.searchsorted(owner, np.arange(rules + 1))
        wanted = np.zeros(self.terminals + rules, dtype=bool)
        wanted[self.terminals + owner] = True
        depth = True
        while depth:  # also the rules that derive them
            more = wanted[self.left] | wanted[self.right] | wanted[self.terminals :]
            depth = (more != wanted[self.terminals :]).any()
            wanted[self.terminals :] = more
        some = wanted[self.symbols]
        symbols, places = self.symbols[some], self.places[some]
        out = [[np.zeros(0, dtype=np.int64)] for _ in range(3)]
        while len(symbols):
            rule = symbols - self.terminals
            counts = begins[rule + 1] - begins[rule]
            k = np.repeat(begins[rule], counts) + _within(counts)
            base = np.repeat(places, counts)
            for column, value in zip(out, (base + start[k], base + end[k], period[k]), strict=True):
                column.append(value)
            left, right = self.left[rule], self.right[rule]
            symbols, places = np.concatenate([left, right]), np.concatenate([places, places + self.lengths[left]])
            some = wanted[symbols]
            symbols, places = symbols[some], places[some]
        return tuple(map(np.concatenate, out))


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each of consecutive groups of the given sizes."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


class Extensions:
    """How far the words at two places go on alike, by two polynomial hashes modulo primes (62 bits)."""

    def __init__(self, ids: np.ndarray):
        self.sums, self.powers = [], []
        values = T.mix(ids.astype(np.uint64) + np.uint64(1))
        for p, b, shift in zip(_PRIMES, _BASES, (33, 1), strict=True):
            power, filled = np.ones(len(ids) + 1, dtype=np.int64), 1
            while filled < len(power):
                more = min(filled, len(power) - filled)
                power[filled : filled + more] = power[:more] * pow(b, filled, p) % p
                filled += more
            value = ((values >> np.uint64(shift)) & np.uint64(0x3FFFFFFF)).astype(np.int64)
            self.sums.append(np.concatenate([[0], np.cumsum(value * power[:-1] % p)]))
            self.powers.append(power)

    def equal(self, one: np.ndarray, other: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``size`` words from ``one`` on equal those from ``other`` (to the right of it) on."""
        same = np.ones(len(one), dtype=bool)
        for p, total, power in zip(_PRIMES, self.sums, self.powers, strict=True):
            a = (total[one + size] - total[one]) % p * power[other - one] % p
            same &= a == (total[other + size] - total[other]) % p
        return same

    def reach(self, one: np.ndarray, other: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """The most words (up to ``most``) alike from the two places on, or before them."""
        found = np.zeros(len(one), dtype=np.int64)
        step = 1 << max(0, int(most.max(initial=0)).bit_length() - 1)
        while step:
            k = np.flatnonzero(found + step <= most)
            shift = -(found[k] + step) if back else found[k]
            found[k[self.equal(one[k] + shift, other[k] + shift, np.full(len(k), step))]] += step
            step >>= 1
        return found


def runs_of(ids: np.ndarray, first: np.ndarray, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs as ``start, end, period``, ordered by start and period; document d has words first[d] to first[d + 1].

    A run is a maximal stretch with smallest period q, ``min_words`` long at least and 2 * q at least.
    """
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    none = np.zeros(0, dtype=np.int64)
    if len(ids) < 2:
        return none, none, none
    grammar = Grammar(ids, doc, int(ids.max()) + 1)
    owner, low, middle, high = grammar.boundaries(first)

    # A run over a boundary has six words or more that recur one period on, among them the boundary's word with the
    # two after or before it: the other places of these two triples, within the node, are the candidates.
    triple = T.mix(T.mix(T.mix(ids[:-2].astype(np.uint64)) + ids[1:-1].astype(np.uint64)) + ids[2:].astype(np.uint64))
    triple[doc[:-2] != doc[2:]] = T.mix(np.arange(len(triple), dtype=np.uint64))[doc[:-2] != doc[2:]]
    order = np.argsort(triple, kind="stable")
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = triple[order[1:]] != triple[order[:-1]]
    number = np.cumsum(fresh) - 1
    group = np.empty(len(order), dtype=np.int64)
    group[order] = number
    span = len(ids) + 1
    sorted_places = number * span + order
    extend = Extensions(ids)
    need = lambda q: np.maximum(min_words - q, q)  # noqa: E731  words that recur
    found: list[tuple[np.ndarray, ...]] = []
    several = np.bincount(number, minlength=1) > 1
    for shift in (0, -2):
        place = middle + shift
        here = np.flatnonzero((place >= low) & (place + 3 <= high))
        here = here[several[group[place[here]]]]
        begin = np.searchsorted(sorted_places, group[place[here]] * span + low[here])
        counts = np.searchsorted(sorted_places, group[place[here]] * span + high[here] - 3, side="right") - begin
        total = np.cumsum(counts)
        a = 0
        while a < len(here):
            z = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + CANDIDATES, side="right")))
            k = np.repeat(np.arange(a, z), counts[a:z])
            x = order[begin[k] + _within(counts[a:z])] - shift
            node = here[k]
            b = middle[node]
            u, v = np.minimum(b, x), np.maximum(b, x)
            q = v - u
            half = (need(q) + 1) // 2  # of the words that recur one side of the boundary has half
            ok = np.flatnonzero(q > 0)
            node, u, v, half = node[ok], u[ok], v[ok], half[ok]
            after, before = v + half <= high[node], u - half >= low[node]
            likely = np.zeros(len(ok), dtype=bool)
            for fits, move in ((after, 0), (before, 1)):
                f = np.flatnonzero(fits & ~likely)
                likely[f] = extend.equal(u[f] - move * half[f], v[f] - move * half[f], half[f])
            node, u, v = node[likely], u[likely], v[likely]
            back = extend.reach(u, v, u - low[node], back=True)
            ahead = extend.reach(u, v, high[node] - v, back=False)
            is_run = back + ahead >= need(v - u)
            found.append(tuple(c[is_run] for c in (owner[node], low[node], u - back, v + ahead, v - u)))
            a = z
    owner, low, start, end, period = (np.concatenate([f[c] for f in found] or [none]) for c in range(5))

    # The smallest period of each stretch of a node; its multiples have the same stretch.
    sort = np.lexsort((period, end, start, owner))
    owner, low, start, end, period = (c[sort] for c in (owner, low, start, end, period))
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    owner, low, start, end, period = (c[new] for c in (owner, low, start, end, period))
    ruled = owner >= 0
    moved = grammar.translate(owner[ruled], (start - low)[ruled], (end - low)[ruled], period[ruled])
    start, end, period = (np.concatenate([c[~ruled], m]) for c, m in zip((start, end, period), moved, strict=True))
    return _merged(start, end, period)


def _merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal intervals: those of one period that share a period's words are parts of one run."""
    if not len(start):
        return start, end, period
    sort = np.lexsort((end, start, period))
    start, end, period = start[sort], end[sort], period[sort]
    width = int(end.max()) + 1
    level = np.cumsum(np.concatenate([[0], period[1:] != period[:-1]])) * width
    so_far = np.maximum.accumulate(end + level) - level  # greatest end of this period so far
    new = np.ones(len(start), dtype=bool)
    new[1:] = (period[1:] != period[:-1]) | (start[1:] + period[1:] > so_far[:-1])
    heads = np.flatnonzero(new)
    start, end, period = start[heads], np.maximum.reduceat(end, heads), period[heads]
    sort = np.lexsort((period, end, start))
    start, end, period = start[sort], end[sort], period[sort]
    least = np.ones(len(start), dtype=bool)
    least[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[least], end[least], period[least]
    sort = np.lexsort((period, start))
    return start[sort], end[sort], period[sort]


def periodic_runs(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Runs of words that repeat with a period, and the text with one period of each run left.

    One row per input row: ``id_col, n_words, runs, collapsed``; ``runs`` lists ``start, length, period`` (in
    words from 0) by start and period. A run is a stretch of at least ``min_words`` words and
    two periods, maximal for its smallest period. ``collapsed`` joins by one space the words that no run contains after its
    first period. Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, unchanged; null and empty texts have no words, no
    runs and an empty result. Rows that repeat an id are taken each; other columns are not read, an empty table gives no rows.

    Each document is worked alone, with no shuffle; a task holds a few megabytes of texts, or one longer text.
    """
    kind = documents.schema[id_col].dataType.simpleString()
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = T.text_bytes(batch.column(1))
            for a, z in T.row_slices(bounds):
                part, cut = raw[bounds[a] : bounds[z]], bounds[a : z + 1] - bounds[a]
                starts, ends, first = T.word_spans(part, cut)
                sizes = np.diff(first)
                words = T.hash_spans(part, starts, ends) + T.mix(np.repeat(np.arange(z - a, dtype=np.uint64), sizes))
                ids = np.unique(words, return_inverse=True)[1]
                start, end, period = runs_of(ids, first, min_words)
                row = np.searchsorted(first, start, side="right") - 1
                gone = np.zeros(len(ids) + 1, dtype=np.int64)
                np.add.at(gone, start + period, 1)
                np.add.at(gone, end, -1)
                kept = np.cumsum(gone)[:-1] == 0
                has_runs = np.zeros(z - a, dtype=bool)
                has_runs[row] = True
                view, texts = part.tobytes(), []
                for k in range(z - a):
                    own = view[cut[k] : cut[k + 1]].split()
                    texts.append(b" ".join(compress(own, kept[first[k] : first[k + 1]].tolist()) if has_runs[k] else own))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(row, np.arange(z - a + 1)), type=pa.int32()),
                    pa.StructArray.from_arrays([pa.array(start - first[row]), pa.array(end - start), pa.array(period)], fields=list(run_type)),
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, z - a), pa.array(sizes, type=pa.int64()), lists, pa.array(texts, type=pa.binary()).cast(pa.string())],
                    names=[id_col, "n_words", "runs", "collapsed"],
                )

    return documents.select(id_col, F.col(text_col)).mapInArrow(
        run, f"`{id_col}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )
