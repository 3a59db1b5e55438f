"""Periodic runs, fingerprints and the Merkle manifest against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from brightwater.llm import digest, merkle, periods
from brightwater.llm import text as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the workers do not have this module

# 11 periodic runs


def brute_runs(w, least=12):
    """Maximal stretches by period, each with its smallest."""
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e, q) for (s, e), q in found.items())


def odd_words(rng):
    kind, n, k = rng.randint(0, 5), rng.randint(0, 110), rng.choice([1, 2, 3, 6, 40])
    some = lambda m: [rng.randrange(k) for _ in range(m)]
    if kind == 0:
        return some(n)
    if kind == 1:
        return (some(rng.randint(1, 20)) * 30)[:n]
    if kind == 2:  # overlap-free, the usual trap for polynomial hashes
        w = [0]
        for _ in range(7):
            w = w + [1 - x for x in w]
        return w
    if kind == 3:  # Fibonacci words have as many runs as can be
        a, b = [0], [0, 1]
        for _ in range(rng.randint(1, 8)):
            a, b = b, b + a
        return b
    out = []
    while len(out) < n:
        p = some(rng.randint(1, 8))
        p = p * rng.randint(1, 4) + some(1) if kind == 4 else p
        out += (p * rng.randint(1, 7))[: rng.randint(1, 60)]
    return out


def ids_of(texts):
    flat = [(d, x) for d, w in enumerate(texts) for x in w]
    number = {v: i for i, v in enumerate(sorted(set(flat)))}
    return np.array([number[f] for f in flat], dtype=np.int64), np.cumsum([0, *map(len, texts)])


@pytest.mark.parametrize("seed", range(4))
def test_runs_are_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(120):
        texts = [odd_words(rng) for _ in range(rng.randint(1, 5))]
        ids, first = ids_of(texts)
        found = sorted(zip(*(c.tolist() for c in periods.runs_of(ids, first)), strict=True))
        want = sorted((a + int(first[d]), b + int(first[d]), p) for d, w in enumerate(texts) for a, b, p in brute_runs(w))
        assert found == want, texts


def test_runs_with_few_candidates_at_a_time(monkeypatch):
    monkeypatch.setattr(periods, "CANDIDATES", 3)
    rng = random.Random(9)
    for _ in range(20):
        w = odd_words(rng)
        ids, first = ids_of([w])
        assert sorted(zip(*(c.tolist() for c in periods.runs_of(ids, first)), strict=True)) == brute_runs(w)


@pytest.mark.parametrize("seed", range(3))
def test_grammar_derives_the_words_and_repeats_no_pair(seed):
    rng = random.Random(seed)
    texts = [odd_words(rng) for _ in range(8)]
    ids, first = ids_of(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    grammar = periods.Grammar(ids, doc, int(ids.max(initial=0)) + 1)

    def derive(symbol):
        rule = symbol - grammar.terminals
        return [symbol] if rule < 0 else derive(grammar.left[rule]) + derive(grammar.right[rule])

    assert [t for s in grammar.symbols.tolist() for t in derive(s)] == ids.tolist()
    for d in range(len(texts)):
        left = grammar.symbols[grammar.doc == d].tolist()
        seen, i = {}, 0
        for i in range(len(left) - 1):
            pair = (left[i], left[i + 1])
            assert pair not in seen or seen[pair] == i - 1 and left[i - 1] == left[i], "a pair stands twice"
            seen.setdefault(pair, i)


def collapse(words, runs):
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_periodic_runs_of_odd_documents(spark):
    rng = random.Random(5)
    texts = [" ".join(f"wé{x}" for x in odd_words(rng)) for _ in range(30)]
    texts += [None, "", " \t\n", "one", "a " * 5000, "b\x0bc\x1c " * 40, "x y z " * 4 + "x", texts[0], texts[0]]
    rows = [(i // 2, t, 1, "n", "c") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, runs int, n_words string, collapsed string").repartition(3)
    found = sorted((r.doc_id, r.n_words, [(x.start, x.start + x.length, x.period) for x in r.runs], r.collapsed) for r in periods.periodic_runs(frame).collect())
    want = []
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = brute_runs(words)
        want.append((i // 2, len(words), runs, collapse(words, runs)))
    assert found == sorted(want)
    assert periods.periodic_runs(frame.where("false")).collect() == []


def test_a_text_beyond_a_slice_is_taken_whole(spark, monkeypatch):
    words = [str(x) for x in range(300)] + ["p", "q", "r"] * 50
    frame = spark.createDataFrame([(None, " ".join(words)), (2, "z " * 12)], "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(T, "SLICE_BYTES", 64)
    found = {r.doc_id: r for r in periods.periodic_runs(frame).collect()}
    assert [tuple(x) for x in found[None].runs] == [(300, 150, 3)] and found[2].collapsed == "z"


# 12 fingerprints


def test_digests_read_back_and_are_bounded():
    texts = ["", "a", "ab", "abc", "the quick brown fox " * 30, "éè" * 500, "abc", "x" * 100_000]
    rows = digest._of(texts)
    marks = digest.written_out(rows)
    assert (digest.read_back(marks) == rows).all() and len({len(m) for m in marks}) == 1
    assert marks[3] == marks[6] and len(set(marks)) == len(texts) - 1
    near = digest.likeness(rows[:, None].repeat(len(texts), 1).reshape(-1, rows.shape[1]), np.tile(rows, (len(texts), 1)))
    near = near.reshape(len(texts), -1)
    assert near.min() >= 0 and near.max() <= 1 and (np.diag(near) == 1).all() and (near == near.T).all()


def test_long_texts_are_counted_piece_by_piece(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abc é") for _ in range(rng.choice([0, 1, 2, 3, 50, 400]))) for _ in range(30)]
    raw, bounds = T.text_bytes(pa.array(texts))
    whole = digest.bucket_counts(raw, bounds)
    assert whole.sum() == sum(max(0, len(t.encode()) - 2) for t in texts)
    monkeypatch.setattr(T, "SLICE_BYTES", 37)
    assert (digest.bucket_counts(raw, bounds) == whole).all()


def edit(text, following):
    return text[: len(text) - 2] + following[:2]


@pytest.mark.parametrize("count", [1, 2, 60])
def test_comparison_with_the_next_document(spark, count):
    rng = random.Random(count)
    texts = [rng.choice([None, "", "a", "text of some length " * rng.randint(1, 20), "été " * rng.randint(1, 9)]) for _ in range(count)]
    rows = [(i * 3, t, 1, "x", "h") for i, t in enumerate(texts)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string, n int, id string, part string").repartition(7)
    found = {r.doc_id: r for r in digest.compare_with_next(frame, edit).collect()}
    assert len(found) == count
    for i, t in enumerate(texts):
        t, after = t or "", texts[(i + 1) % count] or ""
        one, other, following = digest._of([t, edit(t, after), after])
        r = found[i * 3]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edit(t, after).encode()).hexdigest())
        assert [r.fingerprint, r.edited_fingerprint] == digest.written_out(np.array([one, other]))
        assert r.near_edited == digest.likeness(one[None], other[None])[0] and r.near_next == digest.likeness(one[None], following[None])[0]


def test_repeated_and_missing_ids_follow_each_other(spark):
    rows = [(None, "same")] * 40 + [(7, "seven")] * 3 + [(7, "other")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    found = digest.compare_with_next(frame, edit).collect()
    assert sum(r.doc_id is None and r.near_next == 1 for r in found) == 39 and len(found) == 44
    assert digest.compare_with_next(frame.where("false"), edit).collect() == []
    marks = {(r.doc_id, r.n_chars, r.fingerprint) for r in digest.fingerprints(frame).collect()}
    assert {(r.doc_id, r.n_chars, r.fingerprint) for r in found} == marks and len(marks) == 3


# 13 Merkle manifest


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(levels[-1][i : i + arity]) for i in range(0, len(levels[-1]), arity)])
    return levels


def steps_at(levels, i, arity):
    steps = []
    for nodes in levels[:-1]:
        a = i // arity * arity
        steps.append(("".join(nodes[a:i]), "".join(nodes[i + 1 : a + arity])))
        i //= arity
    return steps


def leaf(values):
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


@pytest.mark.parametrize(("arity", "levels"), [(16, 2), (2, 1), (3, 2)])
def test_manifest_is_brute_force(spark, arity, levels):
    rng = random.Random(arity)
    sizes = {None: 5, "": 1, "one": 1, "full": arity**levels, "more": arity**levels + 1, "é": 17, "Z": 16, "a": 120}
    rows = [(i, s, rng.choice([None, "", "Téxt", "b" * rng.randint(0, 9)])) for s, n in sizes.items() for i in rng.sample(range(1000), n)]
    rows += [(None, "a", "x"), (None, "a", "y"), (5000, "a", "twice"), (5000, "a", "twice"), (None, None, None)]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(*r, "c", 1, 2) for r in rows], "doc_id long, source string, text string, tree string, pos int, digest int").repartition(5)
    found = merkle.manifest(frame, ["doc_id", "source", "text"], arity=arity, levels=levels, carry={"id": F.col("text")})
    found = found.withColumns({"proof": merkle.proof_digest(F.col("steps")), "back": merkle.folded(F.col("leaf"), F.col("steps"))}).collect()
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append((r[0], leaf([r[0], r[1], r[2]]), r[2]))
    ordered = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in ordered:
        by_source[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append(levels_of([x[1] for x in by_source[s]], arity))
    top = levels_of([t[-1][0] for t in trees], arity)
    want = []
    for k, (s, tree) in enumerate(zip(ordered, trees, strict=True)):
        for i, (doc_id, digest_, text) in enumerate(by_source[s]):
            steps = steps_at(tree, i, arity) + steps_at(top, k, arity)
            want.append((str(doc_id), digest_, tree[-1][0], top[-1][0], steps, str(text), h(a + b for a, b in steps)))
    got = [(str(r.doc_id), r.leaf, r.subroot, r.root, [tuple(x) for x in r.steps], str(r.id), r.proof) for r in found]
    assert sorted(got) == sorted(want)
    assert {r.back for r in found} == {top[-1][0]}


def test_manifest_of_little(spark):
    frame = spark.createDataFrame([(1, "s", "t")], "doc_id long, source string, text string")
    (only,) = merkle.manifest(frame, ["doc_id", "text"]).collect()
    assert only.leaf == only.subroot == only.root == leaf([1, "t"]) and only.steps == []
    assert merkle.manifest(frame.where("false"), ["doc_id", "text"]).collect() == []


def test_op13_verifies_untampered_rows_only(spark, sf_dir):
    import zlib

    from brightwater.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op13_merkle"](spark, sf_dir).collect():
        tampered = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and re.search("[A-Z]", texts[r.doc_id] or "")
        assert r.verified == (not tampered)
