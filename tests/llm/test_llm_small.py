"""The operators against brute force on small tables: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brightwater.llm import bpe, embeddings, exact, html, lines, minhash, mixing, quality, secrets, substrings
from brightwater.llm import text as T
from brightwater.llm.components import components
from brightwater.llm.fmindex import FMIndex

DOCS = "doc_id long, text string, source string, lang string, n_chars long, id string, node long, fp long"


def docs(spark, texts, ids=None, sources=None):
    ids = ids or list(range(len(texts)))
    sources = sources or ["s"] * len(texts)
    rows = [(i, t, s, "en", len(t or ""), "clash", 7, 8) for i, t, s in zip(ids, texts, sources, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


# words and hashes


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab é\t\n\x0b\x1c", max_size=12)), max_size=6))
def test_word_spans_and_hashes(texts):
    raw, bounds = T.text_bytes(pa.array(texts, pa.string()))
    starts, ends, first = T.word_spans(raw, bounds)
    found = [[raw[s:e].tobytes().decode() for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(first[:-1], first[1:])]
    assert found == [words(t) for t in texts]
    hashes = T.hash_spans(raw, starts, ends)
    flat = [w for row in found for w in row]
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))


def test_components_follow_long_paths(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 103), (103, 100), (103, 103), (None, 5)]
    found = {r.id: r.component_id for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 103: 100}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# 1 lines


def drop_lines(texts, run):
    """Brute force over documents in id order; short texts end in marks."""
    rows = [(i, t.split("\n") if t is not None else []) for i, t in texts]
    seen, gone = {}, set()
    for i, ls in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ended = ls + [None] * (run - len(ls)) if ls else []
        for p in range(len(ended) - run + 1):
            key = tuple(ended[p : p + run])
            if key in seen:
                gone |= {(i, p + k) for k in range(run)}
            seen.setdefault(key, (i, p))
    return {i: "\n".join(x for k, x in enumerate(ls) if (i, k) not in gone) for i, ls in rows}


@pytest.mark.parametrize("run", [1, 2, 3, 5])
def test_line_dedup_is_brute_force(spark, run):
    rng = random.Random(run)
    texts = ["\n".join(rng.choice("abc") for _ in range(rng.randrange(0, 14))) for _ in range(30)] + [None, "", "\n\n\n\n", "a\n" * 300]
    found = by_id(lines.drop_repeated_lines(docs(spark, texts), run=run))
    assert {i: r.text for i, r in found.items()} == drop_lines(list(enumerate(texts)), run)
    assert all(r.n_lines == len((texts[i] or "").split("\n")) * (texts[i] is not None) for i, r in found.items())


def test_line_dedup_repeats_null_ids_and_runs(spark):
    same = docs(spark, ["x\ny\nz", "x\ny\nz", "q\nx\ny\nz\nr"], ids=[1, 1, None])
    out = sorted((str(r.doc_id), r.text) for r in lines.drop_repeated_lines(same, run=3).collect())
    assert out == [("1", ""), ("1", ""), ("None", "q\nx\ny\nz\nr")]
    runs = lines.repeated_runs(docs(spark, ["a\nb\nc\nd", "z\na\nb\nc\nd\na\nb"]), run=2).collect()
    assert sorted((r.id, r.first_line, r.n_lines, r.from_id, r.from_line) for r in runs) == [(1, 1, 4, 0, 0), (1, 5, 2, 0, 0)]
    assert lines.drop_repeated_lines(docs(spark, []), run=3).collect() == []
    assert lines.repeated_runs(docs(spark, ["a", None]), run=3).collect() == []


def test_line_dedup_numbers_rows_without_id_and_takes_short_texts(spark):
    found = lines.drop_repeated_lines(docs(spark, ["p\nq\nr\ns"] * 5 + ["p", "p", "q\nr", "x\nq\nr"], ids=[None] * 4 + [1, 2, 3, 4, 5]), run=3)
    out = sorted((str(r.doc_id), r.text, r.n_lines, r.n_removed) for r in found.collect())
    assert out == [
        ("1", "", 4, 4), ("2", "p", 1, 0), ("3", "", 1, 1), ("4", "q\nr", 2, 0), ("5", "x\nq\nr", 3, 0),
        *[("None", "", 4, 4)] * 3, ("None", "p\nq\nr\ns", 4, 0),
    ]


@pytest.mark.parametrize("run", [1, 2, 4])
def test_line_runs_are_maximal(spark, run):
    """Every run equals its source and ends where they part; together they are the windows that stand earlier."""
    rng = random.Random(40 + run)
    texts = ["\n".join(rng.choice("abcd") for _ in range(rng.randrange(run, 25))) for _ in range(20)]
    texts += [texts[3], texts[4] + "\n" + texts[5], "a\n" * 90, "b\n" + "a\n" * 60]
    split = [t.split("\n") for t in texts]
    seen, want = set(), set()
    for i, ls in enumerate(split):
        for p in range(len(ls) - run + 1):
            if tuple(ls[p : p + run]) in seen:
                want |= {(i, p + k) for k in range(run)}
            seen.add(tuple(ls[p : p + run]))
    covered, last = set(), {}
    for r in sorted(lines.repeated_runs(docs(spark, texts), run=run).collect(), key=lambda r: (r.id, r.first_line)):
        mine, theirs = split[r.id][r.first_line :], split[r.from_id][r.from_line :]
        assert (r.from_id, r.from_line) < (r.id, r.first_line)
        assert mine[: r.n_lines] == theirs[: r.n_lines] and r.n_lines >= run
        assert r.n_lines == min(len(mine), len(theirs)) or mine[r.n_lines] != theirs[r.n_lines]
        assert r.first_line + r.n_lines > last.get(r.id, -1)
        last[r.id] = r.first_line + r.n_lines
        covered |= {(r.id, r.first_line + k) for k in range(r.n_lines)}
    assert covered == want


# 2 mixing


def test_mixing_meets_targets_and_spreads_sources(spark):
    rng = random.Random(3)
    texts = [" ".join("w" for _ in range(rng.randrange(0, 400))) for _ in range(120)] + [None, ""]
    sources = [rng.choice(["a", "b", None, "é"]) for _ in texts]
    frame = docs(spark, texts, sources=sources)
    plan, taken = mixing.mix(frame, block_words=64)
    rows = taken.collect()
    assert len(rows) == len(texts) and all(r["size"] == len(words(texts[r.id])) for r in rows)
    for name in set(sources):
        own = [r for r in rows if r.source == name]
        assert sum(r["size"] for r in own) == own[0].source_size
        assert sum(r.taken for r in own) == int(own[0].target)
        assert all(r.taken <= 2 * r["size"] for r in own)
    total = sum(r["size"] for r in rows)
    targets = {r.source: (r.target, r.source_size) for r in rows}
    assert sum(t for t, _ in targets.values()) == pytest.approx(1.5 * total)
    # Brute force: share by weight, stop at twice the size, share the excess again.
    order = sorted([s for s in targets if s is not None]) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want, open_ = dict.fromkeys(order, 0.0), set(order)
    rest = 1.5 * total
    while open_ and rest > 1e-9:
        share = rest / sum(weight[s] for s in open_)
        rest = 0.0
        for s in list(open_):
            want[s] += share * weight[s]
            if want[s] >= 2 * targets[s][1]:
                rest += want[s] - 2 * targets[s][1]
                want[s] = 2.0 * targets[s][1]
                open_.discard(s)
    assert {s: t for s, (t, _) in targets.items()} == pytest.approx(want)
    assert sum(r.words for r in plan.collect()) == sum(r.taken for r in rows)
    # Any long stretch of the schedule holds the sources near their shares.
    slots = sorted({(r.position, r.source) for r in plan.collect()}, key=lambda x: x[0])
    half = slots[: len(slots) // 2]
    for name in order:
        share = sum(s == name for _, s in slots) / len(slots)
        assert abs(sum(s == name for _, s in half) / len(half) - share) < 0.1
    again = mixing.mix(frame.repartition(7), block_words=64, broadcast_sources=0)[1].collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_mixed_documents_are_whole_but_for_the_last(spark):
    texts = ["a b  c", "d e\nf g", "h", None, ""]
    out = mixing.mixed_documents(docs(spark, texts, sources=["x", "x", "y", "y", "y"]), block_words=2)
    assert out.columns == docs(spark, texts).columns
    got = out.collect()
    assert all(r.n_chars == len(r.text) and texts[r.doc_id].startswith(r.text) for r in got)
    x = sum(len(words(r.text)) for r in got if r.source == "x")
    _, taken = mixing.mix(docs(spark, texts, sources=["x", "x", "y", "y", "y"]), block_words=2)
    assert x == sum(r.taken for r in taken.collect() if r.source == "x")
    empty_plan, empty = mixing.mix(docs(spark, []))
    assert empty.collect() == [] and empty_plan.collect() == []
    assert mixing.mix(docs(spark, [None, ""]))[1].count() == 2


def test_mixed_documents_follow_the_schedule_and_stay_whole(spark):
    rng = random.Random(5)
    texts = [" ".join("w" for _ in range(rng.randrange(1, 300))) for _ in range(90)]
    sources = ["abc"[i % 3] for i in range(90)]
    frame = docs(spark, texts, sources=sources)
    plan, taken = mixing.mix(frame, block_words=64)
    first = {}
    for r in plan.collect():
        at, got = first.get((r.id, r.epoch), (r.position, 0))
        first[r.id, r.epoch] = (min(at, r.position), got + r.words)
    want = sorted((at, hashlib.md5(str(i).encode()).hexdigest(), i) for (i, _), (at, got) in first.items() if 2 * got >= len(words(texts[i])))
    out = mixing.mixed_documents(frame, whole=True, block_words=64).collect()
    assert [r.doc_id for r in out] == [i for _, _, i in want]
    assert all(r.text == texts[r.doc_id] for r in out)
    targets = {r.source: r.target for r in taken.collect()}
    for name, target in targets.items():
        assert abs(sum(len(words(r.text)) for r in out if r.source == name) - target) <= 150


# 3 secrets


BASE = {
    "assign": re.compile(r"""(?:%s)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""" % secrets.KEYS),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def base_spans(text):
    found = []
    for kind, least in (("assign", 12), ("access", 18), ("hex", 16)):
        for m in BASE[kind].finditer(text or ""):
            if len(m[1] if kind == "assign" else m[0]) >= least:
                found.append((m.start(), list(BASE).index(kind), f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(found)]


def test_secret_spans_are_brute_force(spark):
    rng = random.Random(5)
    parts = ["PassWord", "token", "Secret", "api_key", "APIKEY", "passwd", ": ", " = ", '"', "'", "=", ":", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "é", " ", "\n", "short", "ſecret=abcdefghijklmnop", "x" * 13]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(150)] + [None, "", "f" * 5000]
    found = by_id(secrets.find_secrets(docs(spark, texts), F.col("source"), F.col("lang")))
    assert len(found) == len(texts)
    for i, row in found.items():
        assert [f"{s.kind}:{s.start}:{s.end}" for s in row.secrets if s["rank"] < 3] == base_spans(texts[i])


def test_ownership_parts_live_from_copied(spark):
    live, copied = "Zq8Kd02mXv7Lp4Rt9Ws1Yb6Nc", "Ab1Cd2Ef3Gh4Ij5Kl6Mn7Op8Q"
    texts = [f"use {live} here", f"also {live}", *[f"docs say {copied} always"] * 4, f"token = {copied}"]
    frame = docs(spark, texts, sources=["r1", "r2", "r1", "r2", "r3", "r4", "r5"])
    found = by_id(secrets.find_secrets(frame, F.col("source"), F.when(F.col("doc_id") < 2, "me").otherwise(F.col("source"))))
    assert [(s.kind, s.owners, s.repositories, s.verdict) for s in found[0].secrets] == [("owned", 1, 2, "live")]
    assert found[2].secrets == [] and [(s.kind, s.verdict) for s in found[6].secrets] == [("assign", "copied")]
    assert secrets.find_secrets(docs(spark, []), F.col("source"), F.col("lang")).collect() == []


# 4 html


PAGES = [
    ("<html><body><nav><ul><li><a>Home</a></ul></nav><article><h1>T&amp;U</h1><p>One <b>two</b>\n three<br>four<p>Last.</article><footer>x</footer>", "T&U\nOne two three four\nLast."),
    ("<article><p>A b c.</p><aside>side</aside><script>p('</p>')</script><ul><li>item</li></ul><p>End</p></article><section class=comments><article><p>me too</p></article></section>", "A b c.\nitem\nEnd"),
    ("<div class='cookie-notice'>We use cookies</div><div><h2>Title here</h2><p>Some words that matter a lot.</p><p>More.</p></div><form>Name</form><div id=sidebar>links</div>", "Title here\nSome words that matter a lot.\nMore."),
    ("", ""),
    (None, ""),
    ("<p>unclosed &lt;tag&gt; &am", "unclosed <tag> &am"),
    ("<<<>>><article>broken <b <p>text</article", None),
]


def test_main_text_of_pages(spark):
    rows = [(i, "u", h, 1, "x") for i, (h, _) in enumerate(PAGES)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, tile long, text string")
    out = {r.page_id: r.text for r in html.extract(frame).collect()}
    assert all(out[i] == want for i, (_, want) in enumerate(PAGES) if want is not None)
    assert html.extract(frame.limit(0)).collect() == []
    assert html.main_text("<p>" + "word " * 200_000, {}).count("word") == 200_000


LONG = "word " * 59 + "word"
WHOLE = [
    (f"<article><h1>A headline of five words</h1><div class='{{}}'>{LONG}</div><p>{LONG}</p></article>", f"A headline of five words\n{LONG}", ["notice", "newsletter-box", "share-bar", "ad", "google_ad_1"]),
    (f"<article><p>{LONG}</p><aside>{LONG * 3}</aside><p>The {{}} end.</p></article>", f"{LONG}\nThe {{}} end.", ["short"]),
    (f"<article><p>{LONG}</p></article><div class=ad>{LONG * 9}</div><article><p>{{}} part.</p></article>", f"{LONG}\n{{}} part.", ["Second"]),
    (f"<h1>A headline of five words</h1><div class={{}}><p>{LONG}</p></div><p>{LONG}</p>", f"A headline of five words\n{LONG}", ["notice"]),
    (f"<body><form id={{}}><nav>x</nav><article><p>{LONG}</p></article></form></body>", LONG, ["aspnetForm"]),
    (f"<body><form><fieldset><div class={{}}><p>{LONG}</p></div></fieldset></form></body>", LONG, ["content"]),
    (f"<article><p>{LONG}</p><form class={{}}>Your name</form></article>", LONG, ["f"]),
    (f"<div><h2 id={{}}>Head of several words</h2><p>{LONG}</p></div>", f"Head of several words\n{LONG}", ["discussion", "social", "notice", "menu", "search"]),
    (f"<article><div class={{}}>{LONG}</div></article>", LONG, ["social-history", "alert-mechanisms", "menu_planning", "cookieRecipes", "has-sidebar", "search-algorithms"]),
    (f"<section id={{}}><h2>Head of several words</h2><p>{LONG}</p></section>", f"Head of several words\n{LONG}", ["discussion", "social"]),
    (f"<p>{LONG}</p><section class={{}}><article>me too</article></section>", LONG, ["comments", "post-comments", "discussion"]),
]


def test_articles_are_whole_around_cut_parts_forms_and_names():
    for page, want, names in WHOLE:
        for name in names:
            assert html.main_text(page.format(name), {"form": -2.0}) == want.format(name), page.format(name)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.floats(-3, 3), max_size=12))
def test_best_run_is_the_maximum(scores):
    a, b = html.best_run(scores)
    best = max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=0)
    assert sum(scores[a:b]) == pytest.approx(max(best, 0))


# 5 BPE


@pytest.fixture(scope="module")
def vocabulary():
    ranks, pattern = bpe.multilingual()
    return bpe.Encoder(ranks, pattern), tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.sampled_from("abdehlt 's'\n\t\x1c\r!1é　٣😀"), st.characters(blacklist_categories=["Cs"])), max_size=60))
def test_encoding_equals_the_library(vocabulary, text):
    own, library = vocabulary
    assert own.encode([text, None, ""]) == [library.encode_ordinary(text), [], []]


def test_long_pieces_and_both_forms_of_the_tree(vocabulary):
    own, library = vocabulary
    for text in ("a" * 30_000, " " * 5000 + "x", "ab" * 4000, "ünï" * 3000, "x" * 64, "y" * 65):
        assert own.encode([text]) == [library.encode_ordinary(text)]
    rng = random.Random(1)
    pieces = ["".join(rng.choice("etaoiné") for _ in range(rng.randrange(2, 30))).encode()[:64] for _ in range(300)]
    assert bpe.merge_many(pieces, 64, own.single, own.pairs) == [tuple(bpe.merge(p, own.ranks, own.longest)) for p in pieces]


def test_encoding_round_trip_in_spark(spark, vocabulary):
    texts = ["Hello, wörld!", None, "", "  two  spaces\n", "Hello, wörld!"]
    ranks, pattern = bpe.multilingual()
    frame = docs(spark, texts).withColumn("ids", F.lit("clash"))
    out = by_id(bpe.decode(bpe.encode(frame, ranks, pattern), ranks))
    assert {i: bytes(r.decoded).decode() for i, r in out.items()} == {i: t or "" for i, t in enumerate(texts)}
    assert all(r.ids == vocabulary[1].encode_ordinary(texts[i] or "") for i, r in out.items())
    assert bpe.digests(docs(spark, [])).collect() == []


# 6 embeddings


def vector_result(rows, threshold):
    ok = [(i, np.array(v, dtype=float), l) for i, v, l in rows if v is not None and l is not None and None not in v and np.isfinite(np.array(v, dtype=float)).all() and any(v)]
    links, parent = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a, l) in enumerate(ok):
        for j, b, m in ok[k + 1 :]:
            if l == m and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                links[i] += 1
                links[j] += 1
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: (links[i], find(i)) for i in links}


def test_near_vectors_are_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", 16)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 24))
    rows = [(i, [float(x) for x in np.float32(centres[rng.integers(12)] + rng.normal(scale=0.25, size=24))], int(rng.integers(3))) for i in range(150)]
    rows += [(200 + k, rows[0][1], rows[0][2]) for k in range(40)]  # a hot vector
    rows += [(300, None, 1), (301, [0.0] * 24, 1), (302, [float("nan")] + [1.0] * 23, 1), (303, rows[1][1], None), (304, [None] + [1.0] * 23, 1), (305, [float("inf")] * 24, 1)]
    frame = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<float>, label int, node long")
    out = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(frame, threshold=0.93).collect()}
    want = vector_result(rows, 0.93)
    assert out == want
    assert embeddings.near_vectors(frame.limit(0)).collect() == []


def test_near_vectors_of_many_widths(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", 8)
    monkeypatch.setattr(embeddings, "ROTATED_WIDTHS", 3)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 40))
    rows = [(i, [float(x) for x in np.float32(centres[i % 4] + rng.normal(scale=0.2, size=40))][: 2 + i % 20], i % 2) for i in range(240)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(frame, threshold=0.93).collect()}
    assert out == vector_result(rows, 0.93)


def test_early_stop_loses_no_pair():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 32)) * np.geomspace(4, 0.1, 32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for threshold in (0.5, 0.9, 0.99):
        i, j = embeddings.linked_pairs(x, x, threshold)
        assert set(zip(i.tolist(), j.tolist())) == set(zip(*(k.tolist() for k in np.nonzero(x @ x.T >= threshold))))


# 7 quality


def test_quality_learns_from_allowed_rows_only(spark):
    rng = random.Random(6)
    good = lambda: " ".join(rng.choice(["the", "harbour", "was", "quiet", "in", "winter."]) for _ in range(60))
    bad = lambda: " ".join(rng.choice(["WIN!!", "$$$", "free###", "click|", "now***"]) for _ in range(60))
    texts = [good() if i % 3 else bad() for i in range(300)] + [None, "", "x" * 300_000]
    frame = docs(spark, texts)
    labels = [(i, int(i % 3 > 0), "clash") for i in range(300)] + [(None, 1, "c"), (5, None, "c"), (6, 3, "c")]
    out = by_id(quality.quality(frame, spark.createDataFrame(labels, "doc_id long, quality int, text string")))
    import zlib

    assert len(out) == len(texts) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in out.items())
    held = [i for i in range(300) if out[i].held_out]
    assert sum(out[i].predicted == int(i % 3 > 0) for i in held) >= 0.97 * len(held)
    # Turning the held-out labels round changes nothing.
    turned = [(i, 1 - y if i in set(held) else y, c) for i, y, c in labels if i is not None and y is not None]
    again = by_id(quality.quality(frame, spark.createDataFrame(turned, "doc_id long, quality int, text string")))
    assert all(again[i].score == pytest.approx(out[i].score) for i in out)
    none = quality.quality(frame, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in none.collect()} == {0.5}
    assert quality.quality(docs(spark, []), spark.createDataFrame(labels, "doc_id long, quality int, text string")).collect() == []


def test_isotonic_fits_block_means():
    assert quality.isotonic(np.array([1.0, 0, 3]), np.array([1.0, 1, 3])).tolist() == [0.5, 0.5, 1.0]


def test_statistics_of_pieces_add_up(monkeypatch):
    long = "Some words, here! " * 4000
    whole = quality.text_statistics(pa.array([long, "x"]))
    monkeypatch.setattr(T, "SLICE_BYTES", 9000)
    pieces = quality.text_statistics(pa.array([long, "x"]))
    shares = len(quality.CLASSES)
    assert np.allclose(whole[:, : shares + 3], pieces[:, : shares + 3])


# 8 exact dedup


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup_is_brute_force(spark, weak):
    rng = random.Random(8)
    texts = [rng.choice(["Aa", "aA", "É", "é", "", None, "ab", "ba", "x" * 200_000, "X" * 199_999 + "y"]) for _ in range(60)]
    # A fingerprint modulo tiny primes collides all the time; the comparison must sort it out.
    hashes = exact.Fingerprints(primes=(3, 5), bases=(2, 3), chunk=7) if weak else None
    out = by_id(exact.exact_dedup(docs(spark, texts), hashes=hashes))
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(lowered(t), []).append(i)
    for i, t in enumerate(texts):
        own = groups[lowered(t)]
        assert (out[i].keep_id, out[i].group_size, out[i].kept) == (max(own), len(own), i == max(own))
        assert out[i].text_sha256 == hashlib.sha256(lowered(t).encode()).hexdigest()


def test_exact_dedup_of_null_and_repeated_ids(spark):
    rows = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in exact.exact_dedup(docs(spark, ["a", "A", "a", "b"], ids=[None, 4, 4, None])).collect())
    assert rows == [("4", "4", 3, True), ("4", "4", 3, True), ("None", "4", 3, False), ("None", "None", 1, True)]
    assert exact.exact_dedup(docs(spark, [])).collect() == []


@settings(max_examples=50, deadline=None)
@given(st.binary(max_size=60), st.binary(max_size=60))
def test_fingerprints_compose(a, b):
    hashes = exact.Fingerprints(chunk=8)
    parts = [hashes.rows(np.frombuffer(x, dtype=np.uint8), np.array([0, len(x)]))[0] for x in (a, b, a + b)]
    split = lambda x: (int(x) >> 31, int(x) & (2**31 - 1))
    assert hashes.join(split(parts[0]), len(a), split(parts[1])) == split(parts[2])


# 9 substrings


def cut_windows(texts, size):
    seen, gone = set(), {}
    for i, t in sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0)):
        ws = words(t)
        drop = set()
        for p in range(len(ws) - size + 1):
            key = tuple(ws[p : p + size])
            if key in seen:
                drop |= set(range(p, p + size))
            seen.add(key)
        gone[i] = (len(ws), len(drop), hashlib.sha256(" ".join(w for k, w in enumerate(ws) if k not in drop).encode()).hexdigest())
    return gone


@pytest.mark.parametrize("hot", [0, 256])
def test_repeated_windows_are_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT_CLASSES", hot)
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "Ü"]
    passage = [rng.choice(vocabulary) for _ in range(45)]
    texts = []
    for _ in range(60):
        ws = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))]
        if rng.random() < 0.6:
            at, a, b = rng.randrange(len(ws) + 1), rng.randrange(20), rng.randrange(20, 46)
            ws[at:at] = passage[a:b]
        texts.append(rng.choice([" ", "\n", "\t "]).join(ws))
    texts += [None, "", " ".join(["z"] * 90), texts[0], texts[1]]
    out = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.remove_repeats(docs(spark, texts), window=12).collect()}
    assert out == cut_windows(list(enumerate(texts)), 12)


def test_repeated_windows_of_repeated_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    out = substrings.remove_repeats(docs(spark, [text, text, text, "short"], ids=[3, 3, None, 9]), window=20)
    assert sorted((str(r.doc_id), r.n_removed) for r in out.collect()) == [("3", 30), ("3", 30), ("9", 0), ("None", 0)]
    assert substrings.remove_repeats(docs(spark, []), window=20).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.integers(1, 6))
def test_backward_search_counts_occurrences(symbols, size):
    text = np.array([0, *symbols, 0])
    starts = np.array([s for s in range(1, len(text)) if s + size < len(text)], dtype=np.int64)
    if len(starts):
        low, high = FMIndex(text, size + 1).search(text, starts, size)
        want = [sum(text[s : s + size].tolist() == text[t : t + size].tolist() for t in starts) for s in starts]
        assert (high - low).tolist() == want


# 10 MinHash


def near_result(texts, size, percent):
    sets = {}
    for i, t in texts:
        ws = words(lowered(t))
        sets[i] = {tuple(ws[k : k + size]) for k in range(len(ws) - size + 1)} if len(ws) >= size else ({tuple(ws)} if ws else set())
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("block", [4, 256])
def test_near_components_are_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(10)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [None, "", "one", "One", "two words", "a b c", "a b c d"]
    for edits in (0, 2, 6, 10, 16):
        base = [rng.choice(vocabulary) for _ in range(90)]
        for _ in range(14):
            ws = list(base)
            for _ in range(rng.randrange(edits + 1)):
                ws[rng.randrange(len(ws))] = rng.choice(vocabulary)
            texts.append(" ".join(w.upper() if rng.random() < 0.1 else w for w in ws))
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_components(docs(spark, texts), size=4).collect()}
    assert out == near_result(list(enumerate(texts)), 4, 80)


def test_near_components_of_null_and_repeated_ids(spark):
    long = " ".join(f"w{i}" for i in range(50))
    out = minhash.near_components(docs(spark, [long, long, "other text here", long + " end"], ids=[None, 5, 5, 9]))
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in out.collect()) == [
        ("5", "5", True),
        ("5", "5", True),
        ("9", "5", False),
        ("None", "None", True),
    ]
    assert minhash.near_components(docs(spark, [])).collect() == []
