from __future__ import annotations

import math
import random
import re

from brightwater.operators import abbreviations as ab


def brute(texts):
    """Counts and scores by a loop over the words."""
    counts = {}
    for text in texts:
        for piece in re.split(r"\s+", text or ""):
            piece = re.sub(ab.EDGES, "", piece)
            if re.fullmatch(r"[^\W\d_]+(\.[^\W\d_]+)*\.?", piece):
                row = counts.setdefault(re.sub(r"\.$", "", piece).lower(), [0, 0])
                row[0 if piece.endswith(".") else 1] += 1
    stops, plain = (sum(c[i] for c in counts.values()) for i in (0, 1))
    p = stops / (stops + plain)
    found = {}
    for word, (s, n) in counts.items():
        if s:
            ratio = -2 * (s * math.log(p) + n * math.log(1 - p) - s * math.log(0.99) - n * math.log(0.01))
            letters = len(word.replace(".", ""))
            score = ratio * math.exp(-letters) * (word.count(".") + 1) * letters**-n
            if score >= ab.LEAST_SCORE:
                found[word] = (s, n, score)
    return found


def corpus():
    rng = random.Random(5)
    names = ["Ahle", "Brok", "Cuno", "Dorn"]
    middle = ["the firm Acme Corp. has paid", "Mr. {} came on Jan. 5 to see us", "we sold it (e.g. cheaply) then", "you may use the field here", "no delay was seen"]
    last = ["yesterday", "together", "without delay", "gladly", "everywhere", "somehow"]
    return [
        " ".join(f"{rng.choice(['The', 'We', 'You'])} know {rng.choice(middle).format(rng.choice(names))} {rng.choice(last)}." for _ in range(rng.randrange(1, 6)))
        for _ in range(60)
    ]


def test_abbreviations_are_brute_force_and_cuts_are_right(spark):
    texts = corpus()
    docs = spark.createDataFrame([*enumerate(texts), (900, None), (901, ""), (902, "It is Acme Corp. The end came.")], "doc_id long, text string")
    types = ab.word_types(docs)
    found = {r.word: (r.stops, r.plain, r.score) for r in ab.abbreviations(types).collect()}
    want = brute([*texts, "It is Acme Corp. The end came."])
    assert found.keys() == want.keys() == {"corp", "mr", "jan", "e.g"}
    assert all(found[w][:2] == want[w][:2] and math.isclose(found[w][2], want[w][2], rel_tol=1e-9) for w in want)
    out = {}
    for r in sorted(ab.sentences_without_abbreviations(docs).collect(), key=lambda r: (r.doc_id, r.position)):
        assert r.position == len(out.setdefault(r.doc_id, []))
        out[r.doc_id].append(r.sentence)
    ends = re.compile("|".join(rf"(?<={w}\.) " for w in ["yesterday", "together", "delay", "gladly", "everywhere", "somehow"]))
    assert {i: ends.split(t) for i, t in enumerate(texts)} == {i: s for i, s in out.items() if i < 900}
    assert out[902] == ["It is Acme Corp.", "The end came."] and 900 not in out and 901 not in out


def test_no_words_no_abbreviations(spark):
    for rows in ([], [(1, None)], [(1, "only words")], [(1, "All. Stop.")]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        assert ab.abbreviations(ab.word_types(docs)).collect() == []
    assert [r.sentence for r in ab.sentences_without_abbreviations(docs).orderBy("position").collect()] == ["All.", "Stop."]
