from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from idbridge.llm.spelling import Spelling, one_edit, spelling_variants
from idbridge.llm.store import Store

from . import helpers as h

COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def _run(spark, docs, **p):
    return {r.word: tuple(r[c] for c in COLUMNS[1:])
            for r in spelling_variants(docs, Store(spark, "t"), Spelling(**p)).collect()}


def edits(w: str, letters: str) -> set[str]:
    """Every string one edit away."""
    out = {w[:i] + w[i + 1:] for i in range(len(w))}
    out |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
    return (out | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}) - {w}


def brute(rows: list[tuple]) -> dict:
    counts: Counter = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = h.lower(run)
            c = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if c % 31 == 0:
                w = w[:c % len(w)] + w[c % len(w) + 1:]
            counts[w] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    letters = "".join(sorted(set("".join(words))))
    near = {w: sorted(edits(w, letters) & words.keys(), key=lambda x: (-words[x], x)) for w in words}
    form = {w: x[0] if x and words[x[0]] >= 10 * words[w] else None for w, x in near.items()}

    def last(w):
        return last(form[w]) if form[w] else w

    return {w: (n, len(near[w]), form[w], words.get(form[w]), last(w)) for w, n in words.items()}


def _typed(rng: random.Random) -> list[tuple]:
    """Words with errors of all kinds, in a few frequencies, errors of errors."""
    letters = "abcdeéÿ"
    base = ["".join(rng.choices(letters, k=rng.randint(6, 12))) for _ in range(60)]
    bag = []
    for w in base:
        bag += [w] * rng.choice([2, 30, 400])
        for _ in range(8):
            x = rng.choice(sorted(edits(w, letters)))
            bag += [x] * rng.choice([1, 2, 3, 30])
            bag += [rng.choice(sorted(edits(x, letters)))] * 2
    rng.shuffle(bag)
    return [(i, rng.choice([" ", "-", "1", "\n"]).join(w.upper() if rng.random() < 0.1 else w for w in bag[k:k + 50]))
            for i, k in enumerate(range(0, len(bag), 50))]


def test_against_brute_force(spark):
    rows = _typed(random.Random(8))
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], h.DOC_SCHEMA)
    want = brute(rows)
    assert any(v[4] != k and v[4] != v[2] for k, v in want.items())  # chains of forms
    assert _run(spark, docs) == want
    assert _run(spark, docs, block=4, limit=3) == want  # many blocks, each in many parts


def test_one_edit():
    words = ["", "a", "b", "ab", "ba", "abc", "acb", "abcd", "aabc", "bc", "abca"]
    for a in words:
        for b in words:
            assert one_edit(a, b) == (b in edits(a, "abcd"))


def test_edge_rows(spark):
    docs = h.edge_docs(spark).withColumns({c: F.lit("u") for c in ("word", "half", "block", "form")})
    assert _run(spark, docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_long_runs_and_signs_beyond_letters(spark):
    long = "xy" * 3000
    texts = [long, long, long + "x", long + "x", "a×b÷cdefg a×b÷cdefg", "straße_straße naïveté naïveté", "ÀÉÎõüÿÿ ÀÉÎõüÿÿ"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], h.DOC_SCHEMA)
    got = _run(spark, docs)
    assert got == brute(rows) and "ÀÉÎõüÿÿ" in got


def test_ties_take_the_first_in_code_points(spark):
    text = " ".join(["zzaaaaa"] * 40 + ["zzaaaab"] * 40 + ["zzaaaac"] * 2)
    docs = spark.createDataFrame([(7, text, "en", "s", 0)], h.DOC_SCHEMA)
    assert _run(spark, docs)["zzaaaac"] == (2, 2, "zzaaaaa", 40, "zzaaaaa")


def test_empty_table(spark):
    assert _run(spark, h.empty_docs(spark)) == {}


def test_query_against_brute_force(spark):
    from idbridge.llm.queries import QUERIES

    from ..conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.word: tuple(r[c] for c in COLUMNS[1:]) for r in QUERIES["op13_spelling_variants"](spark, SF_SMALL).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
