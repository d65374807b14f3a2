from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from idbridge.llm.secrets import Ownership, secrets
from idbridge.llm.store import Store

from . import helpers as h

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ORDER = ["assign", "access", "hex", "owned"]


def brute(rows, examples=3):
    """rows: (doc_id, text, repository, owner) -> per row the sorted spans."""
    cands = []
    for n, (_, text, repo, owner) in enumerate(rows):
        text = text or ""
        base = [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        base += [("access", m.start(), m.end(), m[0]) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        base += [("hex", m.start(), m.end(), m[0]) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
        bare = [("owned", m.start(), m.end(), m[0]) for m in re.finditer(r"[A-Za-z0-9+/_-]+", text)
                if len(m[0]) >= 20 and all(re.search(c, m[0]) for c in ("[0-9]", "[a-z]", "[A-Z]"))]
        bare = [x for x in bare if not any(b[1] < x[2] and x[1] < b[2] for b in base)]
        cands += [(n, repo, owner, *s) for s in base + bare]
    out = [[] for _ in rows]
    for n, _, _, kind, a, b, value in cands:
        owners = {c[2] for c in cands if c[6] == value}
        verdict = "example" if len(owners) >= examples else "live"
        if kind != "owned" or verdict == "live":
            out[n].append((kind, a, b, hashlib.sha256(value.encode()).hexdigest(), verdict))
    return [sorted(s, key=lambda x: (x[1], ORDER.index(x[0]))) for s in out]


def _check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, repository string, owner string")
    docs = docs.withColumns({c: F.lit("user") for c in ("row", "value", "spans", "base", "ms", "kind")})
    got = [(r.doc_id, [tuple(s) for s in r.spans]) for r in secrets(docs, Store(spark, "t"), Ownership()).collect()]
    want = [(r[0], s) for r, s in zip(rows, brute(rows), strict=True)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return want


def test_kinds_positions_and_owners(spark):
    live, copied = "aB3" + "xY9z" * 6, "Zz8" + "qW1e" * 6
    texts = [
        f"é😀 password = 'hunter22' token:abc12 Token=\"{live}\"",
        "secret:token :abcdefgh API_KEY=a.b-c=d apikey = x",
        "AKIA" + "A1" * 8 + " AKIAAAA AKIAKIA" + "B2" * 10,
        "0123456789abcdef" * 2 + " deadbeef " + "f" * 24 + "G" + "e" * 23,
        f"{live} {copied}", f"x{copied}", copied, copied, copied, f"passwd: {copied}",
        None, "", "ſecret=abcdefgh tokeN=abcdefgh", "password==========", "a" * 50_000 + " token=" + "b" * 60_000]
    want = _check(spark, [(i, t, f"r{i}", f"o{i % 4}") for i, t in enumerate(texts)])
    verdicts = {v for _, s in want for *_, v in s}
    assert verdicts == {"live", "example"}
    assert any(k == "owned" for _, s in want for k, *_ in s)


def test_edge_rows(spark):
    row = (7, "token=abcdefgh", None, None)
    _check(spark, [(None, "token=abcdefgh", "r", None), row, row, (7, "other", "r", "o"), (8, None, None, None)])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, repository string, owner string")
    assert secrets(docs, Store(spark, "t")).count() == 0


def test_no_python_in_the_plan(spark):
    docs = h.edge_docs(spark).select("doc_id", "text", F.lit("r").alias("repository"), F.lit("o").alias("owner"))
    plan = secrets(docs, Store(spark, "t"))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


def test_copies_of_one_owner_stay_live(spark):
    live = "aB3" + "xY9z" * 6
    rows = [(i, f"key {live}", f"r{i}", "o") for i in range(1100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, repository string, owner string")
    got = secrets(docs, Store(spark, "t")).collect()
    assert len(got) == 1100 and all([(s.kind, s.verdict) for s in r.spans] == [("owned", "live")] for r in got)
