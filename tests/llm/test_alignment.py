from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from idbridge.llm.alignment import Pair, agreement, align, groups, link_counts, pack, unpack
from idbridge.llm.bpe import file_bytes, load
from idbridge.llm.store import Store

from . import helpers as h

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def brute(texts: list) -> list[tuple]:
    """Token by token, with the libraries' own encoders."""
    tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    to_byte = file_bytes()
    found, held = [], Counter()
    for t in texts:
        a = tok.encode(" " + (t or ""), add_special_tokens=False).ids
        b = sp.encode(t or "")
        raw_a = [bytes(to_byte[c] for c in tok.id_to_token(i)) for i in a]
        raw_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()
                 for p in map(sp.id_to_piece, b)]
        if not t or not b"".join(raw_a) == b"".join(raw_b) == (" " + t).encode():
            found.append(None)
            continue
        spans = []
        for raw in (raw_a, raw_b):
            at, out = 0, []
            for x in raw:
                out.append((at, at + len(x)))
                at += len(x)
            spans.append(out)
        common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        text, pairs, i, j = [], [], 0, 0
        for e in common:
            first = i, j
            while True:  # both sides walk to e, and each step starts from a linked pair
                pairs.append((a[i], b[j]))
                f, k = spans[0][i][1], spans[1][j][1]
                i, j = i + (f <= k), j + (k <= f)
                if f == k == e:
                    break
            text.append("|".join(",".join(map(str, x)) for x in (a[first[0]:i], b[first[1]:j])))
        held.update(set(pairs))
        found.append((len(a), len(b), len(common), pairs, ";".join(text)))
    most = {}
    for (x, _), n in held.items():
        most[x] = max(most.get(x, 0), n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else
            (*f[:3], len(f[3]), sum(held[q] == most[q[0]] for q in f[3]), sum(held[q] for q in f[3]),
             hashlib.sha256(f[4].encode()).hexdigest()) for f in found]


TEXTS = [None, "", " ", "a", "hello world", "Hello  world\n\tx", "<|endoftext|> <s> <unk> x", "日本語 текст naïveté",
         "x▁y", "ﬁne ﬁsh", "\x00 null", "word " * 300, "1234567890" * 40, "don't we'll", "hello world", "é" * 50]


def _run(spark, docs, **p):
    store = Store(spark, "t")
    return agreement(store.put(align(docs, A, B, **p)), store)


@pytest.mark.parametrize("chunk", [{}, {"chunk_rows": 1}, {"chunk_bytes": 100}], ids=["", "rows", "bytes"])
def test_against_brute_force(spark, chunk):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(TEXTS)], h.DOC_SCHEMA).repartition(3)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in _run(spark, docs, **chunk).collect()}
    assert [got[i] for i in range(len(TEXTS))] == brute(TEXTS)


def test_groups_and_counts(spark):
    docs = spark.createDataFrame([(1, "hello world", "en", "s", 0), (2, "hello", "en", "s", 0)], h.DOC_SCHEMA)
    got = {r.doc_id: [(g.a, g.b) for g in r.groups] for r in groups(docs, A, B).collect()}
    assert got == {1: [([23748], [6312, 28709]), ([995], [1526])], 2: [([23748], [6312, 28709])]}
    counts = link_counts(Store(spark, "t").put(align(docs, A, B))).collect()
    assert {(r.a, r.b): r.n for r in counts} == {(23748, 6312): 2, (23748, 28709): 2, (995, 1526): 1}


def test_edge_rows(spark):
    docs = h.edge_docs(spark)
    texts = {}
    for r in docs.select("doc_id", "text").collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    flat = [(i, t) for i, ts in texts.items() for t in ts]
    want = Counter((i, x) for (i, _), x in zip(flat, brute([t for _, t in flat]), strict=True))
    assert Counter((r.doc_id, tuple(r[c] for c in COLUMNS)) for r in _run(spark, docs).collect()) == want


def test_both_ways_to_encode_equal_the_library():
    """By ranks and by the merge list, on random strings of all kinds of letters."""
    rng = random.Random(6)
    letters = "abcdefgh  \n\t.,'1239éßñ日本語текст\u00a0\u2003\U0001f600sttheing"
    texts = ["".join(rng.choices(letters, k=rng.randint(1, 60))) for _ in range(2000)]
    texts += ["<|endoftext|>", "x" * 5000, " " * 3000, "\r\n" * 50, "we'll they'd I'm"]
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    want = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    m = load(A)
    assert Pair._in_rank_order(m)
    assert Pair._by_rank(m)(texts) == want
    assert Pair._by_merges(A)(texts) == want


def test_packed_numbers():
    for x in ([], [0], [1, 255, 256, 2**32 - 1]):
        assert unpack(pack(np.array(x, np.int64))).tolist() == x


def test_empty_table(spark):
    assert _run(spark, h.empty_docs(spark)).collect() == []


def test_query_against_brute_force(spark):
    from idbridge.llm.queries import QUERIES

    from ..conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_tokenizer_alignment"](spark, SF_SMALL).collect()}
    assert got == dict(zip([r.doc_id for r in docs], brute([r.text for r in docs]), strict=True))
