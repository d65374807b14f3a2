"""Hand-made documents, brute-force versions of the operators, comparisons."""

from __future__ import annotations

import random
import re
import string
import zlib

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# columns that an operator uses inside, given by the user
CLASH = {c: f"user {c}" for c in ("key", "digest", "rep", "hits", "windows", "items", "spans", "whole", "score",
                                  "lang_pred", "ids", "n_tokens", "host", "pos", "row", "root", "__w", "__s")}


def words(n: int, rng: random.Random) -> list[str]:
    return ["".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 7))) for _ in range(n)]


def edge_texts() -> list:
    """Null, empty, blank, one word, symbols, long, equal and tied texts."""
    rng = random.Random(5)
    base = " ".join(words(80, rng))
    return [None, "", " \t\n", "word", "...", "été naïve 日本語 текст", base, base, base.upper(),
            base.replace(" ", "\n\t"), " ".join(words(30_000, rng)), "x" * 20_000, "a b c", "a b c", "  ", "\x00"]


def edge_docs(spark, extra: bool = True):
    texts = edge_texts()
    rows = [(i if i not in (3, 12) else None, t, [None, "en", "fr"][i % 3], ["s0", None][i % 2], 0)
            for i, t in enumerate(texts)]
    rows.append(rows[6])  # a repeated row
    rows.append((6, "another text of the same doc_id", "en", "s1", 1))
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    if extra:
        from pyspark.sql import functions as F
        df = df.withColumns({c: F.lit(v) for c, v in CLASH.items()})
    return df


def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def lower(text) -> str:
    return (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


def space_words(text) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def bench_words(text) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def components(nodes, links) -> dict:
    """Smallest reachable node of each."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for u, v in links:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, k: int) -> frozenset:
    w = space_words(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def near_components(texts: dict, k: int) -> dict:
    """Brute force over all pairs."""
    sets = {i: shingles(t, k) for i, t in texts.items()}
    ids = sorted(sets)
    links = [(u, v) for n, u in enumerate(ids) for v in ids[n + 1:]
             if sets[u] and sets[v] and 100 * len(sets[u] & sets[v]) >= 80 * len(sets[u] | sets[v])]
    return components(ids, links)


def edited(base: list[str], rate: float, rng: random.Random) -> list[str]:
    return [w if rng.random() > rate else "".join(rng.choices(string.ascii_lowercase, k=6)) for w in base]


def twins() -> tuple[str, str]:
    """Two words that any polynomial hash modulo 2**64 takes for one."""
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))
