"""Near duplicates: MinHash signatures, banding, checked links, components.

1. One pass over the texts makes each document's shingle set, ``bands * rows``
   universal-hash minima, one key per band, and a digest of the set. Documents
   of equal sets form one class; its smallest doc_id stands for it.
2. Classes that share a band key are candidates. Every bucket ties its members
   to its smallest one, so a bucket of any size gives as many pairs as it has
   members. Pairs pass a signature check, then the exact check on full sets.
3. Links are merged into components (large-star, small-star). A bucket whose
   members now lie in one component is finished. In the others, the members
   outside the largest component are held against all members of other
   components: inside tasks, in blocks, signature first, then full sets. Only
   links come out, so no pair is emitted and no bucket or partner is capped.

Links are decided on the words; 64-bit hashes only choose what is compared, and
documents whose sets of hashes are equal count as copies.

A pair of the least similarity misses every one of 30 bands of 5 rows with a
probability of 7 in a million. The work of step 3 grows with the unlinked part
of a bucket times its size; linked copies, however many, cost one pair each.

Defined results: no words or a null text give an empty set, linked with
nothing; rows that repeat a doc_id count as versions of one document; a row
without doc_id has the component of its class, or none and is kept if the
class has no doc_id; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import Store, likely_rows, small_batches
from .words import NOT_SPACE, Words, mix, texts_in_chunks, word_shingles

SIGNED = "doc_id bigint, n_shingles bigint, digest binary, sig binary, keys array<bigint>"


@dataclass(frozen=True)
class NearDup:
    """Parameters: links have 100 * intersection >= percent * union."""

    shingle: int = 5
    percent: int = 80
    bands: int = 30
    rows: int = 5
    block: int = 512  # members and queries compared in one task
    seed: int = 7

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        a, b = rng.integers(0, 2**64, (2, self.bands * self.rows), dtype=np.uint64)
        return a | np.uint64(1), b

    def least_estimate(self) -> float:
        """Signature agreement below which a pair cannot be a link, but for
        five standard deviations."""
        s = self.percent / 100
        return s - 5 * (s * (1 - s) / (self.bands * self.rows)) ** 0.5


def shingle_sets(words: Words, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    out = []
    starts, _ = words.all_windows(k)
    full = words.windows(starts, starts + k)
    n = np.maximum(words.count - k + 1, 0)
    cut = np.concatenate(([0], np.cumsum(n)))
    for i in range(words.n_texts):
        if n[i]:
            s = np.sort(full[cut[i]:cut[i + 1]])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) > 1 else s)
        else:
            a, b = words.first[i:i + 1], words.first[i + 1:i + 2]
            out.append(words.windows(a, b) if a[0] < b[0] else np.empty(0, np.uint64))
    return out


def _minima(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One row of minima per non-empty set."""
    x = np.concatenate(sets)
    cut = np.concatenate(([0], np.cumsum([len(s) for s in sets[:-1]]))).astype(np.int64)
    h, out = np.empty_like(x), np.empty((len(a), len(sets)), np.uint64)
    for j in range(len(a)):
        np.multiply(x, a[j], out=h)
        h += b[j]
        np.minimum.reduceat(h, cut, out=out[j])
    return out.T


def _sign(batches: Iterator[pa.RecordBatch], p: NearDup) -> Iterator[pa.RecordBatch]:
    a, b = p.hashes()
    weights = mix(np.arange(1, p.rows + 1, dtype=np.uint64)) | np.uint64(1)
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        for i, j, words in texts_in_chunks(texts, NOT_SPACE, True, 1 << 18):
            sets = shingle_sets(words, p.shingle)
            some = [s for s in sets if len(s)]
            sizes = [len(s) for s in sets]
            sigs, keys, digests, at = [None] * len(sets), [None] * len(sets), [None] * len(sets), 0
            if some:
                minima = _minima(some, a, b)
                low = mix(minima).astype(np.uint8)
                band = (minima.reshape(len(some), p.bands, p.rows) * weights).sum(axis=2, dtype=np.uint64)
                band = mix(band + np.arange(p.bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
            for r, s in enumerate(sets):
                if len(s):
                    sigs[r], keys[r] = low[at].tobytes(), band[at]
                    digests[r] = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    at += 1
            yield pa.RecordBatch.from_arrays(
                [ids.slice(i, j - i), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(sigs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "digest", "sig", "keys"])


def _agreeing(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """The signature check: agreement of the minima's low bytes, corrected
    for the bytes that agree by chance."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                for c in ("sig_u", "sig_v"))
        est = ((x == y).mean(axis=1) - 1 / 256) / (1 - 1 / 256)
        keep = np.flatnonzero(est >= least)
        yield pa.RecordBatch.from_arrays([batch.column("u").take(keep), batch.column("v").take(keep)], names=["u", "v"])


def _linked(batches: Iterator[pa.RecordBatch], p: NearDup) -> Iterator[pa.RecordBatch]:
    """The exact check on full sets, of the words themselves."""
    last, x = None, set()
    for batch in batches:
        keep = []
        for r, (u, a, b) in enumerate(zip(batch.column("u").to_pylist(), batch.column("text_u").to_pylist(),
                                          batch.column("text_v").to_pylist(), strict=True)):
            if last != (u, a):
                last, x = (u, a), word_shingles(a, p.shingle)
            y = word_shingles(b, p.shingle)
            both = len(x & y)
            if both and 100 * both >= p.percent * (len(x) + len(y) - both):
                keep.append(r)
        at = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("u").take(at), batch.column("v").take(at)], names=["u", "v"])


def _sets(batches: Iterator[pa.RecordBatch], p: NearDup) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, words in texts_in_chunks(batch.column("text"), NOT_SPACE, True):
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep").slice(i, j - i),
                 pa.array([s.tobytes() for s in shingle_sets(words, p.shingle)], pa.binary())], names=["rep", "shingles"])


def _across(table: pa.Table, p: NearDup) -> pa.Table:
    """Links between the queries and the members of one block of a bucket that
    lie in different components. A pair that shares an earlier band is left to
    that band's bucket, which is open too."""
    rep, root, band = (table[c].to_numpy() for c in ("rep", "root", "band"))
    query = np.asarray(table["query"].to_pylist(), bool)
    sig, sets = ([np.frombuffer(x, t) for x in table[c].to_pylist()]
                 for c, t in (("sig", np.uint8), ("shingles", np.uint64)))
    keys = table["keys"].combine_chunks().flatten().to_numpy().reshape(len(rep), -1)
    members, least = np.flatnonzero(~query), p.least_estimate()
    u, v = [], []
    if len(members):
        sigs, bands, size = np.stack([sig[m] for m in members]), keys[members], p.percent
        counts = np.array([len(sets[m]) for m in members])
        for q in np.flatnonzero(query):
            first = (bands == keys[q]).argmax(axis=1) == band[q]
            est = ((sigs == sig[q]).mean(axis=1) - 1 / 256) / (1 - 1 / 256)
            n = len(sets[q])
            near = (100 * np.minimum(counts, n) >= size * np.maximum(counts, n)) & (root[members] != root[q])
            linked: set[int] = set()
            for m in members[near & first & (est >= least)]:
                if root[m] not in linked:  # one link to a component is enough
                    both = len(np.intersect1d(sets[q], sets[m], assume_unique=True))
                    if 100 * both >= size * (n + len(sets[m]) - both):
                        linked.add(root[m])
                        u.append(rep[q])
                        v.append(rep[m])
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _check(pairs: DataFrame, texts: DataFrame, p: NearDup) -> DataFrame:
    """Pairs (u, v) that are links by their full sets."""
    ids = pairs.select(F.col("u").alias("id")).unionAll(pairs.select(F.col("v").alias("id")))
    some = likely_rows(texts, "doc_id", ids, "id")
    return (pairs.join(some.toDF("u", "text_u"), "u").join(some.toDF("v", "text_v"), "v")
            .select("u", "v", "text_u", "text_v")
            .mapInArrow(lambda it: _linked(it, p), "u bigint, v bigint"))


def _open_links(tied: DataFrame, roots: DataFrame, reps: DataFrame, texts: DataFrame, store: Store,
                p: NearDup) -> DataFrame:
    """Links across components inside the buckets that hold several."""
    rooted = (tied.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
              .select("rep", "band", "key", F.coalesce("root", "rep").alias("root")))
    parts = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    buckets = (parts.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("most"), F.sum("n").alias("size"),
                                        F.max("n").alias("n"), F.count(F.lit(1)).alias("parts"))
               .where("parts > 1 and size > 2")
               .select("key", "most", F.ceil(F.col("size") / p.block).cast("int").alias("member_blocks"),
                       F.ceil((F.col("size") - F.col("n")) / p.block).cast("int").alias("query_blocks")))
    rows = store.put(rooted.join(buckets, "key"), "open")
    if rows.isEmpty():
        return rows.select(F.col("rep").alias("u"), F.col("rep").alias("v"))
    ids = rows.select("rep").distinct()
    some = likely_rows(texts.withColumnRenamed("doc_id", "rep"), "rep", ids, "rep").join(ids, "rep")
    sets = some.mapInArrow(lambda it: _sets(it, p), "rep bigint, shingles binary").join(
        reps, "rep")
    own = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = rows.withColumn("m", own("member_blocks")).withColumn("q", every("query_blocks")).withColumn("query", F.lit(False))
    queries = (rows.where("root != most").withColumn("q", own("query_blocks")).withColumn("m", every("member_blocks"))
               .withColumn("query", F.lit(True)))
    cols = ["key", "m", "q", "rep", "band", "root", "query"]
    return (members.select(cols).unionAll(queries.select(cols)).join(sets, "rep")
            .groupBy("key", "m", "q").applyInArrow(lambda t: _across(t, p), "u bigint, v bigint"))


def near_duplicates(docs: DataFrame, store: Store, p: NearDup = NearDup()) -> DataFrame:
    """``docs`` (doc_id, text) -> one row per row: doc_id, n_shingles,
    component_id (the smallest doc_id reachable over links)."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = store.put(texts.mapInArrow(lambda it: _sign(it, p), SIGNED), "signed")
    classes = store.put(signed.where("n_shingles > 0 and doc_id is not null").groupBy("digest")
                        .agg(F.min("doc_id").alias("rep")), "classes")
    texts = texts.where("doc_id is not null")

    reps = store.put(signed.select("digest", F.col("doc_id").alias("rep"), "sig", "keys")
                     .join(classes, ["digest", "rep"]).dropDuplicates(["digest", "rep"])
                     .select("rep", "sig", "keys"), "reps")
    buckets = reps.select("rep", F.posexplode("keys").alias("band", "key"))
    heads = buckets.groupBy("key").agg(F.min("rep").alias("pivot"), F.max("rep").alias("last")).where("pivot < last")
    tied = store.put(buckets.join(heads.drop("last"), "key"), "tied")

    sigs, least = reps.select("rep", "sig"), p.least_estimate()
    stars = tied.where("rep != pivot").select(F.col("pivot").alias("u"), F.col("rep").alias("v")).distinct()
    stars = store.put(stars.join(sigs.toDF("u", "sig_u"), "u").join(sigs.toDF("v", "sig_v"), "v")
                      .select("u", "v", "sig_u", "sig_v")
                      .mapInArrow(lambda it: _agreeing(it, least), "u bigint, v bigint"), "stars")
    links = store.put(_check(stars, texts, p), "links")
    roots = components(links, store)
    found = store.put(_open_links(tied, roots, reps, texts, store, p).distinct(), "found")
    more = store.put(_check(found, texts, p), "more")
    if not more.isEmpty():
        roots = components(roots.toDF("u", "v").unionAll(more), store)  # the same components as of all links

    named = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    named = store.put(named.select("digest", F.coalesce("root", "rep").alias("component_id")), "named")
    return (signed.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
