"""Benchmark decontamination by winnowing.

An item's windows are its runs of ``window`` words; an item of fewer words is
one window. Of every window of 10 words the least of its five 6-word hashes is
its fingerprint, so a document that holds the window holds the fingerprint
too, whatever surrounds it: every shared span of 10 words is found. (A shorter
item is its own fingerprint; documents give all runs of the few lengths that
occur.) Fingerprints of documents and items are joined; around each hit the
document's words are extended to the windows that could have chosen it, and
these are joined with the items' windows.

The items' fingerprints are broadcast only below ``broadcast_rows`` rows of 8
bytes, counted first; beyond that the join is shuffled.

Defined results: a null text has no words; a null item_id is no item, but its
windows count as hits; items of equal text each count; texts are told apart
by their MD5, so repeated rows and doc_ids each have their result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Store, likely_rows, small_batches
from .words import ALNUM, Words, ranges, texts_in_chunks


@dataclass(frozen=True)
class Winnow:
    window: int = 10  # words; a span of so many shared words is always found
    gram: int = 6  # words of a fingerprint
    broadcast_rows: int = 1 << 20


def winnowed(words: Words, p: Winnow) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word position, text, hash) of the grams that are the least of some
    window, the leftmost of equal ones."""
    starts, text = words.all_windows(p.window)
    if not len(starts):
        return starts, text, np.empty(0, np.uint64)
    n = len(words.start)
    every = np.zeros(n, np.uint64)
    grams, _ = words.all_windows(p.gram)
    every[grams] = words.windows(grams, grams + p.gram)
    best, at = every[starts], starts.copy()
    for j in range(1, p.window - p.gram + 1):
        less = every[starts + j] < best
        best = np.where(less, every[starts + j], best)
        at[less] = starts[less] + j
    new = np.concatenate(([True], at[1:] != at[:-1]))
    return at[new], text[new], best[new]


def _short_runs(words: Words, lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(position, text, length, hash) of all runs of the given lengths."""
    parts = [(s, t, np.full(len(s), m), words.windows(s, s + m))
             for m in lengths for s, t in [words.all_windows(m)]]
    if not parts:
        e = np.empty(0, np.int64)
        return e, e, e, np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _lists(hashes: np.ndarray, text: np.ndarray, n_texts: int) -> pa.Array:
    """Distinct hashes of each text as a list column."""
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    if len(hashes):
        new = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])))
        hashes, text = hashes[new], text[new]
    offsets = np.searchsorted(text, np.arange(n_texts + 1))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(hashes.view(np.int64)))


def _item_windows(batches: Iterator[pa.RecordBatch], p: Winnow) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, words in texts_in_chunks(batch.column("text"), ALNUM, True):
            ids = batch.column("item_id").slice(i, j - i)
            n = words.count
            starts, text = words.all_windows(p.window)
            fp = np.empty(0, np.uint64)
            if len(starts):
                grams = np.stack([words.windows(starts + k, starts + k + p.gram)
                                  for k in range(p.window - p.gram + 1)])
                fp = grams.min(axis=0)
            short = np.flatnonzero((n > 0) & (n < p.window))
            whole = words.windows(words.first[short], words.first[short] + n[short])
            text = np.concatenate((text, short))
            size = np.concatenate((np.full(len(starts), p.window), n[short]))
            full = np.concatenate((words.windows(starts, starts + p.window), whole))
            fp = np.concatenate((fp, whole))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(text)), pa.array(size, pa.int32()), pa.array(full.view(np.int64)),
                 pa.array(fp.view(np.int64))], names=["item_id", "size", "win", "fp"])


def _fingerprints(batches: Iterator[pa.RecordBatch], p: Winnow, lengths: list[int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, words in texts_in_chunks(batch.column("text"), ALNUM, True):
            _, text, fp = winnowed(words, p)
            _, text2, _, fp2 = _short_runs(words, lengths)
            lists = _lists(np.concatenate((fp, fp2)), np.concatenate((text, text2)), words.n_texts)
            yield pa.RecordBatch.from_arrays([batch.column("key").slice(i, j - i), lists], names=["key", "fps"])


def _extended(batches: Iterator[pa.RecordBatch], p: Winnow, lengths: list[int]) -> Iterator[pa.RecordBatch]:
    """The windows that hold a hit fingerprint at the place it may be chosen for."""
    for batch in batches:
        for i, j, words in texts_in_chunks(batch.column("text"), ALNUM, True):
            hits = batch.column("hits").slice(i, j - i)
            hit_text = np.repeat(np.arange(j - i), np.diff(hits.offsets.to_numpy()))
            hit = hits.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            at, text, fp = winnowed(words, p)
            ok = _pairs_in(text, fp, hit_text, hit)
            at, text = at[ok], text[ok]
            back = p.window - p.gram
            lo = np.maximum(at - back, words.first[text])
            hi = np.minimum(at, words.first[text + 1] - p.window)
            n = np.maximum(hi - lo + 1, 0)
            start = np.unique(ranges(lo, n))
            text = np.searchsorted(words.first, start, "right") - 1
            win = words.windows(start, start + p.window)
            start2, text2, size2, win2 = _short_runs(words, lengths)
            ok = _pairs_in(text2, win2, hit_text, hit)
            start, text = np.concatenate((start, start2[ok])), np.concatenate((text, text2[ok]))
            size = np.concatenate((np.full(len(start) - int(ok.sum()), p.window), size2[ok]))
            win = np.concatenate((win, win2[ok]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").slice(i, j - i).take(pa.array(text)),
                 pa.array(start - words.first[text], pa.int32()), pa.array(size, pa.int32()),
                 pa.array(win.view(np.int64))], names=["key", "start", "size", "win"])


def _pairs_in(text: np.ndarray, h: np.ndarray, text2: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Which (text, h) are among (text2, h2)."""
    def both(t: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(t), [("t", np.int64), ("h", np.uint64)])
        out["t"], out["h"] = t, x
        return out
    hot = np.isin(h, h2)
    out = np.zeros(len(h), bool)
    if hot.any():
        out[hot] = np.isin(both(text[hot], h[hot]), both(text2, h2))
    return out


def _n_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, words in texts_in_chunks(batch.column("text"), ALNUM, True):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, j - i), batch.column("key").slice(i, j - i),
                 pa.array(words.count, pa.int64())], names=["doc_id", "key", "n_words"])


def contamination(docs: DataFrame, items: DataFrame, store: Store, p: Winnow = Winnow()) -> DataFrame:
    """``docs`` (doc_id, text) against ``items`` (item_id, text): one row per
    row of ``docs`` with n_words, windows (array of (start, size), word
    positions of item windows in the text) and items (sorted item_ids as
    strings). Both arrays are empty for a clean document."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).alias("key"))
    items = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    bench = store.put(items.mapInArrow(lambda it: _item_windows(it, p),
                                       "item_id string, size int, win bigint, fp bigint").distinct(), "bench")
    lengths = [r[0] for r in bench.where(F.col("size") < p.window).select("size").distinct().collect()]
    fps, wins = bench.select("fp").distinct(), bench.select("win", "size").distinct()
    if bench.count() <= p.broadcast_rows:
        fps, wins = F.broadcast(fps), F.broadcast(wins)

    hits = (docs.mapInArrow(lambda it: _fingerprints(it, p, lengths), "key string, fps array<bigint>")
            .select("key", F.explode("fps").alias("fp")).join(fps, "fp")
            .groupBy("key").agg(F.collect_set("fp").alias("hits")))
    hits = store.put(hits, "hits")
    near = likely_rows(docs.select("key", "text"), "key", hits, "key").join(hits, "key")
    found = (near.select("key", "text", "hits")
             .mapInArrow(lambda it: _extended(it, p, lengths), "key string, start int, size int, win bigint")
             .join(wins, ["win", "size"]).distinct())
    found = store.put(found, "found")
    where = found.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("start", "size"))).alias("windows"))
    which = (found.select("key", "win", "size").distinct()
             .join(bench.select("win", "size", "item_id").where("item_id is not null").distinct(), ["win", "size"])
             .groupBy("key").agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    marked = store.put(where.join(which, "key", "left"), "marked")
    counted = docs.mapInArrow(_n_words, "doc_id bigint, key string, n_words bigint")
    return (counted.join(marked, "key", "left")
            .select("doc_id", "n_words",
                    F.coalesce("windows", F.expr("cast(array() as array<struct<start:int,size:int>>)")).alias("windows"),
                    F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items")))


def words_hit() -> "F.Column":
    """Number of words that lie in some of ``windows``."""
    return F.expr("size(array_distinct(flatten(transform(windows, w -> sequence(w.start, w.start + w.size - 1)))))")
