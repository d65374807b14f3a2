"""Passages that occur more than once, found through difference-cover anchors.

A window is ``window`` consecutive words. Windows of ``window - period + 1``
words are hashed only where the word position modulo the period lies in a
perfect difference set, 4 of 13 positions. Whatever two places hold the same
35 words, some shift of up to 12 words brings both to such a position, so both
emit the same anchor. Anchors that occur twice are then extended: every
35-word window that could hold one is hashed, and those that occur twice are
the repeats.

Which hashes occur twice is found in two steps. A task marks the ones that
repeat among its own texts and sends one entry for each hash, so a passage in
a third of all documents is one entry per task; packed entries meet by hash
bucket, whose number follows the input, and only (text, position) of repeats
goes on. Texts are read again only where they hold repeats.

Texts that occur more than once as a whole are repeats from end to end (if
they have a window); one of each stands for all in the second step.

Defined results: a null text has no words; repeated rows are texts that occur
again; rows are told apart by their text, so null or repeated doc_ids do not
matter; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import Store, likely_rows, small_batches
from .words import NOT_SPACE, Words, ranges, texts_in_chunks


@dataclass(frozen=True)
class Cover:
    """``cover`` must hold two elements of every difference modulo ``period``."""

    window: int = 35
    period: int = 13
    cover: tuple[int, ...] = (0, 1, 3, 9)
    bucket_bytes: int = 16 << 20  # input text per hash bucket
    flush: int = 1 << 20  # entries a task gathers before it sends them

    def __post_init__(self):
        have = {(a - b) % self.period for a in self.cover for b in self.cover}
        assert have == set(range(self.period)) and self.window >= self.period

    @property
    def anchor(self) -> int:
        return self.window - self.period + 1


SINGLE, KNOWN, PASS = 0, 1, 2  # an entry; one that repeats in its task; one more of those
KEY = "S16"  # MD5 of the text
ENTRY = np.dtype([("hash", "<u8"), ("key", KEY), ("pos", "<i4"), ("flag", "u1")])
SENT = "bucket bigint, hash binary, key binary, pos binary, flag binary"


def _entries(hashes: np.ndarray, keys: np.ndarray, pos: np.ndarray) -> np.ndarray:
    out = np.zeros(len(hashes), ENTRY)
    out["hash"], out["key"], out["pos"] = hashes, keys, pos
    return out


def _send(entries: np.ndarray, buckets: int, hash_type: str) -> pa.RecordBatch:
    """One row per bucket. Of equal hashes one goes to the hash's bucket; the
    others, known to repeat, go where their text's key sends them."""
    entries = entries[np.argsort(entries["hash"], kind="stable")]
    h = entries["hash"]
    first = np.concatenate(([True], h[1:] != h[:-1]))
    many = np.diff(np.append(np.flatnonzero(first), len(h)))[np.cumsum(first) - 1] > 1
    entries["flag"][first & many] = KNOWN
    entries["flag"][~first] = PASS
    own = np.ascontiguousarray(entries["key"]).view("<u8")[::2]
    to = np.where(first, (h >> np.uint64(32)) % np.uint64(buckets), own % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((entries["pos"], own, to))  # runs of one text's entries compress well
    entries, to = entries[order], to[order]
    cut = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
    end = np.append(cut[1:], len(to))
    cols = {n: np.ascontiguousarray(entries[n]) for n in ENTRY.names} | {"hash": entries["hash"].astype(hash_type)}
    return pa.RecordBatch.from_arrays(
        [pa.array(to[cut], pa.int64()),
         *(pa.array([x[a:b].tobytes() for a, b in zip(cut, end, strict=True)], pa.binary()) for x in cols.values())],
        names=["bucket", *ENTRY.names])


def _flushing(parts: Iterator[np.ndarray], p: Cover, buckets: int, hash_type: str) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part)
        if n >= p.flush:
            yield _send(np.concatenate(held), buckets, hash_type)
            held, n = [], 0
    if n:
        yield _send(np.concatenate(held), buckets, hash_type)


def _met(table: pa.Table, hash_type: str) -> pa.Table:
    """The entries of one bucket whose hash occurs twice, or is known to."""
    kinds = {n: ENTRY[n] for n in ENTRY.names} | {"hash": np.dtype(hash_type)}
    col = {n: np.frombuffer(b"".join(table[n].to_pylist()), kind) for n, kind in kinds.items()}
    live = np.flatnonzero(col["flag"] != PASS)
    _, group = np.unique(col["hash"][live], return_inverse=True)
    weight = np.bincount(group, 1.0 + (col["flag"][live] == KNOWN), minlength=1)
    hit = np.concatenate((live[weight[group] >= 2], np.flatnonzero(col["flag"] == PASS)))
    raw = np.ascontiguousarray(col["key"][hit]).tobytes()
    return pa.table({"key": pa.array([raw[i:i + 16] for i in range(0, len(raw), 16)], pa.binary()),
                     "pos": pa.array(col["pos"][hit])})


def _repeats(sent: DataFrame, hash_type: str) -> DataFrame:
    """(key, pos array) of each text's entries that occur twice."""
    met = sent.groupBy("bucket").applyInArrow(lambda t: _met(t, hash_type), "key binary, pos int")
    # a text's entries of one task go as one row; a copied text's positions, sent by many tasks, count once
    return met.groupBy("key").agg(F.collect_set("pos").alias("pos"))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, int, Words]]:
    for batch in batches:
        for i, j, words in texts_in_chunks(batch.column("text"), NOT_SPACE, False):
            yield batch, i, j, words


def _keys(batch: pa.RecordBatch, i: int, j: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("key").slice(i, j - i).to_pylist()), KEY)


def _anchors(batches: Iterator[pa.RecordBatch], p: Cover) -> Iterator[np.ndarray]:
    at_cover, seen = np.isin(np.arange(p.period), p.cover), set()
    for batch, i, j, words in _texts(batches):
        keys, n = _keys(batch, i, j), words.count
        new = np.zeros(len(keys), bool)  # a text once in a while of each task, however often it occurs
        new[np.unique(keys, return_index=True)[1]] = True
        new &= ~np.fromiter((k in seen for k in keys.tolist()), bool, len(keys))
        seen = seen | set(keys.tolist()) if len(seen) < 100_000 else set(keys.tolist())
        start, text = words.all_windows(p.anchor)
        pos = start - words.first[text]
        use = at_cover[pos % p.period] & (n >= p.window)[text] & new[text]
        start, text, pos = start[use], text[use], pos[use]
        yield _entries(words.windows(start, start + p.anchor), keys[text], pos)


def _extended(batches: Iterator[pa.RecordBatch], p: Cover) -> Iterator[np.ndarray]:
    """Every window that can hold one of the text's repeated anchors."""
    for batch, i, j, words in _texts(batches):
        keys = _keys(batch, i, j)
        marks = batch.column("pos").slice(i, j - i)
        text = np.repeat(np.arange(j - i), np.diff(marks.offsets.to_numpy()))
        at = marks.flatten().to_numpy(zero_copy_only=False) + words.first[text]
        lo = np.maximum(at - (p.period - 1), words.first[text])
        hi = np.minimum(at, words.first[text + 1] - p.window)
        start = np.unique(ranges(lo, np.maximum(hi - lo + 1, 0)))
        text = np.searchsorted(words.first, start, "right") - 1
        yield _entries(words.windows(start, start + p.window), keys[text], start - words.first[text])


def _spans(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Window starts of each text as disjoint word ranges."""
    for batch in batches:
        out = []
        for pos in batch.column("pos"):
            s = np.sort(np.array(pos.as_py(), np.int64))
            new = np.flatnonzero(np.concatenate(([True], s[1:] > s[:-1] + window)))
            last = np.append(new[1:], len(s)) - 1
            out.append([{"start": int(a), "end": int(b) + window} for a, b in zip(s[new], s[last], strict=True)])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, kind)], names=["key", "spans"])


def text_key(text: Column) -> Column:
    """The text's MD5, 16 bytes."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


SPANS = "array<struct<start:int,end:int>>"


def repeated_spans(docs: DataFrame, store: Store, p: Cover = Cover()) -> DataFrame:
    """``docs`` (doc_id, text) -> one row per text that holds a repeat: key
    (of ``text_key``), whole (the text itself occurs again) and spans (array
    of (start, end), word ranges covered by repeated windows; null if whole)."""
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    docs = docs.withColumn("key", text_key(F.col("text")))
    classes = store.put(docs.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"),
                                                F.sum(F.octet_length("text")).alias("bytes")), "classes")
    total = classes.agg(F.sum("bytes")).first()[0]
    buckets = max(1, -(-(total or 0) // p.bucket_bytes))
    copied = classes.where("n > 1").select("key")

    short = "<u4"  # with the bucket's bits enough to find candidates; the windows decide on 64 bits
    sent = docs.select("key", "text").mapInArrow(lambda it: _flushing(_anchors(it, p), p, buckets, short), SENT)
    marks = store.put(_repeats(sent, short).join(classes.select("key", "rep"), "key"), "marks")
    near = likely_rows(docs, "key", marks, "key").withColumnRenamed("key", "k")
    # one row of each text; the key holds the doc_id, so copies of a hot text spread over all tasks
    near = near.join(marks, (F.col("k") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("rep")))
    sent = near.select("key", "text", "pos").mapInArrow(
        lambda it: _flushing(_extended(it, p), p, buckets, "<u8"), SENT)
    spans = (_repeats(sent, "<u8").join(copied, "key", "left_anti")
             .mapInArrow(lambda it: _spans(it, p.window), f"key binary, spans {SPANS}"))
    every = spans.select("key", F.lit(False).alias("whole"), "spans").unionAll(
        copied.select("key", F.lit(True).alias("whole"), F.expr(f"cast(null as {SPANS})").alias("spans")))
    return store.put(every, "spans")


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [c for c in batch.schema.names if c not in ("text", "whole", "spans")]
        for i, j, words in texts_in_chunks(batch.column("text"), NOT_SPACE, False):
            n = words.count
            edge = np.zeros(len(words.start) + 1, np.int64)
            for r, (whole, spans) in enumerate(zip(batch.column("whole").slice(i, j - i).to_pylist(),
                                                   batch.column("spans").slice(i, j - i).to_pylist(), strict=True)):
                if whole and n[r] >= window:
                    spans = [{"start": 0, "end": int(n[r])}]
                for s in spans or ():
                    edge[words.first[r] + s["start"]] += 1
                    edge[words.first[r] + s["end"]] -= 1
            stay = np.cumsum(edge[:-1]) == 0
            size = (words.end - words.start + 1)[stay]  # a word and the space behind it
            text = np.append(words.data, np.uint8(0x20))[ranges(words.start[stay], size)]
            text[np.cumsum(size) - 1] = 0x20
            count = np.concatenate(([0], np.cumsum(stay)))[words.first]
            cut = np.concatenate(([0], np.cumsum(size)))[count]
            raw = text.tobytes()
            kept = [raw[a:max(a, b - 1)].decode() for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(i, j - i) for c in keep), pa.array(n, pa.int64()),
                 pa.array(n - np.diff(count), pa.int64()), pa.array(kept, pa.string())],
                names=[*keep, "n_words", "n_removed", "kept_text"])


def without_repeats(docs: DataFrame, spans: DataFrame, p: Cover = Cover()) -> DataFrame:
    """``docs`` (doc_id, text) with n_words, n_removed and kept_text (the
    words outside ``spans``, joined by one space). Only texts that may hold a
    span are shuffled."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("key", text_key(F.col("text")))
    some = likely_rows(docs, "key", spans, "key").join(spans, "key", "left")
    rest = likely_rows(docs, "key", spans, "key", likely=False)
    rest = rest.withColumns({"whole": F.lit(False), "spans": F.expr(f"cast(null as {SPANS})")})
    cols = ["doc_id", "text", "whole", "spans"]
    schema = docs.select("doc_id").schema
    for c, kind in (("n_words", T.LongType()), ("n_removed", T.LongType()), ("kept_text", T.StringType())):
        schema = schema.add(c, kind)
    return some.select(cols).unionAll(rest.select(cols)).mapInArrow(lambda it: _cut(it, p.window), schema)
