"""Spelling variants: words one edit apart, found by blocked Gram matrices.

1. Runs of letters are counted per task and added up per word in Spark.
2. A word is a vector of letter counts. One edit moves it by a squared
   distance of at most 2, and ``|x|^2 + |y|^2 - 2 x.y`` over a whole block is a
   matrix product. Blocks pair the words of one length with those of the same
   and the next length. One edit leaves the first or the last half of the
   shorter word as it is, so a length is cut into blocks by a hash of each half:
   every pair of near words shares a block, and blocks stay small. A block
   beyond ``limit`` words is cut into parts, each pair of parts in a task of
   its own; no word or pair is left out.
3. Pairs at a distance of at most 2 are verified letter by letter. Only near
   pairs leave a task, in the block of the half that they share.
4. The form of a word is its most frequent near word, if at least ``ratio``
   times as frequent; forms are followed to the last by pointer doubling.

Defined results: a null or empty text has no words; a null doc_id reads as an
empty text in the typing-error rule; repeated rows count as often as they
occur; no words give no rows; other columns are ignored. Of near words that
are equally frequent the smallest in code-point order is the form.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Store, small_batches

LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]
_SLOT = np.full(0x100, -1, np.int64)
_SLOT[LETTERS] = np.arange(len(LETTERS))
HELD_LETTERS = 8 << 20  # letters of distinct words that a task keeps before it passes them on


@dataclass(frozen=True)
class Spelling:
    """Words have ``least`` letters and ``times`` occurrences at least. Where
    ``slip`` divides crc32("<doc_id>:<run>"), the run loses one letter there."""

    least: int = 7
    times: int = 2
    ratio: int = 10
    slip: int = 31
    block: int = 1024   # words aimed at in a block
    limit: int = 2048   # words of a part of a block


def _runs(batches: Iterator[pa.RecordBatch], p: Spelling) -> Iterator[pa.RecordBatch]:
    """Partial counts (word, n)."""
    run = re.compile("[a-zÀ-ÿ]{%d,}" % p.least)
    counts: Counter[str] = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                                         names=["word", "n"])
        counts.clear()
        return out

    held = 0
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if not text:
                continue
            seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
            lowered = text.encode().lower().decode()  # of bytes: A-Z only
            for w, n in Counter(run.findall(lowered)).items():
                h = zlib.crc32(w.encode(), seed)
                if h % p.slip == 0:
                    at = h % len(w)
                    w = w[:at] + w[at + 1:]
                    if len(w) < p.least:
                        continue
                if w not in counts:
                    held += len(w)
                counts[w] += n
            if held > HELD_LETTERS:
                yield flush()
                held = 0
    yield flush()


def word_counts(docs: DataFrame, p: Spelling = Spelling()) -> DataFrame:
    """``docs`` (doc_id, text) -> word, n over all documents."""
    small_batches(docs.sparkSession)
    parts = (docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
             .mapInArrow(lambda it: _runs(it, p), "word string, n bigint"))
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= p.times)


def letter_counts(words: list[str]) -> np.ndarray:
    """One row of letter counts per word. Single precision is exact up to words
    of 2,000 letters, double precision beyond."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    size = np.fromiter(map(len, words), np.int64, len(words))
    cell = np.repeat(np.arange(len(words)), size) * len(LETTERS) + _SLOT[points]
    kind = np.float32 if size.max(initial=0) < 2000 else np.float64
    return np.bincount(cell, minlength=len(words) * len(LETTERS)).reshape(len(words), -1).astype(kind)


def within_two(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of x and y at a squared distance of at most 2, by one product."""
    gram = x @ y.T
    gram *= -2
    gram += (x * x).sum(axis=1)[:, None]
    gram += (y * y).sum(axis=1)[None, :]
    return np.nonzero(gram <= 2.5)


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes b of a."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def _near(key, table: pa.Table) -> pa.Table:
    """The near pairs of one pair of parts, each in both directions. A pair that
    shares its first half is left to the block of that half."""
    length, side, i, j = (k.as_py() for k in key)
    words, n = table["word"].to_pylist(), table["n"].to_pylist()
    part, half = table["part"].to_numpy(), table["half"].to_pylist()
    size = np.fromiter(map(len, words), np.int64, len(words))
    vectors, cut = letter_counts(words), length // 2
    found: tuple[list, list, list] = ([], [], [])
    short = size == length
    for left, right in ((i, j), (j, i)) if i != j else ((i, i),):
        rows = np.flatnonzero(short & (part == left))
        for cols in (np.flatnonzero(short & (part == right)), np.flatnonzero(~short & (part == right))):
            same = len(cols) and size[cols[0]] == length
            if not len(rows) or not len(cols) or (same and left > right):
                continue
            for a, b in zip(*within_two(vectors[rows], vectors[cols]), strict=True):
                a, b = rows[a], cols[b]
                if same and left == right and a >= b:
                    continue
                if half[a] != half[b] or (side == 1 and words[a][:cut] == words[b][:cut]):
                    continue
                if one_edit(words[a], words[b]):
                    for u, v in ((a, b), (b, a)):
                        for column, value in zip(found, (words[u], words[v], n[v]), strict=True):
                            column.append(value)
    return pa.table({"word": pa.array(found[0], pa.string()), "near": pa.array(found[1], pa.string()),
                     "near_n": pa.array(found[2], pa.int64())})


def near_words(words: DataFrame, store: Store, p: Spelling = Spelling()) -> DataFrame:
    """``words`` (word, n; distinct) -> word, near, near_n: every pair of near
    words in both directions."""
    small_batches(words.sparkSession)
    sized = words.select("word", "n", F.char_length("word").alias("len"))
    lengths = sized.groupBy("len").agg(F.count(F.lit(1)).alias("words"))
    # a length's blocks hold its words and those one letter longer
    blocks = (lengths.select(F.col("len").alias("length"), "words", F.lit(True).alias("own"))
              .unionAll(lengths.select(F.col("len") - 1, "words", F.lit(False)))
              .groupBy("length").agg(F.sum("words").alias("words"), F.bool_or("own").alias("own"))
              .where("own").select("length", F.ceil(F.col("words") / p.block).alias("blocks")))
    placed = (sized.withColumn("length", F.explode(F.array(F.col("len"), F.col("len") - 1)))
              .withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
              .withColumn("half", F.expr("if(side = 0, substring(word, 1, length div 2), "
                                         "right(word, length - length div 2))"))
              .join(blocks, "length")
              .withColumn("block", F.pmod(F.xxhash64("half"), F.col("blocks"))))
    placed = store.put(placed.select("length", "side", "block", "half", "word", "n"), "placed")
    parts = (placed.groupBy("length", "side", "block")
             .agg(F.count(F.lit(1)).alias("size"), F.sum(F.char_length("word")).alias("letters")).where("size > 1")
             .select("length", "side", "block",
                     F.greatest(F.ceil(F.col("size") / p.limit), F.ceil(F.col("letters") / (p.limit * 1024))).alias("parts")))
    dealt = (placed.join(parts, ["length", "side", "block"])
             .withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)))
             .withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other")))

    def task(key, table):
        length, side, _, i, j = key
        return _near((length, side, i, j), table)

    return (dealt.select("length", "side", "block", "i", "j", "part", "half", "word", "n")
            .groupBy("length", "side", "block", "i", "j").applyInArrow(task, "word string, near string, near_n bigint"))


def roots(forms: DataFrame, store: Store) -> DataFrame:
    """``forms`` (word, form) -> word, root: where following forms ends. Every
    round doubles the steps taken; a form is more frequent than its word, so
    there is no circle."""
    at = store.put(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        step = store.put(at.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"),
                                                               F.col("ahead").isNotNull().alias("moved")), "roots")
        store.drop(at)
        at = step.select("word", "root")
        at._stored_at = step._stored_at
        if step.where("moved").isEmpty():
            return at


def spelling_variants(docs: DataFrame, store: Store, p: Spelling = Spelling()) -> DataFrame:
    """``docs`` (doc_id, text) -> one row per word: word, n, n_near, form,
    form_n, root."""
    words = store.put(word_counts(docs, p), "words")
    near = store.put(near_words(words, store, p), "near")
    best = (near.groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"),
                 F.min(F.struct((-F.col("near_n")).alias("least"), "near")).alias("best"))
            .select("word", "n_near", F.col("best.near").alias("form"), (-F.col("best.least")).alias("form_n")))
    judged = words.join(best, "word", "left")
    good = F.col("form_n") >= F.lit(p.ratio) * F.col("n")
    judged = store.put(judged.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                                     F.when(good, F.col("form")).alias("form"),
                                     F.when(good, F.col("form_n")).alias("form_n")), "judged")
    ends = roots(judged.where("form is not null").select("word", "form"), store)
    return (judged.join(ends, "word", "left")
            .select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))
