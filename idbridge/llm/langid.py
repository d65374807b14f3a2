"""Language identification with string kernels.

The kernel of two texts is the number of n-grams of 1 to 3 bytes (lower-cased)
that both contain, over the root of the product of their own numbers: a
blended-spectrum presence kernel. A bounded sample of labelled rows is fitted
by one-versus-rest kernel ridge regression in the Nystrom space of a few
landmark texts. Scoring is a product of two matrices per block of texts: gram
presence by landmark presence, then landmark weights.

Counts of labels and the choice of the sample cover all labelled rows; the
sample is the ``per_lang`` rows of each language least by a hash of their
text (fewer where there are many languages), which is the same on every run.
Every language that occurs is learned; sample and model grow with the number
of languages, not with that of rows.

Defined results: a null text, or one with no letter, is ``und`` with score 0;
with no labelled row at all every text is ``und``; rows with null lang teach
nothing; every row gives one row; other columns pass through or are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import small_batches
from .words import _LOWER as LOWER
from .words import chunks, utf8

UND = "und"


@dataclass(frozen=True)
class Kernel:
    """``slots``: grams are hashed to so many columns (a power of two)."""

    longest: int = 3
    slots: int = 1 << 14
    per_lang: int = 256  # sample rows of each language
    rows: int = 4096  # sample rows in all: many languages share them evenly, with ``landmarks`` rows each at least
    landmarks: int = 32  # of each language
    ridge: float = 1e-2
    block: int = 64  # texts per matrix product

    def sampled(self, langs: int) -> int:
        """Sample rows of each of so many languages."""
        return min(self.per_lang, max(self.landmarks, self.rows // max(1, langs)))


def presence(data: np.ndarray, offsets: np.ndarray, p: Kernel) -> np.ndarray:
    """Texts by slots, 1 where the text contains a gram of the slot."""
    out = np.zeros((len(offsets) - 1, p.slots), np.float32)
    flat, shift = out.reshape(-1), np.uint32(32 - (p.slots.bit_length() - 1))
    lower = LOWER[data].astype(np.uint32)
    text = np.repeat(np.arange(len(offsets) - 1) * p.slots, np.diff(offsets))
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(lower))  # bytes to the text's end
    code = np.zeros(len(lower), np.uint32)
    for n in range(1, p.longest + 1):
        code[:len(lower) - n + 1] |= lower[n - 1:] << np.uint32(8 * (n - 1))
        slot = ((code + np.uint32(n << 24)) * np.uint32(2654435761)) >> shift
        ok = left >= n
        flat[text[ok] + slot[ok]] = 1
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    """Unit rows, in the place of ``x``."""
    x /= np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
    return x


@dataclass
class Model:
    langs: list[str]
    landmarks: np.ndarray  # landmarks by slots, unit rows
    weights: np.ndarray  # landmarks by languages
    kernel: Kernel

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts by languages: the ridge regression's values."""
        return (_unit(presence(data, offsets, self.kernel)) @ self.landmarks.T) @ self.weights


def fit(x: np.ndarray, langs: list[str], p: Kernel) -> Model | None:
    """Kernel ridge regression in the Nystrom space of the landmarks, from
    the presence rows ``x`` of labelled texts, which become unit rows: the
    driver holds them once."""
    names = sorted(set(langs))
    if not names:
        return None
    x = _unit(x)
    label = np.array([names.index(v) for v in langs])
    pick = np.concatenate([np.flatnonzero(label == k)[:p.landmarks] for k in range(len(names))])
    marks = x[pick]
    near, among = (x @ marks.T).astype(np.float64), (marks @ marks.T).astype(np.float64)
    # k(x, .) ~ near @ among^-1/2: the regression runs on those features
    value, vector = np.linalg.eigh(among + 1e-6 * np.eye(len(marks)))
    root = vector @ np.diag(np.maximum(value, 1e-6) ** -0.5) @ vector.T
    feats = near @ root
    target = np.where(label[:, None] == np.arange(len(names)), 1.0, -1.0)
    share = 1.0 / np.bincount(label, minlength=len(names))[label]  # each language weighs the same
    gram = (feats * share[:, None]).T @ feats + p.ridge * np.eye(len(marks))
    weights = root @ np.linalg.solve(gram, (feats * share[:, None]).T @ target)
    return Model(names, marks.astype(np.float32, copy=False), weights.astype(np.float32), p)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _predict(batches: Iterator[pa.RecordBatch], model: Model | None, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("text")
        n = len(column)
        lang, score = [UND] * n, np.zeros(n)
        if model is not None:
            data, offsets = utf8(column)
            for i, j in chunks(offsets, 1 << 18):
                for a in range(i, j, model.kernel.block):
                    b = min(a + model.kernel.block, j)
                    f = model.scores(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                    best = f.argmax(axis=1)
                    score[a:b] = np.clip((f[np.arange(b - a), best] + 1) / 2, 0, 1)
                    lang[a:b] = [model.langs[k] for k in best]
            for r, text in enumerate(column):
                if not has_letter(text.as_py() or ""):
                    lang[r], score[r] = UND, 0.0
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in keep), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
            names=[*keep, "lang_pred", "score"])


def _packed(batches: Iterator[pa.RecordBatch], p: Kernel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for i, j in chunks(offsets, 1 << 18):
            bits = np.packbits(presence(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], p) > 0, axis=1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in ("lang", "key")),
                                              pa.array([r.tobytes() for r in bits], pa.binary())],
                                             names=["lang", "key", "bits"])


def sample(docs: DataFrame, teaches: Column, p: Kernel) -> tuple[np.ndarray, list[str]]:
    """Presence rows and labels of at most ``p.sampled`` texts of every
    language, those least by a hash of the whole text. The choice covers all labelled rows and does not depend on
    partitions; equal texts count once. The driver gets slots / 8 bytes for
    each, however long the text."""
    known = docs.where(teaches & F.col("lang").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    known = known.where(F.col("text").rlike(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]")).withColumn("key", F.xxhash64("text"))
    every = known.groupBy("lang").count().collect()  # a row for each language
    most = p.sampled(len(every))
    # the least hashes are looked for below a bound that leaves a few times as many rows of each language; a language
    # whose texts repeat too often to fill it is looked for again below a higher one
    share, keys = {r["lang"]: 8 * most / r["count"] for r in every}, []
    while share:
        bounds = docs.sparkSession.createDataFrame(
            [(name, int(min(part, 1.0) * 2**64) - 2**63 - 1) for name, part in sorted(share.items())], "lang string, bound bigint")
        below = known.select("lang", "key").join(F.broadcast(bounds), "lang").where("key <= bound")
        nth = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
        got = (below.select("lang", "key").distinct().withColumn("nth", nth)
               .where(F.col("nth") <= most).select("lang", "key").collect())
        full = Counter(r["lang"] for r in got)
        again = {name: part * 64 for name, part in share.items() if part < 1 and full[name] < most}
        keys += [r for r in got if r["lang"] not in again]
        share = again
    if not keys:
        return np.empty((0, p.slots), np.float32), []
    rows = (known.where(F.col("key").isin([r["key"] for r in keys])).select("lang", "key", "text")
            .mapInArrow(lambda it: _packed(it, p), "lang string, key bigint, bits binary")
            .groupBy("lang", "key").agg(F.min("bits").alias("bits")).collect())
    wanted = {(r["lang"], r["key"]) for r in keys}
    rows = sorted((r for r in rows if (r["lang"], r["key"]) in wanted), key=lambda r: (r["lang"], r["key"]))
    x = np.empty((len(rows), p.slots), np.float32)
    for k, r in enumerate(rows):
        x[k] = np.unpackbits(np.frombuffer(r["bits"], np.uint8))
    return x, [r["lang"] for r in rows]


def identify(docs: DataFrame, teaches: Column, p: Kernel = Kernel()) -> DataFrame:
    """``docs`` (text, lang, ...) with lang_pred and score for every row,
    learned from the rows where ``teaches`` holds. Columns of these two names
    are replaced."""
    spark = docs.sparkSession
    small_batches(spark)
    model = fit(*sample(docs, teaches, p), p)
    shared = spark.sparkContext.broadcast(model)  # landmarks rows of each language
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema
    schema = schema.add("lang_pred", T.StringType()).add("score", T.DoubleType())
    return (docs.select(*[F.col(f"`{c}`") for c in keep])
            .mapInArrow(lambda it: _predict(it, shared.value, keep), schema))
