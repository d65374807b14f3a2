"""Alignment of two tokenizers' tokens over the same text.

1. A text is encoded by both. The byte offsets at which a token ends are kept
   in one dictionary per side, from end to index; the offsets in both, sorted,
   cut both id lists into groups of equal bytes.
2. Inside a group, each stretch between neighbouring ends (of either side)
   lies in one token of A and one of B: that is a link, and every pair of
   tokens whose bytes overlap has exactly one such stretch.
3. How many documents hold a pair of ids linked is added up in Spark. A task
   gathers documents into chunks and passes on each pair once per chunk, with
   its number of documents there, so what is shuffled follows the chunks'
   vocabularies, not the texts. The totals come back per chunk and meet its
   documents again in a cogroup; a frequent pair is one row per chunk, never
   one per document, and no table of all pairs is collected or broadcast.

Memory of a task follows a chunk (16 MB of text) or the longest text.

Defined results: texts that are null, empty, or not given back byte by byte by
both tokenizers have no tokens: zeros and an empty string. Special tokens
written in a text are plain text. Every row is a document, repeated or not;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import PRETOKEN, Encoder, Merges, load
from .store import Store, small_batches
from .words import chunks, ranges, utf8

PAIR = 1 << 24  # a pair's code is a * PAIR + b

ALIGNED = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
           "chunk bigint, links binary, times binary, codes array<bigint>, docs array<int>")


def pack(values: np.ndarray) -> bytes:
    """32-bit numbers by byte planes, which compress well when they are small."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(np.frombuffer(data, np.uint8).reshape(4, -1).T.tobytes(), "<u4").astype(np.int64)


class Pair:
    """Both tokenizers, with every id's bytes."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        m = load(path_a)
        self.bytes_a = m.token
        self.encode_a = self._by_rank(m) if self._in_rank_order(m) else self._by_merges(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.len_a = np.fromiter(map(len, self.bytes_a), np.int64, len(self.bytes_a))
        self.len_b = np.fromiter(map(len, self.bytes_b), np.int64, len(self.bytes_b))
        digits = [b"%d," % i for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.digit_start = np.concatenate(([0], np.cumsum([len(d) for d in digits])))
        self.digits = np.frombuffer(b"".join(digits), np.uint8)

    @staticmethod
    def _in_rank_order(m: Merges) -> bool:
        """Whether ids follow the merge list, as ranked vocabularies have them."""
        made = m.made[np.argsort(m.rank)]
        return bool((np.diff(made) > 0).all()) and (not len(made) or made[0] > m.byte_id.max())

    @staticmethod
    def _by_rank(m: Merges):
        import tiktoken

        named = set(m.special.values())
        ranks = {t: i for i, t in enumerate(m.token) if i not in named}
        encode = tiktoken.Encoding("ranked", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return lambda texts: list(map(encode, texts))

    @staticmethod
    def _by_merges(path: str):
        encoder = Encoder(path)
        encoder.special = None  # written in a text they are plain text
        return lambda texts: [ids.tolist() for ids in encoder.encode(texts)]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both sides; None where a text has no tokens by the rule."""
        some = [k for k, t in enumerate(texts) if t]
        out: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(texts)
        spaced = [" " + texts[k] for k in some]
        ids_b = self.b.encode([texts[k] for k in some], num_threads=1)
        for k, text, a, b in zip(some, spaced, self.encode_a(spaced), ids_b, strict=True):
            want = text.encode()
            if (b"".join(map(self.bytes_a.__getitem__, a)) == want
                    and b"".join(map(self.bytes_b.__getitem__, b)) == want):
                out[k] = np.array(a, np.int64), np.array(b, np.int64)
        return out

    def align(self, a: np.ndarray, b: np.ndarray) -> "Alignment":
        return Alignment(a, b, np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b]))

    def digest(self, x: "Alignment") -> str:
        """SHA-256 of the groups as ``a1,a2|b1;a3|b2,b3``."""
        n_a, n_b = len(x.a), len(x.b)
        group_a = np.searchsorted(x.cut_a, np.arange(n_a), "right")
        group_b = np.searchsorted(x.cut_b, np.arange(n_b), "right")
        at_a = np.arange(n_a) + np.concatenate(([0], x.cut_b))[group_a]  # behind the earlier groups' tokens of B
        at_b = np.arange(n_b) + x.cut_a[group_b]                          # behind the tokens of A up to the own group
        ids, mark = np.empty(n_a + n_b, np.int64), np.full(n_a + n_b, ord(","), np.uint8)
        ids[at_a], ids[at_b] = x.a, x.b
        mark[at_a[x.cut_a - 1]] = ord("|")
        mark[at_b[x.cut_b - 1]] = ord(";")
        size = self.digit_start[ids + 1] - self.digit_start[ids]
        text = self.digits[ranges(self.digit_start[ids], size)]
        text[np.cumsum(size) - 1] = mark
        return hashlib.sha256(text[:-1].tobytes()).hexdigest()


class Alignment:
    """Groups and links of two id lists. ``cut_a[g]`` and ``cut_b[g]``: where
    group g ends in each list; ``link_a[i]``, ``link_b[i]``: token positions."""

    def __init__(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray):
        self.a, self.b = a, b
        index_a = dict(zip(ends_a.tolist(), range(1, len(a) + 1), strict=True))
        index_b = dict(zip(ends_b.tolist(), range(1, len(b) + 1), strict=True))
        common = list(filter(index_b.__contains__, index_a))  # the intersection, in order since the ends ascend
        self.cut_a = np.fromiter(map(index_a.__getitem__, common), np.int64, len(common))
        self.cut_b = np.fromiter(map(index_b.__getitem__, common), np.int64, len(common))
        self._ends = ends_a, ends_b

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the linked tokens: all slices' stretches in a row."""
        ends = np.sort(np.concatenate(self._ends), kind="stable")  # two ascending runs: a merge
        ends = ends[np.append(ends[1:] != ends[:-1], True)]
        return tuple(np.searchsorted(e, ends) for e in self._ends)

    def groups(self) -> list[dict]:
        at_a, at_b = [0, *self.cut_a.tolist()], [0, *self.cut_b.tolist()]
        return [{"a": self.a[i:j].tolist(), "b": self.b[k:m].tolist()}
                for i, j, k, m in zip(at_a, at_a[1:], at_b, at_b[1:], strict=False)]


@lru_cache(maxsize=2)
def pair(path_a: str, path_b: str) -> Pair:
    """One pair of tokenizers per Python worker."""
    return Pair(path_a, path_b)


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str], int]]:
    column = batch.column("text")
    _, offsets = utf8(column)
    for i, j in chunks(offsets):
        yield i, [t or "" for t in column.slice(i, j - i).to_pylist()], int(offsets[j] - offsets[i])


def _aligned(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str, chunk_rows: int,
             chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    both, part, nth = pair(path_a, path_b), TaskContext.get().partitionId(), 0
    rows: list[tuple] = []       # doc_id, n_a, n_b, n_groups, n_links, digest
    held: list[np.ndarray] = []  # the distinct codes of each row, with how often
    often: list[np.ndarray] = []
    size = 0

    def flush() -> pa.RecordBatch:
        codes, at, docs = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
        cut = np.cumsum([len(x) for x in held])[:-1]
        links = [pack(x) for x in np.split(at, cut)]
        first = [None] * (len(rows) - 1)
        columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), [pa.int64()] * 5 + [pa.string()], strict=True)]
        out = pa.RecordBatch.from_arrays(
            [*columns, pa.array([part << 32 | nth] * len(rows), pa.int64()), pa.array(links, pa.binary()),
             pa.array(map(pack, often), pa.binary()), pa.array([codes, *first], pa.list_(pa.int64())),
             pa.array([docs.astype(np.int32), *first], pa.list_(pa.int32()))], names=NAMES)
        rows.clear(), held.clear(), often.clear()
        return out

    none = np.empty(0, np.int64)
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for i, texts, n_bytes in _pieces(batch):
            for k, got in enumerate(both.encode(texts)):
                if got is None:
                    rows.append((ids[i + k], 0, 0, 0, 0, ""))
                    held.append(none)
                    often.append(none)
                    continue
                x = both.align(*got)
                link_a, link_b = x.links()
                codes, times = np.unique(x.a[link_a] * PAIR + x.b[link_b], return_counts=True)
                rows.append((ids[i + k], len(x.a), len(x.b), len(x.cut_a), len(link_a), both.digest(x)))
                held.append(codes)
                often.append(times)
            size += n_bytes
            if size > chunk_bytes or len(rows) > chunk_rows:
                yield flush()
                nth, size = nth + 1, 0
    if rows:
        yield flush()


NAMES = [c.split()[0] for c in ALIGNED.split(", ")]


def align(docs: DataFrame, path_a: str, path_b: str, chunk_rows: int = 1 << 14,
          chunk_bytes: int = 16 << 20) -> DataFrame:
    """``docs`` (doc_id, text) -> per row doc_id, n_a, n_b, n_groups, n_links,
    groups_sha256 and the links of its chunk, as ``link_counts`` and ``agreement``
    read them. Store it before use: chunk numbers hold for one run only."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(lambda it: _aligned(it, path_a, path_b, chunk_rows, chunk_bytes), ALIGNED)


def _grouped(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    both = pair(path_a, path_b)
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
    for batch in batches:
        for i, texts, _ in _pieces(batch):
            groups = [both.align(*got).groups() if got else [] for got in both.encode(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, len(texts)), pa.array(groups, kind)],
                                             names=["doc_id", "groups"])


def groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, groups: both sides' ids of every group."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(lambda it: _grouped(it, path_a, path_b),
                            "doc_id bigint, groups array<struct<a: array<int>, b: array<int>>>")


def _chunk_pairs(aligned: DataFrame) -> DataFrame:
    """Every chunk's pairs once: chunk, pos, code, docs."""
    return (aligned.where("codes is not null")
            .select("chunk", F.posexplode(F.arrays_zip("codes", "docs")).alias("pos", "x"))
            .select("chunk", "pos", F.col("x.codes").alias("code"), F.col("x.docs").alias("docs")))


def link_counts(aligned: DataFrame) -> DataFrame:
    """Stored ``align`` rows -> a, b, n: documents that hold the pair linked."""
    return (_chunk_pairs(aligned).groupBy("code").agg(F.sum("docs").alias("n"))
            .select(F.expr(f"code div {PAIR}").alias("a"), F.expr(f"code % {PAIR}").alias("b"), "n"))


def _summed(rows: pa.Table, pairs: pa.Table) -> pa.Table:
    """n_best and count_sum of one chunk's rows."""
    n, best = np.zeros(pairs.num_rows, np.int64), np.zeros(pairs.num_rows, bool)
    at = pairs["pos"].to_numpy()
    n[at], best[at] = pairs["n"].to_numpy(), pairs["best"].combine_chunks().to_numpy(zero_copy_only=False)
    n_best, total = [], []
    for links, times in zip(rows["links"].to_pylist(), rows["times"].to_pylist(), strict=True):
        x, often = unpack(links), unpack(times)
        n_best.append(int(often[best[x]].sum()))
        total.append(int((n[x] * often).sum()))
    kept = rows.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
    return (kept.append_column("n_best", pa.array(n_best, pa.int64()))
            .append_column("count_sum", pa.array(total, pa.int64())))


def agreement(aligned: DataFrame, store: Store) -> DataFrame:
    """Stored ``align`` rows -> doc_id, n_a, n_b, n_groups, n_links,
    groups_sha256, n_best (links whose count is the highest of their A id) and
    count_sum (over all links)."""
    counts = link_counts(aligned)
    counts = store.put(counts, "counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    judged = (counts.join(most, "a")
              .select((F.col("a") * PAIR + F.col("b")).alias("code"), "n", (F.col("n") == F.col("most")).alias("best")))
    back = _chunk_pairs(aligned).join(judged, "code").select(F.col("chunk").alias("of"), "pos", "n", "best")
    rows = aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "chunk", "links", "times")
    return (rows.groupBy("chunk").cogroup(back.groupBy("of"))
            .applyInArrow(_summed, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                                   "groups_sha256 string, n_best bigint, count_sum bigint"))
