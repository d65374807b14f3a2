"""Byte-level BPE as a streaming transducer with bounded lookahead.

Merges act inside pretokens. How far a byte can change the tokens to its left
is a constant of the merge list: a boundary further left changes only through
a chain of merges of rising rank, each of which takes the left end of the one
before. ``lookahead`` finds the longest such chain. A pretoken is read in
windows; tokens that end at least that far before the window's end are stable
and are emitted, and reading goes on from the last of them. Memory per
pretoken is the window, whatever its length.

All windows of a batch are merged at once on arrays: in each round every
window joins the pairs of its least rank. Encodings of short pretokens are
kept in a table of bounded size.

Decoding feeds the tokens' bytes, piece by piece, to an incremental UTF-8
state machine, which keeps at most three bytes between pieces.

Defined results: a null text is empty; empty texts have no tokens; every row
gives one row, repeated or not.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import small_batches
from .words import chunks, ranges, utf8

# Fixed values of byte-level BPE: the pretoken pattern, and the bytes that a
# vocabulary file writes as themselves (others follow from code point 256 on).
PRETOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]

KNOWN_MAX = 200_000  # encodings kept per Python worker
DECODE_TOKENS = 1 << 16


def file_bytes() -> dict[str, int]:
    rest = [b for b in range(256) if b not in set(PRINTED)]
    return {chr(b): b for b in PRINTED} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Merges:
    """A vocabulary: ``token[i]`` are the bytes of id i; ``pair`` sorted codes
    left << 32 | right of the merges, with their ``rank`` and result ``made``."""

    token: list[bytes]
    byte_id: np.ndarray
    pair: np.ndarray
    rank: np.ndarray
    made: np.ndarray
    special: dict[str, int]
    lookahead: int

    @property
    def longest(self) -> int:
        return max(map(len, self.token))


def lookahead(rules: list[tuple[int, int, int]], length: list[int]) -> int:
    """Bytes to the left of a cut that the text behind the cut can affect.

    ``rules``: (left, right, result) by rank. Behind the cut's left side, some
    token z may or may not be taken by a rule (z, s). Either way the boundary
    left of z can change only by a later rule (q, z) or (q, zs), which then
    does the same to q, and so on; a rule (z, s) that only lengthens z to the
    right leaves the boundary where it is. ``reach[t]`` is the furthest such
    chain from a boundary left of t, over the rules that are still to come."""
    reach, most = [0] * len(length), 0
    for left, right, result in reversed(rules):
        on = max(reach[left], reach[result])
        most = max(most, length[left] + on)
        reach[right] = max(reach[right], length[left] + on)
        reach[left] = max(reach[left], reach[result])
    return most + max(length)


@lru_cache(maxsize=2)
def load(path: str) -> Merges:
    """A vocabulary file of the tokenizers library (byte-level BPE)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    to_byte, vocab = file_bytes(), spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    token = [b""] * (max([*vocab.values(), *special.values()]) + 1)
    for text, i in vocab.items():
        token[i] = text.encode() if text in special else bytes(to_byte[c] for c in text)
    for text, i in special.items():
        token[i] = text.encode()
    rules = []
    for m in spec["model"]["merges"]:
        left, right = m.split(" ") if isinstance(m, str) else m
        rules.append((vocab[left], vocab[right], vocab[left + right]))
    named = set(special.values())
    reach = lookahead(rules, [0 if i in named else len(t) for i, t in enumerate(token)])
    codes = np.array([a << 32 | b for a, b, _ in rules], np.int64)
    order = np.argsort(codes)
    byte_id = np.array([vocab[c] for c, _ in sorted(to_byte.items(), key=lambda x: x[1])], np.int64)
    return Merges(token, byte_id, codes[order], order.astype(np.int64),
                  np.array([r for _, _, r in rules], np.int64)[order], special, reach)


def _ranks(left: np.ndarray, right: np.ndarray, m: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each pair, or the number of merges where it has none, and its result."""
    code = left << 32 | right
    at = np.searchsorted(m.pair, code)
    at[at == len(m.pair)] = 0
    return np.where(m.pair[at] == code, m.rank[at], len(m.rank)), m.made[at]


def merge_windows(windows: list[bytes], m: Merges) -> list[np.ndarray]:
    """Token ids of each window, by itself: round after round, each window
    joins its pairs of least rank, leftmost first. Only pairs beside a join are
    looked up again; windows with nothing left to join leave."""
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(windows)
    size = np.array([len(w) for w in windows], np.int64)
    which = np.flatnonzero(size)
    size = size[which]
    ids = m.byte_id[np.frombuffer(b"".join(windows), np.uint8)]
    none = len(m.rank)
    rank, made = np.full(len(ids), none), np.zeros(len(ids), np.int64)  # of the pair that begins here
    own = np.repeat(np.arange(len(size)), size)
    if len(ids) > 1 and none:
        rank[:-1], made[:-1] = _ranks(ids[:-1], ids[1:], m)
        rank[:-1][own[:-1] != own[1:]] = none
    while len(ids):
        start = np.cumsum(size) - size
        best = np.minimum.reduceat(rank, start)
        done = best == none
        if done.any():
            for w, a, n in zip(which[done].tolist(), start[done].tolist(), size[done].tolist(), strict=True):
                out[w] = ids[a:a + n]
            stay = ~done[own]
            ids, rank, made = ids[stay], rank[stay], made[stay]
            which, size, best = which[~done], size[~done], best[~done]
            own = np.repeat(np.arange(len(size)), size)
            if not len(ids):
                break
        p = np.flatnonzero(rank == best[own])
        near = p[1:] == p[:-1] + 1
        if near.any():  # runs such as aaaa: every other pair
            run = np.flatnonzero(np.concatenate(([True], ~near)))
            nth = np.arange(len(p)) - np.repeat(run, np.diff(np.append(run, len(p))))
            p = p[nth % 2 == 0]
        ids[p] = made[p]
        size -= np.bincount(own[p], minlength=len(size))
        keep = np.ones(len(ids), bool)
        keep[p + 1] = False
        ids, rank, made, own = ids[keep], rank[keep], made[keep], own[keep]
        q = p - np.arange(len(p))  # where the joins are now
        beside = np.zeros(len(ids), bool)
        beside[q] = beside[q[q > 0] - 1] = True
        q = np.flatnonzero(beside)
        last = (q == len(ids) - 1) | (own[np.minimum(q + 1, len(ids) - 1)] != own[q])
        rank[q[last]] = none
        q = q[~last]
        rank[q], made[q] = _ranks(ids[q], ids[q + 1], m)
    return out


def encode_pretoken(data: bytes, m: Merges, window: int = 0) -> np.ndarray:
    """One pretoken of any length, window by window."""
    window = window or 4 * (m.lookahead + m.longest)
    parts, at = [], 0
    while len(data) - at > window:
        got = merge_windows([data[at:at + window]], m)[0]
        ends = np.cumsum([len(m.token[i]) for i in got])
        stable = int(np.searchsorted(ends, window - m.lookahead, "right"))
        parts.append(got[:stable])
        at += int(ends[stable - 1])
    parts.append(merge_windows([data[at:]], m)[0])
    return np.concatenate(parts)


class Encoder:
    """Encodes whole texts; keeps a bounded table of known pretokens."""

    def __init__(self, path: str):
        self.m = m = load(path)
        names = "|".join(map(regex.escape, m.special))
        self.special = regex.compile(f"({names})") if names else None
        self.pretoken = regex.compile(PRETOKEN)
        self.byte_start = np.concatenate(([0], np.cumsum([len(t) for t in m.token])))
        self.bytes = np.frombuffer(b"".join(m.token), np.uint8)
        digits = [b"%d," % i for i in range(len(m.token))]
        self.digit_start = np.concatenate(([0], np.cumsum([len(t) for t in digits])))
        self.digits = np.frombuffer(b"".join(digits), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.int64)  # of all known pretokens, in a row
        self.first = np.zeros(1, np.int64)

    def _learn(self, new: list[str]) -> None:
        window = 4 * (self.m.lookahead + self.m.longest)
        raw = [w.encode() for w in new]
        ids = merge_windows([r if len(r) <= window else b"" for r in raw], self.m)
        for i, r in enumerate(raw):
            if len(r) > window:
                ids[i] = encode_pretoken(r, self.m)
            if new[i] in self.m.special:
                ids[i] = np.array([self.m.special[new[i]]])
        n = len(self.first) - 1
        self.known.update(zip(new, range(n, n + len(new)), strict=True))
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum([len(x) for x in ids])))
        if self.first[-1] > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty(int(self.first[-1]), np.int64)))
        self.ids[self.first[n]:self.first[-1]] = np.concatenate(ids)

    def _split(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return self.pretoken.findall(text)
        out = []
        for part in self.special.split(text):
            out += [part] if part in self.m.special else self.pretoken.findall(part)
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        if len(self.known) > KNOWN_MAX:
            self._forget()
        split = list(map(self._split, texts))
        new = set().union(*split).difference(self.known)
        if new:
            self._learn(list(new))
        out = []
        for words in split:
            at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            out.append(self.ids[ranges(self.first[at], self.first[at + 1] - self.first[at])])
        return out

    def digest(self, ids: np.ndarray) -> str:
        """SHA-256 of the decimal ids joined by commas."""
        sha = hashlib.sha256()
        for k in range(0, len(ids), DECODE_TOKENS):
            part = ids[k:k + DECODE_TOKENS]
            text = self.digits[ranges(self.digit_start[part], self.digit_start[part + 1] - self.digit_start[part])]
            sha.update(text.tobytes() if k + DECODE_TOKENS < len(ids) else text[:-1].tobytes())
        return sha.hexdigest()

    def decode(self, ids: np.ndarray) -> Iterator[str]:
        """The text of ``ids``, in pieces."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for k in range(0, len(ids), DECODE_TOKENS):
            part = ids[k:k + DECODE_TOKENS]
            data = self.bytes[ranges(self.byte_start[part], self.byte_start[part + 1] - self.byte_start[part])]
            yield machine.decode(data.tobytes())
        yield machine.decode(b"", final=True)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    return Encoder(path)


def _texts(column: pa.Array) -> Iterator[list[str]]:
    """The texts of a column in lists of about a megabyte, or one longer text."""
    _, offsets = utf8(column)
    for i, j in chunks(offsets):
        yield [t or "" for t in column.slice(i, j - i).to_pylist()]


def _round_trip(batches: Iterator[pa.RecordBatch], path: str, keep: list[str],
                with_ids: bool) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    for batch in batches:
        counts, id_sha, text_sha, all_ids = [], [], [], []
        for texts in _texts(batch.column("text")):
            for ids in enc.encode(texts):
                sha = hashlib.sha256()
                for piece in enc.decode(ids):
                    sha.update(piece.encode())
                counts.append(len(ids))
                id_sha.append(enc.digest(ids))
                text_sha.append(sha.hexdigest())
                if with_ids:
                    all_ids.append(ids.astype(np.int32))
        new = [pa.array(counts, pa.int64()), pa.array(id_sha, pa.string()), pa.array(text_sha, pa.string())]
        if with_ids:
            new.append(pa.array(all_ids, pa.list_(pa.int32())))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *new],
                                         names=[*keep, *NEW[:len(new)]])


NEW = ("n_tokens", "ids_sha256", "decoded_sha256", "ids")


def round_trip(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Encode and decode every ``text``: the other columns with n_tokens,
    ids_sha256, decoded_sha256 and, if asked for, ids (array of int). Input
    columns of these names are replaced."""
    small_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c != "text" and c not in NEW[:3 + with_ids]]
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema
    kinds = (T.LongType(), T.StringType(), T.StringType(), T.ArrayType(T.IntegerType()))
    for c, kind in zip(NEW[:3 + with_ids], kinds[:3 + with_ids], strict=True):
        schema = schema.add(c, kind)
    return (docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("text"))
            .mapInArrow(lambda it: _round_trip(it, path, keep, with_ids), schema))


def _counted(batches: Iterator[pa.RecordBatch], path: str, keep: list[str]) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    for batch in batches:
        n = [len(x) for texts in _texts(batch.column("text")) for x in enc.encode(texts)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(n, pa.int64())],
                                         names=[*keep, "n_tokens"])


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``n_tokens`` in place of ``text``."""
    small_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c not in ("text", "n_tokens")]
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema.add("n_tokens", T.LongType())
    return (docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("text"))
            .mapInArrow(lambda it: _counted(it, path, keep), schema))


def _encoded(batches: Iterator[pa.RecordBatch], path: str, keep: list[str]) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    for batch in batches:
        ids = pa.array([x.astype(np.int32) for texts in _texts(batch.column("text")) for x in enc.encode(texts)],
                       pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), ids], names=[*keep, "ids"])


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``ids`` (array of int) in place of ``text``."""
    small_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c not in ("text", "ids")]
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema.add("ids", T.ArrayType(T.IntegerType()))
    return (docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("text"))
            .mapInArrow(lambda it: _encoded(it, path, keep), schema))


def _decoded(batches: Iterator[pa.RecordBatch], path: str, keep: list[str]) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    for batch in batches:
        texts = ["".join(enc.decode(np.asarray(i.as_py() or [], np.int64))) for i in batch.column("ids")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string())],
                                         names=[*keep, "text"])


def decode(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``text`` in place of ``ids``."""
    small_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c not in ("text", "ids")]
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema.add("text", T.StringType())
    return (docs.select(*[F.col(f"`{c}`") for c in keep], "ids")
            .mapInArrow(lambda it: _decoded(it, path, keep), schema))
