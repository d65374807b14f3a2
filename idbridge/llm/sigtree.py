"""N-gram Jaccard join by signature trees.

A document's set are its distinct word shingles; two documents link when
100 * intersection >= percent * union.

1. Documents of equal word sequences form one class, its smallest doc_id stands
   for it. A class gets its set's size, a token bitmap (4 to 8 bits a shingle)
   and its prefix: in an order common to all documents, the first
   size - ceil(percent / 100 * size) + 1 shingles. Linked sets share one of
   their prefix shingles. The order puts the most frequent shingles last (any
   order is exact; theirs keeps passages that many documents share from
   gathering unlike documents).
2. Classes that share a prefix shingle meet in the tree of that shingle's
   smallest set, the tree's owner. Owners repeat from shingle to shingle, so a
   class is in few trees however long its text is.
3. A tree's leaves are sets. Up to ``fan`` neighbours, in the order of size and
   likeness, make a node, which holds the OR of their bitmaps, the range of
   their sizes and the most shingles that a bitmap hides (size less its bits).
   Two nodes are traversed together: no pair of sets below them overlaps in more than
   the common bits plus the lesser number hidden. Pairs of nodes that cannot
   reach the overlap that their sizes ask for, or whose sizes are too far
   apart, are pruned; the others are opened, down to pairs of sets. Bitmaps of
   neighbouring widths are compared folded to the narrower.
4. A task takes many small trees or one block of a large one. Of the pairs it is
   left with it passes on a spanning forest, the likeliest pairs first, and
   those are verified on the words themselves; links make components.
5. What the forests leave open is finished: trees in which a pair failed, and
   blocks of one tree against each other, are traversed again, where nodes of
   one component are pruned. Every pair that is left is verified. No tree,
   partner or pair is capped.

Linked copies, however many, cost one verified pair each. Trees whose sets lie
in one component are closed without comparing their blocks.

Defined results: no words or a null text give an empty set, linked with
nothing; rows that repeat a doc_id count as versions of one document; a row
without doc_id has the component of its class, or none if the class has no
doc_id; other columns are ignored. Candidates go by 64-bit hashes, links by the
words; n_shingles counts distinct 64-bit hashes made from each word's BLAKE2.
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
from .words import NOT_SPACE, Words, mix, ranges, texts_in_chunks, word_shingles

COUNTED_BYTES = 16 << 20  # texts whose shingles are counted together
FREQUENT = 1 << 17        # frequent shingles put last: at most 1 MB in every task
SEEN = 1 << 12            # of each count, passed on
FRONTIER = 1 << 22        # bitmap words compared at once

SIGNED = "doc_id bigint, n_shingles bigint, digest binary, bitmap binary, anchors array<bigint>"


@dataclass(frozen=True)
class Join:
    """Parameters: links have 100 * intersection >= percent * union."""

    shingle: int = 5
    percent: int = 80
    fan: int = 16
    block: int = 512  # sets of a tree in one task
    cell: int = 4096  # rows of small trees in one task

    def prefix(self, size: int) -> int:
        return size - (self.percent * size + 99) // 100 + 1


# ------------------------------------------------------------ sets


def sets_of(words: Words, k: int) -> tuple[list[np.ndarray], list[bytes]]:
    """Sorted distinct shingle hashes of every text, and a digest of its words."""
    h, data, ends = words.coded()
    factor = np.random.default_rng(11).integers(0, 2**64, k, dtype=np.uint64) | np.uint64(1)

    def windows(start: np.ndarray, n: int) -> np.ndarray:
        total = np.full(len(start), n, np.uint64)
        for j in range(n):
            total += h[start + j] * factor[j]
        return mix(total)

    starts, _ = words.all_windows(k)
    full = windows(starts, k)
    n = np.maximum(words.count - k + 1, 0)
    cut = np.concatenate(([0], np.cumsum(n)))
    sets, digests = [], []
    for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
        sets.append(np.unique(full[cut[i]:cut[i + 1]]) if n[i] else
                    windows(np.array([a]), int(b - a)) if b > a else np.empty(0, np.uint64))
        sha = hashlib.blake2b(data[ends[a]:ends[b]].tobytes(), digest_size=16)
        sha.update((ends[a + 1:b + 1] - ends[a]).tobytes())
        digests.append(sha.digest())
    return sets, digests


def _counted(batches: Iterator[pa.RecordBatch], p: Join) -> Iterator[pa.RecordBatch]:
    """Shingles that several texts of the same few megabytes hold (texts of
    equal words once), the most frequent ones."""
    held: dict[bytes, np.ndarray] = {}
    size = 0

    def flush() -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(list(held.values())), return_counts=True)
        held.clear()
        most = np.flatnonzero(n > 2)
        most = most[np.argsort(-n[most], kind="stable")[:SEEN]]
        return pa.RecordBatch.from_arrays([pa.array(h[most].view(np.int64)), pa.array(n[most], pa.int64())], names=["h", "n"])

    for batch in batches:
        for _, _, words in texts_in_chunks(batch.column("text"), NOT_SPACE, True):
            sets, digests = sets_of(words, p.shingle)
            held.update(zip(digests, sets, strict=True))
            size += len(words.data)
            if size > COUNTED_BYTES:
                yield flush()
                size = 0
    if held:
        yield flush()


def frequent(texts: DataFrame, p: Join) -> np.ndarray:
    """At most ``FREQUENT`` shingle hashes, sorted: those that come last in prefixes."""
    got = (texts.select("text").mapInArrow(lambda it: _counted(it, p), "h bigint, n bigint")
           .groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(FREQUENT).select("h").toArrow())
    return np.sort(got["h"].to_numpy().view(np.uint64))


def _bitmap(s: np.ndarray) -> bytes:
    """4 to 8 bits a shingle; the width is a power of two, so that halves fold."""
    width = max(64, 1 << (4 * len(s) - 1).bit_length())
    bits = np.zeros(width, bool)
    bits[(s & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _sign(batches: Iterator[pa.RecordBatch], p: Join, last: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, words in texts_in_chunks(batch.column("text"), NOT_SPACE, True):
            sets, digests = sets_of(words, p.shingle)
            anchors, bitmaps = [], []
            for s in sets:
                if not len(s):
                    anchors.append(None)
                    bitmaps.append(None)
                    continue
                n, order = p.prefix(len(s)), s
                if len(last):
                    at = np.minimum(np.searchsorted(last, s), len(last) - 1)
                    common = last[at] == s
                    if common[:n].any():
                        order = np.concatenate((s[~common], s[common]))
                anchors.append(order[:n].view(np.int64))
                bitmaps.append(_bitmap(s))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(digests, pa.binary()), pa.array(bitmaps, pa.binary()), pa.array(anchors, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "digest", "bitmap", "anchors"])


# ----------------------------------------------------------- trees


class Level:
    """Nodes of one height. ``first``: their children in the level below."""

    def __init__(self, bits, low, high, hidden, owner, low_root, high_root, first=None):
        self.bits, self.low, self.high, self.hidden = bits, low, high, hidden
        self.owner, self.low_root, self.high_root, self.first = owner, low_root, high_root, first

    def above(self, fan: int) -> "Level":
        n = len(self.owner)
        new = np.concatenate(([True], self.owner[1:] != self.owner[:-1]))
        nth = np.arange(n) - np.repeat(np.flatnonzero(new), np.diff(np.append(np.flatnonzero(new), n)))
        at = np.flatnonzero(nth % fan == 0)
        return Level(np.bitwise_or.reduceat(self.bits, at, axis=0), np.minimum.reduceat(self.low, at),
                     np.maximum.reduceat(self.high, at), np.maximum.reduceat(self.hidden, at), self.owner[at],
                     np.minimum.reduceat(self.low_root, at), np.maximum.reduceat(self.high_root, at), np.append(at, n))


def grow(bits: np.ndarray, size: np.ndarray, owner: np.ndarray, root: np.ndarray, fan: int, height: int) -> list[Level]:
    """One tree per owner over sets in a row (owners together), all of ``height`` levels above the leaves."""
    hidden = size - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
    levels = [Level(bits, size, size, hidden, owner, root, root)]
    for _ in range(height):
        levels.append(levels[-1].above(fan))
    return levels


def _open(x: Level, y: Level, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of nodes that may hold a link between different components, with
    the part of the overlap asked for that they can reach (0: pruned)."""
    low_x, low_y = x.low[i], y.low[j]
    fits = (100 * x.high[i] >= percent * low_y) & (100 * y.high[j] >= percent * low_x)
    one = (x.low_root[i] == x.high_root[i]) & (y.low_root[j] == y.high_root[j]) & (x.low_root[i] == y.low_root[j])
    out = np.zeros(len(i))
    rest = np.flatnonzero(fits & ~one)
    step = max(1, FRONTIER // x.bits.shape[1])
    for k in range(0, len(rest), step):
        r = rest[k:k + step]
        common = np.bitwise_count(x.bits[i[r]] & y.bits[j[r]]).sum(axis=1).astype(np.int64)
        most = common + np.minimum(x.hidden[i[r]], y.hidden[j[r]])
        asked = percent * (low_x[r] + low_y[r])
        out[r] = np.where((100 + percent) * most >= asked, (100 + percent) * most / asked, 0)
    return out


def traverse(left: list[Level], right: list[Level] | None, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dual traversal from the roots of the same owners: leaf pairs that are
    left, with the reachable part. ``right`` None: ``left`` against itself."""
    own, other = left, right or left
    at = np.searchsorted(other[-1].owner, own[-1].owner)
    i = np.flatnonzero((at < len(other[-1].owner)) & (other[-1].owner[np.minimum(at, len(other[-1].owner) - 1)]
                                                      == own[-1].owner))
    j = at[i]
    found: list[tuple] = []
    pending = [(len(own) - 1, i, j)]
    while pending:  # the last pairs first, so that few wait
        level, i, j = pending.pop()
        if right is None and level == 0:
            off = i < j
            i, j = i[off], j[off]
        reach = _open(own[level], other[level], i, j, percent)
        keep = reach > 0
        if right is None and level:  # a single set of one component has no pair with itself
            keep &= (i != j) | (np.diff(own[level].first)[i] > 1) | (level > 1)
        i, j, reach = i[keep], j[keep], reach[keep]
        if not len(i):
            continue
        if level == 0:
            found.append((i, j, reach))
            continue
        x, y = own[level].first, other[level].first
        n_x, n_y = x[i + 1] - x[i], y[j + 1] - y[j]
        for part in np.array_split(np.arange(len(i)), max(1, int((n_x * n_y).sum()) >> 20)):
            nx, ny = n_x[part], n_y[part]
            a = np.repeat(ranges(x[i[part]], nx), np.repeat(ny, nx))
            b = ranges(np.repeat(y[j[part]], nx), np.repeat(ny, nx))
            if right is None:
                half = a <= b
                a, b = a[half], b[half]
            pending.append((level - 1, a, b))
    if not found:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _forest(u: np.ndarray, v: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Indices of a spanning forest, the likeliest pairs first."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    out = []
    for k in np.argsort(-reach, kind="stable"):
        a, b = find(int(u[k])), find(int(v[k]))
        if a != b:
            parent[a] = b
            out.append(k)
    return np.array(out, np.int64)


def _pairs(table: pa.Table, p: Join, forest: bool) -> pa.Table:
    """Pairs left by the traversal of a task's trees. ``forest``: all sets
    against each other, a spanning forest by owner; else the queries against the
    others, where components differ."""
    rep, owner, size = (table[c].to_numpy() for c in ("rep", "owner", "n_shingles"))
    root = np.arange(len(rep)) if forest else table["root"].to_numpy()
    query = None if forest else table["query"].combine_chunks().to_numpy(zero_copy_only=False)
    maps = table["bitmap"].to_pylist()
    width = np.fromiter(map(len, maps), np.int64, len(maps))
    alike = np.array([int.from_bytes(m[:8], "little") for m in maps], np.uint64)
    band = np.floor(np.log(size) / np.log(1.25))
    order = np.lexsort((alike, band, owner))
    out: list[tuple] = []

    def trees(at: np.ndarray, w: int, height: int) -> list[Level]:
        bits = []
        for k in at:
            m = np.frombuffer(maps[k], np.uint64)
            bits.append(m if width[k] == w else m[:w // 8] | m[w // 8:])
        return grow(np.stack(bits), size[at], owner[at], root[at], p.fan, height)

    def height(*sides: np.ndarray) -> int:
        most, h = max(int(np.unique(owner[s], return_counts=True)[1].max()) for s in sides), 0
        while p.fan ** h < most:
            h += 1
        return h

    def hold(a: np.ndarray, b: np.ndarray | None, w: int) -> None:
        if not len(a) or (b is not None and not len(b)):
            return
        h = height(a) if b is None else height(a, b)
        i, j, reach = traverse(trees(a, w, h), None if b is None else trees(b, w, h), p.percent)
        if len(i):
            out.append((owner[a[i]], a[i], (a if b is None else b)[j], reach))

    for w in np.unique(width):
        here, wider = order[width[order] == w], order[width[order] == 2 * w]
        if forest:
            hold(here, None, w)
            hold(here, wider, w)
        else:
            for one, two in ((here, here), (here, wider), (wider, here)):
                hold(one[query[one]], two[~query[two]], w)
    if not out:
        return pa.table({c: pa.array([], pa.int64()) for c in ("owner", "u", "v")})
    owned, a, b, reach = (np.concatenate(c) for c in zip(*out, strict=True))
    if forest:
        tree = np.unique(owned, return_inverse=True)[1]
        keep = _forest(tree * len(rep) + a, tree * len(rep) + b, reach)
        owned, a, b = owned[keep], a[keep], b[keep]
    u, v = np.minimum(rep[a], rep[b]), np.maximum(rep[a], rep[b])
    keep = u != v
    return pa.table({"owner": owned[keep], "u": u[keep], "v": v[keep]})


# ------------------------------------------------------------ join


def _verified(batches: Iterator[pa.RecordBatch], p: Join) -> Iterator[pa.RecordBatch]:
    """The exact check on the words of both texts."""
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


def _links(pairs: DataFrame, texts: DataFrame, p: Join) -> DataFrame:
    """Stored ``pairs`` (u, v; distinct) that are links by their words."""
    ids = pairs.select(F.col("u").alias("id")).unionAll(pairs.select(F.col("v").alias("id")))
    bits = min(30, max(22, (16 * pairs.count()).bit_length()))
    some = likely_rows(texts, "doc_id", ids, "id", bits)
    return (pairs.join(some.toDF("u", "text_u"), "u").join(some.toDF("v", "text_v"), "v")
            .select("u", "v", "text_u", "text_v")
            .mapInArrow(lambda it: _verified(it, p), "u bigint, v bigint").distinct())


def _trees(reps: DataFrame, store: Store) -> DataFrame:
    """owner, rep: the classes of every tree, its owner included."""
    keys = reps.select(F.explode("anchors").alias("key"), "rep", "n_shingles")
    heads = (keys.groupBy("key").agg(F.min(F.struct("n_shingles", "rep")).alias("head"), F.max("rep").alias("most"),
                                     F.min("rep").alias("least"))
             .where("least < most").select("key", F.col("head.rep").alias("owner")))
    return store.put(keys.join(heads, "key").select("owner", "rep").distinct(), "trees")


def _first(trees: DataFrame, sizes: DataFrame, bitmaps: DataFrame, store: Store, p: Join) -> DataFrame:
    """Spanning forests of the trees, or of the blocks of large ones (the owner is in all)."""
    cells = max(1, trees.count() // p.cell)
    blocks = F.ceil(F.col("size") / p.block).cast("int")
    block = F.when(F.col("rep") == F.col("owner"), F.sequence(F.lit(0), blocks - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("rep"), blocks).cast("int")))
    large = F.col("size") > p.block
    cell = F.when(large, -1 - F.col("owner")).otherwise(F.pmod(F.xxhash64("owner"), F.lit(cells)))
    dealt = (trees.join(sizes, "owner").withColumn("block", F.explode(block)).withColumn("cell", cell)
             .select("owner", "rep", "cell", "block"))
    return store.put(dealt.join(bitmaps, "rep").groupBy("cell", "block")
                     .applyInArrow(lambda t: _pairs(t, p, True), "owner bigint, u bigint, v bigint"), "forests")


def _second(trees: DataFrame, sizes: DataFrame, bitmaps: DataFrame, forests: DataFrame, links: DataFrame,
            roots: DataFrame, store: Store, p: Join) -> DataFrame:
    """Pairs between components in the trees that the forests leave open."""
    failed = forests.join(links, ["u", "v"], "left_anti").select("owner")
    unsure = failed.unionAll(sizes.where(F.col("size") > p.block).select("owner")).distinct()
    rooted = (trees.join(unsure, "owner").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
              .select("owner", "rep", F.coalesce("root", "rep").alias("root")))
    rooted = store.put(rooted, "unsure")
    parts = rooted.groupBy("owner", "root").agg(F.count(F.lit(1)).alias("n"))
    still = (parts.groupBy("owner").agg(F.max_by("root", F.struct("n", "root")).alias("most"), F.sum("n").alias("size"),
                                        F.max("n").alias("n"), F.count(F.lit(1)).alias("parts"))
             .where("parts > 1")
             .select("owner", "most", F.ceil(F.col("size") / p.block).cast("int").alias("member_blocks"),
                     F.ceil((F.col("size") - F.col("n")) / p.block).cast("int").alias("query_blocks")))
    rows = store.put(rooted.join(still, "owner"), "open")
    own = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = (rows.withColumn("m", own("member_blocks")).withColumn("q", every("query_blocks"))
               .withColumn("query", F.lit(False)))
    queries = (rows.where("root != most").withColumn("q", own("query_blocks")).withColumn("m", every("member_blocks"))
               .withColumn("query", F.lit(True)))
    cols = ["owner", "m", "q", "rep", "root", "query"]
    found = (members.select(cols).unionAll(queries.select(cols)).join(bitmaps, "rep")
             .groupBy("owner", "m", "q").applyInArrow(lambda t: _pairs(t, p, False), "owner bigint, u bigint, v bigint"))
    return store.put(found.select("u", "v").distinct(), "rest")


def jaccard_join(docs: DataFrame, store: Store, p: Join = Join()) -> DataFrame:
    """``docs`` (doc_id, text) -> one row per row: doc_id, n_shingles,
    component_id (the smallest doc_id reachable over links)."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    last = frequent(texts, p)
    signed = store.put(texts.mapInArrow(lambda it: _sign(it, p, last), SIGNED), "signed")
    classes = store.put(signed.where("n_shingles > 0 and doc_id is not null").groupBy("digest")
                        .agg(F.min("doc_id").alias("rep")), "classes")
    reps = store.put(signed.select("digest", F.col("doc_id").alias("rep"), "n_shingles", "bitmap", "anchors")
                     .join(classes, ["digest", "rep"]).dropDuplicates(["digest", "rep"]).drop("digest"), "reps")
    texts, bitmaps = texts.where("doc_id is not null"), reps.select("rep", "n_shingles", "bitmap")

    trees = _trees(reps, store)
    sizes = store.put(trees.groupBy("owner").agg(F.count(F.lit(1)).alias("size")), "sizes")
    forests = _first(trees, sizes, bitmaps, store, p)
    links = store.put(_links(store.put(forests.select("u", "v").distinct(), "pairs"), texts, p), "links")
    roots = components(links, store)
    rest = _second(trees, sizes, bitmaps, forests, links, roots, store, p)
    if not rest.isEmpty():
        roots = components(links.unionAll(_links(rest, texts, p)), store)

    named = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("digest", F.coalesce("root", "rep").alias("component_id"))
    return (signed.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
