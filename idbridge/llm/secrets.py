"""Secrets in texts, told apart by who else has them.

Patterns find candidates; the corpus decides what they are. The hash of every
candidate value is counted by distinct repositories and distinct owners: a
value that many owners have was copied from documentation or an example; a
strong one that stays with one or two owners looks live, in however many of
their repositories (these are counted for the report only). Unlike patterns that
carry their own mark (assignments, access keys, long hex), a bare token counts
only if it is strong and owner-specific.

DataFrame functions only. Values leave the scan as hashes. A hot value is
counted after partial aggregation, and its rows meet its counts in a join that
adaptive execution splits.

Defined results: a null text is empty; rows are kept apart by a row number of
the staged scan, so null or repeated ids do not matter; a null owner or
repository is one more owner or repository; equal values in one text are one
value at several spans; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Store

# The base patterns, in the order in which kinds are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
KINDS = {  # kind: (pattern, group that holds the value, least length of the value)
    "assign": (ASSIGN, 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
TOKEN = r"[A-Za-z0-9+/_-]{20,}"  # bare tokens; strong ones mix digits, lower and upper case
STRONG = ("[0-9]", "[a-z]", "[A-Z]")
SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


@dataclass(frozen=True)
class Ownership:
    example_owners: int = 3  # a value of so many owners is a widely copied example


def _with_spans(rows: DataFrame, name: str, kind: str, pattern: str, group: int, least: int) -> DataFrame:
    """Adds column ``name``: leftmost matches that do not overlap, as (kind,
    start, end, value), positions in code points. The pieces between matches
    give the places."""
    text, none = F.col("text"), F.array().cast("array<string>")
    hit = text.rlike(pattern)
    out = rows.withColumns({
        "ms": F.when(hit, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none),
        "vs": F.when(hit, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(none),
        "gaps": F.when(hit, F.split(text, pattern, -1)).otherwise(none)})
    spans = f"""
        if(size(ms) = 0, cast(array() as {SPANS}),
        aggregate(sequence(0, size(ms) - 1),
            cast(named_struct('at', 0, 'out', array()) as struct<at:int,out:{SPANS}>),
            (s, i) -> named_struct(
                'at', s.at + char_length(gaps[i]) + char_length(ms[i]),
                'out', if(char_length(vs[i]) >= {least},
                   array_append(s.out, named_struct('kind', '{kind}', 'start', s.at + char_length(gaps[i]),
                       'end', s.at + char_length(gaps[i]) + char_length(ms[i]), 'value', vs[i])),
                   s.out)),
            s -> s.out))"""
    return out.withColumn(name, F.expr(spans)).drop("ms", "vs", "gaps")


def candidates(docs: DataFrame, store: Store) -> DataFrame:
    """``docs`` (doc_id, text, repository, owner) -> row, doc_id, repository,
    owner, base and bare spans with value hashes, one row per row."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.col("repository").cast("string").alias("repository"), F.col("owner").cast("string").alias("owner"))
    for kind, (pattern, group, least) in KINDS.items():
        rows = _with_spans(rows, kind, kind, pattern, group, least)
    rows = _with_spans(rows, "bare", "owned", TOKEN, 0, 20)
    strong = " and ".join(f"s.value rlike '{c}'" for c in STRONG)
    rows = (rows.withColumn("base", F.expr(f"array_sort(concat({', '.join(KINDS)}), {BY_PLACE})"))
            .withColumn("bare", F.expr(f"filter(bare, s -> {strong} and not exists(base, b -> b.start < s.end and s.start < b.end))")))
    hashed = "transform({0}, s -> named_struct('kind', s.kind, 'start', s.start, 'end', s.end, 'value', sha2(s.value, 256)))"
    return store.put(rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "repository", "owner",
        F.expr(hashed.format("base")).alias("base"), F.expr(hashed.format("bare")).alias("bare")), "candidates")


BY_PLACE = """(a, b) -> cast(case when a.start != b.start then a.start - b.start
    else array_position(array('assign', 'access', 'hex', 'owned'), a.kind)
       - array_position(array('assign', 'access', 'hex', 'owned'), b.kind) end as int)"""


def ownership(rows: DataFrame) -> DataFrame:
    """value -> n_repositories, n_owners, over all candidates."""
    every = rows.select("repository", "owner", F.explode(F.concat("base", "bare")).alias("s")).select(
        F.col("s.value").alias("value"), "repository", "owner")
    # null is one more repository or owner; pairs are made distinct first, so a hot value is spread over its pairs
    counts = [every.select("value", c).distinct().groupBy("value").agg(F.count(F.lit(1)).alias(f"n_{name}"))
              for c, name in (("repository", "repositories"), ("owner", "owners"))]
    return counts[0].join(counts[1], "value")


def secrets(docs: DataFrame, store: Store, p: Ownership = Ownership()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, repository, owner): doc_id,
    spans (those of the patterns and the bare tokens that look live), each
    (kind, start, end, value hash, verdict), by place. Verdicts: ``example``
    (widely copied), ``live`` (owner-specific)."""
    rows = candidates(docs, store)
    known = store.put(ownership(rows), "ownership")
    one = rows.select("row", F.explode(F.concat("base", "bare")).alias("s"))
    copied = F.col("n_owners") >= p.example_owners
    judged = (one.select("row", "s.*").join(known, "value")
              .withColumn("verdict", F.when(copied, "example").otherwise("live"))
              .where("kind != 'owned' or verdict = 'live'")
              .groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end", "value", "verdict")).alias("spans")))
    judged = judged.withColumn("spans", F.expr(f"array_sort(spans, {BY_PLACE})"))
    none = F.expr("cast(array() as array<struct<kind:string,start:int,end:int,value:string,verdict:string>>)")
    return (rows.join(judged, "row", "left")
            .select("doc_id", F.coalesce("spans", none).alias("spans")))
