"""Relational operators of the reconciliation jobs."""

from idbridge.operators.apply import (UpdatePlan, dedupe_inserts, member_inserts, preview_append,
                                      smallest_two, stage, update_from_lookup)
from idbridge.operators.bloom import likely_matches
from idbridge.operators.buckets import (Layout, publish_layouts, read_layouts, rewrite_changed, store_in_buckets)
from idbridge.operators.checks import (duplicate_joined_rows, duplicate_rows, key_counts, mapping_summary, ranked_report,
                                       row_count, sorted_report)
from idbridge.operators.database import Database, StagedInsert, StagedUpdate
from idbridge.operators.factorised import Factorised, factorise
from idbridge.operators.index import MemberIndex
from idbridge.operators.ledger import Ledger
from idbridge.operators.match import match, match_anti, match_inner, match_left, match_semi
from idbridge.operators.ordinals import with_ordinals
from idbridge.operators.remap import remap_id
from idbridge.operators.sketch import heavy_keys, hot_from_sketches, key_sketch, merged
from idbridge.operators.skew import SkewPolicy, hot_keys, skew_join

__all__ = [
    "UpdatePlan", "dedupe_inserts", "member_inserts", "preview_append", "smallest_two", "stage",
    "update_from_lookup", "duplicate_joined_rows", "duplicate_rows", "key_counts", "mapping_summary", "row_count",
    "sorted_report", "match", "match_anti", "match_inner", "match_left", "match_semi", "remap_id",
    "SkewPolicy", "hot_keys", "skew_join", "ranked_report", "with_ordinals", "MemberIndex", "Ledger",
    "Factorised", "factorise", "likely_matches", "heavy_keys", "hot_from_sketches", "key_sketch", "merged",
    "Layout", "publish_layouts", "read_layouts", "rewrite_changed", "store_in_buckets",
    "Database", "StagedInsert", "StagedUpdate",
]
