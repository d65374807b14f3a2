"""Column expressions: all built-in Spark functions, so they stay inside
whole-stage codegen."""

from idbridge.functions.text import R_WHITESPACE, paste_names, sanitize_email
from idbridge.functions.keys import KEY_COLS, add_key, key_exprs, quoted
from idbridge.functions.dates import at_least_year
from idbridge.functions.ids import member_uuid, stable_member_id

__all__ = [
    "R_WHITESPACE", "paste_names", "sanitize_email",
    "KEY_COLS", "add_key", "key_exprs", "quoted",
    "at_least_year",
    "member_uuid", "stable_member_id",
]
