"""Oracle SQL (DuckDB dialect) for every registered query.

Written independently of the Spark plans and as plainly as possible: the
staging tables are materialised with their full fan-out and the UPDATE
winner is ``min()`` over every passing staged row. The Spark side computes
the same result without the fan-out, so agreement checks that rewrite.

The fixture views of ``FIXTURES.md`` are inlined as CTEs over the TPC-H
tables the oracle connection has registered.
"""

from __future__ import annotations

VIEW_SQL = {
    "members": """
WITH b AS (
  SELECT c_custkey AS k,
         'user' || cast(CASE WHEN c_custkey % 50 = 2 THEN c_custkey - 1 ELSE c_custkey END AS string) || '@mail.test' AS e
  FROM customer WHERE c_custkey % 10 <> 0)
SELECT 'M' || lpad(cast(k AS string), 9, '0') AS id,
       CASE WHEN k % 700 = 7 THEN NULL
            WHEN k % 4 = 0 THEN upper(e) || ' '
            WHEN k % 4 = 1 THEN chr(9) || e
            WHEN k % 4 = 2 THEN e
            ELSE '  ' || e || chr(13) || chr(10) END AS email
FROM b""",
    "users": """
WITH f AS (SELECT o_custkey, min(o_orderdate) AS created_at FROM orders GROUP BY o_custkey),
b AS (
  SELECT c_custkey AS k, f.created_at,
         'user' || cast(CASE WHEN c_custkey % 60 = 33 THEN c_custkey - 3 ELSE c_custkey END AS string) || '@mail.test' AS e
  FROM customer LEFT JOIN f ON f.o_custkey = c_custkey WHERE c_custkey % 41 <> 0)
SELECT k AS id,
       CASE WHEN k % 233 = 5 THEN NULL
            WHEN (k + 1) % 4 = 0 THEN upper(e) || ' '
            WHEN (k + 1) % 4 = 1 THEN chr(9) || e
            WHEN (k + 1) % 4 = 2 THEN e
            ELSE '  ' || e || chr(13) || chr(10) END AS email,
       CASE WHEN k % 29 = 3 THEN NULL ELSE 'First' || cast(k AS string) END AS fname,
       CASE WHEN k % 60 = 0 THEN NULL ELSE 'Last' || cast(k AS string) END AS lname,
       created_at,
       CASE k % 3 WHEN 0 THEN NULL
                  WHEN 1 THEN 'M' || lpad(cast(k AS string), 9, '0')
                  ELSE 'M' || lpad(cast(k + 1 AS string), 9, '0') END AS hn_member_id
FROM b""",
    "transactions": """
WITH b AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS d,
         'user' || cast(o_custkey AS string) || '@mail.test' AS e
  FROM orders)
SELECT k AS id,
       CASE WHEN k % 31 = 0 THEN NULL
            WHEN k % 4 = 0 THEN upper(e) || ' '
            WHEN k % 4 = 1 THEN chr(9) || e
            WHEN k % 4 = 2 THEN e
            ELSE '  ' || e || chr(13) || chr(10) END AS customer_email,
       CASE k % 5 WHEN 0 THEN NULL
                  WHEN 2 THEN 'M' || lpad(cast(c + 1 AS string), 9, '0')
                  ELSE 'M' || lpad(cast(c AS string), 9, '0') END AS member_id,
       d AS date
FROM b""",
    "reservations": """
WITH b AS (
  SELECT o_orderkey AS k, o_custkey AS c,
         'user' || cast(o_custkey AS string) || '@mail.test' AS e
  FROM orders WHERE o_orderkey % 3 = 0)
SELECT k AS id,
       CASE WHEN k % 31 = 0 THEN NULL
            WHEN k % 4 = 0 THEN upper(e) || ' '
            WHEN k % 4 = 1 THEN chr(9) || e
            WHEN k % 4 = 2 THEN e
            ELSE '  ' || e || chr(13) || chr(10) END AS customer_email,
       CASE (k + 1) % 5 WHEN 0 THEN NULL
                        WHEN 2 THEN 'M' || lpad(cast(c + 1 AS string), 9, '0')
                        ELSE 'M' || lpad(cast(c AS string), 9, '0') END AS member_id
FROM b""",
    "invoices": """
SELECT o_orderkey + 1000000 AS id,
       CASE WHEN o_orderkey % 37 = 0 THEN NULL
            WHEN o_orderkey % 11 = 0 THEN -o_orderkey
            ELSE o_orderkey - o_orderkey % 3 END AS reservation_id,
       'M' || lpad(cast(o_custkey + 2 AS string), 9, '0') AS customer_id
FROM orders""",
    "tickets": """
SELECT o_orderkey AS id, o_custkey AS user_id,
       CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS boe_event_id,
       CASE WHEN o_orderkey % 4 = 1 THEN o_orderkey END AS boe_ticket_id
FROM orders""",
}


def clean(x: str) -> str:
    """lower + trim of space, tab, LF, CR."""
    return f"trim(lower({x}), ' ' || chr(9) || chr(10) || chr(13))"


# Derived relations shared by several queries, in dependency order.
DERIVED_SQL = {
    "cm": f"SELECT id AS member_id, {clean('email')} AS email FROM members",
    "cu": f"SELECT id, {clean('email')} AS email FROM users",
    "mapped": "SELECT u.id, u.email, m.member_id FROM cu u LEFT JOIN cm m ON u.email IS NOT DISTINCT FROM m.email",
    "stg_trans": f"""SELECT t.id AS transaction_id, coalesce(m.member_id, t.member_id) AS member_id,
        {clean('t.customer_email')} AS customer_email
        FROM transactions t LEFT JOIN cm m ON {clean('t.customer_email')} IS NOT DISTINCT FROM m.email""",
    "stg_resv": f"""SELECT r.id AS reservation_id, coalesce(m.member_id, r.member_id) AS member_id,
        {clean('r.customer_email')} AS customer_email
        FROM reservations r LEFT JOIN cm m ON {clean('r.customer_email')} IS NOT DISTINCT FROM m.email""",
    "stg_inv": """SELECT i.id AS invoice_id, i.reservation_id, coalesce(r.member_id, i.customer_id) AS member_id
        FROM invoices i LEFT JOIN reservations r ON i.reservation_id IS NOT DISTINCT FROM r.id""",
    "stg_inv_cascade": """SELECT i.id AS invoice_id, i.reservation_id, coalesce(r.member_id, i.customer_id) AS member_id
        FROM invoices i LEFT JOIN stg_resv r ON i.reservation_id IS NOT DISTINCT FROM r.reservation_id""",
    # emails of unassigned transactions, less the emails all of whose member rows have an id
    "t_orphans": """SELECT customer_email FROM transactions
        WHERE member_id IS NULL AND customer_email IS NOT NULL AND date >= TIMESTAMP '1998-01-01'
        EXCEPT
        SELECT email FROM members GROUP BY email HAVING count(*) = count(id)""",
    "t_orphans_clean": f"SELECT {clean('customer_email')} AS customer_email FROM t_orphans",
    # users without a member who hold a qualifying ticket, and qualifying tickets of unknown users
    "k_orphans": """SELECT id AS user_id, email, fname, lname, created_at FROM users
        WHERE hn_member_id IS NULL AND id IN (
          SELECT user_id FROM tickets WHERE boe_event_id IS NOT NULL OR boe_ticket_id IS NOT NULL)
        UNION
        SELECT user_id, NULL, NULL, NULL, NULL FROM tickets k
        WHERE (boe_event_id IS NOT NULL OR boe_ticket_id IS NOT NULL)
          AND NOT EXISTS (SELECT 1 FROM users WHERE users.id = k.user_id)""",
    "k_orphans_clean": f"SELECT user_id, {clean('email')} AS email, fname, lname, created_at FROM k_orphans",
    "k_unmatched": """SELECT o.* FROM k_orphans_clean o
        WHERE NOT EXISTS (SELECT 1 FROM cm m WHERE m.email IS NOT DISTINCT FROM o.email)""",
}


def with_views(body: str) -> str:
    ctes = [f"{name} AS ({sql})" for name, sql in {**VIEW_SQL, **DERIVED_SQL}.items()]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _dups(rel: str, key: str, cols: str) -> str:
    return f"SELECT {cols} FROM (SELECT *, count(*) OVER (PARTITION BY {key}) AS n_ FROM {rel}) WHERE n_ > 1"


def _winners(target: str, stg: str, stg_key: str, cur: str, guard: str, extra: str = "") -> str:
    """min staged value per target id over staged rows passing the guard."""
    return (f"SELECT x.id, min(s.member_id) AS winner FROM {target} x JOIN {stg} s ON x.id = s.{stg_key} "
            f"WHERE {guard.format(cur=f'x.{cur}', new='s.member_id')} {extra} GROUP BY x.id")


SQL_GUARD = "s.member_id IS NOT NULL AND {cur} != {new}"
NULL_SAFE_GUARD = "{cur} IS DISTINCT FROM {new}"


def _updated(target: str, cols: list[str], set_col: str, winners: str) -> str:
    sel = ", ".join(f"coalesce(w.winner, x.{c}) AS {c}" if c == set_col else f"x.{c}" for c in cols)
    return f"SELECT {sel} FROM {target} x LEFT JOIN ({winners}) w ON w.id = x.id"


def _changed(target: str, set_col: str, winners: str) -> str:
    return (f"SELECT x.id, x.{set_col} AS old_{set_col}, w.winner AS new_{set_col} "
            f"FROM {target} x JOIN ({winners}) w ON w.id = x.id")


USER_COLS = ["id", "email", "fname", "lname", "created_at", "hn_member_id"]
_STABLE = ("AND NOT EXISTS (SELECT 1 FROM mapped t2 WHERE t2.id = x.id AND t2.member_id = x.hn_member_id)")

_W_USERS = _winners("users", "mapped", "id", "hn_member_id", SQL_GUARD)
_W_USERS_NS = _winners("users", "mapped", "id", "hn_member_id", "s.member_id IS NOT NULL AND " + NULL_SAFE_GUARD)
_W_USERS_STABLE = _winners("users", "mapped", "id", "hn_member_id", SQL_GUARD, _STABLE)
_W_TRANS = _winners("transactions", "stg_trans", "transaction_id", "member_id", NULL_SAFE_GUARD)
_W_RESV = _winners("reservations", "stg_resv", "reservation_id", "member_id", NULL_SAFE_GUARD)
_W_INV = _winners("invoices", "stg_inv", "invoice_id", "customer_id", NULL_SAFE_GUARD)
_W_INV_C = _winners("invoices", "stg_inv_cascade", "invoice_id", "customer_id", NULL_SAFE_GUARD)

_SUMMARY = """SELECT count(*) AS total_users, count(*) FILTER (hn_member_id IS NOT NULL) AS matched_users,
    count(*) FILTER (hn_member_id IS NULL) AS missing_ids FROM {rel}"""

BODIES = {
    "mapped_users": "SELECT id, email, member_id FROM mapped",
    "dup_members": _dups("cm", "email", "member_id, email"),
    "dup_users": _dups("cu", "email", "id, email"),
    "dup_mapped": _dups("mapped", "email", "id, email, member_id"),
    "update_users": _updated("users", USER_COLS, "hn_member_id", _W_USERS),
    "update_users_null_safe": _updated("users", USER_COLS, "hn_member_id", _W_USERS_NS),
    "update_users_stable": _updated("users", USER_COLS, "hn_member_id", _W_USERS_STABLE),
    "changed_users": _changed("users", "hn_member_id", _W_USERS),
    "changed_users_null_safe": _changed("users", "hn_member_id", _W_USERS_NS),
    "mapping_summary": _SUMMARY.format(rel="users"),
    "mapping_summary_after_update": _SUMMARY.format(
        rel="(" + _updated("users", USER_COLS, "hn_member_id", _W_USERS) + ")"),
    "user_count": "SELECT count(*) AS count FROM users",
    "member_email_counts": "SELECT email, count(*) AS n FROM cm GROUP BY email HAVING count(*) > 1",
    "remap_transactions": "SELECT transaction_id, member_id, customer_email FROM stg_trans",
    "remap_reservations": "SELECT reservation_id, member_id, customer_email FROM stg_resv",
    "remap_invoices": "SELECT invoice_id, reservation_id, member_id FROM stg_inv",
    "remap_invoices_cascade": "SELECT invoice_id, reservation_id, member_id FROM stg_inv_cascade",
    "update_transactions": _updated("transactions", ["id", "customer_email", "member_id", "date"],
                                    "member_id", _W_TRANS),
    "update_reservations": _updated("reservations", ["id", "customer_email", "member_id"], "member_id", _W_RESV),
    "update_invoices": _updated("invoices", ["id", "reservation_id", "customer_id"], "customer_id", _W_INV),
    "update_invoices_cascade": _updated("invoices", ["id", "reservation_id", "customer_id"], "customer_id",
                                        _W_INV_C),
    "changed_transactions": _changed("transactions", "member_id", _W_TRANS),
    "changed_reservations": _changed("reservations", "member_id", _W_RESV),
    "changed_invoices": _changed("invoices", "customer_id", _W_INV),
    "changed_invoices_cascade": _changed("invoices", "customer_id", _W_INV_C),
    "transaction_orphans": "SELECT customer_email FROM t_orphans",
    "dup_transaction_orphans": _dups("t_orphans_clean", "customer_email", "customer_email"),
    "unmatched_transaction_emails": """SELECT o.customer_email FROM t_orphans_clean o
        WHERE NOT EXISTS (SELECT 1 FROM cm m WHERE m.email IS NOT DISTINCT FROM o.customer_email)""",
    "matched_transaction_orphans": """SELECT m.member_id, m.email FROM cm m
        JOIN t_orphans_clean o ON m.email IS NOT DISTINCT FROM o.customer_email""",
    "ticket_orphans": "SELECT user_id, email, fname, lname, created_at FROM k_orphans",
    "dup_ticket_orphans": _dups("k_orphans_clean", "email", "user_id, email, fname, lname, created_at"),
    "unmatched_ticket_users": "SELECT user_id, email, fname, lname, created_at FROM k_unmatched",
    "matched_ticket_orphans": """SELECT m.member_id, m.email, o.user_id, o.fname, o.lname, o.created_at
        FROM cm m JOIN k_orphans_clean o ON m.email IS NOT DISTINCT FROM o.email""",
    # ids and times differ between runs; what must hold of them does not
    "new_member_ids": """SELECT count(*) AS n_rows, count(*) AS n_ids, count(*) AS n_id_shape, count(*) AS n_same_time,
        count(user_id) AS n_external_ids FROM k_unmatched""",
    "new_members": """SELECT email, coalesce(fname, 'NA') || ' ' || coalesce(lname, 'NA') AS name,
        CAST(NULL AS VARCHAR) AS phone_number, CAST(NULL AS VARCHAR) AS address,
        CAST(0 AS INTEGER) AS email_verified, CAST(0 AS INTEGER) AS phone_verified,
        user_id AS external_id, created_at AS member_since FROM k_unmatched""",
}

BODIES["staged_changes"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, id, old_{c} AS old_id, new_{c} AS new_id FROM ({BODIES[f'changed_{t}']})"
    for t, c in (("transactions", "member_id"), ("reservations", "member_id"), ("invoices", "customer_id")))


def _ranked(name: str, *order: str) -> str:
    by = ", ".join(f"{c} ASC NULLS LAST" for c in order)
    return f"SELECT *, row_number() OVER (ORDER BY {by}) AS rank FROM ({BODIES[name]})"


BODIES |= {f"ranked_{name}": _ranked(name, *order) for name, order in {
    "dup_members": ("email", "member_id"), "dup_users": ("email", "id"), "dup_mapped": ("email", "id", "member_id"),
    "member_email_counts": ("email", "n"), "dup_transaction_orphans": ("customer_email",),
    "dup_ticket_orphans": ("email", "user_id", "fname", "lname", "created_at")}.items()}

# the same results by other operators
SAME = {
    "mapped_users_two_sources": "mapped_users", "ledger_member_email_counts": "member_email_counts",
    "ledger_dup_members": "dup_members", "ledger_mapping_summary": "mapping_summary_after_update",
    **{f"indexed_{n}": n for n in ("mapped_users", "update_users", "remap_transactions", "update_transactions",
                                   "unmatched_transaction_emails", "matched_transaction_orphans",
                                   "unmatched_ticket_users", "matched_ticket_orphans")},
    **{f"prefiltered_{n}": n for n in ("unmatched_transaction_emails", "matched_transaction_orphans",
                                       "unmatched_ticket_users", "matched_ticket_orphans")},
    **{f"factorised_{n}": n for n in ("mapped_users", "matched_ticket_orphans", "remap_transactions",
                                      "remap_reservations")},
    **{f"rewritten_{n}": f"update_{n}" for n in ("users", "transactions", "reservations", "invoices")},
}
BODIES |= {name: BODIES[of] for name, of in SAME.items()}

ORACLE_SQL = {name: with_views(body) for name, body in BODIES.items()}
