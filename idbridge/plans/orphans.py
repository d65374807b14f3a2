"""Source relations defined by a query: records whose person has no member.

Both are written so the expensive part shrinks first: filters reach the
scan, and the DISTINCT (a partial aggregate) runs before the join, which
then sees each key once and cannot be skewed by a frequent key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from idbridge.functions.dates import at_least_year
from idbridge.operators.match import match_anti


def transaction_orphans(transactions: DataFrame, members: DataFrame, min_year: int,
                        collation: str | None = None) -> DataFrame:
    """Distinct raw customer emails of transactions that have no member id,
    have an email, fall in ``min_year`` or later, and whose email no member
    holds.

    Raw emails, compared as SQL does (NULL matches nothing). The source query
    keeps a transaction row for which some joined member row has no id, so an
    email counts as held only if every member row with it has an id: the anti
    join is against those emails. (With a primary key on the member id this is
    the same as "some member has it".)

    Emails compare byte for byte. A source database compares with its column
    collation; ``collation="UTF8_LCASE"`` gives the case-insensitive one for
    the join (DISTINCT stays exact).
    """
    t = (transactions
         .where(F.col("member_id").isNull() & F.col("customer_email").isNotNull()
                & at_least_year(transactions, "date", min_year))
         .select("customer_email").distinct())
    # plain counts, which a database behind the JDBC catalog takes over
    m = (members.groupBy("email").agg(F.count(F.lit(1)).alias("_rows"), F.count("id").alias("_ids"))
         .where(F.col("_rows") == F.col("_ids")).select("email"))
    if collation:
        # the left side holds distinct emails, so this join cannot be skewed
        on = F.collate(t.customer_email, collation) == F.collate(m.email, collation)
        return t.join(m, on, "left_anti")
    return match_anti(t, m, "customer_email", "email", null_safe=False, split_hot=False)


def ticket_orphans(tickets: DataFrame, users: DataFrame) -> DataFrame:
    """Distinct ``user_id, email, fname, lname, created_at`` of ticket buyers
    whose ticket has an event or ticket reference and whose user row has no
    member id; a ticket whose user row is missing counts, with NULL user
    columns (a left join from tickets to users on the user id).

    The output depends on a ticket only through ``user_id``, so distinct
    user ids are taken first; a user with millions of tickets is one row by
    the time it reaches the join. A ticket without a user row survives with
    NULL user columns, as the SQL left join does.
    """
    ids = (tickets.where(F.col("boe_event_id").isNotNull() | F.col("boe_ticket_id").isNotNull())
           .select("user_id").distinct())
    u = users.select(F.col("id").alias("_uid"), "email", "fname", "lname", "created_at", "hn_member_id")
    joined = ids.join(u, ids.user_id == u._uid, "left")
    return (joined.where(F.col("hn_member_id").isNull())
            .select("user_id", "email", "fname", "lname", "created_at").distinct())
