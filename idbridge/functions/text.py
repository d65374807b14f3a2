"""Text cleaning of match keys and display names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the characters R's trimws() strips by default (space, tab,
# carriage return, line feed). Spark's plain trim() strips spaces only.
R_WHITESPACE = " \t\r\n"


def lower_by_letter(col: Column) -> Column:
    """``tolower``: every code point by itself. Spark's ``lower`` does the same but
    for two letters that depend on their place or become two code points: the
    capital sigma (always the medial form here) and the dotted capital I."""
    return F.lower(F.translate(col, "\u03a3\u0130", "\u03c3i"))


def sanitize_email(col: Column | str) -> Column:
    """Lower-case, then strip R whitespace at both ends (tolower + trimws).

    The input is cast to string first, which covers the ``as.character``
    step applied to driver-specific text types.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.btrim(lower_by_letter(c.cast("string")), F.lit(R_WHITESPACE))


def paste_names(first: Column | str, last: Column | str, na_text: str | None = "NA") -> Column:
    """``paste(first, last)``: join with one space.

    R writes a missing part as the text ``NA``; that is the default. With
    ``na_text=None`` missing parts are skipped, and two missing parts give NULL.
    """
    f = F.col(first) if isinstance(first, str) else first
    s = F.col(last) if isinstance(last, str) else last
    if na_text is not None:
        return F.concat_ws(" ", F.coalesce(f, F.lit(na_text)), F.coalesce(s, F.lit(na_text)))
    return F.nullif(F.concat_ws(" ", f, s), F.lit(""))
