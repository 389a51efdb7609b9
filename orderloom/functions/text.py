"""Text predicates and standardisers, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accented letters that are folded, and what each becomes.
ACCENTED = "áàãâäéèêëíìîïóòõôöúùûüç"
PLAIN = "aaaaaeeeeiiiiooooouuuuc"

# Patterns that decide validity.
DIGITS_ONLY = "^[0-9]+$"
HEX_32 = "^[a-fA-F0-9]{32}$"
TWO_CAPITALS = "^[A-Z]{2}$"


def is_blank(c: Column) -> Column:
    """True for text made of spaces only. NULL stays NULL; tabs are not spaces."""
    return F.trim(c) == ""


def is_numeric_text(c: Column) -> Column:
    return c.rlike(DIGITS_ONLY)


def is_filled(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c) != "")


def is_named(c: Column) -> Column:
    """Filled and not made of digits alone."""
    return is_filled(c) & ~is_numeric_text(c)


def is_untrimmed(c: Column) -> Column:
    return c != F.trim(c)


def upper_code(c: Column) -> Column:
    """Codes such as states, statuses and payment types: trimmed, upper case."""
    return F.upper(F.trim(c))


def lower_code(c: Column) -> Column:
    return F.trim(F.lower(c))


def spaced_lower(c: Column) -> Column:
    """``Cama_Mesa`` to ``cama mesa``: the category key on both sides of the translation join."""
    return F.lower(F.regexp_replace(F.trim(c), "_", " "))


def single_line(c: Column) -> Column:
    """Each CR and each LF becomes one space, so CRLF becomes two."""
    return F.regexp_replace(c, "[\r\n]", " ")


def fold_accents(c: Column) -> Column:
    return F.translate(c, ACCENTED, PLAIN)


def city_title(c: Column) -> Column:
    """Accents folded, runs of whitespace collapsed, words capitalised. Ends are not trimmed."""
    return F.initcap(F.regexp_replace(fold_accents(c), r"\s+", " "))
