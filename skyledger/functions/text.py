"""Text helpers that treat whitespace the way Unicode defines it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four ASCII separators that text tools also split on.
_SPACE = r"[\s\x{1c}-\x{1f}]"
_WORD = r"(?U)[^\s\x{1c}-\x{1f}]+"


def strip_space(text: Column) -> Column:
    """Remove leading and trailing white space of any kind; NULL stays NULL."""
    return F.regexp_replace(text, f"(?U)^{_SPACE}+|{_SPACE}+$", "")


def words(text: Column) -> Column:
    """Non-empty words of a text; NULL has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_WORD), F.lit(0))


def is_valid_email(email: Column) -> Column:
    """Whether a text has the form of an e-mail address; NULL is not one.

    The end of the pattern accepts one final line feed.
    """
    # Fixed value: address pattern.
    pattern = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\n?\z"
    return F.coalesce(email.rlike(pattern), F.lit(False))


def natural_id(kind: str, *parts: Column) -> Column:
    """Key derived from the natural key, so that a retried task writes the same row again."""
    return F.sha2(F.concat_ws("|", F.lit(kind), *[part.cast("string") for part in parts]), 256)
