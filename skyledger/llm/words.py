"""Words of a text, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    """The number of words; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def words_between(text: str, start: Column, end: Column, size: Column) -> Column:
    """The words from ``start`` to before ``end``, one space apart; all of ``size`` give the text as it is."""
    some = F.slice(F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)), (start + 1).cast("int"), (end - start).cast("int"))
    return F.when((start == 0) & (end == size), F.col(text)).otherwise(F.array_join(some, " "))
