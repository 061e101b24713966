"""Cleaning of identifiers, names and addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_id(c: Column) -> Column:
    return F.upper(F.trim(c))


def clean_email(c: Column) -> Column:
    return F.lower(F.trim(c))


def clean_name(c: Column) -> Column:
    """Title case where any character that is neither letter nor digit starts a new word.

    Spark's own ``initcap`` breaks words at blanks only (``O'brien`` instead of ``O'Brien``), so the
    text is cut into runs of word and non-word characters and each run is capitalised. Blank -> NULL.
    """
    runs = F.regexp_extract_all(F.lower(F.trim(c)), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    titled = F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substr(x, F.lit(2))))
    return F.nullif(F.array_join(titled, ""), F.lit(""))
