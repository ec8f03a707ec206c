"""File and attachment names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def base_name(c: Column) -> Column:
    """Last component of a path or URL; trailing slashes do not count."""
    return F.regexp_extract(c, r"([^/]*)/*\z", 1)


def file_stem(c: Column) -> Column:
    """Base name without its last suffix; a leading dot starts no suffix."""
    return F.regexp_replace(base_name(c), r"(?<=[^/])\.[^./]+\z", "")


def _any_of(c: Column, words: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | c.contains(word)
    return hit


def has_relevant_extension(c: Column) -> Column:
    return F.lower(c).rlike(rf"\.(?:{'|'.join(P.RELEVANT_EXTENSIONS)})\z")


def is_blocked_name(c: Column) -> Column:
    low = F.lower(c)
    return _any_of(low, P.BLOCKED_NAME_WORDS) & ~_any_of(low, P.OVERRIDE_NAME_WORDS)


def is_relevant_attachment(c: Column) -> Column:
    """A document type we read, and no contract, price sheet or declaration by name."""
    return has_relevant_extension(c) & ~is_blocked_name(c)
