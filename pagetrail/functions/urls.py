"""Page addresses and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import HOST_PATTERN, PATH_PATTERN, QUERY_OR_FRAGMENT_PATTERN


def _captured(text: Column, pattern: str) -> Column:
    # regexp_extract gives '' both for no match and for an empty match; only the second is kept
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1))


def canonical_url(url: Column) -> Column:
    """Lower-case URL without query string and fragment."""
    return F.lower(F.regexp_replace(url, QUERY_OR_FRAGMENT_PATTERN, ""))


def url_host(url: Column) -> Column:
    return _captured(url, HOST_PATTERN)


def url_path(url: Column) -> Column:
    """Everything after the host, query string included."""
    return _captured(url, PATH_PATTERN)


def surrogate_key(text: Column) -> Column:
    """Hex SHA-256 of the text."""
    return F.sha2(text.cast("string"), 256)
