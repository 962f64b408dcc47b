"""Classification of text by ordered rules, and display labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import OTHER_PAGE_TYPE, PAGE_TYPE_RULES, SOURCE_LABELS, UNATTRIBUTED


def classify(text: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Label of the first rule ``(label, pattern)`` that matches; NULL text stays NULL."""
    label = F.when(text.isNull(), F.lit(None).cast("string"))
    for name, pattern in rules:
        label = label.when(text.rlike(pattern), F.lit(name))
    return label.otherwise(F.lit(default))


def page_type(url: Column, rules: Sequence[tuple[str, str]] = PAGE_TYPE_RULES) -> Column:
    return classify(url, rules, OTHER_PAGE_TYPE)


def source_label(source: Column) -> Column:
    """Readable traffic source; a blank one is unattributed."""
    label = F.when(source.isNull() | (F.trim(source) == ""), F.lit(UNATTRIBUTED))
    for raw, shown in SOURCE_LABELS:
        label = label.when(source == raw, F.lit(shown))
    return label.otherwise(source)
