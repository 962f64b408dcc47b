"""Reading event parameters and items inside the row, without exploding it.

Each function gives SQL expression text.
"""

from __future__ import annotations

from collections.abc import Iterable

from .numbers import double_text, safe_double, safe_product


def quoted(text: str) -> str:
    """The text as an SQL literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def wanted_params(params: str, keys: Iterable[str]) -> str:
    """The event's parameters of these keys: each of them is then looked for in a short array."""
    return f"filter({params}, p -> p.key IN ({', '.join(map(quoted, keys))}))"


def value_text(value: str) -> str:
    """The first filled field of a parameter value, as text: string, int, float, double."""
    return f"""coalesce({value}.string_value, cast({value}.int_value AS string),
        {double_text(f'{value}.float_value')}, {double_text(f'{value}.double_value')})"""


def _largest(params: str, key: str, reading: str) -> str:
    return f"array_max(transform(filter({params}, p -> p.key = {quoted(key)}), p -> {reading}))"


def param_text(params: str, key: str) -> str:
    """Largest text among the event's parameters of that key, NULL when it has none."""
    return _largest(params, key, value_text("p.value"))


def param_int(params: str, key: str) -> str:
    """Largest ``int_value`` among the event's parameters of that key. A scan reads keys and these values only."""
    return f"array_max(zip_with({params}.key, {params}.value.int_value, (k, v) -> CASE WHEN k = {quoted(key)} THEN v END))"


def param_number(params: str, key: str) -> str:
    """Largest numeric reading among the event's parameters of that key."""
    return _largest(params, key, safe_double(value_text("p.value")))


def item_count(items: str) -> str:
    """Number of items on the event; 0 for a NULL array. Only one field is read, which others read, too."""
    return f"cast(greatest(size({items}.price), 0) AS bigint)"


def item_total(items: str) -> str:
    """Sum of price x quantity over the event's items, NULL when no item has a value.

    The two fields are read as arrays of their own, so that a scan leaves out the others.
    """
    products = f"zip_with({items}.price, {items}.quantity, (p, q) -> {safe_product('p', 'q')})"
    values = f"filter({products}, v -> v IS NOT NULL)"
    return f"CASE WHEN size({values}) > 0 THEN aggregate({values}, 0D, (total, v) -> total + v) END"
