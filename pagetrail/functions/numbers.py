"""Number conversions whose edge cases differ from Spark's defaults.

Each takes and gives SQL expression text, so that it can be used inside array lambdas as well.
"""

from __future__ import annotations

NUMERIC_PATTERN = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def safe_double(text: str) -> str:
    """Text as DOUBLE, NULL when it is not a number (no ``1d`` style suffixes)."""
    return f"CASE WHEN {text} RLIKE r'{NUMERIC_PATTERN}' THEN try_cast({text} AS double) END"


def safe_product(left: str, right: str) -> str:
    """Product of two doubles, NULL when finite inputs overflow."""
    a, b = f"cast({left} AS double)", f"cast({right} AS double)"
    finite = f"abs({a}) <> double('inf') AND abs({b}) <> double('inf')"
    return f"CASE WHEN NOT (abs({a} * {b}) = double('inf') AND {finite}) THEN {a} * {b} END"


def double_text(value: str) -> str:
    """A double as text: ``90`` for 90.0, ``12.5``, ``1e+20``, ``1e-05``.

    Plain digits are used for exponents -4..14, and up to 16 where the number needs more than
    15 digits; beyond that the exponent has a sign and at least two digits.
    """
    text = f"cast({value} AS string)"
    mantissa = f"regexp_replace(substring_index({text}, 'E', 1), r'\\.0$', '')"
    exponent = f"try_cast(substring_index({text}, 'E', -1) AS int)"
    digits = f"length(regexp_replace({mantissa}, '[^0-9]', ''))"
    spelled = f"cast(try_cast({text} AS decimal(38,20)) AS string)"
    return f"""CASE
        WHEN {value} IS NULL THEN NULL
        WHEN isnan({value}) THEN 'nan'
        WHEN {value} = double('inf') THEN 'inf'
        WHEN {value} = double('-inf') THEN '-inf'
        WHEN {value} = 0 THEN '0'
        WHEN NOT contains({text}, 'E') THEN regexp_replace({text}, r'\\.0$', '')
        WHEN {exponent} >= -4 AND ({exponent} < 15 OR ({exponent} < 17 AND {digits} > 15))
          THEN rtrim('.', rtrim('0', {spelled}))
        ELSE concat({mantissa}, if({exponent} < 0, 'e-', 'e+'),
                    lpad(cast(abs({exponent}) AS string), greatest(2, length(cast(abs({exponent}) AS string))), '0'))
      END"""
