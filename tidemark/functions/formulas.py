"""Formulas of derived metrics: names, numbers, ``+ - * /`` and brackets."""

from __future__ import annotations

import re
from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import ConfigError

_TOKEN = re.compile(r"\s*(?:(?P<number>\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>[-+*/()]))")


def formula_column(text: str, names: Collection[str]) -> Column:
    """The formula as a column over double columns; a division by zero is null.

    Raises ConfigError for unknown names and for anything else that is no formula.
    """
    tokens, at = [], 0
    while text[at:].strip():
        found = _TOKEN.match(text, at)
        if not found:
            raise ConfigError(f"formula {text!r} has an unexpected {text[at:].strip()[0]!r}")
        tokens.append((found.lastgroup, found[found.lastgroup]))
        at = found.end()
    tokens.append(("end", ""))
    spot = 0

    def take(*signs: str) -> str | None:
        nonlocal spot
        kind, value = tokens[spot]
        if kind == "sign" and value in signs:
            spot += 1
            return value
        return None

    def operand() -> Column:
        nonlocal spot
        if take("-"):
            return -operand()
        if take("+"):
            return operand()
        if take("("):
            inner = total()
            if not take(")"):
                raise ConfigError(f"formula {text!r} lacks a closing bracket")
            return inner
        kind, value = tokens[spot]
        spot += 1
        if kind == "number":
            return F.lit(float(value))
        if kind == "name" and value in names:
            return F.col(value)
        raise ConfigError(f"formula {text!r} has {value!r} where a known name or a number must stand")

    def product() -> Column:
        left = operand()
        while sign := take("*", "/"):
            right = operand()
            left = left * right if sign == "*" else F.try_divide(left, right)
        return left

    def total() -> Column:
        left = product()
        while sign := take("+", "-"):
            right = product()
            left = left + right if sign == "+" else left - right
        return left

    column = total()
    if tokens[spot][0] != "end":
        raise ConfigError(f"formula {text!r} goes on after its end")
    return column
