"""Text patterns and JSON conditions as native predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MANY, _ONE = object(), object()
_ESCAPE = "#"
_TO_END = 2**31 - 1


def _tokens(pattern: str) -> list:
    """Wildcards as markers, everything else as literal text runs."""
    out: list = []
    at = 0
    while at < len(pattern):
        char = pattern[at]
        if char == "[":
            if pattern[at + 2 : at + 3] != "]":
                raise ValueError(f"only one-character classes are known: {pattern!r}")
            char, at = pattern[at + 1], at + 2
        elif char in "%_":
            out.append(_MANY if char == "%" else _ONE)
            at += 1
            continue
        if out and isinstance(out[-1], str):
            out[-1] += char
        else:
            out.append(char)
        at += 1
    return out


def matches(column: Column, pattern: str) -> Column:
    """``LIKE`` with ``%``, ``_`` and one-character classes such as ``[_]``.

    Prefix, suffix, infix and exact patterns become the predicates that a
    Parquet scan can take; the rest stays a native ``LIKE``.
    """
    tokens = _tokens(pattern)
    shape = [token if token is _MANY or token is _ONE else str for token in tokens]
    if shape == [str]:
        return column == F.lit(tokens[0])
    if shape == [str, _MANY]:
        return column.startswith(tokens[0])
    if shape == [_MANY, str]:
        return column.endswith(tokens[1])
    if shape == [_MANY, str, _MANY]:
        return column.contains(tokens[1])
    if shape == [_MANY, _ONE, str, _MANY]:
        return F.substring(column, 2, _TO_END).contains(tokens[2])
    text = ""
    for token in tokens:
        if token is _MANY:
            text += "%"
        elif token is _ONE:
            text += "_"
        else:
            text += "".join(_ESCAPE + c if c in "%_" + _ESCAPE else c for c in token)
    return F.like(column, F.lit(text), F.lit(_ESCAPE))


_OPERATORS = {
    "$eq": lambda column, value: column == F.lit(value),
    "$ge": lambda column, value: column >= F.lit(value),
    "$like": matches,
}


def condition(where: dict) -> Column:
    """``{"$eq": {"payer": "x"}}`` and the like; several entries must all hold."""
    terms = []
    for operator, fields in where.items():
        if operator not in _OPERATORS:
            raise ValueError(f"unknown operator {operator!r}")
        terms += [_OPERATORS[operator](F.col(name), value) for name, value in fields.items()]
    if not terms:
        raise ValueError("empty condition")
    result = terms[0]
    for term in terms[1:]:
        result = result & term
    return result


# The two patterns for February.
FEBRUARY_WILDCARD = "%_02/%"
FEBRUARY_EXACT = "%[_]02/%"


def february_wildcard(key: Column) -> Column:
    """Month 02, and also day 02 of any month: ``_`` stands for any character."""
    return matches(key, FEBRUARY_WILDCARD)


def february_exact(key: Column) -> Column:
    """Month 02 only: the underscore is literal."""
    return matches(key, FEBRUARY_EXACT)
