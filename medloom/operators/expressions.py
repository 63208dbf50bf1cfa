"""Logical expressions over criteria: evaluated as columns, written as SQL.

A tree is nested tuples: ``("AND", a, b, ...)``, ``("OR", a, b, ...)``,
``("NOT", a)`` or ``(field, comparison, value)``.  A criterion whose value is
missing is false, and so is its comparison with null; NOT turns that into true.

Defined results: an empty AND is true, an empty OR false; texts in values are
quoted; unknown operators raise ``ValueError``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPARISONS = {"=": Column.__eq__, "<>": Column.__ne__, "<": Column.__lt__, "<=": Column.__le__, ">": Column.__gt__, ">=": Column.__ge__}


def to_column(tree: tuple) -> Column:
    """The tree as one boolean column that is never null."""
    head, *rest = tree
    if head == "AND":
        return reduce(Column.__and__, map(to_column, rest), F.lit(True))
    if head == "OR":
        return reduce(Column.__or__, map(to_column, rest), F.lit(False))
    if head == "NOT":
        return ~to_column(rest[0])
    op, value = rest
    if op == "like":
        return F.coalesce(F.col(head).like(value), F.lit(False))
    if op not in COMPARISONS:
        raise ValueError(f"unknown comparison {op}")
    return F.coalesce(COMPARISONS[op](F.col(head), F.lit(value)), F.lit(False))


def to_sql(tree: tuple) -> str:
    """The same condition as a SQL text."""
    head, *rest = tree
    if head in ("AND", "OR"):
        return "(" + f" {head} ".join(map(to_sql, rest)) + ")" if rest else str(head == "AND").lower()
    if head == "NOT":
        return f"(NOT {to_sql(rest[0])})"
    op, value = rest
    if op != "like" and op not in COMPARISONS:
        raise ValueError(f"unknown comparison {op}")
    text = "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)
    return f"coalesce({head} {op} {text}, false)"
