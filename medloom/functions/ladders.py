"""Ordered rule ladders: the first rule that holds names the reason."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A rule: its name and a condition, as a Spark expression and in SQL.
Rule = tuple[str, str, str]


def rule(name: str, spark: str, sql: str | None = None) -> Rule:
    """A rule whose condition reads alike in both dialects needs one text; ``rlike`` is translated."""
    return name, spark, sql if sql is not None else spark


def first_reason(rules: list[Rule], otherwise: str = "keep") -> Column:
    """Name of the first rule that holds; a condition that is null doesn't hold."""
    out = None
    for name, cond, _ in rules:
        out = F.when(F.expr(cond), name) if out is None else out.when(F.expr(cond), name)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)


def first_reason_sql(rules: list[Rule], otherwise: str = "keep") -> str:
    return "CASE " + " ".join(f"WHEN {cond} THEN '{name}'" for name, _, cond in rules) + f" ELSE '{otherwise}' END"


def matches(column: str, pattern: str, name: str) -> Rule:
    """A rule that holds where ``column`` has a match of a pattern that both dialects read alike."""
    quoted = pattern.replace("'", "''")
    return name, f"{column} rlike r'{pattern}'", f"regexp_matches({column}, '{quoted}')"


def stepped(start: Column, steps: list[tuple[Column, float, float, float]]) -> Column:
    """A score after ordered steps (condition, change, least, most), each kept within its own bounds."""
    out = start
    for cond, change, least, most in steps:
        out = F.when(cond, F.greatest(F.lit(least), F.least(F.lit(most), out + change))).otherwise(out)
    return out


def stepped_sql(start: str, steps: list[tuple[str, float, float, float]]) -> str:
    out = start
    for cond, change, least, most in steps:
        out = f"(CASE WHEN {cond} THEN greatest({least}::DOUBLE, least({most}::DOUBLE, {out} + {change}::DOUBLE)) ELSE {out} END)"
    return out
