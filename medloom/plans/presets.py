"""Named subsets of operators and their wiring: a plan is a list of transforms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

Transform = Callable[[DataFrame], DataFrame]

#: Query name prefixes of each preset; branches that aren't asked for are never planned.
PRESETS = {
    "all": [""],
    "abbreviations": ["ex01", "ex02", "ex03", "ex05", "ex06", "ag03", "wn01"],
    "identifiers": ["ex10", "ex11", "ex19", "fl20"],
    "genes": ["ag04", "ag08", "sc14", "sc28", "p4_"],
    "entities": ["jn01", "jn03", "ag06", "ag10", "ag25", "wn02"],
    "evaluation": ["jn17", "jn18", "ag11", "ag12", "ag13"],
    "usage": ["ag15", "ag16", "ag17", "ag18", "ag19"],
    "pages": ["sc04", "fl24", "ag22", "ag29", "jn21", "p5_"],
}


def chosen(names: list[str], preset: str) -> list[str]:
    """The query names of a preset, in their own order."""
    return [n for n in names if any(n.startswith(p) for p in PRESETS[preset])]


def chain(df: DataFrame, steps: list[Transform]) -> DataFrame:
    """Apply transforms in turn; each gets the plan of those before it."""
    for step in steps:
        df = df.transform(step)
    return df
