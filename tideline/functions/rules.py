"""Ordered categorisation rules: the first rule that holds names the category."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``category`` applies when any listed test holds.

    ``equals`` maps a column to accepted values. ``prefixes`` maps ``(column, length)``
    to accepted leading substrings of exactly that length, or the whole value when it
    is shorter.
    """

    category: str
    equals: dict[str, Sequence[str]] | None = None
    prefixes: dict[tuple[str, int], Sequence[str]] | None = None

    def condition(self) -> Column:
        tests = [F.col(name).isin(*values) for name, values in (self.equals or {}).items()]
        tests += [
            F.substring(F.col(name), 1, length).isin(*values)
            for (name, length), values in (self.prefixes or {}).items()
        ]
        combined = tests[0]
        for test in tests[1:]:
            combined = combined | test
        return combined


def categorise(rules: Sequence[Rule], otherwise: Column) -> Column:
    """One CASE expression; a test that is null does not hold."""
    first, *rest = rules
    case = F.when(first.condition(), F.lit(first.category))
    for rule in rest:
        case = case.when(rule.condition(), F.lit(rule.category))
    return case.otherwise(otherwise)
