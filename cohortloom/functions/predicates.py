"""Row predicates and flags as plain Columns, so they reach the scan."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortloom.spec import CodeSet, FlagRule, TextSet


def any_of(conditions: Sequence[Column]) -> Column:
    """OR of the conditions; no condition means no row."""
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


def like_any(text: Column, patterns: Sequence[str]) -> Column:
    return any_of([text.like(p) for p in patterns])


def unlike(text: Column, *patterns: str) -> Column:
    """Text like none of the patterns; a null text is not kept."""
    return reduce(lambda a, b: a & b, [~text.like(p) for p in patterns])


def other_than(value: Column, left_out: str) -> Column:
    """Known values but one."""
    return value != left_out


def without_reason(reason: Column) -> Column:
    """Ids of 0 and less stand for no reason; an unknown one is not kept."""
    return reason <= 0


def in_text_set(text: Column, chosen: TextSet) -> Column:
    parts = [text.isin(*chosen.exact)] if chosen.exact else []
    return any_of(parts + [text.like(p) for p in chosen.patterns])


def in_code_set(category: Column, name: Column, chosen: CodeSet) -> Column:
    parts = [category.isin(*chosen.exact)] if chosen.exact else []
    if chosen.guard:
        parts.append(category.isin(*chosen.guard) & like_any(name, chosen.patterns))
    return any_of(parts)


def flag(text: Column, rule: FlagRule) -> Column:
    """The flag of a text under a rule; always a string column."""
    otherwise = F.lit(rule.default).cast("string")
    if not rule.branches:
        return otherwise
    result = F
    for values, mark in rule.branches:
        test = ~text.isin(*values) if rule.outside else text.isin(*values)
        result = result.when(test, F.lit(mark))
    return result.otherwise(otherwise)
