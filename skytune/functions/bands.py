"""Banded rules: ordered tests on one column, the first that holds names the value.

A rule is data; ``on`` turns it into one expression that stays inside whole-stage code
generation. A NULL input satisfies no test and takes
``otherwise``; so does NaN in a column of real numbers, which Spark would take for the greatest. Rules on ranges become
a ``CASE``; rules on single values a lookup in a constant map, which generates far less
code than a chain of comparisons (the JVM never compiles a method over 8000 bytes).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from operator import add
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

Test = Callable[[str], str]


def literal(value: Any) -> str:
    """SQL literal; a float is a double, never a decimal."""
    if isinstance(value, str):
        return "'" + value.replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else repr(value)


def at_least(x: float) -> Test:
    return lambda c: f"{c} >= {literal(x)}"


def above(x: float) -> Test:
    return lambda c: f"{c} > {literal(x)}"


def at_most(x: float) -> Test:
    return lambda c: f"{c} <= {literal(x)}"


def below(x: float) -> Test:
    return lambda c: f"{c} < {literal(x)}"


def exactly(x: float) -> Test:
    return lambda c: f"{c} = {literal(x)}"


def between(lo: float, hi: float) -> Test:
    return lambda c: f"{c} BETWEEN {literal(lo)} AND {literal(hi)}"


def around_midnight(start: int, end: int) -> Test:
    """Hours from ``start`` over midnight to ``end``."""
    return lambda c: f"({c} >= {literal(start)} OR {c} <= {literal(end)})"


def any_of(*tests: Test) -> Test:
    return lambda c: "(" + " OR ".join(t(c) for t in tests) + ")"


@dataclass(frozen=True)
class Bands:
    """Ordered range tests."""

    source: str
    arms: tuple[tuple[Test, Any], ...]
    otherwise: Any
    real: bool = field(default=False, kw_only=True)

    def on(self) -> Column:
        arms = " ".join(
            f"WHEN {test(self.source)} THEN {literal(result)}" for test, result in self.arms
        )
        if self.real:
            arms = f"WHEN isnan({self.source}) THEN {literal(self.otherwise)} {arms}"
        return F.expr(f"CASE {arms} ELSE {literal(self.otherwise)} END")


@dataclass(frozen=True)
class Lookup:
    """Groups of single values."""

    source: str
    groups: tuple[tuple[tuple[Any, ...], Any], ...]
    otherwise: Any
    key_type: str = field(default="string", kw_only=True)
    fold_case: bool = field(default=False, kw_only=True)

    def on(self) -> Column:
        entries = ", ".join(
            f"CAST({literal(value)} AS {self.key_type}), {literal(result)}"
            for values, result in self.groups
            for value in values
        )
        key = f"lower({self.source})" if self.fold_case else self.source
        return F.expr(
            f"coalesce(try_element_at(map({entries}), {key}), {literal(self.otherwise)})"
        )


def total(names: list[str]) -> Column:
    return reduce(add, (F.col(n) for n in names))


def clamp(value: Column, lo: int, hi: int) -> Column:
    """Bounds a value; NULL stays NULL although greatest/least would skip it."""
    return F.when(value.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), value)))


def known(value: Column) -> Column:
    """A real number, or NULL where it is NaN: missing either way."""
    return F.when(~F.isnan(value), value)


def flag(condition: Column) -> Column:
    """A condition as a never-NULL boolean."""
    return F.coalesce(condition, F.lit(False))
