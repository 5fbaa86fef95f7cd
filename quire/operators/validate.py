"""Checks of rows as data: each rule names the rows that break it, and strict mode raises the first.

A check that sits in a column nobody reads is pruned away with it, so violations are a table of their own.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.scores import CATEGORIES


@dataclass(frozen=True)
class Rule:
    """``broken``: true for rows at fault (null counts as sound); ``message``: what is said of them."""

    name: str
    broken: Column
    message: Column | str


class ValidationError(ValueError):
    """The first violation of a table, by rule and then by key."""


def violations(df: DataFrame, rules: list[Rule], key: list[str]) -> DataFrame:
    """rule_no, rule, key columns, message: one row for each rule that a row breaks; one pass over ``df``."""
    said = lambda r: r.message if isinstance(r.message, Column) else F.lit(r.message)
    found = F.array_compact(F.array(*[F.when(F.coalesce(r.broken, F.lit(False)), F.struct(F.lit(i).alias("rule_no"), F.lit(r.name).alias("rule"), said(r).alias("message"))) for i, r in enumerate(rules)]))
    return df.select(*key, F.explode(found).alias("_f")).select("_f.rule_no", "_f.rule", *key, "_f.message")


def require(df: DataFrame, rules: list[Rule], key: list[str]) -> DataFrame:
    """``df`` if it breaks no rule, else ValidationError. An action of its own."""
    first = violations(df, rules, key).orderBy("rule_no", *key).limit(1).collect()
    if first:
        raise ValidationError(f"{first[0].rule}: {first[0].message} ({', '.join(f'{k}={first[0][k]}' for k in key)})")
    return df


def in_range(name: str, column: str, low: float, high: float) -> Rule:
    value = F.col(column)
    return Rule(name, ~value.between(low, high) | F.isnan(value), F.concat(F.lit(f"{column} outside [{low:g}, {high:g}]: "), value.cast("string")))


def member(name: str, column: str, allowed: tuple[str, ...]) -> Rule:
    return Rule(name, ~F.col(column).isin(*allowed), F.concat(F.lit(f"unknown {column}: "), F.col(column)))


def positive(name: str, column: str) -> Rule:
    return Rule(name, F.col(column) <= 0, F.concat(F.lit(f"{column} must be positive, got "), F.col(column).cast("string")))


def not_blank(name: str, column: str) -> Rule:
    return Rule(name, F.trim(column) == "", f"{column} must be a non-empty string")


def simplex(probabilities: str = "probabilities", category: str = "category", tolerance: float = 0.001, allowed: tuple[str, ...] = CATEGORIES) -> list[Rule]:
    """Keys are the categories, values in [0, 1], their sum 1 within ``tolerance``, and the category has the highest."""
    p, keys = F.col(probabilities), F.array(*[F.lit(c) for c in allowed])
    values = F.map_values(p)
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    strange = (F.size(F.array_except(F.map_keys(p), keys)) > 0) | (F.size(F.array_except(keys, F.map_keys(p))) > 0)
    best = F.array_max(values)
    return [
        Rule("probability keys", strange, "probabilities do not name the categories"),
        Rule("probability range", F.exists(values, lambda x: F.isnan(x) | (x < 0) | (x > 1)), "a probability is outside [0, 1]"),
        Rule("probability sum", F.abs(total - 1) > tolerance, "probabilities do not sum to 1"),
        Rule("most probable", F.try_element_at(p, F.col(category)) < best, "the category is not the most probable one"),
    ]


def entries(value: str = "value", pages: str = "pages") -> list[Rule]:
    """A spelling is a non-empty string with a non-empty list of positive pages."""
    return [
        not_blank("empty value", value),
        Rule("no pages", F.coalesce(F.size(pages), F.lit(0)) < 1, f"{pages} must not be empty"),
        Rule("page number", F.exists(pages, lambda p: p.isNull() | (p < 1)), f"{pages} must be positive"),
    ]


def parameters(**values: tuple[float, float, float]) -> None:
    """ValueError unless each value lies in its [low, high]; given as name=(value, low, high)."""
    for name, (value, low, high) in values.items():
        if isinstance(value, bool) or not isinstance(value, (int, float)) or not low <= value <= high:
            raise ValueError(f"{name} must be in [{low:g}, {high:g}], got {value!r}")


def page_numbers() -> list[Rule]:
    return [positive("page number", "page_number")]


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)
