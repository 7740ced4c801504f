"""Cascades of rules: the first that holds names the outcome; and violations, all that hold."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, Column]


def cascade(rules: Sequence[Rule], otherwise: str | None = None) -> Column:
    """The name of the first rule that holds; a null condition does not hold."""
    out = None
    for name, condition in rules:
        out = F.when(condition, name) if out is None else out.when(condition, name)
    return F.lit(otherwise) if out is None else out.otherwise(F.lit(otherwise))


def reasons(rules: Sequence[Rule]) -> Column:
    """The names of all rules that hold, in their order."""
    return F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in rules]), lambda x: x.isNotNull())


def violations(df: DataFrame, key: str, rules: Sequence[Rule]) -> DataFrame:
    """``key, violation``: one row for each rule a row breaks."""
    return df.select(key, F.explode(reasons(rules)).alias("violation"))


def route(df: DataFrame, rules: Sequence[Rule], name: str = "outcome", otherwise: str = "accepted") -> DataFrame:
    return df.withColumn(name, cascade(rules, otherwise))


def all_hold(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [F.coalesce(c, F.lit(False)) for c in conditions], F.lit(True))
