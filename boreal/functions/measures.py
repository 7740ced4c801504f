"""Numbers: similarity of embeddings, tolerant parsing, ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_embedding(x: Column) -> Column:
    """``"1 0 0.5"`` as an array of doubles; null if a part is no number or none is left."""
    parts = F.filter(F.split(F.trim(F.regexp_replace(x, r"[\[\],\s]+", " ")), " "), lambda s: s != "")
    numbers = F.transform(parts, lambda s: s.try_cast("double"))
    return F.when((F.size(numbers) > 0) & F.forall(numbers, lambda n: n.isNotNull()), numbers)


def cosine(a: Column, b: Column) -> Column:
    """Cosine clamped to [0, 1]; 0 if a norm is 0, null if the lengths differ."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    dot = total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))
    norm = lambda x: F.sqrt(total(F.transform(x, lambda v: v.cast("double") * v.cast("double"))))
    both = norm(a) * norm(b)
    value = F.when(both == 0, 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), dot / F.nullif(both, F.lit(0.0)))))
    return F.when(F.size(a) == F.size(b), value)


def strict_bool(x: Column) -> Column:
    """A boolean, or 0 or 1 as a number or text, and nothing else; null marks a malformed value."""
    plain = F.trim(x.cast("string"))
    real = F.typeof(x) == "boolean"
    return F.when(plain == "1", True).when(plain == "0", False).when(real & (plain == "true"), True).when(real & (plain == "false"), False)


def number(x: Column) -> Column:
    """A finite number, else null."""
    value = x.try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def drop_ratio(before: Column, after: Column) -> Column:
    """(before - after) / before; null without a positive value before."""
    return F.when(before > 0, (before - after) / before)


def weight(repetitions: Column, factor: Column) -> Column:
    """Repetitions scaled by a factor, half to even, at least 1."""
    return F.greatest(F.lit(1), F.bround(repetitions * factor).cast("int"))
