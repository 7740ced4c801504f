"""Constraints on manifests, run as queries over their entries: every rule an entry breaks, by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boreal.operators.gates import flag, value
from boreal.operators.rules import violations

SLUG = r"^[a-z0-9][a-z0-9_\-]*$"


def _counted(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``__times``, how often a row's keys occur (null for null keys). Counts are joined, so a key that many rows
    repeat is never one task's window."""
    return df.join(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__times")), list(keys), "left")


def relative_path(path: Column) -> Column:
    """Whether a path stays inside its folder: not absolute, and never above it."""
    return ~(path.startswith("/") | path.rlike(r"(^|[\\/])\.\.([\\/]|$)") | path.rlike(r"^[A-Za-z]:"))


def source_violations(df: DataFrame, key: str = "source_id", allowed: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """``<key>, violation`` of a manifest of corpus sources: a missing, malformed or repeated id, a value outside the
    ``allowed`` ones of a column (null is fine), training allowed on held-out, quarantined or unreviewed personal
    data, an active source whose licence is unclear, a path that leaves its folder, dates the wrong way round."""
    own = _counted(df, [key])
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    held = flag(df, "holdout_only") | flag(df, "contains_holdout_material")
    train, review = flag(df, "allowed_for_training"), flag(df, "requires_review")
    path = value(df, "source_path")
    rules = [
        ("missing_id", name == ""),
        ("malformed_id", (name != "") & ~name.rlike(SLUG)),
        ("repeated_id", (name != "") & (F.col("__times") > 1)),
        *[(f"unknown_{c}", F.col(c).isNotNull() & ~F.col(c).isin(*vs)) for c, vs in (allowed or {}).items()],
        ("training_on_holdout", train & held),
        ("training_on_quarantine", train & (value(df, "quality_tier") == "quarantine")),
        ("personal_data_without_review", value(df, "pii_risk").isin("high", "contains_pii") & ~review),
        ("active_with_unclear_license", (value(df, "acquisition_status") == "active") & value(df, "license_status").isin("", "unclear", "unknown")),
        ("path_leaves_folder", (path != "") & ~relative_path(path)),
        ("dates_reversed", value(df, "date_min") > F.coalesce(F.nullif(value(df, "date_max"), F.lit("")), F.lit("9999"))),
    ]
    return violations(own, key, rules)


def pair_violations(df: DataFrame, source: str = "source", preferred: str = "preferred", rejected: str = "rejected", key: str = "pair_id") -> DataFrame:
    """``<key>, violation`` of a manifest of term pairs: blank terms, a source term that is not among the rejected, a
    preferred one that is, and pairs given twice."""
    own = _counted(df, [source, preferred])
    filled = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    inside = lambda c: F.coalesce(F.array_contains(rejected, F.col(c)), F.lit(False))
    return violations(own, key, [("blank_term", ~filled(source) | ~filled(preferred)), ("source_not_rejected", ~inside(source)), ("preferred_rejected", inside(preferred)), ("repeated_pair", F.col("__times") > 1)])


def share_violations(df: DataFrame, key: str, ratios: Sequence[str], total: float | None = 1.0, tolerance: float = 1e-6) -> DataFrame:
    """``<key>, violation`` of rows of ratios: one that is missing or outside [0, 1], and a sum other than ``total``."""
    rules = [(f"ratio_{c}", ~F.coalesce(F.col(c).between(0, 1), F.lit(False))) for c in ratios]
    if total is not None:
        rules.append(("ratio_sum", F.abs(sum((F.coalesce(F.col(c), F.lit(0.0)) for c in ratios), F.lit(0.0)) - total) > tolerance))
    return violations(df, key, rules)


def descending_violations(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``<key>, violation`` of rows whose thresholds must not ascend in the given order; null and non-finite ones are
    violations of their own."""
    finite = lambda c: F.coalesce(F.abs(F.col(c)) < float("inf"), F.lit(False)) & ~F.coalesce(F.isnan(F.col(c)), F.lit(False))
    rules = [(f"not_finite_{c}", ~finite(c)) for c in columns]
    rules += [(f"ascends_{b}", F.col(a) < F.col(b)) for a, b in zip(columns, columns[1:])]
    return violations(df, key, rules)


def taxonomy_violations(df: DataFrame, severities: Sequence[str] = ("blocking", "major", "minor")) -> DataFrame:
    """``error_code, violation`` of an error taxonomy (``lp_id, error_code, severity``)."""
    own = _counted(df, ["lp_id", "error_code"])
    return violations(own, "error_code", [("level_out_of_range", ~F.coalesce(F.col("lp_id").between(1, 20), F.lit(False))), ("blank_code", F.coalesce(F.trim("error_code"), F.lit("")) == ""), ("unknown_severity", ~F.coalesce(F.col("severity").isin(*severities), F.lit(False))), ("repeated_code", F.col("__times") > 1)])
