"""A training pack: records of several inputs filtered by reason, deduplicated, capped, and what the result amounts to."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boreal.functions import text as X
from boreal.operators import audit
from boreal.operators.balance import drop_score, share_cap
from boreal.operators.dedup import two_key_reasons
from boreal.operators.rules import cascade, reasons
from boreal.session import written

#: Modes of a pack, and the values that mark what may not be sold. Fixed values.
MODES = ("fixture_ci", "local_research", "production_commercial")
NOT_COMMERCIAL = ("permission_required", "unknown", "prohibited")
NOT_COMMERCIAL_LICENSE = ("noncommercial_only", "permission_required", "unclear", "blocked")


@dataclass(frozen=True)
class PackPolicy:
    mode: str = "local_research"
    min_chars: int = 80
    max_chars: int = 2500
    reject_holdout: bool = True
    reject_unknown_use: bool = False
    reject_without_grant: bool = True
    reject_duplicate_normalized: bool = True
    input_shares: Mapping[str, float] = field(default_factory=dict)
    source_share: float = 1.0
    family_share: float = 1.0
    pilot_domains: int = 4
    pilot_registers: int = 3
    production_examples: int = 200_000
    levels: Sequence[tuple[str, int]] = (("production_lora_candidate", 150_000_000), ("pilot_lora_candidate", 20_000_000), ("smoke_test", 500_000))
    seed: int = 42

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {', '.join(MODES)}")
        if not all(0 < x <= 1 for x in (self.source_share, self.family_share, *self.input_shares.values())):
            raise ValueError("shares must be in (0, 1]")
        if [n for _, n in self.levels] != sorted((n for _, n in self.levels), reverse=True):
            raise ValueError("levels must descend")


def _filled(name: str, otherwise: str = "unknown") -> Column:
    return F.coalesce(F.nullif(F.col(name).cast("string"), F.lit("")), F.lit(otherwise))


def _set(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def noncommercial() -> Column:
    return (F.col("license_status") == "noncommercial_only") | (F.col("commercial_use") == "permission_required")


def needs_permission() -> Column:
    return (F.col("commercial_use") == "permission_required") | (F.col("license_status") == "permission_required") | (F.col("source_type") == "permission_required") | F.col("requires_review")


def standard_records(df: DataFrame, seed: int = 42) -> DataFrame:
    """Records with cleaned text, hashes of that text, and the defaults of missing fields. Columns a table lacks count as
    missing; a record without an id gets one from its source and text."""
    kinds = {"allowed_for_training": "boolean", "holdout_only": "boolean", "contains_holdout_material": "boolean", "requires_review": "boolean"}
    names = ("record_id", "source_id", "source_family", "source_input", "text", "language", "register", "domain", "license_status", "commercial_use", "source_type", *kinds)
    lacking = {c: F.lit(None).cast(kinds.get(c, "string")) for c in names if c not in df.columns}
    own = df.withColumns(lacking) if lacking else df
    own = own.withColumn("text", F.coalesce(X.clean("text"), F.lit("")))
    own = own.withColumns(
        {
            "source_family": _filled("source_family"), "source_input": _filled("source_input"), "language": _filled("language", "fr-CA"),
            **{c: _filled(c) for c in ("register", "domain", "license_status", "commercial_use", "source_type")},
            "allowed_for_training": F.coalesce("allowed_for_training", F.lit(True)), **{c: _set(c) for c in ("holdout_only", "contains_holdout_material", "requires_review")},
        }
    )
    own = own.withColumn("source_id", F.coalesce(F.nullif("source_id", F.lit("")), F.col("source_family")))
    made = F.substring(X.sha(F.concat_ws(":", "source_id", "text")), 1, 24)
    own = own.withColumns({"record_id": F.coalesce(F.nullif(F.col("record_id").cast("string"), F.lit("")), made), "text_sha256": X.sha("text"), "normalized_text_sha256": X.sha(X.norm_key("text"))})
    return own.withColumn("drop_score", drop_score(seed, "source_id", "normalized_text_sha256", "record_id"))


def reject_rules(policy: PackPolicy) -> list[tuple[str, Column]]:
    """Why a record is left out, in the order in which reasons are tried; ``granted`` is a boolean column."""
    size = F.length("text")
    rules = [("empty_text", size == 0), ("text_too_short", size < policy.min_chars), ("text_too_long", size > policy.max_chars)]
    if policy.reject_holdout:
        rules.append(("holdout_material", F.col("holdout_only") | F.col("contains_holdout_material")))
    rules.append(("allowed_for_training_false", ~F.col("allowed_for_training")))
    if policy.mode == "production_commercial":
        rules.append(("commercial_mode_reject", F.col("commercial_use").isin(*NOT_COMMERCIAL) | F.col("license_status").isin(*NOT_COMMERCIAL_LICENSE)))
    elif policy.reject_unknown_use:
        rules.append(("commercial_not_safe", F.col("commercial_use").isin("unknown", "prohibited")))
    if policy.reject_without_grant:
        waived = (noncommercial() & ~F.col("requires_review")) if policy.mode == "local_research" else F.lit(False)
        rules.append(("permission_required_without_grant", needs_permission() & ~F.col("granted") & ~waived))
    return rules


def with_grants(df: DataFrame, grants: DataFrame | None, key: str = "source_id") -> DataFrame:
    """Adds ``granted``: whether a record's source is in the table of granted sources (one column of that name)."""
    if grants is None:
        return df.withColumn("granted", F.lit(False))
    known = grants.select(F.col(key)).where(F.col(key).isNotNull()).distinct().withColumn("granted", F.lit(True))
    return df.join(known, key, "left").withColumn("granted", F.coalesce("granted", F.lit(False)))


def judged(records: DataFrame, policy: PackPolicy, grants: DataFrame | None = None, order: Sequence[str] = ("input_ord", "record_id")) -> DataFrame:
    """Standard records with ``reason``: null for those accepted so far, else the first rule that holds or, among
    the others, a repeated text. The first of equal texts in ``order`` stays; the order must tell rows apart."""
    ruled = with_grants(records, grants).withColumn("__rule", cascade(reject_rules(policy)))
    # The columns that decide are deduplicated; texts stay where they are until the reasons are joined back.
    keyed = written(ruled, "ruled")
    left = keyed.where("__rule is null").select(*order, "text_sha256", "normalized_text_sha256")
    normal = "normalized_text_sha256" if policy.reject_duplicate_normalized else "text_sha256"
    repeated = two_key_reasons(left, "text_sha256", normal, list(order)).select(*order, "reason")
    if not policy.reject_duplicate_normalized:
        repeated = repeated.withColumn("reason", F.when(F.col("reason").isNotNull(), "duplicate_exact"))
    repeated = repeated.where("reason is not null").distinct().select(*order, F.concat("reason", F.lit("_text")).alias("__repeated"))
    return keyed.join(repeated, list(order), "left").withColumn("reason", F.coalesce("__rule", "__repeated")).drop("__rule", "__repeated")


def accepted(judged_records: DataFrame, policy: PackPolicy) -> DataFrame:
    """The records left under the caps of inputs, then of sources, then of families, in each of which those with the
    greatest drop score go first; ``accepted_order`` is the key of their order in the pack."""
    rank = ["drop_score", "normalized_text_sha256", "record_id"]
    left = written(judged_records.where("reason is null").drop("reason"), "candidates")
    steps: list[tuple[str, float | Mapping[str, float]]] = [("source_input", policy.input_shares), ("source_id", policy.source_share), ("source_family", policy.family_share)]
    for key, cap in steps:
        if cap and cap != 1.0:
            left = written(share_cap(left, key, cap, rank), "capped")
    return left.withColumn("accepted_order", F.struct("source_family", "source_id", "normalized_text_sha256", "record_id"))


def rejections(judged_records: DataFrame, kept: DataFrame) -> DataFrame:
    """``reason, n`` over all records left out, with those the caps took as downsample_share."""
    told = judged_records.groupBy(F.coalesce("reason", F.lit("")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    counted = kept.agg((-F.count(F.lit(1))).alias("n")).select(F.lit("").alias("reason"), "n")
    total = told.union(counted).groupBy("reason").agg(F.sum("n").alias("n")).where("n > 0")
    return total.withColumn("reason", F.when(F.col("reason") == "", "downsample_share").otherwise(F.col("reason")))


SUMMARIES = ("source_id", "source_family", "domain", "register", "task_type", "license_status", "commercial_use")


def metrics(examples: DataFrame, policy: PackPolicy, split: str = "split") -> DataFrame:
    """One row about a pack's examples: how many, their tokens, shares and diversity, the level these tokens reach,
    what blocks it and what to do about it. An empty pack is insufficient and blocked."""
    counts = audit.count_by(examples, SUMMARIES)
    most = lambda k: F.coalesce(F.max(F.when(F.col("key") == k, F.col("n"))), F.lit(0))
    of = lambda k, cond: F.coalesce(F.sum(F.when((F.col("key") == k) & cond, F.col("n"))), F.lit(0))
    kinds = lambda k: F.count_if(F.col("key") == k)
    shares = counts.agg(
        most("source_id").alias("__source"), most("source_family").alias("__family"), kinds("source_id").alias("sources"), kinds("domain").alias("domains"), kinds("register").alias("registers"), kinds("task_type").alias("tasks"),
        of("source_family", ~F.lower("value").contains("literary")).alias("__modern"), of("task_type", F.col("value") == "preserve_raw").alias("__raw"), of("commercial_use", F.col("value") == "permission_required").alias("__permission"),
    )
    totals = examples.agg(
        F.count(F.lit(1)).alias("examples"), F.coalesce(F.sum(audit.row_tokens()), F.lit(0)).alias("tokens"), F.coalesce(F.sum(F.when(F.col(split) == "train", audit.row_tokens())), F.lit(0)).alias("train_tokens"),
        *[F.count_if(F.col(split) == s).alias(f"{s}_examples") for s in ("train", "dev", "test")],
    )
    row = totals.crossJoin(shares)  # one row each
    share = lambda c: F.coalesce(F.try_divide(F.col(c), F.col("examples")), F.lit(0.0))
    row = row.withColumns({"max_source_share": share("__source"), "max_family_share": share("__family"), "modern_share": share("__modern"), "raw_share": share("__raw"), "permission_share": share("__permission"), "instruction_ratio": F.when(F.col("examples") > 0, 1 - share("__raw")).otherwise(0.0)})
    row = row.withColumn("level", cascade([(n, F.col("tokens") >= t) for n, t in policy.levels], "insufficient"))
    pilot = F.col("level").isin("pilot_lora_candidate", "production_lora_candidate")
    some, research = F.col("examples") > 0, F.lit(policy.mode == "local_research")
    blocking = [
        ("no_examples_generated", ~some),
        ("low_domain_diversity_for_pilot", pilot & (F.col("domains") < policy.pilot_domains)),
        ("low_register_diversity_for_pilot", pilot & (F.col("registers") < policy.pilot_registers)),
        ("single_source_dominance", F.col("max_source_share") > policy.source_share + 1e-9),
        ("single_source_family_dominance", F.col("max_family_share") > policy.family_share + 1e-9),
        ("source_family_dominance", research & some & (F.col("max_family_share") >= 0.75)),
        ("insufficient_modern_diversity", research & some & (F.col("modern_share") < 0.2)),
        ("insufficient_instruction_examples_for_production", (F.col("level") == "production_lora_candidate") & (F.col("examples") < policy.production_examples)),
    ]
    advice = [
        ("more_instructions_and_diversity", F.lit(True)),
        ("secure_commercial_sources", F.col("permission_share") > 0.3),
        ("more_instruction_variety", F.col("raw_share") > 0.8),
        ("more_instruction_strategies", F.col("instruction_ratio") < 0.5),
        ("rerun_for_release", research),
    ]
    row = row.withColumns({"blockers": reasons(blocking), "recommendations": reasons(advice)})
    row = row.withColumn("level", F.when((F.col("level") == "production_lora_candidate") & (F.size("blockers") > 0), "production_blocked").otherwise(F.col("level")))
    return row.drop("__source", "__family", "__modern", "__raw", "__permission")


def commercial_readiness(kept: DataFrame, rejected: DataFrame, policy: PackPolicy) -> DataFrame:
    """One row: ``noncommercial, permission_required, reasons, ready`` from the accepted records and the rejections."""
    own = kept.agg(F.count_if(noncommercial()).alias("noncommercial"), F.count_if(needs_permission()).alias("permission_required"))
    hit = rejected.agg(F.coalesce(F.bool_or(F.col("reason").isin("commercial_mode_reject", "commercial_not_safe")), F.lit(False)).alias("__hit"))
    rules = [
        ("pack_mode_local_research_blocks_commercial_release", F.lit(policy.mode == "local_research")),
        ("pack_mode_fixture_ci_not_for_commercial_release", F.lit(policy.mode == "fixture_ci")),
        ("contains_noncommercial_records", F.col("noncommercial") > 0),
        ("contains_permission_required_records", F.col("permission_required") > 0),
        ("commercial_safety_filters_triggered", F.col("__hit")),
    ]
    row = own.crossJoin(hit).withColumn("reasons", reasons(rules)).drop("__hit")  # one row each
    return row.withColumn("ready", (F.size("reasons") == 0) & F.lit(policy.mode == "production_commercial"))
