"""Cascades that route sources and rows, and the verdicts drawn from aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boreal.functions import chat, text as X
from boreal.functions.measures import drop_ratio
from boreal.operators.rules import cascade, reasons

#: Values of provenance that are trusted. Fixed values.
TRUSTED_DIALECTS = ("quebec", "canada_fr", "canada-fr", "french_canadian", "canadian_french", "fr_ca")
TRUSTED_TIERS = ("gold", "silver", "bronze")
#: Levels of readiness from least to most; a blocked production corpus counts as insufficient. Fixed values.
LEVEL_ORDER = ("insufficient", "smoke_test", "pilot_lora_candidate", "production_lora_candidate")
#: Words a dataset card may not hold. Fixed values.
BANNED_WORDING = ("neutralize", "fr_fr", "fr-fr", "standardize to france french")
#: Commercial uses that keep a row to research. Fixed values.
RESEARCH_ONLY = ("permission_required", "prohibited", "unknown")


def flag(df: DataFrame, name: str, otherwise: bool = False) -> Column:
    """A boolean column, or its default where it is null or the table lacks it."""
    return F.coalesce(F.col(name), F.lit(otherwise)) if name in df.columns else F.lit(otherwise)


def value(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) if name in df.columns else F.lit("")


def source_eligibility(df: DataFrame, include_review: bool = False) -> Column:
    """Why a corpus source is not read, the first reason that holds; null if it is read."""
    review = F.lit(False) if include_review else flag(df, "requires_review")
    return cascade(
        [
            ("future_remote", value(df, "source_type") == "future_remote"),
            ("not_allowed_for_training", ~flag(df, "allowed_for_training")),
            ("requires_review", review),
            ("contains_holdout_material", flag(df, "contains_holdout_material")),
            ("quality_tier_quarantine", value(df, "quality_tier") == "quarantine"),
        ]
    )


def acquisition_route(df: DataFrame, adapters: Sequence[str]) -> Column:
    """The adapter that acquires a source, or why none does: ``skip:<reason>``, ``holdout`` for the registry."""
    status, kind, adapter = value(df, "acquisition_status"), value(df, "source_type"), value(df, "adapter")
    skipped = F.when(status.isin("catalog_only", "blocked_license"), F.concat(F.lit("skip:"), status))
    skipped = skipped.when((kind == "evaluation_holdout") | (status == "holdout_only"), "holdout").when(kind == "permission_required", "skip:permission_required")
    return skipped.when(adapter.isin(*adapters), adapter).when(kind == "github_dataset", "skip:catalog_only").otherwise("skip:unsupported_adapter")


def package_allowed(package: Column, source: Column) -> Column:
    """Whether a catalogue package may be taken, by its own licence class and its source's status."""
    unclear = source.isin("permission_required", "unclear")
    return F.when(package.isin("blocked", "unknown"), unclear).when(package == "noncommercial_only", unclear | source.isin("open_compatible", "noncommercial_only")).otherwise(True)


def fetch_gate(noncommercial_source: Column, include_noncommercial: bool, most_documents: int | None) -> Column:
    """Why pages or packages of a source are not fetched: ``noncommercial_not_included``, ``dry_run`` (a limit of 0)."""
    return cascade([("noncommercial_not_included", noncommercial_source & F.lit(not include_noncommercial)), ("dry_run", F.lit(most_documents == 0))])


def catalogue_decision(df: DataFrame, mode: str, include_review: bool = False, include_unreviewed: bool = False) -> Column:
    """Why an external dataset is not materialized for ``training``, ``evaluation`` or ``all-safe``; "selected" if it is."""
    if mode not in ("training", "evaluation", "all-safe"):
        raise ValueError("mode must be training, evaluation or all-safe")
    modality = F.coalesce(F.nullif(value(df, "modality"), F.lit("")), F.lit("text"))
    out = F.when(value(df, "adapter") == "catalog_only", "catalog_only_requires_future_adapter_or_review").when(modality != "text", F.concat(F.lit("unsupported_modality_"), modality))
    if not include_review:
        out = out.when(flag(df, "requires_review"), "requires_review")
    if not include_unreviewed:
        out = out.when(~flag(df, "license_reviewed"), "license_not_reviewed")
    allowed, held = flag(df, "allowed_for_training"), flag(df, "holdout_only")
    if mode == "training":
        held = held | flag(df, "allowed_for_evaluation") | value(df, "category").contains("benchmark")
        out = out.when(~allowed, "not_allowed_for_training").when(held, "benchmark_or_holdout_blocked_from_training")
    elif mode == "evaluation":
        out = out.when(~flag(df, "allowed_for_evaluation"), "not_allowed_for_evaluation")
    else:
        out = out.when(held, "holdout_excluded_from_all_safe").when(~allowed, "all_safe_only_materializes_training_allowed_sources")
    return out.otherwise("selected")


def trusted_provenance(df: DataFrame) -> Column:
    """Whether a record's dialect and tier are trusted and nothing speaks against training on it."""
    dialect, tier = X.atom(value(df, "dialect_region")), X.atom(value(df, "quality_tier"))
    free = flag(df, "allowed_for_training") & ~flag(df, "holdout_only") & ~flag(df, "contains_holdout_material") & ~flag(df, "requires_review")
    return dialect.isin(*TRUSTED_DIALECTS) & tier.isin(*TRUSTED_TIERS) & free


def curated_row_gate(df: DataFrame, required: Sequence[str] = ("policy_id", "curation_score", "curation_reasons")) -> Column:
    """Why a trainer refuses a curated row: another label than accepted, a required field missing; "empty" rows are
    passed over, not refused; null for a good row."""
    lacking = [(f"missing:{c}", F.col(c).isNull() if c in df.columns else F.lit(True)) for c in required]
    label = F.coalesce(F.col("curation_label"), F.lit(""))
    return cascade([("not_accepted", label != "accepted"), *lacking, ("empty", F.coalesce(X.clean("text"), F.lit("")) == "")])


def pack_row_gate(df: DataFrame) -> Column:
    """Why a trainer refuses a row of a training pack; null for a good row."""
    bare = F.coalesce(X.clean("text"), F.lit("")) == ""
    messages = F.col("messages") if "messages" in df.columns else F.lit(None).cast("array<struct<role:string,content:string>>")
    return cascade(
        [
            ("holdout", flag(df, "holdout_only") | flag(df, "contains_holdout_material")),
            ("not_allowed_for_training", ~flag(df, "allowed_for_training", True)),
            ("review_without_permission", flag(df, "requires_review") & ~flag(df, "permission_granted")),
            ("malformed_messages", messages.isNotNull() & ~chat.well_formed(messages)),
            ("empty", bare & messages.isNull()),
        ]
    )


def research_only(df: DataFrame) -> Column:
    """Rows a trainer takes with a warning: their commercial use keeps them to research."""
    return F.lower(X.clean(value(df, "commercial_use"))).isin(*RESEARCH_ONLY)


def split_input_violations(df: DataFrame, label: str = "accepted") -> Column:
    """What speaks against splitting a curated row: an array of reasons."""
    return reasons(
        [
            ("unexpected_label", ~F.col("curation_label").eqNullSafe(F.lit(label))),
            ("missing_policy_id", F.coalesce(F.col("policy_id"), F.lit("")) == ""),
            ("missing_curation_score", F.col("curation_score").isNull()),
            ("missing_curation_reasons", F.coalesce(F.size("curation_reasons"), F.lit(0)) <= 0),
        ]
    )


def export_row_violations(df: DataFrame) -> Column:
    """What speaks against exporting a row of a split."""
    return reasons(
        [
            ("no_text", F.coalesce(X.clean("text"), F.lit("")) == ""),
            ("no_source", value(df, "source_id") == ""),
            ("holdout", flag(df, "holdout_only")),
            ("not_allowed_for_training", ~flag(df, "allowed_for_training", True)),
        ]
    )


def gate_rows(df: DataFrame, gate: Column, passed_over: Sequence[str] = ()) -> DataFrame:
    """The rows a gate lets through. Any other reason than those passed over is a ValueError that counts them by
    reason, so nothing refused reaches a trainer unnoticed."""
    told = df.withColumn("__gate", gate)
    bad = {r["__gate"]: r["count"] for r in told.where(F.col("__gate").isNotNull()).groupBy("__gate").count().collect()}
    refused = {k: n for k, n in sorted(bad.items()) if k not in passed_over}
    if refused:
        raise ValueError(", ".join(f"{k}: {n}" for k, n in refused.items()))
    return told.where(F.col("__gate").isNull()).drop("__gate")


def level_at_least(level: Column, least: str) -> Column:
    """Whether a readiness level reaches another; a blocked or unknown one is the lowest."""
    place = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for i, n in enumerate(LEVEL_ORDER) for x in (n, i)]), level), F.lit(0))
    return place >= LEVEL_ORDER.index(least)


def stage_verdict(stages: DataFrame) -> DataFrame:
    """One row from ``stage, passed, blocking``: ``stages, failed`` (blocking ones, in order) and ``ok``; a stage that
    says nothing has failed."""
    failed = F.array_sort(F.collect_list(F.when(F.coalesce("blocking", F.lit(True)) & ~F.coalesce("passed", F.lit(False)), F.col("stage"))))
    return stages.agg(F.count(F.lit(1)).alias("stages"), failed.alias("failed")).withColumn("ok", F.size("failed") == 0)


def download_verdict(sources: DataFrame, least: int, allow_partial: bool) -> DataFrame:
    """One row from ``status`` (downloaded, cached, failed): ``available, failed, partial_ok, ok``."""
    row = sources.agg(F.count_if(F.col("status").isin("downloaded", "cached")).alias("available"), F.count_if(F.col("status") == "failed").alias("failed"))
    row = row.withColumn("partial_ok", (F.col("failed") > 0) & F.lit(allow_partial) & (F.col("available") >= least))
    return row.withColumn("ok", (F.col("failed") == 0) | F.col("partial_ok"))


def drop_monitor(df: DataFrame, before: str, after: str, most: float) -> DataFrame:
    """Adds ``drop_ratio`` and ``rollback_required``; scores outside (0, 1] and [0, 1] are an ``issue``."""
    if not 0 <= most <= 1:
        raise ValueError("the allowed drop must be in [0, 1]")
    b, a = F.col(before).try_cast("double"), F.col(after).try_cast("double")
    issue = cascade([("before_out_of_range", ~F.coalesce((b > 0) & (b <= 1), F.lit(False))), ("after_out_of_range", ~F.coalesce((a >= 0) & (a <= 1), F.lit(False)))])
    ratio = F.when(issue.isNull(), drop_ratio(b, a))
    return df.withColumns({"drop_ratio": F.round(ratio, 6), "rollback_required": ratio > most, "issue": issue})


def expected_baseline(prompts: DataFrame) -> DataFrame:
    """The score of a system that always answers with the unwanted term: one point lost a prompt."""
    return prompts.agg(F.count(F.lit(1)).alias("prompts"), (-F.count(F.lit(1))).alias("expected_score"))


def pack_audit(reports: DataFrame) -> DataFrame:
    """The fields of a pack's report a release looks at, with the defaults of missing ones; without any report the one
    row says so."""
    spark = reports.sparkSession
    kinds = {"ok": "false", "mode": "'unknown'", "level": "'insufficient'", "examples": "0L", "train_examples": "0L", "dev_examples": "0L", "test_examples": "0L", "tokens": "0L", "instruction_ratio": "0.0D", "sources": "0L", "domains": "0L", "registers": "0L"}
    told = reports.select(*[F.coalesce(F.col(c) if c in reports.columns else F.lit(None), F.expr(d)).alias(c) for c, d in kinds.items()], (F.col("blockers") if "blockers" in reports.columns else F.array().cast("array<string>")).alias("blockers"))
    none = spark.range(1).select(*[F.expr(d).alias(c) for c, d in kinds.items()], F.array(F.lit("missing_report")).alias("blockers"))
    return told.union(none.join(told.limit(1).select(F.lit(1).alias("__some")), how="left_anti"))


def banned_wording(text: Column) -> Column:
    """The banned words a dataset card holds."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return reasons([(w, F.contains(low, F.lit(w))) for w in BANNED_WORDING])
