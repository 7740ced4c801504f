"""Scoring and labelling of records by markers, penalties and provenance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boreal.functions.text import clean, has_word, norm_key, sha, upper_share, word_count
from boreal.operators.dedup import duplicate_flags
from boreal.operators.rules import cascade, reasons

#: Words typical of Québec French, and their European counterparts. Fixed values.
MARKERS = ("courriel", "fin de semaine", "magasiner", "char", "dépanneur", "chu", "icitte", "pantoute")
REPLACEMENTS = (("email", "courriel"), ("week-end", "fin de semaine"), ("voiture", "char"))


@dataclass(frozen=True)
class CurationPolicy:
    """Weights and thresholds; thresholds must not ascend from accept to reject. Defaults are fixed values."""

    base: float = 1.0
    markers: Mapping[str, float] = field(default_factory=lambda: {"courriel": 0.5, "fin de semaine": 0.5, "magasiner": 0.4, "dépanneur": 0.4, "char": 0.3, "chu": 0.3, "icitte": 0.3, "pantoute": 0.3})
    penalties: Mapping[str, float] = field(default_factory=lambda: {"email": 0.6, "week-end": 0.6, "voiture": 0.4})
    upper: float = 0.5
    short: float = 0.7
    duplicate: float = 0.8
    unmarked: float = 0.4
    accept: float = 1.4
    review: float = 0.8
    quarantine: float = 0.2
    reject: float = -0.2
    blocking: Mapping[str, str] = field(default_factory=dict)
    reviewing: Mapping[str, str] = field(default_factory=dict)
    quarantining: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.accept >= self.review >= self.quarantine >= self.reject:
            raise ValueError("thresholds must descend: accept, review, quarantine, reject")


def marker_scores(df: DataFrame, text: str = "text", markers: Sequence[str] = MARKERS, least: float = 0.0) -> DataFrame:
    """``marker_hits``, the distinct markers that stand in a text as words, and their number over its words."""
    df = df.withColumn("__low", F.lower(F.col(text)))  # a column of its own is computed once, not once a marker
    lowered = F.col("__low")
    hits = reduce(lambda a, b: a + b, [has_word(lowered, m).cast("int") for m in markers])
    ratio = F.col("marker_hits") / F.greatest(F.lit(1), word_count(text))
    scored = df.withColumn("marker_hits", hits).withColumn("__ratio", ratio).where(F.col("__ratio") >= least)
    return scored.withColumn("marker_score", F.round("__ratio", 4)).drop("__ratio", "__low")


def score_records(df: DataFrame, policy: CurationPolicy, order: Sequence[str], text: str = "text", trusted: Column | None = None, review: Column | None = None, holdout: Column | None = None) -> DataFrame:
    """``curation_score``, ``curation_reasons`` in a fixed order and ``curation_label`` of each record. A repeated text
    is a penalty from its second occurrence on, in the given order; markers count as substrings."""
    norm = F.col("__norm")
    flagged = duplicate_flags(df.withColumn("__norm", norm_key(text)), sha(norm), order, "__dup")
    parts: list[tuple[str, Column, float]] = [(f"marker:{m}", F.contains(norm, F.lit(m)), w) for m, w in policy.markers.items()]
    unmarked = ~reduce(lambda a, b: a | b, [F.contains(norm, F.lit(m)) for m in policy.markers])
    parts += [(f"penalty:{p}", F.contains(norm, F.lit(p)), -w) for p, w in policy.penalties.items()]
    parts += [("penalty:too_short", F.length(clean(text)) < 20, -policy.short), ("penalty:excessive_uppercase_ratio", upper_share(text) > 0.45, -policy.upper), ("penalty:low_marker_score", unmarked, -policy.unmarked)]
    if trusted is not None:
        parts.append(("source_trust", F.coalesce(trusted, F.lit(False)), 0.9))
    parts.append(("penalty:duplicate_text", F.col("__dup"), -policy.duplicate))
    rules = [(n, c) for n, c, _ in parts]
    for kind, patterns in (("blocking", policy.blocking), ("review", policy.reviewing), ("quarantine", policy.quarantining)):
        rules += [(f"{kind}:{n}", F.contains(norm, F.lit(p.lower()))) for n, p in patterns.items()]
    if holdout is not None:
        rules.append(("blocking:holdout_material", F.coalesce(holdout, F.lit(False))))
    if review is not None:
        rules.append(("review:permission_required_source", F.coalesce(review, F.lit(False))))
    score = reduce(lambda a, b: a + b, [F.when(c, F.lit(w)).otherwise(0.0) for _, c, w in parts], F.lit(policy.base))
    scored = flagged.withColumn("__score", score).withColumn("curation_reasons", reasons(rules))
    has = lambda kind: F.exists("curation_reasons", lambda r: r.startswith(kind + ":"))
    s = F.col("__score")
    label = cascade(
        [
            ("rejected", has("blocking") | (s < policy.reject)),
            ("quarantine", has("quarantine") | (s < policy.quarantine)),
            ("review_required", has("review") | (s < policy.review)),
            ("accepted", s >= policy.accept),
        ],
        "review_required",
    )
    return scored.withColumn("curation_label", label).withColumn("curation_score", F.round("__score", 6)).drop("__score", "__dup", "__norm")
