"""Minimal pairs: expansion of contrast templates, and the checks of finished pairs."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boreal.functions.text import letters_only, nfc, norm_key
from boreal.operators.dedup import duplicate_flags
from boreal.operators.rules import reasons


def pair_id(lp: Column, contrast: Column, good: Column, bad: Column) -> Column:
    digest = F.sha1(F.concat_ws("|", lp.cast("string"), contrast, good, bad))
    return F.concat(F.lit("lp"), lp.cast("string"), F.lit("-"), F.substring(digest, 1, 10))


def expand(contrasts: DataFrame) -> DataFrame:
    """``id, lp_id, contrast_id, good, bad`` from contrasts with parallel good_templates and bad_templates, whose slots
    are positive_pattern and negative_pattern."""
    rows = contrasts.select("*", F.inline(F.arrays_zip("good_templates", "bad_templates")).alias("__good", "__bad"))
    fill = lambda c: F.replace(F.replace(F.col(c), F.lit("{positive_pattern}"), F.col("positive_pattern")), F.lit("{negative_pattern}"), F.col("negative_pattern"))
    rows = rows.withColumn("good", fill("__good")).withColumn("bad", fill("__bad"))
    ident = pair_id(F.col("lp_id"), F.col("contrast_id"), F.col("good"), F.col("bad"))
    return rows.select(ident.alias("id"), "lp_id", "contrast_id", "good", "bad")


#: Word sequences no side of a pair may hold, and European words a Québec side may not keep. Fixed values.
FORBIDDEN = ("le fin de semaine", "un fin de semaine", "du fin de semaine", "de le")
NEUTRAL = ("week-end", "email")
#: Contrasts that turn on a preposition. Fixed values.
PREPOSITION_FOCUS = ("preposition_attachment", "required_preposition_retention", "stranded_preposition")
_LISTS = ("required_good", "required_bad", "forbidden_good", "forbidden_bad")


def _column(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def _lacks(side: Column, pattern: Column) -> Column:
    """Whether a side lacks a pattern; without a pattern nothing is lacking."""
    return (F.coalesce(pattern, F.lit("")) != "") & ~F.contains(side, pattern)


def issues(pairs: DataFrame, order: Sequence[str] = ("id",), least: int = 8, most: int = 220, banned: Sequence[str] = FORBIDDEN, neutral: Sequence[str] = NEUTRAL) -> DataFrame:
    """``id, issue, blocking`` for every check a pair (``id, good, bad``; where given ``lp_id``, ``positive_pattern``,
    ``negative_pattern``) fails by itself, or by repeating an earlier one. A null side is an empty one; lengths and
    form are remarks, all else blocks."""
    sides = {c: F.coalesce(F.col(c), F.lit("")) for c in ("good", "bad")}
    keyed = pairs.withColumns({"__g": norm_key(sides["good"]), "__b": norm_key(sides["bad"]), "__cg": nfc(sides["good"]), "__cb": nfc(sides["bad"]), "__pos": norm_key(_column(pairs, "positive_pattern")), "__neg": norm_key(_column(pairs, "negative_pattern"))})
    own = duplicate_flags(keyed, F.struct("__g", "__b"), order, "__dup")
    g, b, lp = F.col("__g"), F.col("__b"), _column(pairs, "lp_id")
    number = lp.cast("string").try_cast("int")
    has = lambda side, words: F.coalesce(side.rlike("|".join(re.escape(w) for w in words)), F.lit(False)) if words else F.lit(False)
    checks = [
        ("invalid_lp_id", lp.isNotNull() & number.isNull()),
        ("empty_side", (g == "") | (b == "")),
        ("non_nfc", (F.col("__cg") != sides["good"]) | (F.col("__cb") != sides["bad"])),
        ("identical_pair", g == b),
        ("punctuation_only_change", (letters_only(g) == letters_only(b)) & (g != b)),
        ("too_short", (F.length(g) < least) | (F.length(b) < least)),
        ("too_long", (F.length(g) > most) | (F.length(b) > most)),
        ("forbidden_ngram", has(g, banned) | has(b, banned)),
        ("neutralization_good", (number == 9) & has(g, neutral)),
        ("missing_positive_pattern", (number == 9) & _lacks(g, F.col("__pos"))),
        ("missing_negative_pattern", (number == 9) & _lacks(b, F.col("__neg"))),
        ("duplicate_pair", F.col("__dup")),
    ]
    found = own.select("id", F.explode(reasons(checks)).alias("issue"))
    return found.withColumn("blocking", ~F.col("issue").isin("non_nfc", "too_short", "too_long"))


def context_issues(pairs: DataFrame, contrasts: DataFrame, phenomenon: str | None = None) -> DataFrame:
    """``id, issue`` for pairs that do not follow from their contrast: an unknown contrast (then nothing else is
    checked), another level or phenomenon, sides the templates do not give, an id that is not theirs, attributes that
    differ (``register, term_type, positive_pattern, negative_pattern``, each where both tables have it), a side
    without its pattern or required substrings or with forbidden ones (``required_good`` and so on, arrays of the
    contrast), and for a ``focus`` on prepositions sides under 16 characters."""
    allowed = expand(contrasts).select(F.col("contrast_id").alias("__cid"), F.col("good").alias("g"), F.col("bad").alias("b"), F.lit(True).alias("__known")).distinct()
    shared = [c for c in ("register", "term_type", "positive_pattern", "negative_pattern") if c in contrasts.columns and c in pairs.columns]
    lists = [F.transform(_column(contrasts, c, "array<string>"), norm_key).alias(f"__{c}") for c in _LISTS]
    known = contrasts.select("contrast_id", F.lit(True).alias("__contrast"), F.col("lp_id").alias("__lp"), _column(contrasts, "focus").alias("__focus"), norm_key("positive_pattern").alias("__pos"), norm_key("negative_pattern").alias("__neg"), *[F.col(c).alias(f"__c_{c}") for c in shared], *lists)
    rows = pairs.join(known.dropDuplicates(["contrast_id"]), "contrast_id", "left")
    rows = rows.join(allowed, (F.col("contrast_id") == F.col("__cid")) & (F.col("good") == F.col("g")) & (F.col("bad") == F.col("b")), "left")
    rows = rows.withColumns({"__ng": norm_key("good"), "__nb": norm_key("bad")})
    there, g, b = F.col("__contrast").isNotNull(), F.col("__ng"), F.col("__nb")
    lacking = lambda side, c: F.coalesce(F.exists(F.col(f"__{c}"), lambda x: (x != "") & ~F.contains(side, x)), F.lit(False))
    holding = lambda side, c: F.coalesce(F.exists(F.col(f"__{c}"), lambda x: (x != "") & F.contains(side, x)), F.lit(False))
    focused = there & F.coalesce(F.col("__focus").isin(*PREPOSITION_FOCUS), F.lit(False))
    checks = [
        ("context_lp_id_mismatch", there & (F.col("lp_id") != F.col("__lp"))),
        *([("context_phenomenon_mismatch", ~F.col("phenomenon").eqNullSafe(F.lit(phenomenon)))] if phenomenon is not None else []),
        ("context_unknown_contrast", ~there),
        *[(f"context_{c}_mismatch", there & ~F.col(c).eqNullSafe(F.col(f"__c_{c}"))) for c in shared],
        ("context_unauthorized_pair", there & F.col("__known").isNull()),
        ("context_stable_id_mismatch", there & (F.col("id") != pair_id(F.col("__lp"), F.col("contrast_id"), F.col("good"), F.col("bad")))),
        ("context_missing_positive_pattern", there & _lacks(g, F.col("__pos"))),
        ("context_missing_negative_pattern", there & _lacks(b, F.col("__neg"))),
        ("context_missing_required_good_substring", there & lacking(g, "required_good")),
        ("context_missing_required_bad_substring", there & lacking(b, "required_bad")),
        ("context_forbidden_good_substring", there & holding(g, "forbidden_good")),
        ("context_forbidden_bad_substring", there & holding(b, "forbidden_bad")),
        ("lp20_too_short", focused & ((F.length(g) < 16) | (F.length(b) < 16))),
        ("lp20_missing_preposition_focus", focused & _lacks(g, F.col("__pos"))),
        ("lp20_missing_negative_focus", focused & _lacks(b, F.col("__neg"))),
    ]
    return rows.select("id", F.explode(reasons(checks)).alias("issue"))
