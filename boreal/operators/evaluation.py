"""Scores of responses, deltas between two systems, failures, and diagnostics of graded rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boreal.functions.measures import cosine, number, parse_embedding, strict_bool
from boreal.functions.text import has_any
from boreal.operators.rules import reasons


def term_score(response: Column, wanted: Column, unwanted: Column, bonus: Column | None = None) -> Column:
    """+1 for any wanted term, -1 for any unwanted one, as whole words; a null response has neither. ``bonus`` is a term
    whose presence is told but adds nothing."""
    text = F.coalesce(response, F.lit(""))
    good, bad = has_any(text, wanted), has_any(text, unwanted)
    hit = F.lit(False) if bonus is None else has_any(text, F.array(F.coalesce(bonus, F.lit(""))))
    return F.struct((good.cast("int") - bad.cast("int")).alias("score"), good.alias("preferred_hit"), bad.alias("forbidden_hit"), hit.alias("bonus_hit"))


def rescore(df: DataFrame, responses: Sequence[str], wanted: str, unwanted: str, bonus: Column | None = None) -> DataFrame:
    """Adds ``<response>_score`` structs for each response column."""
    return df.withColumns({f"{r}_score": term_score(F.col(r), F.col(wanted), F.col(unwanted), bonus) for r in responses})


def score_deltas(df: DataFrame, base: Column, adapter: Column, keys: Sequence[str]) -> DataFrame:
    """Sums over all rows and by each key, in one pass: ``<keys>, scope, n, base_score, adapter_score, delta``."""
    own = df.select(*[F.coalesce(F.col(k).cast("string"), F.lit("unknown")).alias(k) for k in keys], base.alias("__b"), adapter.alias("__a"))
    scope = F.coalesce(*[F.when(F.grouping(k) == 0, k) for k in keys], F.lit("all"))
    return own.groupingSets([*[[F.col(k)] for k in keys], []], *keys).agg(
        scope.alias("scope"),
        F.count(F.lit(1)).alias("n"),
        F.sum("__b").alias("base_score"),
        F.sum("__a").alias("adapter_score"),
        (F.sum("__a") - F.sum("__b")).alias("delta"),
    )


def failures(df: DataFrame, base: Column, adapter: Column, preferred: Column, forbidden: Column) -> DataFrame:
    """Rows whose adapter falls behind, names an unwanted term or misses the wanted one, with all reasons."""
    why = reasons([("adapter_under_base", adapter < base), ("contains_forbidden", forbidden), ("missing_preferred", ~preferred)])
    return df.withColumn("reasons", why).where(F.size("reasons") > 0)


def graded(df: DataFrame, correct: Column, code: Column, taxonomy: DataFrame, lp: str = "lp_id", similarity: Column | None = None, reference: Column | None = None, predicted: Column | None = None) -> DataFrame:
    """Adds ``ok, sim, code, severity, issue`` to graded rows.

    ``issue`` is malformed_row where the level is no number, correctness is no clear boolean or the similarity is
    outside [0, 1]; such a row counts in nothing else. Without a similarity, that of the two embeddings is taken. A
    wrong row without a code is missing_error_code, one whose code the taxonomy (``lp_id, error_code, severity``)
    lacks for its level is unknown_error_code; both block.
    """
    sim = F.lit(None).cast("double") if similarity is None else number(similarity)
    unread = F.lit(False) if similarity is None else similarity.isNotNull() & sim.isNull()
    if reference is not None and predicted is not None:
        sim = F.coalesce(sim, cosine(parse_embedding(reference), parse_embedding(predicted)))
    level = F.col(lp).cast("string").try_cast("int")
    known = taxonomy.select(F.col("lp_id").cast("int").alias("__lp"), F.col("error_code").alias("code"), "severity").dropDuplicates(["__lp", "code"])
    rows = df.withColumns({"__lp": level, "ok": strict_bool(correct), "sim": sim, "code": F.nullif(F.trim(code), F.lit(""))})
    rows = rows.withColumn("__bad", level.isNull() | F.col("ok").isNull() | unread | ~F.coalesce(F.col("sim").between(0, 1), F.lit(True)))
    rows = rows.join(F.broadcast(known), ["__lp", "code"], "left")  # a taxonomy is a list of error kinds
    wrong = ~F.col("ok")
    issue = F.when(F.col("__bad"), "malformed_row").when(wrong & F.col("code").isNull(), "missing_error_code").when(wrong & F.col("severity").isNull(), "unknown_error_code")
    return rows.withColumn("issue", issue).drop("__lp", "__bad")


def _sound() -> Column:
    return F.coalesce(F.col("issue") != "malformed_row", F.lit(True))


def diagnostics(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group of graded rows: sound and malformed rows, correct ones, accuracy, mean similarity, unknown codes, and
    errors that block or don't."""
    wrong = _sound() & ~F.col("ok")
    mild = wrong & F.col("issue").isNull() & (F.col("severity") != "blocking")
    right = F.count_if(_sound() & F.col("ok"))
    return rows.groupBy(*by).agg(
        F.count_if(_sound()).alias("n"),
        F.count_if(~_sound()).alias("malformed"),
        right.alias("correct"),
        F.try_divide(right, F.count_if(_sound())).alias("accuracy"),
        F.avg(F.when(_sound(), F.col("sim"))).alias("mean_similarity"),
        F.count_if(F.col("issue") == "unknown_error_code").alias("unknown_codes"),
        F.count_if(wrong & ~F.coalesce(mild, F.lit(False))).alias("blocking"),
        F.count_if(F.coalesce(mild, F.lit(False))).alias("non_blocking"),
    )


def error_codes(rows: DataFrame, by: Sequence[str], order: str, most: int) -> DataFrame:
    """The most frequent codes of each group's sound wrong rows (over all rows with no group); ties go to the code met
    first in ``order``."""
    wrong = rows.where(_sound() & ~F.col("ok") & F.col("code").isNotNull())
    counted = wrong.groupBy(*by, "code").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_seen"))
    # Codes are counted before they are ranked: a window holds a group's codes, not its rows.
    window = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return counted.withColumn("rank", F.row_number().over(window.orderBy(F.desc("n"), "first_seen", "code"))).where(F.col("rank") <= most)


def error_map(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """``<by>, errors``: each group's codes with their counts, as an array of (code, n) in order of codes."""
    wrong = rows.where(_sound() & ~F.col("ok") & F.col("code").isNotNull())
    counted = wrong.groupBy(*by, "code").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("code", "n"))).alias("errors"))


def diagnostics_verdict(rows: DataFrame, required: Sequence[int], lp: str = "lp_id") -> DataFrame:
    """One row: ``total, malformed, missing_codes, unknown_codes, blocking, missing_levels, ok``. It is ok without
    malformed rows, codes that are missing or unknown and blocking errors, and with every required level there."""
    wrong = _sound() & ~F.col("ok")
    mild = F.coalesce(wrong & F.col("issue").isNull() & (F.col("severity") != "blocking"), F.lit(False))
    level = F.when(_sound(), F.col(lp).cast("string").try_cast("int"))
    kind = lambda x: F.count_if(F.col("issue") == x)
    out = rows.agg(F.count(F.lit(1)).alias("total"), kind("malformed_row").alias("malformed"), kind("missing_error_code").alias("missing_codes"), kind("unknown_error_code").alias("unknown_codes"), F.count_if(wrong & ~mild).alias("blocking"), F.array_sort(F.array_except(F.array(*[F.lit(x) for x in required]), F.collect_set(level))).alias("missing_levels"))
    return out.withColumn("ok", (F.col("malformed") + F.col("missing_codes") + F.col("unknown_codes") + F.col("blocking") == 0) & (F.size("missing_levels") == 0))


#: What rows of the older layout call a phenomenon, by level. Fixed values.
PHENOMENA = {9: ("lexical_semantics", "lp9"), 20: ("orphaned_preposition", "lp20")}


def legacy_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, issues)`` of the older layout (``id, phenomenon, is_correct, embedding_ref, embedding_pred,
    error_label``): level and phenomenon by their aliases (an unknown one has no level and makes the row malformed),
    the label as error code of wrong rows only, and ``id, issue`` for embeddings of readable rows that are no numbers."""
    raw = F.coalesce(F.trim("phenomenon"), F.lit(""))
    low, lp, name = F.lower(raw), F.lit(None).cast("int"), F.coalesce(F.nullif(raw, F.lit("")), F.lit("unknown"))
    for level, (target, short) in PHENOMENA.items():
        hit = low.isin(short, f"{short}:{target}", target)
        lp, name = F.when(hit, level).otherwise(lp), F.when(hit, target).otherwise(name)
    ok = strict_bool(F.col("is_correct"))
    rows = df.withColumns({"lp_id": lp, "phenomenon": name, "error_code": F.when(~ok, F.nullif(F.trim("error_label"), F.lit("")))})
    broken = lambda c: F.when(ok.isNotNull() & (F.coalesce(F.col(c), F.lit("")) != "") & parse_embedding(F.col(c)).isNull(), F.lit("malformed_" + c))
    found = F.filter(F.array(broken("embedding_ref"), broken("embedding_pred")), lambda x: x.isNotNull())
    return rows, df.select("id", F.explode(found).alias("issue"))


def gates(metrics: DataFrame, limits: DataFrame) -> DataFrame:
    """``metric, value, passed``: each limit (``metric, kind`` max or min, ``bound``) against a table of
    ``metric, value``; a missing or unreadable value fails."""
    joined = limits.join(metrics, "metric", "left").withColumn("value", F.col("value").try_cast("double"))
    ok = F.when(F.col("kind") == "max", F.col("value") <= F.col("bound")).otherwise(F.col("value") >= F.col("bound"))
    return joined.select("metric", "value", F.coalesce(ok, F.lit(False)).alias("passed"))
