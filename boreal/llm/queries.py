"""Queries of the training-data operators; each runs its operator with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from boreal.llm import boilerplate, contamination, language, leakage, neardup, packing, pairs, splits, tokens
from boreal.session import table

EXAMPLES = ("train", "dev", "test")


def _examples(spark: SparkSession, d: str) -> list[DataFrame]:
    return [table(spark, d, t) for t in EXAMPLES]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.furniture_lines(table(spark, d, "assnat_fixture_harvest"))


def p1_main(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.main_content(table(spark, d, "assnat_fixture_harvest"))


def p2_token_cube(spark: SparkSession, d: str) -> DataFrame:
    return tokens.token_cube(tokens.example_tokens(_examples(spark, d)))


def p2_example_tokens(spark: SparkSession, d: str) -> DataFrame:
    return tokens.example_tokens(_examples(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.tied_sources(_examples(spark, d))


def p3_splits(spark: SparkSession, d: str) -> DataFrame:
    return splits.grouped_splits(_examples(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_duplicate_pairs(table(spark, d, "donnees_quebec_fixture_harvest"))


def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_duplicate_groups(table(spark, d, "donnees_quebec_fixture_harvest"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    train, *held = _examples(spark, d)
    return leakage.leaked_pairs(train, held)


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    train, dev, test = _examples(spark, d)
    return leakage.leak_report(train, {"dev": dev, "test": test})


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return pairs.broken_pairs(table(spark, d, "base_vs_adapter_generations"), table(spark, d, "eval_prompts"))


def p6_counts(spark: SparkSession, d: str) -> DataFrame:
    return pairs.defect_counts(p6_found(spark, d))


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed(table(spark, d, "documents"))


def p7_whole(spark: SparkSession, d: str) -> DataFrame:
    return packing.whole_items(packing.packed(table(spark, d, "documents")))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(packing.packed(table(spark, d, "documents")))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return contamination.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    return contamination.leaked_items(table(spark, d, "documents"), table(spark, d, "benchmark"))


def p8_kept(spark: SparkSession, d: str) -> DataFrame:
    return contamination.without_leaks(table(spark, d, "documents"), table(spark, d, "benchmark")).select("doc_id", "source")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return language.wrong_labels(table(spark, d, "documents"))


def p9_labels(spark: SparkSession, d: str) -> DataFrame:
    return language.document_languages(table(spark, d, "documents"))


def p9_segments(spark: SparkSession, d: str) -> DataFrame:
    return language.language_segments(table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k[:1] == "p" and k[1:2].isdigit()}


def oracle_sql() -> dict[str, str]:
    from boreal.llm import sql

    return {k: v for k, v in sql.ORACLES.items() if k in queries()}
