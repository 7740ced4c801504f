"""All core queries by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from boreal.plans import corpus, examples, packs, streams


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**corpus.Q, **examples.Q, **packs.Q, **streams.Q}


def oracle_sql() -> dict[str, str]:
    return {**corpus.SQL, **examples.SQL, **packs.SQL, **streams.SQL}
