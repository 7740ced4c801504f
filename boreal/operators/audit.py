"""Counts, shares, token estimates and readiness of a corpus in few passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boreal.functions.text import norm_key, sha, word_count
from boreal.operators.rules import cascade, reasons

#: Tokens at which a corpus is large enough for each stage. Fixed values.
LEVELS = (("production", 150_000_000), ("pilot", 20_000_000), ("smoke_test", 500_000))


def count_by(df: DataFrame, keys: Sequence[str], missing: str = "unknown", keep: Sequence[str] = ()) -> DataFrame:
    """``key, value, n`` for several keys in one pass, within the columns to ``keep``; a missing value counts under
    ``missing``."""
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), F.coalesce(F.col(k).cast("string"), F.lit(missing)).alias("value")) for k in keys])
    return df.select(*keep, F.inline(pairs)).groupBy(*keep, "key", "value").agg(F.count(F.lit(1)).alias("n"))


def count_items(df: DataFrame, items: str, name: str = "item") -> DataFrame:
    """How often each item stands in an array column."""
    return df.select(F.explode(items).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def max_share(counts: DataFrame) -> DataFrame:
    """``key, max_share``: the largest value's share of each key of count_by."""
    return counts.groupBy("key").agg((F.max("n") / F.sum("n")).alias("max_share"))


def row_tokens(text: str = "text") -> Column:
    return F.greatest(F.length(text) / 4.0, word_count(text) * 1.35).cast("bigint")


def corpus_tokens(text: str = "text") -> Column:
    """The estimate over a group as a whole; it is not the sum of its rows' estimates."""
    return F.greatest(F.sum(F.length(text)) / 4.0, F.sum(word_count(text)) * 1.35).cast("bigint")


def level(tokens: Column) -> Column:
    return cascade([(name, tokens >= least) for name, least in LEVELS], "insufficient")


def readiness(df: DataFrame, by: Sequence[str] = (), text: str = "text") -> DataFrame:
    """Records, tokens, exact and normalized duplicates, and the level these tokens reach."""
    keyed = df.withColumn("__exact", sha(text)).withColumn("__norm", sha(norm_key(text)))
    out = keyed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(row_tokens(text)).alias("row_tokens"),
        corpus_tokens(text).alias("corpus_tokens"),
        (F.count("__exact") - F.countDistinct("__exact")).alias("duplicate_exact"),
        (F.count("__norm") - F.countDistinct("__norm")).alias("duplicate_normalized"),
    )
    return out.withColumn("level", level(F.coalesce("corpus_tokens", F.lit(0))))


#: Domains of institutions, and source types of today's sources. Fixed values.
INSTITUTIONAL = ("public_administration", "public_data", "administrative", "politics", "law", "education")
MODERN = ("ckan_api", "official_html", "local_permissioned_dump", "permission_required")


def corpus_audit(df: DataFrame, production_turns: int = 200_000, instruction: Column | None = None) -> DataFrame:
    """One row about a corpus of records: what it holds, the level its tokens reach, what blocks it and what to do about
    it. ``instruction`` tells rows that are instructions. Null texts count as empty, null booleans as false."""
    keys = ("source_id", "domain", "register")
    counts = count_by(df, keys).groupBy("key").agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("kinds"))
    of = lambda k, c: F.coalesce(F.max(F.when(F.col("key") == k, F.col(c))), F.lit(0))
    shape = counts.agg(of("source_id", "most").alias("__most"), of("domain", "kinds").alias("domains"), of("register", "kinds").alias("registers"))
    own = df.select(F.coalesce("text", F.lit("")).alias("text"), "domain", "source_type", "license_status", "commercial_use", F.coalesce("holdout_only", F.lit(False)).alias("holdout"), (F.lit(False) if instruction is None else F.coalesce(instruction, F.lit(False))).alias("told"))
    base = own.withColumns({"__exact": sha("text"), "__norm": sha(norm_key("text"))}).agg(
        F.count(F.lit(1)).alias("records"), F.coalesce(corpus_tokens(), F.lit(0)).alias("tokens"),
        (F.count("__exact") - F.countDistinct("__exact")).alias("duplicate_exact"), (F.count("__norm") - F.countDistinct("__norm")).alias("duplicate_normalized"),
        F.count_if("told").alias("instructions"), F.count_if("holdout").alias("holdout_risk"), F.count_if(F.col("license_status").isin("open_compatible", "noncommercial_only")).alias("legal"),
        F.count_if(F.col("commercial_use") == "allowed").alias("commercial"), F.count_if(F.col("license_status") == "noncommercial_only").alias("noncommercial"),
        F.count_if(F.lower("domain").isin(*INSTITUTIONAL)).alias("institutional"), F.count_if(F.lower("source_type").isin(*MODERN)).alias("modern"), F.count_if(F.col("domain") == "literary").alias("literary"),
    )
    row = base.crossJoin(shape)  # one row each
    share = lambda c: F.coalesce(F.try_divide(F.col(c), F.col("records")), F.lit(0.0))
    row = row.withColumns({"max_source_share": share("__most"), "level": level(F.col("tokens"))})
    production = F.col("level") == "production"
    blockers = reasons(
        [
            ("no_records", F.col("records") == 0),
            ("holdout_contamination_risk", F.col("holdout_risk") > 0),
            ("insufficient_instruction_turns", production & (F.col("instructions") < production_turns)),
            ("single_source_dominance", production & (F.col("max_source_share") > 0.35)),
            ("low_domain_diversity", production & (F.col("domains") < 5)),
            ("low_register_diversity", production & (F.col("registers") < 4)),
        ]
    )
    some = F.col("records") > 0
    advice = reasons(
        [
            ("more_modern_sources", F.lit(True)),
            ("less_literary", share("literary") >= 0.5),
            ("less_administrative", share("institutional") >= 0.6),
            ("secure_commercial_sources", some & (share("noncommercial") >= 0.4)),
            ("more_instructions", some & (share("instructions") < 0.1)),
        ]
    )
    row = row.withColumns({"blockers": blockers, "recommendations": advice})
    return row.withColumn("level", F.when(production & (F.size("blockers") > 0), "production_blocked").otherwise(F.col("level"))).drop("__most")


def rollup(df: DataFrame, by: str, skipped: str, summaries: Mapping[str, str]) -> DataFrame:
    """``<by>, seen, selected, skipped`` and a summary of each named column as text, ``value=n`` in order of values; a
    missing value counts as "unknown". Values are counted before they are put together."""
    out = df.groupBy(by).agg(F.count(F.lit(1)).alias("seen"), F.count_if(~F.col(skipped)).alias("selected"), F.count_if(F.col(skipped)).alias("skipped"))
    counts = count_by(df.select(by, *summaries.values()), list(summaries.values()), keep=[by])
    for name, column in summaries.items():
        told = counts.where(F.col("key") == column).groupBy(by).agg(F.array_sort(F.collect_list(F.struct("value", "n"))).alias("x"))
        text = F.array_join(F.transform("x", lambda s: F.concat(s["value"], F.lit("="), s["n"].cast("string"))), " ")
        out = out.join(told.select(by, text.alias(name)), by, "left")
    return out


def coverage(df: DataFrame, by: str, value: str) -> DataFrame:
    """Each key's sorted set of values."""
    return df.groupBy(by).agg(F.array_sort(F.collect_set(value)).alias("covered"))


def content_hash(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``rows, content_sha256`` of a table whatever its order: the rows' hashes are summed in eight parts (a sum is
    the same in any order and needs no gathering), and the sums hashed."""
    digest = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]), 256)
    parts = [F.sum(F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint")).cast("string") for i in range(8)]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.sha2(F.concat_ws(":", *parts), 256).alias("content_sha256"))
