"""First-wins deduplication. An order is always given: rows of a DataFrame have none of their own."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boreal.session import written


def first_wins(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order. Aggregation, not a window: a key held by a third of all rows
    is reduced before the shuffle. Null keys count as one key."""
    names = [f"__k{i}" for i in range(len(keys))]
    keyed = df.select(F.struct(*[F.col(c) for c in order], F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")).alias("__r"), *[(F.col(k) if isinstance(k, str) else k).alias(n) for k, n in zip(keys, names, strict=True)])
    rank = F.struct(*[F.col(f"__r.{c}") for c in order])
    best = keyed.groupBy(*names).agg(F.min_by(F.col("__r.__row"), rank).alias("__row"))
    return best.select("__row.*")


def duplicate_flags(df: DataFrame, key: str | Column, order: Sequence[str], name: str = "is_duplicate") -> DataFrame:
    """Marks every row of a key but its first. The first is found by aggregation and joined back, so a hot key is
    never one task's window."""
    key = F.col(key) if isinstance(key, str) else key
    own = df.withColumn("__k", key)
    first = own.groupBy("__k").agg(F.min(F.struct(*order)).alias("__first"))
    joined = own.join(first, "__k", "left")
    return joined.withColumn(name, F.coalesce(F.struct(*order) != F.col("__first"), F.lit(False))).drop("__k", "__first")


def two_key_reasons(df: DataFrame, exact: str, normal: str, order: Sequence[str]) -> DataFrame:
    """``reason``: null for kept rows, else duplicate_exact or duplicate_normalized. A row is a duplicate if a kept
    row has its normal key; equal exact keys imply equal normal keys, as both are derived from the same text."""
    first = df.groupBy(normal).agg(F.min(F.struct(*order, F.col(exact).alias("__exact"))).alias("__first"))
    own = F.struct(*order)
    lead = F.struct(*[F.col(f"__first.{c}") for c in order])
    reason = F.when(own == lead, F.lit(None)).when(F.col(exact) == F.col("__first.__exact"), "duplicate_exact").otherwise("duplicate_normalized")
    return df.join(first, normal).withColumn("reason", reason).drop("__first")


def duplicate_counts(df: DataFrame, **keys: Column) -> DataFrame:
    """Rows less distinct keys, for each named key."""
    keyed = df.select(*[k.alias(n) for n, k in keys.items()])
    return keyed.agg(F.count(F.lit(1)).alias("records"), *[(F.count(F.lit(1)) - F.countDistinct(n)).alias(n) for n in keys])


def forgetful_dedup(df: DataFrame, key: str, order: Sequence[str], memory: int) -> DataFrame:
    """First-wins with a memory that empties after every ``memory`` kept rows, as a bounded stream reader has it:
    duplicates come back across epochs. Its result depends on every row before, so one task reads the ordered keys,
    holding at most ``memory`` of them; use first_wins wherever full deduplication will do."""

    def keep(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set = set()
        for pdf in it:
            mask = []
            for k in pdf[key]:
                new = k not in seen
                if new:
                    seen.add(k)
                mask.append(new)
                if len(seen) >= memory:
                    seen.clear()
            yield pdf[mask]

    return df.orderBy(*order).coalesce(1).mapInPandas(keep, df.schema)


def dedup_examples(candidates: DataFrame, record: str, rank: str, order: Sequence[str], exact: str, normal: str, most: int, rounds: int = 20, columns: Sequence[str] | None = None, alone: int = 100_000) -> DataFrame:
    """Examples in the given order, each unless an earlier kept one has its exact or normal hash, at most ``most``
    a record. An example beyond its record's limit claims no hash, so neither step can go first; instead, in
    rounds, what is sure is settled: the first open candidate of a hash owns it, for nothing before it can have it.
    One that follows ``most`` owners or kept ones in its record is out, whether it owns its hash or not; an owner
    that no more than ``most`` - 1 open or kept ones precede there is kept, and the others with its hash are out.
    Records can hang on each other in a chain as long as the table, so what is open after ``rounds`` rounds, or is no
    more than ``alone`` rows, is worked off in order by one task. ``columns`` are those of the result, where few and
    small ones will do: they are carried along and the candidates are computed once."""
    # Rounds move ids and hashes only; without ``columns`` the examples themselves are joined once, at the end.
    moved = list(dict.fromkeys([*order, record, rank, normal, *(columns or ())]))
    # Kept ones stay for a round after theirs, in which they keep their hash from the others.
    live = written(candidates.select(*moved).withColumn("__kept", F.lit(False)).withColumn("__before", F.lit(0)), "candidates")
    left, kept = live.count(), []
    before = Window.partitionBy(record).orderBy(rank).rowsBetween(Window.unboundedPreceding, -1)
    count = lambda c: (F.col("__before") + F.coalesce(F.sum(c.cast("int")).over(before), F.lit(0))).cast("int")
    while left:
        heads = live.groupBy(normal).agg(F.min(F.struct(*order)).alias("__first"), F.max("__kept").alias("__claimed"))
        open_ones = live.where(~F.col("__kept")).join(heads.where(~F.col("__claimed")), normal).withColumn("__own", F.struct(*order) == F.col("__first")).drop("__first", "__claimed", "__kept")
        if left <= alone or len(kept) >= rounds:
            kept.append(written(_worked_off(open_ones.drop("__own"), record, order, normal, most), "kept"))
            break
        counted = open_ones.withColumn("__owners", count(F.col("__own"))).withColumn("__all", count(F.lit(True))).where(F.col("__owners") < most)
        settled = counted.withColumn("__kept", F.col("__own") & (F.col("__all") < most)).withColumn("__before", count(F.col("__kept")))
        live = written(settled.select(*moved, "__kept", "__before"), "candidates")
        kept.append(live.where("__kept").drop("__kept", "__before"))
        left = live.where(~F.col("__kept")).count()
    if not kept:
        return candidates.select(*columns) if columns else candidates
    every = reduce(DataFrame.unionByName, kept)
    return every.select(*columns) if columns else candidates.join(every.select(*order), list(order), "left_semi")


def _worked_off(open_ones: DataFrame, record: str, order: Sequence[str], normal: str, most: int) -> DataFrame:
    """The candidates that are kept when they are taken one by one; ``__before`` are kept ones before in the record."""

    def keep(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        taken: Counter = Counter()
        for batch in it:
            mask = []
            for own, h, n in zip(*(batch.column(c).to_pylist() for c in (record, normal, "__before")), strict=True):
                mask.append(ok := h not in seen and n + taken[own] < most)
                if ok:
                    seen.add(h)
                    taken[own] += 1
            yield batch.filter(pa.array(mask, pa.bool_())).select(columns)

    columns = [c for c in open_ones.columns if c != "__before"]
    return open_ones.repartition(1).sortWithinPartitions(*order).mapInArrow(keep, open_ones.select(columns).schema)
