"""Share caps, probabilistic keeping and limits per source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boreal.functions.text import sha, unit_hash


def drops_per_class(classes: Mapping[tuple[int, float], int]) -> dict[tuple[int, float], int]:
    """How many rows each key loses when, while any key with several rows is above its cap of the current total,
    every such key loses one. Keys with the same number of rows and the same cap fare alike, so it runs on
    ``(rows, cap) -> keys``, of which there are far fewer than keys."""
    left = {c: c[0] for c in classes if c[0] > 0}
    total = sum(n * classes[c] for c, n in left.items())
    while total:
        over = [c for c, n in left.items() if n > 1 and n / total > c[1] + 1e-9]
        if not over:
            break
        # All keys above their caps lose one row a round. As long as the same keys stay above and no other joins
        # them, rounds are alike; ``rounds`` of them are taken at once, checked by the same test at their end.
        rounds, width = max(1, min(left[c] for c in over) // 2), sum(classes[c] for c in over)
        inside = set(over)
        while rounds > 1:
            later = total - (rounds - 1) * width
            same = all((left[c] - rounds + 1) > 1 and (left[c] - rounds + 1) / later > c[1] + 1e-9 for c in over)
            if same and not any(n > 1 and n / later > c[1] + 1e-9 for c, n in left.items() if c not in inside):
                break
            rounds //= 2
        for c in over:
            left[c] -= rounds
        total -= rounds * width
    return {c: c[0] - left.get(c, 0) for c in classes if c[0] > left.get(c, 0)}


def drop_score(seed: int, *keys: Column | str) -> Column:
    return sha(F.concat_ws(":", F.lit(str(seed)), *keys))


def share_cap(df: DataFrame, key: str, cap: float | Mapping[str, float], rank: Sequence[str]) -> DataFrame:
    """Rows under a cap on each key's share; a key's rows with the greatest rank go first. ``rank`` begins with a
    column of hexadecimal hashes. With a mapping each key has its own cap, and keys without one are free; a null key
    is the key "unknown".

    Only a histogram reaches the driver, how many keys have how many rows under which cap: different row counts are
    at most about the square root of twice the rows, however many keys there are. A key's rows are told apart by the
    first three digits of their hash: whole buckets above the cut go, whole buckets below it stay, and only the
    bucket the cut falls into is ordered, so a key that holds a third of all rows is never sorted in one task.
    """
    own = df.withColumn("__key", F.coalesce(F.col(key).cast("string"), F.lit("unknown")))
    counted = own.groupBy("__key").agg(F.count(F.lit(1)).alias("__rows"))
    if isinstance(cap, Mapping):
        known = df.sparkSession.createDataFrame([(k, float(v)) for k, v in cap.items()], "__key string, __cap double")
        counted = counted.join(F.broadcast(known), "__key", "left").withColumn("__cap", F.coalesce("__cap", F.lit(1.0)))
    else:
        counted = counted.withColumn("__cap", F.lit(float(cap)))
    classes = {(r["__rows"], r["__cap"]): r["n"] for r in counted.groupBy("__rows", "__cap").agg(F.count(F.lit(1)).alias("n")).collect()}
    drops = drops_per_class(classes)
    if not drops:
        return df
    table = df.sparkSession.createDataFrame([(n, c, d) for (n, c), d in drops.items()], "__rows bigint, __cap double, __drops bigint")
    losing = counted.join(table, ["__rows", "__cap"]).select("__key", "__drops")
    own = own.withColumn("__bucket", F.substring(rank[0], 1, 3))
    sizes = own.groupBy("__key", "__bucket").count().join(losing, "__key")
    above = Window.partitionBy("__key").orderBy(F.desc("__bucket")).rowsBetween(Window.unboundedPreceding, -1)
    cuts = sizes.withColumn("__above", F.coalesce(F.sum("count").over(above), F.lit(0)))
    cuts = cuts.select("__key", "__bucket", (F.col("__drops") - F.col("__above")).alias("__left"), "count")
    placed = own.join(cuts, ["__key", "__bucket"], "left")  # keys without drops have no bucket here
    whole = placed.where("__left is null or __left <= 0")
    split = placed.where("__left > 0 and __left < count")
    split = split.withColumn("__n", F.row_number().over(Window.partitionBy("__key", "__bucket").orderBy(*[F.desc(r) for r in rank]))).where("__n > __left")
    return whole.select(*df.columns).union(split.select(*df.columns))


def probable(key: Column | str, probability: float) -> Column:
    """Whether a row is kept with a probability, decided by its key's hash."""
    if probability >= 1:
        return F.lit(True)
    return unit_hash(key) <= probability if probability > 0 else F.lit(False)


def first_per_key(df: DataFrame, key: str, order: Sequence[str], most: int) -> DataFrame:
    """At most ``most`` rows of each key, the first in order."""
    ranked = df.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("__n") <= most).drop("__n")


def limit_per_source(df: DataFrame, source: str, order: Sequence[str], most: int | None = None, own: Column | None = None) -> DataFrame:
    """The first rows of each source in order, at most the least of how many there are, ``most`` and the source's
    ``own`` limit (null for none)."""
    limit = F.least(F.lit(most).cast("int"), own.cast("int")) if own is not None else F.lit(most).cast("int")
    ranked = df.withColumn("__limit", limit).withColumn("__n", F.row_number().over(Window.partitionBy(source).orderBy(*order)))
    if most is not None:
        ranked = ranked.where(F.col("__n") <= most)  # a fixed bound is applied before the exchange already
    return ranked.where(F.col("__limit").isNull() | (F.col("__n") <= F.col("__limit"))).drop("__n", "__limit")


def top_codes(df: DataFrame, by: Sequence[str], code: str, order: str, most: int) -> DataFrame:
    """The most frequent codes of each group; ties go to the code met first."""
    counted = df.groupBy(*by, code).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_seen"))
    ranked = counted.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "first_seen", code)))
    return ranked.where(F.col("rank") <= most)
