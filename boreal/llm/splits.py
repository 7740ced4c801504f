"""Splits that keep related records together, and the ties between sources that force them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boreal.llm.components import hash_to_min
from boreal.session import written

#: name:digits:12 hexadecimal digits
RECORD_FORM = r"^[^:]*[^:\s][^:]*:[0-9]+:[0-9a-f]{12}$"
_BLANKS = r"^[\s\p{Z}]+|[\s\p{Z}]+$"


def plain(name: str | Column) -> Column:
    """An id without surrounding blanks and case; null if nothing is left."""
    column = F.col(name) if isinstance(name, str) else name
    out = F.lower(F.regexp_replace(column, _BLANKS, ""))
    return F.when(out != "", out)


def record_key(name: str | Column) -> Column:
    """The plain record id where it has the form of one, else null: placeholders tie nothing."""
    out = plain(name)
    return F.when(out.rlike(RECORD_FORM), out)


def source_components(rows: DataFrame, source: str = "source", record: str = "record") -> DataFrame:
    """``node, component`` for every source that shares a record with another, over ``source, record`` rows.

    A record with k sources gives k - 1 edges (each to its least source), so a record held by a third of all
    rows makes no clique. Null sources or records tie nothing.
    """
    ties = rows.select(F.col(source).alias("source"), F.col(record).alias("record")).where("source is not null and record is not null").distinct()
    shared = ties.groupBy("record").agg(F.min("source").alias("least"), F.max("source").alias("most")).where("least < most")
    edges = ties.join(shared, "record").where("source <> least").select(F.col("source").alias("a"), F.col("least").alias("b")).distinct()
    return hash_to_min(edges)


def tied_sources(tables: list[DataFrame], source: str = "source_id", record: str = "source_record_id") -> DataFrame:
    """Pairs of different sources that must share a split: ``source_id_a < source_id_b``, trimmed and in lower
    case. Every pair in a chain of ties comes out, which is what the question asks for; there is no other
    expansion. Null and blank ids and ids that identify no record tie nothing; empty tables give no pair;
    other columns are ignored."""
    rows = reduce(DataFrame.unionByName, [t.select(plain(source).alias("source"), record_key(record).alias("record")) for t in tables])
    nodes = source_components(rows)
    other = nodes.select(F.col("node").alias("source_id_b"), "component")
    return nodes.withColumnRenamed("node", "source_id_a").join(other, "component").where("source_id_a < source_id_b").select("source_id_a", "source_id_b")


def _draw(seed: int, *parts: Column | str) -> Column:
    """A number in (0, 1) from a hash, the same on any partitioning."""
    digits = F.substring(F.sha2(F.concat_ws("|", F.lit(str(seed)), *parts), 256), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def grouped_splits(
    tables: list[DataFrame],
    shares: dict[str, float] | None = None,
    example: str = "example_id",
    source: str = "source_id",
    record: str = "source_record_id",
    seed: int = 42,
) -> DataFrame:
    """``example_id, component, split``: each example's split, so that no source and no record is in two.

    Components of sources come from hash-to-min; weighted rendezvous hashing gives each component the split
    with the least ``-ln(u) / weight``. A component larger than a split's whole quota can't go there, so such
    components go to the split with the largest share, and the weights of the others are raised to fill the
    small splits from what is left. Adding rows to a component that keeps its name never moves it by chance.

    An example without a source is its record's, or else its own, component. Repeated rows count once per
    example_id; an example_id under several components (the same id exported for two sources) takes the least
    split key's component. Null example ids are dropped. Empty tables give no rows.
    """
    shares = shares or {"train": 0.90, "dev": 0.05, "test": 0.05}
    if abs(sum(shares.values()) - 1) > 1e-9 or min(shares.values()) <= 0:
        raise ValueError("shares must be positive and sum to 1")
    largest = max(shares, key=lambda k: shares[k])
    rows = reduce(
        DataFrame.unionByName,
        [t.select(F.col(example).alias("example_id"), plain(source).alias("source"), record_key(record).alias("record")) for t in tables],
    ).where("example_id is not null")
    node = F.coalesce("source", F.concat(F.lit("record "), "record"), F.concat(F.lit("example "), "example_id"))
    rows = rows.withColumn("node", node)
    # One id under two sources ties them like a shared record.
    ties = rows.select("node", "record").union(rows.select("node", F.concat(F.lit("example "), "example_id")))
    components = source_components(ties, "node", "record")
    placed = rows.groupBy("example_id").agg(F.min("node").alias("node")).join(components, "node", "left")
    placed = written(placed.select("example_id", F.coalesce("component", "node").alias("component")), "placed")
    sizes = written(placed.groupBy("component").agg(F.count(F.lit(1)).alias("n")), "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    fits = {k: F.col("n") <= F.lit(s * total) for k, s in shares.items()}
    mass = sizes.agg(*[F.sum(F.when(fits[k], F.col("n"))).alias(k) for k in shares]).first()
    weight = {k: min(1.0, s * total / mass[k]) if mass[k] else 0.0 for k, s in shares.items() if k != largest}
    # Each small split draws its quota from the components that fit it; the largest share takes the rest.
    rest = 1 - F.lit(0.0) - reduce(lambda a, b: a + b, [F.when(fits[k], F.lit(w)).otherwise(0.0) for k, w in weight.items()], F.lit(0.0))
    full = {**{k: F.when(fits[k], F.lit(w)).otherwise(0.0) for k, w in weight.items()}, largest: F.greatest(rest, F.lit(0.0))}
    scores = [F.struct(F.when(w > 0, -F.log(_draw(seed, "component", F.lit(k))) / w).otherwise(F.lit(float("inf"))).alias("score"), F.lit(k).alias("split")) for k, w in full.items()]
    chosen = sizes.select("component", F.least(*scores)["split"].alias("split")) if len(scores) > 1 else sizes.select("component", F.lit(largest).alias("split"))
    return placed.join(chosen, "component").select("example_id", "component", "split")
