"""Train, dev and test splits."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boreal.functions.text import sha, unit_hash
from boreal.session import written

NAMES = ("train", "dev", "test")


def hash_split(key: Column | str, seed: int, train: float) -> Column:
    """train or dev by the key's hash alone."""
    return F.when(unit_hash(F.concat_ws(":", F.lit(str(seed)), key)) < train, "train").otherwise("dev")


def split_counts(total: int, ratios: Mapping[str, float], fill: bool = True) -> dict[str, int]:
    """Whole numbers for the splits: train and dev rounded down, test the rest; with ``fill`` none of dev and test is
    empty once there are three rows."""
    train, dev = int(total * ratios["train"]), int(total * ratios["dev"])
    test = total - train - dev
    if fill and total >= 3:
        dev, test = max(dev, 1), max(test, 1)
        train = max(total - dev - test, 1)
    return {"train": train, "dev": dev, "test": total - train - dev}


def curated_counts(total: int, ratios: Mapping[str, float], allow_empty: bool = True) -> tuple[dict[str, int], list[str]]:
    """``(counts, issues)`` of a curated split: train and dev rounded down, test the rest; an empty train takes a row from
    dev, else from test; empty dev or test of three rows and more is an issue unless it is allowed."""
    out = split_counts(total, ratios, fill=False)
    if total and not out["train"]:
        donor = "dev" if out["dev"] else "test"
        out = {**out, "train": 1, donor: out[donor] - 1}
    empty = total >= 3 and not (out["dev"] and out["test"])
    return out, ["empty_dev_or_test"] if empty and not allow_empty else []


def shuffled_split(df: DataFrame, key: str, seed: int, ratios: Mapping[str, float], fill: bool = False, counting: Callable[[int], Mapping[str, int]] | None = None) -> DataFrame:
    """Rows in the order of their seeded hash, cut at the splits' counts. A row's place in the global order is its
    place in its hash prefix's bucket plus the rows of the buckets before: 4096 counts are summed on the driver, and
    no window spans the table. ``counting`` replaces the rule that turns the number of rows into the splits' counts."""
    hashed = df.withColumn("__h", sha(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))))
    hashed = hashed.withColumn("__b", F.conv(F.substring("__h", 1, 3), 16, 10).cast("int"))
    sizes = {r["__b"]: r["count"] for r in hashed.groupBy("__b").count().collect()}
    before, start = 0, []
    for b in range(4096):
        start.append(before)
        before += sizes.get(b, 0)
    counts = counting(before) if counting else split_counts(before, ratios, fill)
    offset = F.element_at(F.array(*[F.lit(x) for x in start]), F.col("__b") + 1)
    place = offset + F.row_number().over(Window.partitionBy("__b").orderBy("__h", key))
    split = F.when(F.col("__n") <= counts["train"], "train").when(F.col("__n") <= counts["train"] + counts["dev"], "dev").otherwise("test")
    return hashed.withColumn("__n", place).withColumn("split", split).drop("__h", "__b", "__n")


def grouped_split(df: DataFrame, group: str, seed: int, ratios: Mapping[str, float]) -> DataFrame:
    """Whole groups into splits: groups stand in the order of their seeded hash, and a group goes to the split in
    whose share of all rows the middle of its own rows falls, so each split fills up to its target and is off by
    half a group at most. If dev or test stays empty though there are three rows, the smallest group of the fullest
    split (ties: the first in order) moves there, as long as that split keeps another.

    One rule at every size, without groups on the driver: a group's rows are counted, groups are put into 4,096
    buckets by hash, and the rows before a group are those of the buckets before (summed on the driver) plus those
    before it in its bucket. A null group is the group "unknown"; an empty table gives no rows."""
    own = df.withColumn("__g", F.coalesce(F.col(group).cast("string"), F.lit("unknown")))
    sized = own.groupBy("__g").agg(F.count(F.lit(1)).alias("__n")).withColumn("__h", sha(F.concat_ws(":", F.lit(str(seed)), "__g")))
    sized = sized.withColumn("__b", F.conv(F.substring("__h", 1, 3), 16, 10).cast("int"))
    sums = {r["__b"]: r["n"] for r in sized.groupBy("__b").agg(F.sum("__n").alias("n")).collect()}
    total, start = 0, []
    for b in range(4096):
        start.append(total)
        total += sums.get(b, 0)
    targets = split_counts(total, ratios)
    inside = Window.partitionBy("__b").orderBy("__h", "__g").rowsBetween(Window.unboundedPreceding, -1)
    before = F.element_at(F.array(*[F.lit(x) for x in start]), F.col("__b") + 1) + F.coalesce(F.sum("__n").over(inside), F.lit(0))
    middle = before + F.col("__n") / 2
    split = F.when(middle < targets["train"], "train").when(middle < targets["train"] + targets["dev"], "dev").otherwise("test")
    placed = written(sized.withColumn("split", split).select("__g", "__n", "__h", "split"), "groups")
    have = {r["split"]: (r["rows"], r["groups"], r["least"]) for r in placed.groupBy("split").agg(F.sum("__n").alias("rows"), F.count(F.lit(1)).alias("groups"), F.min(F.struct("__n", "__h", "__g")).alias("least")).collect()}
    for s in ("dev", "test"):
        donor = max((x for x in NAMES if x in have), key=lambda x: have[x][0], default=None)
        if total < 3 or s in have or have[donor][1] < 2:
            continue
        least = have[donor][2]
        placed = placed.withColumn("split", F.when(F.col("__g") == least["__g"], s).otherwise(F.col("split")))
        rest = placed.where(F.col("split") == donor).agg(F.sum("__n").alias("rows"), F.count(F.lit(1)).alias("groups"), F.min(F.struct("__n", "__h", "__g")).alias("least")).first()
        have |= {s: (least["__n"], 1, least), donor: (rest["rows"], rest["groups"], rest["least"])}
    return own.join(placed.select("__g", "split"), "__g").drop("__g")


def split_report(df: DataFrame, split: str = "split", extra: Sequence[Column] = ()) -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("rows"), *extra)
