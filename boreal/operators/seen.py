"""Joins between a large and a smaller side: keys the smaller one lacks are left out before the exchange, and crowded
keys are dealt to several tasks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boreal.session import written


class Seen:
    """A bitmap of keys that occur, one bit for each hash slot: it may take a key for one that occurs, never the reverse."""

    MOST, SEGMENT = 1 << 29, 1 << 20  # bits: 64 MB at most, gathered in pieces of 128 kB

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 8 - 1)

    @staticmethod
    def size(keys: int) -> int:
        """Bits for so many keys: a power of two, 16 a key as long as the bound allows."""
        return min(Seen.MOST, 1 << max(Seen.SEGMENT.bit_length() - 1, (16 * keys).bit_length()))

    @staticmethod
    def of(keys: DataFrame, key: str, count: int) -> Seen | None:
        """Of a bigint column of at most ``count`` distinct keys. Slots are made distinct before they are gathered, so
        no piece has more rows than bits. None where the bound would leave most bits set: nothing could be left out."""
        size, segment = Seen.size(count), Seen.SEGMENT
        if count > size:
            return None
        slots = keys.select(F.col(key).bitwiseAND(F.lit(size - 1)).alias("slot")).distinct()

        def piece(pdf: pd.DataFrame) -> pd.DataFrame:
            bits = np.zeros(segment, np.uint8)
            bits[pdf["slot"].to_numpy() % segment] = 1
            return pd.DataFrame({"piece": [int(pdf["slot"].iat[0]) // segment], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

        found = slots.groupBy(F.shiftright("slot", segment.bit_length() - 1)).applyInPandas(piece, "piece int, bits binary").collect()
        out = np.zeros(size // 8, np.uint8)
        for r in found:
            out[r["piece"] * (segment // 8) : (r["piece"] + 1) * (segment // 8)] = np.frombuffer(r["bits"], np.uint8)
        return Seen(out)

    def has(self, keys: np.ndarray) -> np.ndarray:
        slot = keys.view(np.uint64) & self.mask
        return (self.bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def dealt_join(left: DataFrame, right: DataFrame, key: str = "shard", block: int = 2048) -> DataFrame:
    """An inner join whose crowded keys are cut: the left rows of a key with more than ``block`` are dealt to parts of
    that size by hash, and the key's right rows go to every part."""
    crowd = written(left.groupBy(key).count().where(F.col("count") > block).select(key, F.ceil(F.col("count") / block).cast("int").alias("__parts")), "crowd")
    # One plan at every size: a merge join, whose skewed partitions the adaptive planner splits as well.
    if crowd.isEmpty():
        return left.join(right.hint("merge"), key)
    # Names of its own: a key called like a helper column would be overwritten, and all rows would meet.
    deal = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.coalesce("__parts", F.lit(1))).cast("int")
    dealt = left.join(crowd, key, "left").withColumn("__deal", deal).drop("__parts")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))
    spread = right.join(crowd, key, "left").withColumn("__deal", every).drop("__parts")
    return dealt.join(spread.hint("merge"), [key, "__deal"]).drop("__deal")
