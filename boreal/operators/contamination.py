"""Held-out text in training text: equal after normalization, or with nearly the same character trigrams."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boreal.functions.text import holdout_key, sha
from boreal.operators.seen import Seen, dealt_join
from boreal.session import discard, written


def _keyed(df: DataFrame, key: str, text: str, least: int = 3) -> DataFrame:
    return df.select(F.col(key).alias("id"), holdout_key(text).alias("norm")).where(F.length("norm") >= least)


def trigrams(text: str) -> np.ndarray:
    """Distinct character trigrams of a text (a shorter text is one): the number its three code points make, mixed by a
    one-to-one map so that any of its bits tell trigrams apart."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    if len(code) < 3:
        code = np.concatenate([code, np.zeros(3 - len(code), np.int64)])
    mixed = ((code[:-2] << 42) | (code[1:-1] << 21) | code[2:]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return np.unique((mixed ^ (mixed >> np.uint64(32))).view(np.int64))


def _size_class(n: int, threshold: float) -> int:
    return int(math.log(n) / -math.log(threshold) + 1e-9) if threshold < 1 else n


def _parts(grams: np.ndarray, size_class: int, threshold: float) -> np.ndarray:
    """A hash of each part of a set, the trigrams dealt to as many parts as the size class needs."""
    most = math.exp((size_class + 1) * -math.log(threshold)) if threshold < 1 else size_class
    count = int((1 - threshold) / (1 + threshold) * most * (1 + 1 / threshold) + 1e-6) + 1
    values = grams.view(np.uint64)
    part = ((values >> np.uint64(20)) % np.uint64(count)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    sums = np.concatenate([[np.uint64(0)], np.cumsum((values * np.uint64(0xFF51AFD7ED558CCD) ^ (values >> np.uint64(31)))[order], dtype=np.uint64)])
    ends = np.searchsorted(part[order], np.arange(count), side="right")
    total = sums[ends] - sums[np.concatenate([[0], ends[:-1]])]
    size = np.array([size_class + 1], np.uint64) * np.uint64(0x165667B19E3779F9)  # an array wraps around silently
    key = total * np.uint64(0x9E3779B97F4A7C15) + np.arange(count, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + size
    return (key ^ (key >> np.uint64(29))).view(np.int64)


def _sketch(grams: np.ndarray) -> np.ndarray:
    """Whether an odd number of a set's trigrams falls into each of 256 buckets, as four numbers. A trigram that only
    one of two sets has turns one bit, so sketches differ in no more bits than the sets do in trigrams."""
    odd = np.bincount((grams.view(np.uint64) >> np.uint64(48)).astype(np.int64) & 255, minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _overlap(threshold: float, a: str, b: str, norm_a: str, norm_b: str):
    """Pairs of texts with a trigram Jaccard of at least the threshold, for mapInPandas."""

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams: dict[bytes, np.ndarray] = {}  # texts come in many pairs, mostly near each other
        for pdf in it:
            raw = np.zeros(len(pdf))
            for i, (x, y, p, q) in enumerate(zip(pdf[a], pdf[b], pdf[norm_a], pdf[norm_b], strict=True)):
                if len(grams) > 2000:
                    grams.clear()
                for own, text in ((x, p), (y, q)):
                    if own not in grams:
                        grams[own] = trigrams(text)
                g, h = grams[x], grams[y]
                both = len(np.intersect1d(g, h, assume_unique=True))
                raw[i] = both / (len(g) + len(h) - both)
            yield pd.DataFrame({a: pdf[a], b: pdf[b], "raw": raw})[raw >= threshold]

    return batches


def exact_matches(train: DataFrame, holdout: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``train_id, holdout_id`` of texts that are equal under the holdout key."""
    a, b = _keyed(train, key, text), _keyed(holdout, key, text)
    hashed = lambda x, n: x.select(F.col("id").alias(n), F.sha2("norm", 256).alias("h"))
    return hashed(a, "train_id").join(hashed(b, "holdout_id"), "h").select("train_id", "holdout_id").distinct()


def similar_matches(train: DataFrame, holdout: DataFrame, key: str, text: str = "text", threshold: float = 0.92) -> DataFrame:
    """``train_id, holdout_id, score``: different texts with a trigram Jaccard of at least ``threshold`` (above 0).

    An exact join by parts: sets whose overlap is at least t differ in at most k = (1 - t) / (1 + t) of the trigrams
    of both. If the trigrams are dealt to k + 1 parts by hash, at least one part is the same in both sets, so a set
    is posted under each of its parts, and only sets that agree in a part are compared in full. k grows with a
    set's size, so sets are posted by size class, and held-out sets ask the classes a partner can be in. Parts hold
    about ten trigrams at 0.92; much below 0.7 they get too small to tell texts apart. Equal texts are one set on each side, so copies don't multiply the work.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    # Trigrams take several times the room of a text and don't compress, so texts are written and moved, and a text's
    # trigrams are made where they are used.
    sides = []
    for df, name in ((train, "train"), (holdout, "holdout")):
        keyed = written(_keyed(df, key, text).withColumn("set", F.unhex(F.substring(sha("norm"), 1, 32))), f"{name}-keyed")
        sets = written(keyed.groupBy("set").agg(F.first("norm").alias("norm")), f"{name}-sets")
        sides.append((written(keyed.select("id", "set"), f"{name}-rows"), sets))
        discard(keyed)
    (train_rows, train_sets), (hold_rows, hold_sets) = sides

    def posted(sets: DataFrame, x: str, around: tuple[int, ...], seen=None) -> DataFrame:
        def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in it:
                sets, sizes, parts, sketches = [], [], [], []
                for s, g in zip(pdf["set"], map(trigrams, pdf["norm"]), strict=True):
                    own = np.concatenate([_parts(g, c, threshold) for c in {max(_size_class(len(g), threshold) + i, 0) for i in around}])
                    if seen is not None:
                        own = own[seen.value.has(own)]
                    sets += [s] * len(own)
                    sizes.append(np.full(len(own), len(g), np.int32))
                    parts.append(own)
                    sketches.append(np.tile(_sketch(g), (len(own), 1)))
                if parts:
                    odd = np.concatenate(sketches)
                    yield pd.DataFrame({f"set_{x}": pd.Series(sets, dtype="object"), f"n_{x}": np.concatenate(sizes), "part": np.concatenate(parts), **{f"odd{i}_{x}": odd[:, i] for i in range(4)}})

        return sets.mapInPandas(batches, f"set_{x} binary, n_{x} int, part bigint, " + ", ".join(f"odd{i}_{x} bigint" for i in range(4)))

    # The far larger training side posts only parts the held-out side may have.
    asked = written(posted(hold_sets, "b", (-1, 0, 1)), "holdout-parts")
    seen = Seen.of(asked, "part", asked.count())
    offered = posted(train_sets, "a", (0,), seen and train.sparkSession.sparkContext.broadcast(seen))
    near = F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * (threshold - 1e-9)
    # Pairs that meet grow faster than the tables, as common trigrams make equal parts; in the join itself, before
    # anything moves, the sketches leave those out that differ in more trigrams than the threshold allows.
    apart = reduce(add, [F.bit_count(F.col(f"odd{i}_a").bitwiseXOR(F.col(f"odd{i}_b"))) for i in range(4)])
    near &= apart <= (F.col("n_a") + F.col("n_b")) * ((1 - threshold) / (1 + threshold)) + 1e-6
    met = dealt_join(written(offered, "train-parts"), asked, "part")
    pairs = met.where(near & (F.col("set_a") != F.col("set_b"))).select("set_a", "set_b").distinct()
    full = pairs.join(train_sets.select(F.col("set").alias("set_a"), F.col("norm").alias("norm_a")), "set_a").join(hold_sets.select(F.col("set").alias("set_b"), F.col("norm").alias("norm_b")), "set_b")
    scored = full.mapInPandas(_overlap(threshold, "set_a", "set_b", "norm_a", "norm_b"), "set_a binary, set_b binary, raw double")
    a = train_rows.select(F.col("id").alias("train_id"), F.col("set").alias("set_a"))
    b = hold_rows.select(F.col("id").alias("holdout_id"), F.col("set").alias("set_b"))
    return scored.join(a, "set_a").join(b, "set_b").select("train_id", "holdout_id", F.round("raw", 6).alias("score")).distinct()
