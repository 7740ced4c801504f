"""Word-set signatures, the exact check of candidate pairs, and the way back from sets to rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boreal.llm import lexis

SET_SCHEMA = "key {kind}, set_key binary, sid bigint, n int, words array<bigint>"


def word_sets(rows: DataFrame, key: str | Column, text: str | Column, extract: Callable[[str], str] | None = None) -> DataFrame:
    """``key, set_key, sid, n, words``: the distinct words of each text as sorted hashes. Rows without a key or
    without a word are left out (nothing overlaps with nothing). ``extract`` takes the part of the text that
    counts. Texts are used whole."""
    key, text = (F.col(x) if isinstance(x, str) else x for x in (key, text))
    rows = rows.select(key.alias("key"), text.alias("text")).where("key is not null and text is not null")

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            sets = [lexis.word_set(extract(t) if extract else t) for t in pdf["text"]]
            keep = [i for i, s in enumerate(sets) if len(s)]
            keys = [lexis.set_key(sets[i]) for i in keep]
            yield pd.DataFrame(
                {
                    "key": pdf["key"].to_numpy()[keep],
                    "set_key": keys,
                    "sid": [int.from_bytes(k[:8], "big", signed=True) for k in keys],
                    "n": np.array([len(sets[i]) for i in keep], np.int32),
                    "words": [sets[i] for i in keep],
                }
            )

    return rows.mapInPandas(batches, SET_SCHEMA.format(kind=rows.schema["key"].dataType.simpleString()))


def distinct_sets(sets: DataFrame) -> DataFrame:
    """One row for each distinct set: copies of a text, however many, are one set from here on."""
    return sets.groupBy("set_key").agg(F.first("sid").alias("sid"), F.first("n").alias("n"), F.first("words").alias("words"))


def with_sketch(sets: DataFrame) -> DataFrame:
    """Adds ``s1, s2``: one bit of each of 128 MinHash values. Two sets with overlap J differ in about 64 (1 - J). A
    value is mixed with its function's own multiplier first, so that a word which is the least under several
    functions gives each its own bit."""

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        odd = np.random.default_rng(29).integers(0, 1 << 31, 128, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        for pdf in it:
            if not len(pdf):
                continue
            values = lexis.minhash(list(pdf["words"]), 128, seed=11)
            values = (values ^ (values >> np.uint32(15))) * odd
            low = (values >> np.uint32(31)).astype(np.uint64) << (np.arange(128, dtype=np.uint64) % np.uint64(64))
            halves = [low[:, h : h + 64].sum(axis=1, dtype=np.uint64).view(np.int64) for h in (0, 64)]
            yield pdf.assign(s1=halves[0], s2=halves[1])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sets.schema)
    return sets.mapInPandas(batches, f"{schema}, s1 bigint, s2 bigint")


def postings(sets: DataFrame, rows: int, bands: int, carry: Sequence[str] = (), seen: Broadcast | None = None) -> DataFrame:
    """``shard`` and the carried bigint columns of each set, for each of its MinHash bands; with ``seen`` (a broadcast
    Seen) only for bands that may occur there."""

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            if not len(pdf):
                continue
            shards = lexis.band_keys(lexis.minhash(list(pdf["words"]), rows * bands), rows)
            hit = seen.value.has(shards) if seen is not None else np.ones(shards.shape, bool)
            owner = np.nonzero(hit)[0]
            yield pd.DataFrame({"shard": shards[hit], **{c: pdf[c].to_numpy()[owner] for c in carry}})

    return sets.select("words", *carry).mapInPandas(batches, ", ".join(f"{c} bigint" for c in ("shard", *carry)))


def crowded(posts: DataFrame, most: int) -> DataFrame:
    """``shard``: those with more than ``most`` postings. Counts are partial before the shuffle."""
    return posts.groupBy("shard").count().where(F.col("count") > most).select("shard")


_SLOTS = 1 << 18


def word_ranks(sets: DataFrame) -> np.ndarray:
    """How often words occur in the sets, by hash slot: a table of fixed size that sorts words from rare to frequent.
    Any order finds the same pairs; a rare-first order compares fewest."""

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(_SLOTS, np.int64)
        for pdf in it:
            if len(pdf):
                total += np.bincount(np.concatenate(list(pdf["words"])).view(np.uint64) % np.uint64(_SLOTS), minlength=_SLOTS)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"slot": used.astype(np.int32), "n": total[used]})

    counted = sets.select("words").mapInPandas(batches, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(_SLOTS, np.int64)
    out[counted["slot"].to_numpy()] = counted["n"].to_numpy()
    return out


def prefixes(sets: DataFrame, ranks: Broadcast, threshold: float, carry: Sequence[str]) -> DataFrame:
    """``shard`` (a word) and the carried bigint columns for each of the n - ceil(threshold n) + 1 rarest words of a
    set: two sets with an overlap of at least the threshold have one of these in common, whatever the order of words,
    as long as it is one for all."""

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            if not len(pdf):
                continue
            rank, parts = ranks.value, []
            for w in pdf["words"]:
                size = len(w) - int(np.ceil(threshold * len(w) - 1e-9)) + 1
                order = np.lexsort((w, rank[w.view(np.uint64) % np.uint64(_SLOTS)]))
                parts.append(w[order[:size]])
            sizes = [len(x) for x in parts]
            yield pd.DataFrame({"shard": np.concatenate(parts), **{c: np.repeat(pdf[c].to_numpy(), sizes) for c in carry}})

    return sets.select("words", *carry).mapInPandas(batches, ", ".join(f"{c} bigint" for c in ("shard", *carry)))


def verified(pairs: DataFrame, left: DataFrame, right: DataFrame, threshold: float, ids: Sequence[str] = ("sid",)) -> DataFrame:
    """Candidates by ids (``<id>_a, <id>_b``) -> ``set_a, set_b, overlap`` with the exact word overlap at or above the
    threshold. Sets that share an id are all checked, so a clash can't lose a pair."""
    own = lambda sets, x: sets.select(*[F.col(c).alias(f"{c}_{x}") for c in ids], F.col("set_key").alias(f"set_{x}"), F.col("words").alias(f"words_{x}"))

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            score = lexis.overlaps(pdf["words_a"], pdf["words_b"])
            out = pdf[["set_a", "set_b"]].assign(overlap=score)
            yield out[score >= threshold - 1e-12]

    met = pairs.join(own(left, "a"), [f"{c}_a" for c in ids]).join(own(right, "b"), [f"{c}_b" for c in ids])
    return met.select("set_a", "set_b", "words_a", "words_b").mapInPandas(batches, "set_a binary, set_b binary, overlap double")
