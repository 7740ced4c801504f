"""Same or near-same examples across splits: banded MinHash, cross-split candidates only, exact overlap."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boreal.llm.overlap import crowded, distinct_sets, postings, prefixes, verified, with_sketch, word_ranks, word_sets
from boreal.llm.splits import plain
from boreal.operators.seen import Seen, dealt_join
from boreal.session import written

#: Of the 128 bits of a sketch, two sets with an overlap of 0.65 differ in 22.4 on average, with a deviation of 4.3.
#: They share one of the 64 bands with a probability of 0.9996 (0.99999 from 0.7 on).
ROWS, BANDS, RADIUS, BLOCK = 5, 64, 40, 2048
_TURN = re.compile(r"<\|im_start\|>\s*assistant\b(.*?)(?:<\|im_end\|>|(?=<\|im_start\|>)|\Z)", re.S | re.I)


def assistant_turns(text: str) -> str:
    """The assistant turns of a chat rendering, joined; a turn left open runs to the end. Without any, nothing."""
    return "\n".join(_TURN.findall(text))


def _near(met: DataFrame, radius: int) -> DataFrame:
    apart = lambda c: F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b")))
    return met.where(apart("s1") + apart("s2") <= radius).select("s1_a", "s2_a", "s1_b", "s2_b")


def _named(posts: DataFrame, x: str) -> DataFrame:
    return posts.withColumnsRenamed({c: f"{c}_{x}" for c in posts.columns if c != "shard"})


def candidates(train: DataFrame, held: DataFrame, threshold: float = 0.65, block: int = BLOCK) -> DataFrame:
    """Distinct ``s1_a, s2_a, s1_b, s2_b``, the sketches of sets of both sides that meet in a band and lie within the
    radius. A train set posts only the bands the held-out side may have (see Seen), so of the far larger side little
    is moved. Sets of a band with more than ``block`` postings leave the bands: they are joined by their rarest words
    instead, which finds every pair of them at the threshold (see prefixes) and compares few others."""
    context = train.sparkSession.sparkContext
    b = written(postings(held, ROWS, BANDS, ("s1", "s2")), "held-bands")
    seen = Seen.of(b, "shard", b.count())
    a = written(postings(train, ROWS, BANDS, ("s1", "s2"), seen and context.broadcast(seen)), "train-bands")
    hot = written(crowded(a.select("shard").union(b.select("shard")), block), "hot")
    if hot.isEmpty():
        return _near(_named(a, "a").join(_named(b, "b").hint("merge"), "shard"), RADIUS).distinct()
    cold = _named(a.join(hot, "shard", "left_anti"), "a").join(_named(b.join(hot, "shard", "left_anti"), "b").hint("merge"), "shard")
    crowd = [s.join(p.join(hot, "shard", "left_semi").select("s1", "s2").distinct(), ["s1", "s2"], "left_semi") for s, p in ((train, a), (held, b))]
    crowd = [written(c, "crowd") for c in crowd]
    ranks = context.broadcast(word_ranks(crowd[0].select("words").union(crowd[1].select("words"))))
    rare = [_named(prefixes(c, ranks, threshold, ("s1", "s2", "n")), x) for c, x in zip(crowd, "ab", strict=True)]
    met = dealt_join(*rare, block=block).where(F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * (threshold - 1e-9))
    return _near(cold, RADIUS).union(_near(met, RADIUS)).distinct()


def cross_pairs(train: DataFrame, held: DataFrame, key: str, text: str, threshold: float = 0.65) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(train members, held members, pairs of sets)``; only bands met by both sides make candidates, so the far
    larger training side is never joined with itself. Equal sets are candidates by their key."""
    sides = [written(word_sets(t, key, text, assistant_turns), name) for t, name in ((train, "train-sets"), (held, "held-sets"))]
    one = [written(with_sketch(distinct_sets(s)), "distinct-sets") for s in sides]
    members = [written(s.select("key", "set_key").distinct(), "members") for s in sides]
    return members[0], members[1], verified(candidates(*one, threshold), one[0], one[1], threshold, ("s1", "s2"))


def leaked_pairs(train: DataFrame, held: list[DataFrame], key: str = "example_id", text: str = "text", threshold: float = 0.65) -> DataFrame:
    """``example_id_a < example_id_b``: one example of train and one of dev or test whose assistant turns have a word
    overlap of at least the threshold. Stored hashes are ignored: the text decides. Null ids or texts and turns
    without a word are in no pair; one id on both sides is no pair; repeated rows count once."""
    mine, theirs, pairs = cross_pairs(train, reduce(DataFrame.unionByName, [h.select(key, text) for h in held]), key, text, threshold)
    a = mine.select(F.col("key").alias("a"), F.col("set_key").alias("set_a"))
    b = theirs.select(F.col("key").alias("b"), F.col("set_key").alias("set_b"))
    rows = pairs.join(a, "set_a").join(b, "set_b").where("a <> b")
    return rows.select(F.least("a", "b").alias(f"{key}_a"), F.greatest("a", "b").alias(f"{key}_b")).distinct()


def leak_report(train: DataFrame, held: dict[str, DataFrame], key: str = "example_id", text: str = "text", source: str = "source_id", threshold: float = 0.65) -> DataFrame:
    """``split, source_id, leaked, examples``: for each held-out split and source, how many examples also stand in
    train, of how many. One example_id counts once in a split; a source counts under its plain spelling."""
    both = reduce(DataFrame.unionByName, [h.select(key, text) for h in held.values()])
    _, theirs, pairs = cross_pairs(train, both, key, text, threshold)
    leaked = theirs.join(pairs.select(F.col("set_b").alias("set_key")).distinct(), "set_key", "left_semi").select(F.col("key").alias(key)).distinct().withColumn("hit", F.lit(1))
    rows = reduce(DataFrame.unionByName, [h.select(F.lit(s).alias("split"), F.col(key), plain(source).alias("source_id")) for s, h in held.items()])
    rows = rows.where(F.col(key).isNotNull()).groupBy("split", key).agg(F.min("source_id").alias("source_id"))
    return rows.join(leaked, key, "left").groupBy("split", "source_id").agg(F.count("hit").alias("leaked"), F.count(F.lit(1)).alias("examples"))
