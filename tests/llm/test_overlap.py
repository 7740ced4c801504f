import random

import numpy as np
from pyspark.sql import functions as F

from boreal.llm import leakage, lexis, neardup
from boreal.llm.bktree import Forest
from boreal.llm.overlap import distinct_sets, verified, with_sketch, word_sets


def brute(a, b, threshold=0.65, cross=False):
    sets = {k: {frozenset(lexis.words(t)) for x, t in a + b if x == k and t} for k, _ in a + b}
    out = set()
    for x in {k for k, _ in a}:
        for y in {k for k, _ in b}:
            if x is None or y is None or x == y or (not cross and x > y):
                continue
            if any(p and q and len(p & q) >= threshold * len(p | q) for p in sets[x] for q in sets[y]):
                out.add((min(x, y), max(x, y)))
    return out


def texts(seed, n):
    rng = random.Random(seed)
    vocab = [f"mot{i}" for i in range(900)]
    base = [" ".join(rng.choices(vocab, k=60)) for _ in range(n // 3)]
    out = []
    for i in range(n):
        ws = rng.choice(base).split()
        for _ in range(rng.choice([0, 1, 3, 6, 9])):
            ws[rng.randrange(len(ws))] = rng.choice(vocab)
        rng.shuffle(ws)
        out.append((f"r{i:03d}", rng.choice([" ", "\xa0", ", "]).join(ws).upper() if i % 5 == 0 else " ".join(ws)))
    return out


def test_words_are_runs_of_letters_and_digits():
    assert lexis.words("L’été, c'est-à-dire №5 ﬁn_x") == ["l", "été", "c", "est", "à", "dire", "no5", "fin", "x"]
    assert lexis.words(None) == lexis.words("…") == []
    assert lexis.words("é") == ["é"]


def test_forest_finds_what_comparing_all_finds():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 1 << 63, (400, 2), dtype=np.uint64)
    bits[200:] = bits[:200] ^ (np.uint64(1) << rng.integers(0, 63, (200, 2), dtype=np.uint64))
    shard = rng.integers(0, 5, 400)
    q, i = Forest(shard, bits).search(shard, bits, 9)
    near = np.bitwise_count(bits[:, None] ^ bits[None]).sum(axis=2) <= 9
    want = {(a, b) for a, b in np.argwhere(near & (shard[:, None] == shard[None]))}
    assert set(zip(q.tolist(), i.tolist(), strict=True)) == want
    assert len(q) == len(want)


def test_near_pairs_match_brute_force(spark):
    rows = texts(2, 240) + [("x1", "même texte ici"), ("x2", "Même  texte, ici"), ("x3", None), ("x4", "..."), ("x5", ""), (None, "même texte ici"), ("x1", "même texte ici"), ("long", "a b " * 40_000)]
    df = spark.createDataFrame([(k, t, "clash", 1) for k, t in rows], "record_id string, text string, key string, sid int")
    got = [tuple(r) for r in neardup.near_duplicate_pairs(df).collect()]
    assert len(got) == len(set(got))
    assert set(got) <= brute(rows, rows)
    assert set(got) >= brute(rows, rows, 0.72)
    assert len(got) >= 0.98 * len(brute(rows, rows))
    assert neardup.near_duplicate_pairs(df.limit(0)).collect() == []


def test_groups_follow_the_pairs(spark):
    rows = texts(4, 90)
    df = spark.createDataFrame(rows, "record_id string, text string")
    groups = {r["record_id"]: r["group_id"] for r in neardup.near_duplicate_groups(df).collect()}
    assert set(groups) == {k for k, _ in rows}
    assert all(groups[a] == groups[b] for a, b in brute(rows, rows, 0.72))
    tied = {x for p in brute(rows, rows) for x in p}
    assert all(groups[k] == k for k in groups if k not in tied)


def crowd(n, seed=9):
    """Texts of one band (all share its words) that are unlike otherwise, some pairs excepted."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        own = [f"x{rng.randrange(10**9)}" for _ in range(50)]
        rows.append((f"r{i:06d}", " ".join([f"mot{k}" for k in range(30)] + own)))
        if i % 100 == 0:
            rows.append((f"s{i:06d}", " ".join([f"mot{k}" for k in range(30)] + own[:45] + [f"y{i}"])))
    return rows


def test_hot_shards_are_split_without_loss(spark):
    rng = random.Random(9)
    base = [f"mot{i}" for i in range(80)]
    rows = [(f"r{i:03d}", " ".join(base + [f"x{rng.randrange(10**6)}"])) for i in range(120)]
    sets = with_sketch(distinct_sets(word_sets(spark.createDataFrame(rows, "k string, t string"), "k", "t")))
    whole = {tuple(r) for r in neardup.candidate_pairs(sets).collect()}
    split = {tuple(r) for r in neardup.candidate_pairs(sets, block=16).collect()}
    assert whole == split
    assert len(whole) == 120 * 119 // 2


def test_a_crowded_band_of_unlike_sets_is_told_apart_by_rare_words(spark):
    rows = crowd(2000)
    df = spark.createDataFrame(rows, "record_id string, text string").withColumn("example_id", F.col("record_id"))
    want = {(f"r{i:06d}", f"s{i:06d}") for i in range(0, 2000, 100)}
    sets = with_sketch(distinct_sets(word_sets(df, "record_id", "text"))).cache()
    name = {r["sid"]: r["key"] for r in word_sets(df, "record_id", "text").collect()}
    for block in (64, 4096):
        pairs = neardup.candidate_pairs(sets, block=block)
        assert want <= {tuple(sorted((name[a], name[b]))) for a, b in pairs.collect()}
    found = leakage.candidates(sets, sets, block=64)
    full = verified(found, sets, sets, 0.65, ("s1", "s2")).where("set_a <> set_b")
    assert full.count() == 2 * len(want)


def chat(text):
    return f"<|im_start|>system\nTu réponds.\n<|im_end|>\n<|im_start|>user\nQuoi?\n<|im_end|>\n<|im_start|>assistant\n{text}\n<|im_end|>"


def test_leaks_match_brute_force(spark):
    rows = texts(6, 200)
    train, held = rows[:140], rows[140:] + [("same", rows[0][1])]
    schema = "example_id string, text string, source_id string"
    a = spark.createDataFrame([(k, chat(t), "S ") for k, t in train] + [("same", chat("autre chose"), "s"), ("nul", None, "s"), ("vide", chat(""), None), ("nu", rows[0][1], "s")], schema)
    b = spark.createDataFrame([(k, chat(t), "s") for k, t in held], schema)
    got = {tuple(r) for r in leakage.leaked_pairs(a, [b.limit(0), b]).collect()}
    assert brute(train, held, 0.72, cross=True) <= got <= brute(train, held, cross=True)
    report = {(r["split"], r["source_id"]): (r["leaked"], r["examples"]) for r in leakage.leak_report(a, {"dev": b}).collect()}
    assert report == {("dev", "s"): (len({y for x, y in got} & {k for k, _ in held} | {x for x, y in got} & {k for k, _ in held}), len(held))}
    assert leakage.leaked_pairs(a.limit(0), [b]).collect() == []


def test_leaks_at_the_threshold_are_met(spark):
    train, held = [], []
    for i in range(600):  # 26 of 40 words in common: an overlap of 0.65
        common = [f"m{i}x{k}" for k in range(26)]
        train.append((f"t{i:03d}", chat(" ".join(common + [f"a{i}x{k}" for k in range(7)]))))
        held.append((f"v{i:03d}", chat(" ".join(common + [f"b{i}x{k}" for k in range(7)]))))
    a, b = (spark.createDataFrame(x, "example_id string, text string") for x in (train, held))
    got = {tuple(r) for r in leakage.leaked_pairs(a, [b]).collect()}
    assert got <= {(f"t{i:03d}", f"v{i:03d}") for i in range(600)}
    assert len(got) >= 597


def test_assistant_turns():
    assert leakage.assistant_turns(chat("oui")).strip() == "oui"
    assert leakage.assistant_turns("<|im_start|>assistant\nun<|im_end|><|im_start|>user\nx<|im_start|>assistant\ndeux").split() == ["un", "deux"]
    assert leakage.assistant_turns("sans tour") == ""
