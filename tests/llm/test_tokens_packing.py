import os
import random
from datetime import datetime

import numpy as np
import pytest

from boreal.llm import packing, tokens

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.TOKENIZER), reason="no tokenizer file")

EXAMPLE = "example_id string, text string, source_id string, language string, domain string, register string, exported_at timestamp, tokens int, one string"


def test_counts_are_those_of_the_tokenizer(spark):
    texts = ["Bonjour, l'été!", "", None, "mot " * 30_000, "😀 <|im_end|>"]
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "k int, text string, tokens int")
    got = {r["k"]: r["tokens"] for r in tokens.with_tokens(df, keep={"k": "k"}).collect()}
    encode = tokens.encoding().encode_ordinary
    assert got == {i: len(encode(t)) if t else 0 for i, t in enumerate(texts)}
    assert tokens.encoding().decode(encode(texts[0])) == texts[0]


def test_each_example_counts_once_under_plain_labels(spark):
    t = datetime(2024, 1, 1)
    rows = [("a", "un deux", " S1 ", "fr-CA", "News", "x", t, 1, "c"), ("a", "un deux", "s1", "fr_CA", "news ", "X", t, 1, "c"), ("b", "trois", "S1", None, None, "x", t, 1, "c"), (None, "quatre", "s2", "", "news", None, t, 1, "c"), (None, "quatre", "s2", "", "news", None, t, 1, "c")]
    df = spark.createDataFrame(rows, EXAMPLE)
    counts = tokens.example_tokens([df.limit(2), df])
    assert counts.count() == 3
    cube = tokens.token_cube(counts)
    total = cube.where("level = 15").first()
    assert (total["documents"], total["tokens"]) == (3, sum(len(tokens.encoding().encode_ordinary(x)) for x in ("un deux", "trois", "quatre")))
    sources = {r["source_id"]: r["documents"] for r in cube.where("level = 7").collect()}
    assert sources == {"s1": 2, "s2": 1}
    assert {r["domain"] for r in cube.where("level = 13").collect()} == {"news", "(none)"}
    empty = tokens.token_cube(tokens.example_tokens([df.limit(0)])).collect()
    assert sum(r["documents"] for r in empty) == 0


def check(sizes, sources, boxes, capacity):
    fill = np.bincount(boxes, weights=sizes)
    assert fill.max() <= capacity
    return sizes.sum() / (capacity * len(np.unique(boxes)))


def test_pack_fills_and_holds_the_mixture():
    rng = np.random.default_rng(1)
    sources = rng.choice(["hot", "b", "c"], 6000, p=[1 / 3, 0.6, 1 - 1 / 3 - 0.6])
    sizes = np.minimum(rng.lognormal(5.8, 0.9, 6000).astype(int), 2048)
    share = {s: sizes[sources == s].sum() / sizes.sum() for s in ("hot", "b", "c")}
    boxes = packing.pack(sizes, sources, share, {}, 2048)
    assert check(sizes, sources, boxes, 2048) > 0.97
    order = np.argsort(boxes, kind="stable")
    parts = np.array_split(order, 8)[:-1]
    for part in parts:
        held = sizes[part][sources[part] == "hot"].sum() / sizes[part].sum()
        assert abs(held - share["hot"]) < 0.08


def test_pack_takes_up_deficits_and_odd_sizes():
    assert packing.pack(np.array([], int), np.array([]), {}, {}).tolist() == []
    boxes = packing.pack(np.array([0, 0, 2048, 2048]), np.array(["a", "a", "b", "b"]), {}, {})
    assert len(set(boxes.tolist())) == 3
    late = packing.pack(np.full(400, 512), np.array(["a"] * 200 + ["b"] * 200), {"a": 0.5, "b": 0.5}, {"a": 60_000.0, "b": -60_000.0}, window=8)
    assert np.mean(late[:200]) < np.mean(late[200:])


def test_packed_documents(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["mot", "été", "ville"]) for _ in range(rng.randrange(0, 900))), rng.choice(["s1", "s1", "s2", None, " "]), 9, "c") for i in range(400)]
    rows += [(1000, "long " * 7000, "s1", 9, "c"), (1001, None, "s2", 9, "c"), (None, "sans clé", "s2", 9, "c"), (5, rows[5][1], "s1", 9, "c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, container int, piece string")
    out = packing.packed(df).collect()
    full = {}
    for r in out:
        full[r["container"]] = full.get(r["container"], 0) + r["tokens"]
    assert max(full.values()) <= 2048
    pieces = sorted((r["piece"], r["first_token"], r["tokens"]) for r in out if r["doc_id"] == 1000)
    total = len(tokens.encoding().encode_ordinary("long " * 7000))
    assert [p[0] for p in pieces] == list(range(len(pieces))) and sum(p[2] for p in pieces) == total and all(p[2] == 2048 for p in pieces[:-1])
    assert len(out) == len(rows) - 1 + len(pieces)
    assert all(r["piece"] == 0 for r in out if r["doc_id"] != 1000)
    report = packing.fill_report(packing.packed(df)).first()
    assert report["fill"] > 0.9 and report["items"] == len(out)
    assert packing.packed(df.limit(0)).collect() == []
    mixed = packing.packed(df, mixture={"s1": 1, "s2": 1}).collect()
    assert len(mixed) == len(out)


def test_running_sums_over_stretches(spark, monkeypatch):
    monkeypatch.setattr(packing, "_STRETCH", 4)
    rng = random.Random(4)
    rows = [(i, s, rng.randrange(50)) for i in range(23) for s in "ab" if rng.random() < 0.8]
    df = spark.createDataFrame(rows, "shard int, source string, tokens int")
    got = {(r["shard"], r["source"]): r["x"] for r in packing._running(df, "tokens", "x", ["source"]).collect()}
    assert got == {(i, s): sum(n for j, t, n in rows if t == s and j < i) for i, s, _ in rows}
    one = df.groupBy("shard").sum("tokens").toDF("shard", "n")
    assert {r["shard"]: r["x"] for r in packing._running(one, "n", "x", []).collect()} == {i: sum(n for j, _, n in rows if j < i) for i in {r[0] for r in rows}}


def test_items_stay_whole(spark):
    docs = spark.createDataFrame([(i, "mot " * n, "s") for i, n in enumerate([0, 5, 3000, 40, 2500, 7])], "doc_id int, text string, source string")
    out = packing.packed(docs, capacity=64)
    assert {tuple(r)[1:] for r in packing.whole_items(out, capacity=64).collect()} == {(True, True, True)}
    broken = out.where("piece <> 1")
    assert (False in {r["contiguous"] for r in packing.whole_items(broken, capacity=64).collect()})
