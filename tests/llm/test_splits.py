import random

from boreal.llm import splits
from boreal.llm.components import hash_to_min

ROW = "example_id string, source_id string, source_record_id string, source string, component int"


def rid(i):
    return f"n:{i:08d}:{i:012x}"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], ROW)


def components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(f"v{rng.randrange(60):02d}", f"v{rng.randrange(60):02d}") for _ in range(45)] + [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(20)]
    got = {r["node"]: r["component"] for r in hash_to_min(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == components(edges)


def test_components_of_nulls_and_nothing(spark):
    assert hash_to_min(spark.createDataFrame([], "a string, b string")).collect() == []
    rows = hash_to_min(spark.createDataFrame([("x", None), ("y", "y")], "a string, b string")).collect()
    assert [(r["node"], r["component"]) for r in rows] == [("y", "y")]


def test_tied_sources_follow_chains_and_ignore_placeholders(spark):
    rows = [("1", "A ", rid(1)), ("2", "b", rid(1).upper()), ("3", "B", f"\t{rid(2)} "), ("4", "c", rid(2)), ("5", "d", "unknown"), ("6", "e", "unknown"), ("7", "f", "unknown:unknown"),
            ("8", "g", None), ("9", None, rid(2)), ("10", "a", rid(1))]
    got = {tuple(r) for r in splits.tied_sources([frame(spark, rows[:5]), frame(spark, rows[5:])]).collect()}
    assert got == {("a", "b"), ("a", "c"), ("b", "c")}
    assert splits.tied_sources([frame(spark, [])]).collect() == []


def test_splits_keep_sources_and_records_together(spark):
    rng = random.Random(5)
    rows = []
    for i in range(6000):
        source = "hot" if rng.random() < 1 / 3 else f"s{int(rng.paretovariate(0.8)) % 900}"
        rows.append((f"e{i}", rng.choice([source, source.upper(), f" {source} "]) if rng.random() > 0.02 else None, rid(rng.randrange(20000)) if rng.random() > 0.1 else "n/a"))
    rows += rows[:50]
    df = frame(spark, rows)
    out = {r["example_id"]: r["split"] for r in splits.grouped_splits([df]).collect()}
    assert len(out) == 6000
    by_source, by_record = {}, {}
    for e, s, r in rows:
        if s:
            by_source.setdefault(s.strip().lower(), set()).add(out[e])
        if r != "n/a":
            by_record.setdefault(r, set()).add(out[e])
    assert all(len(x) == 1 for x in by_source.values())
    assert all(len(x) == 1 for x in by_record.values())
    again = {r["example_id"]: r["split"] for r in splits.grouped_splits([df.repartition(7)]).collect()}
    assert again == out


def test_shares_are_met_by_many_small_components(spark):
    rows = [(f"e{i}", f"s{i % 3000}", None) for i in range(9000)]
    out = [r["split"] for r in splits.grouped_splits([frame(spark, rows)]).collect()]
    for name, share in (("train", 0.9), ("dev", 0.05), ("test", 0.05)):
        assert abs(out.count(name) / 9000 - share) < 0.02


def test_one_component_goes_whole_to_the_largest_split(spark):
    assert {r["split"] for r in splits.grouped_splits([frame(spark, [(f"e{i}", "only", None) for i in range(30)])]).collect()} == {"train"}
    assert splits.grouped_splits([frame(spark, [])]).collect() == []
