import random

from boreal.llm import contamination
from boreal.llm.lexis import words


def data(seed=1):
    rng = random.Random(seed)
    vocab = [f"m{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randrange(5, 60)))) for i in range(25)]
    docs = []
    for d in range(80):
        ws = rng.choices(vocab, k=rng.randrange(0, 120))
        if d % 3 == 0:
            src = rng.choice(items)[1].split()
            n = rng.choice([11, 12, 13, 40])
            at = rng.randrange(len(src))
            ws[10:10] = src[at : at + n]
        docs.append((d, rng.choice([" ", "\n", "’"]).join(ws).upper()))
    return docs, items


def grams(text):
    ws = words(text)
    return {tuple(ws[i : i + 12]) for i in range(len(ws) - 11)}


def frames(spark, docs, items):
    return spark.createDataFrame([(*r, 7) for r in docs], "doc_id bigint, text string, item_id int"), spark.createDataFrame([(*r, "c") for r in items], "item_id bigint, text string, doc_id string")


def test_found_matches_brute_force(spark):
    docs, items = data()
    docs += [(900, None), (901, ""), (902, "mot " * 50_000), (None, items[0][1])]
    items += [(901, None), (902, "trop court"), (903, items[3][1])]
    a, b = frames(spark, docs, items)
    want = {(d, i) for d, t in docs for i, s in items if d is not None and t and s and grams(t) & grams(s)}
    assert {tuple(r) for r in contamination.contaminated(a, b).collect()} == want
    small = contamination.verbatim_matches(a, b, block_words=50).select("doc_id", "item_id").distinct()
    assert {tuple(r) for r in small.collect()} == want
    assert contamination.contaminated(a.limit(0), b).collect() == contamination.contaminated(a, b.limit(0)).collect() == []
    kept = {r["doc_id"] for r in contamination.without_leaks(a, b).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


def test_matches_are_longest_and_located(spark):
    passage = [f"p{i}" for i in range(30)]
    doc = ["x", "y", *passage[4:25], "z"]
    a, b = frames(spark, [(1, " ".join(doc)), (2, " ".join(passage[:11]))], [(5, " ".join(passage))])
    rows = [tuple(r) for r in contamination.verbatim_matches(a, b).collect()]
    assert rows == [(1, 5, 2, 4, 21)]
    report = contamination.leaked_items(a, b).collect()
    assert [tuple(r) for r in report] == [(5, 1, 21)]


def test_matches_never_cross_documents(spark):
    passage = [f"p{i}" for i in range(24)]
    a, b = frames(spark, [(1, " ".join(passage[:8])), (2, " ".join(passage[8:16])), (3, " ".join(passage[16:]))], [(5, " ".join(passage))])
    assert contamination.contaminated(a.coalesce(1), b).collect() == []


def test_a_formula_repeated_on_both_sides_comes_in_pieces():
    import numpy as np

    formula = [f"f{i}" for i in range(12)]
    passages = contamination.Passages([(i, [*formula, f"own{i}"]) for i in range(20)])
    ids = [passages.ids[w] for w in formula]
    shard = np.array(sum(([*ids, -1] for _ in range(50)), []), np.int64)
    pieces = list(contamination.search_shard(passages, shard, most=100))
    assert len(pieces) == 10 and max(len(t) for t, _, _ in pieces) == 100
    assert sum(len(t) for t, _, _ in pieces) == 20 * 50
    assert len({(int(t), int(s)) for ts, ss, _ in pieces for t, s in zip(ts, ss, strict=True)}) == 1000
