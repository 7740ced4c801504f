import os
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from boreal import session
from boreal.functions import text as X
from boreal.operators import audit, balance, contamination, curation, dedup, evaluation, instruct, lexical, pairs, rules, splits


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_first_wins_on_any_partitioning(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "b", None, "hot", "hot"]), "x") for i in range(300)]
    df = spark.createDataFrame(rows, "i int, k string, key string")
    want = sorted({k: min(i for i, x, _ in rows if x == k) for k in {r[1] for r in rows}}.values())
    for n in (1, 2, 16):
        assert [r[0] for r in rows_of(dedup.first_wins(df.repartition(n), ["k"], ["i"]))] == want
    flags = {r["i"] for r in dedup.duplicate_flags(df.where("k is not null"), "k", ["i"]).where("not is_duplicate").collect()}
    assert flags == {i for i in want if rows[i][1] is not None}
    assert dedup.first_wins(df.limit(0), ["k"], ["i"]).collect() == []


def test_two_keys(spark):
    df = spark.createDataFrame([(1, "A", "a"), (2, "A", "a"), (3, "a", "a"), (4, "b", "b")], "i int, exact string, normal string")
    assert [(r["i"], r["reason"]) for r in dedup.two_key_reasons(df, "exact", "normal", ["i"]).orderBy("i").collect()] == [(1, None), (2, "duplicate_exact"), (3, "duplicate_normalized"), (4, None)]


def test_forgetful_dedup(spark):
    df = spark.createDataFrame(list(enumerate("abacabad")), "i int, k string")
    got = "".join(r["k"] for r in dedup.forgetful_dedup(df.repartition(3), "k", ["i"], 2).orderBy("i").collect())
    want, seen = "", set()
    for k in "abacabad":
        if k not in seen:
            seen.add(k)
            want += k
        if len(seen) >= 2:
            seen.clear()
    assert got == want


def sequential_examples(cands, most):
    exact, normal, count, out = set(), set(), Counter(), []
    for rec, rank, e, n in sorted(cands):
        if count[rec] >= most or e in exact or n in normal:
            continue
        exact.add(e)
        normal.add(n)
        count[rec] += 1
        out.append((rec, rank))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_example_dedup_matches_the_sequential_loop(spark, seed):
    rng = random.Random(seed)
    cands = []
    for rec in range(25):
        for rank in range(5):
            n = f"n{rng.randrange(30)}"
            cands.append((rec, rank, f"{n}-{rng.randrange(2)}", n))
    df = spark.createDataFrame(cands, "rec int, rank int, exact string, normal string")
    got = dedup.dedup_examples(df, "rec", "rank", ["rec", "rank"], "exact", "normal", 2)
    assert rows_of(got.select("rec", "rank")) == sequential_examples(cands, 2)


@pytest.mark.parametrize("options", [{}, {"alone": 0}, {"alone": 0, "rounds": 2}])
def test_examples_that_hang_on_each_other_in_long_chains(spark, options):
    rng = random.Random(7)
    # One text shared by all records but beyond each one's limit; records each of which frees what the next one asks for; chance.
    shared = [(r, k, f"e{r}-{k}", "same" if k == 2 else f"n{r}{k}") for r in range(40) for k in range(3)]
    chain = [(100 + r, k, f"l{r}-{k}", f"link{r + (k == 2)}" if k != 1 else f"own{r}") for r in range(12) for k in range(3)]
    chance = [(1000 + r, k, f"c{1000 * r + k}", f"c{rng.randrange(60)}") for r in range(60) for k in range(rng.randrange(1, 6))]
    cands = shared + chain + chance
    df = spark.createDataFrame(cands, "rec int, rank int, exact string, normal string").repartition(5)
    want = sequential_examples(cands, 2)
    for columns in (None, ["rec", "rank"]):
        got = dedup.dedup_examples(df, "rec", "rank", ["rec", "rank"], "exact", "normal", 2, columns=columns, **options)
        assert rows_of(got.select("rec", "rank")) == want


def slow_cap(counts, cap):
    of = (lambda k: cap.get(k, 1.0)) if isinstance(cap, dict) else (lambda k: cap)
    left = dict(counts)
    while True:
        total = sum(left.values())
        over = [k for k, n in left.items() if n > 1 and n / total > of(k) + 1e-9]
        if not over:
            return {k: counts[k] - left[k] for k in counts if counts[k] > left[k]}
        for k in over:
            left[k] -= 1


@pytest.mark.parametrize("seed", range(200))
def test_caps_match_the_loop(seed):
    rng = random.Random(seed)
    counts = {f"k{i}": rng.choice([1, 2, 5, 40, rng.randrange(1, 300)]) for i in range(rng.randrange(1, 8))}
    cap = rng.choice([0.05, 0.2, 0.5, 0.9, 1.0]) if seed % 2 else {k: rng.choice([0.1, 0.3, 0.7]) for k in counts if rng.random() < 0.6}
    of = (lambda k: cap.get(k, 1.0)) if isinstance(cap, dict) else (lambda k: cap)
    drops = balance.drops_per_class(Counter((n, of(k)) for k, n in counts.items()))
    assert {k: drops[n, of(k)] for k, n in counts.items() if (n, of(k)) in drops} == slow_cap(counts, cap)


def test_share_cap_drops_the_greatest_ranks(spark):
    rows = [(i, "big") for i in range(50)] + [(100 + i, f"k{i}") for i in range(10)] + [(200, None)]
    df = spark.createDataFrame(rows, "i int, k string").withColumn("h", balance.drop_score(1, F.col("i").cast("string")))
    kept = balance.share_cap(df, "k", 0.5, ["h", "i"]).collect()
    left = 50 - slow_cap({"big": 50, "unknown": 1, **{f"k{i}": 1 for i in range(10)}}, 0.5)["big"]
    assert sum(r["k"] == "big" for r in kept) == left and len(kept) == left + 11
    ranks = {r["i"]: r["h"] for r in df.where("k = 'big'").collect()}
    assert {r["i"] for r in kept if r["k"] == "big"} == set(sorted(ranks, key=lambda i: ranks[i])[:left])
    assert balance.share_cap(df.limit(0), "k", 0.5, ["h"]).collect() == []


def test_probable_and_limits(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    n = df.where(balance.probable("k", 0.3)).count()
    assert 500 < n < 700
    assert df.where(balance.probable("k", 0.0)).count() == 0 and df.where(balance.probable("k", 1.0)).count() == 2000
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, "b")], "i int, k string")
    assert [r[0] for r in rows_of(balance.first_per_key(df, "k", ["i"], 2))] == [1, 2, 4]
    codes = spark.createDataFrame([("g", "x", 3), ("g", "y", 1), ("g", "z", 2), ("g", "z", 9)], "g string, c string, i int")
    assert [r["c"] for r in balance.top_codes(codes, ["g"], "c", "i", 2).orderBy("rank").collect()] == ["z", "y"]


def test_splits(spark):
    ratios = {"train": 0.8, "dev": 0.1, "test": 0.1}
    assert splits.split_counts(3, ratios) == {"train": 1, "dev": 1, "test": 1}
    assert splits.split_counts(2, ratios) == {"train": 1, "dev": 0, "test": 1}
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    got = {r["k"]: r["split"] for r in splits.shuffled_split(df, "k", 1, ratios).collect()}
    assert Counter(got.values()) == {"train": 800, "dev": 100, "test": 100}
    assert got == {r["k"]: r["split"] for r in splits.shuffled_split(df.repartition(9), "k", 1, ratios).collect()}
    assert splits.shuffled_split(df.limit(0), "k", 1, ratios).collect() == []


def test_grouped_split(spark):
    rng = random.Random(2)
    rows = [(i, f"g{rng.randrange(40)}" if i % 3 else "hot") for i in range(900)] + [(900, None)]
    df = spark.createDataFrame(rows, "i int, g string")
    ratios = {"train": 0.5, "dev": 0.25, "test": 0.25}
    out = splits.grouped_split(df, "g", 42, ratios).collect()
    assert len(out) == 901
    where = {}
    for r in out:
        where.setdefault(r["g"], set()).add(r["split"])
    assert all(len(s) == 1 for s in where.values()) and {r["split"] for r in out} == {"train", "dev", "test"}
    assert rows_of(splits.grouped_split(df.repartition(7), "g", 42, ratios)) == sorted(tuple(r) for r in out)
    assert splits.grouped_split(df.limit(0), "g", 42, ratios).collect() == []
    # one group holds nearly all: the smallest groups still fill dev and test
    df = spark.createDataFrame([(i, "all") for i in range(100)] + [(200 + i, f"k{i % 3}") for i in range(6)], "i int, g string")
    got = {r["g"]: r["split"] for r in splits.grouped_split(df, "g", 1, {"train": 0.9, "dev": 0.05, "test": 0.05}).collect()}
    assert set(got.values()) == {"train", "dev", "test"}


def test_keys_take_decomposed_accents_for_composed(spark):
    df = spark.createDataFrame([(1, "Un été à Québec."), (2, "Un e\u0301te\u0301 a\u0300 Que\u0301bec."), (3, "autre")], "i int, text string")
    assert [r["i"] for r in dedup.first_wins(df, [X.norm_key("text")], ["i"]).orderBy("i").collect()] == [1, 3]
    assert tuple(dedup.duplicate_counts(df, normal=X.norm_key("text")).first()) == (3, 1)
    assert [r["is_duplicate"] for r in dedup.duplicate_flags(df, X.sha(X.norm_key("text")), ["i"]).orderBy("i").collect()] == [False, True, False]
    assert rows_of(contamination.exact_matches(df.where("i = 1"), df, "i")) == [(1, 1), (1, 2)]
    assert audit.readiness(df).first()["duplicate_normalized"] == 1
    made = instruct.candidates(df.where("i < 3"), "i", strategies=("style_rewrite",)).select("example_norm_sha256").distinct()
    assert made.count() == 1


def test_tables_between_jobs_need_a_shared_folder(spark, tmp_path):
    class Elsewhere:
        conf = type("C", (), {"get": staticmethod(lambda k, d: d)})
        sparkContext = type("S", (), {"master": "spark://head:7077"})

    with pytest.raises(ValueError):
        session.shared_dir(Elsewhere())
    kept = session.written(spark.range(3).toDF("i"), "three")
    folder = kept._boreal_path
    assert os.path.isdir(folder) and kept.count() == 3
    session.discard(kept)
    assert not os.path.exists(folder)
    session.discard(spark.range(1))


def test_curation(spark):
    rows = [(1, "Un courriel au dépanneur ce matin."), (2, "un courriel au dépanneur ce matin."), (3, "court"), (4, "TOUT EST EN MAJUSCULES ICI MEME"), (5, "Ma voiture et un email, une phrase assez longue"), (6, "[pii_review] un courriel et le dépanneur, magasiner")]
    df = spark.createDataFrame(rows, "i int, text string")
    policy = curation.CurationPolicy(reviewing={"pii": "[pii_review]"})
    got = {r["i"]: (r["curation_score"], r["curation_label"], r["curation_reasons"]) for r in curation.score_records(df, policy, ["i"]).collect()}
    assert got[1] == (1.9, "accepted", ["marker:courriel", "marker:dépanneur"])
    assert got[2] == (1.1, "review_required", ["marker:courriel", "marker:dépanneur", "penalty:duplicate_text"])
    assert got[3] == (pytest.approx(-0.1), "quarantine", ["penalty:too_short", "penalty:low_marker_score"])
    assert got[4][1:] == ("quarantine", ["penalty:excessive_uppercase_ratio", "penalty:low_marker_score"])
    assert got[5][1] == "rejected"
    assert got[6][1] == "review_required" and "review:pii" in got[6][2]
    with pytest.raises(ValueError):
        curation.CurationPolicy(accept=0.1)


def test_similar_matches_match_brute_force(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice(["mot", "été", "ville", "pont", "lac"]) + str(rng.randrange(50)) for _ in range(25)) for _ in range(20)]
    make = lambda n: [t if rng.random() < 0.3 else t[: (k := rng.randrange(len(t)))] + "zz" + t[k + 1 :] for t in rng.choices(base, k=n)]
    a, b = list(enumerate(make(60))), [(i + 1000, t) for i, t in enumerate(make(30))] + [(5000, "ab"), (5001, None)]
    grams = lambda t: {t[i : i + 3] for i in range(max(1, len(t) - 2))}
    for t in (0.5, 0.85, 1.0):
        want = set()
        for x, p in a:
            for y, q in b:
                if q and len(q) > 2 and p != q and len(grams(p) & grams(q)) / len(grams(p) | grams(q)) >= t:
                    want.add((x, y))
        got = contamination.similar_matches(spark.createDataFrame(a, "id int, text string"), spark.createDataFrame(b, "id int, text string"), "id", threshold=t)
        assert {(r["train_id"], r["holdout_id"]) for r in got.collect()} == want
    exact = contamination.exact_matches(spark.createDataFrame(a, "id int, text string"), spark.createDataFrame(b, "id int, text string"), "id").collect()
    assert {tuple(r) for r in exact} == {(x, y) for x, p in a for y, q in b if q and len(q) > 2 and p == q}


def test_similar_matches_write_texts_and_not_their_trigrams(spark):
    rng = random.Random(5)
    make = lambda: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyzéèà", k=6)) for _ in range(100))
    texts = [make() for _ in range(400)]
    held = [texts[7][:-1] + "z", make()]
    size = lambda: sum(p.stat().st_size for p in Path(session.scratch(spark)).rglob("*.parquet"))
    before = size()
    frame = lambda rows: spark.createDataFrame(list(enumerate(rows)), "id int, text string")
    got = contamination.similar_matches(frame(texts), frame(held), "id")
    assert [(r["train_id"], r["holdout_id"]) for r in got.collect()] == [(7, 0)]
    assert size() - before < 3 * sum(map(len, texts))


def test_sketches_differ_no_more_than_their_sets():
    rng = np.random.default_rng(1)
    for n, m, both in ((500, 40, 470), (3, 5, 0), (900, 0, 0), (300, 300, 300), (400, 380, 10)):
        shared, a, b = (rng.integers(-(2**63), 2**63 - 1, k) for k in (both, n, m))
        x, y = contamination._sketch(np.concatenate([shared, a])), contamination._sketch(np.concatenate([shared, b]))
        assert len(x) == 4 and sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= n + m
    assert not (contamination._sketch(shared) ^ contamination._sketch(shared[::-1])).any()


def test_evaluation(spark):
    df = spark.createDataFrame([("Un courriel.", "email", "k", "1", 0.5, None), ("email!", None, "k", "0", 0.7, "mild"), ("courrielx", "", "k", "0", None, "odd"), ("", "", "k", "maybe", 0.1, None), ("", "", "k", "1", 3.0, None), ("", "", "k", "0", None, None)], "a string, b string, g string, ok string, sim double, code string")
    scored = evaluation.rescore(df.withColumn("w", F.array(F.lit("courriel"))).withColumn("u", F.array(F.lit("email"))), ["a", "b"], "w", "u").collect()
    assert [r["a_score"]["score"] for r in scored] == [1, -1, 0, 0, 0, 0] and scored[0]["b_score"]["score"] == -1
    taxonomy = spark.createDataFrame([(9, "mild", "minor"), (20, "mild", "blocking")], "lp_id int, error_code string, severity string")
    rows = evaluation.graded(df.withColumn("lp_id", F.lit("9")), F.col("ok"), F.col("code"), taxonomy, similarity=F.col("sim"))
    got = evaluation.diagnostics(rows, ["g"]).first()
    assert (got["n"], got["malformed"], got["correct"], got["unknown_codes"], got["blocking"], got["non_blocking"]) == (4, 2, 1, 1, 2, 1)
    assert got["accuracy"] == 0.25 and got["mean_similarity"] == pytest.approx(0.6)
    other = evaluation.graded(df.withColumn("lp_id", F.lit(20)), F.col("ok"), F.col("code"), taxonomy, similarity=F.col("sim"))
    assert evaluation.diagnostics(other, ["g"]).first()["blocking"] == 3  # the same code blocks on another level
    assert [(r["code"], r["n"]) for r in evaluation.error_codes(rows, ["g"], "a", 2).orderBy("rank").collect()] == [("odd", 1), ("mild", 1)]
    assert evaluation.diagnostics(evaluation.graded(df.withColumn("lp_id", F.lit("x")), F.col("ok"), F.col("code"), taxonomy), ["g"]).first()["malformed"] == 6
    verdict = evaluation.diagnostics_verdict(rows, [9, 20]).first()
    assert (verdict["total"], verdict["malformed"], verdict["missing_codes"], verdict["unknown_codes"], verdict["missing_levels"], verdict["ok"]) == (6, 2, 1, 1, [20], False)
    fine = evaluation.graded(df.where("ok = '1' and sim is null or sim = 0.5").withColumn("lp_id", F.lit(9)), F.col("ok"), F.col("code"), taxonomy)
    assert evaluation.diagnostics_verdict(fine, [9]).first()["ok"]


def test_rows_of_the_older_layout(spark):
    df = spark.createDataFrame([("a", " LP9 ", "1", "1 0", "1 0", "x"), ("b", "lp20:orphaned_preposition", "0", "1 z", "", " perte "), ("c", "autre", "0", None, None, ""), ("d", None, "oui", "z", "z", "e")], "id string, phenomenon string, is_correct string, embedding_ref string, embedding_pred string, error_label string")
    rows, issues = evaluation.legacy_rows(df)
    assert [(r["lp_id"], r["phenomenon"], r["error_code"]) for r in rows.orderBy("id").collect()] == [(9, "lexical_semantics", None), (20, "orphaned_preposition", "perte"), (None, "autre", None), (None, "unknown", None)]
    assert rows_of(issues) == [("b", "malformed_embedding_ref")]


def test_lexical(spark):
    df = spark.createDataFrame([("p1", "email", "courriel"), ("p2", "parking", "stationnement")], "pair_id string, source string, preferred string")
    grid = lexical.preference_grid(df, 10)
    rows = grid.collect()
    assert len(rows) == 2 * 4 * 10 == len({r["example_id"] for r in rows})
    assert not {r["template_id"] for r in rows if r["split"] == "dev"} & {r["template_id"] for r in rows if r["split"] == "train"}
    assert lexical.eval_prompts(df).count() == 10
    failed = df.select(F.lit("q").alias("prompt_id"), F.col("pair_id").alias("lexical_pair_id"), F.lit("direct_preference").alias("task_type"), "source", "preferred", F.array("source").alias("forbidden")).limit(1)
    mined = lexical.mined_examples(failed, 3, {"direct_preference": 1.5})
    assert 2 <= mined.count() <= 4
    assert lexical.mined_examples(failed, 3, {"direct_preference": 1.5}, most=2).count() == 2
    last = lexical.latest_by_key(spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "k string, o int, v string"), "k", ["o"]).first()
    assert last["v"] == "y"


def test_minimal_pairs(spark):
    rows = [("1", "Une bonne phrase.", "Une mauvaise phrase."), ("2", "une bonne  phrase.", "Une mauvaise phrase."), ("3", "", "x"), ("4", "La même phrase ici", "la même phrase ici"), ("5", "La même phrase ici!", "La même phrase ici."), ("6", "m" * 300, "Une autre phrase")]
    got = {}
    for r in pairs.issues(spark.createDataFrame(rows, "id string, good string, bad string"), banned=["autre"]).collect():
        got.setdefault(r["id"], set()).add(r["issue"])
    assert got == {"2": {"duplicate_pair"}, "3": {"empty_side", "too_short"}, "4": {"identical_pair"}, "5": {"punctuation_only_change"}, "6": {"too_long", "forbidden_ngram"}}


def test_pairs_against_their_contrasts(spark):
    contrasts = spark.createDataFrame([(20, "c1", "avec", "sans", ["La personne {positive_pattern} qui je parle."], ["La personne que je parle {negative_pattern}."], "soutenu", ["qui"], ["avec"], "stranded_preposition")], "lp_id int, contrast_id string, positive_pattern string, negative_pattern string, good_templates array<string>, bad_templates array<string>, register string, required_good array<string>, forbidden_bad array<string>, focus string")
    true = pairs.expand(contrasts).withColumn("register", F.lit("soutenu")).withColumn("phenomenon", F.lit("p"))
    assert pairs.context_issues(true, contrasts, "p").collect() == []
    one = true.first()
    rows = [(one["id"], 20, "c1", one["good"], one["bad"], "familier", "q"), ("x", 9, "c1", "court", "avec", "soutenu", "p"), ("y", 20, "c9", "a", "b", None, "p"), ("z", 20, "c1", None, None, "soutenu", "p")]
    forged = spark.createDataFrame(rows, "id string, lp_id int, contrast_id string, good string, bad string, register string, phenomenon string")
    got = {}
    for r in pairs.context_issues(forged, contrasts, "p").collect():
        got.setdefault(r["id"], set()).add(r["issue"].removeprefix("context_"))
    assert got[one["id"]] == {"register_mismatch", "phenomenon_mismatch"}
    assert got["x"] == {"lp_id_mismatch", "unauthorized_pair", "stable_id_mismatch", "missing_positive_pattern", "missing_negative_pattern", "missing_required_good_substring", "forbidden_bad_substring", "lp20_too_short", "lp20_missing_preposition_focus", "lp20_missing_negative_focus"}
    assert got["y"] == {"unknown_contrast"}
    assert "unauthorized_pair" in got["z"]
    lp9 = spark.createDataFrame([("1", "9", "Un week-end ici même", "Une fin de semaine", "fin de semaine", "week-end"), ("2", "neuf", "Une phrase e\u0301crite", "Une autre phrase", None, None)], "id string, lp_id string, good string, bad string, positive_pattern string, negative_pattern string")
    assert rows_of(pairs.issues(lp9)) == [("1", "missing_negative_pattern", True), ("1", "missing_positive_pattern", True), ("1", "neutralization_good", True), ("2", "invalid_lp_id", True), ("2", "non_nfc", False)]


def test_rules_and_audit(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "a b")], "i int, text string")
    named = [("odd", F.col("i") % 2 == 1), ("empty", F.col("text").isNull())]
    assert [r["outcome"] for r in rules.route(df, named).orderBy("i").collect()] == ["odd", "empty", "odd"]
    assert rows_of(rules.violations(df, "i", named)) == [(1, "odd"), (2, "empty"), (3, "odd")]
    counts = audit.count_by(df, ["text"])
    assert rows_of(counts) == [("text", "a b", 2), ("text", "unknown", 1)]
    assert audit.max_share(counts).first()["max_share"] == pytest.approx(2 / 3)
    one = audit.content_hash(df, ["i", "text"]).first()
    assert one == audit.content_hash(df.orderBy(F.desc("i")).repartition(3), ["i", "text"]).first()
    assert one["content_sha256"] != audit.content_hash(df.limit(2), ["i", "text"]).first()["content_sha256"]
    ready = audit.readiness(df).first()
    assert (ready["records"], ready["duplicate_exact"], ready["level"]) == (3, 1, "insufficient")


def test_instruct_empty_and_null_texts(spark):
    df = spark.createDataFrame([(1, None), (2, " "), (3, "Bonjour, mon email est là. Merci.")], "i int, text string")
    made = instruct.examples(df, "i", ["i"], 3).collect()
    assert {r["i"] for r in made} == {3} and [r["task_type"] for r in sorted(made, key=lambda r: r["rank"])] == ["summarize", "style_rewrite", "qa_from_context"]


def test_instruct_replacements_are_found_in_any_spelling(spark):
    texts = ["Un EMAIL ici.", "un ſhopping.", "le par\u212aing.", "Un Téléphone Portable.", "Le PARKİNG ouvert.", "Un emaıl.", "emailing", "rien à changer"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r["i"]: r["messages"][2]["content"] for r in instruct.candidates(df, "i", strategies=("normalize",)).collect()}
    want = {r["i"]: r["n"] for r in df.select("i", "text", X.clean(X.replace_words("text", instruct.REPLACEMENTS)).alias("n")).where("n <> text").collect()}
    assert got == want and {0, 1, 2, 3} <= set(got) and not {6, 7} & set(got)
