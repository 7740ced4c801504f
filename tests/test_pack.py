import pytest
from pyspark.sql import functions as F

from boreal.operators import audit, balance, gates, lexical, manifests, pack, splits
from boreal.sources import readers

SCHEMA = "input_ord int, record_id string, source_id string, source_family string, source_input string, text string, domain string, license_status string, commercial_use string, allowed_for_training boolean, holdout_only boolean, requires_review boolean, extra string"


def rows(*changes):
    base = {"input_ord": 0, "record_id": "r", "source_id": "s", "source_family": "f", "source_input": "i", "text": "Une phrase assez longue pour passer.", "domain": "d", "license_status": "open_compatible", "commercial_use": "allowed", "allowed_for_training": None, "holdout_only": None, "requires_review": False, "extra": "clash"}
    return [tuple({**base, "record_id": f"r{i}", **c}.values()) for i, c in enumerate(changes)]


def reasons_of(spark, policy, *changes, grants=None):
    df = pack.standard_records(spark.createDataFrame(rows(*changes), SCHEMA))
    return [r["reason"] for r in pack.judged(df, policy, grants).orderBy("record_id").collect()]


def test_reject_reasons_come_in_order(spark):
    policy = pack.PackPolicy(min_chars=10, max_chars=60, reject_unknown_use=True)
    text = lambda k: f"Une phrase numéro {k} assez longue."
    changes = [
        {"text": None}, {"text": " \n "}, {"text": "court"}, {"text": "x" * 61}, {"text": text(1), "holdout_only": True, "allowed_for_training": False},
        {"text": text(2), "allowed_for_training": False}, {"text": text(3), "commercial_use": None}, {"text": text(4), "commercial_use": "permission_required", "requires_review": True},
        {"text": text(5), "commercial_use": "permission_required"}, {"text": text(6)}, {"text": "  " + text(6)}, {"text": text(6).upper()},
    ]
    want = ["empty_text", "empty_text", "text_too_short", "text_too_long", "holdout_material", "allowed_for_training_false", "commercial_not_safe", "permission_required_without_grant", None, None, "duplicate_exact_text", "duplicate_normalized_text"]
    got = [r for r in reasons_of(spark, policy, *changes[:10])] + reasons_of(spark, policy, *changes[9:])[1:]
    assert got == want
    grants = spark.createDataFrame([("s",), ("s",), (None,)], "source_id string")
    assert reasons_of(spark, policy, changes[7], grants=grants) == [None]
    production = pack.PackPolicy(mode="production_commercial", min_chars=10)
    assert reasons_of(spark, production, {"commercial_use": "unknown"}, {"license_status": "unclear"}, {"text": text(7)}) == ["commercial_mode_reject"] * 2 + [None]
    exact = pack.PackPolicy(min_chars=10, reject_duplicate_normalized=False)
    assert reasons_of(spark, exact, changes[9], changes[10], changes[11]) == [None, "duplicate_exact_text", None]
    with pytest.raises(ValueError):
        pack.PackPolicy(mode="odd")
    with pytest.raises(ValueError):
        pack.PackPolicy(source_share=0.0)


def test_caps_and_rejections(spark):
    changes = [{"source_id": "big", "source_input": "a", "text": f"Texte numéro {i} de la grande source."} for i in range(30)] + [{"source_id": f"s{i}", "source_input": "b", "source_family": "g", "text": f"Texte numéro {i} d'une petite source."} for i in range(10)]
    df = pack.standard_records(spark.createDataFrame(rows(*changes), SCHEMA))
    policy = pack.PackPolicy(min_chars=5, input_shares={"a": 0.7}, source_share=0.5)
    judged = pack.judged(df, policy)
    kept = pack.accepted(judged, policy)
    assert kept.where("source_id = 'big'").count() == 10 and kept.count() == 20
    assert {r["reason"]: r["n"] for r in pack.rejections(judged, kept).collect()} == {"downsample_share": 20}
    again = pack.accepted(pack.judged(df.repartition(7), policy), policy)
    assert {r["record_id"] for r in again.collect()} == {r["record_id"] for r in kept.collect()}
    ready = pack.commercial_readiness(kept, pack.rejections(judged, kept), policy).first()
    assert not ready["ready"] and ready["reasons"] == ["pack_mode_local_research_blocks_commercial_release"]
    production = pack.PackPolicy(mode="production_commercial", min_chars=5)
    assert pack.commercial_readiness(kept, pack.rejections(judged, kept), production).first()["ready"]
    empty = pack.judged(df.limit(0), policy)
    assert pack.accepted(empty, policy).collect() == [] and pack.rejections(empty, pack.accepted(empty, policy)).collect() == []


def test_metrics_of_a_pack(spark):
    df = spark.createDataFrame([("e1", "a", "literary", "d", "r", "summarize", "o", "allowed", "un mot", "train"), ("e2", "a", None, "d", None, "preserve_raw", "o", "permission_required", "un mot", "dev")], "example_id string, source_id string, source_family string, domain string, register string, task_type string, license_status string, commercial_use string, text string, split string")
    row = pack.metrics(df, pack.PackPolicy(source_share=0.5)).first()
    assert (row["examples"], row["train_examples"], row["test_examples"], row["sources"], row["registers"]) == (2, 1, 0, 1, 2)
    assert row["blockers"] == ["single_source_dominance"] and row["level"] == "insufficient" and row["instruction_ratio"] == 0.5
    high = pack.metrics(df, pack.PackPolicy(source_share=0.5, levels=(("production_lora_candidate", 1),))).first()
    assert high["level"] == "production_blocked" and "low_domain_diversity_for_pilot" in high["blockers"]
    none = pack.metrics(df.limit(0), pack.PackPolicy()).first()
    assert none["blockers"] == ["no_examples_generated"] and none["level"] == "insufficient"


def test_audit_of_nothing_and_of_holdout(spark):
    schema = "source_id string, domain string, register string, text string, source_type string, license_status string, commercial_use string, holdout_only boolean"
    none = audit.corpus_audit(spark.createDataFrame([], schema)).first()
    assert none["blockers"] == ["no_records"] and none["level"] == "insufficient" and none["max_source_share"] == 0
    one = audit.corpus_audit(spark.createDataFrame([("a", "literary", None, None, None, None, None, True)], schema)).first()
    assert one["blockers"] == ["holdout_contamination_risk"] and "less_literary" in one["recommendations"]


def test_routes_and_gates(spark):
    df = spark.createDataFrame([("future_remote", True, None, "gold", "active", "x"), ("local_text", None, None, None, "catalog_only", "x"), ("local_text", True, True, None, "holdout_only", "x"), ("evaluation_holdout", True, False, "quarantine", None, "x"), ("permission_required", True, False, "gold", None, "x"), ("github_dataset", True, False, "gold", None, "y"), ("web", True, False, "gold", None, "x"), (None, None, None, None, None, None)], "source_type string, allowed_for_training boolean, requires_review boolean, quality_tier string, acquisition_status string, adapter string")
    got = [(r["e"], r["a"]) for r in df.select(gates.source_eligibility(df).alias("e"), gates.acquisition_route(df, ["x"]).alias("a")).collect()]
    assert got == [("future_remote", "x"), ("not_allowed_for_training", "skip:catalog_only"), ("requires_review", "holdout"), ("quality_tier_quarantine", "holdout"), (None, "skip:permission_required"), (None, "skip:catalog_only"), (None, "x"), ("not_allowed_for_training", "skip:unsupported_adapter")]
    packages = spark.createDataFrame([("blocked", "unclear"), ("blocked", "open_compatible"), ("noncommercial_only", "open_compatible"), ("open_compatible", "x")], "p string, s string")
    assert [r["ok"] for r in packages.select(gates.package_allowed(F.col("p"), F.col("s")).alias("ok")).collect()] == [True, False, True, True]
    ext = spark.createDataFrame([("catalog_only", None, True), ("x", "audio", True), ("x", None, False), ("x", "text", True)], "adapter string, modality string, allowed_for_training boolean").withColumn("license_reviewed", F.lit(True))
    assert [r["d"] for r in ext.select(gates.catalogue_decision(ext, "training").alias("d")).collect()] == ["catalog_only_requires_future_adapter_or_review", "unsupported_modality_audio", "not_allowed_for_training", "selected"]
    with pytest.raises(ValueError):
        gates.catalogue_decision(ext, "other")
    levels = spark.createDataFrame([("pilot_lora_candidate",), ("production_blocked",), (None,)], "level string")
    assert [r["x"] for r in levels.select(gates.level_at_least(F.col("level"), "smoke_test").alias("x")).collect()] == [True, False, False]
    stages = spark.createDataFrame([("b", False, True), ("a", None, None), ("c", False, False), ("d", True, True)], "stage string, passed boolean, blocking boolean")
    assert tuple(gates.stage_verdict(stages).first()) == (4, ["a", "b"], False)
    status = spark.createDataFrame([("downloaded",), ("failed",), ("cached",)], "status string")
    assert [tuple(gates.download_verdict(status, n, p).first()) for n, p in ((2, True), (3, True), (2, False))] == [(2, 1, True, True), (2, 1, False, False), (2, 1, False, False)]
    drop = spark.createDataFrame([("0.8", "0.6"), ("0", "1"), ("1", "2"), (None, "x")], "b string, a string")
    assert [(r["drop_ratio"], r["rollback_required"], r["issue"]) for r in gates.drop_monitor(drop, "b", "a", 0.1).collect()] == [(0.25, True, None), (None, None, "before_out_of_range"), (None, None, "after_out_of_range"), (None, None, "before_out_of_range")]
    reports = spark.createDataFrame([(True, 5)], "ok boolean, examples bigint")
    assert gates.pack_audit(reports).first()["examples"] == 5
    assert gates.pack_audit(reports.limit(0)).first()["blockers"] == ["missing_report"]


def test_row_gates_refuse_loudly(spark):
    df = spark.createDataFrame([("accepted", 0.5, ["x"], "p", "texte"), ("accepted", 0.5, ["x"], "p", " "), ("rejected", None, None, None, None)], "curation_label string, curation_score double, curation_reasons array<string>, policy_id string, text string")
    assert [r["g"] for r in df.select(gates.curated_row_gate(df).alias("g")).collect()] == [None, "empty", "not_accepted"]
    assert [r["v"] for r in df.select(gates.split_input_violations(df).alias("v")).collect()] == [[], [], ["unexpected_label", "missing_policy_id", "missing_curation_score", "missing_curation_reasons"]]
    with pytest.raises(ValueError, match="not_accepted: 1"):
        gates.gate_rows(df, gates.curated_row_gate(df), ["empty"])
    good = df.where("policy_id is not null")
    assert gates.gate_rows(good, gates.curated_row_gate(good), ["empty"]).count() == 1
    rows_ = spark.createDataFrame([("t", None, None), (None, [("user", "")], None), (" ", None, None), ("t", None, True)], "text string, messages array<struct<role:string,content:string>>, holdout_only boolean")
    assert [r["g"] for r in rows_.select(gates.pack_row_gate(rows_).alias("g")).collect()] == [None, "malformed_messages", "empty", "holdout"]


def test_inputs_limits_and_counts(spark):
    one = spark.createDataFrame([("x",)], "text string")
    both = readers.ordered_inputs([readers.Input("b", one, "f", 2), readers.Input("a", one, "f", 1), readers.Input("c", None, "f", 0, required=False)])
    assert [(r["source_input"], r["input_ord"]) for r in both.orderBy("input_ord").collect()] == [("a", 0), ("b", 1)]
    with pytest.raises(ValueError, match="missing inputs: z"):
        readers.ordered_inputs([readers.Input("z", None, "f")])
    df = spark.createDataFrame([(i, "s", 2 if i < 3 else None) for i in range(6)], "i int, s string, own int")
    assert sorted(r["i"] for r in balance.limit_per_source(df, "s", ["i"], 4, F.col("own")).collect()) == [0, 1, 3]
    assert balance.limit_per_source(df, "s", ["i"]).count() == 6
    assert splits.curated_counts(3, {"train": 0.1, "dev": 0.5, "test": 0.4}) == ({"train": 1, "dev": 0, "test": 2}, [])
    assert splits.curated_counts(3, {"train": 0.1, "dev": 0.5, "test": 0.4}, False)[1] == ["empty_dev_or_test"]
    assert splits.curated_counts(0, {"train": 0.9, "dev": 0.05, "test": 0.05})[0] == {"train": 0, "dev": 0, "test": 0}


def test_overrides_and_least_coverage(spark):
    failed = spark.createDataFrame([("q1", "01:email", "rewrite", "email", "courriel", ["email"]), ("q2", "02:x", "odd", "x", "y", ["x"])], "prompt_id string, lexical_pair_id string, task_type string, source string, preferred string, forbidden array<string>")
    over = spark.createDataFrame([("email", "courrier", [], True)], "pair_key string, preferred string, forbidden array<string>, digital boolean")
    own = {r["prompt_id"]: r for r in lexical.with_overrides(failed, over).collect()}
    assert own["q1"]["preferred"] == "courrier" and own["q1"]["forbidden"] == ["email"] and own["q1"]["digital"] and not own["q2"]["digital"]
    few = lexical.mined_examples(failed, 1)
    assert few.count() == 1
    more = lexical.mined_examples(failed, 1, least_per_pair=3)
    assert more.where("lexical_pair_id = '01:email'").count() in (2, 3) and more.select("example_text").distinct().count() == more.count()
    assert lexical.mined_examples(failed.limit(0), 2, least_per_pair=2).collect() == []
    assert lexical.next_focus(failed, ["rewrite", "correction"], ["email"]).first()["focus"] == ["rewrite", "email"]
    assert lexical.next_focus(failed.limit(0), ["rewrite"], []).first()["focus"] == ["broad"]
    terms = spark.createDataFrame([(["Email", "mail"], "email"), (["Email"], "email"), ([], "email"), (None, "email")], "r array<string>, p string")
    assert [r["t"] for r in terms.select(lexical.rejected_term(F.col("r"), F.col("p")).alias("t")).collect()] == ["mail", "Email", "email", "email"]


def test_manifest_constraints(spark):
    df = spark.createDataFrame([("a", True, False, "data/x", "active", "open"), ("a", True, True, "../x", "active", None), (None, None, None, "/x", None, None), ("Ä b", False, None, "c:x", "x", "unclear")], "source_id string, allowed_for_training boolean, holdout_only boolean, source_path string, acquisition_status string, license_status string")
    got = {}
    for r in manifests.source_violations(df, allowed={"acquisition_status": ["active"]}).collect():
        got.setdefault(r["source_id"], []).append(r["violation"])
    assert sorted(got["a"]) == ["active_with_unclear_license", "path_leaves_folder", "repeated_id", "repeated_id", "training_on_holdout"]
    assert got[None] == ["missing_id", "path_leaves_folder"] and got["Ä b"] == ["malformed_id", "unknown_acquisition_status", "path_leaves_folder"]
    pairs = spark.createDataFrame([("1", "email", "courriel", ["email"]), ("2", "x", "y", ["y"]), ("3", " ", None, None)], "pair_id string, source string, preferred string, rejected array<string>")
    assert sorted((r["pair_id"], r["violation"]) for r in manifests.pair_violations(pairs).collect()) == [("2", "preferred_rejected"), ("2", "source_not_rejected"), ("3", "blank_term"), ("3", "source_not_rejected")]
    ratios = spark.createDataFrame([("ok", 0.9, 0.1), ("sum", 0.9, 0.2), ("neg", 1.1, -0.1), ("nul", None, 1.0)], "k string, a double, b double")
    assert sorted((r["k"], r["violation"]) for r in manifests.share_violations(ratios, "k", ["a", "b"]).collect()) == [("neg", "ratio_a"), ("neg", "ratio_b"), ("nul", "ratio_a"), ("sum", "ratio_sum")]
    steps = spark.createDataFrame([("ok", 1.0, 0.5), ("up", 0.5, 1.0), ("nan", float("nan"), 0.1)], "k string, a double, b double")
    assert sorted((r["k"], r["violation"]) for r in manifests.descending_violations(steps, "k", ["a", "b"]).collect()) == [("nan", "not_finite_a"), ("up", "ascends_b")]
    codes = spark.createDataFrame([(9, "a", "minor"), (9, "a", "odd"), (21, " ", None)], "lp_id int, error_code string, severity string")
    assert len(manifests.taxonomy_violations(codes).collect()) == 6


def test_command_line(spark, tmp_path, capsys):
    from boreal import __main__ as cli

    assert cli.main(["list"]) == 0 and "pack_accepted" in capsys.readouterr().out
    assert cli.main(["run", "no_such_query", "x"]) == 2
    (tmp_path / "a.txt").write_text("Une première ligne assez longue.\nUne première ligne assez longue.\ncourt\n", encoding="utf-8")
    assert cli.main(["harvest", str(tmp_path / "a.txt"), "--out", str(tmp_path / "h.parquet")]) == 0
    assert spark.read.parquet(str(tmp_path / "h.parquet")).count() == 1
    assert cli.main(["split", str(tmp_path / "h.parquet"), "--key", "id", "--out", str(tmp_path / "s")]) == 0
    assert spark.read.json(str(tmp_path / "s")).count() == 1
