"""Queries of the training pack, of routing and of gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from boreal.operators import audit, balance, gates, manifests, pack, splits
from boreal.plans import corpus, examples, sqltext as S
from boreal.session import table
from boreal.sources import catalogue, readers

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        Q[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


# --- the pack ---------------------------------------------------------------------------------------------------------

POLICY = pack.PackPolicy(min_chars=200, max_chars=4000, reject_unknown_use=True, input_shares={"debates": 0.6, "portal": 0.55}, source_share=0.25, family_share=0.52)
_FIELDS = "record_id, source_id, text, language, register, domain, license_status, commercial_use, source_type, allowed_for_training, holdout_only, requires_review, ingested_at"
_STANDARD = f"""raw as (select 0 as input_ord, 'portal' as source_input, 'catalogue' as source_family, {_FIELDS} from donnees_quebec_fixture_harvest union all select 1, 'debates', 'parliament', {_FIELDS} from assnat_fixture_harvest),
named as (select input_ord, source_input, source_family, ingested_at, coalesce({S.clean('text')}, '') as text, coalesce(nullif(source_id, ''), source_family) as source_id, nullif(record_id, '') as own, coalesce(nullif(license_status, ''), 'unknown') as license_status,
 coalesce(nullif(commercial_use, ''), 'unknown') as commercial_use, coalesce(nullif(source_type, ''), 'unknown') as source_type, coalesce(allowed_for_training, true) as allowed, coalesce(holdout_only, false) as held, coalesce(requires_review, false) as review from raw),
standard as (select *, coalesce(own, substr(sha256(source_id || ':' || text), 1, 24)) as record_id, sha256(text) as exact, sha256({S.norm('text')}) as norm from named),
ruled as (select *, license_status = 'noncommercial_only' or commercial_use = 'permission_required' as noncommercial, commercial_use = 'permission_required' or license_status = 'permission_required' or source_type = 'permission_required' or review as permission,
 source_id in (select source_id from dev where source_id is not null) as granted from standard),
judged as (select *, case when text = '' then 'empty_text' when length(text) < 200 then 'text_too_short' when length(text) > 4000 then 'text_too_long' when held then 'holdout_material' when not allowed then 'allowed_for_training_false'
 when commercial_use in ('unknown', 'prohibited') then 'commercial_not_safe' when permission and not granted and not (noncommercial and not review) then 'permission_required_without_grant' end as rule from ruled),
firsts as (select *, row_number() over (partition by norm order by input_ord, record_id, ingested_at, exact) as n, first_value(exact) over (partition by norm order by input_ord, record_id, ingested_at, exact) as lead from judged where rule is null),
reasoned as (select * exclude (n, lead), case when n = 1 then null when exact = lead then 'duplicate_exact_text' else 'duplicate_normalized_text' end as reason from firsts union all select *, rule from judged where rule is not null),
c0 as (select *, sha256('42:' || source_id || ':' || norm || ':' || record_id) as h from reasoned where reason is null)"""


def _capped(before: str, after: str, key: str, cap: str) -> str:
    """A cap in SQL: the greatest level at which every key is within its share of what is left."""
    return f"""{after}r as (select *, row_number() over (partition by {key} order by h, norm, record_id) as rank from {before}), {after}k as (select {key} as k, count(*) as n from {before} group by 1),
{after}l as (select level, (select sum(least(n, level)) from {after}k) as t from (select unnest(range(1, (select coalesce(max(n), 1) + 1 from {after}k))) as level)),
{after} as (select * exclude (rank) from {after}r where rank <= (select coalesce(max(level), 1) from {after}l where level = 1 or level <= ({cap} + 1e-9) * t))"""


_ACCEPTED = f"""with {_STANDARD},
k as (select count_if(source_input = 'debates')::bigint as d, count_if(source_input = 'portal')::bigint as p from c0),
x as (select a, b from k, (select unnest(range(0, (select d + 1 from k))) as a), (select unnest(range(0, (select p + 1 from k))) as b) where (a <= 1 or a <= (0.6 + 1e-9) * (a + b)) and (b <= 1 or b <= (0.55 + 1e-9) * (a + b))),
c1 as (select * exclude (rank) from (select *, row_number() over (partition by source_input order by h, norm, record_id) as rank from c0) where rank <= case source_input when 'debates' then (select max(a) from x) else (select max(b) from x) end),
{_capped('c1', 'c2', 'source_id', '0.25')},
{_capped('c2', 'c3', 'source_family', '0.52')}"""


def _inputs(spark, d):
    own = lambda t: table(spark, d, t).select(*_FIELDS.split(", "))
    return readers.ordered_inputs([readers.Input("debates", own("assnat_fixture_harvest"), "parliament", 2), readers.Input("portal", own("donnees_quebec_fixture_harvest"), "catalogue", 1), readers.Input("absent", None, "none", 0, required=False)])


def _judged(spark, d):
    grants = table(spark, d, "dev").select("source_id")
    return pack.judged(pack.standard_records(_inputs(spark, d)), POLICY, grants, ["input_ord", "record_id", "ingested_at", "text_sha256"])


@query(f"with {_STANDARD} select coalesce(reason, 'accepted') as reason, source_input, count(*) as n from reasoned group by 1, 2")
def pack_rejects(spark, d):
    """Why records of the two inputs are left out of a pack."""
    return _judged(spark, d).groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason"), "source_input").agg(F.count(F.lit(1)).alias("n"))


@query(f"{_ACCEPTED} select record_id, source_input, source_id, source_family, exact as text_sha256 from c3")
def pack_accepted(spark, d):
    """The records left under the caps of inputs, sources and families."""
    return pack.accepted(_judged(spark, d), POLICY).select("record_id", "source_input", "source_id", "source_family", "text_sha256")


@query(
    f"""{_ACCEPTED}, rej as (select reason from reasoned where reason is not null) select *, array_to_string(list_filter(['pack_mode_local_research_blocks_commercial_release', case when noncommercial > 0 then 'contains_noncommercial_records' end,
case when permission_required > 0 then 'contains_permission_required_records' end, case when exists (select 1 from rej where reason = 'commercial_not_safe') then 'commercial_safety_filters_triggered' end], lambda x: x is not null), ' ') as reasons, false as ready
from (select count_if(noncommercial) as noncommercial, count_if(permission) as permission_required from c3)"""
)
def commercial_readiness(spark, d):
    """Whether a pack may be sold, and what speaks against it."""
    judged = _judged(spark, d)
    kept = pack.accepted(judged, POLICY)
    return pack.commercial_readiness(kept, pack.rejections(judged, kept), POLICY).withColumn("reasons", F.array_join("reasons", " "))


@query(f"{_ACCEPTED} select reason, n from (select reason, count(*) as n from reasoned where reason is not null group by 1 union all select 'downsample_share', (select count(*) from c0) - (select count(*) from c3)) where n > 0")
def pack_rejections(spark, d):
    """All records left out, those the caps took included."""
    judged = _judged(spark, d)
    return pack.rejections(judged, pack.accepted(judged, POLICY))


_SMALL = pack.PackPolicy(source_share=0.05, family_share=0.5, pilot_domains=40, pilot_registers=2, production_examples=1_000_000, levels=(("production_lora_candidate", 300_000), ("pilot_lora_candidate", 20_000), ("smoke_test", 500)))


@query(
    f"""with e as (select * from {S.EXAMPLES}), c as (select 'source_id' as key, coalesce(source_id, 'unknown') as value, count(*) as n from e group by 2 union all select 'source_family', coalesce(source_family, 'unknown'), count(*) from e group by 2),
t as (select count(*) as examples, sum(cast(trunc(greatest(length(text) / 4.0, len({S.words('text')}) * 1.35)) as bigint)) as tokens, count_if(split = 'train') as train_examples, count(distinct coalesce(domain, 'unknown')) as domains, count(distinct coalesce(register, 'unknown')) as registers,
 count_if(task_type = 'preserve_raw') / count(*) as raw_share, count_if(commercial_use = 'permission_required') / count(*) as permission_share from e),
s as (select *, (select max(n) from c where key = 'source_id') / examples as max_source_share, (select max(n) from c where key = 'source_family') / examples as max_family_share, (select sum(n) from c where key = 'source_family' and not contains(lower(value), 'literary')) / examples as modern_share from t),
l as (select *, case when tokens >= 300000 then 'production_lora_candidate' when tokens >= 20000 then 'pilot_lora_candidate' when tokens >= 500 then 'smoke_test' else 'insufficient' end as base from s),
b as (select *, list_filter([case when base in ('pilot_lora_candidate', 'production_lora_candidate') and domains < 40 then 'low_domain_diversity_for_pilot' end, case when base in ('pilot_lora_candidate', 'production_lora_candidate') and registers < 2 then 'low_register_diversity_for_pilot' end,
 case when max_source_share > 0.05 + 1e-9 then 'single_source_dominance' end, case when max_family_share > 0.5 + 1e-9 then 'single_source_family_dominance' end, case when max_family_share >= 0.75 then 'source_family_dominance' end, case when modern_share < 0.2 then 'insufficient_modern_diversity' end,
 case when base = 'production_lora_candidate' and examples < 1000000 then 'insufficient_instruction_examples_for_production' end], lambda x: x is not null) as blockers,
 list_filter(['more_instructions_and_diversity', case when permission_share > 0.3 then 'secure_commercial_sources' end, case when raw_share > 0.8 then 'more_instruction_variety' end, case when 1 - raw_share < 0.5 then 'more_instruction_strategies' end, 'rerun_for_release'], lambda x: x is not null) as advice from l)
select examples, tokens::bigint as tokens, train_examples, domains, registers, round(max_source_share, 9) as max_source_share, round(max_family_share, 9) as max_family_share, round(modern_share, 9) as modern_share, round(1 - raw_share, 9) as instruction_ratio,
case when base = 'production_lora_candidate' and len(blockers) > 0 then 'production_blocked' else base end as level, array_to_string(blockers, ' ') as blockers, array_to_string(advice, ' ') as recommendations from b"""
)
def pack_blockers(spark, d):
    """What the examples amount to as a pack, and what blocks it."""
    row = pack.metrics(examples._examples(spark, d), _SMALL)
    rounded = [F.round(c, 9).alias(c) for c in ("max_source_share", "max_family_share", "modern_share", "instruction_ratio")]
    return row.select("examples", "tokens", "train_examples", "domains", "registers", *rounded, "level", F.array_join("blockers", " ").alias("blockers"), F.array_join("recommendations", " ").alias("recommendations"))


@query(
    f"""select coalesce(p.mode, 'unknown') as mode, level, examples, train_examples, ok, blockers from (select 'local_research' as mode, (select count(*) from {S.EXAMPLES}) as examples, (select count(*) from train) as train_examples, 'insufficient' as level, false as ok, '' as blockers) p"""
)
def pack_audit(spark, d):
    """A report without some of its fields, as a release reads it."""
    told = examples._examples(spark, d).agg(F.count(F.lit(1)).alias("examples"), F.count_if(F.col("split") == "train").alias("train_examples")).withColumn("mode", F.lit("local_research"))
    return gates.pack_audit(told).select("mode", "level", "examples", "train_examples", "ok", F.array_join("blockers", ",").alias("blockers"))


_AUDIT = """select count(*) as records, cast(trunc(greatest(sum(length(text)) / 4.0, sum(len({w})) * 1.35)) as bigint) as tokens, count(*) - count(distinct text) as duplicate_exact, count(*) - count(distinct {n}) as duplicate_normalized, count_if(coalesce(holdout_only, false)) as holdout_risk,
count_if(license_status in ('open_compatible', 'noncommercial_only')) as legal, count_if(commercial_use = 'allowed') as commercial, count_if(license_status = 'noncommercial_only') as noncommercial, count_if(lower(domain) in ({i})) as institutional, count_if(lower(source_type) in ({m})) as modern, count_if(domain = 'literary') as literary,
count(distinct coalesce(domain, 'unknown')) as domains, count(distinct coalesce(register, 'unknown')) as registers, (select max(n) from (select count(*) as n from r group by coalesce(source_id, 'unknown'))) / count(*) as max_source_share from r""".format(
    w=S.words("text"), n=S.norm("text"), i=", ".join(S.quote(x) for x in audit.INSTITUTIONAL), m=", ".join(S.quote(x) for x in audit.MODERN)
)


@query(
    f"""with r as (select coalesce(text, '') as text, * exclude (text) from donnees_quebec_fixture_harvest), a as ({_AUDIT}),
l as (select *, case {' '.join(f"when tokens >= {n} then '{k}'" for k, n in audit.LEVELS)} else 'insufficient' end as level from a)
select * replace (round(max_source_share, 9) as max_source_share), case when holdout_risk > 0 then 'holdout_contamination_risk' else '' end as blockers, array_to_string(list_filter(['more_modern_sources', case when literary / records >= 0.5 then 'less_literary' end,
case when institutional / records >= 0.6 then 'less_administrative' end, case when noncommercial / records >= 0.4 then 'secure_commercial_sources' end, 'more_instructions'], lambda x: x is not null), ' ') as recommendations from l"""
)
def corpus_audit(spark, d):
    """The catalogue records as a corpus: balances, duplicates, level, blockers and advice."""
    row = audit.corpus_audit(corpus._records(spark, d)).drop("instructions")
    return row.withColumns({"max_source_share": F.round("max_source_share", 9), "blockers": F.array_join("blockers", " "), "recommendations": F.array_join("recommendations", " ")})


# --- routing ------------------------------------------------------------------------------------------------------------


@query(
    """select case when source_type = 'future_remote' then 'future_remote' when not coalesce(allowed_for_training, false) then 'not_allowed_for_training' when coalesce(requires_review, false) then 'requires_review'
when 'holdout' in (select unnest(quality_flags)) then 'contains_holdout_material' when coalesce(quality_flags[1], '') = 'quarantine' then 'quality_tier_quarantine' else 'read' end as outcome, count(*) as n from donnees_quebec_fixture_harvest group by 1"""
)
def source_eligibility(spark, d):
    """Records as sources: which are read, and why others are not."""
    own = corpus._records(spark, d).withColumns({"contains_holdout_material": F.array_contains(F.coalesce("quality_flags", F.array().cast("array<string>")), "holdout"), "quality_tier": F.try_element_at("quality_flags", F.lit(1))})
    return own.select(F.coalesce(gates.source_eligibility(own), F.lit("read")).alias("outcome")).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


_RECORDS = "(select acquisition_status, source_type, adapter from donnees_quebec_fixture_harvest union all select acquisition_status, source_type, adapter from assnat_fixture_harvest)"


@query(
    f"""select case when acquisition_status in ('catalog_only', 'blocked_license') then 'skip:' || acquisition_status when source_type = 'evaluation_holdout' or acquisition_status = 'holdout_only' then 'holdout' when source_type = 'permission_required' then 'skip:permission_required'
when adapter in ('donnees_quebec_ckan', 'assnat_journal_debats', 'local_text_bundle') then adapter when source_type = 'github_dataset' then 'skip:catalog_only' else 'skip:unsupported_adapter' end as route, count(*) as n from {_RECORDS} group by 1"""
)
def acquisition_routes(spark, d):
    """Records of both harvests as sources: the adapter that acquires each."""
    own = corpus._records(spark, d).select("acquisition_status", "source_type", "adapter").union(corpus._pages(spark, d).select("acquisition_status", "source_type", "adapter"))
    return own.select(gates.acquisition_route(own, ["donnees_quebec_ckan", "assnat_journal_debats", "local_text_bundle"]).alias("route")).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""select license_class, license_status, case license_class when 'blocked' then coalesce(license_status in ('permission_required', 'unclear'), false) when 'unknown' then coalesce(license_status in ('permission_required', 'unclear'), false)
when 'noncommercial_only' then coalesce(license_status in ('permission_required', 'unclear', 'open_compatible', 'noncommercial_only'), false) else true end as allowed, count(*) as n from
({corpus._license_sql().split(' as n from ', 1)[1].rsplit(') group by 1', 1)[0].replace("(select case", "(select license_status, case", 1).replace("from (select lower", "from (select license_status, lower", 1).lstrip('(')}) group by all"""
)
def package_routing(spark, d):
    """Whether a package may be taken, by its own licence and its source's status."""
    own = corpus._records(spark, d).select("license_status", catalogue.license_class(F.col("license_id"), F.col("license_name"), F.col("license_url")).alias("license_class"))
    told = own.withColumn("allowed", F.coalesce(gates.package_allowed(F.col("license_class"), F.col("license_status")), F.lit(False)))
    return told.groupBy("license_class", "license_status", "allowed").agg(F.count(F.lit(1)).alias("n"))


_DECISIONS = {
    "training": "when not coalesce(allowed_for_training, false) then 'not_allowed_for_training' when coalesce(holdout_only, false) or coalesce(allowed_for_evaluation, false) then 'benchmark_or_holdout_blocked_from_training'",
    "evaluation": "when not coalesce(allowed_for_evaluation, false) then 'not_allowed_for_evaluation'",
    "all-safe": "when coalesce(holdout_only, false) then 'holdout_excluded_from_all_safe' when not coalesce(allowed_for_training, false) then 'all_safe_only_materializes_training_allowed_sources'",
}


@query(
    " union all ".join(
        f"select '{m}' as mode, case when adapter = 'catalog_only' then 'catalog_only_requires_future_adapter_or_review' when coalesce(requires_review, false) then 'requires_review' when license_id is null then 'license_not_reviewed' {c} else 'selected' end as decision, count(*) as n from donnees_quebec_fixture_harvest group by 2"
        for m, c in _DECISIONS.items()
    )
)
def catalogue_decisions(spark, d):
    """Which records as datasets are materialized in each mode."""
    own = corpus._records(spark, d).withColumn("license_reviewed", F.col("license_id").isNotNull())
    modes = F.array(*[F.struct(F.lit(m).alias("mode"), gates.catalogue_decision(own, m).alias("decision")) for m in _DECISIONS])
    return own.select(F.inline(modes)).groupBy("mode", "decision").agg(F.count(F.lit(1)).alias("n"))


@query("select record_id, ingested_at, commercial_use = 'permission_required' and source_id not in (select source_id from dev where source_id is not null) as lacks_grant from donnees_quebec_fixture_harvest where source_id is not null and commercial_use is not null")
def permission_grants(spark, d):
    """Records that need a permission their source lacks: a join with the granted sources."""
    own = pack.with_grants(corpus._records(spark, d).where("source_id is not null and commercial_use is not null"), table(spark, d, "dev"))
    return own.select("record_id", "ingested_at", ((F.col("commercial_use") == "permission_required") & ~F.col("granted")).alias("lacks_grant"))


@query("select record_id, ingested_at, source_id from (select *, row_number() over (partition by source_id order by ingested_at, record_id) as n from donnees_quebec_fixture_harvest where source_id is not null) where n <= least(8, coalesce(greatest(resource_count, 1), 8))")
def limited_sources(spark, d):
    """At most eight records a source, and no more than a record's own limit: the limit is the feature here."""
    own = corpus._records(spark, d).where("source_id is not null")
    kept = balance.limit_per_source(own, "source_id", ["ingested_at", "record_id"], 8, F.greatest("resource_count", F.lit(1)))
    return kept.select("record_id", "ingested_at", "source_id")


# --- gates --------------------------------------------------------------------------------------------------------------

_BAD_TURN = "len(messages) = 0 or len(list_filter(messages, lambda m: coalesce({r}, '') = '' or coalesce({c}, '') = '')) > 0".format(r=S.clean("m['role']"), c=S.clean("m['content']"))


@query(
    f"""select gate, warned, count(*) as n from (select case when coalesce(holdout_only, false) then 'holdout' when not coalesce(allowed_for_training, true) then 'not_allowed_for_training' when coalesce(requires_review, false) then 'review_without_permission'
when messages is not null and ({_BAD_TURN}) then 'malformed_messages' when coalesce({S.clean('text')}, '') = '' and messages is null then 'empty' else 'passed' end as gate, lower({S.clean("coalesce(commercial_use, '')")}) in ('permission_required', 'prohibited', 'unknown') as warned from {S.EXAMPLES}) group by all"""
)
def trainer_gate(spark, d):
    """Rows of a pack a trainer would refuse or take with a warning."""
    own = examples._examples(spark, d)
    return own.select(F.coalesce(gates.pack_row_gate(own), F.lit("passed")).alias("gate"), gates.research_only(own).alias("warned")).groupBy("gate", "warned").agg(F.count(F.lit(1)).alias("n"))


@query(
    corpus._curation_sql(
        "select gate, violations, count(*) as n from (select case when curation_label <> 'accepted' then 'not_accepted' when doc_id % 7 = 0 then 'missing:policy_id' when coalesce({t}, '') = '' then 'empty' else 'passed' end as gate, array_to_string(list_filter([case when curation_label <> 'accepted' then 'unexpected_label' end, "
        "case when doc_id % 7 = 0 then 'missing_policy_id' end, case when len(reasons) = 0 then 'missing_curation_reasons' end], lambda x: x is not null), ' ') as violations from l join (select doc_id, text from documents) using (doc_id)) group by all".format(t=S.clean("text"))
    )
)
def curated_gate(spark, d):
    """Curated documents before a trainer and before a split; every seventh has lost its policy."""
    own = corpus._curated(spark, d).withColumn("policy_id", F.when(F.col("doc_id") % 7 != 0, "p"))
    told = own.select(F.coalesce(gates.curated_row_gate(own), F.lit("passed")).alias("gate"), F.array_join(gates.split_input_violations(own), " ").alias("violations"))
    return told.groupBy("gate", "violations").agg(F.count(F.lit(1)).alias("n"))


@query(f"select violation, count(*) as n from (select unnest(list_filter([case when coalesce({S.clean('text')}, '') = '' then 'no_text' end, case when coalesce(source_id, '') = '' then 'no_source' end, case when coalesce(holdout_only, false) then 'holdout' end, case when not coalesce(allowed_for_training, true) then 'not_allowed_for_training' end], lambda x: x is not null)) as violation from {S.EXAMPLES}) group by 1")
def export_violations(spark, d):
    own = examples._examples(spark, d)
    return audit.count_items(own.select(gates.export_row_violations(own).alias("v")), "v", "violation")


@query(f"select dialect_region, language, count_if(replace(translate(lower({S.clean('dialect_region')}), 'àâäáãåçéèêëíîïìñóôöõòúùûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '#', '') in ('quebec', 'canada_fr', 'canada-fr', 'french_canadian', 'canadian_french', 'fr_ca') and coalesce(allowed_for_training, false) and not coalesce(holdout_only, false) and not coalesce(requires_review, false)) as trusted, count(*) as n from donnees_quebec_fixture_harvest group by 1, 2")
def trusted_records(spark, d):
    """Records whose provenance is trusted, of which tier is taken as silver."""
    own = corpus._records(spark, d).withColumn("quality_tier", F.lit("Silver"))
    return own.withColumn("t", gates.trusted_provenance(own)).groupBy("dialect_region", "language").agg(F.count_if(F.coalesce("t", F.lit(False))).alias("trusted"), F.count(F.lit(1)).alias("n"))


@query(
    """with h as (select doc_id, row_number() over (order by sha256('11:' || doc_id::varchar), doc_id) as n, count(*) over () as t from documents)
select doc_id, case when n <= greatest(trunc(t * 0.0001), 1) then 'train' when n <= greatest(trunc(t * 0.0001), 1) + trunc(t * 0.5) - (case when trunc(t * 0.0001) = 0 and trunc(t * 0.5) > 0 then 1 else 0 end) then 'dev' else 'test' end as split from h"""
)
def curated_split(spark, d):
    """A split whose train share rounds to nothing: it takes a row from dev."""
    ratios = {"train": 0.0001, "dev": 0.5, "test": 0.4999}
    return splits.shuffled_split(corpus._documents(spark, d).select("doc_id"), "doc_id", 11, ratios, counting=lambda n: splits.curated_counts(n, ratios)[0]).select("doc_id", "split")


@query("select split, count(*) as rows from (select case when ('0x' || substr(sha256('7:' || doc_id::varchar), 1, 8))::bigint / 4294967295.0 < 0.8 then 'train' else 'dev' end as split from documents) group by 1")
def split_report(spark, d):
    return splits.split_report(corpus.hash_split(spark, d))


@query(f"select source, level, level in ('smoke_test', 'pilot', 'production') and level = 'smoke_test' as reaches from ({corpus._readiness_sql('source')})")
def level_reached(spark, d):
    """Which sources' texts alone reach the smoke-test level; levels of another scheme count as the lowest."""
    return corpus.readiness_by_source(spark, d).select("source", "level", gates.level_at_least(F.col("level"), "smoke_test").alias("reaches"))


@query(f"with s as (select split as stage, count_if(messages is null) = 0 as passed, split <> 'test' as blocking from {S.EXAMPLES} group by split) select count(*) as stages, array_to_string(list_sort(list(stage) filter (where blocking and not passed)), ' ') as failed, count_if(blocking and not passed) = 0 as ok from s")
def stage_verdict(spark, d):
    """One verdict over stages, here whether each split's examples have messages; test may fail."""
    stages = examples._examples(spark, d).groupBy(F.col("split").alias("stage")).agg((F.count_if(F.col("messages").isNull()) == 0).alias("passed")).withColumn("blocking", F.col("stage") != "test")
    return gates.stage_verdict(stages).withColumn("failed", F.array_join("failed", " "))


@query("with s as (select case when acquisition_status = 'active' then 'downloaded' when acquisition_status is null then 'failed' else 'cached' end as status from donnees_quebec_fixture_harvest), c as (select count_if(status <> 'failed') as available, count_if(status = 'failed') as failed from s) select available, failed, failed > 0 and available >= 10 as partial_ok, failed = 0 or available >= 10 as ok from c")
def download_verdict(spark, d):
    """Whether enough of a download came through."""
    status = F.when(F.col("acquisition_status") == "active", "downloaded").when(F.col("acquisition_status").isNull(), "failed").otherwise("cached")
    return gates.download_verdict(corpus._records(spark, d).select(status.alias("status")), 10, True)


@query(
    f"""with s as (select coalesce(task_type, 'none') as task_type, round(count_if(base_preferred) / count(*), 9) as before, round(count_if(adapter_preferred) / count(*), 9) as after from {examples._scores()} group by 1),
i as (select *, case when not (before > 0 and before <= 1) then 'before_out_of_range' when not (after >= 0 and after <= 1) then 'after_out_of_range' end as issue from s)
select task_type, before, after, case when issue is null then round((before - after) / before, 6) end as drop_ratio, case when issue is null then (before - after) / before > 0.03 end as rollback_required, issue from i"""
)
def drop_monitor(spark, d):
    """How much less often the adapter names the wanted term than the base, by task."""
    own = examples._rescored(spark, d).groupBy(F.coalesce("task_type", F.lit("none")).alias("task_type"))
    shares = own.agg(*[F.round(F.count_if(f"{s}_preferred") / F.count(F.lit(1)), 9).alias(n) for s, n in (("base", "before"), ("adapter", "after"))])
    return gates.drop_monitor(shares, "before", "after", 0.03)


@query("select count(*) as prompts, -count(*) as expected_score from eval_prompts")
def expected_baseline(spark, d):
    return gates.expected_baseline(table(spark, d, "eval_prompts"))


@query("select doc_id, array_to_string(list_filter([case when contains(lower(coalesce(lang, '')), 'fr_fr') then 'fr_fr' end, case when contains(lower(coalesce(lang, '')), 'fr-fr') then 'fr-fr' end], lambda x: x is not null), ' ') as banned from documents")
def banned_wording(spark, d):
    """Words that may not stand in a card, looked for in the labels of documents."""
    return corpus._documents(spark, d).select("doc_id", F.array_join(gates.banned_wording(F.col("lang")), " ").alias("banned"))


@query(f"select fetched, count(*) as n from (select case when license_status = 'noncommercial_only' then 'noncommercial_not_included' else 'fetched' end as fetched from donnees_quebec_fixture_harvest) group by 1")
def fetch_gate(spark, d):
    own = corpus._records(spark, d)
    gate = gates.fetch_gate(F.coalesce(F.col("license_status") == "noncommercial_only", F.lit(False)), False, 25)
    return own.select(F.coalesce(gate, F.lit("fetched")).alias("fetched")).groupBy("fetched").agg(F.count(F.lit(1)).alias("n"))


_SOURCE_RULES = {
    "missing_id": "coalesce(record_id, '') = ''",
    "malformed_id": "coalesce(record_id, '') <> '' and not regexp_matches(record_id, '^[a-z0-9][a-z0-9_\\-]*$')",
    "repeated_id": "coalesce(record_id, '') <> '' and times > 1",
    "unknown_commercial_use": "commercial_use is not null and commercial_use not in ('allowed', 'unknown')",
    "training_on_holdout": "coalesce(allowed_for_training, false) and coalesce(holdout_only, false)",
    "personal_data_without_review": "coalesce(pii_risk, '') in ('high', 'contains_pii') and not coalesce(requires_review, false)",
    "active_with_unclear_license": "coalesce(acquisition_status, '') = 'active' and coalesce(license_status, '') in ('', 'unclear', 'unknown')",
    "path_leaves_folder": "coalesce(source_path, '') <> '' and (starts_with(source_path, '/') or regexp_matches(source_path, '(^|[/\\\\])\\.\\.([/\\\\]|$)') or regexp_matches(source_path, '^[A-Za-z]:'))",
    "dates_reversed": "coalesce(date_min, '') > coalesce(nullif(date_max, ''), '9999')",
}


@query(f"with r as (select *, count(*) over (partition by record_id) as times from donnees_quebec_fixture_harvest) select violation, count(*) as n from ({' union all '.join(f'select {S.quote(n)} as violation from r where {c}' for n, c in _SOURCE_RULES.items())}) group by violation")
def source_violations(spark, d):
    """Catalogue records as entries of a manifest, and the constraints they break."""
    found = manifests.source_violations(corpus._records(spark, d), "record_id", {"commercial_use": ["allowed", "unknown"]})
    return found.groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


_TERM_PAIRS = "(select prompt_id as pair_id, expected_terms[1] as preferred, forbidden_terms[1] as source, forbidden_terms as rejected from eval_prompts)"


@query(
    f"""with r as (select *, count(*) over (partition by source, preferred) as times from {_TERM_PAIRS}), b as (select *, coalesce({S.clean('source')}, '') = '' or coalesce({S.clean('preferred')}, '') = '' as blank from r)
select violation, count(*) as n from (select 'blank_term' as violation from b where blank union all select 'source_not_rejected' from b where not coalesce(list_contains(rejected, source), false) union all select 'preferred_rejected' from b where coalesce(list_contains(rejected, preferred), false) union all select 'repeated_pair' from b where times > 1 and source is not null and preferred is not null) group by 1"""
)
def term_pair_violations(spark, d):
    first = lambda c: F.try_element_at(c, F.lit(1))
    own = table(spark, d, "eval_prompts").select(F.col("prompt_id").alias("pair_id"), first("expected_terms").alias("preferred"), first("forbidden_terms").alias("source"), F.col("forbidden_terms").alias("rejected"))
    return manifests.pair_violations(own).groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


#: Sums widen in SQL; these columns keep the queries' types.
SQL |= {q: S.typed(SQL[q], columns) for q, columns in {
    "commercial_readiness": {"noncommercial": "bigint", "permission_required": "bigint"},
    "corpus_audit": {c: "bigint" for c in ("holdout_risk", "legal", "commercial", "noncommercial", "institutional", "modern", "literary", "duplicate_exact", "duplicate_normalized")},
    "download_verdict": {"available": "bigint", "failed": "bigint"},
    "trusted_records": {"trusted": "bigint"},
    "pack_blockers": {"train_examples": "bigint"},
}.items()}
