"""Queries over chat examples, evaluations, lexical grids and minimal pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boreal.functions import chat, measures, text as X
from boreal.operators import audit, balance, contamination, evaluation, instruct, lexical, pairs, rules
from boreal.plans import sqltext as S
from boreal.session import table
from boreal.sources import readers

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _examples(spark: SparkSession, d: str) -> DataFrame:
    return readers.union_inputs([(t, table(spark, d, t)) for t in ("train", "dev", "test")]).withColumnRenamed("source_input", "split")


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


def _generations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "base_vs_adapter_generations")


E = S.EXAMPLES
_TURN = "'<|im_start|>' || m['role'] || chr(10) || m['content'] || chr(10) || '<|im_end|>'"
_FIRST = "coalesce(list_filter(messages, lambda m: m['role'] = '{r}')[1]['content'], '')"

# --- messages and renderings ----------------------------------------------------------------------------------------


@query(f"select example_id, split, sha256(array_to_string([{_TURN} for m in messages], chr(10))) as chatml, array_to_string([{_TURN} for m in messages], chr(10)) = text as as_stored from {E} where messages is not null")
def chatml_render(spark, d):
    made = chat.chatml(F.col("messages"))
    return _examples(spark, d).where("messages is not null").select("example_id", "split", X.sha(made).alias("chatml"), (made == F.col("text")).alias("as_stored"))


@query(f"select example_id, split, '### Instruction:' || chr(10) || {_FIRST.format(r='user')} || chr(10) || chr(10) || '### Response:' || chr(10) || {_FIRST.format(r='assistant')} as alpaca from {E} where messages is not null")
def alpaca_render(spark, d):
    return _examples(spark, d).where("messages is not null").select("example_id", "split", chat.alpaca(F.col("messages")).alias("alpaca"))


@query(f"select example_id, split, sha256({_FIRST.format(r='assistant')}) as completion from {E} where messages is not null")
def completion_render(spark, d):
    return _examples(spark, d).where("messages is not null").select("example_id", "split", X.sha(chat.completion(F.col("messages"))).alias("completion"))


@query(f"select split, m['role'] as role, count(*) as turns, sum(length(m['content'])) as chars from (select split, unnest(messages) as m from {E}) group by 1, 2")
def turns_by_role(spark, d):
    own = _examples(spark, d).select("split", F.explode("messages").alias("m"))
    return own.groupBy("split", F.col("m.role").alias("role")).agg(F.count(F.lit(1)).alias("turns"), F.sum(F.length("m.content")).alias("chars"))


@query(f"select split, count_if(messages is not null and len(messages) > 0 and len(list_filter(messages, lambda m: coalesce(trim(m['role']), '') = '' or coalesce(trim(m['content']), '') = '')) = 0) as well_formed, count(*) as rows from {E} group by split")
def message_checks(spark, d):
    return _examples(spark, d).groupBy("split").agg(F.count_if(chat.well_formed(F.col("messages"))).alias("well_formed"), F.count(F.lit(1)).alias("rows"))


@query(f"select example_id, split, length(coalesce(nullif(trim(text), ''), case when len(messages) > 0 then array_to_string([{_TURN} for m in messages], chr(10)) end, '')) as chars from {E}")
def trainer_text(spark, d):
    return _examples(spark, d).select("example_id", "split", F.length(chat.trainer_text(F.col("text"), F.col("messages"))).alias("chars"))


# --- making examples ------------------------------------------------------------------------------------------------


def _candidate_sql() -> str:
    w = instruct.Wording()
    spots = ", ".join("{" + f"'at': instr(low, {S.quote(m)}), 'term': {S.quote(m)}" + "}" for m in instruct.MARKERS)
    cases = " ".join(f"when contains(low, {S.quote(a)}) or contains(low, {S.quote(b)}) then [{S.quote(a)}, {S.quote(b)}]" for a, b in instruct.CONTRASTS)
    normal = "' ' || body || ' '"
    for old, new in instruct.REPLACEMENTS:
        for _ in range(2):
            normal = f"regexp_replace({normal}, '([^\\p{{L}}\\p{{N}}_])(?i:{old})([^\\p{{L}}\\p{{N}}_])', '\\1{new}\\2', 'g')"
    chatml = lambda user, answer: f"'<|im_start|>system' || chr(10) || {S.quote(w.system)} || chr(10) || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || {user} || chr(10) || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || {answer} || chr(10) || '<|im_end|>'"
    fill = lambda t, **kv: reduce(lambda s, x: f"replace({s}, '{{{x[0]}}}', {x[1]})", kv.items(), S.quote(t))
    rows = [
        ("summarize", "true", S.quote(w.summarize), "case when len(x) = 0 then '' when len(x) > 1 and length(x[1] || ' ' || x[2]) <= 100000 then x[1] || ' ' || x[2] else x[1] end"),
        ("style_rewrite", "true", S.quote(w.rewrite), "body"),
        ("explain_term", "marker is not null", fill(w.explain, term="marker"), fill(w.explained, term="marker", sentence="x[1]")),
        ("qa_from_context", "true", S.quote(w.question), "x[1]"),
        ("normalize", "normal <> body", S.quote(w.normalize), "normal"),
        ("contrast", "pair is not null", fill(w.contrast, left="pair[1]", right="pair[2]"), fill(w.contrasted, right="pair[2]", left="pair[1]")),
        ("preserve_raw", S.unit(f"sha256({S.norm('body')}) || ':' || doc_id::varchar") + " <= 0.5", S.quote(w.raw), "body"),
    ]
    union = " union all ".join(f"select doc_id, {i} as rank, '{n}' as task_type, {chatml(u, a)} as t from p where {c}" for i, (n, c, u, a) in enumerate(rows))
    return f"""with b as (select doc_id, {S.clean('text')} as body from documents where text is not null),
l as (select *, lower(body) as low, {S.sentences('body')} as x, {S.clean(normal)} as normal from b where body <> ''),
p as (select *, list_sort(list_filter([{spots}], lambda s: s['at'] > 0))[1]['term'] as marker, case {cases} end as pair from l),
c as ({union}) select doc_id, rank, task_type, sha256(t) as example_sha256, sha256({S.norm('t')}) as example_norm_sha256 from c"""


def _candidates(spark, d):
    own = _documents(spark, d).where("text is not null").select("doc_id", "text")
    return instruct.candidates(own, "doc_id", keep_raw=0.5, most_chars=100_000)


@query(_candidate_sql())
def instruct_candidates(spark, d):
    return _candidates(spark, d).select("doc_id", "rank", "task_type", "example_sha256", "example_norm_sha256")


@query(
    f"""with recursive made as ({_candidate_sql()}),
c as (select *, row_number() over (order by doc_id, rank) as i, hash(example_norm_sha256) as h from made),
r(i, doc_id, taken, seen, kept) as (select 0::bigint, null::bigint, 0, []::ubigint[], false union all
 select c.i, c.doc_id, (case when c.doc_id is not distinct from r.doc_id then taken else 0 end) + (case when ok then 1 else 0 end), case when ok then list_append(seen, c.h) else seen end, ok
 from (select r.*, c.i as ci, not list_contains(seen, c.h) and (case when c.doc_id is not distinct from r.doc_id then taken else 0 end) < 3 as ok from r join c on c.i = r.i + 1) r join c on c.i = r.ci)
select c.doc_id, rank, task_type, example_sha256 from c join r using (i) where kept"""
)
def instruct_examples(spark, d):
    """Examples deduplicated, at most three a document."""
    own = _documents(spark, d).where("text is not null").select("doc_id", "text")
    return instruct.examples(own, "doc_id", ["doc_id"], 3, ["doc_id", "rank", "task_type", "example_sha256"], keep_raw=0.5, most_chars=100_000)


# --- reports over examples ------------------------------------------------------------------------------------------

_KEYS = ("task_type", "source_family", "register", "language", "license_status", "commercial_use")
_COUNTS = " union all ".join(f"select split, '{k}' as key, coalesce({k}, 'unknown') as value, count(*) as n from {E} group by 1, 3" for k in _KEYS)


@query(f"select key, value, sum(n) as n from ({_COUNTS}) group by key, value")
def pack_counts(spark, d):
    return audit.count_by(_examples(spark, d), _KEYS)


@query(
    f"""select split, count(*) as examples, count(distinct example_id) as ids, count(distinct source_id) as sources, count(distinct source_record_id) as records,
sum(cast(trunc(greatest(length(text) / 4.0, len({S.words('text')}) * 1.35)) as bigint)) as tokens, count_if(commercial_use = 'allowed') as commercial,
count_if(coalesce(task_type, '') <> 'preserve_raw') / count(*) as instruction_ratio, bool_or(coalesce(requires_review, false)) as any_review from {E} group by split"""
)
def pack_report(spark, d):
    return _examples(spark, d).groupBy("split").agg(
        F.count(F.lit(1)).alias("examples"), F.countDistinct("example_id").alias("ids"), F.countDistinct("source_id").alias("sources"), F.countDistinct("source_record_id").alias("records"),
        F.sum(audit.row_tokens()).alias("tokens"), F.count_if(F.col("commercial_use") == "allowed").alias("commercial"),
        (F.count_if(F.coalesce("task_type", F.lit("")) != "preserve_raw") / F.count(F.lit(1))).alias("instruction_ratio"), F.bool_or(F.coalesce("requires_review", F.lit(False))).alias("any_review"),
    )


@query(f"select source_family, list_sort(list_distinct(array_agg(task_type) filter (where task_type is not null))) as covered from {E} group by source_family")
def task_coverage(spark, d):
    return audit.coverage(_examples(spark, d), "source_family", "task_type")


@query(f"select key, value, n, n / sum(n) over (partition by key) as share from (select key, value, sum(n) as n from ({_COUNTS}) group by key, value)")
def pack_shares(spark, d):
    counts = audit.count_by(_examples(spark, d), _KEYS)
    total = counts.groupBy("key").agg(F.sum("n").alias("t"))
    return counts.join(total, "key").select("key", "value", "n", (F.col("n") / F.col("t")).alias("share"))


@query("select distinct source_id from dev where source_id is not null except select source_id from train")
def sources_only_in_dev(spark, d):
    """Set difference."""
    return table(spark, d, "dev").select("source_id").where("source_id is not null").distinct().exceptAll(table(spark, d, "train").select("source_id").distinct())


@query("select distinct source_record_id from (select source_record_id from train where source_record_id is not null intersect select source_record_id from test)")
def records_in_train_and_test(spark, d):
    return table(spark, d, "train").select("source_record_id").where("source_record_id is not null").intersect(table(spark, d, "test").select("source_record_id"))


@query(f"select source_id, list_sort(list_filter(['preserve_raw', 'summarize', 'qa_from_context'], lambda t: not list_contains(array_agg(task_type), t))) as missing from {E} where task_type is not null group by source_id")
def missing_tasks(spark, d):
    """Which of three tasks a source lacks."""
    wanted = F.array(*[F.lit(t) for t in ("preserve_raw", "summarize", "qa_from_context")])
    return _examples(spark, d).where("task_type is not null").groupBy("source_id").agg(F.array_sort(F.array_except(wanted, F.collect_set("task_type"))).alias("missing"))


_BROKEN = (("no_messages", "messages is null"), ("no_language", "language is null"), ("holdout", "coalesce(holdout_only, false)"), ("stale_hash", "text_sha256 is null"), ("no_record", "source_record_id is null or trim(source_record_id) = ''"))


@query(f"select violation, count(*) as n from ({' union all '.join(f'select {S.quote(n)} as violation from {E} where {c}' for n, c in _BROKEN)}) group by violation")
def example_violations(spark, d):
    return rules.violations(_examples(spark, d), "example_id", [(n, F.expr(c)) for n, c in _BROKEN]).groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


# --- contamination --------------------------------------------------------------------------------------------------

_HELD = "(select example_id, text from dev union all select example_id, text from test)"
_KEY = r"trim(regexp_replace(regexp_replace(translate(lower(nfc_normalize(text)), '’‘“”«»', '''''\"\"\"\"'), '[^\p{L}\p{N}_\s\p{Z}'']', '', 'g'), '[\s\x0b\x1c-\x1f\x85\p{Z}]+', ' ', 'g'))".replace('\\"', '"')


def _held(spark, d):
    return table(spark, d, "dev").select("example_id", "text").union(table(spark, d, "test").select("example_id", "text"))


@query(f"with a as (select example_id, {_KEY} as k from train), b as (select example_id, {_KEY} as k from {_HELD}) select distinct a.example_id as train_id, b.example_id as holdout_id from a join b using (k) where length(k) >= 3")
def exact_contamination(spark, d):
    return contamination.exact_matches(table(spark, d, "train"), _held(spark, d), "example_id")


@query(
    f"""with a as (select example_id, {_KEY} as k from train), b as (select example_id, {_KEY} as k from {_HELD}),
u as (select k, row_number() over (order by k) as i from (select distinct k from (select k from a union all select k from b) where length(k) >= 3)),
g as (select i, count(*) over (partition by i) as n, t from (select distinct i, substr(k, p::int, 3) as t from (select i, k, unnest(range(1, greatest(length(k) - 2, 1) + 1)) as p from u))),
r as (select *, row_number() over (partition by i order by f, t) as q from (select *, count(*) over (partition by t) as f from g)),
c as (select distinct x.i as ia, y.i as ib, x.n as na, y.n as nb from r x join r y using (t) where x.i <> y.i and x.q <= x.n - ceil(0.92 * x.n - 1e-9) + 1 and y.q <= y.n - ceil(0.92 * y.n - 1e-9) + 1 and least(x.n, y.n) >= 0.92 * greatest(x.n, y.n)
  and x.i in (select i from u join a using (k)) and y.i in (select i from u join b using (k))),
s as (select ia, ib, count(*) / (any_value(na) + any_value(nb) - count(*)) as s from c join g x on x.i = ia join g y on y.i = ib and y.t = x.t group by ia, ib)
select distinct a.example_id as train_id, b.example_id as holdout_id, round(s, 6) as score from s join u v on v.i = ia join u w on w.i = ib join a on a.k = v.k join b on b.k = w.k where s >= 0.92"""
)
def fuzzy_contamination(spark, d):
    return contamination.similar_matches(table(spark, d, "train"), _held(spark, d), "example_id", threshold=0.92)


# --- evaluation -----------------------------------------------------------------------------------------------------

_PAD = "' ' || lower(trim(regexp_replace(coalesce({r}, ''), '[\\s\\x0b\\x1c-\\x1f\\x85\\p{{Z}}]+', ' ', 'g'))) || ' '"
_HAS = "coalesce(len(list_filter({t}, lambda z: trim(z) <> '' and regexp_matches(" + _PAD + ", '[^\\p{{L}}\\p{{N}}_]' || regexp_escape(lower(trim(z))) || '[^\\p{{L}}\\p{{N}}_]'))) > 0, false)"


def _scores() -> str:
    cols = []
    for s in ("base", "adapter"):
        good, bad = _HAS.format(t="expected_terms", r=f"{s}_response"), _HAS.format(t="forbidden_terms", r=f"{s}_response")
        cols.append(f"({good})::int - ({bad})::int as {s}_score, {good} as {s}_preferred, {bad} as {s}_forbidden")
    return f"(select run_id, prompt_id, lexical_pair_id, task_type, generated_at, base, adapter, adapter_response, {', '.join(cols)} from base_vs_adapter_generations)"


def _rescored(spark, d, *more):
    return evaluation.rescore(_generations(spark, d), ["base_response", "adapter_response"], "expected_terms", "forbidden_terms").select(
        "run_id", "prompt_id", "lexical_pair_id", "task_type", "generated_at", "base", "adapter", "expected_terms", "forbidden_terms", *more,
        *[F.col(f"{s}_response_score.{c}").alias(f"{s}_{n}") for s in ("base", "adapter") for c, n in (("score", "score"), ("preferred_hit", "preferred"), ("forbidden_hit", "forbidden"))],
    )


@query(f"select run_id, prompt_id, base_score, adapter_score, base_preferred, adapter_forbidden from {_scores()}")
def term_scores(spark, d):
    return _rescored(spark, d).select("run_id", "prompt_id", "base_score", "adapter_score", "base_preferred", "adapter_forbidden")


@query(f"select base['score'] is not distinct from base_score as base_agrees, adapter['score'] is not distinct from adapter_score as adapter_agrees, count(*) as n from {_scores()} group by 1, 2")
def stored_score_check(spark, d):
    own = _rescored(spark, d)
    return own.groupBy(F.col("base.score").eqNullSafe(F.col("base_score")).alias("base_agrees"), F.col("adapter.score").eqNullSafe(F.col("adapter_score")).alias("adapter_agrees")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""select run_id, task_type, case when grouping(run_id) = 0 then 'run_id' when grouping(task_type) = 0 then 'task_type' else 'all' end as scope, count(*) as n,
sum(base_score) as base_score, sum(adapter_score) as adapter_score, sum(adapter_score) - sum(base_score) as delta
from (select coalesce(run_id, 'unknown') as run_id, coalesce(task_type, 'unknown') as task_type, base_score, adapter_score from {_scores()}) group by grouping sets ((run_id), (task_type), ())"""
)
def eval_delta(spark, d):
    return evaluation.score_deltas(_rescored(spark, d), F.col("base_score"), F.col("adapter_score"), ["run_id", "task_type"])


_WHY = (("adapter_under_base", "adapter_score < base_score"), ("contains_forbidden", "adapter_forbidden"), ("missing_preferred", "not adapter_preferred"))
_FAILURES = f"(select *, list_filter([{', '.join(f'case when {c} then {S.quote(n)} end' for n, c in _WHY)}], lambda x: x is not null) as reasons from {_scores()})"


def _failed(spark, d):
    return evaluation.failures(_rescored(spark, d), F.col("base_score"), F.col("adapter_score"), F.col("adapter_preferred"), F.col("adapter_forbidden"))


@query(f"select run_id, prompt_id, array_to_string(reasons, ' ') as reasons from {_FAILURES} where len(reasons) > 0")
def eval_failures(spark, d):
    return _failed(spark, d).select("run_id", "prompt_id", F.array_join("reasons", " ").alias("reasons"))


@query(f"with c as (select task_type, reason, count(*) as n, min(prompt_id) as first_seen from (select task_type, prompt_id, unnest(reasons) as reason from {_FAILURES}) group by 1, 2) select task_type, reason, n, first_seen, cast(rank as int) as rank from (select *, row_number() over (partition by task_type order by n desc, first_seen, reason) as rank from c) where rank <= 2")
def top_failure_reasons(spark, d):
    """The two most frequent reasons of each task; ties go to the first seen."""
    own = _failed(spark, d).select("task_type", "prompt_id", F.explode("reasons").alias("reason"))
    return balance.top_codes(own, ["task_type"], "reason", "prompt_id", 2)


#: A level for each row, a phenomenon, and what a grader would have written: rows without an answer are malformed.
_GRADE = f"""(select prompt_id || '|' || run_id as id, case when task_type is null then 'lp?' when lexical_pair_id is null then '20' else '9' end as lp_id, coalesce(task_type, 'none') as phenomenon,
case when coalesce({S.clean('adapter_response')}, '') = '' then 'sans réponse' when adapter_score > 0 then '1' else '0' end as is_correct, case when base_score < 0 then '1.5' when adapter_preferred then '0.75' end as similarity,
case when adapter_forbidden then 'contains_forbidden' when base_preferred then 'missing_preferred' when base_forbidden then 'invented' end as error_code from """
_SEVERITY = "(values (9, 'missing_preferred', 'minor'), (9, 'contains_forbidden', 'blocking'), (20, 'contains_forbidden', 'minor'))"


def _graded_sql(tail: str) -> str:
    return f"""with g as (select *, try_cast(lp_id as int) as lp, case is_correct when '1' then true when '0' then false end as ok, try_cast(similarity as double) as sim from {_GRADE}{_scores()})),
r as (select g.*, t.severity, lp is null or ok is null or coalesce(sim not between 0 and 1, false) as bad from g left join {_SEVERITY} t(lp_id, error_code, severity) on t.lp_id = g.lp and t.error_code = g.error_code),
d as (select *, not bad and not ok as wrong, not bad and not ok and coalesce(severity <> 'blocking', false) as mild from r) {tail}"""


def _graded(spark, d):
    scored = _rescored(spark, d, "adapter_response")
    rows = scored.select(
        F.concat("prompt_id", F.lit("|"), "run_id").alias("id"),
        F.when(F.col("task_type").isNull(), "lp?").when(F.col("lexical_pair_id").isNull(), "20").otherwise("9").alias("lp_id"),
        F.coalesce("task_type", F.lit("none")).alias("phenomenon"),
        F.when(F.coalesce(X.clean("adapter_response"), F.lit("")) == "", "sans réponse").when(F.col("adapter_score") > 0, "1").otherwise("0").alias("is_correct"),
        F.when(F.col("base_score") < 0, "1.5").when(F.col("adapter_preferred"), "0.75").alias("similarity"),
        F.when(F.col("adapter_forbidden"), "contains_forbidden").when(F.col("base_preferred"), "missing_preferred").when(F.col("base_forbidden"), "invented").alias("error_code"),
    )
    taxonomy = spark.createDataFrame([(9, "missing_preferred", "minor"), (9, "contains_forbidden", "blocking"), (20, "contains_forbidden", "minor")], "lp_id int, error_code string, severity string")
    return evaluation.graded(rows, F.col("is_correct"), F.col("error_code"), taxonomy, similarity=F.col("similarity"))


@query(
    _graded_sql(
        """select lp_id, phenomenon, count_if(not bad) as n, count_if(bad) as malformed, count_if(not bad and ok) as correct, count_if(not bad and ok) / nullif(count_if(not bad), 0) as accuracy, avg(sim) filter (where not bad) as mean_similarity,
count_if(wrong and error_code is not null and severity is null) as unknown_codes, count_if(wrong and not mild) as blocking, count_if(mild) as non_blocking from d group by lp_id, phenomenon"""
    )
)
def diagnostics(spark, d):
    """Accuracy, similarity and errors by level and phenomenon; the same code weighs differently on two levels."""
    return evaluation.diagnostics(_graded(spark, d), ["lp_id", "phenomenon"])


_FIRST_CODES = "select {by}error_code as code, n, first_seen, cast(rank as int) as rank from (select *, row_number() over ({part} order by n desc, first_seen, error_code) as rank from (select {by}error_code, count(*) as n, min(id) as first_seen from d where wrong and error_code is not null group by all)) where rank <= {most}"


@query(_graded_sql(_FIRST_CODES.format(by="lp_id, phenomenon, ", part="partition by lp_id, phenomenon", most=3)))
def diagnostics_codes(spark, d):
    """The three most frequent codes of each level and phenomenon."""
    return evaluation.error_codes(_graded(spark, d), ["lp_id", "phenomenon"], "id", 3)


@query(_graded_sql(_FIRST_CODES.format(by="", part="", most=5)))
def diagnostics_codes_overall(spark, d):
    return evaluation.error_codes(_graded(spark, d), [], "id", 5)


@query(_graded_sql("select lp_id, phenomenon, string_agg(error_code || '=' || n, ' ' order by error_code) as errors from (select lp_id, phenomenon, error_code, count(*) as n from d where wrong and error_code is not null group by all) group by 1, 2"))
def diagnostics_errors(spark, d):
    own = evaluation.error_map(_graded(spark, d), ["lp_id", "phenomenon"])
    return own.select("lp_id", "phenomenon", F.array_join(F.transform("errors", lambda e: F.concat(e["code"], F.lit("="), e["n"].cast("string"))), " ").alias("errors"))


@query(
    _graded_sql(
        """select *, malformed + missing_codes + unknown_codes + blocking = 0 and missing_levels = '' as ok from (select count(*) as total, count_if(bad) as malformed, count_if(wrong and error_code is null) as missing_codes,
count_if(wrong and error_code is not null and severity is null) as unknown_codes, count_if(wrong and not mild) as blocking, array_to_string(list_filter([9, 20], lambda x: not coalesce(list_contains(list(lp) filter (where not bad), x), false)), ',') as missing_levels from d)"""
    )
)
def diagnostics_verdict(spark, d):
    return evaluation.diagnostics_verdict(_graded(spark, d), [9, 20]).withColumn("missing_levels", F.array_join("missing_levels", ","))


_LEGACY = f"(select prompt_id as id, case when lexical_pair_id is null then ' LP20 ' when task_type = 'rewrite' then 'lp9' when task_type = 'correction' then 'Lexical_Semantics' when task_type is null then '' else task_type end as phenomenon, case when coalesce({S.clean('adapter_response')}, '') = '' then 'non' when adapter_score > 0 then '1' else ' 0' end as is_correct, case when adapter_forbidden then 'a b' when base_forbidden then '' else '1 0 0.5' end as embedding_ref, '0.5 1 0' as embedding_pred, case when base_preferred then ' perte ' else '' end as error_label from "


def _legacy(spark, d):
    own = _rescored(spark, d, "adapter_response").select(
        F.col("prompt_id").alias("id"),
        F.when(F.col("lexical_pair_id").isNull(), " LP20 ").when(F.col("task_type") == "rewrite", "lp9").when(F.col("task_type") == "correction", "Lexical_Semantics").when(F.col("task_type").isNull(), "").otherwise(F.col("task_type")).alias("phenomenon"),
        F.when(F.coalesce(X.clean("adapter_response"), F.lit("")) == "", "non").when(F.col("adapter_score") > 0, "1").otherwise(" 0").alias("is_correct"),
        F.when(F.col("adapter_forbidden"), "a b").when(F.col("base_forbidden"), "").otherwise("1 0 0.5").alias("embedding_ref"),
        F.lit("0.5 1 0").alias("embedding_pred"),
        F.when(F.col("base_preferred"), " perte ").otherwise("").alias("error_label"),
    )
    return evaluation.legacy_rows(own)


@query(
    f"""with l as (select *, trim(is_correct) as c, lower(trim(phenomenon)) as p from {_LEGACY}{_scores()}))
select lp_id, phenomenon, error_code, count(*) as n from (select case when p in ('lp9', 'lp9:lexical_semantics', 'lexical_semantics') then 9 when p in ('lp20', 'lp20:orphaned_preposition', 'orphaned_preposition') then 20 end as lp_id,
case when p in ('lp9', 'lp9:lexical_semantics', 'lexical_semantics') then 'lexical_semantics' when p in ('lp20', 'lp20:orphaned_preposition', 'orphaned_preposition') then 'orphaned_preposition' when p = '' then 'unknown' else trim(phenomenon) end as phenomenon,
case when c = '0' then nullif(trim(error_label), '') end as error_code from l) group by all"""
)
def legacy_phenomena(spark, d):
    """Rows of the older layout under today's levels and codes."""
    return _legacy(spark, d)[0].groupBy("lp_id", "phenomenon", "error_code").agg(F.count(F.lit(1)).alias("n"))


@query(f"select issue, count(*) as n from (select 'malformed_embedding_ref' as issue from {_LEGACY}{_scores()}) where trim(is_correct) in ('0', '1') and embedding_ref = 'a b') group by issue")
def legacy_issues(spark, d):
    return _legacy(spark, d)[1].groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


@query("select prompt_id, run_id, generated_at from (select *, row_number() over (partition by prompt_id order by generated_at desc, run_id desc) as n from (select distinct prompt_id, run_id, generated_at from base_vs_adapter_generations where prompt_id is not null)) where n = 1")
def latest_generation(spark, d):
    """The lookup of a prompt's generation: the last one wins."""
    own = _generations(spark, d).where("prompt_id is not null").select("prompt_id", "run_id", "generated_at")
    return lexical.latest_by_key(own, "prompt_id", ["generated_at", "run_id"])


@query("select g.run_id, g.prompt_id, p.domain, p.prompt_id is null as unknown_prompt from base_vs_adapter_generations g left join (select prompt_id, min(domain) as domain from eval_prompts where prompt_id is not null group by prompt_id) p using (prompt_id)")
def generation_lookup(spark, d):
    """Generations with their prompt's domain; a miss stays, marked."""
    known = table(spark, d, "eval_prompts").where("prompt_id is not null").groupBy("prompt_id").agg(F.min("domain").alias("domain"), F.lit(True).alias("known"))
    return _generations(spark, d).join(known, "prompt_id", "left").select("run_id", "prompt_id", "domain", F.col("known").isNull().alias("unknown_prompt"))


@query(
    """with p as (select a.vec_id, a.label, a.embedding as x, b.embedding as y from embeddings a join embeddings b on b.vec_id = a.vec_id + 1)
select label, count(*) as n, round(avg(case when s is null then 0 else least(1.0, greatest(0.0, s)) end), 5) as mean_similarity from (select label, list_cosine_similarity(x::double[], y::double[]) as s from p) group by label"""
)
def embedding_similarity(spark, d):
    """Mean cosine of each vector with the next one, by label."""
    own = table(spark, d, "embeddings")
    after = own.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return own.join(after, "vec_id").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(measures.cosine(F.col("embedding"), F.col("other"))), 5).alias("mean_similarity"))


@query("select vec_id, list_sum([v * v for v in embedding::double[]]) > 0 as has_norm, len(embedding) as size from embeddings")
def embedding_parse(spark, d):
    """Embeddings written as text and read back."""
    text = F.array_join(F.transform("embedding", lambda v: v.cast("double").cast("string")), " ")
    read = measures.parse_embedding(text)
    return table(spark, d, "embeddings").select("vec_id", (F.aggregate(read, F.lit(0.0), lambda s, v: s + v * v) > 0).alias("has_norm"), F.size(read).alias("size"))


@query("select metric, value, coalesce(case when kind = 'max' then value <= bound else value >= bound end, false) as passed from (select 'accuracy' as metric, 'min' as kind, 0.5 as bound union all select 'forbidden_rate', 'max', 0.25 union all select 'coverage', 'min', 0.9) left join (select 'accuracy' as metric, count_if(adapter_score > 0) / count(*) as value from " + _scores() + " union all select 'forbidden_rate', count_if(adapter_forbidden) / count(*) from " + _scores() + ") using (metric)")
def metric_gates(spark, d):
    """Limits against measured values; a metric that was not measured fails."""
    own = _rescored(spark, d).agg((F.count_if(F.col("adapter_score") > 0) / F.count(F.lit(1))).alias("accuracy"), (F.count_if("adapter_forbidden") / F.count(F.lit(1))).alias("forbidden_rate"))
    measured = own.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("accuracy", "forbidden_rate")])))
    limits = spark.createDataFrame([("accuracy", "min", 0.5), ("forbidden_rate", "max", 0.25), ("coverage", "min", 0.9)], "metric string, kind string, bound double")
    return evaluation.gates(measured, limits)


# --- lexical grids and minimal pairs --------------------------------------------------------------------------------

_PAIRS = "(select lexical_pair_id as pair_id, min(f) as source, min(e) as preferred from (select lexical_pair_id, expected_terms[1] as e, forbidden_terms[1] as f from eval_prompts) where lexical_pair_id is not null and e is not null and f is not null group by lexical_pair_id)"


def _pairs(spark, d):
    own = table(spark, d, "eval_prompts").select(F.col("lexical_pair_id").alias("pair_id"), F.try_element_at("expected_terms", F.lit(1)).alias("e"), F.try_element_at("forbidden_terms", F.lit(1)).alias("f"))
    return own.where("pair_id is not null and e is not null and f is not null").groupBy("pair_id").agg(F.min("f").alias("source"), F.min("e").alias("preferred"))


def _grid_sql() -> str:
    pool = []
    flat = [(g, f"{g}-{i:02d}", t) for g, ts in lexical.CONTEXTS.items() for i, t in enumerate(ts, 1)]
    for split, count, own in (("train", 8, [x for x in flat if x[0] != "quotidien"]), ("dev", 2, [x for x in flat if x[0] == "quotidien"])):
        for n in range(count):
            turn = n // len(own)
            pool.append(f"({S.quote(split)}, {n}, {S.quote(own[n % len(own)][1] + (f'-v{turn + 1}' if turn else ''))}, {S.quote(own[n % len(own)][2] + (f' (variante {turn + 1})' if turn else ''))})")
    tasks = ", ".join(f"({S.quote(k)}, {S.quote(u)}, {S.quote(a)})" for k, (u, a) in lexical.TASKS.items())
    fill = lambda c: f"replace(replace(replace(replace({c}, '{{sentence}}', s), '{{corrected}}', replace(s, source, preferred)), '{{source}}', source), '{{preferred}}', preferred)"
    return f"""with g as (select *, replace(template, '{{source}}', source) as s from {_PAIRS} p, (values {tasks}) t(task_type, u, a), (values {', '.join(pool)}) c(split, n, template_id, template)),
m as (select *, '<|im_start|>user' || chr(10) || {fill('u')} || chr(10) || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || {fill('a')} || chr(10) || '<|im_end|>' as example_text from g)
select pair_id, task_type, split, template_id, pair_id || ':' || task_type || ':' || split || ':' || printf('%03d', n + 1) || ':' || substr(sha256(example_text), 1, 10) as example_id, example_text from m"""


@query(_grid_sql())
def preference_grid(spark, d):
    return lexical.preference_grid(_pairs(spark, d), 10).drop("messages")


_TASKS_ASKED = {k: f"{t} Contexte : {lexical.PROMPT_CONTEXTS[i % 5]}." for i, (k, t) in enumerate(lexical.EVAL_TASKS.items())}


@query(
    f"""select regexp_replace(regexp_replace(lower(pair_id), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') || '-' || printf('%02d', task_no) as prompt_id, pair_id, task_type,
replace(replace(template, '{{source}}', source), '{{preferred}}', preferred) as prompt, [preferred] as expected_terms, [source] as forbidden_terms
from {_PAIRS} p, (values {', '.join(f'({i}, {S.quote(k)}, {S.quote(t)})' for i, (k, t) in enumerate(_TASKS_ASKED.items(), 1))}) t(task_no, task_type, template)"""
)
def eval_prompt_grid(spark, d):
    return lexical.eval_prompts(_pairs(spark, d))


_OVERRIDES = [("balado", "baladodiffusion", ["podcast", "pod-cast"], True), ("spam", None, [], True)]


def _mined_sql() -> str:
    forms = ", ".join(f"({S.quote(k)}, {i}, {len(v)}, {S.quote(u)}, {S.quote(a)})" for k, v in lexical.MINED.items() for i, (u, a) in enumerate(v))
    pick = lambda xs: f"([{', '.join(S.quote(x) for x in xs)}])[draw % {len(xs)} + 1]"
    fill = lambda c: f"replace(replace(replace(replace({c}, '{{context}}', context), '{{source}}', source), '{{preferred}}', preferred), '{{forbidden}}', forbidden)"
    return f"""with f as (select distinct prompt_id, task_type, lexical_pair_id from {_FAILURES} where len(reasons) > 0),
q as (select f.*, source, case when key = 'balado' then 'baladodiffusion' else preferred end as preferred, case when key = 'balado' then 'podcast, pod-cast' else source end as forbidden, key in ('balado', 'spam') as digital
 from (select f.*, regexp_replace(lexical_pair_id, '^[^:]*:', '') as key from f) f join {_PAIRS} q on q.pair_id = f.lexical_pair_id),
v as (select *, unnest(range(0, greatest(1, case task_type when 'rewrite' then 4 when 'correction' then 3 else 2 end))) as variant from q),
d as (select v.*, ('0x' || substr(sha256('42:' || prompt_id || ':' || variant), 1, 8))::bigint as draw, user_, assistant from v join (values {forms}) t(task_type, form, forms, user_, assistant) on t.task_type = v.task_type and v.variant % forms = form),
c as (select *, case when digital then {pick(lexical.DIGITAL_CONTEXTS)} else {pick(lexical.GENERAL_CONTEXTS)} end as context from d),
m as (select *, '<|im_start|>user' || chr(10) || {fill('user_')} || chr(10) || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || {fill('assistant')} || chr(10) || '<|im_end|>' as example_text from c),
w as (select * from m qualify row_number() over (partition by example_text order by lexical_pair_id, prompt_id, task_type, variant) = 1),
i as (select *, prompt_id || ':' || task_type || ':' || variant || ':' || substr(sha256(example_text), 1, 10) as example_id from w)
select example_id, prompt_id, lexical_pair_id, task_type, variant::int as variant, case when {S.unit("'42:' || example_id")} < 0.8 then 'train' else 'dev' end as split, example_text from i"""


@query(_mined_sql())
def failure_mining(spark, d):
    """Examples from the prompts an adapter fails, more of them for some tasks, with overrides for two pairs."""
    failed = _failed(spark, d).select("prompt_id", "task_type", "lexical_pair_id").distinct().join(_pairs(spark, d).withColumnRenamed("pair_id", "lexical_pair_id"), "lexical_pair_id")
    overrides = spark.createDataFrame(_OVERRIDES, "pair_key string, preferred string, forbidden array<string>, digital boolean")
    own = lexical.with_overrides(failed.withColumn("forbidden", F.array("source")), overrides)
    return lexical.mined_examples(own, 2, {"rewrite": 2.0, "correction": 1.5})


@query(
    f"""with f as (select task_type, regexp_replace(lexical_pair_id, '^[^:]*:', '') as key from {_FAILURES} where len(reasons) > 0)
select array_to_string(case when len(x) > 0 then x else ['broad'] end, ' ') as focus from (select list_filter([case when exists (select 1 from f where task_type = 'choose_best_term') then 'choose_best_term' end, case when exists (select 1 from f where task_type = 'open_generation') then 'open_generation' end,
case when exists (select 1 from f where key = 'balado') then 'balado' end, case when exists (select 1 from f where key = 'courriel') then 'courriel' end], lambda z: z is not null) as x)"""
)
def next_focus(spark, d):
    """What the failures still are about."""
    own = lexical.next_focus(_failed(spark, d), ["choose_best_term", "open_generation"], ["balado", "courriel"])
    return own.select(F.array_join("focus", " ").alias("focus"))


@query(
    f"""select prompt_id, run_id, adapter_response is not null and bonus <> '' and regexp_matches({_PAD.format(r='adapter_response')}, '[^\\p{{L}}\\p{{N}}_]' || regexp_escape(bonus) || '[^\\p{{L}}\\p{{N}}_]') as bonus_hit
from (select g.prompt_id, run_id, adapter_response, lower(trim(coalesce(bonus, ''))) as bonus from base_vs_adapter_generations g left join (select prompt_id, min(scoring.exact_preferred_bonus) as bonus from eval_prompts where prompt_id is not null group by prompt_id) p using (prompt_id))"""
)
def bonus_hits(spark, d):
    """Whether a response names the term its prompt prefers."""
    asked = table(spark, d, "eval_prompts").where("prompt_id is not null").groupBy("prompt_id").agg(F.min("scoring.exact_preferred_bonus").alias("bonus"))
    score = evaluation.term_score(F.col("adapter_response"), F.col("expected_terms"), F.col("forbidden_terms"), F.col("bonus"))
    return _generations(spark, d).join(asked, "prompt_id", "left").select("prompt_id", "run_id", score["bonus_hit"].alias("bonus_hit"))


@query(
    f"""select prompt_id, coalesce(list_filter(forbidden_terms, lambda t: {S.norm('t')} <> {S.norm('expected_terms[1]')})[1], forbidden_terms[1], expected_terms[1]) as rejected from (select distinct prompt_id, forbidden_terms, expected_terms from eval_prompts)"""
)
def rejected_terms(spark, d):
    own = table(spark, d, "eval_prompts").select("prompt_id", "forbidden_terms", "expected_terms").distinct()
    return own.select("prompt_id", lexical.rejected_term(F.col("forbidden_terms"), F.try_element_at("expected_terms", F.lit(1))).alias("rejected"))


#: Sentences a pair's terms stand in, one side each.
_SIDES = (("On parle de {positive_pattern} au conseil.", "On parle de {negative_pattern} au conseil."), ("{positive_pattern}, dit-elle.", "{negative_pattern}, dit-elle."))


def _contrasts(spark, d):
    side = lambda k: F.array(*[F.lit(x[k]) for x in _SIDES])
    own = _pairs(spark, d).select(F.lit(9).alias("lp_id"), F.col("pair_id").alias("contrast_id"), F.col("preferred").alias("positive_pattern"), F.col("source").alias("negative_pattern"), side(0).alias("good_templates"), side(1).alias("bad_templates"))
    return own.withColumns({"required_good": F.array(F.lit("conseil")), "forbidden_bad": F.array("positive_pattern"), "focus": F.lit("required_preposition_retention")})


_EXPANDED = f"""(select 'lp9-' || substr(sha1('9|' || pair_id || '|' || good || '|' || bad), 1, 10) as id, 9 as lp_id, pair_id as contrast_id, good, bad, preferred, source from
(select pair_id, preferred, source, replace(replace(g, '{{positive_pattern}}', preferred), '{{negative_pattern}}', source) as good, replace(replace(b, '{{positive_pattern}}', preferred), '{{negative_pattern}}', source) as bad
from {_PAIRS} p, (values {', '.join(f'({S.quote(g)}, {S.quote(b)})' for g, b in _SIDES)}) t(g, b)))"""


@query(f"select id, lp_id, contrast_id, good, bad from {_EXPANDED}")
def minimal_pairs(spark, d):
    """A pair for each term pair of the prompts and each sentence."""
    return pairs.expand(_contrasts(spark, d))


_PAIR_CHECKS = (
    ("invalid_lp_id", "lp is not null and try_cast(lp as int) is null"),
    ("empty_side", "g = '' or b = ''"),
    ("non_nfc", "nfc_normalize(good) <> good or nfc_normalize(bad) <> bad"),
    ("identical_pair", "g = b"),
    ("punctuation_only_change", "regexp_replace(g, '[^\\p{L}\\p{N}]', '', 'g') = regexp_replace(b, '[^\\p{L}\\p{N}]', '', 'g') and g <> b"),
    ("too_short", "length(g) < 8 or length(b) < 8"),
    ("too_long", "length(g) > 220 or length(b) > 220"),
    ("forbidden_ngram", "regexp_matches(g || chr(1) || b, 'le fin de semaine|un fin de semaine|du fin de semaine|de le')"),
    ("neutralization_good", "try_cast(lp as int) = 9 and regexp_matches(g, 'week-end|email')"),
    ("missing_positive_pattern", "try_cast(lp as int) = 9 and coalesce(pos, '') <> '' and not contains(g, pos)"),
    ("missing_negative_pattern", "try_cast(lp as int) = 9 and coalesce(neg, '') <> '' and not contains(b, neg)"),
    ("duplicate_pair", "dup"),
)


@query(
    f"""with p as (select prompt_id || '|' || run_id || '|' || generated_at::varchar as id, case when task_type = 'rewrite' then '9' when task_type is null then 'neuf' end as lp, coalesce(base_response, '') as good, coalesce(adapter_response, '') as bad, {S.norm("expected_terms[1]")} as pos, {S.norm("forbidden_terms[1]")} as neg from base_vs_adapter_generations),
n as (select *, {S.norm('good')} as g, {S.norm('bad')} as b from p), f as (select *, row_number() over (partition by g, b order by id) > 1 as dup from n),
i as ({' union all '.join(f"select {S.quote(n)} as issue from f where {c}" for n, c in _PAIR_CHECKS)}) select issue, issue not in ('non_nfc', 'too_short', 'too_long') as blocking, count(*) as n from i group by issue"""
)
def pair_issues(spark, d):
    """The checks of minimal pairs, over pairs of responses."""
    own = _generations(spark, d).select(
        F.concat_ws("|", "prompt_id", "run_id", F.date_format("generated_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("id"),
        F.when(F.col("task_type") == "rewrite", "9").when(F.col("task_type").isNull(), "neuf").alias("lp_id"),
        F.coalesce("base_response", F.lit("")).alias("good"), F.coalesce("adapter_response", F.lit("")).alias("bad"),
        F.try_element_at("expected_terms", F.lit(1)).alias("positive_pattern"), F.try_element_at("forbidden_terms", F.lit(1)).alias("negative_pattern"),
    )
    return pairs.issues(own).groupBy("issue", "blocking").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""with m as (select *, id as own from {_EXPANDED}),
forged as (select 'f1' || right(id, 10) as id, 9 as lp_id, contrast_id, bad as good, good as bad from m union all select 'f2' || right(id, 10), 20, contrast_id, good, bad from m union all select 'f3' || right(id, 10), 9, contrast_id || '?', good, bad from m),
r as (select x.*, y.preferred is not null as there, preferred, source, {S.norm('good')} as g, {S.norm('bad')} as b, {S.norm('preferred')} as pos, {S.norm('source')} as neg,
 exists (select 1 from m where m.contrast_id = x.contrast_id and m.good = x.good and m.bad = x.bad) as known from (select id, lp_id, contrast_id, good, bad from m union all select * from forged) x left join (select distinct contrast_id, preferred, source from m) y using (contrast_id)),
i as (select 'context_unknown_contrast' as issue from r where not there union all select 'context_lp_id_mismatch' from r where there and lp_id <> 9 union all select 'context_unauthorized_pair' from r where there and not known
union all select 'context_stable_id_mismatch' from r where there and id <> 'lp9-' || substr(sha1('9|' || contrast_id || '|' || good || '|' || bad), 1, 10)
union all select 'context_missing_positive_pattern' from r where there and not contains(g, pos) union all select 'context_missing_negative_pattern' from r where there and not contains(b, neg)
union all select 'lp20_missing_preposition_focus' from r where there and not contains(g, pos) union all select 'lp20_missing_negative_focus' from r where there and not contains(b, neg)
union all select 'lp20_too_short' from r where there and (length(g) < 16 or length(b) < 16)
union all select 'context_missing_required_good_substring' from r where there and not contains(g, 'conseil') union all select 'context_forbidden_bad_substring' from r where there and contains(b, pos))
select issue, count(*) as n from i group by issue"""
)
def context_issues(spark, d):
    """Pairs of the prompts' terms beside forged ones: sides exchanged, another level, an unknown contrast."""
    contrasts = _contrasts(spark, d)
    true = pairs.expand(contrasts)
    tail = lambda n: F.concat(F.lit(n), F.substring("id", -10, 10)).alias("id")
    forged = true.select(tail("f1"), "lp_id", "contrast_id", F.col("bad").alias("good"), F.col("good").alias("bad"))
    forged = forged.union(true.select(tail("f2"), F.lit(20).alias("lp_id"), "contrast_id", "good", "bad"))
    forged = forged.union(true.select(tail("f3"), "lp_id", F.concat("contrast_id", F.lit("?")), "good", "bad"))
    return pairs.context_issues(true.unionByName(forged), contrasts).groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


#: Sums widen in SQL; these columns keep the queries' types.
SQL |= {q: S.typed(SQL[q], columns) for q, columns in {
    "turns_by_role": {"chars": "bigint"},
    "message_checks": {"well_formed": "bigint"},
    "pack_counts": {"n": "bigint"},
    "pack_report": {"tokens": "bigint", "commercial": "bigint"},
    "pack_shares": {"n": "bigint"},
    "eval_delta": {"base_score": "bigint", "adapter_score": "bigint", "delta": "bigint"},
    "diagnostics": {c: "bigint" for c in ("n", "malformed", "correct", "unknown_codes", "blocking", "non_blocking")},
    "diagnostics_verdict": {c: "bigint" for c in ("malformed", "missing_codes", "unknown_codes", "blocking")},
    "trainer_text": {"chars": "int"},
    "embedding_parse": {"size": "int"},
}.items()}
