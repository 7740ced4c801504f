"""Queries over documents, pages and catalogue records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boreal.functions import text as X
from boreal.operators import audit, balance, curation, dedup, rules, splits
from boreal.plans import sqltext as S
from boreal.session import table
from boreal.sources import catalogue, html

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "assnat_fixture_harvest")


def _records(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "donnees_quebec_fixture_harvest")


def _examples(spark: SparkSession, d: str) -> DataFrame:
    from functools import reduce

    return reduce(DataFrame.unionByName, [table(spark, d, t).withColumn("split", F.lit(t)) for t in ("train", "dev", "test")])


# --- cleaning, dedup ------------------------------------------------------------------------------------------------


@query(
    f"""with n as (select doc_id, source, {S.clean('text')} as t, {S.norm('text')} as k from documents),
first as (select k, min(doc_id) as doc_id from n where length(t) >= 20 group by k)
select coalesce(source, 'unknown') as source, count(*) as records, sum(cast(trunc(greatest(length(t) / 4.0, len({S.words('t')}) * 1.35)) as bigint)) as tokens
from n join first using (doc_id) group by 1"""
)
def normalized_dedup_by_source(spark, d):
    """Clean, drop short texts, keep the first of each normalized text, and estimate tokens by source. Texts are read
    into a key and a count where they lie; only these are moved."""
    own = _documents(spark, d).select("doc_id", "source", X.clean("text").alias("text")).where(F.length("text") >= 20)
    keyed = own.select("doc_id", F.coalesce("source", F.lit("unknown")).alias("source"), audit.row_tokens().alias("tokens"), X.sha(X.norm_key("text")).alias("k"))
    kept = dedup.first_wins(keyed, ["k"], ["doc_id"])
    return kept.groupBy("source").agg(F.count(F.lit(1)).alias("records"), F.sum("tokens").alias("tokens"))


@query(
    f"""with l as (select doc_id, generate_subscripts(x, 1) as n, unnest(x) as line from (select doc_id, {S.lines('text')} as x from documents)),
c as (select doc_id, n, {S.clean('line')} as line from l),
r as (select *, row_number() over (partition by line order by doc_id, n) as k from c where length(line) >= 20)
select doc_id, cast(n - 1 as int) as line_no, sha256(line) as id from r where k = 1"""
)
def harvest_lines(spark, d):
    """Lines of at least 20 characters, each text once, at its first place."""
    rows = _documents(spark, d).select("doc_id", F.posexplode(F.split(X.unix_newlines("text"), "\n")).alias("line_no", "line"))
    rows = rows.select("doc_id", "line_no", X.clean("line").alias("line")).where(F.length("line") >= 20)
    return dedup.first_wins(rows.select("doc_id", "line_no", X.sha("line").alias("id")), ["id"], ["doc_id", "line_no"])


@query(f"select count(*) as records, count(*) - count(distinct text) as exact, count(*) - count(distinct {S.norm('text')}) as normalized from documents")
def dup_counts(spark, d):
    return dedup.duplicate_counts(_documents(spark, d), exact=X.sha("text"), normalized=X.sha(X.norm_key("text")))


@query(
    f"""with n as (select doc_id, {S.clean('text')} as t, {S.norm('text')} as k from documents),
f as (select k, min(doc_id) as lead, arg_min(t, doc_id) as tlead from n group by k)
select doc_id, case when doc_id = lead then null when t = tlead then 'duplicate_exact' else 'duplicate_normalized' end as reason from n join f using (k)"""
)
def two_key_dedup_reasons(spark, d):
    keyed = _documents(spark, d).select("doc_id", X.sha(X.clean("text")).alias("exact"), X.sha(X.norm_key("text")).alias("normal"))
    return dedup.two_key_reasons(keyed, "exact", "normal", ["doc_id"]).select("doc_id", "reason")


@query(f"select doc_id, row_number() over (partition by {S.norm('text')} order by doc_id) > 1 as is_duplicate from documents")
def duplicate_flags(spark, d):
    own = _documents(spark, d).select("doc_id", X.sha(X.norm_key("text")).alias("k"))
    return dedup.duplicate_flags(own, "k", ["doc_id"]).select("doc_id", "is_duplicate")


@query(
    """select record_id, max(ingested_at) as ingested_at, count(*) as deliveries, count(distinct text) as texts from assnat_fixture_harvest
where record_id is not null group by record_id"""
)
def deliveries(spark, d):
    """Each page's last delivery, and how many there were."""
    return _pages(spark, d).where("record_id is not null").groupBy("record_id").agg(F.max("ingested_at").alias("ingested_at"), F.count(F.lit(1)).alias("deliveries"), F.countDistinct("text").alias("texts"))


@query(
    """select record_id, sha256(text) as text_sha256 from (select record_id, text, row_number() over (partition by record_id order by ingested_at, sha256(text)) as n from assnat_fixture_harvest) where n = 1"""
)
def first_delivery(spark, d):
    own = _pages(spark, d).select("record_id", "ingested_at", X.sha("text").alias("text_sha256"))
    return dedup.first_wins(own, ["record_id"], ["ingested_at", "text_sha256"]).select("record_id", "text_sha256")


@query("select record_id, text_sha256 = sha256(text) as exact_matches, text_sha256 is null as missing from assnat_fixture_harvest")
def stored_hash_check(spark, d):
    """Whether a stored hash is that of the text."""
    return _pages(spark, d).select("record_id", (F.col("text_sha256") == X.sha("text")).alias("exact_matches"), F.col("text_sha256").isNull().alias("missing"))


@query("select event_type, user_id, min(event_id) as event_id from events group by event_type, user_id")
def event_first_seen(spark, d):
    own = table(spark, d, "events").select("event_id", "event_type", "user_id")
    return dedup.first_wins(own, ["event_type", "user_id"], ["event_id"])


@query(
    f"""with recursive k as (select doc_id, row_number() over (order by doc_id) as i, md5(coalesce({S.norm('text')}, chr(0))) as k from documents),
r(i, seen, fresh) as (select 0::bigint, []::varchar[], false union all
 select k.i, case when list_contains(seen, k.k) then seen when len(seen) >= 199 then [] else list_append(seen, k.k) end, not list_contains(seen, k.k) from r join k on k.i = r.i + 1)
select doc_id, sha256({S.norm('text')}) as k from documents where doc_id in (select doc_id from k join r using (i) where fresh)"""
)
def forgetful_dedup(spark, d):
    """Normalized dedup with a memory of 200 texts."""
    own = _documents(spark, d).select("doc_id", X.sha(X.norm_key("text")).alias("k"))
    return dedup.forgetful_dedup(own, "k", ["doc_id"], 200)


# --- text functions -------------------------------------------------------------------------------------------------


def _marker_sql() -> str:
    hits = " + ".join(f"({S.has_word('lower(text)', m)})::int" for m in curation.MARKERS)
    return f"select doc_id, {hits} as marker_hits, round(({hits}) / greatest(1, len({S.words('text')})), 4) as marker_score from documents"


@query(_marker_sql())
def marker_score(spark, d):
    return curation.marker_scores(_documents(spark, d)).select("doc_id", "marker_hits", "marker_score")


def _edit_sql() -> str:
    out = "text"
    edge = "([^\\p{L}\\p{N}_]|^)"
    end = "([^\\p{L}\\p{N}_]|$)"
    for old, new in curation.REPLACEMENTS:
        for _ in range(2):  # neighbours share a boundary character
            out = f"regexp_replace({out}, '{edge}{old.upper()}{end}', '\\1{new.upper()}\\2', 'g')"
        for _ in range(2):
            out = f"regexp_replace({out}, '{edge}({'|'.join(_caps(old))}){end}', '\\1{new[:1].upper() + new[1:]}\\3', 'g')"
        for _ in range(2):
            out = f"regexp_replace({out}, '{edge}(?i:{old}){end}', '\\1{new}\\2', 'g')"
    return f"select doc_id, sha256({out}) as edited from documents"


def _caps(word: str) -> list[str]:
    return [word[:1].upper() + "(?i:" + word[1:] + ")"]


@query(_edit_sql())
def normative_edit(spark, d):
    return _documents(spark, d).select("doc_id", X.sha(X.replace_matching_case("text", curation.REPLACEMENTS)).alias("edited"))


def _lexical_sql() -> str:
    from boreal.operators.instruct import REPLACEMENTS

    out = "' ' || text || ' '"
    for old, new in REPLACEMENTS:
        for _ in range(2):
            out = f"regexp_replace({out}, '([^\\p{{L}}\\p{{N}}_])(?i:{old})([^\\p{{L}}\\p{{N}}_])', '\\1{new}\\2', 'g')"
    return f"select doc_id, sha256({S.clean(out)}) as edited from documents"


@query(_lexical_sql())
def lexical_normalize(spark, d):
    from boreal.operators.instruct import REPLACEMENTS

    return _documents(spark, d).select("doc_id", X.sha(X.clean(X.replace_words("text", REPLACEMENTS))).alias("edited"))


@query(f"select doc_id, cast(n - 1 as int) as n, s as sentence from (select doc_id, generate_subscripts(x, 1) as n, unnest(x) as s from (select doc_id, {S.sentences('text')} as x from documents))")
def sentence_split(spark, d):
    return _documents(spark, d).select("doc_id", F.posexplode(X.sentences("text")).alias("n", "sentence"))


@query(
    f"""with s as (select doc_id, {S.clean('text')} as t, {S.sentences('text')} as x from documents)
select doc_id, case when len(x) = 0 then '' when length(x[1]) > 300 then case when len(x) > 1 and length(x[2]) <= 300 then x[2] else rtrim(substr(x[1], 1, 300)) end
  when len(x) > 1 and length(x[1] || ' ' || x[2]) <= 300 then x[1] || ' ' || x[2] else x[1] end as summary,
  rtrim(substr(coalesce(x[1], t), 1, 200)) as first_sentence from s"""
)
def extractive_summary(spark, d):
    return _documents(spark, d).select("doc_id", X.summary("text", 300).alias("summary"), X.first_sentence("text", 200).alias("first_sentence"))


@query(
    f"""select doc_id, cast(n - 1 as int) as n, p as paragraph from (select doc_id, generate_subscripts(x, 1) as n, unnest(x) as p from
(select doc_id, list_filter([{S.clean('y')} for y in string_split_regex(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '\\n\\s*\\n')], lambda z: length(z) >= 40) as x from documents))"""
)
def blank_line_paragraphs(spark, d):
    return _documents(spark, d).select("doc_id", F.posexplode(X.paragraphs("text", 40)).alias("n", "paragraph"))


@query(
    f"""with b as (select doc_id, regexp_replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '^[\\s\\x0b]+|[\\s\\x0b]+$', '', 'g') as t from documents),
w as (select doc_id, case when regexp_matches(t, '\\n[\\t\\x0b\\f\\r ]*\\n') then [{S.clean('y')} for y in string_split_regex(t, '\\n\\s*\\n')] else [{S.clean('y')} for y in string_split(t, chr(10))] end as x from b)
select doc_id, cast(n - 1 as int) as n, p as segment from (select doc_id, generate_subscripts(x, 1) as n, unnest(x) as p from (select doc_id, list_filter(x, lambda z: length(z) >= 40) as x from w))"""
)
def plain_text_segments(spark, d):
    return _documents(spark, d).select("doc_id", F.posexplode(X.segments("text", None, 40)).alias("n", "segment"))


def _first_marker_sql() -> str:
    from boreal.operators.instruct import MARKERS

    spots = ", ".join("{" + f"'at': instr(t, {S.quote(m)}), 'term': {S.quote(m)}" + "}" for m in MARKERS)
    return f"select doc_id, list_sort(list_filter([{spots}], lambda s: s['at'] > 0))[1]['term'] as marker from (select doc_id, lower({S.clean('text')}) as t from documents)"


@query(_first_marker_sql())
def first_marker(spark, d):
    from boreal.operators.instruct import MARKERS

    own = _documents(spark, d).select("doc_id", F.lower(X.clean("text")).alias("low"))
    return own.select("doc_id", X.earliest(F.col("low"), MARKERS).alias("marker"))


def _contrast_sql() -> str:
    from boreal.operators.instruct import CONTRASTS

    cases = " ".join(f"when contains(t, {S.quote(a)}) or contains(t, {S.quote(b)}) then {S.quote(a + '|' + b)}" for a, b in CONTRASTS)
    return f"select doc_id, case {cases} end as pair from (select doc_id, lower({S.clean('text')}) as t from documents)"


@query(_contrast_sql())
def contrast_pair(spark, d):
    from boreal.operators.instruct import CONTRASTS

    pair = X.first_listed(F.col("low"), CONTRASTS)
    return _documents(spark, d).select("doc_id", F.lower(X.clean("text")).alias("low")).select("doc_id", F.when(pair.isNotNull(), F.concat(pair["left"], F.lit("|"), pair["right"])).alias("pair"))


@query(
    f"""select doc_id, coalesce(length(regexp_replace(text, '[^\\p{{Lu}}]', '', 'g')) / nullif(length(regexp_replace(text, '[^\\p{{L}}]', '', 'g')), 0), 0.0) as upper_share,
len({S.words('text')}) as words, regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') as slug from documents"""
)
def text_measures(spark, d):
    return _documents(spark, d).select("doc_id", X.upper_share("text").alias("upper_share"), X.word_count("text").alias("words"), X.slug("title").alias("slug"))


@query(
    f"""with f as (select record_id, ingested_at, list_distinct(list_filter([{S.clean('package_title')}, {S.clean('organization_title')}, {S.clean('text')}, {S.clean('source_name')}, {S.clean('package_name')}], lambda s: s is not null and s <> '')) as x from donnees_quebec_fixture_harvest),
e as (select record_id, ingested_at, unnest(x) as s from f), r as (select *, row_number() over (partition by record_id, ingested_at order by -length(s), s) as n from (select distinct * from e))
select record_id, ingested_at, sha256(string_agg(s, chr(10) order by n)) as leaves from r where n <= 4 group by record_id, ingested_at"""
)
def string_leaves(spark, d):
    """The longest distinct text fields of a record, at most four, as one text."""
    leaves = X.longest_leaves(*[F.col(c) for c in ("package_title", "organization_title", "text", "source_name", "package_name")])
    return _records(spark, d).select("record_id", "ingested_at", X.sha(leaves).alias("leaves")).distinct()


@query(
    """select doc_id, case when lower(trim(lang)) in ('1', 'true', 'yes', 'y', 'on') then true when lower(trim(lang)) in ('0', 'false', 'no', 'n', 'off', '') then false end as flag,
translate(lower(trim(register)), 'àâäáãåçéèêëíîïìñóôöõòúùûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy') as register from documents"""
)
def tolerant_values(spark, d):
    return _documents(spark, d).select("doc_id", X.truthy("lang").alias("flag"), X.atom("register").alias("register"))


# --- pages and catalogue --------------------------------------------------------------------------------------------

_PAGE_LINES = f"""(select record_id, ingested_at, cast(n - 1 as int) as line_no, line from (select record_id, ingested_at, generate_subscripts(x, 1) as n, unnest(x) as line from
(select record_id, ingested_at, list_filter([{S.clean('y')} for y in {S.lines('text')}], lambda z: z <> '') as x from assnat_fixture_harvest)))"""


def _page_lines(spark, d):
    return _pages(spark, d).select("record_id", "ingested_at", F.posexplode(X.lines("text")).alias("line_no", "line"))


@query(
    f"""select record_id, count(*) as lines, count_if(length(line) < 8 or regexp_matches(lower(line), '^(?:{"|".join(html.NAVIGATION).replace("'", "''")})(?: .*)?$')) as navigation from {_PAGE_LINES} group by record_id"""
)
def navigation_lines(spark, d):
    own = _page_lines(spark, d)
    return own.groupBy("record_id").agg(F.count(F.lit(1)).alias("lines"), F.count_if(html.is_navigation(F.col("line"))).alias("navigation"))


@query(
    f"""select speaker, count(*) as lines from (select nullif({S.clean("regexp_extract(line, '^(M\\.|Mme|Mmes|MM\\.|Le président|La présidente|Le député|La députée|[A-ZÉÈÀÂÊÎÔÛÇ][^:]{2,80})\\s*:', 1)")}, '') as speaker from {_PAGE_LINES}) where speaker is not null group by speaker"""
)
def speakers(spark, d):
    own = _page_lines(spark, d).select(html.speaker(F.col("line")).alias("speaker"))
    return own.where("speaker is not null").groupBy("speaker").agg(F.count(F.lit(1)).alias("lines"))


@query(
    f"""select record_id, ingested_at, coalesce(nullif(regexp_extract(text, '(?:^|[^0-9A-Za-z_])(20\\d{{2}}-\\d{{2}}-\\d{{2}})(?:$|[^0-9A-Za-z_])', 1), ''),
nullif(regexp_extract(lower(text), '(?:^|[^0-9\\p{{L}}_])([0-3]?\\d[\\s\\p{{Z}}]+(?:{html.MONTHS})[\\s\\p{{Z}}]+20\\d{{2}})(?:$|[^0-9\\p{{L}}_])', 1), '')) as date from assnat_fixture_harvest"""
)
def page_dates(spark, d):
    return _pages(spark, d).select("record_id", "ingested_at", html.date_in(F.col("text")).alias("date"))


def _license_sql() -> str:
    has = lambda ps: f"regexp_matches(m, '{'|'.join(p.replace('.', chr(92) + '.') for p in ps)}')"
    return f"""select license_class, count(*) as n from (select case when {has(catalogue.BLOCKED)} then 'blocked' when {has(catalogue.NONCOMMERCIAL)} then 'noncommercial_only' when {has(catalogue.OPEN)} then 'open_compatible' else 'unknown' end as license_class
from (select lower(coalesce(license_id, '') || ' ' || coalesce(license_name, '') || ' ' || coalesce(license_url, '')) as m from donnees_quebec_fixture_harvest)) group by 1"""


@query(_license_sql())
def license_class(spark, d):
    own = _records(spark, d).select(catalogue.license_class(F.col("license_id"), F.col("license_name"), F.col("license_url")).alias("license_class"))
    return own.groupBy("license_class").agg(F.count(F.lit(1)).alias("n"))


_LABELS = "list_sort(list_distinct(list_filter([{c} for y in {x}], lambda s: s is not null and s <> '')))"


@query(
    f"""with p as (select record_id, ingested_at, {S.clean('package_title')} as t, {S.clean('organization_title')} as o, array_to_string({_LABELS.format(c=S.clean('y'), x='tags')}, ', ') as k,
array_to_string({_LABELS.format(c=S.clean('y'), x='groups')}, ', ') as g,
array_to_string(list_filter([array_to_string(list_filter([{S.clean("r['name']")}, {S.clean("r['description']")}], lambda v: v is not null and v <> ''), ': ') for r in resource_metadata], lambda s: s <> ''), ' | ') as r from donnees_quebec_fixture_harvest)
select record_id, ingested_at, array_to_string(list_filter([case when t <> '' then 'Titre: ' || t end, case when o <> '' then 'Organisation: ' || o end, case when k <> '' then 'Mots-clés: ' || k end,
case when g <> '' then 'Groupes: ' || g end, case when r <> '' then 'Ressources: ' || r end], lambda v: v is not null), chr(10) || chr(10)) as package_text from p"""
)
def package_text(spark, d):
    made = catalogue.package_text(F.col("package_title"), F.lit(None).cast("string"), F.col("organization_title"), F.col("tags"), F.col("groups"), F.col("resource_metadata"))
    return _records(spark, d).select("record_id", "ingested_at", made.alias("package_text"))


@query(
    """select coalesce(organization_name, 'unknown') as organization, count(*) as records, count(distinct package_id) as packages, count(distinct record_id) as distinct_records,
sum(coalesce(resource_count, 0)) as resources, min(metadata_created) as first_created from donnees_quebec_fixture_harvest group by 1"""
)
def catalogue_rollup(spark, d):
    return _records(spark, d).groupBy(F.coalesce("organization_name", F.lit("unknown")).alias("organization")).agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("package_id").alias("packages"), F.countDistinct("record_id").alias("distinct_records"),
        F.sum(F.coalesce("resource_count", F.lit(0))).alias("resources"), F.min("metadata_created").alias("first_created"),
    )


@query(
    """with r as (select coalesce(source_id, 'unknown') as source_id, coalesce(license_status, 'unknown') as l, coalesce(domain, 'unknown') as d, not coalesce(allowed_for_training, false) or coalesce(holdout_only, false) as skipped from donnees_quebec_fixture_harvest),
l as (select source_id, string_agg(l || '=' || n, ' ' order by l) as licences from (select source_id, l, count(*) as n from r group by all) group by 1), d as (select source_id, string_agg(d || '=' || n, ' ' order by d) as domains from (select source_id, d, count(*) as n from r group by all) group by 1)
select source_id, count(*) as seen, count(*) - count_if(skipped) as selected, count_if(skipped) as skipped, any_value(licences) as licences, any_value(domains) as domains from r join l using (source_id) join d using (source_id) group by source_id"""
)
def acquisition_rollup(spark, d):
    """What came of each source: records seen, selected and skipped, by licence and domain."""
    own = _records(spark, d).select(F.coalesce("source_id", F.lit("unknown")).alias("source_id"), "license_status", "domain", (~F.coalesce("allowed_for_training", F.lit(False)) | F.coalesce("holdout_only", F.lit(False))).alias("skipped"))
    return audit.rollup(own, "source_id", "skipped", {"licences": "license_status", "domains": "domain"})


@query("select package_id, record_id, package_title from (select *, row_number() over (partition by package_id order by ingested_at desc, record_id desc) as n from donnees_quebec_fixture_harvest where package_id is not null) where n = 1")
def latest_package(spark, d):
    """Of a package found several times the last payload is taken."""
    from boreal.operators.lexical import latest_by_key

    own = _records(spark, d).where("package_id is not null").select("package_id", "record_id", "package_title", "ingested_at")
    return latest_by_key(own, "package_id", ["ingested_at", "record_id"]).drop("ingested_at")


@query("select tag, count(*) as n from (select unnest(tags) as tag from donnees_quebec_fixture_harvest) group by tag")
def tag_counts(spark, d):
    return audit.count_items(_records(spark, d), "tags", "tag")


@query("select flag, count(*) as n from (select unnest(quality_flags) as flag from donnees_quebec_fixture_harvest) group by flag")
def quality_flag_counts(spark, d):
    return audit.count_items(_records(spark, d), "quality_flags", "flag")


_ROUTES = (("holdout", "holdout_only"), ("training_not_allowed", "allowed_for_training = false"), ("needs_review", "requires_review"), ("license_missing", "license_id is null or trim(license_id) = ''"))


@query(f"select outcome, count(*) as n from (select case {' '.join(f'when {c} then {S.quote(n)}' for n, c in _ROUTES)} else 'accepted' end as outcome from donnees_quebec_fixture_harvest) group by 1")
def record_routing(spark, d):
    """A cascade of rules, first match wins."""
    return rules.route(_records(spark, d), [(n, F.expr(c)) for n, c in _ROUTES]).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query(" union all ".join(f"select record_id, {S.quote(n)} as violation from donnees_quebec_fixture_harvest where {c}" for n, c in _ROUTES))
def record_violations(spark, d):
    """All rules a record breaks."""
    return rules.violations(_records(spark, d), "record_id", [(n, F.expr(c)) for n, c in _ROUTES])


# --- curation, audit ------------------------------------------------------------------------------------------------


def _curation_sql(tail: str) -> str:
    p = curation.CurationPolicy()
    has = lambda m: f"contains(k, {S.quote(m)})"
    none = " and ".join(f"not {has(m)}" for m in p.markers)
    upper = "coalesce(length(regexp_replace(text, '[^\\p{Lu}]', '', 'g')) / nullif(length(regexp_replace(text, '[^\\p{L}]', '', 'g')), 0), 0.0) > 0.45"
    parts = [(f"marker:{m}", has(m), w) for m, w in p.markers.items()] + [(f"penalty:{m}", has(m), -w) for m, w in p.penalties.items()]
    parts += [("penalty:too_short", f"length({S.clean('text')}) < 20", -p.short), ("penalty:excessive_uppercase_ratio", upper, -p.upper), ("penalty:low_marker_score", none, -p.unmarked), ("penalty:duplicate_text", "dup", -p.duplicate)]
    score = f"{p.base}::double" + "".join(f" + case when {c} then ({w})::double else 0.0::double end" for _, c, w in parts)
    why = "list_filter([" + ", ".join(f"case when {c} then {S.quote(n)} end" for n, c, _ in parts) + "], lambda x: x is not null)"
    return f"""with n as (select doc_id, text, {S.norm('text')} as k from documents where text is not null),
f as (select *, row_number() over (partition by k order by doc_id) > 1 as dup from n),
s as (select doc_id, {score} as s, {why} as reasons from f),
l as (select doc_id, round(s, 6) as curation_score, reasons, case when s < {p.reject} then 'rejected' when s < {p.quarantine} then 'quarantine' when s < {p.review} then 'review_required' when s >= {p.accept} then 'accepted' else 'review_required' end as curation_label from s) {tail}"""


def _curated(spark, d):
    own = _documents(spark, d).where("text is not null").select("doc_id", "text")
    return curation.score_records(own, curation.CurationPolicy(), ["doc_id"])


@query(_curation_sql("select doc_id, curation_score, curation_label, array_to_string(reasons, ' ') as reasons from l"))
def curation_labels(spark, d):
    return _curated(spark, d).select("doc_id", "curation_score", "curation_label", F.array_join("curation_reasons", " ").alias("reasons"))


@query(_curation_sql("select reason, count(*) as n from (select unnest(reasons) as reason from l) group by reason"))
def curation_reason_counts(spark, d):
    return audit.count_items(_curated(spark, d), "curation_reasons", "reason")


@query(_curation_sql("select curation_label, count(*) as n from l group by curation_label"))
def curation_label_counts(spark, d):
    return _curated(spark, d).groupBy("curation_label").agg(F.count(F.lit(1)).alias("n"))


def _readiness_sql(by: str) -> str:
    head, tail = (f"coalesce({by}, 'unknown') as {by}, ", f" group by coalesce({by}, 'unknown')") if by else ("", "")
    return f"""select *, case {' '.join(f"when corpus_tokens >= {n} then '{k}'" for k, n in audit.LEVELS)} else 'insufficient' end as level from
(select {head}count(*) as records, sum(cast(trunc(greatest(length(text) / 4.0, len({S.words('text')}) * 1.35)) as bigint)) as row_tokens,
cast(trunc(greatest(sum(length(text)) / 4.0, sum(len({S.words('text')})) * 1.35)) as bigint) as corpus_tokens,
count(*) - count(distinct text) as duplicate_exact, count(*) - count(distinct {S.norm('text')}) as duplicate_normalized from documents where text is not null{tail})"""


@query(_readiness_sql(""))
def readiness(spark, d):
    return audit.readiness(_documents(spark, d).where("text is not null"))


@query(_readiness_sql("source"))
def readiness_by_source(spark, d):
    own = _documents(spark, d).where("text is not null").withColumn("source", F.coalesce("source", F.lit("unknown")))
    return audit.readiness(own, ["source"])


_KEYS = ("source", "domain", "register", "lang")
_COUNTS = " union all ".join(f"select '{k}' as key, coalesce({k}, 'unknown') as value, count(*) as n from documents group by 2" for k in _KEYS)


@query(_COUNTS)
def balance_counts(spark, d):
    return audit.count_by(_documents(spark, d), _KEYS)


@query(f"select key, max(n) / sum(n) as max_share from ({_COUNTS}) group by key")
def max_shares(spark, d):
    return audit.max_share(audit.count_by(_documents(spark, d), _KEYS))


@query(f"select doc_id, source from (select doc_id, source, row_number() over (partition by source order by sha256('42:' || doc_id::varchar), doc_id) as n from documents where source is not null) where n <= 5")
def limit_per_source(spark, d):
    """At most five documents a source, in the order of their hash: a limit per source is the feature here."""
    own = _documents(spark, d).where("source is not null").select("doc_id", "source", balance.drop_score(42, F.col("doc_id").cast("string")).alias("h"))
    return balance.first_per_key(own, "source", ["h", "doc_id"], 5).select("doc_id", "source")


@query("select coalesce(source, 'unknown') as source, list_sort(list_distinct(array_agg(domain) filter (where domain is not null))) as covered from documents group by 1")
def domain_coverage(spark, d):
    return audit.coverage(_documents(spark, d).withColumn("source", F.coalesce("source", F.lit("unknown"))), "source", "domain")


# --- sampling, splits -----------------------------------------------------------------------------------------------


@query(f"select doc_id, {S.unit('sha256(' + S.norm('text') + chr(41) + chr(32) + chr(124) * 2 + chr(32) + S.quote(':') + chr(32) + chr(124) * 2 + ' doc_id::varchar')} <= 0.5 as kept from documents where text is not null")
def probabilistic_keep(spark, d):
    key = F.concat_ws(":", X.sha(X.norm_key("text")), F.col("doc_id").cast("string"))
    return _documents(spark, d).where("text is not null").select("doc_id", balance.probable(key, 0.5).alias("kept"))


@query(f"select doc_id, case when {S.unit(S.quote('7:') + ' || doc_id::varchar')} < 0.8 then 'train' else 'dev' end as split from documents")
def hash_split(spark, d):
    return _documents(spark, d).select("doc_id", splits.hash_split(F.col("doc_id").cast("string"), 7, 0.8).alias("split"))


@query(
    """with n as (select doc_id, row_number() over (order by sha256('42:' || doc_id::varchar), doc_id) as n, count(*) over () as t from documents)
select doc_id, case when n <= trunc(t * 0.9) then 'train' when n <= trunc(t * 0.9) + trunc(t * 0.05) then 'dev' else 'test' end as split from n"""
)
def shuffled_split(spark, d):
    return splits.shuffled_split(_documents(spark, d).select("doc_id"), "doc_id", 42, {"train": 0.9, "dev": 0.05, "test": 0.05}).select("doc_id", "split")


@query(
    """with g as (select coalesce(source, 'unknown') as g, count(*) as n, sha256('42:' || coalesce(source, 'unknown')) as h from documents group by 1, 3),
b as (select *, coalesce(sum(n) over (order by h, g rows between unbounded preceding and 1 preceding), 0) + n / 2 as middle, sum(n) over () as t from g),
c as (select *, greatest(trunc(t * 0.05), 1) as dev, greatest(t - trunc(t * 0.9) - trunc(t * 0.05), 1) as test from b),
s as (select *, case when middle < t - dev - test then 'train' when middle < t - test then 'dev' else 'test' end as split from c),
m as (select g from s where split = 'train' order by n, h, g limit (case when exists (select 1 from s where split = 'dev') then 0 else 1 end))
select doc_id, source, case when s.g in (select g from m) then 'dev' else split end as split from documents join s on s.g = coalesce(source, 'unknown')"""
)
def grouped_split(spark, d):
    """Documents split so that no source is in two splits."""
    own = _documents(spark, d).select("doc_id", "source")
    return splits.grouped_split(own, "source", 42, {"train": 0.9, "dev": 0.05, "test": 0.05})


_RANKED = "(select doc_id, {k}, coalesce({k}, 'unknown') as k, row_number() over (partition by coalesce({k}, 'unknown') order by sha256('42:' || doc_id::varchar), doc_id) as rank, count(*) over (partition by coalesce({k}, 'unknown')) as n from documents)"


@query(
    f"""with r as (select * from {_RANKED.format(k='source')}), c as (select k, count(*) as n from r group by k),
l as (select level, (select sum(least(n, level)) from c) as t from (select unnest(range(1, (select max(n) + 1 from c))) as level))
select doc_id, source from r where rank <= (select max(level) from l where level = 1 or level <= (0.05 + 1e-9) * t)"""
)
def share_cap_source(spark, d):
    """Documents left when no source may hold more than a twentieth."""
    own = _documents(spark, d).select("doc_id", "source", balance.drop_score(42, F.col("doc_id").cast("string")).alias("h"))
    return balance.share_cap(own, "source", 0.05, ["h", "doc_id"]).select("doc_id", "source")


@query(
    f"""with r as (select * from {_RANKED.format(k='domain')}), c as (select k, count(*) as n from r group by k), t as (select sum(n) as all_rows from c),
p as (select unnest(range(0, coalesce((select n from c where k = 'politics'), 0) + 1)) as p), q as (select unnest(range(0, coalesce((select n from c where k = 'literature'), 0) + 1)) as q),
x as (select p, q, all_rows - coalesce((select n from c where k = 'politics'), 0) - coalesce((select n from c where k = 'literature'), 0) + p + q as total from p, q, t),
ok as (select max(p) as p, max(q) as q from x where (p <= 1 or p <= (0.2 + 1e-9) * total) and (q <= 1 or q <= (0.15 + 1e-9) * total))
select doc_id, domain from r, ok where rank <= case k when 'politics' then p when 'literature' then q else n end"""
)
def share_cap_domain(spark, d):
    """A cap for each domain; domains without one are free."""
    own = _documents(spark, d).select("doc_id", "domain", balance.drop_score(42, F.col("doc_id").cast("string")).alias("h"))
    return balance.share_cap(own, "domain", {"politics": 0.2, "literature": 0.15}, ["h", "doc_id"]).select("doc_id", "domain")


@query(
    """with h as (select coalesce(source, 'unknown') as source, sha256(doc_id::varchar || chr(31) || coalesce(text, chr(1) || 'x')) as d, doc_id, text from documents),
x as (select source, """
    + ", ".join(f"sum(('0x' || substr(sha256(doc_id::varchar || chr(31) || text), {8 * i + 1}, 8))::bigint)::varchar as p{i}" for i in range(8))
    + ", count(*) as rows from h where text is not null group by source) select source, rows, sha256(p0 || ':' || p1 || ':' || p2 || ':' || p3 || ':' || p4 || ':' || p5 || ':' || p6 || ':' || p7) as content_sha256 from x"
)
def content_hash_by_source(spark, d):
    own = _documents(spark, d).where("text is not null").withColumn("source", F.coalesce("source", F.lit("unknown")))
    return audit.content_hash(own, ["doc_id", "text"], ["source"])


#: Sums widen in SQL; these columns keep the queries' types.
SQL |= {q: S.typed(SQL[q], columns) for q, columns in {
    "normalized_dedup_by_source": {"tokens": "bigint"},
    "navigation_lines": {"navigation": "bigint"},
    "acquisition_rollup": {"selected": "bigint", "skipped": "bigint"},
    "catalogue_rollup": {"resources": "bigint"},
    "readiness": {"row_tokens": "bigint"},
    "readiness_by_source": {"row_tokens": "bigint"},
    "text_measures": {"words": "int"},
}.items()}
