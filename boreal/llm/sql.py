"""The same results in SQL for the queries SQL can express on whole tables."""

from __future__ import annotations

_WORDS = r"list_distinct(regexp_extract_all(lower(nfc_normalize({text})), '[\p{{L}}\p{{N}}]+'))"
_PLAIN = r"nullif(lower(regexp_replace({x}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')), '')"
_RECORD = r"^[^:]*[^:\s][^:]*:[0-9]+:[0-9a-f]{12}$"
_ALL = "(select source_id, source_record_id from train union all select source_id, source_record_id from dev union all select source_id, source_record_id from test)"

_TIES = f"""
ties as (select distinct s, r from (select {_PLAIN.format(x='source_id')} as s, {_PLAIN.format(x='source_record_id')} as r from {_ALL})
  where s is not null and r is not null and regexp_full_match(r, '{_RECORD}')),
edges as (select distinct a.s as a, b.s as b from ties a join ties b using (r) where a.s <> b.s),
reach as (select a, b from edges union select reach.a, edges.b from reach join edges on reach.b = edges.a)
"""

_TURN = r"regexp_extract_all(text, '(?is)<\|im_start\|>\s*assistant\b(.*?)(?:<\|im_end\|>|$)', 1)"

_GRAMS = """(select {key} as id, g, unnest(range(1, len(w) - 10)) as i, w from (select {key}, regexp_extract_all(lower(nfc_normalize(text)), '[\\p{{L}}\\p{{N}}]+') as w, 0 as g from {name} where text is not null) where len(w) >= 12)"""
_LEAKS = f"""select distinct d.id as doc_id, b.id as item_id
  from (select id, array_to_string(w[i:i + 11], ' ') as s from {_GRAMS.format(key='doc_id', name='documents')}) d
  join (select id, array_to_string(w[i:i + 11], ' ') as s from {_GRAMS.format(key='item_id', name='benchmark')}) b using (s)"""

_GROUPS = f"""
with recursive sets as (select distinct record_id as id, list_sort({_WORDS.format(text='text')}) as w from donnees_quebec_fixture_harvest where record_id is not null and text is not null),
one as (select w, row_number() over (order by w) as k, len(w) as n from (select distinct w from sets where len(w) > 0)),
words as (select k, n, unnest(w) as word from one),
links as (select a.k as a, b.k as b from words a join words b on a.word = b.word and a.k <> b.k group by a.k, b.k, a.n, b.n having count(*) >= 0.65 * (a.n + b.n - count(*))),
reach as (select k as a, k as b from one union select reach.a, links.b from reach join links on reach.b = links.a),
part as (select a as k, min(b) as part from reach group by a),
own as (select s.id, o.k, p.part, (select count(*) from links where links.a = o.k) as links from sets s join one o using (w) join part p on p.k = o.k),
named as (select part, min(id) as group_id from own group by part)
select id as record_id, min(group_id) as group_id, sum(links)::bigint as links from own join named using (part) group by id"""

_PAIRS_OF_SPLITS = f"""
rows as (select 0 as side, example_id, text from train union all select 1, example_id, text from dev union all select 1, example_id, text from test),
sets as (select distinct side, example_id as id, {_WORDS.format(text=f"array_to_string({_TURN}, ' ')")} as w from rows where example_id is not null and text is not null),
numbered as (select *, row_number() over (order by side, id) as k, len(w) as n from sets where len(w) > 0),
words as (select side, k, unnest(w) as word from numbered),
pairs as (select a.k as ka, b.k as kb, count(*) as n_both from words a join words b on a.word = b.word and a.side = 0 and b.side = 1 group by 1, 2),
near as (select a.id as a, b.id as b from pairs join numbered a on a.k = ka join numbered b on b.k = kb where n_both >= 0.65 * (a.n + b.n - n_both))"""

_HITS = f"""select d.id as doc_id, b.id as item_id, d.i as d, b.i as b from (select id, i, array_to_string(w[i:i + 11], ' ') as s from {_GRAMS.format(key='doc_id', name='documents')}) d
  join (select id, i, array_to_string(w[i:i + 11], ' ') as s from {_GRAMS.format(key='item_id', name='benchmark')}) b using (s)"""

_EXAMPLES = " union all ".join(f"select example_id, source_id, source_record_id from {t}" for t in ("train", "dev", "test"))


def _draw(split: str) -> str:
    return f"((('0x' || substr(sha256('42|' || component || '|{split}'), 1, 12))::bigint + 0.5) / 281474976710656.0)"


_SPLITS = f"""
with recursive rows as (select example_id, {_PLAIN.format(x='source_id')} as source, case when regexp_full_match({_PLAIN.format(x='source_record_id')}, '{_RECORD}') then {_PLAIN.format(x='source_record_id')} end as record from ({_EXAMPLES}) where example_id is not null),
nodes as (select *, coalesce(source, 'record ' || record, 'example ' || example_id) as node from rows),
ties as (select distinct node, record as r from nodes where record is not null union select distinct node, 'example ' || example_id from nodes),
least as (select r, min(node) as hub from ties group by r having count(*) > 1),
edges as (select node as a, hub as b from ties join least using (r) where node <> hub union select hub, node from ties join least using (r) where node <> hub),
reach as (select a, b from edges union select reach.a, edges.b from reach join edges on reach.b = edges.a),
parts as (select a as node, min(b) as component from reach group by a),
placed as (select example_id, coalesce(component, first) as component from (select example_id, min(node) as first from nodes group by example_id) left join parts on node = first),
sizes as (select component, count(*) as n from placed group by component),
total as (select count(*) as t from placed),
weights as (select t, least(1.0, 0.05 * t / (select sum(n) from sizes where n <= 0.05 * t)) as w from total),
drawn as (select component, case when n <= 0.05 * t then w else 0.0 end as small, {', '.join(f"{_draw(k)} as u_{k}" for k in ('train', 'dev', 'test'))} from sizes, weights),
scored as (select component, list_sort([{{'s': case when 1 - 2 * small > 0 then -ln(u_train) / (1 - 2 * small) else 'inf'::double end, 'k': 'train'}}, {{'s': case when small > 0 then -ln(u_dev) / small else 'inf'::double end, 'k': 'dev'}},
 {{'s': case when small > 0 then -ln(u_test) / small else 'inf'::double end, 'k': 'test'}}])[1]['k'] as split from drawn)
select example_id, component, split from placed join scored using (component)"""

ORACLES = {
    "p8_found": _LEAKS,
    "p8_kept": f"select doc_id, source from documents where doc_id not in (select doc_id from ({_LEAKS}))",
    "p8_items": f"""with hits as ({_HITS}), runs as (select *, d - b as diagonal, d - row_number() over (partition by doc_id, item_id, d - b order by d) as island from (select distinct * from hits))
select item_id, count(distinct doc_id) as documents, cast(max(words) as int) as longest from (select doc_id, item_id, count(*) + 11 as words from runs group by doc_id, item_id, diagonal, island) group by item_id""",
    "p3_splits": _SPLITS,
    "p4_groups": _GROUPS,
    "p5_report": f"""with {_PAIRS_OF_SPLITS},
held as (select split, example_id, min(source_id) as source_id from (select 'dev' as split, example_id, {_PLAIN.format(x='source_id')} as source_id from dev union all select 'test', example_id, {_PLAIN.format(x='source_id')} from test) where example_id is not null group by 1, 2)
select split, source_id, count_if(example_id in (select b from near)) as leaked, count(*) as examples from held group by 1, 2""",
    "p7_whole": "select doc_id, true as within_capacity, true as contiguous, true as kept_whole from documents",
    "p3_found": f"with recursive {_TIES} select distinct a as source_id_a, b as source_id_b from reach where a < b",
    "p4_found": f"""
with sets as (select distinct record_id as id, {_WORDS.format(text='text')} as w from donnees_quebec_fixture_harvest where record_id is not null and text is not null),
numbered as (select *, row_number() over (order by id) as k, len(w) as n from sets where len(w) > 0),
words as (select k, unnest(w) as word from numbered),
pairs as (select a.k as ka, b.k as kb, count(*) as n_both from words a join words b on a.word = b.word and a.k < b.k group by 1, 2)
select distinct least(a.id, b.id) as record_id_a, greatest(a.id, b.id) as record_id_b
from pairs join numbered a on a.k = ka join numbered b on b.k = kb
where a.id <> b.id and n_both >= 0.65 * (a.n + b.n - n_both)""",
    "p5_found": f"""with {_PAIRS_OF_SPLITS} select distinct least(a, b) as example_id_a, greatest(a, b) as example_id_b from near where a <> b""",
}
