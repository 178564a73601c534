"""The queries that SQL can say, as plain DuckDB SQL over whole tables."""

from __future__ import annotations

import re

from gradeloom.llm.chat import CLOSE, CONTROLS, OPEN
from gradeloom.llm.licenses import K, LEAST_SHARE, NEAR, NOTICES, PHRASES

#: Documents as numbered rows, as rows may repeat.
LOW = """translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""
PARTED = f"""string_split_regex({LOW}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""
WORDS = f"""list_filter({PARTED}, lambda w: w <> '')"""


def wordings() -> str:
    """Rows (template, label, exact, place, grams, t0, t1) of all wordings."""
    rows = []
    both = [(p, label, True) for p, label in PHRASES.items()] + [(t, label, False) for label, ts in NOTICES.items() for t in ts]
    for number, (text, label, exact) in enumerate(both):
        parts = re.findall(r"[a-z0-9]+", text.lower())
        for place in range(len(parts) - K + 1):
            rows.append(f"({number}, '{label}', {str(exact).lower()}, {place}, {len(parts) - K + 1}, '{parts[place]}', '{parts[place + 1]}')")
    return ", ".join(rows)


LICENSES = f"""
with templates(template, label, exact, place, grams, t0, t1) as (values {wordings()}),
docs as (select row_number() over () as r, doc_id, {WORDS} as w from documents),
grams as (select r, unnest(range(1, len(w))) as i, w from docs),
met as (
  select distinct r, template, label, exact, grams, i - 1 - place as diagonal, place
  from (select r, i, w[i] as w0, w[i + 1] as w1 from grams) join templates on w0 = t0 and w1 = t1),
diagonals as (select distinct r, template, label, exact, grams, diagonal from met),
shares as (
  select d.r, d.template, d.label, d.exact, d.diagonal, count(distinct m.place) / any_value(d.grams)::double as share
  from diagonals d join met m on m.r = d.r and m.template = d.template
    and m.diagonal between d.diagonal and d.diagonal + case when d.exact then 0 else {NEAR} end
  group by d.r, d.template, d.label, d.exact, d.diagonal),
good as (select * from shares where share >= case when exact then 1.0 else {LEAST_SHARE} end)
select any_value(doc_id) as doc_id, any_value(len(w))::bigint as n_words, count(*) filter (exact) as n_base,
  min(diagonal) filter (exact)::bigint as first_word, max(diagonal) filter (exact)::bigint as last_word,
  coalesce(string_agg(distinct label, ',' order by label) filter (exact), '') as base_labels,
  coalesce(string_agg(distinct label, ',' order by label), '') as labels, coalesce(max(share), 0.0) as score
from docs left join good using (r) group by r
"""

CONTAINED = f"""
with docs as (select doc_id as id, {WORDS} as w from documents),
items as (select item_id as id, {WORDS} as w from benchmark),
doc_runs as (
  select distinct id, array_to_string(w[i:i + 4], ' ') as run
  from (select id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from docs where len(w) > 0)),
item_runs as (
  select distinct id, array_to_string(w[i:i + 4], ' ') as run
  from (select id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from items where len(w) > 0)),
doc_phrases as (
  select distinct id, array_to_string(w[i:i + k - 1], ' ') as run
  from (select id, w, k, unnest(range(1, len(w) - k + 2)) as i
    from docs, (select distinct len(w) as k from items where len(w) between 1 and 4) where len(w) >= k)),
all_runs as (select * from doc_runs union select * from doc_phrases),
sizes as (select id, count(*) as n from item_runs group by id)
select d.id as doc_id, i.id as item_id, any_value(n) as n_shingles, count(*) as n_shared,
  count(*) / any_value(n)::double as containment
from item_runs i join all_runs d using (run) join sizes s on s.id = i.id
group by d.id, i.id having 100 * count(*) >= 75 * any_value(n)
"""

JACCARD = f"""
with recursive docs as (
  select doc_id as id, list_filter(string_split_regex({LOW}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w from documents),
runs as (
  select distinct id, array_to_string(w[i:i + 4], ' ') as run
  from (select id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from docs where len(w) > 0)),
sizes as (select id, count(*) as n from runs group by id),
links as (
  select a.id as a, b.id as b from runs a join runs b using (run) join sizes x on x.id = a.id join sizes y on y.id = b.id
  where a.id <> b.id group by a.id, b.id, x.n, y.n having 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach as (select id as a, id as b from sizes union select r.a, l.b from reach r join links l on l.a = r.b)
select d.id as doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(c, d.id) as component_id
from docs d left join sizes s on s.id = d.id left join (select a, min(b) as c from reach group by a) on a = d.id
"""

REPEATS = """
with docs as (select doc_id as id, hex(encode(coalesce(text, ''))) as h from documents),
places as (
  select id, unnest(range(0, len(h) // 2 - 49)) as i,
    unnest(list_transform(range(0, len(h) // 2 - 49), lambda i: substring(h, 2 * i + 1, 100))) as s
  from docs where len(h) >= 100),
firsts as (select s, min(id) as f from places group by s),
starts as (select id, i from places join firsts using (s) where f < id),
spans as (select id, i, case when i - lag(i) over (partition by id order by i) <= 50 then 0 else 1 end as new from starts),
runs as (select id, min(i) as a, max(i) + 50 as b from (select id, i, sum(new) over (partition by id order by i) as g from spans) group by id, g),
kept as (
  select d.id, any_value(h) as h, count(a) as n_spans, coalesce(sum(b - a), 0) as n_removed,
    list(a order by a) filter (a is not null) as starts, list(b order by a) filter (a is not null) as ends
  from docs d left join runs r using (id) group by d.id)
select id as doc_id, (len(h) // 2)::bigint as n_bytes, n_removed::bigint as n_removed, n_spans,
  sha256(unhex(case when starts is null then h else array_to_string(list_transform(
    range(0, len(starts) + 1), lambda k: substring(h, case when k = 0 then 1 else 2 * ends[k] + 1 end,
      case when k = len(starts) then len(h) else 2 * starts[k + 1] - case when k = 0 then 0 else 2 * ends[k] end end)), '') end)) as kept_sha256
from kept
"""

COLLOCATIONS = r"""
with words as (
  select l, d, p, i, w from (
    select l, d, p, unnest(ws) as w, unnest(range(1, len(ws) + 1)) as i from (
      select l, d, p, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') as ws from (
        select l, d, unnest(ps) as piece, unnest(range(1, len(ps) + 1)) as p from (
          select coalesce(lang, 'und') as l, row_number() over () as d,
            string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') as ps
          from documents))))),
runs as (
  select l, w as w1, lead(w) over t as w2, lead(w, 2) over t as w3 from words window t as (partition by d, p order by i)),
ones as (select l, w1, count(*)::hugeint as f from runs group by all),
twos as (select l, w1, w2, count(*)::hugeint as f from runs where w2 is not null group by all),
threes as (select l, w1, w2, w3, count(*)::hugeint as f from runs where w3 is not null group by all having count(*) >= 10),
longer as (
  select l, w1, w2, max(f) as most from (
    select l, w1, w2, f from threes union all select l, w2 as w1, w3 as w2, f from threes) group by all),
cuts as (
  select t.l, t.w1 || ' ' || t.w2 as phrase, t.f as a, x.f as lf, y.f as rf, 1 as k
  from twos t join ones x on x.l = t.l and x.w1 = t.w1 join ones y on y.l = t.l and y.w1 = t.w2
  left join longer m on m.l = t.l and m.w1 = t.w1 and m.w2 = t.w2
  where t.f >= 10 and not coalesce(100 * m.most >= 50 * t.f, false)
  union all
  select t.l, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, x.f, y.f, 1
  from threes t join ones x on x.l = t.l and x.w1 = t.w1 join twos y on y.l = t.l and y.w1 = t.w2 and y.w2 = t.w3
  union all
  select t.l, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, x.f, y.f, 2
  from threes t join twos x on x.l = t.l and x.w1 = t.w1 and x.w2 = t.w2 join ones y on y.l = t.l and y.w1 = t.w3),
scored as (select *, (1000000::hugeint * a * a) // (lf * rf) as score from cuts),
worst as (select * from scored qualify row_number() over (partition by l, phrase order by score, k) = 1),
ranked as (select *, row_number() over (partition by l order by score desc, a desc, encode(phrase)) as rank from worst),
sizes as (select l, sum(f) as n from ones group by l)
select l as lang, rank, phrase, a::bigint as a, lf::bigint as l, rf::bigint as r, n::bigint as n, score::bigint as score
from ranked join sizes using (l) where rank <= 2000
"""



def escaped(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for control in CONTROLS:
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return out


CHAT = f"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as t from conversations
  union all select * from (values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')))
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || t || chr(10), '' order by turn nulls first, role, t)) as turns_sha256,
  coalesce(sum(length(t)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(t, '' order by turn nulls first, t) filter (role = 'assistant'), '')) as loss_sha256,
  sum({len(OPEN) + len(CLOSE) + 2} + length(replace({escaped('role')}, chr(10), chr(92) || chr(10))) + length({escaped('t')}))::bigint as formatted_chars
from said group by conv_id
"""

NEGATIVES = """
with rows as (
  select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select a.r as a, a.vec_id as anchor_id, b.r as b, b.vec_id as id, a.label = b.label as same,
    list_inner_product(a.v, b.v)::bigint as score
  from rows a join rows b on a.r <> b.r where a.vec_id % 50 = 0),
positives as (
  select a, anchor_id, row_number() over (partition by a order by score desc, id) as place, id, score
  from scores where same qualify place <= 5),
negatives as (
  select p.a, p.anchor_id, p.place, p.id as positive_id, p.score as positive_score, s.id as negative_id, s.score as negative_score,
    row_number() over (partition by p.a, p.place order by s.score desc, s.id) as rank
  from positives p join scores s on s.a = p.a and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from negatives where rank <= 3
"""

SQL = {
    "op3_licenses": LICENSES,
    "op8_suffix_dedup": REPEATS,
    "op9_jaccard_join": JACCARD,
    "op10_decontamination": CONTAINED,
    "op11_collocations": COLLOCATIONS,
    "op12_chat_format": CHAT,
    "op13_hard_negatives": NEGATIVES,
}
