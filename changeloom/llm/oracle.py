"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = f"""
with docs as (select doc_id, string_split(coalesce(text, ''), chr(10)) p from documents),
lines as (select doc_id, unnest(p) line, unnest(range(len(p))) pos from docs),
keyed as (select *, {LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} k from lines),
shared as (select k, min(doc_id) first from keyed where length(k) >= 10 group by k having count(distinct doc_id) >= 2),
marked as (select d.doc_id, d.line, d.pos, s.first is not null and d.doc_id <> s.first gone from keyed d left join shared s using (k))
select doc_id, count(*) n_lines, count(*) filter (gone) n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) kept_sha256
from marked group by doc_id
"""

WORDS = "regexp_extract_all(" + LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP6 = f"""
with items as (select item_id, {WORDS} w from benchmark),
docs as (select doc_id, {WORDS} w from documents),
windows as (select distinct item_id, w[i:i + least(len(w), 13) - 1] gram, least(len(w), 13)::int width
  from (select item_id, w, unnest(range(1, greatest(len(w) - 11, 2))) i from items where len(w) > 0)),
widths as (select distinct width from windows),
grams as (select doc_id, w[i:i + width - 1] gram, width, i
  from (select doc_id, w, width, unnest(range(1, len(w) - width + 2)) i from docs, widths)),
hits as (select distinct doc_id, i, width, item_id from grams join windows using (gram, width)),
words as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + width)) p from hits) group by doc_id),
found as (select doc_id, count(*) n_items, string_agg(item, ',' order by item) ids
  from (select distinct doc_id, item_id::varchar item from hits) group by doc_id)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
  sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from docs left join words using (doc_id) left join found using (doc_id)
"""


def seeded(value: str) -> str:
    return f"('0x' || substr(md5('mix-1' || {value}), 1, 15))::bigint"


OP9 = f"""
with sized as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint size from documents),
sums as (select source, sum(size)::bigint source_size, count(*) n from sized group by source),
ranked as (select *, [3, 1, 2][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::bigint weight from sums),
run as (select *, (sum(source_size) over ())::bigint all_size, (sum(weight) over ())::bigint all_weight,
  coalesce(sum(2 * source_size) over b, 0)::bigint cap_before, coalesce(sum(weight) over b, 0)::bigint weight_before
  from ranked window b as (order by (2 * source_size)::double / weight, source nulls last rows between unbounded preceding and 1 preceding)),
marked as (select *, (all_size * 3 / 2::double - cap_before) * weight / (all_weight - weight_before) >= (2 * source_size)::double clamped from run),
totals as (select *, coalesce(sum(2 * source_size) filter (clamped) over (), 0)::bigint cap_sum, (sum(weight) filter (not clamped) over ())::bigint open_weight from marked),
plan as (select source, source_size, n, case when clamped then (2 * source_size)::double
  else (all_size * 3 / 2::double - cap_sum) * weight / open_weight end target from totals),
drawn as (select s.doc_id, s.size, p.source_size, p.target, p.source, {seeded("coalesce(doc_id::varchar, '')")} draw,
  {seeded("coalesce(doc_id::varchar, '')")} % ceil(p.n / 50000.0)::bigint grp,
  case when p.source_size > 0 then p.target / p.source_size else 0 end rate
  from sized s join plan p on s.source is not distinct from p.source),
placed as (select *, row_number() over (partition by source, grp order by size, draw, doc_id) spot, rate - floor(rate) part,
  ({seeded("coalesce(source, '') || '/' || grp::varchar")} % 1000000) / 1e6 start from drawn)
select doc_id, size, source_size, target,
  (size * (floor(rate) + floor(spot * part + start) - floor((spot - 1) * part + start)))::bigint taken
from placed
"""

OP12 = r"""
with d as (select doc_id, coalesce(text, '') t, sha256('7:' || coalesce(doc_id::varchar, '')) h from documents),
u as (select *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') m, ('0x' || h[1:8])::bigint h1, ('0x' || h[9:16])::bigint h2, ('0x' || h[17:24])::bigint h3, ('0x' || h[25:32])::bigint h4 from d),
c as (select *, len(m)::bigint n, least(h1 % (len(m) + 1), h2 % (len(m) + 1)) c1, greatest(h1 % (len(m) + 1), h2 % (len(m) + 1)) c2 from u),
o as (select *, array_to_string(m[1:c1], '') p, array_to_string(m[c1 + 1:c2], '') i, array_to_string(m[c2 + 1:], '') s,
  case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 100 then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end form from c)
select doc_id, n, form, case when form <> 'plain' then length(p)::bigint end prefix_chars, case when form <> 'plain' then length(i)::bigint end middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || i else '<S>' || s || '<P>' || p || '<M>' || i end) output_sha256, sha256(t) restored_sha256
from o
"""

TERMS = "regexp_extract_all(" + LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP13 = f"""
with d as (select doc_id, {TERMS} w from documents),
q as (select item_id, term, count(*) uses from (select item_id, unnest({TERMS}) term from benchmark) group by all),
size as (select count(*) filter (len(w) > 0)::bigint n, sum(len(w))::bigint total from d),
p as (select doc_id, words, term, count(*) tf from (select doc_id, len(w) words, unnest(w) term from d) where term in (select term from q) group by all),
weights as (select term, floor(1000 * ln((2 * n + 2)::double / (2 * df + 1)))::bigint w from (select term, count(*) df from p group by term), size),
scores as (select item_id, doc_id, sum(uses * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * words * n) // total))))::bigint score
  from q join p using (term) join weights using (term), size group by item_id, doc_id)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int "rank", doc_id, score
from scores where score > 0 qualify "rank" <= 10
"""

ORACLE = {"op2_line_dedup": OP2, "op6_decontaminate": OP6, "op9_mix_sources": OP9, "op12_fill_middle": OP12, "op13_lexical_search": OP13}
