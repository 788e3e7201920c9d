"""SQL twins of the queries that SQL can express.

Packing, sharding, the fingerprints and the classifier are beyond SQL; the line and page
queries and the conversation digests are tested against brute force instead.
"""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


_URL_RULES = f"""
with rules(verdict, host, path) as (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
    ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
  rest as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as r from pages),
  split as (select row_number() over () as n, page_id, {_lower("regexp_extract(r, '^[^/?#]*', 0)")} as host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path from rest),
  fit as (select n, r.host || r.path as rule, r.verdict from split s join rules r
    on (s.host = r.host or ends_with(s.host, '.' || r.host)) and starts_with(s.path, r.path)),
  best as (select n, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict from fit group by n)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from split left join best using (n)
"""

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CONTAMINATION = f"""
with d as (select row_number() over () as n, doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_WORDS}') as w from documents),
  b as (select item_id, regexp_extract_all({_lower("text")}, '{_WORDS}') as w from benchmark where text is not null),
  bk as (select item_id, w, least(10, len(w)) as k from b where len(w) > 0),
  bw as (select distinct k, item_id, array_to_string(w[i:i + k - 1], ' ') as win
    from (select item_id, w, k, unnest(range(1, len(w) - k + 2)) as i from bk)),
  dw as (select n, k, i, array_to_string(w[i:i + k - 1], ' ') as win
    from (select n, w, k, unnest(range(1, len(w) - k + 2)) as i from d, (select distinct k from bw) where len(w) >= k)),
  hit as (select n, i, bw.k, item_id from dw join bw on dw.k = bw.k and dw.win = bw.win),
  covered as (select n, count(*) as n_hit from (select distinct n, unnest(range(i, i + k)) as p from hit) group by n),
  named as (select n, count(*) as n_items, string_agg(item, ',' order by item) as items
    from (select distinct n, cast(item_id as varchar) as item from hit) group by n)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (n) left join named using (n)
"""

_GAP = r"[ \t\n\x0b\x0c\r]"
_WORD = r"[^ \t\n\x0b\x0c\r]+"
_QUALITY = f"""
with d as (select row_number() over () as n, doc_id, lang, source, coalesce(text, '') as t from documents),
  w as (select *, regexp_extract_all(t, '{_WORD}') as w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as l from d),
  win as (select n, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as v from (select n, w, unnest(range(1, len(w) - 1)) as i from w where len(w) > 2)),
  twice as (select n, i from (select n, i, count(*) over (partition by n, v) as c from win) where c > 1),
  rep as (select n, count(*) as r from (select distinct n, unnest([i, i + 1, i + 2]) as p from twice) group by n),
  base as (select n, doc_id, lang, source, len(w)::bigint as n_words, length(regexp_replace(t, '{_GAP}', '', 'g'))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, len(l)::bigint as n_lines,
    (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(r, 0)::bigint as n_repeat_words from w left join rep using (n)),
  m as (select *, least(n_symbols * 1000 // greatest(n_words, 1), 10000) as symbol_share, n_dup_lines * 1000 // greatest(n_lines, 1) as dup_line_share,
    n_repeat_words * 1000 // greatest(n_words, 1) as repeat_share, least(word_chars * 16 // greatest(n_words, 1), 10000) as word_length from base),
  long as (unpivot m on symbol_share, dup_line_share, repeat_share, word_length into name measure value bucket),
  ranked as (select *, count(*) over g as sg, row_number() over (g order by bucket) as rg, count(*) over s as ss,
      row_number() over (s order by bucket) as rs, count(*) over a as sa, row_number() over (a order by bucket) as ra
    from long window g as (partition by measure, lang, source), s as (partition by measure, lang), a as (partition by measure)),
  marked as (select *, min(case when 4 * rg >= sg then bucket end) over g as g1, min(case when 4 * rg >= 3 * sg then bucket end) over g as g3,
      min(case when 4 * rs >= ss then bucket end) over s as s1, min(case when 4 * rs >= 3 * ss then bucket end) over s as s3,
      min(case when 4 * ra >= sa then bucket end) over a as a1, min(case when 4 * ra >= 3 * sa then bucket end) over a as a3
    from ranked window g as (partition by measure, lang, source), s as (partition by measure, lang), a as (partition by measure)),
  picked as (select n, measure, bucket, case when sg >= 30 then g1 when ss >= 30 then s1 else a1 end as q1,
      case when sg >= 30 then g3 when ss >= 30 then s3 else a3 end as q3,
      case measure when 'symbol_share' then 50 when 'dup_line_share' then 300 when 'repeat_share' then 200 else 24 end as margin from marked),
  judged as (select n, bool_or(bucket > q3 + greatest(3 * (q3 - q1), margin)) as outlier from picked group by n)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and not outlier as kept
from base join judged using (n)
"""

# CRC-32 of the decimal id, bit by bit: a byte comes in at the first of its eight steps.
_CRC = """list_reduce([4294967295] || flatten(list_transform(string_split(cast(doc_id as varchar), ''),
    lambda ch: [ascii(ch)::bigint, 0, 0, 0, 0, 0, 0, 0])), lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1)))"""
_RUNS = f"""
with d as (select row_number() over () as id, doc_id, xor({_CRC}, 4294967295)::bigint as h,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') as w from documents),
  g as (select *, len(w) as n, h // 10 as g from d),
  a as (select *, g % greatest(n, 1) as a from g),
  p as (select *, 1 + (n - a) // (3 + g % 8) as p from a),
  planted as (select id, doc_id, n, case when h % 10 = 0 and n > 0 then list_transform(range(0, n),
    lambda i: case when i < a then w[i + 1] else w[a + (i - a) % p + 1] end) else w end as w from p),
  word as (select id, n, unnest(range(0, n)) as i, unnest(w) as word from planted),
  equal as (select x.id, x.i, y.i - x.i as p from word x join word y
    on x.id = y.id and x.word = y.word and y.i > x.i and 3 * (y.i - x.i) <= x.n),
  stretch as (select id, p, i - row_number() over (partition by id, p order by i) as s, i from equal),
  found as (select id, p, min(i) as start, count(*) + p as length from stretch group by id, p, s
    having count(*) + p >= greatest(24, 3 * p)),
  run as (select id, start, length, min(p) as period from found group by id, start, length),
  best as (select *, row_number() over (partition by id order by length::double / period desc, start, period) as k from run),
  listed as (select id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as t from run group by id),
  gone as (select distinct id, unnest(range(start + period, start + length)) as i from run),
  kept as (select id, string_agg(word, ' ' order by i) as t from word anti join gone using (id, i) group by id)
select doc_id, coalesce(n_runs, 0)::bigint as n_runs, start::bigint as start, length::bigint as length, period::bigint as period,
  (1000 * length // period)::bigint as exponent_milli, sha256(coalesce(listed.t, '')) as runs_sha256, sha256(coalesce(kept.t, '')) as collapsed_sha256
from planted left join listed using (id) left join kept using (id) left join (select * from best where k = 1) using (id)
"""

_PIECE_END = r"[.,;:!?\n\x0b\x0c\r]+"
_PHRASES = f"""
with d as (select row_number() over () as id, coalesce(lang, 'und') as lang, {_lower("coalesce(text, '')")} as t from documents),
  piece as (select lang, regexp_extract_all(unnest(regexp_split_to_array(t, '{_PIECE_END}')), '[^ \t]+') as w from d),
  gram as (select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase
    from piece, (values (1), (2), (3)) as s(k) where len(w) >= k),
  f as (select lang, k, phrase, count(*) as f from gram group by all),
  total as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
  often as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from f where k > 1 and f >= 10),
  cut as (select o.*, c, array_to_string(w[:c], ' ') as head, array_to_string(w[c + 1:], ' ') as rest from often o, (values (1), (2)) as s(c) where c < k),
  scored as (select cut.lang, cut.k, cut.phrase, a, c, h.f as l, r.f as r, (1000000::hugeint * a * a // (h.f::hugeint * r.f))::bigint as score
    from cut join f h on h.lang = cut.lang and h.k = c and h.phrase = head join f r on r.lang = cut.lang and r.k = cut.k - c and r.phrase = cut.rest),
  chosen as (select * from scored qualify row_number() over (partition by lang, phrase order by score, c) = 1),
  held as (select distinct x.lang, x.phrase from often x join (select lang, a, unnest([array_to_string(w[:2], ' '), array_to_string(w[2:], ' ')]) as phrase
    from often where k = 3) y on x.lang = y.lang and x.phrase = y.phrase where 100 * y.a >= 50 * x.a),
  ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from chosen anti join held using (lang, phrase))
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score from ranked join total using (lang) where rank <= 2000
"""

_MIX = f"""
with q as (select doc_id, 0.5::double + 1.5::double * avg(quality) as weight from labels where doc_id is not null and quality is not null group by doc_id),
  d as (select row_number() over () as id, d.doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::bigint as size,
    coalesce(case when weight > 0 then weight end, 1.0::double) as weight from documents d left join q on d.doc_id = q.doc_id),
  s as (select source, sum(size)::bigint as source_size from d group by source),
  p as (select *, ([3, 1, 2])[((row_number() over (order by source nulls last)) - 1) % 3 + 1] as w from s),
  cap as (select *, 2 * source_size as cap, row_number() over (order by 2 * source_size::double / w, source nulls last) as k from p),
  level as (select *, (sum(source_size) over ())::double * 1.5::double - coalesce(sum(cap) over (order by k rows between unbounded preceding and 1 preceding), 0)::double as rest,
    (sum(w) over (order by k rows between current row and unbounded following))::double as among from cap),
  first as (select min(k) as k from level where w * rest / among <= cap),
  t as (select x.source, x.source_size, case when x.k < y.k then x.cap::double else least(x.w * y.rest / y.among, x.cap::double) end as target
    from level x, level y join first on y.k = first.k),
  b as (select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole from t),
  r as (select *, round(target)::bigint - whole * source_size as left_over from b),
  drawn as (select id, doc_id, d.source, size, source_size, target, whole, left_over,
    -ln((('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || '|' || size), 1, 13))::bigint + 0.5::double) / 4503599627370496::double) / weight as draw
    from d join r on d.source is not distinct from r.source),
  grouped as (select source, draw, doc_id, size, count(*) as copies from drawn group by all),
  ran as (select *, sum(copies * size) over (partition by source order by draw, doc_id nulls first, size rows between unbounded preceding and current row) as upto from grouped)
select drawn.doc_id, drawn.size, source_size, target, (whole * drawn.size + case when upto <= left_over then drawn.size
  else greatest(0, left_over - (upto - copies * ran.size)) // copies end)::bigint as taken
from drawn join ran on drawn.source is not distinct from ran.source and drawn.draw = ran.draw and drawn.doc_id is not distinct from ran.doc_id and drawn.size = ran.size
"""

SQL: dict[str, str] = {
    "op1_url_rules": _URL_RULES,
    "op4_decontamination": _CONTAMINATION,
    "op10_quality_rules": _QUALITY,
    "op11_periodic_runs": _RUNS,
    "op12_collocations": _PHRASES,
    "op13_source_mix": _MIX,
}
