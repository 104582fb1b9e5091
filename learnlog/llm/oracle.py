"""DuckDB SQL for the queries that SQL can express."""

from learnlog.llm.shared import WORD_PATTERN

_FOLDED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    folded = _FOLDED.format(f"coalesce({text}, '')")
    return f"regexp_extract_all({folded}, '{WORD_PATTERN}')"


OP10 = f"""
with d as (select doc_id, {_words("text")} as w from documents),
b as (select item_id, {_words("text")} as w from benchmark),
item_windows as (
  select item_id, least(len(w), 10) as size,
    unnest([array_to_string(w[i : i + least(len(w), 10) - 1], ' ')
            for i in range(1, len(w) - least(len(w), 10) + 2)]) as gram
  from b where len(w) > 0),
sizes as (select distinct size from item_windows),
doc_windows as (
  select doc_id, size, unnest(range(1, len(w) - size + 2)) as place,
    unnest([array_to_string(w[i : i + size - 1], ' ') for i in range(1, len(w) - size + 2)]) as gram
  from d, sizes where len(w) >= size),
hits as (
  select doc_id, place, size, item_id from doc_windows join item_windows using (size, gram)),
hit_words as (
  select doc_id, count(distinct word) as n_hit
  from (select doc_id, unnest(range(place, place + size)) as word from hits) group by doc_id),
hit_items as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items
  from (select distinct doc_id, cast(item_id as varchar) as item_id from hits) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
  coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
  n_hit is not null as contaminated
from d left join hit_words using (doc_id) left join hit_items using (doc_id)
"""


OP11 = r"""
with d as (
  select doc_id, coalesce(text, '') as t, sha256(concat('7:', doc_id)) as h from documents),
u as (
  select *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') as l,
    [('0x' || substr(h, 8 * i + 1, 8))::bigint for i in range(4)] as hs from d),
c as (
  select *, cast(len(l) as bigint) as n, least(hs[1] % (len(l) + 1), hs[2] % (len(l) + 1)) as a,
    greatest(hs[1] % (len(l) + 1), hs[2] % (len(l) + 1)) as b from u),
f as (
  select *, case
      when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') then 'plain'
      when hs[4] % 100 < 50 then 'spm' else 'psm' end as form,
    array_to_string(l[1 : a], '') as p, array_to_string(l[a + 1 : b], '') as m,
    array_to_string(l[b + 1 :], '') as s
  from c)
select doc_id, n, form,
  case when form <> 'plain' then cast(length(p) as bigint) end as prefix_chars,
  case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256
from f
"""

_TERMS = _words("text").replace(WORD_PATTERN, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

OP12 = f"""
with words as (select rowid_, doc_id, unnest({_TERMS}) as term
  from (select row_number() over () as rowid_, doc_id, text from documents)),
tf as (select rowid_, doc_id, term, count(*) as tf from words group by all),
lengths as (select rowid_, sum(tf) as n from tf group by rowid_),
total as (select cast(count(*) as bigint) as big_n, cast(sum(n) as bigint) as big_l from lengths),
norms as (
  select rowid_, 50 + (50 * cast(n as bigint) * big_n) // big_l as m from lengths, total),
weights as (
  select term, cast(floor(1000 * ln((2 * big_n + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w
  from tf, total group by term, big_n),
q as (select distinct item_id, term from (select item_id, unnest({_TERMS}) as term from benchmark)),
scores as (
  select item_id, rowid_, doc_id,
    cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) as bigint) as score
  from q join weights using (term) join tf using (term) join norms using (rowid_)
  group by item_id, rowid_, doc_id),
ranked as (
  select item_id, cast(row_number() over (
    partition by item_id order by score desc, doc_id nulls last) as int) as rank, doc_id, score
  from scores where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 50
"""

OP13 = f"""
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
lines as (select doc_id, unnest(range(1, len(l) + 1)) as place, unnest(l) as line from d),
keyed as (
  select doc_id, place, line, {_FOLDED.format(
    "trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} as key from lines),
holders as (
  select key, min(doc_id) as keeper from keyed where length(key) >= 10
  group by key having count(distinct doc_id) >= 2),
marked as (
  select doc_id, place, line, keeper is not null and doc_id <> keeper as dropped
  from keyed left join holders using (key))
select doc_id, count(*) as n_lines, cast(count(*) filter (where dropped) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not dropped), '')) as kept_sha256
from marked group by doc_id
"""


def statements() -> dict[str, str]:
    return {
        "op10_decontaminate": OP10,
        "op11_fill_in_middle": OP11,
        "op12_lexical_search": OP12,
        "op13_line_dedup": OP13,
    }
