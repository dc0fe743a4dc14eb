"""The queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from wordloom.llm.quality_rules import SCORES, Risk
from wordloom.llm.secrets import KINDS, LEAST_DISTINCT, PLACEHOLDER

_CANONICAL = r"""
    lower(regexp_replace(regexp_extract(bare, '^[^/?]*'), ':(80|443)$', '')) ||
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        regexp_replace(bare, '^[^/?]*', ''),
        '([?&])utm_[^&]*', '\1', 'g'), '&+', '&', 'g'), '&$', ''), '\?&', '?', 'g'), '\?$', ''), '/+(\?|$)', '\1', 'g')
"""

OP5 = rf"""
with p as (
  select page_id, url, '"' || md5(coalesce(html, '')) || '"' as tag, length(coalesce(html, '')) as size from pages
), records as (
  select page_id * 3 as record_id, url, page_id * 1000 as date, true as is_full, page_id, tag, size, null as sent from p
  union all
  select page_id * 3 + 1, url || '#again', page_id * 1000 + 500 + page_id % 7 * 100000, false, page_id, null, null,
         case when page_id % 5 = 0 then '"stale"' else tag end from p
  union all
  select page_id * 3 + 2, url, page_id * 1000 - 500, false, page_id, null, null, null from p
), bared as (
  select *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^https?://(www\.)?', '', 'i') as bare from records
), named as (
  select * exclude (url), {_CANONICAL} as url from bared
), looked as (
  select *, last_value(case when is_full then struct_pack(id := record_id, page := page_id, tag := tag, size := size) end
      ignore nulls) over (partition by url order by date, is_full, record_id
      rows between unbounded preceding and 1 preceding) as r
  from named
), judged as (
  select *, case when r is null or url is null or date is null then 'missing'
                 when record_id % 3 = 1 and sent = r.tag then 'resolved'
                 when record_id % 3 = 2 and page_id = r.page then 'resolved'
                 else 'changed' end as state
  from looked where not is_full
)
select record_id, url, date, case when state = 'resolved' then r.id else -1 end as response_id, state,
  case when state = 'resolved' and record_id % 3 = 1 then
    'cache-control=max-age=' || (page_id % 100) || ';content-length=' || r.size || ';content-type=text/html;etag=W/' ||
    sent || ';last-modified=' || r.page || ';x-cache=hit'
  when state = 'resolved' then
    'cache-control=max-age=60;content-length=' || r.size || ';content-type=text/html;etag=' || r.tag ||
    ';last-modified=' || page_id else '' end as headers
from judged
"""


def _matches(number: int) -> str:
    _, pattern, group, least = KINDS[number]
    rx = pattern.replace("'", "''")
    return f"""
  select row_id, owner, repo, {number} as kind, i, w[i] as found, v[i] as value,
    list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(w[1:i-1], lambda x: length(x))), 0) as start
  from (
    select *, unnest(range(1, len(w) + 1)) as i from (
      select row_id, owner, repo, string_split_regex(text, '{rx}') as s, regexp_extract_all(text, '{rx}', 0) as w,
             regexp_extract_all(text, '{rx}', {group}) as v
      from d where regexp_matches(text, '{rx}')
    )
  ) where length(v[i]) >= {least}"""


_NAMES = "[" + ", ".join(f"'{k[0]}'" for k in KINDS) + "]"
OP8 = f"""
with d as (
  select row_number() over () as row_id, doc_id, coalesce(text, '') as text, coalesce(source, '') as owner,
         concat_ws('/', source, lang) as repo from documents
), m as ({" union all ".join(_matches(n) for n in range(len(KINDS)))}
), judged as (
  select *, not copied and not regexp_matches(value, '{PLACEHOLDER}')
    and len(list_distinct(string_split(value, ''))) >= {LEAST_DISTINCT} as live from (
    select m.*, n_owners >= 3 or (n_owners >= 2 and n_repos >= 6) as copied from m
    join (select sha256(value) as h, count(distinct owner) as n_owners, count(distinct (owner, repo)) as n_repos
      from m group by 1) o on sha256(m.value) = o.h)
), spans as (
  select row_id, kind, copied, live, start, {_NAMES}[kind + 1] || ':' || start || ':' || (start + length(found)) as written
  from judged where kind < 3 or live
), rows_of as (
  select row_id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access,
    count(*) filter (kind = 2) as n_hex, string_agg(written, ',' order by start, kind) filter (kind < 3) as base,
    string_agg(written, ',' order by start, kind) as spans, count(*) filter (live) as n_live,
    count(*) filter (copied) as n_copied
  from spans group by 1
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live,
  coalesce(n_copied, 0) as n_copied
from d left join rows_of using (row_id)
"""

OP10 = r"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), t as (
  select *, row_number() over w - 1 as place, lag(role) over w as before,
    length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + 28
      + length(replace(regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g'), chr(10), '<|nl|>')) - 4 as chars
  from said window w as (partition by conv_id order by turn nulls first, role, text)
), checked as (
  select *, case
    when role = 'system' then before is null
    when role = 'user' then before is null or before in ('system', 'assistant')
    when role = 'assistant' then before = 'user' else false end as good
  from t
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by place) filter (role = 'assistant'), '')) as loss_sha256,
  sum(chars)::bigint as formatted_chars,
  bool_and(coalesce(good, false)) as valid,
  coalesce(min(place) filter (not coalesce(good, false)), -1) as first_bad
from checked group by conv_id
"""

_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"

OP3 = f"""
with recursive texts as (
  select coalesce(text, '') as t, min(doc_id) as doc, count(*) as copies, row_number() over () as node
  from documents group by 1
), words as (select node, {_WORDS} as w from texts
), shingles as (
  select distinct node, array_to_string(w[i:i + 4], ' ') as s
  from (select node, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from words where len(w) > 0)
), sizes as (select node, count(*) as n from shingles group by 1
), common as (
  select a.node as a, b.node as b, count(*) as c from shingles a join shingles b on a.s = b.s and a.node < b.node group by all
), links as (
  select a, b from common join sizes x on x.node = a join sizes y on y.node = b where 5 * c >= 4 * (x.n + y.n - c)
), both_ways as (select a, b from links union all select b, a from links
), reached as (
  select node, node as root from texts
  union select l.b, r.root from reached r join both_ways l on l.a = r.node
), classes as (select node, min(root) as root from reached group by 1
), least as (select root, min(doc) as class_id from classes join texts using (node) group by 1
)
select d.doc_id, least.class_id, (select count(*) from both_ways l where l.a = t.node) as n_links, t.copies as n_copies
from documents d join texts t on t.t = coalesce(d.text, '') join classes using (node) join least using (root)
"""

_RISK = Risk()
_CUTS = "[" + ", ".join(str(c) for c in _RISK.grid) + "]"
_MAXIMA = ", ".join(f"max(cutoff) filter (score = '{s}') as max_{s}" for s in SCORES)
OP4 = f"""
with d as (select row_number() over () as r, doc_id, lang, coalesce(text, '') as t from documents
), words as (select r, {_WORDS} as w from d
), cells as (select r, unnest(range(1, len(w) + 1)) as i, unnest(w) as word from words
), windows as (
  select r, i, count(*) over (partition by r, g) as times
  from (select r, unnest(range(1, len(w) - 6)) as i, list_slice(w, unnest(range(1, len(w) - 6)), unnest(range(8, len(w) + 1))) as g
        from words where len(w) >= 8)
), covered as (select r, count(distinct i + k) as n from windows, range(8) o(k) where times > 1 group by 1
), lines as (
  select r, count(*) - count(distinct line) as n from (select r, unnest(string_split(t, chr(10))) as line from d)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by 1
), counted as (
  select d.r, doc_id, lang, md5(t) as text_digest, len(w) as n_words, coalesce((select sum(length(word)) from cells c where c.r = d.r), 0)::bigint as word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols, coalesce(l.n, 0) as n_dup_lines,
    coalesce(v.n, 0) as n_repeat_words, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as capitals,
    length(t) - length(regexp_replace(t, '[a-z]', '', 'g')) as small
  from d join words using (r) left join lines l using (r) left join covered v using (r)
), scored as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
    least(n_symbols / greatest(n_words, 1)::double, 1) as symbol_share,
    n_repeat_words / greatest(n_words, 1)::double as repeat_share,
    least(n_dup_lines * 10 / greatest(n_words, 1)::double, 1) as dup_line_share,
    capitals / greatest(capitals + small, 1)::double as capital_share,
    least(abs(word_chars / greatest(n_words, 1)::double - 6) / 12::double, 1) as odd_length
  from counted
), holdout as (select distinct lang, text_digest, {", ".join(SCORES)} from scored
  where not base_failed and doc_id in (select doc_id from labels where quality = 1)
), strata as (select lang, count(*) as n from holdout group by 1
), chances as (
  select lang, k, sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln({_RISK.alpha / len(SCORES)}::double)
    + (n - k) * ln(1 - {_RISK.alpha / len(SCORES)}::double))) over (partition by lang order by k) as tail
  from strata, lateral (select unnest(range(0, n)) as k)
), limits as (
  select lang, max(k) as most from chances
  where tail <= {_RISK.delta}::double / ((select count(*) from strata) * {len(SCORES)}) group by 1
), long as (unpivot (select lang, {", ".join(SCORES)} from holdout) on {", ".join(SCORES)} into name score value x
), rejected as (
  select lang, score, c, count(*) filter (x > c) as k from long, (select unnest({_CUTS}::double[]) as c) group by all
), cutoffs as (
  select r.lang, score, min(c) as cutoff from rejected r join limits l on l.lang is not distinct from r.lang where k <= most group by all
), wide as (select lang, {_MAXIMA} from cutoffs group by 1)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not ({" or ".join(f"coalesce({s} > max_{s}, false)" for s in SCORES)}) as kept, s.lang, {", ".join(SCORES)}
from scored s left join wide w on w.lang is not distinct from s.lang
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SMALL = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"

OP11 = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang, regexp_extract_all(piece, '[^\x20\x09]+') as w
  from (select lang, unnest(string_split_regex({_SMALL}, '[.,;:!?\x0A-\x0D]')) as piece from documents)
), totals as (select lang, sum(len(w))::bigint as n from pieces group by 1
), found as (
  select lang, size, array_to_string(w[i:i + size - 1], ' ') as phrase, count(*) as f
  from (select lang, w, size, unnest(range(1, len(w) - size + 2)) as i from pieces, range(1, 6) s(size) where len(w) >= size)
  group by all having count(*) >= 100
), many as (select *, string_split(phrase, ' ') as w from found where size > 1
), cuts as (
  select m.lang, m.phrase, m.size, m.f as a, k, l.f as l, r.f as r, n, (1000 * m.f::hugeint * n) // (l.f::hugeint * r.f) as score
  from (select *, unnest(range(1, size)) as k from many) m join totals using (lang)
  join found l on l.lang = m.lang and l.phrase = array_to_string(w[1:k], ' ')
  join found r on r.lang = m.lang and r.phrase = array_to_string(w[k + 1:], ' ')
), best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), kept as (
  select * from best b where not exists (
    select 1 from many q where q.lang = b.lang and q.size > b.size and q.f >= b.a
      and contains(' ' || q.phrase || ' ', ' ' || b.phrase || ' '))
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score::bigint as score
from kept qualify rank <= 2000
"""

_CRC = "select range as i, range as c from range(256)"
for _ in range(8):
    _CRC = f"select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end as c from ({_CRC})"


def _features(name: str, table: str) -> str:
    return rf"""{name} as (
  select r, doc_id, regexp_extract_all({_SMALL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from (
    select row_number() over () as r, * from {table})), {name}_words as (
  select r, word, count(*) as times from (select r, unnest(w) as word from {name}) group by all)"""


OP12 = f"""
with {_features("d", "documents")}, {_features("b", "(select item_id as doc_id, text from benchmark)")},
crc as (select list(c order by i) as t from ({_CRC})
), bytes as (
  select word, list_transform(range(1, len(h), 2), lambda i: ('0x' || substr(h, i, 2))::bigint) as x
  from (select word, hex(word) as h from (select word from d_words union select word from b_words))
), hashed as (
  select word, xor(list_reduce(list_prepend(4294967295::bigint, x),
    lambda acc, byte: xor(acc >> 8, t[(xor(acc, byte) & 255) + 1])), 4294967295) % 10000 as bucket from bytes, crc
), sums as (select range as bucket, coalesce(s, 0) as s, coalesce(t, 0) as t from range(10000)
  left join (select bucket, sum(times) as s from d_words join hashed using (word) group by 1) on bucket = range
  left join (select bucket as b, sum(times) as t from b_words join hashed using (word) group by 1) on b = range
), gains as (
  select bucket, floor(1000 * ln((t + 1)::double * (sum(s) over () + 10000)::double
    / ((s + 1)::double * (sum(t) over () + 10000)::double)))::bigint as gain from sums
), weights as (
  select r, sum(times * gain)::bigint as weight from d_words join hashed using (word) join gains using (bucket) group by 1
), scored as (
  select doc_id, len(w) as n_features, coalesce(weight, 0) as weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
    (('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296.0::double)))::bigint as score
  from d left join weights using (r)
)
select *, case when n_features >= 20 and place <= drawn then place end as rank from (
  select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id nulls first, weight, n_features) as place,
    10 * (count(*) filter (n_features >= 20) over ()) // 100 as drawn from scored)
"""
OP12 = f"select doc_id, n_features, weight, score, rank from ({OP12})"

OP13 = r"""
with rules(verdict, host, path) as (
  values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), rests as (
  select row_number() over () as r, page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages
), urls as (
  select r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '""" + _UPPER + "', '" + _UPPER.lower() + r"""') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from rests
), won as (
  select r, max_by(u.host || u.path, length(u.host || u.path)) as rule, max_by(verdict, length(u.host || u.path)) as verdict
  from urls join rules u on (urls.host = u.host or ends_with(urls.host, '.' || u.host)) and starts_with(urls.path, u.path) group by r
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from urls left join won using (r)
"""

ORACLES = {
    "op3_ngram_jaccard_join": OP3,
    "op4_quality_rules": OP4,
    "op5_warc_revisits": OP5,
    "op8_secret_scans": OP8,
    "op10_chat_formatting": OP10,
    "op11_collocations": OP11,
    "op12_importance_resampling": OP12,
    "op13_url_filters": OP13,
}
