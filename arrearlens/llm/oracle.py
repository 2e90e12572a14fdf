"""DuckDB SQL for the operators that SQL can express, by the direct route: all windows, all pairs."""

from __future__ import annotations

import re

from .repetition import COVERAGE, LINE_COVERAGE

_LOWER = "translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({c}, '[^\x20\x09-\x0D]+')"
_PLAIN_WORDS = r"regexp_extract_all({c}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_RUNS = "case when len(w) = 0 then []::varchar[] else list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, greatest(len(w) - 3, 2))]) end"

OP5 = f"""
with recursive d as (select doc_id, {_WORDS.format(c=_LOWER.format(c="coalesce(text, '')"))} as w from documents),
s as (select doc_id, {_RUNS} as sh from d),
t as (select doc_id, len(sh) as n, unnest(sh) as token from s),
c as (select a.doc_id as a, b.doc_id as b, any_value(a.n) as n, any_value(b.n) as m, count(*) as k
    from t a join t b on a.token = b.token and a.doc_id <> b.doc_id group by 1, 2),
e as (select a, b from c where 100 * k >= 85 * (n + m - k)),
r(doc_id, reached) as (select doc_id, doc_id from s union select r.doc_id, e.b from r join e on r.reached = e.a),
g as (select doc_id, min(reached) as component_id from r group by 1)
select doc_id, cast(len(sh) as bigint) as n_shingles, component_id, doc_id = component_id as kept from s join g using (doc_id)"""

OP7 = f"""
with i as (select cast(item_id as varchar) as item, {_PLAIN_WORDS.format(c=_LOWER.format(c="text"))} as w from benchmark where text is not null),
win as (select distinct item, least(len(w), 13) as n, array_to_string(w[k:k + 12], ' ') as words
    from (select item, w, unnest(range(1, greatest(len(w) - 11, 2))) as k from i where len(w) > 0)),
d as (select doc_id, {_PLAIN_WORDS.format(c=_LOWER.format(c="coalesce(text, '')"))} as w from documents),
sizes as (select distinct n from win),
plc as (select doc_id, n, unnest(range(1, len(w) - n + 2)) as k, w from d join sizes on len(w) >= n),
occ as (select doc_id, k, plc.n, item from plc join win on plc.n = win.n and array_to_string(w[k:k + plc.n - 1], ' ') = win.words),
hit as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(k, k + n)) as p from occ) group by 1),
its as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from occ) group by 1)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hit using (doc_id) left join its using (doc_id)"""

OP8 = f"""
with recursive l as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(0, len(string_split(text, chr(10))))) as pos
    from documents where text is not null),
f as (select line, min(struct_pack(doc_id := doc_id, pos := pos)) as first from l where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by 1),
s as (select line, first, {_RUNS} as sh from (select *, {_WORDS.format(c="line")} as w from f)),
t as (select line, first, len(sh) as n, unnest(sh) as token from s),
c as (select a.line as line, b.line as other, any_value(a.n) as n, any_value(b.n) as m, count(*) as k
    from t a join t b on a.token = b.token and b.first < a.first group by 1, 2),
gone as (select distinct line from c where 100 * k >= 80 * (n + m - k)),
k as (select l.*, f.line is null or (g.line is null and f.first.doc_id = l.doc_id and f.first.pos = l.pos) as stays
    from l left join f using (line) left join gone g using (line)),
r as (select doc_id, count(*) as n_lines, count(*) filter (not stays) as n_removed,
    coalesce(string_agg(line, chr(10) order by pos) filter (stays), '') as kept_text from k group by 1)
select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept_text, '')) as kept_sha256
from documents d left join r using (doc_id)"""


def _repeated(n: int) -> str:
    """Word places in runs of n words that occur twice or more."""
    return f"""select doc_id, unnest(range(k, k + {n})) as p from (
        select doc_id, k, count(*) over (partition by doc_id, run) as times from (
            select doc_id, k, array_to_string(w[k:k + {n - 1}], ' ') as run
            from (select doc_id, w, unnest(range(1, len(w) - {n} + 2)) as k from d where len(w) >= {n}))) where times > 1"""


_LENGTHS = sorted({8, *COVERAGE})

OP9 = f"""
with d as (select doc_id, coalesce(text, '') as text, {_WORDS.format(c="coalesce(text, '')")} as w from documents),
{", ".join(f"r{n} as (select doc_id, count(*) as places, sum(len(w[p])) as chars from (select distinct doc_id, p from ({_repeated(n)})) join d using (doc_id) group by 1)" for n in _LENGTHS)},
l as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(0, len(string_split(text, chr(10))))) as pos from d),
again as (select doc_id, count(*) as lines, sum(len(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g'))) as chars from (
    select doc_id, line, row_number() over (partition by doc_id, line order by pos) as nth from l
    where regexp_matches(line, '[^\\x20\\x09-\\x0D]')) where nth > 1 group by 1),
m as (select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(list_sum([len(x) for x in w]), 0) as bigint) as word_chars,
    cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols, coalesce(again.lines, 0) as n_dup_lines,
    coalesce(again.chars, 0) as line_chars, {", ".join(f"coalesce(r{n}.chars, 0) as chars{n}" for n in _LENGTHS)}, coalesce(r8.places, 0) as n_repeat_words
    from d left join again using (doc_id) {" ".join(f"left join r{n} using (doc_id)" for n in _LENGTHS)})
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, share(line_chars) as line_coverage,
    {", ".join(f"share(chars{n}) as coverage_{n}" for n in COVERAGE)},
    n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
    not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and share(line_chars) <= {LINE_COVERAGE}
        and {" and ".join(f"share(chars{n}) <= {limit}" for n, limit in COVERAGE.items())} as kept
from m"""
#: Shares as the operator divides them.
OP9 = re.sub(r"share\((\w+)\)", r"(cast(\1 as double) / greatest(word_chars, 1))", OP9)


OP11 = f"""
with d as (select coalesce(lang, 'und') as lang, unnest(string_split_regex({_LOWER.format(c="coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
p as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from d),
t as (select lang, cast(sum(len(w)) as bigint) as n from p group by 1),
g as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase from (
    select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from p, (select unnest(range(1, 6)) as k) where len(w) >= k)),
f as materialized (select lang, phrase, k, count(*) as a from g group by all having count(*) >= 100),
c as (select lang, phrase, k, a, string_split(phrase, ' ') as w from f where k > 1),
gone as (select distinct s.lang, s.phrase from c b join c s on s.lang = b.lang and s.k < b.k and b.a >= s.a
    and contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ')),
cuts as (select c.lang, c.phrase, c.a, m as k, l.a as l, r.a as r, t.n, cast(1000::hugeint * c.a * t.n // (l.a::hugeint * r.a) as bigint) as score
    from (select *, unnest(range(1, k)) as m from c anti join gone using (lang, phrase)) c
    join f l on l.lang = c.lang and l.phrase = array_to_string(c.w[:m], ' ')
    join f r on r.lang = c.lang and r.phrase = array_to_string(c.w[m + 1:], ' ') join t on t.lang = c.lang),
best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1)
select lang, cast(row_number() over (partition by lang order by score desc, a desc, phrase) as integer) as rank, phrase, a, l, r, n, score
from best qualify rank <= 2000"""

_TERMS = r"regexp_extract_all({c}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP12 = f"""
with d as (select row_number() over () as place, doc_id, {_TERMS.format(c=_LOWER.format(c="coalesce(text, '')"))} as w from documents),
h as (select *, len(w) as n from d where len(w) > 0), t as (select count(*) as docs, cast(sum(n) as bigint) as words from h),
m as (select place, doc_id, 50 + (50 * n * docs) // words as m from h, t),
p as (select place, term, count(*) as tf from (select place, unnest(w) as term from h) group by all),
i as (select row_number() over () as item, item_id, list_distinct({_TERMS.format(c=_LOWER.format(c="coalesce(text, '')"))}) as w from benchmark),
a as (select item, item_id, unnest(w) as term from i),
u as (select term, cast(floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)::double)) as bigint) as weight
    from p join (select distinct term from a) using (term), t group by 1),
s as (select item, item_id, place, doc_id, cast(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) as bigint) as score
    from a join u using (term) join p using (term) join m using (place) group by all)
select item_id, cast(row_number() over (partition by item order by score desc, doc_id, place) as integer) as rank, doc_id, score
from s where score > 0 qualify rank <= 50"""

_ESCAPED = r"regexp_replace({c}, '<(\\*)\|', '<\\\1|', 'g')"
_SAID = "'<|im_end|><|im_start|>assistant ok'"

OP13 = f"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as said, role as r, text as t from conversations
    union all select -1, 0, 'user', {_SAID}, 'user', {_SAID} union all select -1, 1, 'assistant', {_SAID}, 'assistant', {_SAID})
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || said || chr(10), '' order by turn nulls first, r nulls first, t nulls first)) as turns_sha256,
    cast(coalesce(sum(len(said)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
    sha256(coalesce(string_agg(said, '' order by turn nulls first, r nulls first, t nulls first) filter (role = 'assistant'), '')) as loss_sha256,
    cast(sum(len('<|im_start|>') + len(replace({_ESCAPED.format(c="role")}, chr(10), '<|nl|>')) + 1 + len({_ESCAPED.format(c="said")}) + len('<|im_end|>') + 1) as bigint) as formatted_chars
from c group by conv_id"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_minhash_join": OP5,
        "op7_window_join": OP7,
        "op8_line_dedup": OP8,
        "op9_repetition": OP9,
        "op11_collocations": OP11,
        "op12_ranked_search": OP12,
        "op13_chat_format": OP13,
    }
