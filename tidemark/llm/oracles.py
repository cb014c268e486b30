"""SQL over the same tables for the queries SQL can express."""

from __future__ import annotations

from tidemark.llm import quality, sanitise

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def _quality() -> str:
    """Windows of every length, counted and covered word by word; only where two words are repeated can more be."""
    lengths = list(quality.LENGTHS)
    covered = "\n".join(
        f"left join (select r, sum(size) as c, count(*) as n from (select distinct p.r, p.i, p.size from pos p join rep on rep.r = p.r and rep.n = {n} and p.i between rep.i and rep.i + {n - 1}) group by r) d{n} on d{n}.r = t.r"
        for n in quality.DUPLICATE_LIMITS
    )
    tops = "\n".join(f"left join (select r, max(held) as c from rep where n = {n} and times >= {quality.TOP_LEAST} group by r) t{n} on t{n}.r = t.r" for n in quality.TOP_LIMITS)
    bad = [f"100 * coalesce(t{n}.c, 0) > {x} * word_chars" for n, x in quality.TOP_LIMITS.items()]
    bad += [f"100 * coalesce(d{n}.c, 0) > {x} * word_chars" for n, x in quality.DUPLICATE_LIMITS.items()]
    bad += [f"100 * n_dup_lines > {quality.LINE_LIMIT} * n_lines", f"100 * dup_line_chars > {quality.LINE_CHARS_LIMIT} * line_chars"]
    columns = ["dup_line_chars"] + [f"cast(coalesce(t{n}.c, 0) as bigint) as top_{n}_chars" for n in quality.TOP_LIMITS] + [f"cast(coalesce(d{n}.c, 0) as bigint) as dup_{n}_chars" for n in quality.DUPLICATE_LIMITS]
    return f"""
with docs as (select row_number() over () as r, doc_id, coalesce(text, '') as text, {_WORDS} as words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as lines from documents),
pos as (select r, i, words[i] as w, length(words[i]) as size from docs, unnest(range(1, len(words) + 1)) as u(i)),
pairs as (select r, i, w || chr(10) || lead(w) over (partition by r order by i) as g from pos),
cand as (select r, i from pairs where g is not null qualify count(*) over (partition by r, g) > 1),
run as (select r, i, len(words) as total, words, unnest({lengths}) as n from cand join docs using (r)),
wins as (select r, i, n, words[i : i + n - 1] as g from run where i + n - 1 <= total),
rep as (select r, i, n, g, count(*) over (partition by r, n, g) as times,
        list_sum(list_transform(g, lambda w: length(w))) * count(*) over (partition by r, n, g) as held from wins qualify times > 1),
t as (select r, doc_id, len(words) as n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) as word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
        len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
        coalesce(list_sum(list_transform(lines, lambda l: length(l))), 0) as line_chars,
        coalesce(list_sum(list_transform(lines, lambda l: length(l))), 0) - coalesce(list_sum(list_transform(list_distinct(lines), lambda l: length(l))), 0) as dup_line_chars from docs),
m as (select t.*, coalesce(d{quality.BASE_LENGTH}.n, 0) as n_repeat_words, ({" or ".join(bad)}) as bad, {", ".join(columns[1:])}
    from t {tops} {covered}),
v as (select *, n_words < {quality.BASE_WORDS} or 100 * n_repeat_words > {quality.BASE_REPEAT} * n_words as base_failed from m)
select doc_id, {", ".join(f"cast({c} as bigint) as {c}" for c in quality.COLUMNS)}, base_failed, not base_failed and not bad as kept,
    {", ".join(f"cast({c} as bigint) as {c}" for c in quality.MEASURES)} from v
"""  # noqa: S608


_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATE = f"""
with docs as (select row_number() over () as r, doc_id, list_filter(regexp_split_to_array({_LOWERED}, '{_NO_WORD}'), lambda w: w <> '') as words from documents),
items as (select item_id, list_filter(regexp_split_to_array({_LOWERED}, '{_NO_WORD}'), lambda w: w <> '') as words from benchmark where item_id is not null),
grams as (select distinct item_id, words[i : i + least(len(words), 10) - 1] as g from items, unnest(range(1, len(words) + 1)) as u(i)
    where i + least(len(words), 10) - 1 <= len(words)),
lengths as (select distinct len(g) as n from grams),
wins as (select r, i, n, words[i : i + n - 1] as g from docs, lengths, unnest(range(1, len(words) + 1)) as u(i) where i + n - 1 <= len(words)),
hits as (select r, i, n, item_id from wins join grams using (g)),
words_hit as (select r, count(distinct p) as n_hit from hits, unnest(range(i, i + n)) as u(p) group by r),
items_hit as (select r, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids from hits group by r)
select doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
    sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join words_hit using (r) left join items_hit using (r)
"""

PREFERENCE = """
with last as (select conv_id, max({'turn': coalesce(turn, -9223372036854775808), 'text': text}) as l from conversations where role = 'assistant' group by conv_id),
pair as (select c.*, a.l is null as whole, b.l is null as lonely, b.l.text as other, coalesce(turn, -9223372036854775808) as t, a.l.turn as end_turn,
        coalesce(role, '') = 'assistant' and coalesce(turn, -9223372036854775808) is not distinct from a.l.turn and c.text is not distinct from a.l.text as final
    from conversations c left join last a on a.conv_id is not distinct from c.conv_id left join last b on b.conv_id = xor(c.conv_id, 1)),
sides as (select conv_id, t as turn, coalesce(role, '') as role, final and lonely as gone, replace(coalesce(text, ''), '<|im_', '<| im_') as chosen,
        replace(coalesce(case when final then other else text end, ''), '<|im_', '<| im_') as rejected from pair where whole or t <= end_turn),
marked as (select *, coalesce(bool_and(chosen = rejected and not gone) over (partition by conv_id order by turn, role), true) as shared from sides),
drawn as (select *, '<|im_start|>' || role || chr(10) as head, '<|im_end|>' || chr(10) as tail from marked),
placed as (select *, sum(case when shared then 0 else length(head || chosen || tail) end) over w - length(chosen || tail) as c_at,
        sum(case when shared or gone then 0 else length(head || rejected || tail) end) over w - length(rejected || tail) as r_at
    from drawn window w as (partition by conv_id order by turn, role))
select conv_id, cast(count(*) filter (shared) as int) as n_prompt_turns,
    coalesce(string_agg(head || chosen || tail, '' order by turn, role) filter (shared), '') as prompt,
    coalesce(string_agg(head || chosen || tail, '' order by turn, role) filter (not shared), '') as chosen,
    coalesce(string_agg(head || rejected || tail, '' order by turn, role) filter (not shared and not gone), '') as rejected,
    coalesce(string_agg(c_at || ':' || (c_at + length(chosen) + 10), ',' order by turn, role) filter (not shared and role = 'assistant'), '') as chosen_spans,
    coalesce(string_agg(r_at || ':' || (r_at + length(rejected) + 10), ',' order by turn, role) filter (not shared and not gone and role = 'assistant'), '') as rejected_spans,
    count(*) filter (not shared and role = 'assistant') > 0 and count(*) filter (not shared and not gone and role = 'assistant') > 0 as usable
from placed group by conv_id
"""

#: The plain patterns: RE2 reads a text once whatever they are.
_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_RUN = r"[\p{L}\p{N}]"


def _sanitise() -> str:
    sizes = "cast(coalesce(list_sum(list_transform({0}, lambda x: length(x))), 0) as bigint)"
    found = " union all ".join(
        f"select r, '{k}' as kind, {i} as rank, regexp_extract_all(text, '{p}') as ms, regexp_split_to_array(text, '{p}') as gaps from docs"
        for i, (k, p) in enumerate(_PATTERNS.items())
    )
    counts = ", ".join(f"count(*) filter (kind = '{k}') as n_{k}" for k in _PATTERNS)
    spell = "string_agg(kind || ':' || s || ':' || e, ',' order by s, rank, e)"
    return f"""
with docs as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
found as ({found}),
placed as (select r, kind, rank, ms[i] as m, regexp_replace(ms[i], '[^0-9]', '', 'g') as digits,
        {sizes.format("gaps[1:i]")} + {sizes.format("ms[1:i-1]")} as s from found, unnest(range(1, len(ms) + 1)) as u(i)),
base as (select r, kind, rank, m, s, s + length(m) as e from placed where case kind
        when 'ip' then list_bool_and(list_transform(string_split(m, '.'), lambda x: coalesce(try_cast(nullif(ltrim(x, '0'), '') as hugeint), 0) <= 255 and length(ltrim(x, '0')) <= 3))
        when 'card' then length(digits) between 12 and 19 and list_sum(list_transform(range(0, length(digits)), lambda i:
            case when i % 2 = 0 then cast(digits[length(digits) - i] as int) else 2 * cast(digits[length(digits) - i] as int) - case when digits[length(digits) - i] > '4' then 9 else 0 end end)) % 10 = 0
        when 'phone' then length(digits) between 9 and 15 else true end),
beside as (select r, lower(kind || ':' || m) as entity, substring(text, greatest(s + 1 - {sanitise.NEAR_CHARS}, 1), least(s, {sanitise.NEAR_CHARS})) as b,
        s > {sanitise.NEAR_CHARS} as far, substring(text, e + 1, {sanitise.NEAR_CHARS}) as a, text from base join docs using (r)),
near as (select distinct entity, text, unnest(regexp_extract_all(lower(case when far then regexp_replace(b, '^{_RUN}+', '') else b end), '{_RUN}{{3,}}')
        || regexp_extract_all(lower(case when length(a) = {sanitise.NEAR_CHARS} then regexp_replace(a, '{_RUN}+$', '') else a end), '{_RUN}{{3,}}')) as term from beside),
close as (select term, max(n) as together from (select term, entity, count(*) as n from near where not regexp_matches(term, '^[0-9]+$') group by all) group by term having max(n) >= {sanitise.MIN_TEXTS}),
holders as (select distinct text, unnest(regexp_extract_all(lower(text), '{_RUN}{{3,}}')) as term from docs),
telling as (select term from (select term, count(*) as n, max(together) as together from holders join close using (term) group by term) where log2(n / together) <= {sanitise.MAX_BITS}),
runs as (select r, regexp_extract_all(text, '{_RUN}+') as ms, regexp_split_to_array(text, '{_RUN}+') as gaps from docs
        where r in (select r from docs join holders using (text) join telling using (term))),
words as (select r, lower(ms[i]) as term, length(ms[i]) as size, {sizes.format("gaps[1:i]")} + {sizes.format("ms[1:i-1]")} as s from runs, unnest(range(1, len(ms) + 1)) as u(i)),
terms as (select r, 'term' as kind, {len(_PATTERNS)} as rank, s, s + size as e from words semi join telling using (term)
        where not exists (select 1 from base b where b.r = words.r and words.s < b.e and b.s < words.s + size)),
counted as (select r, {counts}, {spell} as spans from base group by r),
every as (select r, {spell} as spans, count(*) filter (kind = 'term') as n_terms from (select r, kind, rank, s, e from base union all select * from terms) group by r)
select doc_id, {", ".join(f"coalesce(n_{k}, 0) as n_{k}" for k in _PATTERNS)}, sha256(coalesce(c.spans, '')) as base_sha256,
    coalesce(e.spans, '') as spans, coalesce(n_terms, 0) as n_terms
from docs left join counted c using (r) left join every e using (r)
"""  # noqa: S608

#: Every window is one row; the counts of all its prefixes come from it.
PHRASES = r"""
with docs as (select coalesce(lang, 'und') as lang, """ + _LOWERED + r""" as text from documents),
pieces as (select lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece from docs),
words as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') as ws from pieces),
runs as (select lang, k, ws[i : i + k - 1] as g from words, unnest(range(1, len(ws) + 1)) as u(i), (values (1), (2), (3)) as s(k) where i + k - 1 <= len(ws)),
counts as (select lang, k, array_to_string(g, ' ') as phrase, count(*) as f from runs group by all),
sizes as (select lang, cast(sum(f) as bigint) as n from counts where k = 1 group by lang),
phrases as (select lang, k, phrase, f as a, string_split(phrase, ' ') as ws from counts where k > 1 and f >= 10),
inside as (select distinct s.lang, s.phrase from phrases s join phrases b on b.lang = s.lang and b.k > s.k and 100 * b.a >= 50 * s.a
    and (array_to_string(b.ws[1 : 2], ' ') = s.phrase or array_to_string(b.ws[2 : 3], ' ') = s.phrase)),
cuts as (select p.lang, p.phrase, p.a, c, array_to_string(ws[1 : c], ' ') as head, array_to_string(ws[c + 1 : k], ' ') as rest
    from phrases p anti join inside using (lang, phrase), (values (1), (2)) as t(c) where c < k),
scored as (select cuts.lang, cuts.phrase, a, c, x.f as l, y.f as r, cast((1000000::hugeint * a * a) // (x.f::hugeint * y.f) as bigint) as score
    from cuts join counts x on x.lang = cuts.lang and x.phrase = head join counts y on y.lang = cuts.lang and y.phrase = rest),
least as (select * from scored qualify row_number() over (partition by lang, phrase order by score, c) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank, phrase, a, l, r, n, score
from least join sizes using (lang) qualify rank <= 2000
"""

SQL = {
    "op1_quality": _quality(),
    "op4_decontaminate": DECONTAMINATE,
    "op8_preference": PREFERENCE,
    "op10_pii": _sanitise(),
    "op12_phrases": PHRASES,
}
