"""SQL of the queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from pagetally.llm.mixing import GRID, PLACE_BITS
from pagetally.llm.quality_rules import QUANTILES, RULES, SCALE, Limits
from pagetally.llm.queries import MIX

#: The words of a text, in the expression language of the engine that checks.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quality_rules() -> str:
    limits = Limits()
    values = ", ".join(
        f"case when {r.of} > 0 then {r.part} * {SCALE} // {r.of} else 0 end as {r.name}" for r in RULES
    )
    long = " union all ".join(
        f"select lang, source, '{r.name}' as rule, {r.name} as v, {r.outer} as outer_q, "
        f"{r.spreads} as spreads, {r.least} as least, {r.low} as low from measures where not base_failed"
        for r in RULES
    )

    at = ", ".join(f"min(bucket) filter (100 * upto >= {q} * total) as q{q}" for q in QUANTILES)
    chosen = ", ".join(f"coalesce(s.q{q}, l.q{q}, a.q{q}) as q{q}" for q in QUANTILES)
    upper = "case outer_q " + " ".join(f"when {q} then q{q}" for q in QUANTILES) + " end"
    lower = "case 100 - outer_q " + " ".join(f"when {q} then q{q}" for q in QUANTILES) + " end"

    def level(name: str, groups: str) -> str:
        return f"""{name}_at as (
            select {groups} rule, bucket, sum(n) over (partition by {groups} rule order by bucket) as upto,
                   sum(n) over (partition by {groups} rule) as total
            from (select {groups} rule, bucket, sum(n) as n from own group by all)),
        {name} as (
            select {groups} rule, max(total) as total,
                   {at}
            from {name}_at group by all)"""

    failing = " or ".join(
        f"(t.rule = '{r.name}' and (m.{r.name} > t.high or (t.low and m.{r.name} < t.bottom)))" for r in RULES
    )
    return rf"""
    with tokens as (select doc_id, lang, source, text, {WORDS} as w from documents),
    grams as (
        select doc_id, i, array_to_string(w[i:i + 4], ' ') as g
        from tokens, unnest(range(1, len(w) - 3)) as r(i)),
    twice as (select doc_id, g from grams group by all having count(*) > 1),
    covered as (
        select doc_id, count(distinct i + k) as n
        from grams join twice using (doc_id, g), unnest(range(0, 5)) as r(k) group by doc_id),
    counted as (
        select doc_id, lang, source, len(w) as n_words,
               length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
               length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g')) as n_symbols,
               list_filter(string_split(coalesce(text, ''), chr(10)),
                           lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines,
               coalesce(n, 0) as n_repeat_words
        from tokens left join covered using (doc_id)),
    measures as (
        select *, len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
               n_words < {limits.min_words}
                 or 100 * n_repeat_words > {limits.max_repeat_percent} * n_words as base_failed,
               {values}
        from counted),
    long as ({long}),
    own as (
        select lang, source, rule, count(*) as n,
               (v >> greatest(length(bin(v)) - 7, 0)) << greatest(length(bin(v)) - 7, 0) as bucket
        from long group by lang, source, rule, bucket),
    {level("by_source", "lang, source,")},
    {level("by_lang", "lang,")},
    {level("by_all", "")},
    chosen as (
        select g.*, {chosen}
        from (select distinct lang, source, rule, outer_q, spreads, least, low from long) as g
        left join by_source as s on s.lang is not distinct from g.lang
            and s.source is not distinct from g.source and s.rule = g.rule and s.total >= {limits.least_rows}
        left join by_lang as l on l.lang is not distinct from g.lang and l.rule = g.rule
            and l.total >= {limits.least_rows}
        left join by_all as a on a.rule = g.rule),
    fences as (
        select *, upper_q + spreads * greatest(upper_q - lower_q, least) as high,
               lower_q - spreads * greatest(upper_q - lower_q, least) as bottom
        from (select *, {upper} as upper_q, {lower} as lower_q from chosen)),
    outside as (
        select distinct m.doc_id
        from measures as m join fences as t
          on m.lang is not distinct from t.lang and m.source is not distinct from t.source
        where {failing})
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines::bigint as n_dup_lines,
           n_repeat_words::bigint as n_repeat_words, base_failed,
           not base_failed and doc_id not in (select doc_id from outside) as kept
    from measures"""


SUBSTRING_DEDUP = rf"""
    with tokens as (select doc_id, {WORDS} as w from documents),
    grams as (
        select doc_id, i, array_to_string(w[i:i + 12], ' ') as g
        from tokens, unnest(range(1, len(w) - 11)) as r(i)),
    firsts as (select g, min(doc_id) as first from grams group by g),
    gone as (
        select distinct doc_id, i + k as i
        from grams join firsts using (g), unnest(range(0, 13)) as r(k) where doc_id > first),
    lost as (select doc_id, count(*) as n, list(i) as spots from gone group by doc_id)
    select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed,
           sha256(array_to_string(
               [w[i] for i in range(1, len(w) + 1) if spots is null or not list_contains(spots, i)], ' '
           )) as kept_sha256
    from tokens left join lost using (doc_id)"""


# The exponent is looked for among all of the grid here, where the operator bisects.
MIXING = rf"""
    with sized as (select doc_id, source, len({WORDS})::bigint as n_tokens from documents),
    sources as (select source, sum(n_tokens)::bigint as tokens from sized group by source having tokens > 0),
    tried as (
        select k, source, tokens, pow(tokens / most, k / {GRID}) as mass,
               pow(tokens / most, k / {GRID}) / tokens * most as repeats
        from sources, (select max(tokens)::double as most from sources), range(0, {GRID + 1}) as r(k)),
    exponent as (
        select coalesce(min(k), {GRID}) as k
        from (select k from tried group by k having max(repeats) / min(repeats) <= {MIX.max_repeats})),
    budgets as (
        select source, tokens,
               round(tokens * (repeats * (1 / min(repeats) over ())))::bigint as budget
        from tried join exponent using (k)),
    plan as (select *, budget // tokens as blocks, budget % tokens as rest from budgets),
    last as (
        select source, rest, n_tokens,
               ('0x' || substr(md5('0:' || blocks || ':' || doc_id), 1, 8))::bigint >> 2 as place
        from sized join plan using (source) where rest > 0),
    upto as (
        select source, place, rest, sum(sum(n_tokens)) over (partition by source order by place) as upto
        from last group by source, place, rest),
    cuts as (select source, min(place) as cut from upto where upto > rest group by source),
    taken as (
        select s.*, p.tokens, p.budget,
               coalesce(blocks + (('0x' || substr(md5('0:' || blocks || ':' || doc_id), 1, 8))::bigint >> 2
                                  < coalesce(cut, 0))::bigint, 1) as copies
        from sized as s left join plan as p using (source) left join cuts using (source)),
    placed as (
        select *, ('0x' || substr(md5('0:' || block || ':' || doc_id), 1, 8))::bigint >> 2 as place
        from taken, unnest(range(0, copies)) as r(block))
    select doc_id, source, n_tokens, block, place,
           least(coalesce((block + place / {1 << PLACE_BITS}) * tokens / budget, 0), 1) as at
    from placed"""


# Every call has one result at most here. A call comes after the one two turns before it, every
# third also after the one six turns before; the longest way counts.
TOOL_CALLS = """
    with recursive asked as (
        select conv_id, turn, text, 'call-' || conv_id || '-' || turn as call_id,
               turn // 2 % 3 as kind, length(text) as size
        from conversations where role = 'user'),
    answered as (
        select conv_id, turn, text, 'call-' || conv_id || '-' || (turn - 1) as call_id
        from conversations where role = 'assistant'),
    comes as (
        select a.conv_id, a.turn, b.turn as before
        from asked as a join asked as b
          on b.conv_id = a.conv_id and (b.turn = a.turn - 2 or (a.kind = 2 and b.turn = a.turn - 6))),
    ways as (
        select conv_id, turn, 0::bigint as level from asked as a
        where not exists (select 1 from comes as c where c.conv_id = a.conv_id and c.turn = a.turn)
        union
        select c.conv_id, c.turn, level + 1
        from ways as w join comes as c on c.conv_id = w.conv_id and c.before = w.turn),
    depth as (select conv_id, turn, max(level) as level from ways group by all),
    called as (
        select a.*, level,
               case kind when 0 then 'search' when 1 then 'translate' else 'count_words' end as name,
               case when kind = 0 then '{"limit":' || case when size % 7 = 0
                        then '"' || (size % 20 + 1) || '"' else (size % 20 + 1)::varchar end
                        || ',"query":' || to_json(text) || '}'
                    when kind = 1 then '{"target":"' || ['en', 'de', 'fr', 'es', 'xx'][size % 5 + 1]
                        || '","text":' || to_json(text) || '}'
                    when size % 11 = 0 then '{"lang":"en","options":{"least":' || size % 3 || ',"unique":true}}'
                    else '{"options":{"least":' || size % 3 || ',"unique":true},"text":' || to_json(text) || '}'
               end as arguments,
               case when kind = 0 and size % 7 = 0 then 'type:limit'
                    when kind = 1 and size % 5 = 4 then 'choice:target'
                    when kind = 2 and size % 11 = 0 then 'missing:text,unexpected:lang'
                    else '' end as problems
        from asked as a join depth using (conv_id, turn)),
    linked as (
        select coalesce(c.conv_id, r.conv_id) as conv_id, coalesce(c.call_id, r.call_id) as call_id,
               coalesce(c.turn, r.turn) as turn, level, name, arguments, coalesce(problems, '') as problems,
               r.text as result, (c.call_id is not null)::bigint as n_calls,
               (r.call_id is not null)::bigint as n_results,
               case when c.call_id is null then 'no_call' when r.call_id is null then 'no_result'
                    else 'linked' end as status
        from called as c full join answered as r on c.conv_id = r.conv_id and c.call_id = r.call_id)
    select conv_id, call_id, turn, level, status, problems, n_calls, n_results,
           '{' || coalesce('"arguments":' || arguments || ',', '') || '"call_id":"' || call_id
           || '","conv_id":' || conv_id || coalesce(',"name":"' || name || '"', '')
           || case when problems = '' then '' else
                ',"problems":["' || replace(problems, ',', '","') || '"]' end
           || coalesce(',"result":' || to_json(result), '') || ',"status":"' || status || '"}' as message
    from linked"""


# Every n-gram is written out and counted by itself here.
COLLOCATIONS = r"""
    with pieces as (
        select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) as piece
        from documents),
    words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
    starts as (
        select lang, w, size, unnest(range(1, len(w) - size + 2)) as i
        from words, (values (1), (2), (3)) as sizes(size)),
    counts as (
        select lang, size, array_to_string(w[i : i + size - 1], ' ') as phrase, count(*) as n
        from starts group by all),
    candidates as (select lang, size, phrase, n, string_split(phrase, ' ') as w from counts where size > 1 and n >= 10),
    cuts as (
        select lang, phrase, n as a, k, array_to_string(w[1:k], ' ') as part, array_to_string(w[k + 1 :], ' ') as rest
        from candidates, (values (1), (2)) as cut(k) where k < size),
    scored as (
        select u.lang, u.phrase, a, x.n as l, y.n as r, k,
               cast(1000000 * a::hugeint * a::hugeint // (x.n::hugeint * y.n::hugeint) as bigint) as score
        from cuts as u join counts as x on x.lang = u.lang and x.phrase = u.part
                       join counts as y on y.lang = u.lang and y.phrase = u.rest),
    best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
    inside as (
        select lang, phrase, max(n) as n from (
            select lang, array_to_string(w[1:2], ' ') as phrase, n from candidates where size = 3
            union all
            select lang, array_to_string(w[2:3], ' '), n from candidates where size = 3)
        group by all),
    total as (select lang, sum(n)::bigint as n from counts where size = 1 group by lang)
    select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
           phrase, a, l, r, t.n, score
    from best left join inside as i using (lang, phrase) join total as t using (lang)
    where i.n is null or 100 * i.n < 50 * a
    qualify rank <= 2000"""


EXACT_DEDUP = r"""
    with texts as (
        select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
        from documents),
    groups as (select text_sha256, min(doc_id) as keep_id, count(*) as group_size from texts group by all)
    select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256
    from texts join groups using (text_sha256)"""


ORACLE: dict[str, str] = {
    "op1_quality_rules": _quality_rules(),
    "op5_mixing": MIXING,
    "op6_tool_calls": TOOL_CALLS,
    "op10_substring_dedup": SUBSTRING_DEDUP,
    "op11_collocations": COLLOCATIONS,
    "op12_exact_dedup": EXACT_DEDUP,
}
