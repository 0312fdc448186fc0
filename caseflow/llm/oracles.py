"""SQL that the queries of the training-data operators must agree with, where SQL can say it.

SimHash (no seeded XXH64), token counts, pseudonyms and the pipeline are tested by brute force.
"""

from __future__ import annotations

from caseflow.llm import chat, licences, quality

LOWER_AZ = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
ALNUM_WORDS = (
    f"regexp_extract_all({LOWER_AZ.format('coalesce(text, %s)' % repr(''))}, "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
SYMBOLS = "translate({}, '#*$%&|<>', '')"

OP1 = f"""
with sized as (
  select doc_id, source, len({WORDS})::bigint as size,
    -ln((cast('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, 'null')), 1, 13) as bigint) + 0.5::double)
        / 4503599627370496.0::double)
    / greatest(case when text is null then 1.0::double
       else length({SYMBOLS.format('text')})::double / greatest(length(text), 1) end, 0.05::double) as key
  from documents
), sources as (
  select source, sum(size)::bigint as source_size from sized group by source
), ranked as (
  select *, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w from sources
), totals as (select sum(source_size)::bigint as total from ranked),
steps as (
  select r.*, row_number() over o as k,
    ((select total from totals) - coalesce(sum(3 * source_size) over (o rows between unbounded preceding and 1 preceding), 0))::bigint
    / (sum(w) over (o rows between current row and unbounded following))::bigint as share
  from ranked r
  window o as (order by 3 * source_size / w, source nulls last)
), level as (
  select coalesce((select share from steps where w * share <= 3 * source_size order by k limit 1), 0) as share
), plan as (
  select source, source_size, least(w * (select share from level), 3 * source_size)::double as target from ranked
), prefixed as (
  select s.*, p.source_size, p.target,
    case when p.source_size > 0 then floor(p.target / p.source_size)::bigint else 0 end as epochs,
    coalesce(sum(size) over (partition by s.source order by key, doc_id, size
                             rows between unbounded preceding and 1 preceding), 0)::bigint as prefix
  from sized s join plan p on s.source is not distinct from p.source
)
select doc_id, size, source_size, target,
  (size * (epochs + case when size > 0 and prefix + size / 2 <= target - epochs * source_size then 1 else 0 end))::bigint as taken
from prefixed
"""

OP2 = f"""
with items as (
  select item_id::varchar as item, {ALNUM_WORDS} as w from benchmark
), windows as (
  select distinct item, least(len(w), 10) as size, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') as gram
  from (select *, unnest(range(1, len(w) - least(len(w), 10) + 2)) as p from items where len(w) > 0)
), docs as (
  select row_number() over () as r, doc_id, {ALNUM_WORDS} as w from documents
), places as (
  select r, w, unnest(range(1, len(w) + 1)) as p from docs
), found as (
  select r, p, size, array_to_string(w[p:p + size - 1], ' ') as gram
  from places, (select distinct size from windows) where p + size - 1 <= len(w)
), hits as (
  select f.r, f.p, f.size, v.item from found f join windows v on f.size = v.size and f.gram = v.gram
), words as (
  select r, count(distinct q)::bigint as n_hit
  from (select r, unnest(range(p, p + size)) as q from (select distinct r, p, size from hits)) group by r
), named as (
  select r, count(distinct item)::bigint as n_items, string_agg(distinct item, ',' order by item) as items from hits group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join words using (r) left join named using (r)
"""

OP4 = f"""
with docs as (select row_number() over () as r, doc_id, {WORDS} as w from documents),
places as (select r, doc_id, w, unnest(range(1, len(w) + 1)) as p from docs),
grams as (select r, doc_id, p, array_to_string(w[p:p + 12], ' ') as gram from places where p + 12 <= len(w)),
least as (select gram, min(doc_id) as first from grams group by gram having min(doc_id) < max(doc_id)),
gone as (
  select distinct r, unnest(range(p, p + 13)) as p from grams join least using (gram) where doc_id > first
),
kept as (
  select r, array_to_string(list(w[p] order by p), ' ') as words, count(*) as n
  from places anti join gone using (r, p) group by r
)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed,
  sha256(coalesce(words, '')) as kept_sha256
from docs left join kept using (r)
"""

OP6 = r"""
with parts as (
  select page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path,
    row_number() over () as r
  from pages
), rules(rule_host, rule_path, action) as (
  values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
    ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits as (
  select r, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
    arg_max(action, length(rule_host || rule_path)) as action
  from parts join rules
    on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  group by r
)
select page_id, host, path, rule, coalesce(action, 'allow') as verdict from parts left join fits using (r)
"""

OP7 = rf"""
with docs as (
  select row_number() over () as r, doc_id, source, coalesce(text, '') as text, {WORDS} as w from documents
), grams as (
  select r, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] as gram
  from (select r, w, unnest(range(1, len(w) - 1)) as p from docs where len(w) > 2)
), twice as (
  select r, p from (select r, p, count(*) over (partition by r, gram) as n from grams) where n > 1
), repeated as (
  select r, count(distinct q)::bigint as n from (select r, unnest([p, p + 1, p + 2]) as q from twice) group by r
), lines as (
  select r, count(*)::bigint as n, (count(*) - count(distinct line))::bigint as again
  from (select r, unnest(string_split(text, chr(10))) as line from docs)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by r
), stats as (
  select d.r, doc_id, source, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    (length(text) - length({SYMBOLS.format('text')}))::bigint as n_symbols,
    coalesce(l.again, 0) as n_dup_lines, coalesce(l.n, 0) as n_lines, coalesce(x.n, 0) as n_repeat_words
  from docs d left join repeated x using (r) left join lines l using (r)
), failed as (
  select *, {', '.join(f'({rule}) as f_{name}' for name, rule in quality.RULES.items())} from stats
), fails as (
  unpivot (select source, count(*) as n, {', '.join(f'count(*) filter (f_{name}) as {name}' for name in quality.RULES)}
    from failed group by source) on {', '.join(quality.RULES)} into name rule value k
), prior as (
  select rule, sum(k) / sum(n) as mean, sum(k * k / n) / sum(n) - (sum(k) / sum(n)) * (sum(k) / sum(n)) as spread,
    count(*) / sum(n) as chance
  from fails group by rule
), strong as (
  select rule, mean, case when chance >= 1 or mean <= 0 or mean >= 1 then 0.0
    else least(greatest((spread / (mean * (1 - mean)) - chance) / (1 - chance), 0.0), 1.0) end as alike
  from prior
), bad as (
  select source, bool_or((k * alike + mean * (1 - alike)) / (n * alike + 1 - alike) > {quality.MOST_RATE}) as rejected
  from fails join strong using (rule) group by source
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f_short or f_repeated as base_failed,
  not (f_short or f_repeated) and not b.rejected as kept
from failed f join bad b on f.source is not distinct from b.source
"""

OP9 = """
with records as (
  select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as hex,
    max(page_id) over (partition by sha1(coalesce(html, ''))) as head from pages
)
select page_id, octet_length(encode(payload))::bigint as payload_bytes,
  array_to_string([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((cast('0x' || substr(hex || '0', i * 5 // 4 + 1, 3) as bigint) >> (7 - i * 5 % 4)) & 31) + 1, 1)
    for i in range(32)], '') as payload_digest,
  case when page_id is not distinct from head then 'response' else 'revisit' end as record_type,
  case when page_id is distinct from head then head end as refers_to
from records
"""

OP10 = rf"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed as (
  select *, row_number() over o - 1 as place, coalesce(sum(tokens) over (o rows between unbounded preceding and 1 preceding), 0) as start,
    {len(chat.BEGIN + chat.MIDDLE + chat.END)}
      + length(regexp_replace(role, '{chat.CONTROL}', '\1~\2\3', 'g'))
      + length(regexp_replace(text, '{chat.CONTROL}', '\1~\2\3', 'g')) as chars
  from (select *, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + {chat.OVERHEAD} as tokens from rows)
  window o as (partition by conv_id order by turn nulls last, role, text)
), led as (
  select conv_id, tokens as led, chars as led_chars from placed where place = 0 and role = 'system'
), roomy as (
  select p.*, led is not null as has_system, coalesce(led_chars, 0) as led_chars, start - coalesce(led, 0) as at_,
    greatest({chat.BUDGET} - coalesce(led, 0), 1) as room
  from placed p left join led l on p.conv_id is not distinct from l.conv_id
), windowed as (
  select *, case when at_ // stretch < (at_ + tokens - 1) // stretch then 1 else 0 end + 2 * (at_ // stretch) as w
  from (select *, greatest(room - room // {chat.KEPT_FOR_HISTORY}, 1) as stretch from roomy)
  where not (has_system and place = 0)
), spans as (
  select conv_id, w, min(place) as first, min(at_) as begins, max(room) - sum(tokens) as spare, any_value(led_chars) as led_chars
  from windowed group by conv_id, w having min(place) > 0 and w > 0
), again as (
  select conv_id, sum(led_chars + history) as chars from (
    select s.conv_id, s.led_chars, coalesce(sum(p.chars), 0) as history
    from spans s left join windowed p
      on s.conv_id is not distinct from p.conv_id and p.place < s.first and p.place >= s.first - {chat.HISTORY}
      and s.begins - p.at_ <= s.spare
    group by s.conv_id, s.w, s.led_chars)
  group by conv_id
), whole as (
  select conv_id, count(*)::bigint as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by place) filter (role = 'assistant'), '')) as loss_sha256,
    sum(chars) as own
  from placed group by conv_id
)
select w.conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
  (own + coalesce(a.chars, 0))::bigint as formatted_chars
from whole w left join again a on w.conv_id is not distinct from a.conv_id
"""

def op11() -> str:
    """Every file's votes and phrases by plain joins; phrases are compared with slices of the text."""
    quoted = lambda words: str(list(words))
    words = [t.text.split() for t in licences.TEMPLATES]
    templates, rules = [], []
    for t, template in enumerate(licences.TEMPLATES):
        need = 1 if template.base else min(licences.RARE, len(set(words[t])))
        templates.append(f"({t}, '{template.label}', {template.base}, {need}, {quoted(words[t])})")
        for phrase in template.phrases:
            p = phrase.split()
            offset = next(i for i in range(len(words[t])) if words[t][i : i + len(p)] == p)
            slack = 0 if template.base else licences.SLACK
            rules.append(f"({t}, {quoted(p)}, {offset}, {slack})")
    return f"""
with templates(t, label, base, need, words) as (values {", ".join(templates)}),
rules(t, phrase, shift, slack) as (values {", ".join(rules)}),
posts as (select t, unnest(words) as word, generate_subscripts(words, 1) - 1 as shift from templates),
docs as (select row_number() over () as r, doc_id, {ALNUM_WORDS} as w from documents),
places as (select r, unnest(w) as word, generate_subscripts(w, 1) - 1 as pos from docs),
hits as (select * from places semi join posts using (word)),
seen as (select word, count(distinct r) as df from hits group by word),
ranked as (
  select r, t, word, row_number() over (partition by r, t order by df, word) as k
  from (select distinct r, word from hits) join (select distinct t, word from posts) using (word) join seen using (word)
),
chosen as (select r, t, word from ranked join templates using (t) where k <= need),
enough as (select r, t from chosen join templates using (t) group by r, t, need having count(*) = need),
totals as (select r, t, count(*) as total from chosen join posts using (t, word) group by r, t),
votes as (
  select r, t, pos - shift as start, count(*) as agree
  from chosen semi join enough using (r, t) join hits using (r, word) join posts using (t, word) group by r, t, start
),
candidates as (select * from votes join totals using (r, t) where agree * 2 >= total),
said as (
  select distinct h.r, h.pos, phrase from hits h join rules on h.word = phrase[1] join docs using (r)
  where w[h.pos + 1:h.pos + len(phrase)] = phrase
),
stands as (
  select r, t, start, any_value(agree) as agree, any_value(total) as total
  from candidates join rules using (t) join said using (r, phrase)
  where said.pos between start + shift - slack and start + shift + slack
  group by r, t, start
  having count(distinct phrase) = (select count(*) from rules x where x.t = candidates.t)
),
verdicts as (
  select r, count(*) filter (where base) as n_base, min(start) filter (where base) as first_word,
    max(start) filter (where base) as last_word,
    string_agg(distinct label, ',' order by label) filter (where base) as base_labels,
    string_agg(distinct label, ',' order by label) as labels, max(agree / total) as score
  from stands join templates using (t) group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word,
  last_word::bigint as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
  coalesce(score, 0)::double as score
from docs left join verdicts using (r)
"""


ORACLES = {
    "op1_mix_sources": OP1,
    "op2_decontaminate": OP2,
    "op4_substring_dedup": OP4,
    "op6_url_filter": OP6,
    "op7_quality_rules": OP7,
    "op9_warc": OP9,
    "op10_chat_windows": OP10,
    "op11_licence_scan": op11(),
}
