"""The SQL that queries must agree with, written for DuckDB over the same tables."""

from casebook.llm.rules import ALPHA, CUTOFFS, DELTA, LEAST_WORDS, MOST_REPEATED

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]"

URL_FILTER = f"""
with parts as (
    select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), hosts as (
    select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') as host,
        regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path
    from parts
), rules(rule_host, rule_path, rule_verdict) as (
    values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fitting as (
    select page_id, rule_host || rule_path as rule, rule_verdict,
        row_number() over (partition by page_id order by length(rule_host) desc, length(rule_path) desc) as place
    from hosts join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
)
select h.page_id, h.host, h.path, f.rule, coalesce(f.rule_verdict, 'allow') as verdict
from hosts h left join fitting f on f.page_id = h.page_id and f.place = 1
"""

WARC = """
with payloads as (
    select page_id, coalesce(html, '') as payload, octet_length(encode(coalesce(html, ''))) as size from pages
), newest as (
    select *, case when size >= 1000 then max(page_id) over (partition by payload) else page_id end as last from payloads
)
select page_id, cast(size as bigint) as payload_bytes, sha1(payload) as payload_digest,
    case when page_id < last then 'revisit' else 'response' end as record_type,
    case when page_id < last then last end as refers_to
from newest
"""

NEAR_DUPLICATES = f"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}+') as w from documents
), sets as (
    select doc_id, case
        when len(w) >= 5 then list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)])
        when len(w) > 0 then [array_to_string(w, ' ')] else [] end as shingles
    from words
), shingle as (
    select doc_id, len(shingles) as n, unnest(shingles) as s from sets
), pairs as (
    select a.doc_id as a, b.doc_id as b, a.n as m, b.n, count(*) as common
    from shingle a join shingle b on a.s = b.s and a.doc_id <> b.doc_id group by all
), links as (
    select a, b from pairs where 100 * common >= 75 * (m + n - common)
), reach(id, other) as (
    select doc_id, doc_id from documents
    union select r.id, l.b from reach r join links l on r.other = l.a
), groups as (
    select id, min(other) as component_id from reach group by id
)
select s.doc_id, cast(len(s.shingles) as bigint) as n_shingles, g.component_id, s.doc_id = g.component_id as kept
from sets s join groups g on g.id = s.doc_id
"""

_RATES = {
    "symbol_rate": "case when word_chars > 0 then n_symbols / word_chars else 0 end",
    "dup_line_rate": "case when n_lines > 0 then n_dup_lines / n_lines else 0 end",
    "repeat_rate": "case when n_words > 0 then n_repeat_words / n_words else 0 end",
}
_TESTED = " union all ".join(
    f"select lang, '{name}' as rule, {place} as place, {cutoff} as cutoff, count(*) as good, count(*) filter ({rate} > {cutoff}) as rejected "
    "from holdout group by lang"
    for name, rate in _RATES.items()
    for place, cutoff in enumerate(CUTOFFS[name])
)
_SHARE = ALPHA / len(CUTOFFS)
_CHANCE = (
    f"exp(lgamma(good + 1) - lgamma(j + 1) - lgamma(good - j + 1) + j * ln({_SHARE}) + (good - j) * ln(1 - {_SHARE}))"
)
_BROKEN = ", ".join(f"case when {rate} > {name}_cutoff then '{name}' end" for name, rate in _RATES.items())
_CUTOFF = ", ".join(f"min(cutoff) filter (rule = '{name}') as {name}_cutoff" for name in _RATES)

QUALITY_RULES = f"""
with words as (
    select doc_id, coalesce(lang, '') as lang, coalesce(text, '') as text,
        regexp_extract_all(coalesce(text, ''), '{_WORD}+') as w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as l
    from documents
), windows as (
    select doc_id, unnest(range(1, len(w) - 1)) as i, unnest([array_to_string(w[k:k + 2], ' ') for k in range(1, len(w) - 1)]) as t
    from words
), twice as (
    select doc_id, i from windows qualify count(*) over (partition by doc_id, t) > 1
), repeated as (
    select doc_id, count(distinct i + d) as n from twice cross join (values (0), (1), (2)) as v(d) group by doc_id
), stats as (
    select words.doc_id, lang, cast(len(w) as bigint) as n_words,
        cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
        cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
        cast(len(l) as bigint) as n_lines, cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
        cast(coalesce(n, 0) as bigint) as n_repeat_words
    from words left join repeated on repeated.doc_id = words.doc_id
), judged as (
    select *, n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words as base_failed from stats
), holdout as (
    select judged.* from judged
    join (select doc_id, min(quality) as quality from labels group by doc_id) using (doc_id)
    where quality = 1 and not base_failed
), tested as (
    {_TESTED}
), passed as (
    select *, case when rejected > good * {_SHARE} then false else
        list_sum([{_CHANCE} for j in range(0, rejected + 1)]) <= {DELTA} / ((select count(distinct lang) from holdout) * {len(CUTOFFS)}) end as fine
    from tested
), chosen as (
    select * from passed p
    where not exists (select 1 from passed q where q.lang = p.lang and q.rule = p.rule and q.place <= p.place and not q.fine)
), cutoffs as (
    select lang, {_CUTOFF} from chosen group by lang
), verdicts as (
    select judged.*, concat_ws(',', case when base_failed then 'base' end, {_BROKEN}) as failed_rules
    from judged left join cutoffs on cutoffs.lang = judged.lang
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed_rules, failed_rules = '' as kept
from verdicts
"""

COLLOCATIONS = rf"""
with pieces as (
    select coalesce(lang, 'und') as lang,
        unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents
), words as (
    select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), places as (
    select lang, w, unnest(range(1, len(w) + 1)) as i from words
), grams as (
    select lang, k as size, array_to_string(w[i:i + k - 1], ' ') as phrase
    from places, (select unnest(range(1, 6)) as k) where i + k - 1 <= len(w)
), counts as (
    select lang, size, phrase, count(*) as f from grams group by all
), totals as (
    select lang, sum(f) as n from counts where size = 1 group by lang
), candidates as (
    select lang, phrase, f as a, size, string_split(phrase, ' ') as w from counts where size > 1 and f >= 100
), parts as (
    select lang, array_to_string(w[i:i + k - 1], ' ') as phrase, max(a) as most
    from (select *, unnest(range(1, size + 1)) as i from candidates), (select unnest(range(2, 5)) as k)
    where k < size and i + k - 1 <= size group by all
), cuts as (
    select c.lang, c.phrase, c.a, k, l.f as l, r.f as r, n,
        cast(1000 * cast(c.a as hugeint) * n // (cast(l.f as hugeint) * r.f) as bigint) as score
    from (select *, unnest(range(1, size)) as k from candidates) c
    join counts l on l.lang = c.lang and l.phrase = array_to_string(c.w[1:k], ' ')
    join counts r on r.lang = c.lang and r.phrase = array_to_string(c.w[k + 1:], ' ')
    join totals t on t.lang = c.lang
), lowest as (
    select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), ranked as (
    select o.*, row_number() over (partition by o.lang order by score desc, a desc, o.phrase) as rank
    from lowest o left join parts p on p.lang = o.lang and p.phrase = o.phrase where p.most is null or 100 * p.most < 100 * o.a
)
select lang, rank, phrase, a, l, r, cast(n as bigint) as n, score from ranked where rank <= 2000
"""
