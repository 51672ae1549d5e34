"""SQL that says the same as a query of this subpackage, where SQL can."""

WORD, SPACE = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]"

OP4 = rf"""
with d as (select row_number() over () as rid, doc_id, coalesce(text,'') as text, coalesce(lang,'') as lang from documents),
w as materialized (select rid, lang, regexp_extract_all(text, '{WORD}') as words, regexp_extract_all(lower(text), '{WORD}') as lowered from d),
win as (select rid, i, words[i]||chr(1)||words[i+1]||chr(1)||words[i+2] as x from (select rid, words, unnest(range(1, len(words)-1)) as i from w)),
rep as (select rid, count(distinct p) as n_repeat_words from (select rid, unnest([i,i+1,i+2]) as p from (select rid, i, count(*) over (partition by rid, x) as c from win) where c>1) group by rid),
one as (select rid, lang, unnest(lowered) as word from w),
top as (select lang, word, row_number() over (partition by lang order by count(*) desc, word) as k from one group by lang, word qualify k<=24),
hit as (select rid, coalesce(k,0) as k, count(*) as n from one left join top using (lang, word) group by all),
b as materialized (select d.rid, doc_id, lang, len(words) as n_words, length(text)-length(regexp_replace(text,'[a-z]','','g')) as c1, length(text)-length(regexp_replace(text,'[A-Z]','','g')) as c2,
  length(text)-length(regexp_replace(text,'{SPACE}','','g')) as c3, length(text)-length(regexp_replace(text,'[0-9]','','g')) as c4, length(text)-length(regexp_replace(text,'[#*$%&|<>]','','g')) as c5,
  length(text)-length(regexp_replace(text,'[!-~]','','g')) as ascii, length(text) as n_chars,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) as lines from d join w using (rid, lang)),
cls as (select rid, lang, unnest([0,1,2,3,4,5,6]) as k, unnest([c1,c2,c3,c4,c5,ascii-c1-c2-c4-c5,n_chars-ascii-c3]) as n from b),
al as (select 'c' as kind, rid, lang, k, n from cls union all select 'w', rid, lang, k, n from hit join b using (rid)),
ref as (select kind, lang, k, sum(n) as r from al group by all),
tot as (select kind, lang, sum(r) as rs from ref group by all),
doc as (select kind, rid, any_value(lang) as lang, sum(n) as ns from al group by all having sum(n)>0),
jsd as (select kind, rid, sqrt(greatest(sum(case when p>0 then p*log2(2*p/(p+q)) else 0 end + case when q>0 then q*log2(2*q/(p+q)) else 0 end)/2, 0)) as dist
  from (select doc.kind, doc.rid, coalesce(n,0)::double/ns as p, r::double/rs as q from doc join ref using (kind, lang) join tot using (kind, lang) left join al on al.kind=doc.kind and al.rid=doc.rid and al.k=ref.k) group by all),
m as (select b.*, coalesce(n_repeat_words,0) as n_repeat_words, jc.dist as class_distance, jw.dist as word_distance, sum(n_words) over (partition by lang) as ref_words
  from b left join rep using (rid) left join jsd jc on jc.rid=b.rid and jc.kind='c' left join jsd jw on jw.rid=b.rid and jw.kind='w')
select doc_id, cast(n_words as bigint) as n_words, cast(n_chars-c3 as bigint) as word_chars, cast(c5 as bigint) as n_symbols, cast(len(lines)-len(list_distinct(lines)) as bigint) as n_dup_lines,
  cast(n_repeat_words as bigint) as n_repeat_words, (n_words<50 or 100*n_repeat_words>50*n_words) as base_failed,
  not (n_words<50 or 100*n_repeat_words>50*n_words) and (n_words<50 or ref_words<1000 or not (coalesce(class_distance,0)>0.28 or coalesce(word_distance,0)>0.45)) as kept,
  round(class_distance,6) as class_distance, round(word_distance,6) as word_distance from m
"""


#: Words of pieces as lists, phrases by their place, and every cut of a candidate; sums of 64 bits are multiplied as 128.
OP12 = r"""
with texts as (select coalesce(lang, 'und') as lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents where text is not null),
pieces as (select row_number() over () as piece, lang, p from (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\n\x0B\x0C\r]')) as p from texts)),
listed as (select piece, lang, list_filter(regexp_split_to_array(p, '[ \t]+'), lambda x: x <> '') as w from pieces),
words as (select piece, lang, unnest(w) as w0, unnest(range(len(w))) as i from listed),
runs as (select lang, w0, lead(w0, 1) over (partition by piece order by i) as w1, lead(w0, 2) over (partition by piece order by i) as w2 from words),
phrases as (
  select lang, 1 as size, w0 as phrase, count(*)::bigint as f from runs group by all
  union all select lang, 2, w0 || ' ' || w1, count(*)::bigint from runs where w1 is not null group by all
  union all select lang, 3, w0 || ' ' || w1 || ' ' || w2, count(*)::bigint from runs where w2 is not null group by all),
totals as (select lang, sum(f)::bigint as n from phrases where size = 1 group by lang),
candidates as (select lang, size, phrase, f as a, string_split(phrase, ' ') as w from phrases where size > 1 and f >= 10),
cuts as (select c.lang, c.phrase, c.size, c.a, k, array_to_string(w[1:k], ' ') as head, array_to_string(w[k + 1:size], ' ') as tail from candidates c, (values (1), (2)) ks(k) where k < c.size),
valued as (
  select c.*, x.f as l, y.f as r, (1000000::hugeint * c.a * c.a) // (x.f::hugeint * y.f) as score
  from cuts c join phrases x on x.lang = c.lang and x.phrase = c.head and x.size = c.k join phrases y on y.lang = c.lang and y.phrase = c.tail and y.size = c.size - c.k),
weakest as (select * from valued qualify row_number() over (partition by lang, phrase order by score, k) = 1),
longer as (select lang, phrase, max(f) as longer from (
  select lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as phrase, a as f from candidates where size = 3) group by all),
kept as (select q.* from weakest q left join longer m on m.lang = q.lang and m.phrase = q.phrase where m.longer is null or 100 * m.longer < 50 * q.a),
ranked as (select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, score::bigint as score from kept)
select ranked.lang, rank, phrase, a, l, r, n, score from ranked join totals on totals.lang = ranked.lang where rank <= 2000
"""
