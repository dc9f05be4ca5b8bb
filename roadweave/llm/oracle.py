"""SQL statements for the queries that SQL can express, written for DuckDB over the same tables."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op2_exact_dedup"] = r"""
with t as (
    select doc_id, sha256(regexp_replace(coalesce("text", ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents
)
select
    doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size, doc_id = min(doc_id) over g as kept, text_sha256
from t window g as (partition by text_sha256)
"""

SQL["op4_curriculum_mix"] = r"""
with recursive d as (
    select doc_id, "source", len(regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+'))::bigint as size, md5(doc_id::varchar) as k
    from documents
),
s as (
    select "source", sum(size)::bigint as source_size,
        (list_value(5.0::double, 2.0::double, 1.0::double))[((row_number() over (order by "source" nulls last) - 1) % 3 + 1)::int] as weight
    from d group by "source"
),
-- level: what a unit of weight gets; whoever is above its cap stops there and the rest share again
r as (
    select 0 as step, (select sum(source_size) from s)::double / (select sum(weight) from s) as level
    union all
    select step + 1,
        ((select sum(source_size) from s) - (select coalesce(sum(3 * source_size), 0) from s where 3 * source_size <= level * weight))
        / (select sum(weight) from s where 3 * source_size > level * weight)
    from r
    where step < 100 and exists (select 1 from s where 3 * source_size > level * weight)
),
l as (select level from r order by step desc limit 1),
t as (
    select "source" as src, source_size, weight,
        case when 3 * source_size <= level * weight then (3 * source_size)::double else level * weight end as target
    from s, l
),
c as (
    select d.*, t.*, coalesce(sum(size) over (partition by src order by k, doc_id, size rows between unbounded preceding and 1 preceding), 0)::bigint as before
    from d join t on d."source" is not distinct from t.src
),
p as (
    select *, case when source_size > 0 then floor(round(target)::bigint / source_size)::bigint else 0 end as passes,
        case when target > 0 then least(1.0::double, before / target) else 0.0::double end as share
    from c
),
q as (
    select *, greatest(0, least(size, round(target)::bigint - passes * source_size - before)) as cut from p
),
x as (
    select *, case when size = 0 then 1 else (passes + (cut > 0)::int)::int end as copies,
        -- demand of each weight class up to a time: 5t, t + t^2 and 2t - t^2; its inverse gives the time
        case when weight = 5 then 2 * (share * 5) / (5 + sqrt(25::double))
             when weight = 2 then case when share * 2 <= 0.75 then 2 * (share * 2) / (1 + sqrt(1 + 4 * (share * 2)))
                                       else 0.5 + 2 * (share * 2 - 0.75) / (2 + sqrt(4 + 4 * (share * 2 - 0.75))) end
             else case when share <= 0.75 then 2 * share / (2 + sqrt(greatest(0, 4 - 4 * share)))
                       else 0.5 + 2 * (share - 0.75) / (1 + sqrt(greatest(0, 1 - 4 * (share - 0.75)))) end end as moment
    from q
)
select doc_id, size, source_size, target, (passes * size + cut)::bigint as taken, "source", copies::int as copies,
    case when copies > 0 then moment end as "position"
from x
"""

SQL["op5_line_frequency"] = r"""
with d as (
    select row_number() over () as r, doc_id, "source" as host, coalesce("text", '') as t,
        regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+') as w
    from documents
),
win as (
    select r, i, count(*) over (partition by r, w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]) as n
    from (select r, w, unnest(range(1, len(w) - 3)) as i from d where len(w) >= 6)
),
rep as (
    select r, sum(least(5, coalesce(following - i, 5)))::bigint as n_repeat_words
    from (select r, i, lead(i) over (partition by r order by i) as following from win where n > 1) group by r
),
line as (
    select r, host, t, lower(trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'))) as line, x
    from (select r, host, t, unnest(string_split(t, chr(10))) as x from d) where regexp_matches(x, '[^\x20\x09-\x0D]')
),
dup as (select r, count(*) - count(distinct x) as n_dup_lines from line group by r),
h as (select distinct host, t, substr(md5(line), 1, 16) as h from line),
freq as (select host, h, count(*) as n from h group by host, h),
sizes as (select "source" as host, count(distinct coalesce("text", '')) as docs from documents group by "source"),
common as (
    select freq.host, freq.h from freq join sizes on freq.host is not distinct from sizes.host where n > 5 and n * 100 > docs * 5
),
gone as (
    select line.r, sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')))::bigint as n
    from line join common c on line.host is not distinct from c.host and substr(md5(line.line), 1, 16) = c.h group by line.r
),
m as (
    select d.doc_id, len(w)::bigint as n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
        coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
        coalesce(gone.n, 0)::bigint as n_boilerplate_words
    from d left join rep using (r) left join dup using (r) left join gone using (r)
)
select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
    not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) 
        and n_words - n_boilerplate_words >= 10 and 100 * (n_words - n_boilerplate_words) >= 50 * n_words as kept
from m
"""

SQL["op12_bit_sliced_top_k"] = r"""
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as q from embeddings
    where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
s as (
    select a.vec_id as query_id, b.vec_id, list_inner_product(a.q, b.q)::bigint as score
    from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as "rank" from s)
select query_id, "rank", vec_id, score from r where "rank" <= 10
"""

SQL["op13_hard_negatives"] = r"""
with v as (
    select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label::bigint end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)) as q
    from embeddings
    where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
s as (
    select a.vec_id as anchor_id, b.vec_id, a.label = b.label as alike, list_inner_product(a.q, b.q)::bigint as score
    from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
),
p as (
    select anchor_id, vec_id as positive_id, score as positive_score from s where alike
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id, (row_number() over n)::int as "rank", vec_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not alike and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
window n as (partition by anchor_id, positive_id order by score desc, vec_id)
qualify row_number() over n <= 10
"""
