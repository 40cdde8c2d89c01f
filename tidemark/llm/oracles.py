"""DuckDB statements for the corpus queries that SQL can express."""

from __future__ import annotations

from tidemark.llm.quality import STOP_WORDS

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_STOP = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))

SQL: dict[str, str] = {}

SQL["op5_mixing"] = rf"""
with sized as (
    select doc_id, source, len({_WORDS})::bigint as size from documents
), keyed as (
    select *, md5(concat_ws(':', doc_id::varchar, size::varchar)) as digest from sized
), totals as (
    select source, sum(size)::bigint as source_size from sized group by source
), weighted as (
    select *, row_number() over (order by source nulls last) - 1 as place,
           [5.0, 2.0, 1.0][(row_number() over (order by source nulls last) - 1) % 3 + 1]::double as weight,
           source_size * 2.0::double as cap
    from totals
), filled as (
    select *,
           (sum(source_size) over ())::double * 1.5::double as words,
           coalesce(sum(cap) over (order by cap / weight, place
                    rows between unbounded preceding and 1 preceding), 0)::double as given,
           (sum(weight) over () - coalesce(sum(weight) over (order by cap / weight, place
                    rows between unbounded preceding and 1 preceding), 0))::double as weights
    from weighted
), levels as (
    select *, max(case when (words - given) / weights * weight <= cap then (words - given) / weights end)
              over () as level
    from filled
), aims as (
    select source, source_size, place, least(cap, coalesce(level * weight, cap)) as target from levels
), queued as (
    select k.doc_id, k.size, a.source_size, a.target, a.place,
           (sum(k.size) over (partition by k.source order by k.digest, k.doc_id, k.size
                rows between unbounded preceding and current row))::double - k.size / 2.0::double as middle
    from keyed k join aims a on k.source is not distinct from a.source
), taken as (
    select *,
           case when size = 0 then 0
                else (case when middle < target then 1 else 0 end)
                   + (case when middle + source_size < target then 1 else 0 end) end as copies,
           middle / target as share
    from queued
)
select doc_id, size, source_size, target, (size * copies)::bigint as taken,
       case when copies = 0 then null else round(least(1.0::double, case place % 3
           when 0 then (case when share >= 0.625
                        then 0.5 + 2 * (share - 0.625) / (1 + sqrt(greatest(1 - 2 * (share - 0.625), 0)))
                        else 2 * share / (1.5 + sqrt(greatest(2.25 - 2 * share, 0))) end)
           when 1 then share
           else (case when share >= 0.375
                        then 0.5 + 2 * (share - 0.375) / (1 + sqrt(greatest(1 + 2 * (share - 0.375), 0)))
                        else 2 * share / (0.5 + sqrt(greatest(0.25 + 2 * share, 0))) end)
           end), 6) end as first_position
from taken
"""

SQL["op6_quality"] = rf"""
with base as (
    select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents
), worded as (
    select *, {_WORDS} as w from base
), grams as (
    select rid, i, w[i:i + 4] as gram
    from (select rid, w, unnest(range(1, len(w) - 3)) as i from worded where len(w) > 5)
), twice as (
    select rid, i from (select rid, i, count(*) over (partition by rid, gram) as n from grams) where n > 1
), covered as (
    select rid, sum(least(5, i - coalesce(before, i - 5)))::bigint as n
    from (select rid, i, lag(i) over (partition by rid order by i) as before from twice) group by rid
), lines as (
    select rid, (count(*) - count(distinct line))::bigint as dups, count(*) as n
    from (select rid, unnest(string_split(text, chr(10))) as line from base)
    where regexp_matches(line, '[^\x20\x09-\x0D]') group by rid
), counted as (
    select doc_id, len(w)::bigint as n_words,
           length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
           (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
           length(text) - length(replace(text, '!', '')) as n_exclamations,
           coalesce(l.dups, 0) as n_dup_lines, coalesce(l.n, 0) as n_lines,
           coalesce(c.n, 0) as n_repeat_words,
           len(list_filter(w, lambda x: lower(x) in ({_STOP}))) as n_stop
    from worded left join lines l using (rid) left join covered c using (rid)
), judged as (
    select *, (n_words < 10 or 100 * n_repeat_words > 20 * n_words) as base_failed,
           greatest(n_words, 1)::double as n from counted
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed
       and word_chars / n between 2.0 and 12.0
       and n_symbols / n <= 0.2
       and n_exclamations / n <= 0.5
       and n_dup_lines / greatest(n_lines, 1)::double <= 0.5
       and (n_stop / n >= 0.01 or n_words < 100) as kept
from judged
"""

SQL["op10_topk"] = """
with usable as (
    select row_number() over () as rid, vec_id,
           list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.rid, q.vec_id as query_id, c.vec_id,
           list_inner_product(q.v, c.v)::bigint as score
    from usable q join usable c on q.rid <> c.rid and len(q.v) = len(c.v)
    where q.vec_id % 50 = 0
), ranked as (
    select *, row_number() over (partition by rid order by score desc, vec_id) as place from scored
)
select query_id, place::integer as rank, vec_id, score from ranked where place <= 5
"""

SQL["op7_setsketch"] = rf"""
with recursive worded as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents
), shingled as (
    select doc_id, case when len(w) = 0 then [] when len(w) = 1 then [w[1]]
           else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as s
    from worded
), items as (
    select doc_id, unnest(s) as item from shingled
), sizes as (
    select doc_id, len(s) as n from shingled
), numbered as (
    select item, row_number() over (order by count(*), item) as place from items group by item
), ordered as (
    select doc_id, item, place, row_number() over (partition by doc_id order by place) as rank
    from items join numbered using (item)
), prefixes as (
    -- two sets that alike share one of their (n - ceil(0.8 n) + 1) rarest items
    select doc_id, item, n from ordered join sizes using (doc_id) where rank <= n - (4 * n + 4) // 5 + 1
), candidates as (
    select distinct a.doc_id as x, b.doc_id as y
    from prefixes a join prefixes b on a.item = b.item and a.doc_id < b.doc_id
    where 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), links as (
    select x, y
    from (select c.x, c.y, count(*) as shared from candidates c
          join items a on a.doc_id = c.x join items b on b.doc_id = c.y and b.item = a.item
          group by c.x, c.y)
    join sizes p on p.doc_id = x join sizes q on q.doc_id = y
    where 100 * shared >= 80 * (p.n + q.n - shared)
), steps as (
    select x as u, y as v from links union select y, x from links
), reach as (
    select u, v from steps union select r.u, s.v from reach r join steps s on r.v = s.u
), least_of as (
    select u, min(v) as m from reach group by u
)
select s.doc_id, s.n::bigint as n_shingles, least(s.doc_id, coalesce(m, s.doc_id)) as component_id,
       s.doc_id = least(s.doc_id, coalesce(m, s.doc_id)) as kept
from sizes s left join least_of on u = s.doc_id
"""

SQL["op9_suffix_dedup"] = """
with raw as (
    select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n
    from documents
), windows as (
    select doc_id, p, md5_number(substr(h, (2 * p + 1)::bigint, 200)) as w
    from (select doc_id, h, unnest(range(0, n - 99)) as p from raw where n >= 100)
), marked as (
    select doc_id, p, row_number() over (partition by w order by doc_id, p) as place from windows
), again as (
    select doc_id, p, lag(p) over (partition by doc_id order by p) as before from marked where place > 1
), islands as (
    select doc_id, p, sum(case when before is null or p - before > 100 then 1 else 0 end)
           over (partition by doc_id order by p) as island
    from again
), spans as (
    select doc_id, min(p) as a, max(p) + 100 as b from islands group by doc_id, island
), pieces as (
    select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as gap from spans
), cuts as (
    select doc_id, sum(b - a)::bigint as removed, count(*) as n_spans, max(b) as tail,
           string_agg(substr(h, (2 * gap + 1)::bigint, (2 * (a - gap))::bigint), '' order by a) as head
    from pieces join raw using (doc_id) group by doc_id
)
select doc_id, n::bigint as n_bytes, coalesce(removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, (2 * coalesce(tail, 0) + 1)::bigint))) as kept_sha256
from raw left join cuts using (doc_id)
"""

SQL["op11_covertree"] = """
with recursive sound as (
    select row_number() over () as rid, vec_id, label, embedding::double[] as v from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
    select a.rid as x, b.rid as y, b.vec_id as other
    from sound a join sound b on a.label = b.label and len(a.v) = len(b.v) and a.rid <> b.rid
    where list_cosine_similarity(a.v, b.v) >= 0.98
), reach as (
    select x, y from links union select r.x, l.y from reach r join links l on r.y = l.x
), least_of as (
    select r.x, min(s.vec_id) as m from reach r join sound s on s.rid = r.y group by r.x
), counted as (
    select x, count(*) as n from links group by x
), joined as (
    select s.vec_id, coalesce(n, 0) as n_links, least(s.vec_id, coalesce(m, s.vec_id)) as component_id
    from sound s left join counted c on c.x = s.rid left join least_of l on l.x = s.rid
    union all
    select vec_id, 0, vec_id from embeddings
    where vec_id is null or label is null or embedding is null
       or len(list_filter(embedding, lambda x: x is null or not isfinite(x))) > 0
       or len(list_filter(embedding, lambda x: x <> 0)) = 0
)
select vec_id, n_links::bigint as n_links, component_id, vec_id is null or vec_id = component_id as kept from joined
"""


def _rounds(n: int) -> str:
    """Assignments a0 to a<n> and the centroids between them."""
    out = []
    for i in range(n + 1):
        out.append(
            f"""a{i} as materialized (
    select rid, min({{'d': list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c),
                      'num': num}}) as best
    from kept, c{i} group by rid
)"""
        )
        if i < n:
            out.append(
                f"""m{i} as (
    select num, list(x order by d) as c from (
        select best.num as num, d, floor(sum(v[d])::double / count(*)) as x
        from a{i} join kept using (rid), (select unnest(range(1, 65)) as d) group by all
    ) group by num
), c{i + 1} as materialized (
    select num, coalesce(m{i}.c, c{i}.c) as c from c{i} left join m{i} using (num)
)"""
            )
    return ", ".join(out)


SQL["op12_centroids"] = f"""
with kept as materialized (
    select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings
    where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), c0 as materialized (
    select row_number() over (order by sha256('2:' || coalesce(vec_id::varchar, '')), v) - 1 as num, v as c
    from kept qualify num < 40
), {_rounds(5)}, summed as (
    select best.num as num, sum(best.d) as total from a5 group by best.num
)
select vec_id, best.num::integer as cluster, best.d::bigint as distance, total::bigint as cluster_inertia,
       (select sum(total) from summed)::bigint as inertia,
       sha256(array_to_string(list_transform(c, lambda x: x::bigint::varchar), ',')) as centroid_sha256
from a5 join kept using (rid) join summed on summed.num = best.num join c5 on c5.num = best.num
"""

# the reflected polynomial of CRC-32; each distinct word's checksum is computed once
_BIT = "case when {c} & 1 = 1 then xor({c} >> 1, 3988292384) else {c} >> 1 end"
_CRC = "list_reduce(range(8), lambda c, k: " + _BIT.format(c="c") + ", {start})"
_TOKENS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
SQL["op13_resampling"] = f"""
with docs as materialized (
    select row_number() over () as rid, doc_id, {_TOKENS} as w from documents
), goal as materialized (
    select unnest({_TOKENS}) as word from benchmark
), spread as materialized (
    select rid, unnest(w) as word from docs
), vocabulary as (
    select word, hex(encode(word)) as h from (select word from spread union select word from goal)
), placed as materialized (
    select word, xor(list_reduce(list_transform(range(1, len(h) // 2 + 1), lambda i: ('0x' || substr(h, 2 * i - 1, 2))::bigint),
           lambda acc, byte: {_CRC.format(start="xor(acc, byte)")}, 4294967295::bigint), 4294967295) % 10000 as place
    from vocabulary
), s as (
    select place, count(*) as n from spread join placed using (word) group by place
), t as (
    select place, count(*) as n from goal join placed using (word) group by place
), gains as (
    select place, floor(1000 * ln(((coalesce(t.n, 0) + 1) * ((select count(*) from spread) + 10000))::double
                   / ((coalesce(s.n, 0) + 1) * ((select count(*) from goal) + 10000))::double))::bigint as gain
    from s full join t using (place)
), weighed as (
    select rid, sum(gain) as weight from spread join placed using (word) join gains using (place) group by rid
), scored as (
    select rid, doc_id, len(w)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
           (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id::varchar), 1, 8))::bigint + 0.5::double)
                / 4294967296::double))))::bigint as score
    from docs left join weighed using (rid)
), able as (
    select rid, row_number() over (order by score desc, doc_id, n_features) as place, count(*) over () as n
    from scored where n_features >= 20 and score is not null
)
select doc_id, n_features, weight, score, case when place <= 10 * n // 100 then place end::bigint as rank
from scored left join able using (rid)
"""
