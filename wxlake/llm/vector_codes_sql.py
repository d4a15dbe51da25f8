"""SQL twin of the vector codes: full comparisons in each round."""

from __future__ import annotations

from wxlake.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE


def _assigned(number: int) -> str:
    """``a{number}``: the nearest entry of ``b{number}`` of each part of each vector, and its squared distance."""
    return f"""
a{number} as materialized (
    select r, part, v, arg_min(entry, (d, entry)) as entry, min(d) as d
    from (select r, p.part, p.v, b.entry, list_sum(list_transform(list_zip(p.v, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
          from cut as p join b{number} as b on p.part = b.part) group by r, part, v)"""


def _moved(number: int) -> str:
    """``b{number}``: the entries after one more round."""
    last = number - 1
    return f"""
b{number} as materialized (
    select b.part, b.entry, coalesce(m.c, b.c) as c from b{last} as b left join (
        select part, entry, list(c order by place) as c
        from (select part, entry, place, floor(sum(x)::double / count(*))::bigint as c
              from (select part, entry, unnest(v) as x, unnest(range(1, len(v) + 1)) as place from a{last}) group by part, entry, place)
        group by part, entry) as m on m.part = b.part and m.entry = b.entry)"""


CODES = f"""
with kept as materialized (
    select vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v,
           row_number() over (order by vec_id nulls last, embedding) as r
    from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
cut as materialized (
    select r, part, v[part * (len(v) // {PARTS}) + 1 : (part + 1) * (len(v) // {PARTS})] as v
    from kept, (select unnest(range({PARTS})) as part)),
b0 as materialized (select part, r - 1 as entry, v as c from cut where r <= {ENTRIES}),
{",".join(_assigned(i) + "," + _moved(i + 1) for i in range(ROUNDS))},
{_assigned(ROUNDS)},
book as (
    select sha256(string_agg(x::varchar, ',' order by part, entry, place)) as codebooks_sha256
    from (select part, entry, unnest(c) as x, unnest(range(1, len(c) + 1)) as place from b{ROUNDS})),
coded as (
    select r, string_agg(printf('%02x', entry), '' order by part) as code, sum(d)::bigint as error from a{ROUNDS} group by r)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from coded join kept using (r) cross join book"""
