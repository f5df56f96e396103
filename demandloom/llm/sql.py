"""The operators that SQL can express, as DuckDB SQL over the same tables."""

from __future__ import annotations

_WHITE = r"[\x20\x09-\x0D]+"

SQL = {
    "op1_line_dedup": r"""
with docs as (
    select row_number() over () as r, doc_id, text, string_split(text, chr(10)) as lines from documents
), numbered as (
    select r, doc_id, generate_subscripts(lines, 1) - 1 as i, unnest(lines) as line from docs
), filled as (
    select r, doc_id, i, line, row_number() over (partition by r order by i) as k
    from numbered where regexp_matches(line, '[^\x20\x09-\x0D]')
), windows as (
    select a.r, a.doc_id, a.i as s, c.i as e, a.line || chr(10) || b.line || chr(10) || c.line as w
    from filled a join filled b on a.r = b.r and b.k = a.k + 1 join filled c on a.r = c.r and c.k = a.k + 2
), placed as (
    select *, row_number() over (partition by w order by doc_id, s) as place from windows
), covered as (
    select distinct r, unnest(range(s, e + 1)) as i from placed where place > 1
), kept as (
    select n.r, string_agg(n.line, chr(10) order by n.i) as text, count(*) as k
    from numbered n left join covered c on n.r = c.r and n.i = c.i where c.r is null group by n.r
)
select d.doc_id, coalesce(len(d.lines), 0)::bigint as n_lines,
       (coalesce(len(d.lines), 0) - coalesce(k.k, 0))::bigint as n_removed,
       case when d.text is null then null else coalesce(k.text, '') end as text
from docs d left join kept k on d.r = k.r
""",
    "op4_decontaminate": r"""
with d as (
    select doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') as w from documents
), ds as (
    select distinct doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) as g from d where len(w) >= 5
), b as (
    select item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') as w from benchmark
), bs as (
    select distinct item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) as g from b where len(w) >= 5
), n as (
    select item_id, count(*) as n_item from bs group by item_id
), shared as (
    select ds.doc_id, bs.item_id, count(*) as n_shared from ds join bs using (g) group by all
)
select doc_id, item_id, n_item, n_shared, n_shared / n_item as containment
from shared join n using (item_id) where 5 * n_shared >= 4 * n_item
""",
    "op5_substring_dedup": r"""
with d as (
    select row_number() over () as r, doc_id,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents
), s as (
    select r, unnest(range(1, len(w) - 33)) as i, w from d where len(w) >= 35
), g as (
    select r, i, sha256(array_to_string(w[i:i+34], ' ')) as g from s
), c as (
    select r, i from g qualify count(*) over (partition by g) > 1
), covered as (
    select r, list_sort(list_distinct(flatten(list(range(i, i + 35))))) as p from c group by r
), k as (
    select d.doc_id, len(d.w) as n, len(coalesce(covered.p, [])) as n_removed,
           case when covered.p is null then d.w
                else list_transform(list_filter(range(1, len(d.w) + 1), lambda i: not list_contains(covered.p, i)), lambda i: d.w[i]) end as kept
    from d left join covered on d.r = covered.r
)
select doc_id, n::bigint as n_words, n_removed::bigint as n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) as kept_sha256 from k
""",
    "op7_warc": r"""
with p as (
    select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages
), b as (
    select *, array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda k:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hex, 5 * i + 1, 5))::bigint >> k) & 31) + 1)::bigint, 1)), '')), '') as digest from p
), f as (
    select *, min(page_id) over (partition by hex) as first from b
)
select page_id, strlen(html)::bigint as payload_bytes, digest as payload_digest,
       case when first is null or page_id = first then 'response' else 'revisit' end as record_type,
       case when first is null or page_id = first then null else first end as refers_to
from f
""",
}


def _rounds(n_centroids: int, rounds: int, dims: int, scale: int) -> str:
    """Lloyd rounds in plain steps: all distances, argmin, exact floor of the mean."""
    steps = f"""
with recursive kept as materialized (
    select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(x::double * {scale})::bigint) as v
    from embeddings
    where len(embedding) = {dims} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {dims}
), c0 as materialized (
    select row_number() over (order by sha256('1:' || vec_id) nulls last, v) - 1 as k, v as c
    from kept qualify k < {n_centroids}
)"""
    for i in range(rounds + 1):
        steps += f"""
, a{i} as materialized (
    select r, vec_id, v, k, list_sum(list_transform(range(1, {dims + 1}), lambda j: (v[j] - c[j]) * (v[j] - c[j])))::bigint as d
    from kept, c{i} qualify row_number() over (partition by r order by d, k) = 1
)"""
        if i < rounds:
            steps += f"""
, s{i} as materialized (
    select k, j, sum(x)::bigint as s, count(*) as n
    from (select k, generate_subscripts(v, 1) as j, unnest(v) as x from a{i}) group by k, j
), m{i} as materialized (
    select k, list((s - ((s % n) + n) % n) // n order by j) as c from s{i} group by k
), c{i + 1} as materialized (
    select c{i}.k, coalesce(m{i}.c, c{i}.c) as c from c{i} left join m{i} on c{i}.k = m{i}.k
)"""
    return f"""{steps}
select vec_id, a{rounds}.k::int as cluster, d as distance,
       (sum(d) over (partition by a{rounds}.k))::bigint as cluster_inertia, (sum(d) over ())::bigint as inertia,
       sha256(array_to_string(c, ',')) as centroid_sha256
from a{rounds} join c{rounds} on a{rounds}.k = c{rounds}.k
"""


SQL["op12_centroids"] = _rounds(16, 3, 64, 64)
