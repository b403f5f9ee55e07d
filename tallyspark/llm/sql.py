"""SQL of those queries that SQL can express on whole tables."""

_GRAMS = "g as (select distinct doc_id, i, substr(text, cast(i as int), 200) as x from documents, unnest(range(1, length(text) - 198)) r(i) where length(text) >= 200)"
_SHARED = _GRAMS + ", m as (select x from g group by 1 having count(distinct doc_id) > 1), s as (select doc_id, i from g where x in (select x from m))"

ORACLE = {
    "p10_classes": "select doc_id, min(doc_id) over (partition by text) as class_id from documents where length(text) >= 200",
    "p10_found": f"with {_SHARED}, h as (select g.doc_id, g.x from g join s using (doc_id, i)) select distinct a.doc_id as doc_a, b.doc_id as doc_b from h a join h b on a.x = b.x and a.doc_id < b.doc_id",
    "p10_links": f"""with {_SHARED}, c as (select doc_id, min(doc_id) over (partition by text) as k from documents where length(text) >= 200), h as (select distinct c.k, g.x from g join s using (doc_id, i) join c using (doc_id))
        select distinct a.k as class_a, b.k as class_b from h a join h b on a.x = b.x and a.k < b.k""",
    "p10_shares": f"""with {_SHARED}, n as (select doc_id, i, lag(i) over w as before, lead(i) over w as after from s window w as (partition by doc_id order by i)),
        c as (select doc_id, count(*) filter (before is null or i - before > 200) as n_spans, cast(sum(least(200, coalesce(after - i, 200))) as bigint) as shared_chars from n group by 1)
        select doc_id, coalesce(n_spans, 0) as n_spans, coalesce(shared_chars, 0) as shared_chars, coalesce(shared_chars / nullif(length(text), 0), 0) as share from documents left join c using (doc_id)""",
}
